"""Concrete layer plans: silver cleansing, gold star schema, analyses, reports."""
