"""Generic DataFrame operators (cleansing, keying, size-aware joins)."""
