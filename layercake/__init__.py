"""layercake: a layered (bronze -> silver -> gold) batch warehouse and sales
analytics library built from Spark DataFrame and SQL built-ins.

Sub-packages
------------
functions  Column -> Column helpers with warehouse semantics (integer
           division, calendar-boundary date differences, code maps, ...).
operators  Generic DataFrame -> DataFrame cleansing and keying operators.
sources    Declared schemas, the CSV ingest with quarantine and audit, the
           catalog helpers and the test-table adapter.
plans      The concrete layer plans: silver cleansing, gold star schema,
           analyses and reports, plus the layer runners.
"""

__version__ = "0.1.0"
