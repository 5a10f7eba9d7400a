"""Column-level helpers (Column in, Column out), all JVM-side built-ins."""

from layercake.functions.exprs import *  # noqa: F401,F403
