"""Named queries.  Importing this package registers every query."""

from . import abc, clean, inventory, io, measures, ml, profile, sales, slicers, supplier, timeseries  # noqa: F401
from . import library  # noqa: F401  (after the modules it derives from)
from .registry import ORACLE_SQL, QUERIES, query  # noqa: F401
