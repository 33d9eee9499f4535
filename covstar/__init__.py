"""covstar: a PySpark-native mobile-coverage star-schema warehouse."""

from .operators.warehouse import Warehouse
from .sources.adapter import events_to_raw, raw_from_dir

__all__ = ["Warehouse", "events_to_raw", "raw_from_dir"]
