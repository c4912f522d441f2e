"""humusgrid: a Spark-native engine for provenance-first scientific measurement tables."""

from humusgrid.session import get_session
from humusgrid.sources.tables import load_table

__all__ = ["get_session", "load_table"]
