"""Named queries over the given tables, with SQL that has the same result."""

from . import decision_queries, function_queries, gate_queries, geometry_queries, lookup_queries, overlay_queries, record_queries, scene_queries, source_queries, spatial_queries, stream_queries  # noqa: F401 (they register their queries)
from .catalog import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
