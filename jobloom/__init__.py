"""Event-driven table ingest on Spark: decode, route, enrich, import and merge."""

from jobloom.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
