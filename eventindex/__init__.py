"""Index, search and analyse large collections of per-event measurement files on Spark."""

from eventindex.plans.api import EventIndex
from eventindex.plans.build import build_index
from eventindex.session import configure

__all__ = ["EventIndex", "build_index", "configure"]
