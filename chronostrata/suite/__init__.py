from chronostrata.suite import cleaning, history, marts, merges, quality, search, streams, tables, vault  # noqa: F401
from chronostrata.suite.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
