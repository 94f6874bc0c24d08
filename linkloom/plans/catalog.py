"""Registered queries of the linkage engine and their SQL counterparts."""

from linkloom.plans.oracles import ORACLES
from linkloom.plans.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
