"""Named queries over the supplied tables, and SQL that states what they must return."""

from .oracles import ORACLES
from .queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
