"""The registered queries: each runs one or several operators over the given tables.

Every query has a name, the operator ids of the survey it covers and, where SQL can express the
result, a statement that another engine can run on the same tables.
"""

from barloom.catalog import tables  # noqa: F401  (first: the others build on its views)
from barloom.catalog import functions  # noqa: F401
from barloom.catalog import panel  # noqa: F401
from barloom.catalog import features, functions, learning, screening, sinks, sources, split  # noqa: F401
from barloom.catalog.registry import IDS, ORACLES, QUERIES

__all__ = ["IDS", "ORACLES", "QUERIES"]
