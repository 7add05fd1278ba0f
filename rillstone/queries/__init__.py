"""All queries of the library's operators over the given tables."""

from rillstone.queries import focal, grid, hydro, spatial, zones  # noqa: F401
from rillstone.queries.registry import QUERIES, SQL  # noqa: F401
