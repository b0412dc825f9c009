"""All registered queries and the SQL they are checked against."""

from plateflow.queries import analyses, files, images, jobs  # noqa: F401  (they register their queries)
from plateflow.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
