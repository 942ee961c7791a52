"""All checked queries."""

from checks import assembly, files, genome, tables  # noqa: F401
from checks.registry import QUERIES, SQL  # noqa: F401
