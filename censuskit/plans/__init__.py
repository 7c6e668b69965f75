"""Query plans: the named analyses (``catalog``) and their SQL oracle."""

from censuskit.plans.catalog import QUERIES  # noqa: F401
from censuskit.plans.oracle import oracle_sql  # noqa: F401
