"""Sources: the census reader, the census derived from the driver tables,
the outcome (exam result) table and the fixture generators."""

from censuskit.sources.census import (  # noqa: F401
    census_table,
    derived_census,
    read_census,
    read_census_csv,
    write_census,
)
from censuskit.sources.outcome import (  # noqa: F401
    outcome_long,
    outcome_sheet,
    read_outcome_csv,
)
