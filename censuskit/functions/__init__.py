"""Column expressions (JVM-side, codegen-friendly) used by the operators."""

from censuskit.functions.exprs import (  # noqa: F401
    pct_gap_of_sums,
    pct_have,
    pct_lack,
    pearson,
    ratio_weighted_sum,
    round6,
    scaled_weighted_sum,
    sector_of,
    value_map,
)
