"""Name normalisation and list stacking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# District aliases of the study's exam-results sheet
# (results spelling -> census spelling), applied in this order.
EXAM_DISTRICT_ALIASES = [
    ("bagalkote", "bagalkot"),
    ("chikodi", "belagavi chikkodi"),
    ("bengaluru north", "bengaluru u north"),
    ("bengaluru south", "bengaluru u south"),
    ("chamarajanagar", "chamarajanagara"),
    ("chikkaballapur", "chikkaballapura"),
    ("chikkamagaluru", "chikkamangaluru"),
    ("kalaburagi", "kalburgi"),
    ("madhugiri", "tumakuru madhugiri"),
    ("ramnagara", "ramanagara"),
    ("sirsi", "uttara kannada sirsi"),
    ("yadgir", "yadagiri"),
]

ALIAS_FROM = "alias_from"
ALIAS_TO = "alias_to"
ALIAS_ORDER = "alias_order"
#: Rows that an ordered alias table may have: they travel as one array.
MOST_ALIASES = 10_000


def normalize_key(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.trim(c))


def apply_aliases(df: DataFrame, column: str, aliases, mode: str = "exact",
                  out: str | None = None) -> DataFrame:
    """Replace values of ``column`` through an alias map.

    ``aliases`` is a list of (from, to) pairs or a DataFrame with columns
    ``alias_from``/``alias_to``.

    * ``exact`` (default): whole-value match. A list becomes a CASE
      expression (no join); a DataFrame is joined ``left`` on the value after
      de-duplicating its keys (the smallest target wins), so the join never
      multiplies rows. The planner broadcasts it when its statistics are small.
    * ``substring``: unanchored literal replacements applied one after the
      other in list order (the study's behaviour; ``bagalkote`` with the pair
      ``bagalkot -> bagalkote`` becomes ``bagalkotee``). A DataFrame has a
      column ``alias_order``, too, and at most ``MOST_ALIASES`` rows (more are an
      error): they become one sorted array, folded over each value. Rows with a
      null spelling are left out; ties in order go by spelling.
    """
    out = out or column
    if mode == "substring":
        if isinstance(aliases, DataFrame):
            if ALIAS_ORDER not in aliases.columns:
                raise ValueError(f"substring mode needs an ordered list of pairs, or a table with {ALIAS_ORDER}")
            pairs = aliases.select(ALIAS_ORDER, ALIAS_FROM, ALIAS_TO).dropna(subset=[ALIAS_FROM, ALIAS_TO])
            if pairs.limit(MOST_ALIASES + 1).count() > MOST_ALIASES:
                raise ValueError(f"more than {MOST_ALIASES} ordered aliases")
            listed = pairs.agg(F.sort_array(F.collect_list(F.struct(ALIAS_ORDER, ALIAS_FROM, ALIAS_TO)))).scalar()
            folded = F.aggregate("_aliases", F.col(column), lambda name, a: F.replace(name, a[ALIAS_FROM], a[ALIAS_TO]))
            return df.withColumn("_aliases", listed).withColumn(out, folded).drop("_aliases")
        expr = F.col(column)
        for src, dst in aliases:
            expr = F.replace(expr, F.lit(src), F.lit(dst))
        return df.withColumn(out, expr)
    if mode != "exact":
        raise ValueError(f"unknown mode {mode!r}")
    if isinstance(aliases, DataFrame):
        amap = aliases.groupBy(ALIAS_FROM).agg(F.min(ALIAS_TO).alias(ALIAS_TO))
        joined = df.join(amap, df[column] == amap[ALIAS_FROM], "left")
        return joined.withColumn(out, F.coalesce(F.col(ALIAS_TO), F.col(column))).drop(
            ALIAS_FROM, ALIAS_TO
        )
    first: dict = {}
    for src, dst in aliases:
        first.setdefault(src, dst)
    expr = None
    c = F.col(column)
    for src, dst in first.items():
        expr = F.when(c == F.lit(src), F.lit(dst)) if expr is None else expr.when(c == F.lit(src), F.lit(dst))
    return df.withColumn(out, c if expr is None else expr.otherwise(c))


def stack_lists(df: DataFrame, pairs, name_out: str, label_out: str, value_out: str,
                complete_only: bool = False, aliases=None) -> DataFrame:
    """Side-by-side (name, value) column pairs to one long table.

    ``pairs`` holds (name column, value column, label). Names are lower-cased,
    values cast to double with ``try_cast``; rows of shorter lists (null name)
    are dropped. The lists come out of one projection (an exploded array).
    ``aliases`` (exact matches, see ``apply_aliases``) are applied to the names
    of every list before the lists are compared. ``complete_only`` keeps only
    names present in every list (the study joined the lists inner); a grouped
    count joined back, one row per name.
    """
    items = [
        F.struct(
            normalize_key(F.col(f"`{name_col}`")).alias(name_out),
            F.lit(str(label)).alias(label_out),
            F.col(f"`{value_col}`").try_cast("double").alias(value_out),
        )
        for name_col, value_col, label in pairs
    ]
    out = df.select(F.explode(F.array(*items)).alias("_item")).select("_item.*").where(F.col(name_out).isNotNull())
    if aliases is not None:
        out = apply_aliases(out, name_out, aliases)
    if complete_only:
        full = (out.groupBy(name_out).agg(F.countDistinct(label_out).alias("_n"))
                .where(F.col("_n") == F.lit(len(pairs))).select(name_out))
        out = out.join(full, name_out, "left_semi")
    return out
