"""Census sources.

* ``read_census_csv``: the original layout, one folder per (year, state) of
  CSV files with a header row; one pass over the bytes, columns matched by
  *name* in every file and cast explicitly (no schema inference pass, no
  positional union).
* ``derived_census``: a census built from the driver's TPC-H-style tables, so
  that every job can run on data whose size grows with the scale factor.
* ``write_census`` / ``read_census``: Parquet, partitioned by year and state,
  so that a year or state filter prunes folders.
* ``census_table``: the derived census on its join result, which is
  materialised once per session in the checkpoint folder; a query reads the
  key columns it uses and computes only the measures it names.
"""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censuskit.schema import (
    CENSUS_COLUMNS,
    CENSUS_SCHEMA,
    DISTRICT,
    LOCATION,
    MANAGEMENT_NAMES,
    MEASURES,
    MGMT_ID,
    MGMT_NAME,
    PERIOD,
    RURAL,
    STATE,
    TOTAL,
    URBAN,
)
from censuskit.sources import storage

# ---------------------------------------------------------------------------
# Original CSV layout
# ---------------------------------------------------------------------------


LINES_VERSION = "1"
_FILE, _HEADER, _LINE, _CORRUPT = "_file", "_header", "_line", "_corrupt"


def _csv_text(spark: SparkSession, pattern: str) -> DataFrame:
    """The lines of all CSV files: ``_file``, ``_header`` (a line that names the
    total column) or ``_line`` (any other that is not blank)."""
    lines = spark.read.text(pattern).select(F.col("_metadata.file_path").alias(_FILE), "value")
    is_header = F.contains(F.lower("value"), F.lit(TOTAL.lower()))
    return lines.where(F.trim("value") != "").select(_FILE, F.when(is_header, F.col("value")).alias(_HEADER), F.when(~is_header, F.col("value")).alias(_LINE))


def _csv_lines(spark: SparkSession, base_path: str) -> DataFrame:
    """``_csv_text`` of ``<base>/<year>/<state>/*.csv``, read once: the bytes
    are scanned for the write, headers and rows then come from Parquet. Files
    that change make a new table."""
    base = base_path.rstrip("/")
    try:
        finger = storage.content_fingerprint(spark, [base])
        lines = _csv_text(spark, f"{base}/*/*/*.csv")
    except AnalysisException as e:
        raise FileNotFoundError(f"no <year>/<state> folders of CSV files under {base_path}") from e
    return storage.materialize(
        spark, f"csv-{finger[:16]}", [base], LINES_VERSION,
        build=lambda: lines,
        write=lambda df, path: df.write.mode("overwrite").parquet(path),
        read=lambda path: spark.read.schema(lines.schema).parquet(path),
    )


def _census_strings(spark: SparkSession, base_path: str) -> DataFrame:
    """The census columns of the rows as strings, ``_file``, and ``_corrupt``:
    the line of a row that has more or fewer fields than its header."""
    lines = _csv_lines(spark, base_path)
    headers = lines.groupBy(_FILE).agg(F.max(_HEADER).alias(_HEADER))  # one row per file
    found = [r[0] for r in headers.select(_HEADER).distinct().collect()]  # one row per header
    if None in found:
        raise ValueError(f"CSV files without a header that names {TOTAL} under {base_path}")
    path = F.url_decode(F.replace(_FILE, F.lit("+"), F.lit("%2B")))
    folder = {PERIOD: r"/([^/]+)/[^/]+/[^/]+$", STATE: r"/([^/]+)/[^/]+$"}
    rows = lines.where(F.col(_LINE).isNotNull()).select(_FILE, _LINE).join(headers, _FILE)
    parsed = F.lit(None)
    for header in sorted(found):  # one branch per header; a row is parsed by its own
        names = [c.strip().lstrip("\ufeff").lower() for c in next(csv.reader([header]))]
        fields = F.from_csv(_LINE, ", ".join([*(f"_{i} STRING" for i in range(len(names))), f"{_CORRUPT} STRING"]), {"columnNameOfCorruptRecord": _CORRUPT})
        branch = F.get(F.transform(F.array(fields), _census_fields(names)), F.lit(0))
        parsed = F.when(F.col(_HEADER) == F.lit(header), branch).otherwise(parsed)
    if not found:
        parsed = F.lit(None).cast(f"struct<{', '.join(f'{c}:string' for c in [*CENSUS_COLUMNS, _CORRUPT])}>")
    strings = rows.select(_FILE, parsed.alias("row")).select(_FILE, "row.*")
    for name, pattern in folder.items():  # a folder is named "<value>" or "<column>=<value>"
        strings = strings.withColumn(name, F.coalesce(name, F.regexp_replace(F.regexp_extract(path, pattern, 1), "^[^=]*=", "")))
    return strings


def _census_fields(names: list[str]):
    """Census columns, by name, of fields parsed by position."""

    def pick(x):
        columns = [F.trim(x[f"_{names.index(c.lower())}"]) if c.lower() in names else F.lit(None).cast("string") for c in CENSUS_COLUMNS]
        return F.struct(*[c.alias(n) for n, c in zip(CENSUS_COLUMNS, columns)], x[_CORRUPT].alias(_CORRUPT))

    return pick


def read_census_csv(spark: SparkSession, base_path: str, null_policy: str = "keep") -> DataFrame:
    """Read ``<base>/<year>/<state>/*.csv``.

    A CSV scan maps all its files by position, so files exported with another
    column order would shift silently. Here the lines are read once, as text,
    however many layouts there are; a table of one header per file is joined to
    them, and every row is parsed by its own header (all fields as strings, no
    inference pass). Census columns are picked by header name, ignoring case and
    blanks, and cast with ``try_cast`` (``bad_census_values`` counts what does
    not cast, ``bad_census_rows`` the rows that do not fit their header).
    ``Academic_Year`` and ``State_Name`` fall back to the folder names
    (``<year>/<state>`` or ``Academic_Year=<year>/State_Name=<state>``) when the
    files do not carry them. A quoted field may not hold a line feed.
    """
    strings = _census_strings(spark, base_path)
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in CENSUS_SCHEMA.fields]
    return apply_null_policy(strings.select(*typed), null_policy)


def bad_census_values(spark: SparkSession, base_path: str) -> DataFrame:
    """Per census column, ``Bad_Values``: CSV values that are present but do
    not cast to the column's type, and so are null in ``read_census_csv``."""
    strings = _census_strings(spark, base_path)
    bad = [F.count(F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), 1)).alias(f.name) for f in CENSUS_SCHEMA.fields]
    return strings.agg(*bad).unpivot([], CENSUS_COLUMNS, "Column_Name", "Bad_Values")


def bad_census_rows(spark: SparkSession, base_path: str) -> DataFrame:
    """Per year and state, ``Rows`` and ``Bad_Rows``: rows with more or fewer
    fields than their header names (what they have is read by position)."""
    strings = _census_strings(spark, base_path)
    return strings.groupBy(PERIOD, STATE).agg(F.count("*").alias("Rows"), F.count(_CORRUPT).alias("Bad_Rows"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """``unionByName`` of many frames as a balanced tree: plan depth grows
    with log(n), not n, when there are hundreds of export folders."""
    frames = list(frames)
    while len(frames) > 1:
        paired = [a.unionByName(b) for a, b in zip(frames[0::2], frames[1::2])]
        frames = paired + ([frames[-1]] if len(frames) % 2 else [])
    return frames[0]


def apply_null_policy(df: DataFrame, null_policy: str = "keep") -> DataFrame:
    """``keep`` leaves null measures in place (the observed behaviour);
    ``zero`` replaces them with 0 (the documented intent)."""
    if null_policy == "keep":
        return df
    if null_policy == "zero":
        present = [m for m in MEASURES + [TOTAL] if m in df.columns]
        return df.na.fill(0, subset=present)
    raise ValueError(f"unknown null_policy {null_policy!r}")


# ---------------------------------------------------------------------------
# Parquet layout
# ---------------------------------------------------------------------------


def write_census(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a census partitioned by year and state.

    The rows are rebalanced by these columns first: few files for a small
    partition, and several tasks for one that holds a third of all rows;
    ``maxRecordsPerFile`` bounds file size.
    """
    _write_partitioned(df.select(*CENSUS_COLUMNS), path, mode)


def _write_partitioned(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    balanced = df.hint("rebalance", PERIOD, STATE)
    balanced.write.mode(mode).option("maxRecordsPerFile", 5_000_000).partitionBy(PERIOD, STATE).parquet(path)


def read_census(spark: SparkSession, path: str, null_policy: str = "keep") -> DataFrame:
    """Read a census written by ``write_census`` with the declared schema
    (partition values are not type-inferred)."""
    df = spark.read.schema(CENSUS_SCHEMA).parquet(path).select(*CENSUS_COLUMNS)
    return apply_null_policy(df, null_policy)


# ---------------------------------------------------------------------------
# Census derived from the driver tables
# ---------------------------------------------------------------------------

# Fixed values of the derivation: order year to academic year (1995 ->
# "2017_2018"), and the management id chosen by ``l_partkey % 6``.
YEAR_OFFSET = 22
MGMT_BY_PARTKEY_MOD6 = {0: 1, 1: 3, 2: 4, 3: 5, 4: 92, 5: 97}
URBAN_SEGMENTS = ["AUTOMOBILE", "MACHINERY"]
ZERO_TOTAL_ORDER_MOD = 97
DERIVATION_VERSION = "2"

_INPUTS = ["lineitem", "orders", "customer", "nation", "region"]


def census_inputs(sf_dir: str) -> list[str]:
    """The driver tables that the census is derived from."""
    return [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in _INPUTS]


def _measure(i: int) -> str:
    """Measure number i of a census row: null on every (11+i)-th order,
    otherwise a deterministic count between 0 and the total."""
    return (
        f"CAST(CASE WHEN l_orderkey % {11 + i} = 0 THEN NULL "
        f"ELSE ({3 + i} * l_partkey + {7 + 2 * i} * l_suppkey + l_linenumber) % ({TOTAL} + 1) END AS INT)"
    )


def _lookup_sql(col: str, mapping: dict) -> str:
    """CASE expression mapping the values of ``col`` through ``mapping``."""

    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nation key, state, district) from nation ⋈ region: the 25 nations of
    the benchmark's fixed geography, broadcast."""
    d = sf_dir.rstrip("/")
    region = storage.read_table(spark, f"{d}/region.parquet").select(
        F.col("r_regionkey"), F.col("r_name").alias(STATE)
    )
    nation = storage.read_table(spark, f"{d}/nation.parquet").select(
        F.col("n_nationkey"), F.col("n_regionkey"), F.col("n_name").alias(DISTRICT)
    )
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    return F.broadcast(geo.select("n_nationkey", STATE, DISTRICT))


def derived_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join behind the derived census, ``lineitem ⋈ orders ⋈ customer ⋈
    nation ⋈ region``: the census keys, the total and the four integer keys
    that the measures are computed from.

    region -> state, nation -> district, customer segment -> location,
    order year -> academic year, line quantity -> number of schools. Every
    order year takes part.
    """
    d = sf_dir.rstrip("/")
    orders = storage.read_table(spark, f"{d}/orders.parquet").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("_y")
    )
    geo = geography(spark, d)
    customer = storage.read_table(spark, f"{d}/customer.parquet").select(
        "c_custkey",
        "c_nationkey",
        F.when(F.col("c_mktsegment").isin(*URBAN_SEGMENTS), F.lit(URBAN))
        .otherwise(F.lit(RURAL))
        .alias(LOCATION),
    )
    cust = customer.join(geo, customer.c_nationkey == geo.n_nationkey).select(
        "c_custkey", STATE, DISTRICT, LOCATION
    )
    # Statistics and AQE choose between a broadcast and a shuffle of customers.
    ordered = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        "o_orderkey", "_y", STATE, DISTRICT, LOCATION
    )
    lines = storage.read_table(spark, f"{d}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    # Two fact tables: a sort-merge join on the order key at every size; AQE
    # splits a skewed order key into several tasks.
    joined = lines.join(ordered.hint("merge"), lines.l_orderkey == ordered.o_orderkey)
    return joined.selectExpr(
        STATE,
        DISTRICT,
        LOCATION,
        f"concat_ws('_', CAST(_y + {YEAR_OFFSET} AS STRING), CAST(_y + {YEAR_OFFSET + 1} AS STRING)) AS {PERIOD}",
        f"CASE WHEN l_orderkey % {ZERO_TOTAL_ORDER_MOD} = 0 THEN 0 ELSE CAST(l_quantity AS INT) END AS {TOTAL}",
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
    )


def with_measures(derived: DataFrame) -> DataFrame:
    """The census columns from ``derived_rows``. Plain expressions: a query
    computes those it names, the rest is pruned with the keys it needs."""
    management = f"CAST({_lookup_sql('CAST(l_partkey % 6 AS INT)', MGMT_BY_PARTKEY_MOD6)} AS INT)"
    return derived.selectExpr(
        STATE,
        DISTRICT,
        LOCATION,
        f"{_lookup_sql(management, MANAGEMENT_NAMES)} AS {MGMT_NAME}",
        f"{management} AS {MGMT_ID}",
        PERIOD,
        TOTAL,
        *[f"{_measure(i)} AS `{m}`" for i, m in enumerate(MEASURES)],
    )


def derived_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The census derived from the driver tables, not materialised."""
    return with_measures(derived_rows(spark, sf_dir))


def census_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived census over its materialised join (written once per session
    under the checkpoint folder, shared storage on a cluster): each query is
    one pruned Parquet scan plus its own measures and aggregation."""
    d = sf_dir.rstrip("/")
    return storage.materialize(
        spark,
        "census",
        census_inputs(d),
        DERIVATION_VERSION,
        build=lambda: derived_rows(spark, d),
        write=_write_partitioned,
        read=lambda path: with_measures(_read_derived(spark, path)),
    )


def _read_derived(spark: SparkSession, path: str) -> DataFrame:
    names = [STATE, DISTRICT, LOCATION, PERIOD]
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    inner = spark.read.parquet(path).schema
    kinds = {f.name: f.dataType for f in inner.fields}
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField(n, kinds[n]) for n in (TOTAL, *keys)])
    return spark.read.schema(schema).parquet(path)
