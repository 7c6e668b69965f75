"""Shared-storage helpers: where materialised tables go and whether they exist.

Materialised intermediates live under the folder the cluster names in
``spark.checkpoint.dir`` (a shared file system on a cluster). Only when that
setting is absent (local tests) do we pick a scratch folder ourselves.
"""

from __future__ import annotations

import hashlib
import tempfile
import threading
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # a Spark Connect client has no SparkContext
        return None


def session_key(spark: SparkSession):
    """Identity of the running application, for per-session memos."""
    sc = _context(spark)
    return sc.applicationId if sc is not None else id(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.
    Only a local session may do without one; on a cluster each executor would
    write to a disk of its own, so that is an error."""
    sc = _context(spark)
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            master = sc.master if sc is not None else ""
            if master != "local" and not master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="censuskit-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    return root


def _listing(spark: SparkSession, *paths: str, recursive: bool = False) -> DataFrame:
    """File metadata (path, length, modification time) through the public
    ``binaryFile`` source; file contents are not read unless selected."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(list(paths)).select("path", "length", "modificationTime")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists (resolving the source lists it; no job runs)."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException:
        return False


def content_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Digest of the length and modification time of every file under the
    inputs (one listing job that returns one row)."""
    files = _listing(spark, *paths, recursive=True)
    row = files.agg(F.count("*"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return hashlib.sha1(f"{'|'.join(paths)}:{row[0]}:{row[1]}".encode()).hexdigest()


def cut(spark_df: DataFrame, name: str) -> DataFrame:
    """A DataFrame written to the checkpoint folder and read back: what follows
    rereads files, in this run and after the loss of an executor."""
    spark = spark_df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/censuskit/{name}-{uuid.uuid4().hex}"
    spark_df.write.parquet(path)
    return spark.read.schema(spark_df.schema).parquet(path)


_TABLES: dict[tuple[int, str], object] = {}


def read_table(spark: SparkSession, path: str):
    """``spark.read.parquet(path)`` memoised per session, for read-only input
    tables: the file listing and footer (schema) reads happen once, not in
    every query that is built on the table."""
    key = (session_key(spark), path)
    df = _TABLES.get(key)
    if df is None:
        df = spark.read.parquet(path)
        _TABLES[key] = df
    return df


_MATERIALISED: dict[tuple, tuple[str, object]] = {}
_MATERIALISE_LOCK = threading.Lock()


def materialize(spark: SparkSession, name: str, inputs: list[str], version: str, build, write, read):
    """A derived table written once per session under the checkpoint folder
    and read back (lineage cut: a lost executor re-reads files instead of
    recomputing the derivation).

    Inputs are taken as read-only while the application runs: within it a
    table is built once per input path, and its folder belongs to the
    application alone. Without a SparkContext the folder may be shared, and its
    name carries the inputs' lengths and modification times.
    ``build()`` returns the DataFrame, ``write(df, path)`` stores it,
    ``read(path)`` loads it; the loaded DataFrame is reused for the session.
    Concurrent callers in one driver build it once.
    """
    key = (session_key(spark), name, tuple(inputs))
    hit = _MATERIALISED.get(key)
    if hit is not None:  # written by this application into its own folder
        return hit[1]
    with _MATERIALISE_LOCK:
        hit = _MATERIALISED.get(key)
        if hit is not None:
            return hit[1]
        if _context(spark) is not None:
            # The checkpoint root is application-specific (Spark adds a UUID
            # folder), and inputs are read-only for the application's life.
            finger = "|".join(inputs)
        else:
            # Shared root (no SparkContext): key on the inputs' content.
            finger = content_fingerprint(spark, inputs)
        digest = hashlib.sha1(f"{version}|{name}|{finger}".encode()).hexdigest()[:16]
        path = f"{checkpoint_root(spark).rstrip('/')}/censuskit/{name}-{digest}"
        if not path_exists(spark, f"{path}/_SUCCESS"):
            write(build(), path)
        df = read(path)
        _MATERIALISED[key] = (path, df)
        return df
