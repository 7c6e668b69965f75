"""Helpers shared by the operators: tables, scratch storage, text batches."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at a time.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Only a local
    session may do without one: a machine-local folder would lose rows on a
    cluster, so that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="censuskit-llm-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/llm-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later stages, and
    tasks of a lost executor, reread files instead of recomputing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: str) -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def filter_texts(df: DataFrame, text: str, start) -> DataFrame:
    """The rows of ``df``, all columns, whose texts pass. ``start()`` gives each
    task a function from a slice of texts (column ``text``, nulls empty) to a
    boolean for each."""
    at = df.columns.index(text)

    def run(batches):
        decide = start()
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([pa.compute.fill_null(batch.column(at), "")], ["text"])
            done = 0
            for part in slices(texts, "text"):
                yield batch.slice(done, part.num_rows).filter(pa.array(decide(part), pa.bool_()))
                done += part.num_rows

    return df.mapInArrow(run, df.schema)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Pieces of a record batch with about ``limit`` bytes of ``column`` each,
    at least one row; a text longer than that is a piece of its own."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def raw_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, end to end, and
    the offsets of its rows (one more than rows, from 0)."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(array.buffers()[1], dtype=kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    if not len(array) or array.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    data = np.frombuffer(array.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]
