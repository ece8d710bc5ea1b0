"""What the operators of this subpackage share: reading, durable cuts and Arrow text buffers."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one call of a numpy kernel takes; a longer document is taken alone.
KERNEL_BYTES = 1 << 20
#: Rows and bytes of a batch that a kernel takes.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20
#: Keys of more than one in so many rows are met in a broadcast, which has fewer rows than that.
HOT = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder: the one that spark.checkpoint.dir names, or a temporary one on a single machine."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def forget(spark: SparkSession, path: str) -> None:
    """Deletes a folder in the store that holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def durable(df: DataFrame) -> DataFrame:
    """df, computed once and written to the shared checkpoint folder.

    The folder is the one the cluster names in spark.checkpoint.dir; only where it is unset
    (tests, a single machine) a temporary one is set. The executors' disks hold a copy just
    until the checkpoint is written, so that the plan does not run twice.
    """
    checkpoint_folder(df.sparkSession)
    kept = df.persist(StorageLevel.DISK_ONLY)
    try:
        return kept.checkpoint(eager=True)
    finally:
        kept.unpersist()


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most BATCH_ROWS rows and BATCH_BYTES, or of one longer row; nothing is copied."""
    for b in batches:
        step = max(1, min(BATCH_ROWS, b.num_rows * BATCH_BYTES // max(b.nbytes, 1)))
        for k in range(0, b.num_rows, step):
            yield b.slice(k, step)


def in_batches(df: DataFrame, kernel, schema) -> DataFrame:
    """df put through kernel(iterator of record batches), which has some megabytes at a time.

    A batch waits as a whole in the JVM and in the worker. Where the session has Spark's own bound
    of 10,000 rows it gets BATCH_ROWS, which takes hundreds of MB off an executor's peak; any other stays.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":
        conf.set(name, str(BATCH_ROWS))
    return df.mapInArrow(lambda batches: kernel(sliced(batches)), schema)


def meet(rows: DataFrame, firsts: DataFrame, keys: list[str], count: str, hot: int = HOT) -> DataFrame:
    """rows left-joined on keys with firsts, which has one row for each key and how many rows share it.

    Keys that hold more than one in hot of the counted rows are fewer than hot, whatever the size of
    the tables: these are broadcast, and no other key is large enough to make one task long.
    """
    total = firsts.agg(F.sum(count)).first()[0] or 0
    many = F.col(count) * hot > total
    names = [f"_k{k}" for k in range(len(keys))]
    first = firsts.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), *(c for c in firsts.columns if c not in keys))
    on = lambda df: [df[k] == F.col(n) for k, n in zip(keys, names, strict=True)]
    frequent = first.where(many)
    near = rows.join(F.broadcast(frequent), on(rows), "inner").drop(*names)
    few = rows.join(F.broadcast(frequent.select(*names)), on(rows), "left_anti")
    return near.unionByName(few.join(first.where(~many), on(few), "left").drop(*names))


def numbered(docs: DataFrame) -> DataFrame:
    """docs with its columns named c0, c1, ..., so that none clashes with an operator's own."""
    return docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))


def number(docs: DataFrame, column: str) -> str:
    """A column's name in numbered(docs)."""
    return f"c{docs.columns.index(column)}"


def utf8(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column and the n+1 offsets of the texts; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    col = col.cast(pa.large_binary())
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if col.null_count:
        size = np.diff(offsets)
        null = np.asarray(col.is_null())
        if size[null].any():  # bytes under a null are not text
            return utf8(col.fill_null(b""))
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = KERNEL_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of at most limit bytes, or of one longer document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
