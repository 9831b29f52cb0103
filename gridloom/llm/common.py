"""What the operators share: the shared folder, written tables, byte blobs and
the word rules of the contracts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (tests, a single machine) is a temporary folder made and set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="gridloom-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, and a lost
    executor costs a reread instead of a recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text: str) -> int:
    """About how many bytes of text ``df`` has: twice the compressed size that
    the optimizer knows of a scan, which costs no job, or else a sum. It only
    sizes partitions and tables."""
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if known < 1 << 60:
        return 2 * known
    return df.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0


def trimmed(batches):
    """Passes batches on; at the end of the task, memory that the reused worker
    no longer needs goes back to the system."""
    import ctypes
    import gc

    import pyarrow as pa

    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def texts_of(batch, column: int = 0, rows: int = 512):
    """The texts of a batch, decoded a few rows at a time."""
    for k in range(0, batch.num_rows, rows):
        yield from batch.column(column).slice(k, rows).to_pylist()


def sliced(batches, rows: int = 512):
    """The batches in small pieces, so that what a step makes of one is small."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def beside(docs: DataFrame, text: str, keep: list[str]) -> tuple[DataFrame, int]:
    """The columns ``keep`` and the place of the text, which is sent once: it
    is added behind them only where it is not among them."""
    if text in keep and docs.schema[text].dataType.simpleString() == "string":
        return docs.select(*keep), keep.index(text)
    return docs.select(*keep, F.col(text).cast("string").alias("__text")), len(keep)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_bucket(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``: the contracts' folds.
    A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus
