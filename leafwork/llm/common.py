"""What the training-data operators share: tables, the shared folder, and word splitting."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"
_BLANK_CLASS = r"[\x20\x09-\x0D]"
#: Bytes of a batch of texts that executors and their Python workers hold: each in several forms at once.
BATCH_BYTES = 4 << 20
_BYTES_OF_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in a local session a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='leafwork-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/leafwork/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: the lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more."""
    spark = tables[0].sparkSession
    for t in tables:
        where = spark._jvm.org.apache.hadoop.fs.Path(t.stored_at)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs within hands Python workers batches of about BATCH_BYTES or of one row, not of 10,000 rows of any size; then the session is as before."""
    before = spark.conf.get(_BYTES_OF_BATCH, None)
    spark.conf.set(_BYTES_OF_BATCH, BATCH_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BYTES_OF_BATCH)
        else:
            spark.conf.set(_BYTES_OF_BATCH, before)


def give_back() -> None:
    """Return what this process has freed to the system: allocators keep it, and Python workers stay between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def lean(make: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], each: bool = False) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """`make`, a function for mapInPandas or mapInArrow, that gives freed memory back at its end and, with `each`, after each batch it reads."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch
            del batch
            give_back()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from make(read(batches) if each else batches)
        give_back()

    return run


def rows_whole(docs: DataFrame, *also: Column) -> DataFrame:
    """_row, a struct of all columns of `docs`, and the columns `also`: whatever `docs` calls its columns, nothing clashes."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *also)


def of_row(columns: list[str]) -> list[Column]:
    return [F.col("_row").getField(c).alias(c) for c in columns]


def words(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text as array<string>; null or blank text: empty."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _BLANK_CLASS + "+", -1))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")
