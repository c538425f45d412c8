"""What the operators share: shared-folder tables, Arrow access to text, and the clean word split."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII capitals and their small letters, for `translate`.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the cluster's own setting; on a local master without one, a new folder."""
    setting = spark.conf.get("spark.checkpoint.dir", None)
    if setting:
        return setting
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = f"file://{tempfile.mkdtemp(prefix='millrace-')}"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def carried(docs: DataFrame, less: str | None = None, **more: Column) -> DataFrame:
    """The row (but for the column `less`) as one struct `row`, so that no column's name can clash, and more columns beside it."""
    fields = [F.col(f"`{c}`") for c in docs.columns if c != less] or [F.lit(0).alias("none")]
    return docs.select(F.struct(*fields).alias("row"), *[c.alias(n) for n, c in more.items()])


def unpacked(columns: list[str], **own: Column) -> list[Column]:
    """What to select from a carried table: the row's columns and an operator's own, which replace those of the same name in place."""
    return [*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns], *[c.alias(n) for n, c in own.items() if n not in columns]]


def byte_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def give_back() -> None:
    """Return freed memory to the system: Python workers stay alive between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def crc_mod(c: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(n))
