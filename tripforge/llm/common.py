"""Helpers shared by the operators of this subpackage.

Words are maximal runs of characters other than ASCII white space
(``[^\\x20\\x09-\\x0D]+``) everywhere unless a module says otherwise.
"""

from __future__ import annotations

import ctypes
import os
import uuid
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.session import scratch_path

ASCII_SPACE = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def text_of(col: str = "text") -> Column:
    """The text of a document, null read as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array (splitting at one plain character is
    several times faster than at a pattern)."""
    for c in ASCII_SPACE[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read again.

    Cuts the lineage so that later jobs read files rather than recompute,
    also after executors were lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: int = 1 << 22):
    """What runs inside hands rows to Python workers by ``size`` bytes, not by Spark's
    64 MB: a worker, and the JVM that writes to it, hold several copies of a batch."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def give_back() -> None:
    """Memory that was freed goes back to the system: Spark keeps Python workers for
    later tasks, and Arrow and the C library keep what the largest batch took."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):    # glibc's
        libc.malloc_trim(0)


def keys() -> Column:
    """A unique number for each row.  It may differ when the rows are read
    again, so it is written (``staged``) before it is used."""
    return F.monotonically_increasing_id()


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row``: a unique number for each row, the same whenever the
    rows are read again: its file (numbered by a hash of the path, of which there
    are as many as files) and its place in it.  Rows that are not read straight
    from Parquet are written first."""
    spark = docs.sparkSession
    try:
        m = docs.metadataColumn("_metadata")
        placed = docs.withColumn("__file", F.xxhash64(m["file_path"])).withColumn("__at", m["row_index"])
    except AnalysisException:
        return numbered(staged(docs, "rows"))
    files = sorted(r[0] for r in placed.select("__file").distinct().collect())
    numbers = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "__file long, __no long")
    return (placed.join(F.broadcast(numbers), "__file")
            .withColumn("__row", F.shiftleft("__no", 40) + F.col("__at")).drop("__file", "__no", "__at"))


def bits_of(rows: DataFrame) -> DataFrame:
    """(__bucket, __bits): the set of ``__row`` numbers as bitmaps, a bit for each row of a file."""
    at = F.col("__row") + 1
    return rows.groupBy(F.bitmap_bucket_number(at).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("__bits"))


def marked(docs: DataFrame, bits: DataFrame, name: str) -> DataFrame:
    """``docs`` (numbered) with the boolean column ``name``: is the row in the set?

    What is joined is a bit for each row, not a key, so that texts stay where they
    are for sixty times as many rows before Spark prefers to shuffle."""
    at = F.bitmap_bit_position(F.col("__row") + 1)
    byte = F.conv(F.hex(F.substring("__bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return (docs.withColumn("__bucket", F.bitmap_bucket_number(F.col("__row") + 1)).join(bits, "__bucket", "left")
            .withColumn(name, hit).drop("__bucket", "__bits"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """As many partitions as the session deals shuffles to: by ``keys``, or
    evenly without any (a list of files, each of which is work for a task)."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), *keys)


# -- files that tasks write and read by themselves (archives, token files) --------

def open_fs(uri: str):
    """(pyarrow file system, path on it) for a folder or file of the shared store."""
    from pyarrow import fs

    u = urlparse(uri)
    if u.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(u.path)
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, chunks) -> int:
    """Write a file whole or not at all: a retried or doubled task attempt
    writes its own temporary name, and the rename publishes one of them."""
    f, path = open_fs(uri)
    f.create_dir(os.path.dirname(path), recursive=True)
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    size = 0
    with f.open_output_stream(tmp) as out:
        for c in chunks:
            out.write(c)
            size += len(c)
    f.move(tmp, path)
    return size


def fresh_folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)
