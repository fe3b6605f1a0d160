"""What the operators share: the shared folder, written intermediate tables, words and shingles."""

from __future__ import annotations

import atexit
import re
import sys
import unicodedata
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: all of ASCII but digits and lower-case letters (after ascii_lower).
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOCAL_SHARED = "/tmp/checkpoints/tessera"
#: Rows of a narrow table (some 50 bytes each) that may be broadcast.
BROADCAST_ROWS = 200_000
#: Bytes of text that a Python worker takes at a time; a longer text is taken alone.
SLICE_BYTES = 1 << 20


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, a local one, on a local master only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return LOCAL_SHARED


class Scratch:
    """Written tables in the shared folder. Executors may be lost: a written table needs no lineage.

    Tables go at drop() or only(), at the end of a `temporary` block in which the object was made, or when the driver's Python
    ends (results are lazy and may still read them until then).
    """

    live: list["Scratch"] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._made, self.last = 0, ""
        self.paths: list[tuple[str, str]] = []
        Scratch.live.append(self)
        atexit.register(self.drop)

    def path(self, name: str) -> str:
        self._made += 1
        self.last = f"{self.root}/{self._made:03d}-{name}"
        self.paths.append((name, self.last))
        return self.last

    def table(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        path = self.path(name)
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        schema = df.schema
        return self.spark.read.schema(schema).parquet(path)

    def only(self, *names: str) -> None:
        """Drops all tables but those of these names, which a result still reads."""
        for name, path in self.paths:
            if name not in names:
                self.drop(path)
        self.paths = [x for x in self.paths if x[0] in names]

    def drop(self, path: str | None = None) -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path or self.root)
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has ended; the folder is the cluster's to clean
            pass


@contextmanager
def temporary() -> Iterator[None]:
    """At its end, all tables of Scratch objects made inside are dropped; what is needed on must have been written elsewhere."""
    before = len(Scratch.live)
    try:
        yield
    finally:
        for scratch in Scratch.live[before:]:
            scratch.drop()
        del Scratch.live[before:]


def broadcast_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of narrow rows with a broadcast hint if it has at most so many; it is counted first. Larger ones are joined by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. Text of ASCII alone takes lower(), which goes by bytes there; translate() goes by characters."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Array of the words of a text: runs of digits, ASCII letters (lower-cased) and everything beyond ASCII; null has none."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.filter(parts, lambda w: w != "")


def utf8(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def slices(batches: Iterator, column: int, limit: int = SLICE_BYTES) -> Iterator:
    """Parts of Arrow batches whose texts in a column come to at most so many bytes (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


@lru_cache
def letter_runs() -> re.Pattern:
    """Runs of letters, which are what Unicode calls so (categories L*), on the JVM as in Python."""
    ranges: list[list[int]] = []
    for code in range(sys.maxunicode + 1):
        if unicodedata.category(chr(code))[0] == "L":
            if ranges and code == ranges[-1][1] + 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return re.compile("[" + "".join(f"\\U{x:08x}-\\U{y:08x}" for x, y in ranges) + "]+")


def row_key(id_col: str, text_col: str) -> list[Column]:
    """What tells rows apart: the id (which may be null or shared) and a hash of the text. Rows alike in both are judged alike."""
    return [F.col(id_col).alias("row_id"), F.xxhash64(F.col(text_col)).alias("row_text")]


def without(docs: DataFrame, rejected: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents whose (row_id, row_text) isn't in `rejected`; a null id equals a null id. Columns of any name come through."""
    own, mark = row_key(id_col, text_col)
    left = docs.select(F.struct("*").alias("row"), own.alias("left_id"), mark.alias("left_text"))
    same = F.col("left_id").eqNullSafe(F.col("row_id")) & (F.col("left_text") == F.col("row_text"))
    return left.join(rejected.select("row_id", "row_text"), same, "left_anti").select("row.*")


def likely(docs: DataFrame, key: list[str], rows: DataFrame, row_key_names: list[str], most_bits: int = 1 << 28) -> DataFrame:
    """The rows of docs whose key stands in the written table `rows`, and a few others: what is left for a join to decide.

    A bit for each hash of a key (32 bits a row, at most `most_bits` in all, up to 32 MB) is broadcast, so that docs with long texts
    need not be shuffled when nearly all of them drop out. Nulls count as a value.
    """
    bits = 1 << 20
    while bits < min(most_bits, 32 * rows.count()):
        bits *= 2
    place = lambda names: F.pmod(F.xxhash64(*[F.col(c) for c in names]), F.lit(bits))
    page = F.shiftright("place", 15)
    spots = rows.select(place(row_key_names).alias("place")).select(page.alias("page"), F.col("place").bitwiseAND(32767).cast("int").alias("spot"))
    pages = spots.groupBy("page").agg(F.bitmap_construct_agg("spot").alias("marks"))
    out = docs.withColumn("place", place(key)).withColumn("page", page).join(F.broadcast(pages), "page")
    spot = F.col("place").bitwiseAND(32767).cast("int")
    byte = F.conv(F.hex(F.substring("marks", F.shiftright(spot, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return out.where(F.getbit(byte, spot.bitwiseAND(7)) == 1).drop("place", "page", "marks")
