"""Sharding: a Feistel permutation of global row numbers gives each row its shard and its slot.

Row numbers 0..n-1 follow (id, size, crc32). A permutation p of them deals the rows out: shard = p mod shards,
slot = p div shards, so shard sizes differ by one row at most and every slot from 0 on is taken (law `rows`).
The permutation is a Feistel network over Z_a x Z_b with a*b >= n and a*b - n < a. Where it leaves 0..n-1 it is
applied again (cycle walking) until it comes back. Anyone who knows n and the seed computes shard and slot of a row
number, and the row number of a slot (`row_at`), without looking at data.

Nulls: a null id sorts first; a null text has 0 bytes and crc32 0. Repeated rows get places of their own. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, shuffle_partitions, utf8

ROUNDS = 8
#: Walks that are always done; a*b - n < a, so one in sqrt(n) rows needs one, and the rest of walk() is hardly ever run.
SHORT_WALK = 24


def sides(n: int) -> tuple[int, int]:
    """a, b with a*b >= n and a*b - n < a."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def _div(x: Column, m: int) -> Column:
    """Whole-number division; `/` would go through doubles, which are exact to 2**53 only."""
    return F.call_function("div", x.cast("long"), F.lit(m).cast("long"))


def _round(value: Column, key: Column, modulus: int) -> Column:
    return F.pmod(F.xxhash64(value, key), F.lit(modulus))


def feistel(x: Column, a: int, b: int, seed: int, rounds: int = ROUNDS, inverse: bool = False) -> Column:
    """One application of the network, or of its inverse, to x in 0..a*b-1."""
    start = F.struct(_div(x, b).alias("l"), F.pmod(x, F.lit(b)).cast("long").alias("r"))
    sign = -1 if inverse else 1

    def step(acc: Column, i: Column) -> Column:
        key = (i + F.lit(seed)).cast("long")
        left = F.pmod(acc["l"] + sign * _round(acc["r"], key, a), F.lit(a)).cast("long")
        right = F.pmod(acc["r"] + sign * _round(acc["l"], key, b), F.lit(b)).cast("long")
        even = i % 2 == 0
        return F.struct(F.when(even, left).otherwise(acc["l"]).alias("l"), F.when(even, acc["r"]).otherwise(right).alias("r"))

    order = F.array(*[F.lit(i) for i in (reversed(range(rounds)) if inverse else range(rounds))])
    return F.aggregate(order, start, step, lambda acc: acc["l"] * F.lit(b) + acc["r"])


def walk(x: Column, n: int, seed: int, inverse: bool = False) -> Column:
    """The permutation of 0..n-1, or its inverse. Outside lie a*b - n numbers, so so many walks always suffice."""
    a, b = sides(n)
    once = lambda v: feistel(v, a, b, seed, inverse=inverse)
    walks = lambda v, m: F.aggregate(F.sequence(F.lit(1), F.lit(m)), v, lambda acc, _: F.when(acc < n, acc).otherwise(once(acc)))
    first, spare = once(x), a * b - n
    if spare == 0:
        return first
    out = F.when(first < n, first).otherwise(walks(first, min(spare, SHORT_WALK)))
    return out if spare <= SHORT_WALK else F.when(out < n, out).otherwise(walks(out, spare))


def place(row: Column, n: int, shards: int, seed: int = 0) -> tuple[Column, Column]:
    """Shard and slot of a row number."""
    p = walk(row, n, seed)
    return F.pmod(p, F.lit(shards)).cast("int"), _div(p, shards)


def row_at(shard: Column, slot: Column, n: int, shards: int, seed: int = 0) -> Column:
    """Row number that lies in a slot of a shard."""
    return walk(slot.cast("long") * F.lit(shards) + shard.cast("long"), n, seed, inverse=True)


def number_rows(df: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """Adds `row`, the global row number in this order, and gives the number of rows.

    A range partitioning orders the rows over all tasks; each task numbers its own, and one row per task carries the
    offsets. The numbered rows are written before the offsets are counted, so both speak of the same partitioning.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "rows")
    keys = [F.col(c).asc_nulls_first() for c in order]
    ranged = df.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
    held = scratch.table(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    held = held.withColumn("_part", F.shiftright("_at", 33))
    counts = held.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), "_n")
    offsets = scratch.table(offsets, "offsets")  # one row for each task of the range partitioning
    total = offsets.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    rows = held.join(F.broadcast(offsets.drop("_n")), "_part").withColumn("row", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    return rows.drop("_part", "_at", "_before"), int(total)


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = 20260101, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size (UTF-8 bytes plus 1), text_crc32, law, shard, slot, grown_shard (null under this law), row."""
    slim = docs.select(
        F.col(id_col).alias(id_col),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(utf8(F.col(text_col))).cast("long").alias("text_crc32"),
    )
    rows, n = number_rows(slim, id_col, "size", "text_crc32")
    shard, slot = place(F.col("row"), max(n, 1), shards, seed)
    return rows.select(id_col, "size", "text_crc32", F.lit("rows").alias("law"), shard.alias("shard"), slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row")
