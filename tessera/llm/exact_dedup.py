"""Exact dedup: distributed MSD radix partitioning of documents by successive bytes.

All documents start in one group. Each round takes the next bytes of a text as its digit (256 bytes, then 64 KiB, then
1 MiB at a time) and splits every group by it. A group is done when it has one row left or when its digit came short,
which means that its texts have ended and are equal byte by byte; no digest decides. Only open groups go on, with what is
left of their texts. A group gets a number when its row is written, so neither ids nor hashes name it, and null or shared ids
merge nothing.

Group sizes come from aggregation, which combines before it shuffles; groups of one never leave it. The table of groups is
written, then joined to the rows: broadcast if its files are small enough for Spark's own threshold, else a sort-merge
join, whose hot groups adaptive execution splits over several tasks.

Nulls: a null text counts as empty; a null id is smaller than any other. Rows that share an id are separate rows; where several
rows of a group have its largest id (or no row has one), a single one of them stays. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, ascii_lower

#: Bytes of the digits of the first rounds; the last holds for all later ones.
WIDTHS = (256, 1 << 16, 1 << 20)


def _digit(rest: Column, width: int) -> Column:
    return F.substring(rest, 1, width)


def _split(scratch: Scratch, rows: DataFrame, width: int, heads: DataFrame) -> DataFrame:
    """Rows with the number and size of their new group, and what is left of the text where the group stays open."""
    groups = heads.groupBy("grp", "digit").agg(F.max("id").alias("keep"), F.count("*").alias("n")).where("n > 1")
    groups = scratch.table(groups.withColumn("number", F.monotonically_increasing_id()), "groups")
    joined = rows.withColumn("digit", _digit(F.col("rest"), width)).join(groups, ["grp", "digit"], "left")
    is_open = (F.col("n") > 1) & (F.length("digit") == width)
    return scratch.table(
        joined.select(
            "id", "sha", F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep"), F.coalesce("n", F.lit(1)).cast("long").alias("n"), "number",
            F.when(is_open, F.substring(F.col("rest"), width + 1, 2147483647)).alias("rest"), F.coalesce(is_open, F.lit(False)).cast("int").alias("open"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "split", partition_by="open",
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """One row per document: id, keep_id (largest id of its group), group_size, kept, text_sha256 of the normalised text.

    Texts equal but for A-Z against a-z are equal. One row of each group is kept.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    text = F.coalesce(F.col(text_col), F.lit(""))
    full = F.encode(ascii_lower(text), "UTF-8")
    rows = docs.select(F.col(id_col).alias("id"), F.lit(0).cast("long").alias("grp"), F.unhex(F.sha2(full, 256)).alias("sha"), full.alias("rest"))
    first = F.encode(ascii_lower(F.substring(text, 1, widths[0])), "UTF-8")  # as many characters have at least as many bytes
    heads = docs.select(F.lit(0).cast("long").alias("grp"), F.col(id_col).alias("id"), _digit(first, widths[0]).alias("digit"))
    done: DataFrame | None = None
    for level in range(1 << 30):
        width = widths[min(level, len(widths) - 1)]
        parts = _split(scratch, rows, width, heads)
        closed = parts.where("open = 0").select("id", "sha", "keep", "n", "number", "row", F.lit(level).alias("level"))
        done = closed if done is None else done.unionByName(closed)
        rows = parts.where("open = 1").select("id", F.col("number").alias("grp"), "sha", "rest")
        if rows.isEmpty():
            break
        heads = rows.select("grp", "id", _digit(F.col("rest"), width=widths[min(level + 1, len(widths) - 1)]).alias("digit"))
    largest = F.col("id").eqNullSafe(F.col("keep"))
    # groups in which several rows have the largest id: the one with the last row number stays
    ties = done.where("n > 1").where(largest).groupBy("level", "number").agg(F.count("*").alias("m"), F.max("row").alias("last")).where("m > 1")
    ties = scratch.table(ties.select("level", "number", "last"), "ties")
    done = done.join(ties, ["level", "number"], "left")
    kept = largest & (F.col("last").isNull() | (F.col("row") == F.col("last")))
    return done.select(F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, of equal texts only the row with the largest id; of rows alike in id and text one stays."""
    scratch = Scratch(docs.sparkSession, "copies")
    sha = F.sha2(F.encode(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), "UTF-8"), 256)
    keep = scratch.table(exact_groups(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("keep"), F.col("text_sha256").alias("kept_sha")), "keep")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), sha.alias("sha"))
    same = F.col("id").eqNullSafe(F.col("keep")) & (F.col("sha") == F.col("kept_sha"))
    return rows.join(keep, same, "left_semi").dropDuplicates(["id", "sha"]).select("row.*")
