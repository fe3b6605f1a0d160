"""Line dedup: lines that stand on many sites are boilerplate and go.

A line is what lies between line feeds, without blanks, tabs and carriage returns at its ends and with A-Z lower-cased; lines
without a letter or digit stay and count nowhere. A line's spread is its number of distinct sites. Per line, HyperLogLog
sketches of the sites are built in each task and merged by aggregation. A sketch far above or below the threshold decides at
once; the lines whose estimate lies within `MARGIN` (over ten standard errors of the sketch) get an exact distinct count. Lines
spread over at least `min_sites` sites are removed from every document. Unless it is given, `min_sites` is half of the corpus's
sites, `MOST_SITES` at most and three at least: on a small corpus boilerplate is what half of it shares, a line on two sites may be a
quotation, and on a large corpus ten unrelated sites don't write the same line.

Lines are known by a 128-bit pair of hashes. The removed lines are written; Spark broadcasts them if their files are small
and otherwise joins by shuffle, where adaptive execution splits a hot line's rows.

Nulls: a null text has no lines and stays null; a null site is no site. A document whose lines all go keeps an empty text.
Repeated rows are treated alike. An empty table gives an empty result. Columns of any name come through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, ascii_lower, row_key

MOST_SITES = 10
#: Sketches of 2**12 registers: a standard error of 1.6 %.
LOG_REGISTERS, MARGIN = 12, 0.25


def with_key(lines: DataFrame, line: Column) -> DataFrame:
    """Adds key; lines without a letter or digit go. Each step stands in a projection of its own, so that it is evaluated once."""
    lines = lines.withColumn("_trim", F.trim(line, F.lit(" \t\r"))).withColumn("_norm", ascii_lower(F.col("_trim"))).where(F.col("_norm").rlike(r"[\p{L}\p{N}]"))
    return lines.withColumn("key", F.struct(F.xxhash64("_norm").alias("a"), F.xxhash64(F.lit(1), "_norm", F.length("_norm")).alias("b"))).drop("_trim", "_norm")


def threshold(docs: DataFrame, site_col: str) -> int:
    """Half of the sites, MOST_SITES at most, three at least."""
    sites = docs.where(F.col(site_col).isNotNull()).groupBy(site_col).agg(F.count("*").alias("n")).limit(2 * MOST_SITES).count()  # more don't matter
    return min(MOST_SITES, max(3, -(-sites // 2)))


def spread_lines(docs: DataFrame, min_sites: int, text_col: str, site_col: str, scratch: Scratch) -> DataFrame:
    """key: the lines that stand on at least so many sites."""
    lines = docs.where(F.col(site_col).isNotNull()).select(F.explode(F.split(F.col(text_col), "\n")).alias("line"), F.col(site_col).cast("string").alias("site"))
    lines = with_key(lines, F.col("line")).select("key", "site")
    # a line that stands in fewer places than sites are needed is decided by its count, and needs no sketch
    often = scratch.table(lines.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select("key"), "often")
    sketched = lines.join(often, "key", "left_semi").groupBy("key").agg(F.hll_sketch_agg("site", LOG_REGISTERS).alias("sketch"))
    spread = scratch.table(sketched.select("key", F.hll_sketch_estimate("sketch").alias("sites")), "spread")
    band = F.lit(MARGIN * min_sites + 1)
    near = scratch.table(spread.where(F.abs(F.col("sites") - min_sites) <= band).select("key"), "near")
    exact = lines.join(near, "key", "left_semi").groupBy("key", "site").agg(F.count("*").alias("n")).groupBy("key").agg(F.count("*").alias("sites"))
    sure = spread.where(F.col("sites") - min_sites > band).select("key")
    return scratch.table(sure.unionByName(exact.where(F.col("sites") >= min_sites).select("key")), "boilerplate")


def _cleaned(docs: DataFrame, min_sites: int | None, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """row (all columns), text without boilerplate lines, n_lines, n_removed.

    Removed lines come back to their document as "position:line"; taking those strings out of the document's own is linear.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    bad = spread_lines(docs, min_sites or threshold(docs, site_col), text_col, site_col, scratch)
    own, mark = row_key(id_col, text_col)
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), own, mark)
    placed = F.transform(F.split("text", "\n"), lambda line, i: F.concat(i.cast("string"), F.lit(":"), line))
    line_of = lambda x: F.substr(x, F.locate(":", x) + 1)
    lines = docs.select(own.alias("i"), mark.alias("t"), F.col(text_col).alias("text")).select("i", "t", F.explode(placed).alias("line"))
    hit = with_key(lines, line_of(F.col("line"))).join(bad, "key", "left_semi")
    removed = scratch.table(hit.groupBy("i", "t").agg(F.collect_set("line").alias("gone")), "removed")
    joined = rows.join(removed, F.col("row_id").eqNullSafe(F.col("i")) & (F.col("row_text") == F.col("t")), "left")
    kept = F.array_join(F.transform(F.array_except(placed, F.col("gone")), line_of), "\n")
    counts = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))
    return joined.select(
        "row", "row_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"), counts.cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
    )


def clean_lines(docs: DataFrame, min_sites: int | None = None, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", length_col: str | None = None) -> DataFrame:
    """The documents with their columns, the text without boilerplate lines; length_col, if there is one, follows a changed text."""
    out = _cleaned(docs, min_sites, id_col, text_col, site_col)

    def column(name: str) -> Column:
        own = F.col("row").getField(name)
        if name == text_col:
            return F.col("text").alias(name)
        if name == length_col:
            return F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema[name].dataType)).otherwise(own).alias(name)
        return own.alias(name)

    return out.select(*map(column, docs.columns))


def line_report(docs: DataFrame, min_sites: int | None = None, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """Per document: id, n_lines, n_removed, text_sha256 of what is left (null stays null)."""
    out = _cleaned(docs, min_sites, id_col, text_col, site_col)
    return out.select(F.col("row_id").alias(id_col), "n_lines", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))
