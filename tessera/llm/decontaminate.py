"""Benchmark decontamination: a prefix-filtered set join of document words against item-sized windows.

A window is `n` consecutive words of an item, or the whole item where it has fewer words. Windows are cut into shingles of
`s` words, ordered by rarity: their number of occurrences over all documents. A document that contains a window contains all
its shingles, so for full containment the necessary prefix is one shingle, the rarest. Document positions join on that
shingle alone; positional and length bounds (the window must begin and end inside the document) are applied, and then the
words themselves are compared, so hashes decide nothing. A window whose rarest shingle never occurs joins nothing.

Documents are read twice, once to count and once to join; only positions that match leave a task. The tables of shingles and
windows are written and measured first. Up to `BROADCAST_BYTES` and `BROADCAST_ROWS` they are broadcast; beyond that,
positions (without texts) are shuffled on shingle hashes, and candidates are joined back to their documents for comparison.

Only DataFrame functions run. Nulls: a null text has no words; an item without words has no window; a null item id counts as
the text ''. Rows with equal id and text get equal results. Empty tables: no documents, no rows; no items, nothing is hit.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import NOT_WORD, Scratch, ascii_lower, row_key, without

WORDS_PER_WINDOW, WORDS_PER_SHINGLE = 10, 5
BROADCAST_BYTES, BROADCAST_ROWS = 32 << 20, 200_000


def _words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def _key(tokens: Column, at: Column, size: int) -> Column:
    """Hash of `size` words from position `at` (from 0) on."""
    return F.xxhash64(*[F.get(tokens, at + j) for j in range(size)])


def item_windows(items: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """item, len, win (the words as an array): each window of each item once."""
    w = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), _words(F.col(text_col)).alias("w")).withColumn("m", F.size("w"))
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.col("m") - n, F.lit(0))))
    return w.where("m > 0").select("item", "w", F.least(F.col("m"), F.lit(n)).alias("len"), at.alias("at")).select("item", "len", F.slice("w", F.col("at") + 1, F.col("len")).alias("win")).distinct()


def _positions(docs: DataFrame, size: int) -> DataFrame:
    """One row for each run of `size` words: pos, key, with the document's id, th, w and n_words."""
    placed = docs.where(F.col("n_words") >= size).withColumn("pos", F.explode(F.sequence(F.lit(0), F.col("n_words") - size)))
    return placed.withColumn("key", _key(F.col("w"), F.col("pos"), size))


def _small(df: DataFrame) -> bool:
    rows, width = df.select(F.count("*"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and width <= BROADCAST_BYTES


def occurrences(docs: DataFrame, windows: DataFrame, s: int, scratch: Scratch) -> DataFrame:
    """id, th, win, pos, len: every place where a window stands in a document. docs: id, th, w, n_words."""
    distinct = windows.select("len", "win").distinct().withColumn("size", F.least("len", F.lit(s)))
    runs = distinct.withColumn("off", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("size"))))
    sizes = [r[0] for r in distinct.select("size").distinct().collect()]  # at most s numbers
    found: DataFrame | None = None
    for size in sorted(sizes):
        shingles = scratch.table(runs.where(F.col("size") == size).withColumn("key", _key(F.col("win"), F.col("off"), size)).drop("size"), "shingles")
        keys = scratch.table(shingles.select("key").distinct(), "keys")
        small = _small(shingles)
        hint = F.broadcast if small else (lambda x: x)
        counts = scratch.table(_positions(docs, size).select("key").join(hint(keys), "key", "left_semi").groupBy("key").agg(F.count("*").alias("freq")), "counts")
        by_rarity = Window.partitionBy("win").orderBy("freq", "off")
        prefix = shingles.join(counts, "key", "left").fillna(0, ["freq"]).withColumn("rank", F.row_number().over(by_rarity)).where("rank = 1 AND freq > 0")
        prefix = scratch.table(prefix.select("key", "off", "len", "win"), "prefix")
        start = F.col("pos") - F.col("off")
        bounds = (start >= 0) & (start + F.col("len") <= F.col("n_words"))
        same = F.slice("w", start + 1, F.col("len")) == F.col("win")
        if small:
            hits = _positions(docs, size).join(F.broadcast(prefix), "key").where(bounds).where(same)
        else:
            candidates = _positions(docs, size).select("id", "th", "n_words", "pos", "key").join(prefix, "key").where(bounds).drop("n_words")
            again = docs.select(F.col("id").alias("id2"), F.col("th").alias("th2"), "w").dropDuplicates(["id2", "th2"])
            hits = candidates.join(again, F.col("id").eqNullSafe(F.col("id2")) & F.col("th").eqNullSafe(F.col("th2"))).where(same)
        hits = hits.select("id", "th", "win", start.alias("pos"), "len")
        found = hits if found is None else found.unionByName(hits)
    return found


def measure(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = WORDS_PER_WINDOW, s: int = WORDS_PER_SHINGLE) -> DataFrame:
    """Per document: row_id, row_text (see common.row_key), n_words, n_hit (words inside any occurrence), n_items, items (comma-joined)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    windows = scratch.table(item_windows(items, n, item_col, item_text_col), "windows")
    own, mark = row_key(id_col, text_col)
    base = docs.select(own.alias("id"), mark.alias("th"), _words(F.col(text_col)).alias("w")).withColumn("n_words", F.size("w").cast("long"))
    hits = occurrences(base, windows, s, scratch)
    if hits is None:  # no item has a word
        hits = spark.createDataFrame([], f"id {docs.schema[id_col].dataType.simpleString()}, th long, win array<string>, pos long, len int")
    hits = scratch.table(hits.distinct(), "hits")
    before = F.max(F.col("pos") + F.col("len")).over(Window.partitionBy("id", "th").orderBy("pos", "len", "win").rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("pos") + F.col("len")
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("pos"), F.coalesce(before, F.col("pos"))))
    covered = hits.withColumn("fresh", fresh).groupBy("id", "th").agg(F.sum("fresh").cast("long").alias("n_hit"))
    in_doc = hits.select("id", "th", "win").distinct().join(windows.select("item", "win"), "win").select("id", "th", "item").distinct()
    listed = in_doc.groupBy("id", "th").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"))
    both = covered.id.eqNullSafe(listed.id) & covered.th.eqNullSafe(listed.th)
    per_doc = covered.join(listed, both).select(covered.id.alias("i"), covered.th.alias("h"), "n_hit", "n_items", "items")
    per_doc = scratch.table(per_doc, "per_doc")
    out = base.select("id", "th", "n_words").join(per_doc, F.col("id").eqNullSafe(F.col("i")) & F.col("th").eqNullSafe(F.col("h")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(F.col("id").alias("row_id"), F.col("th").alias("row_text"), "n_words", zero("n_hit"), zero("n_items"), F.coalesce("items", F.lit("")).alias("items"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    out = measure(docs, items, id_col, text_col, **options)
    contaminated = F.col("n_hit") > 0
    return out.select(F.col("row_id").alias(id_col), "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), contaminated.alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents in which no word is hit. A row is known by its id and text, so a null or shared id takes no other row along."""
    bad = measure(docs, items, id_col, text_col, **options).where("n_hit > 0").select("row_id", "row_text")
    bad = Scratch(docs.sparkSession, "leaks").table(bad, "rows")  # written, so that its size decides how it is joined
    return without(docs, bad, id_col, text_col)
