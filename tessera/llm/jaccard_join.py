"""N-gram Jaccard join: MinHash banding, a shuffle on band hashes, and verification on full n-gram sets.

Words are as in `common.words`; a text's set is that of its runs of five words (of all its words where it has fewer than
five; none where it has none). Two texts are linked if their sets' Jaccard similarity is at least the threshold.

1. One pass computes per document a digest of its words and its MinHash band hashes (bands and rows follow from threshold
   and recall, see `banding`). Documents with equal words collapse to one text with a number and a count, by aggregation.
2. Texts that share a band hash form a bucket. Buckets with the same members count once.
3. Members of buckets get their full sets. Buckets that have texts in common are dealt together, as one group, where that sends fewer
   shingles than dealing each of them does (`dealt`). A group or bucket is cut into blocks of bounded size, and every pair of its blocks
   is a task's work: all pairs of texts that share a bucket are verified there, in buckets each in the first band that the two share
   and in groups once. What leaves is one
   row per text with its number of links and one edge of a spanning forest, so the rows grow with the members and the blocks
   and not with the pairs, and no link is lost, dropped or capped.
4. Components of the edges are the classes.

Result, one row per document: id, text_id (smallest id with the same words), class_id (smallest id of the class), n_links
(number of other documents linked to it, copies included), n_shingles, and keeps: true for one row of each class, which has
the class's smallest id.

Nulls: a null text has no words and links to nothing, like any text without words; its class is its own id and it is kept.
Rows are told apart by id and text, never by id alone: rows that share an id or have none are documents of their own. A class
without any id has a null class_id. Of rows alike in id and text, `keeps` is true for all or none;
drop_near_copies leaves one of them. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, likely, row_key, temporary, without, words
from tessera.llm.graph import components

#: Shingles in a block of a bucket (8 bytes each, two blocks in a task), at most; a bucket that would fill less than MANY_BLOCKS
#: of these is cut into up to so many, of LEAST_SHINGLES at least, for even tasks. Cuts change no result, but each block is sent to
#: all others of its bucket.
BLOCK_SHINGLES, LEAST_SHINGLES, MANY_BLOCKS = 1 << 18, 1 << 17, 3
#: Shingles hashed at a time.
CHUNK = 1 << 18
#: Stands for the band where buckets are dealt together.
GROUP = -1
PRIME = np.uint64(0x9E3779B97F4A7C15)


def banding(threshold: float, recall: float, rows: int = 5) -> tuple[int, int]:
    """The fewest bands of so many rows that make two texts at the threshold meet with at least this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)), rows


def shingle_hashes(tokens: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all runs of n tokens, document by document, and their number per document.

    tokens: 64-bit hashes of all documents' words in a row. A document of fewer than n words has one run, of all of them.
    """
    tokens = tokens.view(np.uint64)
    counts = np.where(lengths >= n, lengths - n + 1, (lengths > 0).astype(lengths.dtype))
    ends = np.cumsum(lengths)
    if not len(tokens):
        return np.empty(0, np.uint64), counts
    padded = np.concatenate([tokens, np.zeros(n - 1, np.uint64)])
    rolled = np.zeros(len(tokens), np.uint64)
    for j in range(n):
        rolled = rolled * PRIME + padded[j : j + len(tokens)]
    keep = np.zeros(len(tokens) + 1, np.int64)
    starts = ends - lengths
    np.add.at(keep, starts[counts > 0], 1)
    np.add.at(keep, (starts + counts)[counts > 0], -1)
    mask = np.cumsum(keep[:-1]) > 0
    for i in np.flatnonzero((lengths > 0) & (lengths < n)):  # short texts: their own words only
        value = int(lengths[i])
        for token in tokens[starts[i] : ends[i]].tolist():
            value = (value * int(PRIME) + token) % (1 << 64)
        rolled[starts[i]] = value
    out = rolled[mask]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return out, counts


def _signatures(hashes: np.ndarray, counts: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """MinHash values, (documents with shingles) x (hash functions)."""
    counts = counts[counts > 0]
    out = np.empty((len(counts), len(multipliers)), np.uint64)
    first = np.cumsum(counts) - counts
    at = 0
    while at < len(counts):
        stop = max(at + 1, int(np.searchsorted(first, first[at] + CHUNK, "right")) - 1)
        part = hashes[first[at] : first[stop - 1] + counts[stop - 1]]
        cuts = first[at:stop] - first[at]
        for k, a in enumerate(multipliers):
            out[at:stop, k] = np.minimum.reduceat(part * a, cuts)
        at = stop
    return out


def _bands(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(minima), bands), np.uint64)
    for r in range(rows):
        out = out * PRIME + minima[:, r::rows][:, :bands]
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def _hashed(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _arrays(column) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a list column of longs."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], np.diff(offsets)


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column of longs in chunks."""
    chunks = [_arrays(c) for c in column.chunks]
    return np.concatenate([v for v, _ in chunks]), np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in chunks]))])


def sketch(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """row_id, row_text, digest of the words (null without words), number of shingles, band hashes."""
    multipliers = np.random.default_rng(20260101).integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["row_id", "row_text", "digest", "n_shingles", "bands"]
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                tokens, lengths = _arrays(batch.column(2))
                hashes, counts = shingle_hashes(tokens, lengths, n)
                full = np.zeros((len(lengths), bands), np.int64)
                full[counts > 0] = _bands(_signatures(hashes, counts, multipliers), bands, rows)
                ends = np.cumsum(lengths)
                digests = [hashlib.blake2b(tokens[e - m : e].tobytes(), digest_size=16).digest() if m else None for e, m in zip(ends, lengths, strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(lengths) + 1) * bands, pa.int32()), pa.array(full.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(counts.astype(np.int64)), lists], names)

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(*row_key(id_col, text_col), _hashed(F.col(text_col)).alias("w"))
    return source.mapInArrow(run, f"row_id {kind}, row_text long, digest binary, n_shingles long, bands array<long>")


def shingle_sets(texts: DataFrame, n: int) -> DataFrame:
    """number, sorted distinct shingle hashes, of rows of (number, w)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                hashes, counts = shingle_hashes(*_arrays(batch.column(1)), n)
                ends = np.cumsum(counts)
                sets = [np.unique(hashes[e - m : e]).view(np.int64) for e, m in zip(ends, counts, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["number", "grams"])

    return texts.select("number", "w").mapInArrow(run, "number long, grams array<long>")


def verify_blocks(threshold: float):
    """Work on one pair of blocks of a bucket, or of a group of them (band GROUP): rows (number, links, other)."""

    def run(key, table):
        import pyarrow as pa

        band, _, left, right = (k.as_py() for k in key)
        blocks, numbers = table.column("block").to_numpy(), table.column("number").to_numpy()
        order = np.lexsort((numbers, blocks))
        blocks, numbers, copies = blocks[order], numbers[order], table.column("copies").to_numpy()[order]
        grams, at = _lists(table.column("grams"))
        sets = [grams[at[k] : at[k + 1]] for k in order.tolist()]
        sizes = np.diff(at)[order]
        keys = _lists(table.column("bands"))[0].reshape(len(order), -1)[order]
        keys = keys if band == GROUP else keys[:, :band]
        # shingles by number, so that a set is a mark in a table and its share of another one a sum of marks
        distinct, flat = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        mark = np.zeros(len(distinct), bool)
        second = int((blocks == left).sum())
        links, parent = np.zeros(len(order), np.int64), list(range(len(order)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for i in range(second if left != right else len(order)):
            after = i + 1 if left == right else second
            if after == len(order):
                break
            size, others = sizes[i], sizes[after:]
            fits = np.minimum(others, size) >= threshold * np.maximum(others, size) - 1e-9
            met = (keys[after:] == keys[i]).any(axis=1)
            fits &= met if band == GROUP else ~met  # in a bucket: not met in an earlier band
            if not fits.any():
                continue
            own = flat[starts[i] : starts[i] + size]
            mark[own] = True
            near = after + np.flatnonzero(fits)
            n, first = sizes[near], np.cumsum(sizes[near]) - sizes[near]
            shared = np.add.reduceat(mark[flat[np.repeat(starts[near] - first, n) + np.arange(n.sum())]], first, dtype=np.int64)
            mark[own] = False
            for j in near[shared >= threshold * (n + size - shared) - 1e-9].tolist():
                links[i] += copies[j]
                links[j] += copies[i]
                a, b = root(i), root(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        found = links > 0
        other = np.array([numbers[root(i)] for i in np.flatnonzero(found)], np.int64)
        return pa.table({"number": numbers[found], "links": links[found], "other": other})

    return run


def _blocks(size: str) -> Column:
    return F.least(F.ceil(F.col(size) / LEAST_SHINGLES), F.greatest(F.ceil(F.col(size) / BLOCK_SHINGLES), F.lit(MANY_BLOCKS))).cast("int")


def dealt(scratch: Scratch, members: DataFrame) -> DataFrame:
    """(band, key, number, blocks): where texts are compared. members: band, key, number, n_shingles, blocks, of buckets.

    Near copies stand in many buckets, each with some of them. Buckets that hang together become one (GROUP, key) unless its blocks,
    each of which goes to all others, would come to more shingles than those of the buckets.
    """
    with temporary():
        first = members.groupBy("band", "key").agg(F.min("number").alias("first"))
        roots = components(members.join(first, ["band", "key"]).select(F.col("number").alias("u"), F.col("first").alias("v")))
        rooted = members.join(roots, members.number == roots.node, "left").withColumn("root", F.coalesce("root", "number")).drop("node")
        rooted = scratch.table(rooted, "rooted")
    once = rooted.groupBy("root", "number").agg(F.first("n_shingles").alias("n_shingles"), F.sum("blocks").alias("sent"))
    groups = once.groupBy("root").agg(F.sum("n_shingles").alias("size"), F.sum(F.col("n_shingles") * F.col("sent")).alias("sent"))
    groups = groups.withColumn("blocks", _blocks("size")).where("size * blocks <= sent").select("root", "blocks")
    groups = scratch.table(groups, "groups")
    together = once.join(groups, "root").select(F.lit(GROUP).alias("band"), F.col("root").alias("key"), "number", "blocks")
    rest = rooted.join(groups, "root", "left_anti").select("band", "key", "number", "blocks")
    return scratch.table(together.unionByName(rest), "dealt")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, recall: float = 0.9995) -> DataFrame:
    out = _classes(docs, id_col, text_col, n, threshold, recall)
    return out.select(F.col("row_id").alias(id_col), "text_id", "class_id", "n_links", "n_shingles", "keeps")


def _classes(docs: DataFrame, id_col: str, text_col: str, n: int = 5, threshold: float = 0.8, recall: float = 0.9995) -> DataFrame:
    """row_id, row_text, text_id, class_id, n_links, n_shingles, keeps: one row per document."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    bands, rows = banding(threshold, recall)
    sketches = scratch.table(sketch(docs, id_col, text_col, n, bands, rows), "sketches")
    worded = sketches.where("digest IS NOT NULL").groupBy("digest")
    row = F.struct(F.col("row_id").isNull().alias("none"), "row_id", "row_text")  # ids before nulls
    texts = worded.agg(F.min(row).alias("row"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    texts = scratch.table(texts.withColumn("number", F.monotonically_increasing_id()), "texts")
    members = texts.select("number", "n_shingles", F.posexplode("bands").alias("band", "key"))
    buckets = (
        members.groupBy("band", "key")
        .agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"), F.bit_xor(F.xxhash64("number")).alias("x"), F.bit_xor(F.xxhash64("number", F.lit(1))).alias("y"))
        .where("n > 1")
        .groupBy("n", "size", "x", "y")
        .agg(F.min(F.struct("band", "key")).alias("b"))
        .select("b.band", "b.key", _blocks("size").alias("blocks"))
    )
    buckets = scratch.table(buckets, "buckets")
    met = likely(members, ["band", "key"], buckets, ["band", "key"])
    slim = dealt(scratch, scratch.table(met.join(buckets, ["band", "key"]), "members"))
    chosen = likely(texts, ["number"], slim, ["number"]).join(slim.select("number").distinct(), "number", "left_semi")
    chosen = scratch.table(chosen.select("number", "copies", "bands", "row.row_id", "row.row_text"), "chosen")
    # the sets come from one document of each text
    own, mark = row_key(id_col, text_col)
    same = F.col("row_id").eqNullSafe(F.col("own_id")) & (F.col("row_text") == F.col("own_text"))
    source = docs.select(own.alias("own_id"), mark.alias("own_text"), F.col(text_col).alias("text"))
    source = likely(source, ["own_id", "own_text"], chosen, ["row_id", "row_text"])
    source = source.join(chosen.select("number", "row_id", "row_text"), same).select("number", _hashed(F.col("text")).alias("w"))
    sets = scratch.table(shingle_sets(source, n), "sets").dropDuplicates(["number"])  # rows alike in id and text
    written = scratch.last
    rich = scratch.table(sets.join(chosen.select("number", "copies", "bands"), "number"), "rich")
    scratch.drop(written)
    block = F.pmod(F.xxhash64(F.col("number"), F.lit(7)), F.col("blocks")).cast("int")
    work = slim.withColumn("block", block).withColumn("with_block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    work = work.select("band", "key", "number", "block", F.least("block", "with_block").alias("left"), F.greatest("block", "with_block").alias("right"))
    work = work.join(rich, "number")
    found = work.groupBy("band", "key", "left", "right").applyInArrow(verify_blocks(threshold), "number long, links long, other long")
    found = scratch.table(found, "found")
    links = found.groupBy("number").agg(F.sum("links").alias("links"))
    state = texts.select("digest", "row", "copies", "number").join(links, "number", "left")
    with temporary():
        roots = components(found.select(F.col("number").alias("u"), F.col("other").alias("v")))
        state = state.join(roots, state.number == roots.node, "left").withColumn("root", F.coalesce("root", "number"))
        # only texts with a link or a copy need a join; all others are their own class
        state = state.withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1).where("n_links > 0")
        state = scratch.table(state.select("digest", "row", "root", "n_links"), "state")
    first = state.groupBy("root").agg(F.min("row").alias("first"))
    classes = scratch.table(state.join(first, "root").select("digest", "row", "first", "n_links"), "classes")
    scratch.only("sketches", "classes")
    out = sketches.drop("bands").join(classes, "digest", "left")
    alone = F.col("first").isNull()
    keeps = alone | (F.col("row_id").eqNullSafe(F.col("first.row_id")) & (F.col("row_text") == F.col("first.row_text")))
    return out.select(
        "row_id", "row_text", F.when(alone, F.col("row_id")).otherwise(F.col("row.row_id")).alias("text_id"),
        F.when(alone, F.col("row_id")).otherwise(F.col("first.row_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "n_shingles", keeps.alias("keeps"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, of each class one: that with the smallest id; of rows alike in id and text the first met."""
    scratch = Scratch(docs.sparkSession, "near")
    classes = scratch.table(_classes(docs, id_col, text_col, **options), "classes")
    out = without(docs, classes.where("NOT keeps"), id_col, text_col)
    # rows alike in id and text are copies of each other too
    alike = classes.where("n_links > 0 AND keeps").groupBy("row_id", "row_text").agg(F.count("*").alias("m")).where("m > 1")
    alike = scratch.table(alike, "alike")
    if alike.isEmpty():
        return out
    own, mark = row_key(id_col, text_col)
    rows = out.select(F.struct("*").alias("row"), own, mark)
    same = rows.row_id.eqNullSafe(alike.row_id) & (rows.row_text == alike.row_text)
    once = rows.join(alike, same, "left_semi").dropDuplicates(["row_id", "row_text"])
    return rows.join(alike, same, "left_anti").unionByName(once).select("row.*")
