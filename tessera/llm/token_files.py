"""Token-ID / binary output: fixed-width bit packing with block offsets.

A shard file holds the ids of a run of documents in ascending id order, each with the end id appended. Every id takes the
fewest bits that hold the vocabulary's largest id; blocks of BLOCK ids are packed on their own, so block k starts at a
known byte and any id is found by arithmetic. Layout: MAGIC, blocks, footer, length of the footer (8 bytes little-endian),
MAGIC. The footer (JSON line, then raw arrays) has width, block size, number of ids, and for each document its id and its
number of ids; the first `nulls` documents have none. Unpacking a block is one vectorised numpy expression.

The ranges of the shards are found first, from ids, hashes and sizes of texts alone, by a range partitioning of these narrow rows.
Then texts are encoded where they lie, and their packed ids (0.6 of the texts' bytes here) go straight to their shard: one
shuffle, and no table of them is written beside it. Shards are ranges by id and a hash of the text, so shard order is id order,
rows that share an id or have none spread over shards, and the start of a shard is the sum of the counts before it: one row per
shard reaches the driver. Files are written under a name of the attempt and then moved: a task that is run again, or twice at once,
puts the same bytes in the same place. The folder is reached through pyarrow's file systems (file:, hdfs:, s3:, gs:), so it
may be anything that all executors share.

Nulls: a null text gives the end id alone; null ids come first. Repeated ids lie beside each other, ordered by a hash of their
texts. An empty table gives no shard. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.bpe import Cutter, Memo, fill
from tessera.llm.common import Scratch, shuffle_partitions, slices, temporary

MAGIC, BLOCK = b"TKPACK02", 1 << 16
#: Bytes of a shard file: up to MOST_BYTES; less, but LEAST_BYTES, where that gives no more files than shuffle partitions.
LEAST_BYTES, MOST_BYTES = 16 << 20, 256 << 20
#: Bytes of packed ids for a byte of text, about (0.59 on the check's tables); it only sets the number of shards.
TEXT_SHARE = 0.6
_odd = re.compile("[\x1c-\x1f]")
#: Below U+0250, and without U+0130, NFC changes nothing and lower-casing goes character by character in every library.
_beyond = re.compile("[\u0130\u0250-\U0010ffff]").search


def bits_for(vocab_size: int) -> int:
    """Bits of the largest id."""
    return max(1, int(vocab_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Little-endian bit packing; a block of n ids takes ceil(n * width / 8) bytes."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * width).reshape(n, width)
    return bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def open_store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class ShardWriter:
    """Streams ids to a file; holds one block and 16 bytes for each document."""

    def __init__(self, uri: str, width: int):
        self.fs, self.path = open_store(uri)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.width, self.n, self.held, self.size, self.nulls = width, 0, [], 0, 0
        self.docs: list[int] = []
        self.counts: list[int] = []
        self.out = self.fs.open_output_stream(self.temporary)
        self.out.write(MAGIC)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        if doc is None:
            self.nulls += 1
            if self.nulls <= len(self.docs):
                raise ValueError("documents without an id come first")
        self.docs.append(doc or 0)
        self.counts.append(len(ids))
        self.held.append(ids)
        self.size += len(ids)
        self.n += len(ids)
        if self.size >= BLOCK:
            every = np.concatenate(self.held)
            whole = len(every) // BLOCK * BLOCK
            for k in range(0, whole, BLOCK):
                self.out.write(pack(every[k : k + BLOCK], self.width))
            self.held, self.size = [every[whole:]], len(every) - whole

    def close(self) -> None:
        if self.size:
            self.out.write(pack(np.concatenate(self.held), self.width))
        head = json.dumps({"width": self.width, "block": BLOCK, "n": self.n, "docs": len(self.docs), "nulls": self.nulls}).encode() + b"\n"
        footer = head + np.array(self.docs, "<i8").tobytes() + np.array(self.counts, "<i8").tobytes()
        self.out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        self.out.close()
        self.fs.move(self.temporary, self.path)


class ShardReader:
    def __init__(self, uri: str):
        self.fs, self.path = open_store(uri)
        self.file = self.fs.open_input_file(self.path)
        end = self.file.size() - 16
        self.file.seek(end)
        tail = self.file.read(16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{uri} is not a whole shard file")
        length = int.from_bytes(tail[:8], "little")
        self.file.seek(end - length)
        head, _, arrays = self.file.read(length).partition(b"\n")
        spec = json.loads(head)
        self.width, self.block, self.n, self.nulls = spec["width"], spec["block"], spec["n"], spec["nulls"]
        self.docs = np.frombuffer(arrays, "<i8", spec["docs"])
        self.counts = np.frombuffer(arrays, "<i8", spec["docs"], 8 * spec["docs"])

    def read_block(self, k: int) -> np.ndarray:
        count = min(self.block, self.n - k * self.block)
        self.file.seek(len(MAGIC) + k * (self.block * self.width // 8))
        return unpack(self.file.read(-(-count * self.width // 8)), count, self.width)

    def ids(self, start: int, n: int) -> np.ndarray:
        """Random access: the n ids from position start on."""
        if n <= 0:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (start + n - 1) // self.block
        return np.concatenate([self.read_block(k) for k in range(first, last + 1)])[start - first * self.block :][:n]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Each document's id, start in the shard, and ids, block by block."""
        at, block, values = 0, -1, np.empty(0, np.uint32)
        for k, (doc, n) in enumerate(zip(self.docs.tolist(), self.counts.tolist(), strict=True)):
            parts, pos, left = [], at, n
            while left:
                if pos // self.block != block:
                    block = pos // self.block
                    values = self.read_block(block)
                parts.append(values[pos % self.block :][:left])
                pos, left = pos + len(parts[-1]), left - len(parts[-1])
            yield None if k < self.nulls else doc, at, np.concatenate(parts) if parts else np.empty(0, np.uint32)
            at += n


class LibraryEncoder:
    """Ids of the tokenizers library for whole texts. Where a vocabulary lower-cases, drops white space and cuts by a known
    pattern, the library encodes each distinct piece once and its ids are kept; all other texts go through it whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        spec = json.loads(self.lib.to_str())
        pre = json.dumps(spec["pre_tokenizer"])
        # the fixed pattern of a lower-casing vocabulary whose pieces hold no white space
        self.by_word = '"Removed"' in pre and "[^\\\\s\\\\p{L}\\\\p{N}]+" in pre and '"invert": true' in pre
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.vocab_size = self.lib.get_vocab_size(with_added_tokens=True)
        self.stretch = Memo(self._stretch, 400_000)
        self.piece = Memo(self._whole, 300_000)
        self.cut = None
        if self.by_word:
            pattern = "'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+"
            self.cut = Cutter(fill(pattern, True), fill(pattern, False))

    def _whole(self, text: str) -> bytes:
        return array("I", self.lib.encode(text, add_special_tokens=False).ids).tobytes()

    def _stretch(self, stretch: str) -> bytes:
        """Ids of a stretch without white space; normalising the parts of a text between white space is normalising the text."""
        if not _beyond(stretch):
            normal = stretch.lower()
        else:
            normal = self.lib.normalizer.normalize_str(stretch)
            if self.lib.normalizer.normalize_str(normal) != normal:
                return self._whole(stretch)
        return b"".join([self.piece[p] for p in self.cut(normal)])

    def encode(self, text: str) -> bytes:
        """As little-endian unsigned 32-bit integers."""
        if not self.by_word or _odd.search(text) or any(s in text for s in self.special):
            return self._whole(text)
        return b"".join(map(self.stretch.__getitem__, (text if not text.isascii() and _beyond(text) else text.lower()).split()))


_encoders: dict[str, LibraryEncoder] = {}


def _encoder(path: str) -> LibraryEncoder:
    if path not in _encoders:
        _encoders[path] = LibraryEncoder(path)
    return _encoders[path]


def shard_bounds(docs: DataFrame, id_col: str, text_col: str, shards: int | None) -> list[tuple[int, int, int]]:
    """The last row of each shard in order, as (1 or 0 for a null id, id, hash of the text); empty if there are no rows."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), _mark(text_col), F.octet_length(F.col(text_col).cast("string")).alias("size"))
    with temporary():
        rows = Scratch(spark, "ranges").table(rows, "rows")
        if shards is None:
            size = rows.agg(F.coalesce(F.sum(F.coalesce("size", F.lit(0)) + 4), F.lit(0))).first()[0]
            size = int(size * TEXT_SHARE)
            shards = max(1, -(-size // MOST_BYTES), min(shuffle_partitions(spark), -(-size // LEAST_BYTES)))
        ranged = rows.repartitionByRange(shards, F.col("id").asc_nulls_first(), F.col("mark").asc())
        key = F.struct(F.col("id").isNotNull().cast("int").alias("some"), F.coalesce("id", F.lit(0)).alias("id"), "mark")
        last = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.max(key).alias("last")).select("last.*").collect()  # one row per shard
    return sorted(tuple(r) for r in last)


def _mark(text_col: str):
    return F.xxhash64(text_col).alias("mark")


def shards_of(ids: np.ndarray, some: np.ndarray, marks: np.ndarray, bounds: list[tuple[int, int, int]]) -> np.ndarray:
    """The number of bounds before each row; beyond the last one it is the last shard."""
    out = np.zeros(len(ids), np.int32)
    for one, last, mark in bounds[:-1]:
        out += (some > one) | ((some == one) & ((ids > last) | ((ids == last) & (marks > mark))))
    return out


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str, bounds: list[tuple[int, int, int]]) -> DataFrame:
    """id, mark (hash of the text), n, width, packed (the ids and the end id in the fewest bits), shard."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder, end = _encoder(tokenizer), np.array([end_id], np.uint32)
        width = bits_for(encoder.vocab_size)
        for batch in slices(batches, 2):
            ids = [np.concatenate([np.frombuffer(encoder.encode(t.as_py() or ""), "<u4"), end]) for t in batch.column(2)]
            columns = [pa.array([len(x) for x in ids], pa.int64()), pa.array([width] * len(ids), pa.int32()), pa.array([pack(x, width) for x in ids], pa.binary())]
            own = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            some = batch.column(0).is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
            shard = shards_of(own, some, batch.column(1).to_numpy(zero_copy_only=False), bounds)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, pa.array(shard, pa.int32())], ["id", "mark", "n", "width", "packed", "shard"])

    slim = docs.select(F.col(id_col).cast("long").alias("id"), _mark(text_col), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, "id long, mark long, n long, width int, packed binary, shard int")


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> list[tuple[int, int, int, str]]:
    """Writes the shard files; (shard, start, ids, uri) in order, one entry per file."""
    spark = docs.sparkSession
    fs, base = open_store(folder)
    fs.create_dir(base, recursive=True)
    bounds = shard_bounds(docs, id_col, text_col, shards)
    if not bounds:
        return []

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        writer, shard = None, TaskContext.get().partitionId()
        uri = f"{folder}/shard-{shard:06d}.bin"
        for batch in batches:
            for doc, n, width, packed in zip(batch.column(0), batch.column(2), batch.column(3), batch.column(4), strict=True):
                writer = writer or ShardWriter(uri, width.as_py())
                writer.add(doc.as_py(), unpack(packed.as_py(), n.as_py(), width.as_py()))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([writer.n], pa.int64()), pa.array([uri])], ["shard", "n", "uri"])

    order = [F.col("id").asc_nulls_first(), F.col("mark").asc()]
    ready = encoded(docs, tokenizer, end_id, id_col, text_col, bounds)
    ranged = ready.repartitionById(len(bounds), F.col("shard")).sortWithinPartitions(*order)
    made = sorted(tuple(r) for r in ranged.mapInArrow(run, "shard int, n long, uri string").collect())  # one row per shard
    starts = accumulate((n for _, n, _ in made), initial=0)
    return [(shard, start, n, uri) for (shard, n, uri), start in zip(made, starts, strict=False)]


def read_shards(spark: SparkSession, shards: list[tuple[int, int, int, str]], id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per document, from the files: id, start, n_tokens, ids_crc32, shard; with_ids adds the ids."""
    extra = ", ids array<long>" if with_ids else ""
    schema = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long, shard int{extra}"
    if not shards:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for shard, start, _, uri in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows: list[tuple] = []
                for doc, at, ids in ShardReader(uri).documents():
                    rows.append((doc, start + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), shard, *([ids.tolist()] if with_ids else [])))
                    if len(rows) >= 4096:
                        yield _batch(pa, rows, id_col, with_ids)
                        rows = []
                if rows:
                    yield _batch(pa, rows, id_col, with_ids)

    table = spark.createDataFrame(shards, "shard int, start long, n long, uri string")
    return table.repartition(len(shards), "shard").mapInArrow(run, schema)


def _batch(pa, rows: list[tuple], id_col: str, with_ids: bool):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), *([pa.list_(pa.int64())] if with_ids else [])]
    names = [id_col, "start", "n_tokens", "ids_crc32", "shard", *(["ids"] if with_ids else [])]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    return read_shards(spark, write_shards(docs, scratch.path("shards"), tokenizer, end_id, id_col, text_col), id_col)
