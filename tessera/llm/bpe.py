"""BPE encoding and decoding of whole texts with a byte-level vocabulary file.

A text is cut at special tokens, then into pieces by the vocabulary's own pattern; merges never cross pieces. In a piece, a
segment tree over adjacent pair ranks holds at its root the lowest rank; the leftmost pair of that rank is merged, which
changes at most three leaves in logarithmic time, until no mergeable pair is left: n log n for a piece of n bytes, however
long. Decoding maps ids back to bytes.

Words recur, so workers keep the ids of recent ones (two generations of bounded size, see Memo; about 100 MB); what is
forgotten is computed again. Texts are taken in slices of bounded size. One narrow pass over the documents, no shuffle; a lost
task is simply run again.

Nulls: a null text is encoded as the empty text (0 ids). A null id stays null. Repeated rows give repeated results. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices

#: What Python counts as white space, without blank and line feed.
ODD_SPACE = re.compile(r"[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: White space as Unicode has it: fixed values.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
_classes: dict[tuple[str, bool], str] = {}


def char_class(name: str, basic: bool = False) -> str:
    """The letters or numbers as the tokenizers library's Unicode version has them, as ranges for a character class; basic: up to U+FFFF."""
    if (name, basic) not in _classes:
        from tokenizers import Regex, pre_tokenizers

        everything = "".join(map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x10000 if basic else 0x110000)]))
        runs = pre_tokenizers.Split(Regex(rf"\p{{{name}}}"), "removed", invert=True).pre_tokenize_str(everything)
        ranges: list[list[int]] = []
        for code in sorted({ord(c) for r, _ in runs for c in r}):
            if ranges and code == ranges[-1][1] + 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
        _classes[name, basic] = ("a-zA-Z" if name == "L" else "0-9") + "".join(f"\\U{x:08x}-\\U{y:08x}" for x, y in ranges)
    return _classes[name, basic]


def fill(pattern: str, basic: bool) -> str:
    """The pattern with its classes {L}, {N} and {S} written out."""
    return pattern.replace("{L}", char_class("L", basic)).replace("{N}", char_class("N", basic)).replace("{S}", SPACE)


class Cutter:
    """All pieces of a text. Python's own engine has tables for characters up to U+FFFF and is faster there."""

    def __init__(self, basic: str, full: str):
        import regex

        self.basic, self.full = re.compile(basic).findall, regex.compile(full).findall

    def __call__(self, text: str) -> list[str]:
        return self.basic(text) if text.isascii() or max(text) <= "\uffff" else self.full(text)


def piece_patterns() -> tuple[str, str]:
    return fill(PIECES, True), fill(PIECES, False)


class Memo(dict):
    """Results by key. When `size` are held, they become the old generation, and the one before goes."""

    def __init__(self, make: Callable, size: int = 150_000, longest: int = 64):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class ByteBPE:
    """Byte-level BPE from a tokenizers file: encode gives the ids of tokenizers with add_special_tokens=False."""

    def __init__(self, path: str, patterns: tuple[str, str] | None = None):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        pre = spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without normalizer and prefix space is needed")
        alphabet = self._alphabet()
        self.byte_id = [vocab[alphabet[b]] for b in range(256)]
        width = self.width = max(vocab.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.none = len(pairs)
        self.ranks = {vocab[a] * width + vocab[b]: k for k, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        back = {c: b for b, c in alphabet.items()}
        self.bytes_of = {i: bytes(map(back.__getitem__, t)) for t, i in vocab.items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of.update({i: t.encode() for t, i in special.items()})
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.pieces = Cutter(*(patterns or piece_patterns()))
        self.bytes_of_digits = {str(i): b for i, b in self.bytes_of.items()}
        self.unit = Memo(self._encode_unit, 250_000)
        self.other = Memo(self._encode_piece, 20_000)

    @staticmethod
    def _alphabet() -> dict[int, str]:
        """Bytes that print stand for themselves, the others follow from U+0100 on."""
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(own)]
        return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}

    def merge(self, ids: list[int]) -> list[int]:
        n = len(ids)
        if n < 2:
            return ids
        rank, none, width, made = self.ranks.get, self.none, self.width, self.made
        # leaf size + i of the tree is the pair that starts at symbol i; every inner node has the least of its two children
        size = 1 << (n - 2).bit_length()
        tree = [none] * (2 * size)
        tree[size : size + n - 1] = [rank(a * width + b, none) for a, b in zip(ids, ids[1:], strict=False)]
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a <= b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (low := tree[1]) < none:
            k = 1
            while k < size:  # to the leftmost leaf of that rank
                k += k
                if tree[k] != low:
                    k += 1
            i = k - size
            j = after[i]
            k = after[i] = after[j]
            ids[i], ids[j] = made[low], -1
            h = before[i]
            if k < n:
                before[k] = i
                tree[size + j] = none
                tree[size + i] = rank(ids[i] * width + ids[k], none)
                changed = (size + j, size + i)
            else:
                tree[size + i] = none
                changed = (size + i,)
            if h >= 0:
                tree[size + h] = rank(ids[h] * width + ids[i], none)
                changed += (size + h,)
            for k in changed:
                k >>= 1
                while k:
                    a, b = tree[2 * k], tree[2 * k + 1]
                    if b < a:
                        a = b
                    if tree[k] == a:
                        break
                    tree[k] = a
                    k >>= 1
        return [x for x in ids if x >= 0]

    def _encode_piece(self, piece: str) -> str:
        """Decimal ids of one piece, joined by commas."""
        return ",".join(map(str, self.merge(list(map(self.byte_id.__getitem__, piece.encode())))))

    def _encode_unit(self, unit: str) -> str:
        """Decimal ids of a stretch without its leading blank, which is there unless it starts with a line feed."""
        text = unit if unit[:1] == "\n" else " " + unit
        pieces = self.pieces(text)
        return self._encode_piece(text) if len(pieces) == 1 else self._joined(pieces)

    def _joined(self, pieces: list[str]) -> str:
        """A blank with a word behind it is looked up as the word."""
        unit, other = self.unit, self.other
        return ",".join([unit[p[1:]] if p[0] == " " and p[1:].isalpha() else other[p] for p in pieces])

    def _csv(self, text: str) -> str:
        return self._joined(self.pieces(text))

    def _ordinary(self, text: str) -> list[str]:
        if not text:
            return []
        blanks = text.count(" ") + text.count("\n")
        # only single blanks and line feeds between runs, none at the ends: pieces never cross the blanks, so the parts can be looked up
        if not ODD_SPACE.search(text) and len(text.split()) == blanks + 1:
            first, *rest = text.replace("\n", " \n").split(" ")
            return [self._csv(first), *map(self.unit.__getitem__, rest)]
        return [self._csv(text)]

    def encode_parts(self, text: str) -> list[str]:
        """The ids in decimal, joined by commas, of consecutive stretches of the text."""
        if self.cut is None or not any(s in text for s in self.special):
            return self._ordinary(text)
        return [x for p in self.cut.split(text) for x in ([str(self.special[p])] if p in self.special else self._ordinary(p))]

    def encode(self, text: str) -> list[int]:
        return [int(i) for part in self.encode_parts(text) for i in part.split(",")]

    def decode_digits(self, csv: str) -> str:
        """The text of decimal ids joined by commas; bytes are joined before they are read as UTF-8."""
        return b"".join(map(self.bytes_of_digits.__getitem__, csv.split(","))).decode("utf-8", "replace") if csv else ""

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_loaded: dict[str, ByteBPE] = {}


def _codec(path: str, patterns: tuple[str, str]) -> ByteBPE:
    if path not in _loaded:
        _loaded[path] = ByteBPE(path, patterns)
    return _loaded[path]


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per document: id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256, round_trips; with_ids adds ids."""
    patterns = piece_patterns()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        codec = _codec(path, patterns)
        for part in slices(batches, 1):
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "round_trips": []}
            flat = []
            for value in part.column(1):
                text = value.as_py() or ""
                csv = ",".join(codec.encode_parts(text))
                decoded = codec.decode_digits(csv)
                out["n_tokens"].append(csv.count(",") + 1 if csv else 0)
                out["ids_sha256"].append(hashlib.sha256(csv.encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                out["round_trips"].append(decoded == text)
                if with_ids and csv:
                    flat.append(np.fromstring(csv, np.int32, sep=","))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.bool_())
            arrays = [part.column(0), *(pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True))]
            names = [id_col, *out]
            if with_ids:
                ends = pa.array(np.cumsum([0, *out["n_tokens"]]), pa.int32())
                arrays.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trips boolean"
    schema += ", ids array<int>" if with_ids else ""
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def encode_stage(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents' ids with n_tokens and the token ids themselves."""
    return round_trip(docs, path, id_col, text_col, with_ids=True)
