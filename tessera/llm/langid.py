"""Language ID: interpolated Kneser-Ney character language models, one per language.

Words are runs of letters, lower-cased; a model of order 4 runs over each word with boundary marks, so a word's probability
doesn't depend on its neighbours. Counts come from every training row: words are counted per language by aggregation, then
cut into 4-grams once per distinct word. Lower orders use continuation counts (in how many contexts a gram occurs), as
Kneser and Ney have it, with one absolute discount per language and order, n1 / (n1 + 2 n2). All of this is aggregation and
windows over grams; no gram is pruned and no language is gathered in one task. The model is written to the shared folder and
read by each worker as sorted arrays of gram hashes with values beside them; looking up many grams is one binary search. So
it grows with the distinct grams of the corpus, in files and in workers, and doesn't pass through the driver.

A text goes to the language with the lowest cross-entropy per character. The score is the posterior of that language under a
temperature fitted on a fold of training rows that the models haven't seen: by hash of the text, about `CALIBRATION_ROWS` rows
or a tenth of all, whichever is less (a documented bound; a language without other rows is learned from those). `rejected`
marks texts whose cross-entropy lies beyond the limit that nearly all rows of that fold keep within.

Letters are what Unicode calls so (categories L*), in training as in scoring. Nulls: a null text and one without letters give
`und` with score 0; a null language is never learned from. Without training rows every text is `und`. Repeated rows give
repeated results; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, letter_runs, slices
from tessera.llm.token_files import open_store

ORDER = 4
CALIBRATION_ROWS = 2_000
REJECT_QUANTILE = 0.999
LONGEST_KEPT, KEPT_WORDS = 48, 200_000
MARK = "\x02"
UNKNOWN = 1e-7
_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(id_col: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.pmod(F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")), F.lit(folds)) == fold


def gram_counts(train: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n) for all 4-grams of marked words."""
    words = train.select(F.col(lang_col).cast("string").alias("lang"), F.explode(F.split(F.lower(F.col(text_col)), r"[^\p{L}]+")).alias("word")).where("word <> ''")
    counted = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    marked = counted.withColumn("word", F.concat(F.lit(MARK * (ORDER - 1)), "word", F.lit(MARK)))
    at = F.explode(F.sequence(F.lit(1), F.length("word") - (ORDER - 1)))
    return marked.withColumn("at", at).select("lang", F.substr("word", "at", F.lit(ORDER)).alias("gram"), "n").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _hash(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of code points."""
    out = np.full(len(codes), codes.shape[1], np.uint64)
    for j in range(codes.shape[1]):
        out = (out ^ codes[:, j].astype(np.uint64)) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _codes(grams: list[str], width: int) -> np.ndarray:
    return np.frombuffer("".join(grams).encode("utf-32-le"), "<u4").reshape(len(grams), width)


@dataclass
class Table:
    """Values by sorted hash."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Table:
        order = np.argsort(keys)
        return cls(keys[order], values[order])

    def get(self, keys: np.ndarray, default: float) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), default)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.values[at], default)


@dataclass
class Model:
    """p_n = a_n(gram) + g_n(context) * p_(n-1)."""

    gram: list[Table] = field(default_factory=list)
    context: list[Table] = field(default_factory=list)

    def log2p(self, codes: np.ndarray) -> np.ndarray:
        p = np.full(len(codes), UNKNOWN)
        for n in range(1, ORDER + 1):
            part = codes[:, ORDER - n :]
            p = self.gram[n - 1].get(_hash(part), 0.0) + self.context[n - 1].get(_hash(part[:, :-1]), 1.0) * p
        return np.log2(p)


def fit(grams: DataFrame) -> DataFrame:
    """(lang, level, context, gram, value) of the Kneser-Ney models, from (lang, gram, n) of the highest order."""
    counts, out = grams.select("lang", "gram", F.col("n").cast("long").alias("n")), None
    for level in range(ORDER, 0, -1):
        if level < ORDER:  # in how many contexts a gram occurs
            counts = counts.groupBy("lang", F.substring("gram", 2, level).alias("gram")).agg(F.count("*").alias("n"))
        ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discount = F.when(ones + twos > 0, F.least(F.lit(0.95), F.greatest(F.lit(0.1), ones / (ones + 2 * twos)))).otherwise(0.5)
        discounts = counts.groupBy("lang").agg(discount.alias("d"))
        of_context = Window.partitionBy("lang", "left")
        rows = counts.withColumn("left", F.substring("gram", 1, level - 1)).withColumns({"total": F.sum("n").over(of_context), "kinds": F.count("*").over(of_context)})
        rows = rows.join(discounts, "lang")
        known = rows.select("lang", F.lit(level).alias("level"), F.lit(False).alias("context"), "gram", (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("value"))
        left = rows.select("lang", F.lit(level).alias("level"), F.lit(True).alias("context"), F.col("left").alias("gram"), (F.col("d") * F.col("kinds") / F.col("total")).alias("value")).distinct()
        both = known.unionByName(left)
        out = both if out is None else out.unionByName(both)
    return out


def load(path: str) -> dict[str, Model]:
    """The models from their table in the shared folder."""
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    store, folder = open_store(path)
    table = pq.read_table(folder, filesystem=store)
    models: dict[str, Model] = {}
    for lang in sorted(pc.unique(table.column("lang")).to_pylist()):
        own, model = table.filter(pc.equal(table.column("lang"), lang)), Model()
        for level in range(1, ORDER + 1):
            for context, tables in ((False, model.gram), (True, model.context)):
                part = own.filter(pc.and_(pc.equal(own.column("level"), level), pc.equal(own.column("context"), context)))
                width = level - context
                tables.append(Table.of(_hash(_codes(part.column("gram").to_pylist(), width)), part.column("value").to_numpy()))
        models[lang] = model
    return models


_loaded: dict[str, Scorer] = {}


def _scorer(path: str) -> Scorer:
    if path not in _loaded:
        _loaded.clear()  # a worker serves one model at a time
        _loaded[path] = Scorer(load(path))
    return _loaded[path]


class Scorer:
    """Sums of log2 p per language and numbers of characters, for whole texts."""

    def __init__(self, models: dict[str, Model]):
        self.langs = sorted(models)
        self.models = [models[k] for k in self.langs]
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.langs) + 1))

    def _score(self, tokens: list[str]) -> np.ndarray:
        """One row per token: sums over its letter runs, and their characters."""
        out = np.zeros((len(tokens), len(self.langs) + 1))
        runs = [(k, w) for k, token in enumerate(tokens) for w in letter_runs().findall(token.lower())]
        for start in range(0, len(runs), 20_000):
            part = runs[start : start + 20_000]
            marked = [MARK * (ORDER - 1) + w + MARK for _, w in part]
            sizes = np.array([len(w) - ORDER + 1 for w in marked])
            flat = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4")
            starts = np.repeat(np.cumsum(sizes + ORDER - 1) - (sizes + ORDER - 1), sizes)
            inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            codes = flat[(starts + inner)[:, None] + np.arange(ORDER)]
            distinct, back = np.unique(_hash(codes), return_inverse=True)
            first = np.zeros(len(distinct), np.int64)
            first[back[::-1]] = np.arange(len(codes))[::-1]
            owner = np.repeat(np.array([k for k, _ in part]), sizes)
            for j, model in enumerate(self.models):
                out[:, j] += np.bincount(owner, model.log2p(codes[first])[back], len(tokens))
            out[:, -1] += np.bincount(owner, minlength=len(tokens))
        return out

    def texts(self, texts: list[str]) -> np.ndarray:
        split = [t.split() for t in texts]
        if len(self.at) > KEPT_WORDS:
            self.at.clear()
        new = list({w for words in split for w in words if w not in self.at and len(w) <= LONGEST_KEPT})
        if new:
            need = len(self.at) + len(new)
            if need > len(self.rows):
                self.rows = np.vstack([self.rows[: len(self.at)], np.zeros((2 * need - len(self.at), self.rows.shape[1]))])
            self.rows[len(self.at) : need] = self._score(new)
            self.at.update(zip(new, range(len(self.at), need), strict=True))
        out = np.zeros((len(texts), len(self.langs) + 1))
        get = self.at.get
        for k, words in enumerate(split):
            places = [get(w, -1) for w in words]
            index = np.array(places, np.int64)
            out[k] = self.rows[index[index >= 0]].sum(axis=0)
            if -1 in places:
                out[k] += self._score([w for w, p in zip(words, places, strict=True) if p < 0]).sum(axis=0)
        return out


@dataclass
class Identifier:
    langs: list[str]
    path: str = ""
    sharpness: float = 8.0
    limits: dict[str, float] = field(default_factory=dict)

    def entropies(self, docs: DataFrame, text_col: str, *keep: str) -> DataFrame:
        """`keep` columns, bits per character for each language (in order of name), and number of characters with marks."""
        path, langs = self.path, len(self.langs)

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            scorer = _scorer(path)
            for batch in slices(batches, len(keep)):
                sums = scorer.texts([t.as_py() or "" for t in batch.column(len(keep))])
                chars = sums[:, -1]
                bits = -sums[:, :-1] / np.maximum(chars, 1)[:, None]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1) * langs, pa.int32()), pa.array(bits.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), lists, pa.array(chars.astype(np.int64))], [*keep, "bits", "chars"])

        kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
        return docs.select(*keep, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, f"{kinds}, bits array<double>, chars long")

    def predict(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """id, lang_pred, score, bits_per_char, rejected."""
        if not self.langs:
            return docs.select(id_col, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits_per_char"), F.lit(True).alias("rejected"))
        langs = F.array(*[F.lit(x) for x in self.langs])
        limits = F.array(*[F.lit(float(self.limits.get(x, 1e9))) for x in self.langs])
        out = self.entropies(docs, text_col, id_col)
        best = F.array_min("bits")
        at = F.array_position("bits", best).cast("int")
        spread = F.aggregate("bits", F.lit(0.0), lambda acc, b: acc + F.exp(F.lit(-self.sharpness) * (b - best)))
        some = F.col("chars") > 0
        return out.select(
            id_col, F.when(some, F.element_at(langs, at)).otherwise("und").alias("lang_pred"), F.when(some, 1 / spread).otherwise(0.0).alias("score"),
            F.when(some, best).alias("bits_per_char"), F.when(some, best > F.element_at(limits, at)).otherwise(True).alias("rejected"),
        )


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Identifier:
    """Learns from all rows given; the caller leaves out what is held out."""
    scratch = Scratch(docs.sparkSession, "langid")
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    total = rows.count()
    share = min(0.1, CALIBRATION_ROWS / max(total, 1))
    # equal texts lie on the same side
    rows = rows.withColumn("unseen", F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000))
    alone = scratch.table(rows.groupBy("lang").agg(F.min("unseen").alias("alone")).where("alone").select("lang"), "alone")
    learned = rows.where("NOT unseen").unionByName(rows.where("unseen").join(alone, "lang", "left_semi"))
    grams = scratch.table(gram_counts(learned, "text", "lang"), "grams")
    model = scratch.table(fit(grams), "model")
    langs = [r[0] for r in model.select("lang").distinct().orderBy("lang").collect()]  # a name for each language
    out = Identifier(langs, scratch.last)
    if langs:
        fold = out.entropies(rows.where("unseen"), "text", "lang").where("chars > 0")
        _calibrate(out, fold.toPandas())  # about CALIBRATION_ROWS rows of one number per language
    return out


def _calibrate(model: Identifier, seen) -> None:
    langs = model.langs
    if not len(seen):
        return
    bits = np.stack(seen["bits"].to_list())
    truth = np.array([langs.index(x) if x in langs else -1 for x in seen["lang"]])
    bits, truth = bits[truth >= 0], truth[truth >= 0]
    if not len(truth):
        return
    grid = 2.0 ** np.arange(-1, 6, 0.5)
    losses = []
    for sharp in grid:
        z = -sharp * (bits - bits.min(axis=1, keepdims=True))
        losses.append(-np.mean(z[np.arange(len(z)), truth] - np.log(np.exp(z).sum(axis=1))))
    model.sharpness = float(grid[int(np.argmin(losses))])
    for k, lang in enumerate(langs):
        own = bits[truth == k, k]
        if len(own):
            model.limits[lang] = float(np.quantile(own, REJECT_QUANTILE)) + 0.25


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: id, held_out, lang_pred, score, bits_per_char, rejected. Learns from rows that aren't held out."""
    model = train(docs.where(~held_out(F.col(id_col))), id_col, text_col, lang_col)
    out = model.predict(docs.select(id_col, text_col), id_col, text_col)
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score", "bits_per_char", "rejected")
