"""Toxicity: maximum-scoring segments of token log-odds.

Token log-odds. A token's share of toxic use is estimated from labelled training rows with Dirichlet (for two classes: beta)
priors in a chain: all tokens, then the token's first 3, 5 and 7 letters, then the token itself; each level is the prior mean
of the next, with `PRIOR` pseudo-counts, and a level counts only where it differs from its prior mean by `LEAST_Z` standard
errors, so rare and unseen tokens fall back to what they begin with. A token's score is the
log of p(token | toxic) / p(token | other).

Segments. The linear-time scan of Ruzzo and Tompa finds all maximal-scoring segments of a text. Scores of segments by chance
follow an extreme-value law in the logarithm of the text's length; its two parameters are fitted on non-toxic training rows
that the log-odds haven't seen, and a segment is significant if its p-value under that law is at most `SIGNIFICANT`. A logistic
curve over the best segment's normalised score and the text's mean gives the score of the text.

Training takes at most about `MAX_ROWS` labelled rows (a documented bound for a classifier, chosen by hash of the id); the
log-odds table reaches the driver, with tokens of fewer than `MIN_DOCS` rows left to their prefixes. All texts are scored whole.

Nulls: null and empty texts get the score of a text without tokens; rows without a label or an id aren't learned from; of several
labels of an id, and of the labels of equal texts, the largest counts. Repeated rows give repeated results. An empty table gives an empty result; without toxic and other
training rows every score is the share of toxic rows, or 0. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import Memo
from tessera.llm.common import Scratch, letter_runs, row_key, slices, without

MAX_ROWS = 40_000
PRIOR, MIN_DOCS, PREFIXES = 4.0, 4, (3, 5, 7)
SIGNIFICANT = 0.01
#: A level is kept where its log-odds differ from its prior's by this many standard errors.
LEAST_Z = 4.0
#: Counts that a worker holds before it hands them on.
HELD_COUNTS = 100_000


def held_out(id_col: Column, folds: int = 5, fold: int = 0) -> Column:
    return _fold(id_col, folds) == fold


def _fold(id_col: Column, folds: int) -> Column:
    return F.pmod(F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")), F.lit(folds))


def _levels(word: str) -> list[str]:
    """Prefixes (marked by their length) and the word itself."""
    return [f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n] + [f"w{word}"]


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, sum) by the scan of Ruzzo and Tompa, in linear time."""
    found: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum after
    total = 0.0
    for i, x in enumerate(scores):
        before, total = total, total + x
        if x <= 0:
            continue
        start, left, right = i, before, total
        while found:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= right:
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
        found.append((start, i + 1, left, right))
    return [(a, b, after - before) for a, b, before, after in found]


@dataclass
class Scores:
    """Log-odds of tokens by level, and the law of chance."""

    base: float = 0.0  # logit of the toxic share of all tokens
    prior: float = 0.0
    shift: dict[str, float] = field(default_factory=dict)  # log-odds at a level, where counted
    rate: float = 1.0  # lambda
    log_k: float = 0.0
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)
    #: What a token without counts at any level scores.
    plain: float = 0.0

    def token(self, word: str) -> float:
        best = self.plain
        get = self.shift.get
        for level in _levels(word):
            value = get(level)
            if value is not None:
                best = value
        return best

    def stretch(self, text: str) -> float:
        """Sum over the letter runs of a stretch without white space."""
        return sum(self.token(w) for w in letter_runs().findall(text.lower()))

    def significance(self, segment: float, tokens: int) -> float:
        """Normalised score; exp(-exp(-x)) is the chance of a lower one."""
        return self.rate * segment - math.log(max(tokens, 1)) - self.log_k

    def p_value(self, segment: float, tokens: int) -> float:
        return -math.expm1(-math.exp(-min(700.0, max(-700.0, self.significance(segment, tokens)))))

    def features(self, best: float, total: float, tokens: int) -> tuple[float, float, float]:
        return 1.0, min(40.0, max(-10.0, self.significance(best, tokens))), max(-1.0, min(1.0, total / max(tokens, 1) * 10))

    def probability(self, best: float, total: float, tokens: int) -> float:
        z = sum(w * x for w, x in zip(self.weights, self.features(best, total, tokens), strict=True))
        return 1 / (1 + math.exp(-min(700.0, max(-700.0, z))))


def count_tokens(train: DataFrame, text_col: str, label_col: str, fold_col: str) -> DataFrame:
    """(fold, level, toxic, other, docs): damped counts of tokens and prefixes in labelled rows."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        find = letter_runs().findall
        kinds = (pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.int64())

        def rows(sums: dict[tuple[int, str], list[float]]):
            columns = zip(*((*k, *v) for k, v in sums.items()), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["fold", "level", "toxic", "other", "docs"])

        sums: dict[tuple[int, str], list[float]] = {}
        for batch in slices(batches, 0):
            for text, label, fold in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words: dict[str, int] = defaultdict(int)
                for word in find((text or "").lower()):
                    words[word] += 1
                counts: dict[str, int] = defaultdict(int)
                for word, n in words.items():
                    for level in _levels(word):
                        counts[level] += n
                    counts[""] += n
                for level, n in counts.items():
                    held = sums.get((fold, level))
                    if held is None:
                        held = sums[fold, level] = [0.0, 0.0, 0]
                    held[0 if label else 1] += n if level == "" else 1 + math.log(n)
                    held[2] += 1
                if len(sums) >= HELD_COUNTS:
                    yield rows(sums)
                    sums = {}
        if sums:
            yield rows(sums)

    counted = train.select(text_col, F.col(label_col).cast("int"), F.col(fold_col).cast("int")).mapInArrow(run, "fold int, level string, toxic double, other double, docs long")
    return counted.groupBy("fold", "level").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.sum("docs").alias("docs"))


def log_odds(table) -> Scores:
    """Scores from an Arrow table of (level, toxic, other), the levels that are counted; the level '' counts all tokens."""
    out = Scores()
    counts = {k: (t, o) for batch in table.to_batches(16_384) for k, t, o in zip(*(batch.column(c).to_pylist() for c in ("level", "toxic", "other")), strict=True)}
    counts.pop("", None)
    toxic, other = (sum(v[j] for k, v in counts.items() if k[0] == "w") for j in (0, 1))
    if toxic <= 0 or other <= 0:
        return out
    share = toxic / (toxic + other)
    out.base = math.log(share / (1 - share))
    rates: dict[str, float] = {}
    # shorter prefixes first, so that each level finds its prior
    for level in sorted(counts, key=lambda k: (k[0] == "w", k[0])):
        word = level[1:]
        mean = share
        for n in PREFIXES:
            if len(word) >= n and (level[0] == "w" or n < int(level[0])):
                mean = rates.get(f"{n}{word[:n]}", mean)
        t, o = counts[level]
        rates[level] = (t + PRIOR * mean) / (t + o + PRIOR)
        shift = math.log(rates[level] / (1 - rates[level])) - out.base
        held = math.log(mean / (1 - mean)) - out.base
        error = math.sqrt(1 / (t + PRIOR * mean) + 1 / (o + PRIOR * (1 - mean)))
        if abs(shift - held) >= LEAST_Z * error:
            out.shift[level] = shift
        else:
            rates[level] = mean
    return out


class Reader:
    """Scans texts with one table of scores."""

    def __init__(self, scores: Scores):
        self.scores = scores
        self.known = Memo(scores.stretch, 200_000)

    def scan(self, text: str) -> tuple[np.ndarray, float, float]:
        """Scores of the stretches between white space, the best segment's score and the sum of all."""
        values = np.fromiter(map(self.known.__getitem__, text.split()), float)
        if not len(values):
            return values, 0.0, 0.0
        sums = np.concatenate([[0.0], np.cumsum(values)])
        return values, float((sums - np.minimum.accumulate(sums)).max()), float(sums[-1])

    def passages(self, values: np.ndarray, best: float) -> list[tuple[int, int, float, float]]:
        """Significant segments: first and past-last word, score, p-value."""
        if self.scores.p_value(best, len(values)) > SIGNIFICANT:
            return []
        out = ((a, b, s, self.scores.p_value(s, len(values))) for a, b, s in maximal_segments(values.tolist()))
        return [x for x in out if x[3] <= SIGNIFICANT]


def _fit_chance(scores: Scores, best: np.ndarray, tokens: np.ndarray) -> None:
    """Moments of the extreme-value law: best * rate - ln(tokens) - log_k is Gumbel."""
    keep = (tokens > 0) & (best > 0)
    if keep.sum() < 10:
        return
    s, logs = best[keep], np.log(tokens[keep])
    rate = 1.0
    for _ in range(25):  # the length's share of the mean depends on the rate
        spread = (s - logs / rate).std()
        rate = 0.5 * rate + 0.5 * min(50.0, max(0.02, math.pi / (math.sqrt(6) * max(spread, 1e-6))))
    scores.rate = float(rate)
    scores.log_k = float(rate * (s - logs / rate).mean() - 0.5772156649)


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1e-2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, w))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5) -> Scores:
    """Learns from all labelled rows given; the caller leaves out what is held out."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("known_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    total = known.count()
    share = min(1.0, MAX_ROWS / max(total, 1))
    few = scratch.table(known.where(F.pmod(F.xxhash64("known_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1), "labels")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(few, F.col("id") == F.col("known_id"))
    # copies would speak for each other in the fold that must be unseen: equal texts are one row of one fold
    rows = rows.groupBy("text").agg(F.max("toxic").alias("_toxic"))
    rows = scratch.table(rows.withColumn("_fold", F.pmod(F.xxhash64("text"), F.lit(folds)).cast("int")), "rows")
    counts = scratch.table(count_tokens(rows, "text", "_toxic", "_fold"), "counts")
    by_level = lambda df: df.groupBy("level").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.sum("docs").alias("docs")).where(F.col("docs") >= MIN_DOCS).select("level", "toxic", "other").toArrow()
    # the law of chance and the curve are fitted on a fold that the log-odds of `part` haven't seen
    part = log_odds(by_level(counts.where("fold <> 0")))
    seen = scan(rows.where("_fold = 0"), part, "text", "_toxic").select("_toxic", "best", "total", "tokens").toPandas()
    model = log_odds(by_level(counts))
    y = seen["_toxic"].to_numpy(float)
    _fit_chance(model, seen["best"].to_numpy()[y == 0], seen["tokens"].to_numpy()[y == 0])
    if 0 < y.sum() < len(y):
        x = np.array([model.features(b, t, n) for b, t, n in zip(seen["best"], seen["total"], seen["tokens"], strict=True)])
        model.weights = _fit_logistic(x, y)
    else:
        rate = float(y.mean()) if len(y) else 0.0
        model.weights = (math.log((rate + 1e-6) / (1 - rate + 1e-6)), 0.0, 0.0)
    return model


def scan(docs: DataFrame, scores: Scores, text_col: str, *keep: str) -> DataFrame:
    """`keep` columns, best segment, sum, tokens, probability and the significant passages."""
    held = docs.sparkSession.sparkContext.broadcast(scores)  # tokens of at least MIN_DOCS of at most MAX_ROWS rows

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        reader = Reader(held.value)
        passage = pa.struct([("first", pa.int32()), ("past", pa.int32()), ("score", pa.float64()), ("p_value", pa.float64())])
        kinds = (pa.float64(), pa.float64(), pa.int64(), pa.float64(), pa.list_(passage))
        names = [*keep, "best", "total", "tokens", "probability", "passages"]
        for batch in slices(batches, len(keep)):
            out: list[tuple] = []
            for text in batch.column(len(keep)):
                values, best, total = reader.scan(text.as_py() or "")
                spans = [dict(zip(("first", "past", "score", "p_value"), x, strict=True)) for x in reader.passages(values, best)]
                out.append((best, total, len(values), reader.scores.probability(best, total, len(values)), spans))
            made = (pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(keep))), *made], names)

    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    schema = kept + "best double, total double, tokens long, probability double, passages array<struct<first:int,past:int,score:double,p_value:double>>"
    return docs.select(*keep, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)


def _scanned(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """row_id, row_text and the scan of every row; learns from labelled rows that aren't held out."""
    seen = labels.where(~held_out(F.col(id_col)))
    model = train(docs, seen.select(id_col, label_col), id_col, text_col, label_col)
    return scan(docs.select(*row_key(id_col, text_col), F.col(text_col).alias("text")), model, "text", "row_id", "row_text")


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per document: id, held_out, score, predicted, n_passages, passages."""
    out = _scanned(docs, labels, id_col, text_col, label_col)
    predicted = (F.col("probability") >= 0.5).cast("int")
    return out.select(
        F.col("row_id").alias(id_col), held_out(F.col("row_id")).alias("held_out"), F.col("probability").alias("score"), predicted.alias("predicted"),
        F.size("passages").alias("n_passages"), "passages",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose text isn't predicted toxic. A row is known by its id and text, so a null or shared id takes no other row along."""
    bad = _scanned(docs, labels, id_col, text_col, "toxic").where("probability >= 0.5").select("row_id", "row_text")
    bad = Scratch(docs.sparkSession, "toxic").table(bad, "rows")  # written, so that its size decides how it is joined
    return without(docs, bad, id_col, text_col)
