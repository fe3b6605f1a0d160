"""Rows without an id, with a shared id, with id -1: operators and stages know rows by id and text. Stages against brute force."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import bpe, common, compact_windows, decontaminate, exact_dedup, jaccard_join, queries, sharding, toxicity
from tests.llm.test_edges import LOWER, _brute_hits, _shingles, prose, rows, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def table(spark, pairs):
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(pairs)], SCHEMA).repartition(3)


def test_exact_groups_of_shared_and_null_ids(spark):
    a, b, c = "a" * 256 + "tail", "b" * 256 + "tail", "c" * 260
    got = rows(exact_dedup.exact_groups(table(spark, [(5, a), (5, b), (1, a), (2, b), (None, c), (None, c), (-1, "x"), (-1, "X"), (7, "y"), (None, "y")])))
    key = lambda r: (r["text_sha256"][:6], str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"])
    sha = lambda t: hashlib.sha256(t.translate(LOWER).encode()).hexdigest()[:6]
    want = [(sha(a), "5", "5", 2, True), (sha(a), "1", "5", 2, False), (sha(b), "5", "5", 2, True), (sha(b), "2", "5", 2, False), (sha(c), "None", "None", 2, True), (sha(c), "None", "None", 2, False)]
    want += [(sha("x"), "-1", "-1", 2, True), (sha("x"), "-1", "-1", 2, False), (sha("y"), "7", "7", 2, True), (sha("y"), "None", "7", 2, False)]
    assert sorted(map(key, got)) == sorted(want)
    left = rows(exact_dedup.drop_copies(table(spark, [(5, a), (5, b), (1, a), (None, c), (None, c), (5, a)])))
    assert sorted((str(r["doc_id"]), r["text"][0]) for r in left) == [("5", "a"), ("5", "b"), ("None", "c")]


def near(text, k=60):
    w = text.split()
    w[k] = "zzzz"
    return " ".join(w)


def test_jaccard_of_shared_and_null_ids(spark):
    p, q, r, s = (prose(k, 120) for k in range(20, 24))
    docs = table(spark, [(None, p), (None, q), (3, near(p)), (4, near(q)), (-1, r), (9, r), (9, s), (2, near(s)), (None, None)])
    got = defaultdict(list)
    for x in rows(jaccard_join.jaccard_join(docs)):
        got[x["doc_id"]].append((x["text_id"], x["class_id"], x["n_links"], x["keeps"]))
    assert sorted(got[None], key=str) == sorted([(None, 3, 1, False), (None, 4, 1, False), (None, None, 0, True)], key=str)
    assert got[3] == [(3, 3, 1, True)] and got[4] == [(4, 4, 1, True)] and got[-1] == [(-1, -1, 1, True)] and got[2] == [(2, 2, 1, True)]
    assert sorted(got[9]) == [(-1, -1, 1, False), (9, 2, 1, False)]
    kept = rows(jaccard_join.drop_near_copies(docs))
    assert sorted((str(x["doc_id"]), (x["text"] or "")[:5]) for x in kept) == sorted([("3", p[:5]), ("4", q[:5]), ("-1", r[:5]), ("2", s[:5]), ("None", "")])
    twice = rows(jaccard_join.drop_near_copies(table(spark, [(1, p), (1, p), (None, q), (None, q)])))
    assert sorted(str(x["doc_id"]) for x in twice) == ["1", "None"]


def test_recall_of_the_join_on_texts(spark):
    rng = np.random.default_rng(5)
    pairs, want = [], 0
    for k in range(300):
        w = prose(1000 + k, 150).split()
        other = list(w)
        for at in rng.choice(150, 3, replace=False):
            other[at] = f"q{k}x{at}"
        a, b = " ".join(w), " ".join(other)
        x, y = _shingles(a), _shingles(b)
        if len(x & y) >= 0.8 * len(x | y):
            want += 1
            pairs += [(2 * k, a), (2 * k + 1, b)]
    found = jaccard_join.jaccard_join(table(spark, pairs)).where("n_links = 1").count()
    assert want > 100 and found >= 2 * want * 0.995


def test_passages_of_shared_and_null_ids(spark):
    p, q = prose(31, 60), prose(32, 60)
    docs = table(spark, [(None, p + " " + prose(33, 40)), (None, q + " " + prose(34, 40)), (7, prose(35, 30) + " " + p), (7, prose(36, 30) + " " + q), (-1, p), (8, prose(37, 90))])
    got = rows(compact_windows.repeated_passages(docs))
    spans = sorted((str(r["doc_id"]), r["n_words"], [(s["first"], s["past"]) for s in r["spans"]], str(r["class_id"])) for r in got)
    assert spans == sorted([("None", 100, [(0, 60)], "-1"), ("None", 100, [(0, 60)], "7"), ("7", 90, [(30, 90)], "-1"), ("7", 90, [(30, 90)], "7"), ("-1", 60, [(0, 60)], "-1"), ("8", 90, [], "8")])


def test_shared_signatures_beyond_what_workers_hold(spark, monkeypatch):
    monkeypatch.setattr(compact_windows, "HELD_KEYS", 0)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    p = prose(41, 70)
    got = rows(compact_windows.repeated_passages(table(spark, [(1, p + " " + prose(42, 50)), (2, prose(43, 20) + " " + p)])))
    assert {r["doc_id"]: [(s["first"], s["past"]) for s in r["spans"]] for r in got} == {1: [(0, 70)], 2: [(20, 90)]}


def test_a_rejected_row_takes_no_other_row_along(spark):
    bad, mine = prose(51, 60), prose(52, 60)
    docs = table(spark, [(None, bad), (None, mine), (None, None), (3, bad), (3, mine)])
    items = spark.createDataFrame([(1, bad)], "item_id long, text string")
    assert sorted((str(r["doc_id"]), r["text"]) for r in rows(decontaminate.drop_contaminated(docs, items)) if r["text"]) == [("3", mine), ("None", mine)]
    rejected = docs.where(F.col("text") == bad).select(*common.row_key("doc_id", "text"))
    assert common.without(docs, rejected, "doc_id", "text").count() == 3


def test_shards_equal_a_plain_feistel(spark):
    n, shards, seed = 3001, 16, 20260101
    a, b = sharding.sides(n)
    rnd = lambda v, key, m: (lambda h: (h - (1 << 64) if h >> 63 else h) % m)(xxhash.xxh64(int(key).to_bytes(8, "little", signed=True), seed=xxhash.xxh64(int(v).to_bytes(8, "little", signed=True), seed=42).intdigest()).intdigest())

    def once(x):
        left, right = divmod(x, b)
        for i in range(sharding.ROUNDS):
            if i % 2 == 0:
                left = (left + rnd(right, i + seed, a)) % a
            else:
                right = (right + rnd(left, i + seed, b)) % b
        return left * b + right

    def walk(x):
        x = once(x)
        while x >= n:
            x = once(x)
        return x

    shard, slot = sharding.place(F.col("id"), n, shards, seed)
    got = {r["id"]: (r["shard"], r["slot"]) for r in spark.range(n).select("id", shard.alias("shard"), slot.alias("slot")).collect()}
    assert got == {x: (walk(x) % shards, walk(x) // shards) for x in range(n)}


def test_scan_equals_a_plain_search(spark):
    rng = np.random.default_rng(6)
    scores = toxicity.Scores(shift={"wbad": 3.0, "wworse": 4.5, "wgood": -1.0}, plain=-0.4, rate=1.2, log_k=0.3, weights=(-2.0, 0.7, 0.1))
    vocabulary = ["bad", "worse", "good", "other", "thing"]
    texts = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 40)), p=[0.1, 0.1, 0.3, 0.3, 0.2])) for _ in range(60)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in rows(toxicity.scan(docs, scores, "text", "doc_id")):
        x = [{"bad": 3.0, "worse": 4.5, "good": -1.0}.get(w, -0.4) for w in (texts[r["doc_id"]] or "").split()]
        best = max((sum(x[i:j]) for i in range(len(x)) for j in range(i + 1, len(x) + 1)), default=0.0)
        best = max(best, 0.0)
        assert r["best"] == pytest.approx(best) and r["tokens"] == len(x) and r["total"] == pytest.approx(sum(x))
        norm = 1.2 * best - math.log(max(len(x), 1)) - 0.3
        z = -2.0 + 0.7 * min(40, max(-10, norm)) + 0.1 * max(-1, min(1, sum(x) / max(len(x), 1) * 10))
        assert r["probability"] == pytest.approx(1 / (1 + math.exp(-z)))
        for s in r["passages"]:
            assert s["score"] == pytest.approx(sum(x[s["first"] : s["past"]])) and s["p_value"] <= toxicity.SIGNIFICANT
        assert bool(r["passages"]) == (1 - math.exp(-math.exp(-norm)) <= toxicity.SIGNIFICANT)


def test_counts_equal_a_counter(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "HELD_COUNTS", 5)
    texts = [("bad Bad word", 1, 0), ("word other ½ other", 0, 1), (None, 1, 0), ("word", 0, 0)]
    got = {(r["fold"], r["level"]): (r["toxic"], r["other"], r["docs"]) for r in rows(toxicity.count_tokens(spark.createDataFrame(texts, "text string, y int, fold int"), "text", "y", "fold"))}
    want = defaultdict(lambda: [0.0, 0.0, 0])
    for text, y, fold in texts:
        n = Counter(lv for w in (text or "").lower().replace("½", "").split() for lv in toxicity._levels(w))
        total = len((text or "").replace("½", "").split())
        for lv, k in [*n.items(), *([("", total)] if total else [])]:
            want[fold, lv][0 if y else 1] += k if lv == "" else 1 + math.log(k)
            want[fold, lv][2] += 1
    assert {k: tuple(v) for k, v in got.items()} == {k: tuple(v) for k, v in want.items()}


def test_equal_texts_with_different_labels_have_one_outcome(spark):
    docs = spark.createDataFrame([(k, "vile words here" if k % 2 else f"plain text {k}") for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 2 and k % 3 == 0)) for k in range(60)], "doc_id long, toxic int")
    scores = [sorted((r["doc_id"], round(r["score"], 9)) for r in rows(toxicity.score_toxicity(docs.repartition(n), labels))) for n in (2, 5)]
    assert scores[0] == scores[1]


def test_the_pipeline_equals_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    leak, line = prose(61, 40), "Read more on our site"
    pairs = [(k, f"{line}\n{prose(70 + k, 60)}\nown {k}") for k in range(12)]
    pairs += [(20, pairs[0][1]), (21, near(pairs[1][1].replace("\n", " \n ")).replace(" \n ", "\n")), (22, prose(90, 30) + " " + leak), (None, f"{line}\n{prose(91, 60)}"), (None, None), (23, ""), (None, prose(92, 20) + " " + leak), (23, prose(93, 50))]
    docs = table(spark, pairs)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(4, 1), (5, 0), (6, 0)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    items = [(1, leak)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    # toxicity as its own report has it
    scored = rows(toxicity.score_toxicity(docs.select("doc_id", "text"), spark.read.parquet(str(tmp_path / "labels.parquet"))))
    assert len(scored) == len(pairs)
    stages = dict(corpus_pipeline.STAGES)
    left = [(r["doc_id"], r["text"], r["source"]) for r in rows(stages["toxicity"](spark, docs, str(tmp_path)))]
    assert len(left) == sum(not r["predicted"] for r in scored)
    # lines: on three sites at least
    sites = defaultdict(set)
    norm = lambda x: x.strip(" \t\r").translate(LOWER)
    for _, t, s in left:
        for x in (t or "").split("\n") if t is not None else []:
            if any(c.isalnum() for c in x):
                sites[norm(x)].add(s)
    clean = [(i, None if t is None else "\n".join(x for x in t.split("\n") if len(sites.get(norm(x), ())) < 3)) for i, t, _ in left]
    # near copies: components of all pairs, the smallest id stays
    sets, group = [_shingles(t) for _, t in clean], list(range(len(clean)))
    for x in range(len(clean)):
        for y in range(x):
            if sets[x] and sets[y] and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]) - 1e-9:
                group = [group[y] if g == group[x] else g for g in group]
    members = defaultdict(list)
    for g, (i, t) in zip(group, clean, strict=True):
        members[g].append((i is None, i or 0, t))
    unique = [(None if m[0] else m[1], m[2]) for ms in members.values() for m in ([min(ms, key=lambda m: m[:2])] if len(ms) > 1 else ms)]
    kept = [(i, t) for i, t in unique if not _brute_hits(t, items)[1]]
    lib = Tokenizer.from_file(queries.vocabulary(queries.BYTE_BPE))
    want = sorted((str(i), len(ids := lib.encode(t or "", add_special_tokens=False).ids), ids) for i, t in kept)
    got = rows(corpus_pipeline.run(spark, str(tmp_path)))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids"]) for r in got) == want and words(line)


def test_long_texts_and_slices(spark):
    texts = ["word " * 60_000, "", None, "x" * 300_000, *["a b c"] * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r for r in rows(bpe.encode_stage(docs, queries.vocabulary(queries.BYTE_BPE)))}
    assert len(got) == len(texts) and all(len(r["ids"]) == r["n_tokens"] and r["round_trips"] for r in got.values())
