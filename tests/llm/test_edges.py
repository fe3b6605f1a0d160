"""Every operator and stage over nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns; each held against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import bpe, compact_windows, decontaminate, exact_dedup, jaccard_join, langid, line_dedup, queries, sharding, token_files, toxicity

#: Columns of a pipeline's documents, and others with names that the operators use themselves.
EXTRA = ("id", "w", "key", "rep", "text_id", "row", "row_id", "row_text", "_id", "_th", "_bad", "_gone", "_n_lines", "_n_removed", "number", "class_id", "first", "kept", "sha", "line", "_text", "_toxic")
DDL = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} long" for c in EXTRA)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))


BASE = prose(1, 120)
PASSAGE = prose(2, 60)
TEXTS = [
    (1, None), (2, ""), (3, "  \n\n "), (4, BASE), (5, BASE.upper()), (6, BASE), (7, BASE.replace(BASE.split()[60], "zzzz")), (8, prose(3, 80) + " " + PASSAGE + " " + prose(4, 30)), (9, PASSAGE + "\n" + prose(5, 90)),
    (10, "one two three"), (11, "One, two; three!"), (12, "word " * 3000), (13, "x" * 20000), (14, "don't <|endoftext|>  café \U0001f600 日本語\t\x1c　 End\n"), (15, prose(6, 40)), (15, prose(6, 40)), (None, "no id at all here"), (16, "ÄÖ ß straße Ω"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if k % 2 else "de", f"src{k % 7}", len(t or ""), *([7] * len(EXTRA))) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DDL).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_bpe_equals_the_library(docs, empty):
    from tokenizers import Tokenizer

    path = queries.vocabulary(queries.BYTE_BPE)
    lib = Tokenizer.from_file(path)
    want = sorted((str(i), hashlib.sha256(",".join(map(str, lib.encode(t or "", add_special_tokens=False).ids)).encode()).hexdigest()) for i, t in TEXTS)
    got = rows(bpe.round_trip(docs, path))
    assert sorted((str(r["doc_id"]), r["ids_sha256"]) for r in got) == want and all(r["round_trips"] for r in got)
    assert rows(bpe.encode_stage(empty, path)) == []


def test_pair_merges_on_random_text():
    from tokenizers import Tokenizer

    path = queries.vocabulary(queries.BYTE_BPE)
    lib, own = Tokenizer.from_file(path), bpe.ByteBPE(path)
    rng = np.random.default_rng(7)
    alphabet = list("abcDE 019  \n\t'st.!é日\U0001f600　\x1c\x85") + ["the", " of", "'re", "<|endoftext|>"]
    for _ in range(300):
        text = "".join(rng.choice(alphabet, int(rng.integers(0, 25))))
        ids = lib.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids and own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_exact_groups(docs, empty):
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[(t or "").translate(LOWER)].append(i)
    key = lambda i: -1 if i is None else i
    want = sorted((key(i), key(max(g, key=key)), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)
    for widths in (exact_dedup.WIDTHS, (4, 8, 16)):  # narrow digits go through many rounds
        got = rows(exact_dedup.exact_groups(docs, widths=widths))
        assert sorted((key(r["doc_id"]), key(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == want
    assert rows(exact_dedup.exact_groups(empty)) == []


def test_shards_are_dealt_evenly(docs, empty, spark):
    got = rows(sharding.shard_rows(docs, 4))
    assert len(got) == len(TEXTS)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in TEXTS)
    assert rows(sharding.shard_rows(empty, 4)) == []


@pytest.mark.parametrize("n", [1, 2, 3, 50, 1000, 4999])
def test_the_permutation_is_one(spark, n):
    p = spark.range(n).select("id", sharding.walk(F.col("id"), n, 5).alias("p")).withColumn("back", sharding.walk(F.col("p"), n, 5, inverse=True))
    got = rows(p)
    assert sorted(r["p"] for r in got) == list(range(n)) and all(r["back"] == r["id"] for r in got)
    shard, slot = sharding.place(F.col("id"), n, 4, 5)
    again = spark.range(n).select("id", shard.alias("shard"), slot.alias("slot")).withColumn("row", sharding.row_at(F.col("shard"), F.col("slot"), n, 4, 5))
    assert again.where("row <> id").count() == 0


ITEMS = [(1, PASSAGE), (2, "One two three"), (3, None), (4, ""), (None, " ".join(BASE.split()[10:22])), (5, PASSAGE)]


def _brute_hits(text, items, n=10):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        b = words(body)
        for k in range(max(0, len(b) - n) + 1 if b else 0):
            win = b[k : k + n]
            for p in range(len(w) - len(win) + 1):
                if w[p : p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    found.add("" if item is None else str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


@pytest.mark.parametrize("small", [True, False])
def test_decontamination(docs, empty, spark, small, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    if not small:
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    want = sorted((str(i), *_brute_hits(t, ITEMS)) for i, t in TEXTS)
    got = rows(decontaminate.decontaminate(docs, items))
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in got) == want
    assert rows(decontaminate.decontaminate(empty, items)) == []
    none = decontaminate.decontaminate(docs, items.limit(0))
    assert none.where("contaminated").count() == 0 and none.count() == len(TEXTS)


def _shingles(text):
    w = words(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("block", [1 << 17, 64])
def test_jaccard_join(docs, empty, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    unique = {(-1 if i is None else i): _shingles(t) for i, t in TEXTS}
    ids = list(unique)
    root = {i: i for i in ids}
    degree = defaultdict(int)
    for a in ids:
        for b in ids:
            x, y = unique[a], unique[b]
            if a < b and x and y and len(x & y) >= 0.8 * len(x | y) - 1e-9:
                degree[a] += 1
                degree[b] += 1
                ra, rb = root[a], root[b]
                for k in ids:
                    if root[k] == max(ra, rb):
                        root[k] = min(ra, rb)
    for r in rows(jaccard_join.jaccard_join(docs)):
        i = -1 if r["doc_id"] is None else r["doc_id"]
        assert (-1 if r["class_id"] is None else r["class_id"]) == root[i]
        if i != 15:  # two rows of one id
            assert r["n_links"] == degree[i]
    assert rows(jaccard_join.jaccard_join(empty)) == []


def test_banding_reaches_its_recall():
    bands, r = jaccard_join.banding(0.8, 0.9995)
    assert 1 - (1 - 0.8**r) ** bands >= 0.9995 > 1 - (1 - 0.8**r) ** (bands - 1)


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 32])
def test_bit_packing_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1001, np.uint64).astype(np.uint32)
    data = token_files.pack(ids, width)
    assert len(data) == -(-1001 * width // 8) and (token_files.unpack(data, 1001, width) == ids).all()


def test_token_files(docs, empty, tmp_path, spark):
    from tokenizers import Tokenizer

    path = queries.vocabulary(queries.WORD_BPE)
    lib = Tokenizer.from_file(path)
    shards = token_files.write_shards(docs, f"file://{tmp_path}/s", path, 2, shards=3)
    got = {(r["doc_id"], r["start"]): r for r in rows(token_files.read_shards(spark, shards, with_ids=True))}
    start = 0
    for i, t in sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        r = got[i, start]
        assert r["ids"] == ids and r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    reader = token_files.ShardReader(shards[-1][3])
    every = reader.ids(0, reader.n)
    assert (reader.ids(5, 40) == every[5:45]).all()
    assert rows(token_files.write_and_read(empty, path)) == []


def test_line_dedup(docs, empty, spark):
    lines = ["Shared line", "own %d", "", " shared LINE \t\r", "--"]
    some = spark.createDataFrame([(k, "\n".join(lines) % k, f"s{k % 4}", 1) for k in range(8)] + [(8, None, "s1", 1), (9, "", "s2", 1), (10, "shared line", None, 1), (None, "shared line\nmine", None, 1), (None, "yours", None, 1)], "doc_id long, text string, source string, n_chars int")
    got = {r["doc_id"]: r for r in rows(line_dedup.clean_lines(some, 4, length_col="n_chars").where("doc_id IS NOT NULL"))}
    assert got[3]["text"] == "own 3\n\n--" and got[3]["n_chars"] == 9 and got[8]["text"] is None and got[9]["text"] == "" and got[10]["text"] == "" and got[9]["n_chars"] == 1
    assert {r["text"] for r in rows(line_dedup.clean_lines(some, 4).where("doc_id IS NULL"))} == {"mine", "yours"}
    report = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in rows(line_dedup.line_report(some, 4))}
    assert report[3] == (5, 2) and report[8] == (0, 0) and report[9] == (1, 0) and report[10] == (1, 1)
    assert rows(line_dedup.line_report(some, 5).where("n_removed > 0")) == []
    assert line_dedup.threshold(some, "source") == 3 and line_dedup.threshold(docs, "source") == 4  # three at least, half of seven
    many = spark.range(200).selectExpr("'x' AS text", "id % 50 AS source")
    assert line_dedup.threshold(many, "source") == line_dedup.MOST_SITES
    out = line_dedup.clean_lines(docs)
    assert out.columns == docs.columns and out.count() == len(TEXTS)
    assert rows(line_dedup.line_report(empty)) == []


def test_language_id(docs, empty, spark):
    de, en = "der die und nicht ein Straße schön über", "the and not with this that which where"
    train = spark.createDataFrame([(k, " ".join(np.random.default_rng(k).choice((de if k % 2 else en).split(), 30)), "de" if k % 2 else "en") for k in range(60)], "doc_id long, text string, lang string")
    model = langid.train(train)
    got = {r["doc_id"]: r for r in rows(model.predict(spark.createDataFrame([(1, "über die Straße"), (2, "where is that"), (3, None), (4, "123 --"), (5, "")], "doc_id long, text string"), "doc_id", "text"))}
    assert [got[k]["lang_pred"] for k in range(1, 6)] == ["de", "en", "und", "und", "und"] and all(0 <= r["score"] <= 1 for r in got.values())
    assert len(rows(langid.identify(docs))) == len(TEXTS)
    assert rows(langid.identify(empty)) == []


def test_maximal_segments():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x = rng.integers(-5, 6, int(rng.integers(0, 14))).astype(float).tolist()
        found = toxicity.maximal_segments(x)

        def brute(lo, hi, x=x):  # the best segment, then what lies left and right of it
            best = max(((sum(x[a:b]), -(b - a), -a) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0))
            if best[0] <= 0:
                return []
            a, b = -best[2], -best[2] - best[1]
            return [*brute(lo, a), (a, b, best[0]), *brute(b, hi)]

        assert sorted(found) == sorted(brute(0, len(x)))


def test_toxicity(docs, empty, spark):
    rng = np.random.default_rng(9)
    clean = [f"w{k}" for k in range(50)]
    clean = [prose(k, 1) for k in range(50)]

    def text(k):
        w = list(rng.choice(clean, 60))
        return " ".join(w if k % 4 else [*w[:30], "vileword", "vileword", "nasty", *w[30:]])

    d = spark.createDataFrame([(k, text(k)) for k in range(400)], "doc_id long, text string")
    lab = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)] + [(7, None)], "doc_id long, toxic int")
    got = rows(toxicity.score_toxicity(d, lab))
    held = [r for r in got if r["held_out"]]
    assert len(got) == 400 and np.mean([r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held]) > 0.95
    assert all(r["n_passages"] > 0 for r in held if r["predicted"])
    labels = spark.createDataFrame([(4, 1), (8, 0)], "doc_id long, toxic int")
    out = rows(toxicity.score_toxicity(docs, labels))
    assert len(out) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in out)
    assert len(rows(toxicity.score_toxicity(docs, labels.limit(0)))) == len(TEXTS)
    assert rows(toxicity.score_toxicity(empty, labels)) == []


def test_repeated_passages(docs, empty):
    got = rows(compact_windows.repeated_passages(docs))
    assert len(got) == len(TEXTS)
    by = {r["doc_id"]: r for r in got}
    assert by[8]["n_dup_words"] >= 60 and by[9]["n_dup_words"] >= 60 and by[8]["class_id"] == by[9]["class_id"] == 8
    assert by[4]["n_dup_words"] == 120 and by[6]["class_id"] == 4 and by[5]["class_id"] == 4
    for i in (1, 2, 3, 10, 11, 13, 14, 16, None):
        assert by[i]["n_passages"] == 0 and by[i]["class_id"] == i
    assert rows(compact_windows.repeated_passages(empty)) == []


def test_compact_windows_cover_each_subsequence_once():
    rng = np.random.default_rng(11)
    values = rng.integers(1, 40, 60, np.uint64) << np.uint64(40)  # with ties
    values[30] = 0
    l, c, r = compact_windows.windows(values, 4)
    found = list(zip(l.tolist(), c.tolist(), r.tolist(), strict=True))
    for a in range(60):
        for b in range(a + 3, 60):
            if (values[a : b + 1] == 0).any():
                continue
            least = a + int(values[a : b + 1].argmin())
            assert sum(x <= a and b <= z and a <= k <= b for x, k, z in found) == 1 and any(k == least and x <= a and b <= z for x, k, z in found)


def test_stages_keep_columns(docs, empty, spark, tmp_path):
    labels = spark.createDataFrame([(4, 1), (8, 0)], "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for start in (docs, empty):
        df = start
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            df = stage(spark, df, str(tmp_path))
            assert k == len(corpus_pipeline.STAGES) - 1 or df.columns == start.columns
        kept = {r["doc_id"] for r in rows(df)}
        assert (kept == set()) if start is empty else {1, 2, 3, 13, 14} <= kept and not kept & {5, 6, 7, 8, 9}
