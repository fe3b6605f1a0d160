"""Language models against a plain Kneser-Ney written out, and what counts as a letter."""

import math
from collections import Counter, defaultdict

import numpy as np

from tessera.llm import langid

MARK = langid.MARK


def brute(words):
    """p(last character | the three before), interpolated, of one language from its words."""
    counts = Counter()
    for w in words:
        marked = MARK * 3 + w + MARK
        counts.update(marked[k : k + 4] for k in range(len(marked) - 3))
    levels = {4: counts}
    for n in (3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    table = {}
    for n, c in levels.items():
        ones, twos = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
        total, kinds = Counter(), Counter()
        for g, v in c.items():
            total[g[:-1]] += v
            kinds[g[:-1]] += 1
        table[n] = c, d, total, kinds

    def p(gram):
        out = langid.UNKNOWN
        for n in (1, 2, 3, 4):
            c, d, total, kinds = table[n]
            g = gram[4 - n :]
            if total[g[:-1]]:
                out = max(c[g] - d, 0) / total[g[:-1]] + d * kinds[g[:-1]] / total[g[:-1]] * out
        return out

    return p


def test_models_equal_a_plain_kneser_ney_and_a_rare_language_keeps_its_grams(spark):
    texts = {"aa": ["alpha beta gamma delta epsilon", "Alpha beta, zeta? eta", "theta iota kappa alpha"] * 40, "bb": ["zwölf kühe größe straße"]}
    rows = [(lang, t) for lang, ts in texts.items() for t in ts]
    docs = spark.createDataFrame(rows, "lang string, text string")
    table = langid.Scratch(spark, "test")
    table.table(langid.fit(langid.gram_counts(docs, "text", "lang")), "model")
    models = langid.load(table.last)
    assert sorted(models) == ["aa", "bb"]
    rng = np.random.default_rng(1)
    letters = list(MARK + "abcdeghilmnoptzwösüß")
    for lang, ts in texts.items():
        p = brute([w for t in ts for w in langid.letter_runs().findall(t.lower())])
        grams = ["".join(rng.choice(letters, 4)) for _ in range(300)] + [MARK * 3 + "a", "alph", "lpha", "ölf" + MARK, "traß"]
        got = models[lang].log2p(langid._codes(grams, 4))
        assert np.allclose(got, [math.log2(p(g)) for g in grams])
        # probabilities of what may follow a context sum to one, less what is left for characters never seen
        follow = sorted({c for t in ts for c in t.lower()} | {MARK})
        assert 0.5 < sum(2.0 ** models[lang].log2p(langid._codes([MARK * 3 + c for c in follow], 4))) <= 1 + 1e-9


def test_only_letters_count_and_calibration_rows_are_unseen(spark):
    rng = np.random.default_rng(2)
    words = {"en": "the and not with this that which where house".split(), "de": "der die und nicht ein straße schön über haus".split()}
    rows = [(k, " ".join(rng.choice(words[lang], 30)), lang) for k in range(400) for lang in ("en", "de")]
    rows += [(5000, "только один", "ru"), (5001, None, "en"), (5002, "no language", None)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en", "ru"]
    asked = spark.createDataFrame([(1, "²½ Ⅻ 123"), (2, None), (3, ""), (4, "один"), (5, "½straße"), (6, "that house")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in model.predict(asked, "doc_id", "text").collect()}
    assert [got[k]["lang_pred"] for k in range(1, 7)] == ["und", "und", "und", "ru", "de", "en"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[1]["score"] == 0 and defaultdict(float, model.limits)["en"] > 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").where("held_out AND lang IS NOT NULL AND text IS NOT NULL").toPandas()
    assert (out["lang_pred"] == out["lang"]).mean() > 0.97
