"""Buckets of near copies that hang together are dealt as one group, and no link is lost."""

import numpy as np
import pytest

from tessera.llm import jaccard_join as jj
from tessera.llm.common import Scratch


def near_copies(clusters, size):
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(clusters):
        body = [f"{x:x}" for x in rng.integers(1 << 40, 1 << 50, 300)]
        for _ in range(size):
            w = list(body)
            for at in rng.integers(0, 300, int(rng.integers(0, 7))):
                w[at] = f"{int(rng.integers(1 << 40, 1 << 50)):x}"
            texts.append(w)
    return texts


@pytest.mark.parametrize("blocks", [1 << 17, 3000])
def test_links_are_those_of_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(jj, "LEAST_SHINGLES", blocks)
    monkeypatch.setattr(jj, "BLOCK_SHINGLES", 2 * blocks)
    held = []
    real = jj.dealt
    monkeypatch.setattr(jj, "dealt", lambda scratch, members: held.append((members.collect(), real(scratch, members))) or held[-1][1].cache())
    texts = near_copies(6, 12)
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_links"] for r in jj.jaccard_join(docs).collect()}
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in texts]
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9
    want = {a: sum(near(a, b) for b in range(len(texts)) if b != a) for a in range(len(texts))}
    assert got == want
    (members, sent), = held
    rows, numbers = sent.collect(), {r["number"] for r in members}
    assert sum(r["blocks"] for r in rows) < sum(r["blocks"] for r in members) / 2
    assert {r["number"] for r in rows} == numbers
    if blocks > 3000:
        assert len(rows) == len(numbers) and {r["band"] for r in rows} == {jj.GROUP}


def test_a_chain_of_buckets_stays_as_it_is_where_a_group_would_send_more(spark):
    scratch = Scratch(spark, "chain")
    long = jj.LEAST_SHINGLES // 2
    rows = [(0, k // 2, k, long, 1) for k in range(40)] + [(1, (k + 1) // 2, k, long, 1) for k in range(1, 39)]
    members = scratch.table(spark.createDataFrame(rows, "band int, key long, number long, n_shingles long, blocks int"), "members")
    assert sorted(tuple(r) for r in jj.dealt(scratch, members).select("band", "key", "number").collect()) == sorted(r[:3] for r in rows)
