"""What each operator once left out."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from prefmill.llm import quality, sharding, simhash_dedup
from test_brute_force import groups, words

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def near_copies(seed: int = 3, n: int = 90):
    """Texts whose copies differ in some places: 5-word likeness on both sides of 0.8."""
    r = random.Random(seed)
    base = [[f"w{r.randrange(4000)}" for _ in range(150)] for _ in range(6)]
    out = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.randrange(6)):
            w[r.randrange(len(w))] = f"new{i}"
        out.append(" ".join(w))
    return [*out, "", None, "one", "ONE", "a b c", "  "]


def jaccard(a, b):
    cut = lambda t: {tuple(w[i : i + 5]) for w in [words(t)] for i in range(max(1, len(w) - 4)) if w}
    a, b = cut(a), cut(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_pipeline_near_copies_at_least_0_8(spark, monkeypatch):
    texts = dict(enumerate(near_copies()))
    docs = spark.createDataFrame([(i, t, "en", "src1", 1) for i, t in texts.items()], DDL)
    want = groups(texts, lambda a, b: jaccard(texts[a], texts[b]) >= 0.8)
    got = {r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()}
    assert got == set(want.values())
    monkeypatch.setattr(simhash_dedup, "MOST", 8)
    assert {r["doc_id"]: r["component_id"] for r in simhash_dedup.similar_texts(docs).collect()} == want


def test_near_copies_with_passages_repeated(spark):
    """Likeness is of shingle sets: how often a passage is repeated says nothing, whatever it does to the hashes' sum."""
    r = random.Random(11)
    say = lambda k: [f"w{r.randrange(5000)}" for _ in range(k)]
    texts = {}
    for n in range(8):
        base, refrain = say(r.choice([40, 300])), say(r.choice([8, 30]))
        for times in (1, 2, 20, 200):
            w = list(base)
            for _ in range(r.choice([0, 1, 2, 8])):
                w[r.randrange(len(w))] = f"new{len(texts)}"
            texts[len(texts)] = " ".join(w + refrain * times)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    want = groups(texts, lambda a, b: jaccard(texts[a], texts[b]) >= 0.8)
    assert 8 <= len(set(want.values())) < 32
    got = {r["doc_id"]: r["component_id"] for r in simhash_dedup.similar_texts(docs).collect()}
    assert got == want
    # the vote of all shingles, repeats included, would be beyond any radius for some of these pairs
    far = [(simhash_dedup.fingerprint(texts[a], 5) ^ simhash_dedup.fingerprint(texts[b], 5)).bit_count() for a in texts for b in texts if a < b and want[a] == want[b]]
    assert max(far) > simhash_dedup.RADIUS_SIMILAR - 6


def test_only_members_of_a_group_go(spark):
    """Equal keys with different texts, repeated rows and null keys: rows go by key and text."""
    a, b, c = ("the first text of all " * 9, "a wholly different one stands here " * 9, "and a third, found nowhere else at all " * 9)
    rows = [(1, a, "x"), (5, a, "y"), (5, b, "z"), (5, b, "z"), (None, b, "n"), (None, c, "n"), (None, c, "n"), (None, None, "e"), (9, "", "e")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, stays string").repartition(4)
    got = sorted((str(r["doc_id"]), r["text"] or "") for r in simhash_dedup.keep_first(d).collect())
    assert got == sorted([("1", a), ("5", b), ("None", c), ("9", "")])
    big = spark.createDataFrame([((1 << 62) + 5, a), ((1 << 63) - 1, a), (-(1 << 63), b)], "doc_id bigint, text string")
    assert {r["doc_id"]: r["component_id"] for r in simhash_dedup.report(big).collect()} == {(1 << 62) + 5: (1 << 62) + 5, (1 << 63) - 1: (1 << 62) + 5, -(1 << 63): -(1 << 63)}
    named = spark.createDataFrame([("b", a), ("a", a), (None, a), (None, c)], "doc_id string, text string")
    assert {(r["doc_id"], r["component_id"]) for r in simhash_dedup.report(named).collect()} == {("b", "a"), ("a", "a"), (None, "a"), (None, None)}


@pytest.mark.parametrize("radius", [8, 22, 31, 32, 62])
def test_bit_sliced_distances_beyond_eight(radius):
    r = np.random.default_rng(radius)
    lanes = r.integers(0, 2**64, 200, dtype=np.uint64)
    start = np.array([0, 90])
    group = np.searchsorted(start, np.arange(200), "right") - 1
    q, lane = simhash_dedup.within(lanes, start, lanes, group, radius)
    want = {(i, j) for i in range(200) for j in range(200) if group[i] == group[j] and (int(lanes[i]) ^ int(lanes[j])).bit_count() <= radius}
    assert set(zip(q.tolist(), lane.tolist())) == want


def test_copies_that_fit_a_shard_stay_together(spark):
    # 10 % and 5 % of the rows, a shard's fair share is 20 %
    say = lambda i: "one group " * 8 if i % 10 == 0 else "the other group " * 5 if i % 20 == 1 else f"text {i:05} " * 7
    d = spark.createDataFrame([(i, say(i)) for i in range(3000)], "doc_id bigint, text string")
    rows = sharding.assign(d, shards=5, units=16, keep=False).collect()
    assert len({r["shard"] for r in rows if r["doc_id"] % 10 == 0}) == 1
    assert len({r["shard"] for r in rows if r["doc_id"] % 20 == 1}) == 1
    load = Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
    assert max(load.values()) < 1.02 * min(load.values())


def test_dictionaries_see_whole_texts(spark, monkeypatch):
    block = lambda i, k: f"{i:03}.{k:03}".ljust(512, "x")
    texts = {i: "".join(block(i, k) for k in range(40)) + "end" if i % 2 else block(i, 0) + "end" for i in range(60)}
    d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    y = spark.createDataFrame([(i, i % 4 // 2) for i in texts], "doc_id bigint, quality int")
    seen: list[bytes] = []
    train = quality.train_dictionary
    monkeypatch.setattr(quality, "train_dictionary", lambda t: seen.extend(t) or train(t))
    quality.fit(d, y)
    used = sorted(t.decode() for t in seen)
    assert len(used) > 10 and len(used) == len(set(used)) and set(used) <= set(texts.values())
    assert any(len(t) == 40 * 512 + 3 for t in used)
