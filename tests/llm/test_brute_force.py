"""Each operator against plain Python on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from prefmill.llm import (
    components,
    decontaminate,
    doc_fingerprints,
    hamming,
    licenses,
    maxent_lm,
    mixing,
    quality,
    sharding,
    simhash_dedup,
    substring_dedup,
    suffix_sort,
    token_counts,
)


def words(t):
    return (t or "").encode().lower().split()


def held(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds == 0


# -- near-duplicates ---------------------------------------------------------


def simhash(t):
    w = words(t)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(nodes, linked):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in nodes}


def test_simhash_groups(small):
    docs = {r["doc_id"]: r["text"] for r in small.collect()}
    fp = {k: simhash(t) for k, t in docs.items()}
    want = groups(fp, lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 4)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_dedup.report(small).collect()}
    assert got == {k: (f"{fp[k]:016x}", want[k]) for k in docs}


@pytest.mark.parametrize("most", [8, 2048])
def test_links_of_planted_fingerprints(spark, monkeypatch, most):
    """Chains, stars and pairs at exactly the radius, with buckets that must be cut into chunks."""
    monkeypatch.setattr(hamming.bucket_tasks, "__defaults__", (most,))
    r = random.Random(3)
    fps = set()
    for _ in range(30):
        x = r.getrandbits(64)
        fps.add(x)
        for _ in range(8):
            y = x
            for b in r.sample(range(64), r.choice([1, 4, 5, 6])):
                y ^= 1 << b
            fps.add(y)
            x = y if r.random() < 0.5 else x
    at = {x - (1 << 64) if x >> 63 else x: x for x in fps}
    want = groups(at, lambda a, b: (at[a] ^ at[b]).bit_count() <= 4)
    links = simhash_dedup.links(spark.createDataFrame([(x,) for x in at], "fp bigint"))
    got = {i: i for i in at} | {r["node"]: r["component"] for r in components.components(links).collect()}
    assert got == want


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_distances(radius):
    r = np.random.default_rng(5)
    lanes = r.integers(0, 2**64, 333, dtype=np.uint64)
    lanes[100:120] = lanes[50] ^ (np.uint64(1) << r.integers(0, 64, 20).astype(np.uint64))
    start = np.array([0, 40, 200])
    group = np.searchsorted(start, np.arange(333), "right") - 1
    q, lane = simhash_dedup.within(lanes, start, lanes, group, radius)
    want = {(i, j) for i in range(333) for j in range(333) if group[i] == group[j] and (int(lanes[i]) ^ int(lanes[j])).bit_count() <= radius}
    assert set(zip(q.tolist(), lane.tolist())) == want


def test_components_of_chains_and_stars(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(200 + r.randrange(40), 200 + r.randrange(40)) for _ in range(30)] + [(7, 7), (None, 3)]
    nodes = {x for e in edges if None not in e and e[0] != e[1] for x in e}
    pairs = {frozenset(e) for e in edges}
    want = groups(nodes, lambda a, b: frozenset((a, b)) in pairs)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == want


# -- document fingerprints ---------------------------------------------------


def test_edited_texts(small):
    docs = sorted((r["doc_id"], r["text"] or "") for r in small.collect())
    got = {r["doc_id"]: r for r in doc_fingerprints.report(small).collect()}
    prints = {k: doc_fingerprints.fingerprint(t) for k, t in docs}
    for i, (k, t) in enumerate(docs):
        k2, follower = docs[(i + 1) % len(docs)]
        half = len(t) // 2
        e = t[: len(t) - half] + follower[:half]
        r = got[k]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert r["fingerprint"] == prints[k].hex() and r["edited_fingerprint"] == doc_fingerprints.fingerprint(e).hex()
        assert r["near_next"] == pytest.approx(doc_fingerprints.likeness(prints[k], prints[k2]))
        as_int = {x: int.from_bytes(p, "little") for x, p in prints.items()}
        assert r["n_same"] == sum(as_int[x] == as_int[k] for x in as_int)
        assert r["n_near"] == sum(0 < (as_int[x] ^ as_int[k]).bit_count() <= doc_fingerprints.RADIUS for x in as_int)


@pytest.mark.parametrize("most", [4, 2048])
def test_neighbours_by_block_tables(spark, monkeypatch, most):
    monkeypatch.setattr(hamming.bucket_tasks, "__defaults__", (most,))
    r = random.Random(9)
    fps = []
    for _ in range(6):
        x = r.getrandbits(256)
        for _ in range(12):
            y = x
            for b in r.sample(range(256), r.choice([0, 3, 8, 9])):
                y ^= 1 << b
            fps.append(y)
    frame = spark.createDataFrame([(f"{x:064x}",) for x in fps], "fingerprint string")
    for row in doc_fingerprints.neighbours(frame).collect():
        x = int(row["fingerprint"], 16)
        assert row["n_same"] == fps.count(x)
        assert row["n_near"] == sum(0 < (x ^ y).bit_count() <= 8 for y in fps)


# -- substring dedup ---------------------------------------------------------


def removed(rows, width):
    seen, out = set(), {}
    for k, t in rows:
        b = (t or "").encode()
        covered = bytearray(len(b))
        for s in range(len(b) - width + 1):
            if b[s : s + width] in seen:
                covered[s : s + width] = b"\1" * width
            seen.add(b[s : s + width])
        runs = sum(1 for i in range(len(b)) if covered[i] and not (i and covered[i - 1]))
        rest = bytes(x for x, c in zip(b, covered) if not c)
        out[k] = (len(b), sum(covered), runs, hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize("hot", [6, 1 << 16])
def test_substring_dedup(small, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    want = removed(sorted((r["doc_id"], r["text"]) for r in small.collect()), 100)
    assert {r[0]: tuple(r)[1:] for r in substring_dedup.report(small).collect()} == want
    assert sum(x[1] for x in want.values()) > 0


@pytest.mark.parametrize("width", [20, 200])
def test_other_widths_and_two_levels(small, monkeypatch, width):
    monkeypatch.setattr(substring_dedup, "ONE_LEVEL", 0)
    monkeypatch.setattr(substring_dedup, "ANCHORS_PER_PART", 100)
    want = removed(sorted((r["doc_id"], r["text"]) for r in small.collect()), width)
    assert {r[0]: tuple(r)[1:] for r in substring_dedup.report(small, width=width).collect()} == want
    with pytest.raises(ValueError):
        substring_dedup.report(small, width=4)


def test_periodic_and_accented_texts(spark):
    texts = ["a" * 350, "ab" * 200, "é" * 120, "a" * 99, "x" * 100, "x" * 100, "é" * 120 + "!", "y" * 40 + "a" * 120]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r[0]: tuple(r)[1:] for r in substring_dedup.report(d).collect()} == removed(list(enumerate(texts)), 100)


@pytest.mark.parametrize("piece", [1 << 19, 700])
def test_stretches_that_repeat_themselves(spark, monkeypatch, piece):
    """Rules, padding and short patterns, within and between documents: found at once, and told by few records."""
    monkeypatch.setattr(substring_dedup, "CHUNK", piece)
    monkeypatch.setattr(substring_dedup, "LONGEST", 400)
    monkeypatch.setattr(substring_dedup, "ANCHORS_PER_PART", 40)
    r = random.Random(6)
    say = lambda k: "".join(r.choice("abcdefgh ") for _ in range(k))
    texts = ["-" * 5000, say(150) + "=" * 1500 + say(50) + "=" * 130 + say(90), "-" * 99 + say(30) + "-" * 260, "", None, "é-" * 600, "0123456789" * 90 + say(80)]
    texts += [say(70) + p * (900 // len(p)) + say(120) for p in ("xyz", " ", "the same words again and over ", "q" * 40 + "z", "A" * 60 + say(17))]
    texts += [texts[1], "-" * 4000 + "!"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    assert {x[0]: tuple(x)[1:] for x in substring_dedup.report(d).collect()} == removed(list(enumerate(texts)), 100)
    if piece > 700:
        left = [int((~known).sum()) for *_, known in substring_dedup.text_runs([b"-" * 5000])]
        assert left == [1]


def test_long_texts_in_pieces():
    r = random.Random(4)
    t = bytes(r.choice(b"abcd") for _ in range(5000))
    old = substring_dedup.CHUNK
    try:
        substring_dedup.CHUNK = 700
        small = sorted((int(a), int(n), int(h)) for d, at, size, hs, _ in substring_dedup.text_runs([t]) for a, n, h in zip(at, size, hs))
    finally:
        substring_dedup.CHUNK = old
    windows = [s for a, n, _ in small for s in range(a, a + n)]
    assert windows == list(range(len(t) - 99))


def test_many_windows_are_sorted_in_lots(monkeypatch):
    r = random.Random(3)
    parts = [bytes(r.choice(b"abc") for _ in range(130)) for _ in range(6)]
    body = []
    for _ in range(200):
        k = r.randrange(20)
        x = bytearray(r.choice(parts)[k : k + r.randrange(100, 111)])
        if r.random() < 0.3:
            x[r.randrange(len(x))] = 33
        body.append(bytes(x))
    group, ids, at = np.array([r.randrange(3) for _ in body]), np.arange(200), np.array([r.randrange(1000) for _ in body])
    first, want = {}, set()
    for i in range(200):
        for s in range(len(body[i]) - 99):
            k = (group[i], body[i][s : s + 100])
            if k in first:
                want.add((i, at[i] + s))
            first.setdefault(k, i)
    for most in (1 << 17, 100):
        monkeypatch.setattr(substring_dedup, "WINDOWS_PER_SORT", most)
        run, step, run1, step1 = substring_dedup.repeats(group, ids, at, body, 100)
        assert {(ids[r], at[r] + k) for r, k in zip(run, step)} == want
        assert len(run) + len(run1) == sum(len(b) - 99 for b in body) and len(run1) == len(first)
    assert want


def test_deep_shallow_sort():
    r = random.Random(1)
    for depth in (8, 40, 100):
        buf = bytes(r.choice(b"ab") if r.random() < 0.97 else r.randrange(256) for _ in range(700)) + bytes(120)
        start = np.array([r.randrange(600) for _ in range(90)])
        group = np.array([r.randrange(3) for _ in range(90)])
        order, cls = suffix_sort.sort_to_depth(np.frombuffer(buf, np.uint8), start, group, depth)
        key = [(group[i], buf[start[i] : start[i] + depth]) for i in order]
        assert key == sorted(key) and [a != b for a, b in zip(key[1:], key)] == np.diff(cls).astype(bool).tolist()


def test_blind_trie_orders_strings():
    r = random.Random(8)
    strings = [bytes(r.choice(b"ab") for _ in range(r.randrange(1, 9))) for _ in range(200)]
    trie = suffix_sort.BlindTrie(strings[0], 0)
    for i, s in enumerate(strings[1:], 1):
        trie.add(s, i)
    got = [[strings[i] for i in c] for c in trie.classes()]
    assert [c[0] for c in got] == sorted(set(strings)) and all(len(set(c)) == 1 for c in got)


# -- language model ----------------------------------------------------------


def test_lm_base_and_normalisation(small):
    docs = {r["doc_id"]: [*words(r["text"]), None] for r in small.collect()}
    train = [k for k in docs if not held(k, 10)]
    c = Counter(w for k in train for w in docs[k])
    n, v = sum(c.values()), len(c)
    got = {r["doc_id"]: r for r in maxent_lm.report(small).collect()}
    for k, tokens in docs.items():
        r = got[k]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(k, 10), len(tokens), sum(c[w] > 0 for w in tokens), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_lm_sums_to_one_and_learns(small):
    train = small.where(~maxent_lm.held_out("doc_id", 10))
    model, counts, _ = maxent_lm.fit(train)
    every = {bytes(r["w"]): r["n"] for r in counts.collect()}
    assert model.likelihoods == sorted(model.likelihoods) and model.likelihoods[-1] > model.likelihoods[0]
    scorer = maxent_lm.Scorer(model)
    v = scorer.v
    known = set(v.words)
    for one, two in ((0, 0), (1, 0), (5, 200), (255, 3)):
        h = np.array([one * maxent_lm.BUCKETS + two])
        scorer.histories(h)
        p = 10.0 ** scorer.table[h[0]].astype(float)
        total = p[0] + 10.0 ** scorer.unseen[h[0]]
        for i in range(len(v.words)):
            within = scorer.band[one, i] if i < maxent_lm.HEAD else v.within[i]
            total += p[v.cls[i]] * 10.0**within
        for w, n in every.items():
            if w not in known:
                k = v.hashed(w) % maxent_lm.RARES
                total += p[maxent_lm.RARE0 + k] * (1 - v.unseen) * (n + 0.1) / max(v.rare_mass[k], 0.1)
        # classes without words keep a little of the mass
        assert 0.9 < total <= 1 + 1e-6


def test_lm_context_weights(small):
    """Part by part against dictionaries: groups sum to 1, more met pairs with more text, answers equal what the weights say."""
    from prefmill.llm import context_weights

    train = small.where(~maxent_lm.held_out("doc_id", 10))
    model, _, contexts = maxent_lm.fit(train)
    v = model.vocabulary.prepare()
    texts = [(r["text"] or "").encode() for r in train.collect()]
    every: Counter[int] = Counter()
    met: Counter[tuple] = Counter()
    for t in texts:
        ws = t.lower().split()
        met.update((a, b) for a, b in zip([None, *ws], ws) if v.index[b] >= 0)
        for _, _, ids, history, _, _, _, previous in maxent_lm.sequences([t], v):
            every.update(maxent_lm.context_keys(v, model.bits, ids, history, previous)[1].tolist())
    got: Counter[int] = Counter()
    for r in contexts.collect():
        for k, c in zip(context_weights.unpack_keys(r["keys"]).tolist(), np.frombuffer(context_weights.unpack(r["counts"]), "<u4").tolist()):
            got[k] += c
        assert r["part"] < model.parts
    assert got == every and sum(got.values()) == sum(met.values()) and len(got) >= 0.95 * len(met)
    shares = maxent_lm.Shares(model)
    keys = np.array(sorted(got), np.uint64)
    part = context_weights.Part(keys, np.array([got[k] for k in keys.tolist()]), shares.share, shares.rank_class)
    n, rank_bits = len(v.words), context_weights.RANK_BITS
    for key in keys[:: max(1, len(keys) // 40)].tolist():
        cls = shares.rank_class[key & ((1 << rank_bits) - 1)]
        ranks = np.flatnonzero(shares.rank_class[:n] == cls).astype(np.uint64)
        words = np.uint64(key >> rank_bits << rank_bits) | ranks
        assert (shares.share(words) * 10.0 ** part(words)).sum() == pytest.approx(1, abs=1e-4)


def test_lm_context_weights_in_many_parts(small, monkeypatch):
    """Scores do not depend on the number of parts, lots and flushes but by rounding and discounts."""
    from prefmill.llm import context_weights

    monkeypatch.setattr(context_weights, "MOST_PARTS", 1)
    one = {r["doc_id"]: r["score"] for r in maxent_lm.report(small).collect()}
    monkeypatch.setattr(context_weights, "MOST_PARTS", 7)
    monkeypatch.setattr(context_weights, "PART_TOKENS", 100)
    many = {r["doc_id"]: r["score"] for r in maxent_lm.report(small).collect()}
    assert all(many[k] == pytest.approx(one[k], rel=0.05) for k in one)


# -- quality -----------------------------------------------------------------


def test_quality_held_out_accuracy(spark):
    r = random.Random(6)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))) for _ in range(200)]
    rows, labels = [], []
    for i in range(600):
        w = [r.choice(vocab) for _ in range(r.randrange(30, 80))]
        good = i % 4 != 0
        rows.append((i, " ".join(w if good else [x + r.choice(["***", "&&&", "$$$"]) for x in w])))
        labels.append((i, int(good)))
    d, y = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = {r["doc_id"]: r for r in quality.report(d, y).collect()}
    assert all(0 <= r["score"] <= 1 and r["held_out"] == held(k, 5) and r["predicted"] == int(r["score"] >= 0.3) for k, r in got.items())
    out = [k for k in got if got[k]["held_out"]]
    assert np.mean([got[k]["predicted"] == dict(labels)[k] for k in out]) > 0.97


def test_quality_ignores_held_out_labels(spark, small):
    y = spark.createDataFrame([(i, i % 3 % 2) for i in range(120)], "doc_id bigint, quality int")
    flipped = y.select("doc_id", (1 - y.quality).alias("q"), quality.held_out("doc_id").alias("h"), "quality").selectExpr("doc_id", "IF(h, q, quality) AS quality")
    a = {r["doc_id"]: r["score"] for r in quality.report(small, y).collect()}
    assert a == {r["doc_id"]: r["score"] for r in quality.report(small, flipped).collect()}


def test_quality_scores_in_plain_python(spark, small):
    """Every score from the dictionaries and the knots alone: whole texts, block by block."""
    import zstandard

    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(120)], "doc_id bigint, quality int")
    model = quality.fit(small, labels)
    assert model.bad and model.good and list(model.score) == sorted(model.score)
    kinds = [zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_AUTO) for d in (model.bad, model.good)]

    def size(data, kind):
        return len(zstandard.ZstdCompressor(level=1, dict_data=kind, write_content_size=False, write_dict_id=False, write_checksum=False).compress(data))

    def score(text):
        data = (text or "").encode()
        more = sum(size(data[i : i + 512], kinds[0]) - size(data[i : i + 512], kinds[1]) for i in range(0, len(data), 512))
        x = (more + model.rate * 64) / (len(data) + 64)
        pairs = list(zip(model.at, model.score))
        if x <= pairs[0][0]:
            return pairs[0][1]
        for (a, p), (b, q) in zip(pairs, pairs[1:]):
            if a <= x <= b:
                return q if b == a else p + (q - p) * (x - a) / (b - a)
        return pairs[-1][1]

    texts = {r["doc_id"]: r["text"] for r in small.collect()}
    for r in quality.report(small, labels).collect():
        assert r["score"] == pytest.approx(score(texts[r["doc_id"]]), abs=1e-9) and r["predicted"] == int(r["score"] >= 0.3)


def test_isotonic_is_monotone():
    r = np.random.default_rng(0)
    x = r.normal(size=400)
    at, score = quality.isotonic(x, (r.random(400) < 1 / (1 + np.exp(-3 * x))).astype(float), np.ones(400))
    assert at == sorted(at) and score == sorted(score)


# -- decontamination ---------------------------------------------------------


def best_substring(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for ch in text:
        prev, row[0] = row[0], 0
        for i, c in enumerate(item, 1):
            prev, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, prev + (c != ch))
        best = min(best, row[-1])
    return best


def test_decontamination_finds_all_within_budget(spark):
    r = random.Random(12)
    items = [" ".join("".join(r.choice("abcdef") for _ in range(r.randrange(2, 7))) for _ in range(18)) for _ in range(6)] + ["too short", "", "of middle length", "thirteen char"]
    docs = []
    for i in range(60):
        text = " ".join("".join(r.choice("abcdef") for _ in range(4)) for _ in range(40))
        if i % 2:
            x = list(items[r.randrange(6)])
            for _ in range(r.randrange(0, 12)):
                k = r.randrange(len(x))
                x[k : k + 1] = r.choice([[], ["z"], [x[k], "q"]])
            cut = r.randrange(len(text))
            text = text[:cut] + ", " + "".join(x).upper() + "! " + text[cut:]
        if i % 7 == 0:
            text = r.choice([text + " Of midddle-length", text + " thirteen-charr", text + " thirtoen chars", text + " off middle lenth", "Too-short; " + text, text + " too  SHORT", text + " tootoo short", text + " too shorter", "too short"])
        docs.append((i, text))
    norm = lambda s: re.sub(r"[\W_]+", " ", s.lower()).strip()
    want = {}
    for i, t in docs:
        for j, q in enumerate(items):
            n = norm(q)
            if 0 < len(n) < 13:  # no budget by the rate
                if f" {n} " in f" {norm(t)} ":
                    want[i, j] = 0
            elif n:
                d = best_substring(n, norm(t))
                if d <= int(len(n) * 0.08):
                    want[i, j] = d
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    for size in (16 << 20, 200):  # one block of items, several blocks
        got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontaminate.matches(d, b, block_bytes=size).collect()}
        assert got == want
        clean = {r["doc_id"] for r in decontaminate.keep_clean(d, b, block_bytes=size).collect()}
        assert clean == {i for i, _ in docs} - {i for i, _ in want}
    assert want and 0 < len({i for i, _ in want}) < 30


# -- licences ----------------------------------------------------------------


def found_licenses(t):
    """(coefficient, words, licence, place) of the windows that count, best first, in plain Python."""
    every = [(n, licenses.bigrams(x)) for n, ts in sorted(licenses.TEMPLATES.items()) for x in ts]
    dice = lambda a, b: 2 * len(a & b) / (len(a) + len(b))
    g, best = licenses.bigrams(t or ""), []
    for name, own in every:
        told = [
            set(own) - set(h) for other, h in every
            if other != name and any(dice(set(own), set(h[i : i + len(own)])) >= 0.8 for i in range(max(1, len(h) - len(own) + 1)))
        ] + [{b for b in own if re.fullmatch(r"(version|v) \d+", b)}]
        windows = [(i, set(g[i : i + len(own)])) for i in range(len(g)) if g[i] in set(own)]
        good = [(-dice(a, set(own)), i) for i, a in windows if dice(a, set(own)) >= 0.8 and all(2 * len(a & x) >= len(x) for x in told)]
        if good:
            worse, i = min(good)
            best.append((worse, -len(own), name, i, len(own) + 1))
    overlap = lambda f, h: 2 * (min(f[3] + f[4], h[3] + h[4]) - max(f[3], h[3])) > min(f[4], h[4])
    return sorted(f for f in best if not any(h[2] != f[2] and h < f and overlap(f, h) for h in best))


def test_each_template_names_its_licence(spark):
    """Alone, in the middle of other words, and two in one text."""
    every = [(n, t) for n, ts in licenses.TEMPLATES.items() for t in ts]
    other = {n: next(t for m, t in every if m != n and m[:3] != n[:3]) for n, _ in every}
    texts = [t for _, t in every] + [f"Some words before it. {t} And some more after it." for _, t in every] + [f"{t} -- whereas the other part: {other[n]}" for n, t in every]
    texts += ["This work is licensed under the GNU General Public License, version 1.", "This work is licensed under the GNU Affero General Public License, version 7."]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    got = {r["doc_id"]: (r["n_licenses"], r["license"], r["licenses"]) for r in rows}
    for k, (name, _) in enumerate(every):
        assert got[k] == (1, name, name) and got[len(every) + k] == (1, name, name), texts[k]
        partner = next(m for m, t in every if t == other[name])
        assert got[2 * len(every) + k][2] == ",".join(sorted((name, partner))), texts[k]
    assert got[len(texts) - 2][0] == got[len(texts) - 1][0] == 0


def test_license_scan(spark):
    import textwrap

    r = random.Random(7)
    every = [t for ts in licenses.TEMPLATES.values() for t in ts]
    other = ["nothing", "", "the the the the", "license", "software is provided and the rights to use copies of the software", "Copyright 2020 X. All rights reserved."]
    docs = []
    for i in range(70):
        lines = []
        for _ in range(r.randrange(1, 4)):
            t = r.choice(every) if r.random() < 0.5 else r.choice(other)
            w = t.split()
            for _ in range(r.randrange(0, 1 + len(w) // 12)):
                w[r.randrange(len(w))] = "changed"
            lines.append(textwrap.fill(" ".join(w), r.choice([20, 60, 999])))
        docs.append((i, r.choice(["\n", " ", "; see "]).join(lines)))
    wrapped = {
        "MIT": "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated documentation files\n(the Software)",
        "Apache-2.0": "Copyright 2020 X\n# Licensed under the\n# Apache License, Version 2.0.\ncode", "GPL-3.0": "header " + licenses.TEMPLATES["GPL-3.0"][1].replace(" the ", "\n the ") + " more",
    }
    docs += [(100 + k, t) for k, t in enumerate(wrapped.values())] + [(80, None), (81, ""), (None, licenses.TEMPLATES["BSD-3-Clause"][1])]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.scan(frame).collect()}
    for k, t in docs:
        best = found_licenses(t)
        names, top = sorted({f[2] for f in best}), best[0] if best else None
        assert got[k] == (len(names), top and top[2], top and pytest.approx(-top[0]), ",".join(names) if names else None), (k, t)
    assert all(name in got[100 + k][3].split(",") for k, name in enumerate(wrapped)) and "BSD-3-Clause" in got[None][3]
    spans = licenses.license_spans(frame.where("doc_id = 101")).collect()
    assert [(s["license"], s["first_word"], s["n_words"]) for s in spans] == [("Apache-2.0", 3, 8)]


# -- sharding ----------------------------------------------------------------


def test_sharding(small):
    rows = sharding.assign(small, shards=7, keep=False).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in small.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    load, slots = Counter(), {}
    for r in rows:
        b = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(b) + 16, zlib.crc32(b), "bytes", None)
        load[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) <= max(min(load.values()) * 1.02, max(r["size"] for r in rows))


def test_one_hot_group_is_split(spark):
    d = spark.createDataFrame([(i, "copy of the same text " * 4 if i % 3 else f"text {i} " * 10) for i in range(3000)], "doc_id bigint, text string")
    load = Counter()
    for r in sharding.assign(d, shards=5, units=16, keep=False).collect():
        load[r["shard"]] += r["size"]
    assert max(load.values()) < 1.02 * min(load.values())


def test_repeated_rows_spread(spark):
    rows = [(None, "one row many times " * 5)] * 4000 + [(i, f"text {i:05} " * 9) for i in range(4000)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for keep in (False, True):
        load, slots = Counter(), {}
        for r in sharding.assign(d, shards=6, units=16, keep=keep).collect():
            load[r["shard"]] += r["size"]
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert max(load.values()) < 1.02 * min(load.values()) and sum(map(len, slots.values())) == 8000
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_levelling_keeps_tokens_and_rows():
    r = np.random.default_rng(5)
    need = r.lognormal(0, 1, (600, 1)) * r.uniform(0.3, 1.7, (600, 3))
    need = need / need.sum(axis=0) * 6
    at = r.integers(0, 6, 600)
    load = lambda x: np.stack([np.bincount(x, weights=c, minlength=6) for c in need.T], axis=1)
    before, after = load(at), load(sharding.level(need, at, 6))
    assert np.ptp(after[:, 0]) < 0.3 * np.ptp(before[:, 0])
    assert (np.abs(after[:, 1:] - 1).max(axis=0) <= np.abs(before[:, 1:] - 1).max(axis=0) + 1e-9).all()


def test_placing_balances_every_dimension():
    r = np.random.default_rng(3)
    sizes = r.lognormal(3, 1.5, (900, 1)) * r.uniform(0.5, 1.5, (900, 3))
    at = sharding.place(sizes, 9)
    for k in range(3):
        load = np.bincount(at, weights=sizes[:, k], minlength=9)
        assert load.max() < 1.25 * load.min()


# -- mixing ------------------------------------------------------------------


def test_budgets_redistribute_siblings_first():
    tokens = {("a", "x"): 100, ("a", "y"): 10, ("b", "z"): 1000}
    got = mixing.budgets(tokens, 200, {("a",): 1.0, ("b",): 1.0}, 1)
    assert got == {("a", "x"): 90, ("a", "y"): 10, ("b", "z"): 100}  # y is short: its sibling x pays, not b
    assert mixing.budgets(tokens, 400, {}, 1) == {("a", "x"): 100, ("a", "y"): 10, ("b", "z"): 290}
    assert sum(mixing.budgets(tokens, 10**9, {}, 2).values()) == 2220
    assert mixing.budgets({}, 10, {}, 1) == {}
    # what weighs nothing gives nothing, and its family's shortage goes on to b
    assert mixing.budgets(tokens, 500, {("a", "x"): 0.0}, 1) == {("a", "x"): 0, ("a", "y"): 10, ("b", "z"): 490}
    assert mixing.budgets(tokens, 500, {("a",): 0.0}, 2) == {("a", "x"): 0, ("a", "y"): 0, ("b", "z"): 500}
    assert mixing.budgets(tokens, 500, {("a", "x"): 0.0, ("a", "y"): 0.0, ("b",): 0.0}, 1) == {("a", "x"): 0, ("a", "y"): 0, ("b", "z"): 0}


def test_mixing_prefixes(small):
    rows = mixing.select(small, mixing.tree(), share=1.3, epochs=4, seed=5).collect()
    leaves = {}
    for r in rows:
        leaves.setdefault((r["domain"], r["lang"], r["source"]), []).append(r)
    total = 0
    for part in leaves.values():
        used = sum(r["copies"] * r["n_tokens"] + r["part_tokens"] for r in part)
        assert used == part[0]["budget"] and len({r["copies"] for r in part}) == 1
        partial = [r for r in part if 0 < r["part_tokens"] < r["n_tokens"]]
        assert len(partial) <= 1  # a prefix has one edge
        total += used
    assert total == int(sum(r["n_tokens"] for r in rows) * 1.3)
    again = {r["doc_id"]: (r["copies"], r["part_tokens"]) for r in mixing.select(small, mixing.tree(), share=1.3, epochs=4, seed=5).collect()}
    assert again == {r["doc_id"]: (r["copies"], r["part_tokens"]) for r in rows}


def test_mixing_repeated_rows(spark):
    rows = [(1, "three words here", "en", "src0")] * 900 + [(i, "two words", "en", "src0") for i in range(2, 50)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(4)
    got = mixing.select(d, mixing.tree(), share=0.5, epochs=1).collect()
    assert sum(r["part_tokens"] for r in got) == (2700 + 96) // 2 and sum(0 < r["part_tokens"] < r["n_tokens"] for r in got) <= 1


def tokens_of(k, t):
    return len((t or "").encode().split())


def mixture(rows, weights, target, epochs, seed, hashes):
    """Plain Python: (doc, copies, part) by the tree, its budgets and the order of the hashes."""
    domain = {s: d for d, ss in mixing.DOMAINS.items() for s in ss}
    leaves = {}
    for k, t, lang, source in rows:
        leaves.setdefault((domain.get(source, "other"), lang or "(none)", source or "(none)"), []).append((k, tokens_of(k, t)))
    have = {p: sum(n for _, n in ds) for p, ds in leaves.items()}

    def share(path, budget):
        kids = sorted({p[: len(path) + 1] for p in leaves if p[: len(path)] == path})
        if path in leaves:
            return {path: budget}
        cap = {c: epochs * sum(n for p, n in have.items() if p[: len(c)] == c) for c in kids}
        got, live, left = dict.fromkeys(kids, 0), [c for c in kids if cap[c]], min(budget, sum(cap.values()))
        while live and left:
            w = sum(weights.get(c, 1.0) for c in live)
            full = [c for c in live if left * weights.get(c, 1.0) / w >= cap[c]]
            if not full:
                want = {c: left * weights.get(c, 1.0) / w for c in live}
                got.update({c: int(want[c]) for c in live})
                odd = left - sum(int(x) for x in want.values())
                for c in sorted(live, key=lambda c: (int(want[c]) - want[c], c))[:odd]:
                    got[c] += 1
                break
            for c in full:
                got[c] = cap[c]
                left -= cap[c]
                live.remove(c)
        out = {}
        for c in kids:
            out |= share(c, got[c])
        return out

    out = {}
    for p, budget in share((), min(target, epochs * sum(have.values()))).items():
        copies, rest = divmod(budget, have[p]) if have[p] else (0, 0)
        for k, n in sorted(leaves[p], key=lambda x: hashes[x[0]]):
            out[k] = (copies, min(n, max(0, rest)), budget)
            rest -= n
    return out


def test_mixing_against_plain_python(spark, small):
    from pyspark.sql import functions as F

    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in small.collect()]
    for share, epochs in ((0.5, 4), (0.9, 1), (2.7, 4)):
        got = {r["doc_id"]: r for r in mixing.select(small, mixing.tree(), share=share, epochs=epochs, seed=3).collect()}
        made = [(k, zlib.crc32((t or "").encode()), got[k]["copies"]) for k, t, *_ in rows]
        h = spark.createDataFrame(made, "k bigint, c bigint, n bigint").select("k", F.shiftrightunsigned(F.xxhash64(F.lit(3), "n", "k", "c", F.lit(0).cast("bigint")), 0).alias("h"))
        hashes = {r["k"]: r["h"] % 2**64 for r in h.collect()}
        # the order within a range is that of the signed hash, all of one range having the same top bits
        want = mixture(rows, mixing.WEIGHTS, int(sum(tokens_of(k, t) for k, t, *_ in rows) * share), epochs, 3, hashes)
        assert {k: (r["copies"], r["part_tokens"], r["budget"]) for k, r in got.items()} == want


# -- token counts ------------------------------------------------------------


def test_token_counts(small):
    import base64

    import tiktoken

    with open(token_counts.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("t", pat_str=token_counts.SPLIT, mergeable_ranks=ranks, special_tokens={})
    n = [len(e.encode_ordinary(r["text"] or "")) for r in small.collect()]
    table = token_counts.context_table(token_counts.histogram(token_counts.token_lengths(small)), [7, 512])
    rows = {r["context_limit"]: r for r in table.collect()}
    assert set(rows) == {*n, 7, 512}
    for limit, r in rows.items():
        assert r["docs_at"] == n.count(limit) and r["docs_within"] == sum(x <= limit for x in n) and r["docs_over"] == sum(x > limit for x in n)
        assert r["tokens_within"] == sum(x for x in n if x <= limit) and r["truncated_total"] == sum(min(x, limit) for x in n)
        assert r["lost_tokens"] == sum(max(0, x - limit) for x in n) and r["quantile"] == pytest.approx(sum(x <= limit for x in n) / len(n))
    got = {r["share"]: r["n_tokens"] for r in token_counts.quantile_lengths(table, [0.5, 0.9, 1.0]).collect()}
    assert got == {s: sorted(n)[math.ceil(s * len(n)) - 1] for s in (0.5, 0.9, 1.0)}
