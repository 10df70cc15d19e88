"""Source divergence audit: how a source's words differ from those of other sources and of its language.

Two passes over the texts. The first counts in how many documents of its language each term
occurs; a language keeps the terms of at least ``LEAST`` documents. The second counts every
occurrence of kept terms with Aho-Corasick automata over delimiter-padded terms (" term "), run over
texts whose terms stand between single spaces, so only whole terms match and neighbours share
their space.

The vocabulary may outgrow any task, so only its ``HEAD`` most widely used pairs of language and term
are broadcast as automata. What a text holds beside them goes, by a hash of the term, to the
automaton of one block of the rest (``BLOCK`` terms): texts of such terms are shuffled, every
occurrence is counted in exactly one place, and a block with much text is worked by several tasks.

A term is a run of letters A-Z (lowered) and of code points from U+0080 on. With N the group's sum of
counts over the V kept terms of its language, a count c gives p = 1 + floor(10**9 (c + 2) / (N + 2 V)); two such
shares p, q diverge by floor((p - q)**2 / (p + q)). All of it is integer arithmetic.

* ``pair``: for each two groups (language, source) of a language, the divergence summed over all kept
  terms. Postings (term, group, p) are dealt into blocks of terms and pairs of chunks of groups; a task adds
  up what differs from two absent counts, so terms that neither group uses cost nothing.
* ``term``: for each group, the kept terms it uses more than its language does, the ``TOP`` strongest.

Defined cases: null text, language or source is an empty string; a group without any kept term has
zero counts, and pairs of it have value 0 only if its language keeps none; repeated rows count
as often as they stand there; ties are ranked by the item's bytes; very long texts are counted whole;
other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import filterfalse
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefmill.llm.common import bounded_batches, written
from prefmill.llm.hamming import TASK, deal, whole_tasks

LEAST, TOP = 10, 10
SCALE = 1_000_000_000
#: Pairs of language and term that every task holds, and those of one block of the rest.
HEAD, BLOCK = 1 << 15, 1 << 17
#: Counts are given out at so many occurrences or groups, gathered terms and texts at so many bytes.
OCCURRENCES, GROUPS_HELD, GATHER, TEXTS = 1 << 22, 1 << 16, 8 << 20, 16 << 20
#: Terms of one block of postings, groups of one chunk, characters of gathered terms for one task.
TERMS, GROUPS, TASK_CHARS = 512, 256, 16 << 20
MOST_TASKS = 20000

_KEEP = {*range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEEP else 32 for b in range(256))

#: Automata of this worker, for the last vocabulary it saw.
_held: dict[str, dict[str, tuple]] = {}


def terms(text: str) -> list[bytes]:
    """All terms of a whole text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def automaton(kept: list[bytes]):
    """Finds kept terms between spaces; a match's value is the term's place in the list. Bytes are matched as Latin-1."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, term in enumerate(kept):
        found.add_word(f" {term.decode('latin-1')} ", i)
    found.make_automaton()
    return found


def recount(found, words: list[bytes]) -> np.ndarray:
    """The place of each occurrence of a kept term in a sequence of terms."""
    if not len(found) or not words:
        return np.zeros(0, np.int64)
    return np.fromiter(map(itemgetter(1), found.iter(f" {b' '.join(words).decode('latin-1')} ")), np.int64)


def _rows(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(clean(lang).alias("lang"), clean(source).alias("source"), clean(text).alias("text"))


def frequencies(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The distinct terms of some texts, and in how many of them each occurs; no Python object for any term."""
    plain = [t.translate(_TABLE) for t in texts]
    raw = np.frombuffer(b" ".join([b"", *plain, b""]), np.uint8)
    inside = raw != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # it begins and ends with a space: terms begin and end by turns
    start, end = edge[::2], edge[1::2]
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    occurrences = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
    found = occurrences.dictionary_encode()
    first = np.cumsum([1, *[len(t) + 1 for t in plain[:-1]]])
    per = np.diff(np.r_[np.searchsorted(start, first), len(start)])
    pair = np.repeat(np.arange(len(plain)), per) << 32 | found.indices.to_numpy().astype(np.int64)
    pair.sort()
    once = pair[np.flatnonzero(np.diff(pair, prepend=-1))]
    return found.dictionary, np.bincount(once & 0xFFFFFFFF, minlength=len(found.dictionary))


def document_counts(rows: DataFrame) -> DataFrame:
    """rows (lang, text) -> (lang, term, df): in how many documents of the language each term occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = defaultdict(list)
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, texts in waiting.items():
                found, df = frequencies(texts)
                for a in range(0, len(found), 1 << 16):
                    part = found[a : a + (1 << 16)].cast(pa.large_string()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(part)), part, pa.array(df[a : a + (1 << 16)], pa.int64())], ["lang", "term", "df"])
            waiting.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                waiting[lang].append(text.encode("utf-8", "surrogatepass"))
                size += len(text)
                if size >= TEXTS:
                    yield from counted()
                    size = 0
        yield from counted()

    return rows.select("lang", "text").mapInArrow(count, "lang string, term string, df bigint").groupBy("lang", "term").agg(F.sum("df").alias("df"))


def _head(vocabulary: DataFrame, most: int) -> tuple[dict[str, tuple[list[bytes], list[int]]], int]:
    """The most widely used terms of each language, at most ``most`` in all, with their ids; and the count down to which they go."""
    level = F.floor(F.log2(F.col("df").cast("double")) * 8).cast("int")
    sizes = vocabulary.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect()
    least, total = None, 0
    for r in sizes:
        if total + r["n"] > most:
            break
        least, total = r["level"], total + r["n"]
    out: dict[str, tuple[list[bytes], list[int]]] = {}
    if least is not None:
        for r in vocabulary.where(level >= least).select("lang", "term", "tid").toLocalIterator():
            kept, ids = out.setdefault(r["lang"], ([], []))
            kept.append(r["term"].encode("utf-8"))
            ids.append(r["tid"])
    return out, least if least is not None else 1 << 20


def occurrences(rows: DataFrame, vocabulary: DataFrame, head: int = HEAD) -> DataFrame:
    """rows (lang, source, text) and vocabulary (lang, term, df, tid) -> (lang, source, tid, n): occurrences of kept terms, written."""
    spark = rows.sparkSession
    first, least = _head(vocabulary, head)
    level = F.floor(F.log2(F.col("df").cast("double")) * 8).cast("int")
    rest = vocabulary.where(level < least)
    left = rest.count()
    blocks = math.ceil(left / BLOCK)
    name, sent = uuid.uuid4().hex, spark.sparkContext.broadcast(first)

    def prepared(lang: str) -> tuple:
        if name not in _held:
            _held.clear()
            _held[name] = {}
        mine = _held[name]
        if lang not in mine:
            kept, ids = sent.value.get(lang, ([], []))
            mine[lang] = automaton(kept), frozenset(kept), np.array(ids, np.int64)
        return mine[lang]

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[np.ndarray] = []
        groups: dict[tuple[str, str], int] = {}
        beside: dict[tuple[str, str, int], list[bytes]] = defaultdict(list)
        size = seen = 0

        def counted() -> Iterator[pd.DataFrame]:
            if found:
                code, n = np.unique(np.concatenate(found), return_counts=True)
                of = code >> 32
                # a group's occurrences lie together
                ids = [prepared(lang)[2][code[a:b] & 0xFFFFFFFF] for (lang, _), a, b in zip(groups, *np.searchsorted(of, [np.arange(len(groups)), np.arange(1, len(groups) + 1)]))]
                names = np.array(list(groups), object)[of]
                yield pd.DataFrame({"lang": names[:, 0], "source": names[:, 1], "tid": np.concatenate(ids), "n": n, "block": -1, "body": ""})
            found.clear()
            groups.clear()

        def gathered() -> Iterator[pd.DataFrame]:
            if beside:
                keys = list(beside)
                yield pd.DataFrame(keys, columns=["lang", "source", "block"]).assign(tid=-1, n=0, body=[b" ".join(beside[k]).decode("utf-8") for k in keys])
            beside.clear()

        for frame in frames:
            for lang, source, text in zip(frame["lang"], frame["source"], frame["text"]):
                machine, known, _ = prepared(lang)
                words = terms(text)
                at = recount(machine, words)
                if len(at):
                    found.append(at | groups.setdefault((lang, source), len(groups)) << 32)
                    seen += len(at)
                if blocks and len(at) < len(words):
                    for w in filterfalse(known.__contains__, words):
                        beside[lang, source, zlib.crc32(w) % blocks].append(w)
                        size += len(w) + 1
                    if size >= GATHER:
                        yield from gathered()
                        size = 0
            if seen >= OCCURRENCES or len(groups) >= GROUPS_HELD:
                yield from counted()
                seen = 0
        yield from counted()
        yield from gathered()

    out = written(rows.mapInPandas(count, "lang string, source string, tid bigint, n bigint, block int, body string"), "term-counts")
    counts = out.where("block < 0").select("lang", "source", "tid", "n")
    if blocks:
        counts = counts.unionByName(_rest(out.where("block >= 0"), rest, blocks))
    return written(counts.groupBy("lang", "source", "tid").agg(F.sum("n").alias("n")), "occurrences")


def _rest(texts: DataFrame, rest: DataFrame, blocks: int) -> DataFrame:
    """Occurrences in gathered terms (lang, source, block, body) of the terms that no task holds from the start."""
    chars = texts.agg(F.sum(F.length("body").cast("bigint"))).first()[0] or 0
    salts = min(max(1, math.ceil(chars / blocks / TASK_CHARS)), max(1, MOST_TASKS // blocks))
    none = F.lit(None).cast("string")
    vocabulary = rest.select(
        F.pmod(F.crc32(F.encode("term", "UTF-8")), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        F.lit(0).alias("kind"), "lang", none.alias("source"), "tid", F.col("term").alias("body"),
    )
    bodies = texts.select("block", F.pmod(F.xxhash64("body", "lang", "source"), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("kind"), "lang", "source", F.lit(0).cast("bigint").alias("tid"), "body")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, kept, found = None, {}, {}
        for frame in frames:
            out: dict[tuple[str, str, int], int] = defaultdict(int)
            for block, salt, kind, lang, source, tid, body in frame.itertuples(index=False, name=None):
                if (block, salt) != at:
                    at, kept, found = (block, salt), {}, {}
                if not kind:
                    mine, ids = kept.setdefault(lang, ([], []))
                    mine.append(body.encode("utf-8"))
                    ids.append(tid)
                    continue
                if lang not in kept:
                    continue
                if lang not in found:
                    found[lang] = automaton(kept[lang][0])
                ids = kept[lang][1]
                for i, n in zip(*(x.tolist() for x in np.unique(recount(found[lang], body.encode("utf-8").split(b" ")), return_counts=True))):
                    out[lang, source, ids[i]] += n
            yield pd.DataFrame([(*k, n) for k, n in out.items()], columns=["lang", "source", "tid", "n"])

    dealt = vocabulary.unionByName(bodies).repartition(blocks * salts, "block", "salt").sortWithinPartitions("block", "salt", "kind")
    return dealt.mapInPandas(count, "lang string, source string, tid bigint, n bigint")


def share(n: Column, total: Column, v: Column) -> Column:
    """p of a count: an exact division, whatever the size of the counts."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    whole = F.greatest(total + 2 * v, F.lit(1))
    exact = F.call_function("div", wide(n + 2, 20) * wide(F.lit(SCALE), 10), wide(whole, 20))
    # what fits a long is divided as one
    return F.lit(1).cast("bigint") + F.when(n < (1 << 33) - 2, F.call_function("div", (n + 2) * SCALE, whole)).otherwise(exact)


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pairs(postings: DataFrame, groups: DataFrame, v: int) -> DataFrame:
    """postings (lang, tid, source, p) and groups (lang, source, p0, m: groups of the language) -> (lang, a, b, part), each two groups
    once: over all kept terms, their divergence less that of two absent counts."""
    blocks = max(1, math.ceil(v / TERMS))
    mine = postings.join(groups, ["lang", "source"]).select("lang", F.pmod(F.xxhash64("tid"), F.lit(blocks)).cast("bigint").alias("key"), "source", "tid", "p", "p0", "m")
    # every group stands in every block, with no term
    present = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("key"), "source", F.lit(-1).cast("bigint").alias("tid"), F.col("p0").alias("p"), "p0", "m")
    rows = mine.unionByName(present).withColumn("n", F.col("m")).withColumn("tab", F.xxhash64("lang"))
    dealt = deal(rows, F.xxhash64("source", F.lit(12)), GROUPS).drop("m").repartition("lang", *TASK).sortWithinPartitions(*TASK, "lang")

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_tasks(frames):
            for a, b in zip(starts, [*starts[1:], len(frame)]):
                for lang, task in frame.iloc[a:b].groupby("lang", sort=False):
                    yield from _added(lang, task)

    return dealt.mapInPandas(add, "lang string, a string, b string, part bigint").groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))


def _added(lang: str, task: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Partial sums of one block of terms and one pair of chunks of groups."""
    term, _ = pd.factorize(task["tid"].where(task["tid"] >= 0))
    high = int(term.max(initial=-1)) + 1
    if not high:
        return
    group, names = pd.factorize(task["source"])
    p, p0 = task["p"].to_numpy(), np.zeros(len(names), np.int64)
    p0[group] = task["p0"].to_numpy()
    side = np.zeros(len(names), np.int64)
    side[group] = task["side"].to_numpy()
    table = np.repeat(p0[:, None], high, axis=1)
    at = term >= 0
    table[group[at], term[at]] = p[at]
    names = np.asarray(names, dtype=object)
    lanes, asks = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = bool((task["ci"] == task["cj"]).iloc[0])
    # below 2**26 squares and sums are exact as doubles, and a quotient is too far from the next whole number to be rounded up to it
    small = (table < 1 << 26).all(axis=0) if (p0 < 1 << 26).all() else np.zeros(high, bool)
    light, heavy = table[:, small].astype(float), table[:, ~small]
    out = []
    for k, q in enumerate(lanes if alone else asks):
        to = lanes[k + 1 :] if alone else lanes
        d, e, d0 = light[to] - light[q], heavy[to] - heavy[q], p0[to] - p0[q]
        part = np.floor(d * d / (light[to] + light[q])).sum(axis=1).astype(np.int64) + (e * e // (heavy[to] + heavy[q])).sum(axis=1)
        part -= high * (d0 * d0 // (p0[to] + p0[q]))
        some = part != 0
        if some.any():
            out.append((np.repeat(names[q], some.sum()), names[to[some]], part[some]))
    if out:
        a, b, part = (np.concatenate(x) for x in zip(*out))
        first = a < b
        yield pd.DataFrame({"lang": np.repeat(np.array([lang], object), len(a)), "a": np.where(first, a, b), "b": np.where(first, b, a), "part": part})


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST, top: int = TOP, head: int = HEAD) -> DataFrame:
    """(lang, source, part, item, value, rank)."""
    bounded_batches(docs)
    rows = _rows(docs, text, lang, source)
    kept = document_counts(rows).where(F.col("df") >= least)
    vocabulary = written(kept.select("lang", "term", "df", F.monotonically_increasing_id().alias("tid")), "vocabulary")
    counts = occurrences(rows, vocabulary, head)
    sizes = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    every = written(rows.select("lang", "source").distinct(), "groups")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = every.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").join(every.groupBy("lang").agg(F.count(F.lit(1)).alias("m")), "lang")
    zero = F.lit(0).cast("bigint")
    groups = groups.withColumns({"total": F.coalesce("total", zero), "v": F.coalesce("v", zero)})
    groups = written(groups.withColumn("p0", share(zero, F.col("total"), F.col("v"))), "group-totals")
    v = vocabulary.count()
    postings = counts.join(groups.select("lang", "source", "total", "v"), ["lang", "source"]).select("lang", "source", "tid", share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    # pairs
    one, two = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("pa"), "v"), groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("pb"))
    sums = written(_pairs(postings, groups.select("lang", "source", "p0", "m"), v), "pair-sums")
    sums = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "part"))
    pairs = one.join(two, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    value = F.coalesce("part", zero) + F.col("v") * gap(F.col("pa"), F.col("pb"))
    pairs = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), value.alias("value"))
    # terms
    whole = counts.groupBy("lang", "tid").agg(F.sum("n").alias("n")).join(groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("v").alias("v")), "lang")
    whole = whole.select("tid", share(F.col("n"), F.col("total"), F.col("v")).alias("q")).join(vocabulary.select("tid", "term"), "tid")
    strong = postings.join(whole, "tid").where("p > q")
    strong = strong.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    return pairs.withColumn("rank", rank).unionByName(strong.withColumn("rank", rank).where(F.col("rank") <= top))


def oracle_sql() -> str:
    """DuckDB SQL for the rows of ``audit`` over documents."""
    gap_ = lambda p, q: f"(({p} - {q}) * ({p} - {q})) // ({p} + {q})"
    p = lambda n, total, v: f"1 + ({SCALE}::HUGEINT * ({n} + 2)) // ({total} + 2 * {v})"
    return rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
        FROM documents),
    tokens AS (SELECT i, lang, source, unnest(ts) AS term FROM docs),
    kept AS (SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT i) >= {LEAST}),
    sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    counts AS (SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
    grid AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, s.v, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
        FROM groups g JOIN kept k ON g.lang = k.lang JOIN sizes s ON s.lang = g.lang
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    shares AS (SELECT lang, source, term, n, {p("n", "total", "v")} AS p FROM grid),
    langs AS (SELECT lang, term, sum(n) AS n, max(v) AS v FROM grid GROUP BY lang, term),
    whole AS (SELECT lang, term, {p("n", "sum(n) OVER (PARTITION BY lang)", "v")} AS q FROM langs),
    pairs AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
            coalesce((SELECT sum({gap_("x.p", "y.p")}) FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term
                WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
    strong AS (
        SELECT s.lang, s.source, 'term' AS part, s.term AS item, {gap_("s.p", "w.q")} AS value
        FROM shares s JOIN whole w ON s.lang = w.lang AND s.term = w.term WHERE s.n > 0 AND s.p > w.q),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
        FROM (SELECT * FROM pairs UNION ALL SELECT * FROM strong))
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= {TOP}"""
