"""Near-duplicates by SimHash, compared in bit-sliced form.

Fingerprint: A-Z lowered, words between ASCII white space, shingles of words with
repeats, XXH64 (seed 42) of each; a bit is set if over half the hashes have it set.
Texts with fewer words than a shingle are one shingle; texts without words have
fingerprint zero.

Comparison (``within``): a task lays its fingerprints out vertically, 64 lanes to a
machine word and one word row a bit; carry-save counters add 8 bit planes at a time for
many (query, word) pairs at once, and words in which every lane is beyond the radius are
abandoned. Of the pairs found, a task returns only as many links as join the same nodes,
so copies and hot groups stay linear; components over those links are the groups.

Two ways to the buckets that are compared:

* ``near_duplicates``: a small radius (4 of 64 bits, shingles of 4 words). Buckets come
  from blocks of the fingerprint by the pigeonhole principle (``hamming``), so every pair
  within the radius is found.
* ``similar_texts``: Jaccard coefficient of the shingle sets of at least ``least`` (0.8,
  shingles of 5 words). At 0.8 two fingerprints differ in some 10 of 64 bits, too many for
  blocks, so buckets come from BANDS hashes of ROWS smallest shingle hashes each (two texts
  at a coefficient of j share one with probability 1 - (1 - j**ROWS)**BANDS, 0.9996 at 0.8).
  Here a fingerprint is the vote of the shingle set, each shingle once, so that it says nothing of how often a
  passage is repeated. Within a bucket the same bit-sliced comparison drops what is beyond RADIUS_SIMILAR bits (at 0.8
  some 10 of 64 differ, with a deviation of 3), and what is left is decided by the whole shingle sets (32-bit hashes). First every text
  meets the smallest member of its buckets, then only buckets that still hold several
  groups are compared in full, a bucket over ``MOST`` rows as pairs of chunks.

Defined cases: a null text is empty; empty texts are linked with each other; repeated rows
share their group; a component_id is the smallest key of a group that is not null, and
null in a group without any; very long texts are read whole, their shingles by pieces of
16384; other columns are ignored by ``near_duplicates`` and ``similar_texts`` and kept,
whatever their names, by ``keep_first``. Of each group ``keep_first`` keeps the row with the
smallest key (null is the largest; of equal keys the smallest SHA-256 of the text), and
one of repeated rows. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefmill.llm.common import boxed, bounded_batches, text_digest, text_or_empty, written
from prefmill.llm.components import components
from prefmill.llm.hamming import TASK, blocks_for, bucket_tasks, deal, star_links, whole_tasks

SHINGLE = 4
RADIUS = 4
SIMILAR_SHINGLE = 5
LEAST = 0.8
RADIUS_SIMILAR = 28
BANDS, ROWS = 20, 5
MOST = 512

_SEEDED = np.random.default_rng(5)
TIMES = _SEEDED.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)
PLUS = _SEEDED.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64)


def shingle_hashes(text: str, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of each shingle of one whole text, repeats included, by pieces of 16384."""
    from xxhash import xxh64_intdigest as digest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return
    line = b" ".join(words)
    if n <= shingle:
        yield np.array([digest(line, 42)], "<u8")
        return
    size = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(size + 1) - 1
    start = (end - size)[: n - shingle + 1].tolist()
    stop = end[shingle - 1 :].tolist()
    for k in range(0, len(start), 16384):
        yield np.array([digest(line[a:b], 42) for a, b in zip(start[k : k + 16384], stop[k : k + 16384])], "<u8")


def vote(parts: list[np.ndarray]) -> int:
    """The fingerprint of shingle hashes."""
    votes, n = np.zeros(64, np.int64), 0
    for h in parts:
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
        n += len(h)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one whole text."""
    return vote(list(shingle_hashes(text, shingle)))


def fingerprints(text: str = "text", shingle: int = SHINGLE) -> Column:
    """A bigint column: the fingerprint's bits."""

    @F.pandas_udf(T.LongType())
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], dtype=np.uint64).view(np.int64))

    return run(text_or_empty(text))


def _csa(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder of three bit planes: (sum, carry)."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def within(lanes: np.ndarray, lane_start: np.ndarray, queries: np.ndarray, of: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All (query, lane) positions at most ``radius`` bits (under 63) apart within a group.

    lanes are sorted by group, the groups' first positions are in lane_start; of: each
    query's group. Groups are padded to whole words of 64 lanes.
    """
    count = np.diff(np.r_[lane_start, len(lanes)])
    words = -(-count // 64)
    base = np.cumsum(words) - words
    group = np.repeat(np.arange(len(count)), count)
    spot = base[group] * 64 + np.arange(len(lanes)) - lane_start[group]
    total = int(words.sum())
    laid = np.zeros(total * 64, np.uint64)
    laid[spot] = lanes
    back = np.full(total * 64, -1, np.int64)
    back[spot] = np.arange(len(lanes))
    pack = lambda x: np.packbits(x, bitorder="little").view("<u8")
    valid = pack(back >= 0)
    item_q = np.repeat(np.arange(len(queries)), words[of])
    first = np.cumsum(words[of]) - words[of]
    item_w = np.arange(len(item_q)) - first[item_q] + base[of][item_q]
    zero = np.zeros(len(item_q), np.uint64)
    # counter bits of 1, 2, 4, ...: as many as a count up to the radius needs, and what runs over them
    counter = [zero] * max(3, radius.bit_length())
    over = zero
    for b in range(0, 64, 8):
        q = queries[item_q]
        x = []
        for k in range(b, b + 8):
            plane = pack(((laid >> np.uint64(k)) & np.uint64(1)).astype(np.uint8))
            x.append(plane[item_w] ^ (np.uint64(0) - ((q >> np.uint64(k)) & np.uint64(1))))
        ones, twos, fours = counter[:3]
        ones, ta = _csa(ones, x[0], x[1])
        ones, tb = _csa(ones, x[2], x[3])
        twos, fa = _csa(twos, ta, tb)
        ones, ta = _csa(ones, x[4], x[5])
        ones, tb = _csa(ones, x[6], x[7])
        twos, fb = _csa(twos, ta, tb)
        fours, carry = _csa(fours, fa, fb)
        counter[:3] = ones, twos, fours
        for k in range(3, len(counter)):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        over = over | carry
        near = valid[item_w] & ~(over | _beyond(counter, radius))
        left = near != 0
        if not left.all():
            item_q, item_w, near, over = item_q[left], item_w[left], near[left], over[left]
            counter = [c[left] for c in counter]
        if not len(item_q):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = np.unpackbits(near.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    i, lane = np.nonzero(bits)
    return item_q[i], back[item_w[i] * 64 + lane]


def _beyond(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count exceeds the radius: a comparison with a constant, from the top bit down."""
    greater, equal = np.zeros_like(counter[0]), ~np.zeros_like(counter[0])
    for k in range(len(counter) - 1, -1, -1):
        if radius >> k & 1:
            equal = equal & counter[k]
        else:
            greater = greater | (equal & counter[k])
            equal = equal & ~counter[k]
    return greater


def task_pairs(frame: pd.DataFrame, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row positions of the pairs within the radius in each task of the frame."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    fp = frame["fp"].to_numpy().view(np.uint64)
    side = frame["side"].to_numpy()
    task = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(frame)]))
    alone = (frame["ci"] == frame["cj"]).to_numpy()
    lanes, asks = np.flatnonzero(side == 0), np.flatnonzero((side == 1) | alone)
    names, lane_start = np.unique(task[lanes], return_index=True)
    if not len(names):
        return none
    of = np.searchsorted(names, task[asks])
    ok = (of < len(names)) & (names[np.minimum(of, len(names) - 1)] == task[asks])
    asks, of = asks[ok], of[ok]
    if not len(asks):
        return none
    q, lane = within(fp[lanes], lane_start, fp[asks], of, radius)
    a, b = asks[q], lanes[lane]
    return a[a != b], b[a != b]


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """distinct (fp) -> (a, b): fingerprints joined as all pairs within the radius join them."""
    blocks = blocks or blocks_for(distinct.count(), 64, radius)

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_tasks(frames):
            a, b = star_links(len(frame), *task_pairs(frame, starts, radius))
            fp = frame["fp"].to_numpy()
            yield pd.DataFrame({"a": fp[a], "b": fp[b]})

    tasks = bucket_tasks(distinct.select("fp"), ["fp"], blocks, radius)
    return tasks.select(*TASK, "side", "fp").mapInPandas(search, "a bigint, b bigint")


def _named(rows: DataFrame, node: str, found: DataFrame) -> DataFrame:
    """rows (id, node ...) and (node, component) of the linked ones -> (node, component, component_id), written."""
    groups = rows.groupBy(node).agg(F.min("id").alias("id")).join(found.withColumnRenamed("node", node), node, "left")
    groups = written(groups.select(node, "id", F.coalesce("component", node).alias("component")), "groups")
    least = written(groups.groupBy("component").agg(F.min("id").alias("component_id")), "group-names")
    return written(groups.select(node, "component").join(least, "component"), "named-groups")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """(key, fp bigint, component_id): a row for each row of docs."""
    bounded_batches(docs)
    rows = written(docs.select(F.col(key).alias("id"), fingerprints(text, shingle).alias("fp")), "simhash")
    distinct = written(rows.select("fp").distinct(), "distinct")
    found = written(components(links(distinct, radius)), "components")
    return rows.join(_named(rows, "fp", found), "fp").select(F.col("id").alias(key), "fp", "component_id")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint as 16 hex digits, component_id)."""
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(docs, key, text).select(key, digits.alias("fingerprint"), "component_id")


# -- a Jaccard coefficient of at least ``least`` --------------------------------


def shingle_set(text: str, shingle: int = SIMILAR_SHINGLE) -> np.ndarray:
    """The sorted set of the shingles' hashes, 32 bits of each, of one whole text."""
    parts = [(h >> np.uint64(32)).astype("<u4") for h in shingle_hashes(text, shingle)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, "<u4")


def band_keys(parts: list[np.ndarray]) -> np.ndarray:
    """BANDS signed keys of a text's shingle hashes; a text without any has keys of its own."""
    from xxhash import xxh64_intdigest as digest

    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for part in parts:
        h = np.unique(part)
        for k in range(0, len(h), 1024):
            least = np.minimum(least, (h[None, k : k + 1024] * TIMES + PLUS).min(axis=1))
    return np.array([digest(least[i * ROWS : (i + 1) * ROWS].tobytes(), i) for i in range(BANDS)], np.uint64).view(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard coefficient of two shingle sets; of two empty ones 1."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def joined(sets: list[np.ndarray], label: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Of the pairs a-b of sets, those of at least ``least`` that join what neither labels nor earlier pairs join."""
    parent = {x: x for x in label.tolist()}

    def root(x: object) -> object:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = root(label[i]), root(label[j])
        n, m = len(sets[i]), len(sets[j])
        if x != y and min(n, m) >= least * max(n, m) and likeness(sets[i], sets[j]) >= least:
            parent[x] = y
            out.append((i, j))
    return out


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a coefficient of at least ``least``, written."""

    @F.pandas_udf("double")
    def like(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([likeness(np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")) for a, b in zip(left, right)], dtype="float64")

    met = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    return written(met.where(like("sa", "sb") >= least).select("a", "b"), "verified")


def _labelled(members: DataFrame, found: DataFrame) -> DataFrame:
    """members with the group so far of each node (c) and of its bucket's first (cf), written."""
    own = found.select(F.col("node").alias("g"), F.col("component").alias("c"))
    first = found.select(F.col("node").alias("first"), F.col("component").alias("cf"))
    rows = members.join(own, "g", "left").join(first, "first", "left")
    return written(rows.withColumns({"c": F.coalesce("c", "g"), "cf": F.coalesce("cf", "first")}), "labelled")


def _similar_links(members: DataFrame, sets: DataFrame, least: float, radius: int) -> DataFrame:
    """members (bucket, g, fp, first, ffp) -> components (node, component) over all pairs of the least likeness in a bucket."""
    near = members.where((F.col("g") != F.col("first")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("ffp"))) <= radius))
    # each text meets the smallest of its buckets' first members, then those that this left apart
    links_ = _verified(near.groupBy(F.col("g").alias("a")).agg(F.min("first").alias("b")), sets, least)
    rows = _labelled(members, written(components(links_), "components"))
    apart = rows.where((F.col("c") != F.col("cf")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("ffp"))) <= radius))
    links_ = links_.unionByName(_verified(apart.select(F.col("g").alias("a"), F.col("first").alias("b")).distinct(), sets, least))
    rows = _labelled(members, written(components(links_), "components"))
    # buckets that still hold several groups, in full
    mixed = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    mixed = written(mixed.where("lo <> hi").select("bucket", "n"), "mixed")
    rows = rows.select("bucket", "g", "c", "fp").join(mixed, "bucket").select(F.lit(0).alias("tab"), F.col("bucket").alias("key"), "g", "c", "fp", "n")
    dealt = deal(rows, F.xxhash64("g", F.lit(5)), MOST).repartition(*TASK).sortWithinPartitions(*TASK, "side", "g")

    def candidates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_tasks(frames):
            a, b = task_pairs(frame, starts, radius)
            c = frame["c"].to_numpy()
            apart = c[a] != c[b]
            yield frame.iloc[np.unique(np.r_[a[apart], b[apart]])]

    ddl = "tab int, key bigint, g binary, c binary, fp bigint, ci int, cj int, side int"
    asked = written(dealt.select("tab", "key", "g", "c", "fp", "ci", "cj", "side").mapInPandas(candidates, ddl), "candidates")

    def decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_tasks(frames, 512):
            a, b = task_pairs(frame, starts, radius)
            c, g = frame["c"].to_numpy(), frame["g"].to_numpy()
            got = joined([np.frombuffer(s, "<u4") for s in frame["s"]], c, a, b, least)
            yield pd.DataFrame([(g[i], g[j]) for i, j in got], columns=["a", "b"])

    full = asked.join(sets, "g").repartition(*TASK).sortWithinPartitions(*TASK, "side", "g")
    links_ = links_.unionByName(written(full.mapInPandas(decide, "a binary, b binary"), "more-links"))
    return written(components(links_), "components")


def _similar(docs: DataFrame, key: str, text: str, shingle: int, least: float, radius: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, sha) of docs, and (sha, component, component_id) of each text."""
    bounded_batches(docs)

    @F.pandas_udf("struct<g binary, fp bigint, keys array<bigint>>")
    def marks(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_128_digest

        for batch in texts:
            out = []
            for t in batch:
                parts = list(shingle_hashes(t, shingle))
                every = np.unique(np.concatenate(parts)) if parts else np.zeros(0, "<u8")
                out.append((xxh3_128_digest(every.tobytes()), np.uint64(vote([every])).astype(np.int64), band_keys(parts)))
            yield pd.DataFrame(out, columns=["g", "fp", "keys"])

    @F.pandas_udf("binary")
    def sets_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shingle_set(t, shingle).tobytes() for t in batch], dtype=object)

    body = text_or_empty(text)
    rows = docs.select(F.col(key).alias("id"), text_digest(text).alias("sha"), marks(body).alias("m"))
    rows = written(rows.select("id", "sha", "m.*"), "marks")
    # texts with equal shingle sets are one node
    nodes = written(rows.groupBy("g").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "sha")).alias("of"), F.first("fp").alias("fp"), F.first("keys").alias("keys")), "nodes")
    spread = nodes.select("g", "fp", F.explode("keys").alias("bucket"))
    full = spread.groupBy("bucket").agg(F.min(F.struct("g", "fp")).alias("x"), F.max("g").alias("last")).where("x.g <> last")
    full = written(full.select("bucket", F.col("x.g").alias("first"), F.col("x.fp").alias("ffp")), "buckets")
    members = written(spread.join(full, "bucket"), "members")
    # the texts of those nodes, each from one row: by key and digest, so that copies of one text spread out
    asked = written(members.select("g").distinct().join(nodes, "g").select("g", "of.id", "of.sha"), "asked")
    bodies = docs.select(F.col(key).alias("bid"), text_digest(text).alias("bsha"), body.alias("t"))
    one = bodies.join(asked, (F.col("bsha") == F.col("sha")) & F.col("bid").eqNullSafe(F.col("id")))
    sets = written(one.select("g", sets_of("t").alias("s")).groupBy("g").agg(F.first("s").alias("s")), "shingle-sets")
    found = _similar_links(members, sets, least, radius)
    named = _named(rows.select("id", "g"), "g", found)
    shas = written(rows.select("sha", "g").distinct(), "digests")
    return rows.select("id", "sha"), shas.join(named, "g").select("sha", "component", "component_id")


def similar_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SIMILAR_SHINGLE, least: float = LEAST, radius: int = RADIUS_SIMILAR
) -> DataFrame:
    """(key, component_id): a row for each row of docs."""
    rows, groups = _similar(docs, key, text, shingle, least, radius)
    return rows.join(groups, "sha").select(F.col("id").alias(key), "component_id")


def keep_first(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SIMILAR_SHINGLE, least: float = LEAST, radius: int = RADIUS_SIMILAR
) -> DataFrame:
    """docs with one row of each group of texts whose shingle sets have a coefficient of at least ``least``."""
    rows, groups = _similar(docs, key, text, shingle, least, radius)
    each = rows.groupBy("id", "sha").agg(F.count(F.lit(1)).alias("n")).join(groups, "sha")
    each = written(each.select("id", "sha", "n", "component"), "rows-of-groups")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "sha")
    first = written(each.groupBy("component").agg(F.min(order).alias("of")), "first-of-groups")
    each = written(each.join(first, "component").select("id", "sha", "n", (order == F.col("of")).alias("stays")), "decided")
    held = docs.select(boxed(docs).alias("row"), F.col(key).alias("bid"), text_digest(text).alias("bsha"))
    same = (F.col("bsha") == F.col("sha")) & F.col("bid").eqNullSafe(F.col("id"))
    kept = held.join(each.where(~F.col("stays")).select("id", "sha"), same, "left_anti")
    again = each.where("stays AND n > 1").select("id", "sha")
    if not again.isEmpty():
        once = kept.join(again, same, "left_semi").dropDuplicates(["bid", "bsha"])
        kept = kept.join(again, same, "left_anti").unionByName(once)
    return kept.select("row.*")
