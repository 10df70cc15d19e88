"""N-gram Jaccard join: groups of documents whose sets of word shingles have a Jaccard coefficient of at least ``LEAST`` per cent.

A grouped prefix join. Documents with equal sets are one node. With shingles in a fixed order, the rarest
first, two sets that are alike share a shingle among the first floor(0.15 n) + 1 of each (their prefixes). Nodes with
equal prefixes and sizes collapse into one group; an index from prefix shingles to groups gives pairs of
groups, which sizes and positions filter before their members are expanded and verified on the whole sets.

1. ``_marks``: a row's set size and a digest of its set; rows with equal digests are one node.
2. ``_shared``: which nodes can have a partner at all. Of each set the smallest hashes, twice the prefix, are
   dealt by their high bits; alike sets share at least as many of those as ``_asked_of`` tells, so a node with fewer
   hashes that a second node has goes. A task sends a hash once, however many of its documents hold it.
3. ``_ordered``: the sets of the nodes left, written in lots; how many nodes hold each hash is
   counted by parts of the hash space and sent back to the lots that asked, which order, cut prefixes and name groups.
4. ``_links``: every member meets the first of its group, every group the first groups of its index entries; then the
   pairs of groups that components still hold apart, in full: an entry over ``MOST`` groups as pairs of chunks. Parities of
   the sets, a bit or two a hash, rule out most pairs that are not alike before any set moves; a task verifies the others itself and returns links alone, at most one for each two components it joins.

Links that would join what is joined already are not looked for, so a hot group of near copies costs
a few links a member, not all pairs; no partner that would join anything is left out.

Words lie between ASCII white space, A-Z lowered; a shingle is ``SHINGLE`` words, known by its XXH64. Texts with
fewer words are one shingle. Defined cases: a null text is empty; texts without words have an empty set and are linked
with nothing, each its own group; equal sets are linked, rows repeated or not; a component_id is the smallest
key of a group that is not null, and null in a group without any; very long texts are read whole; other columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.llm.common import bounded_batches, text_or_empty, written
from prefmill.llm.components import components
from prefmill.llm.hamming import TASK, deal, whole_tasks
from prefmill.llm.simhash_dedup import shingle_hashes

SHINGLE = 4
#: Per cent.
LEAST = 85
#: Hashes of one part, of one lot that a task sends, groups of one chunk of an index entry.
PART, LOT, MOST = 1 << 22, 1 << 20, 512
#: Hashes that an index entry, where it is looked at, gets of those before it.
BEFORE = 64
MOST_TASKS = 20000
#: Bits of the filter of texts: so many for each node, between these powers of two, in pieces of PIECE bytes.
NODE_BITS, LEAST_BITS, MOST_BITS, PIECE = 8, 16, 26, 1 << 12


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of one whole text's distinct shingles."""
    parts = list(shingle_hashes(text, shingle))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, "<u8")


def alike(a: np.ndarray, n: int, b: np.ndarray, m: int, least: int = LEAST) -> bool:
    """Whether sets of n and m hashes are alike, by those hashes of each that any other set holds."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= least * (n + m - both)


def parities(h: np.ndarray, n: int) -> bytes:
    """A bit for each low part of a hash: whether an odd number of the hashes have it. A power of two of bits, for a set of n hashes n at least."""
    width = max(64, 1 << (n - 1).bit_length())
    return np.packbits(np.bincount((h & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1, bitorder="little").tobytes()


def may_be_alike(x: bytes, n: int, y: bytes, m: int, alone: int, least: int = LEAST) -> bool:
    """Whether sets of n and m hashes may be alike by their parities: as many hashes at least are in one of them only as bits differ,
    and the ``alone`` ones that no other set holds."""
    a, b = (int.from_bytes(z, "little") for z in (x, y))
    wide, narrow = 8 * max(len(x), len(y)), 8 * min(len(x), len(y))
    if len(x) < len(y):
        a, b = b, a
    while wide > narrow:
        wide //= 2
        a = (a >> wide) ^ (a & ((1 << wide) - 1))
    return ((a ^ b).bit_count() + alone) * (100 + least) <= (100 - least) * (n + m)


def _spare(n: Column | int | np.ndarray, least: int):
    """How many hashes of n a partner may lack: n - ceil(n * least / 100)."""
    return F.floor(n * (100 - least) / 100) if isinstance(n, Column) else n * (100 - least) // 100


def _asked_of(n: np.ndarray, least: int) -> np.ndarray:
    """Of n hashes' first ones, how many at least a partner (never smaller than ceil(n * least / 100)) has among its first ones."""
    return np.maximum(1, _spare(-(-n * least // 100), least))


def _first(n: int, least: int) -> int:
    """How many of n hashes are dealt: prefixes longer by k share k hashes; k is what may be lacking."""
    spare = _spare(n, least)
    return spare + max(1, spare)


def _key(key: str, text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("-")), F.lit(":"), text), "UTF-8"), 256))


def _marks(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(id, dk, n, g, ref) of each row, written: set size, digest of the set, and 64 bits of that."""

    @F.pandas_udf("struct<n int, g binary, ref bigint>")
    def mark(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_128_digest

        for batch in texts:
            out = []
            for t in batch:
                s = shingle_set(t, shingle)
                g = xxh3_128_digest(s.tobytes())
                out.append((len(s), g if len(s) else None, int.from_bytes(g[:8], "little", signed=True) or 1))
            yield pd.DataFrame(out, columns=["n", "g", "ref"])

    body = text_or_empty(text)
    rows = docs.select(F.col(key).alias("id"), _key(key, body).alias("dk"), mark(body).alias("m"))
    return written(rows.select("id", "dk", "m.*"), "set-marks")


def _bits(total: int) -> int:
    """Of hashes, how many high bits name a part, so that a part has PART hashes or fewer."""
    return max(0, math.ceil(math.log2(max(1, total) / PART)))


def _cuts(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted hashes: the parts that occur and where each begins (with the end)."""
    part = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
    at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    return part[at], np.r_[at, len(h)]


def _low(h: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits below those that name the part."""
    return ((h >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype("<u4")


def _shared(docs: DataFrame, text: str, shingle: int, least: int, bits: int) -> DataFrame:
    """(ref, k): how many of the first hashes of a set another set has among its first ones, at least."""
    lot = LOT

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_128_digest

        held, refs, seen, size = [], [], set(), 0

        def given() -> Iterator[pd.DataFrame]:
            if not held:
                return
            h = np.concatenate(held)
            of = np.repeat(np.arange(len(held)), [len(x) for x in held])
            order = np.argsort(h, kind="stable")
            h, of = h[order], of[order]
            start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            count = np.diff(np.r_[start, len(h)])
            many = np.repeat(count > 1, count)
            mine = np.bincount(of[many], minlength=len(held))
            who = np.array(refs, np.int64)
            some = np.flatnonzero(mine)
            # a hash that several sets of this lot hold is sent once, for none of them
            owner = np.where(count > 1, np.int64(0), who[of[start]])
            h = h[start]
            parts, cuts = _cuts(h, bits)
            rows = []
            for p, a, b in zip(parts.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
                names, at = np.unique(owner[a:b], return_inverse=True)
                rows.append((p, 1, _low(h[a:b], bits).tobytes(), names.tobytes(), at.astype("<u4" if len(names) > 65535 else "<u2").tobytes()))
            rows.append((int(who[0] % (1 << bits)) if bits else 0, 0, mine[some].astype("<u4").tobytes(), who[some].tobytes(), b""))
            yield pd.DataFrame(rows, columns=["part", "kind", "low", "names", "at"])

        for frame in frames:
            for t in frame["t"]:
                s = shingle_set(t, shingle)
                if not len(s):
                    continue
                g = xxh3_128_digest(s.tobytes())
                if g in seen:
                    continue
                seen.add(g)
                first = s[: _first(len(s), least)].copy()
                held.append(first)
                refs.append(int.from_bytes(g[:8], "little", signed=True) or 1)
                size += len(first)
                if size >= lot:
                    yield from given()
                    held, refs, seen, size = [], [], set(), 0
        yield from given()

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, lows, owners = None, [], []

        def counted() -> Iterator[pd.DataFrame]:
            if not lows:
                return
            low, owner = np.concatenate(lows), np.concatenate(owners)
            order = np.lexsort((owner, low))
            low, owner = low[order], owner[order]
            new = np.r_[True, (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])]
            low, owner = low[new], owner[new]
            start = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
            n = np.diff(np.r_[start, len(low)])
            # sorted by owner, so an owner of 0 need not be first; any stands for two sets
            several = np.logical_or.reduceat(owner == 0, start) | (n > 1)
            names, k = np.unique(owner[np.repeat(several, n) & (owner != 0)], return_counts=True)
            yield pd.DataFrame({"ref": names, "k": k})

        for frame in frames:
            for part, kind, low, names, where in frame.itertuples(index=False, name=None):
                if not kind:
                    yield pd.DataFrame({"ref": np.frombuffer(names, "<i8"), "k": np.frombuffer(low, "<u4").astype(np.int64)})
                    continue
                if part != at:
                    yield from counted()
                    at, lows, owners = part, [], []
                who = np.frombuffer(names, "<i8")
                lows.append(np.frombuffer(low, "<u4"))
                owners.append(who[np.frombuffer(where, "<u4" if len(who) > 65535 else "<u2")])
        yield from counted()

    sent = docs.select(text_or_empty(text).alias("t")).mapInPandas(send, "part int, kind int, low binary, names binary, at binary")
    dealt = sent.repartition(min(1 << bits, MOST_TASKS), "part").sortWithinPartitions("part", "kind")
    return dealt.mapInPandas(count, "ref bigint, k bigint").groupBy("ref").agg(F.sum("k").alias("k"))


def _maybe(keys: DataFrame, key: str, bits: int):
    """A test of a binary column that holds for all the keys and for few others: one of 2 ** bits bits, named by the first bytes of the key, is set."""

    def spot(values: pd.Series) -> np.ndarray:
        first = np.frombuffer(b"".join(v[:8] for v in values), "<u8")
        return (first >> np.uint64(64 - bits)).astype(np.int64)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            at = np.unique(spot(frame[key]))
            yield pd.DataFrame({"piece": at // (8 * PIECE), "bit": at % (8 * PIECE)})

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            pieces = []
            for piece, own in frame.groupby("piece"):
                on = np.zeros(8 * PIECE, np.uint8)
                on[own["bit"].to_numpy()] = 1
                pieces.append((piece, np.packbits(on).tobytes()))
            yield pd.DataFrame(pieces, columns=["piece", "held"])

    spark = keys.sparkSession
    found = keys.select(key).mapInPandas(place, "piece bigint, bit bigint").repartition("piece").mapInPandas(fill, "piece bigint, held binary")
    held = np.zeros(max(PIECE, 1 << (bits - 3)), np.uint8)
    for piece, own in found.toLocalIterator():
        held[piece * PIECE : (piece + 1) * PIECE] |= np.frombuffer(own, np.uint8)
    sent = spark.sparkContext.broadcast(held.tobytes())

    @F.pandas_udf("boolean")
    def maybe(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype=bool)
        at, on = spot(values), np.frombuffer(sent.value, np.uint8)
        return pd.Series((on[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1)

    return maybe


def _lots(bodies: DataFrame, shingle: int) -> DataFrame:
    """bodies (nid, t) -> (lot, nids, sizes, hashes), written: the whole sets of some nodes in one row."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        lot, last = TaskContext.get().partitionId() << 33, None
        for frame in frames:
            nids, sets = [], []
            for nid, t in zip(frame["nid"], frame["t"]):
                if nid != last:
                    nids.append(nid)
                    sets.append(shingle_set(t, shingle))
                last = nid
            if nids:
                yield pd.DataFrame({"lot": [lot], "nids": [np.array(nids, "<i8").tobytes()], "sizes": [np.array([len(s) for s in sets], "<i4").tobytes()], "hashes": [np.concatenate(sets).tobytes()]})
                lot += 1

    return written(bodies.mapInPandas(pack, "lot bigint, nids binary, sizes binary, hashes binary"), "sets")


def _ordered(lots: DataFrame, least: int, bits: int) -> DataFrame:
    """lots -> (nid, n, alone, prefix, grp, bits, s), written: the hashes of the prefix that a second node has (from position ``alone`` on), the
    group, and the parities and all of the hashes that a second node has."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lot, hashes in zip(frame["lot"], frame["hashes"]):
                h, n = np.unique(np.frombuffer(hashes, "<u8"), return_counts=True)
                parts, cuts = _cuts(h, bits)
                rows = [(p, lot, _low(h[a:b], bits).tobytes(), n[a:b].astype("<u2" if n.max() < 65536 else "<u4").tobytes()) for p, a, b in zip(parts.tolist(), cuts[:-1], cuts[1:])]
                yield pd.DataFrame(rows, columns=["part", "lot", "low", "n"])

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []

        def counted() -> Iterator[pd.DataFrame]:
            if not held:
                return
            low = np.concatenate([x[1] for x in held])
            names, where = np.unique(low, return_inverse=True)
            total = np.bincount(where, np.concatenate([x[2] for x in held])).astype(np.int64)
            for lot, mine, _ in held:
                df = total[np.searchsorted(names, mine)]
                some = df > 1
                if some.any():
                    yield pd.DataFrame({"lot": [lot], "part": [at], "low": [mine[some].tobytes()], "df": [np.minimum(df[some], 0xFFFFFFFF).astype("<u4").tobytes()]})

        for frame in frames:
            for part, lot, low, n in frame.itertuples(index=False, name=None):
                if part != at:
                    yield from counted()
                    at, held = part, []
                low = np.frombuffer(low, "<u4")
                held.append((lot, low, np.frombuffer(n, "<u2" if len(n) == 2 * len(low) else "<u4").astype(np.int64)))
        yield from counted()

    asked = lots.select("lot", "hashes").mapInPandas(ask, "part int, lot bigint, low binary, n binary")
    answers = asked.repartition(min(1 << bits, MOST_TASKS), "part").sortWithinPartitions("part").mapInPandas(count, "lot bigint, part int, low binary, df binary")
    none = F.lit(None).cast("binary")
    both = lots.select("lot", F.lit(1).alias("kind"), F.lit(0).alias("part"), "nids", "sizes", "hashes", none.alias("low"), none.alias("df")).unionByName(
        answers.select("lot", F.lit(0).alias("kind"), "part", none.alias("nids"), none.alias("sizes"), none.alias("hashes"), "low", "df")
    )

    def order(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, known = None, []
        for frame in frames:
            for lot, kind, part, nids, sizes, hashes, low, df in frame.itertuples(index=False, name=None):
                if lot != at:
                    at, known = lot, []
                if not kind:
                    known.append((part, np.frombuffer(low, "<u4"), np.frombuffer(df, "<u4")))
                    continue
                yield _prefixes(np.frombuffer(nids, "<i8"), np.frombuffer(sizes, "<i4"), np.frombuffer(hashes, "<u8"), known, least, bits)

    ddl = "nid bigint, n int, alone int, prefix array<bigint>, grp binary, bits binary, s binary"
    # rows repeated as they are may stand in several lots
    return written(both.repartition("lot").sortWithinPartitions("lot", "kind").mapInPandas(order, ddl).dropDuplicates(["nid"]), "ordered")


def _prefixes(nids: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, known: list[tuple], least: int, bits: int) -> pd.DataFrame:
    """The rows of ``_ordered`` of one lot; known: (part, low, df) of the hashes that several nodes have."""
    from xxhash import xxh3_128_digest

    words = np.concatenate([(np.uint64(p) << np.uint64(32)) | low.astype(np.uint64) for p, low, _ in known]) if known else np.zeros(0, np.uint64)
    count = np.concatenate([df for _, _, df in known]).astype(np.int64) if known else np.zeros(0, np.int64)
    turn = np.argsort(words)
    words, count = words[turn], count[turn]
    mine = hashes >> np.uint64(32 - bits)
    spot = np.searchsorted(words, mine)
    df = np.ones(len(hashes), np.int64)
    if len(words):
        ok = words[np.minimum(spot, len(words) - 1)] == mine
        df[ok] = count[spot[ok]]
    out = []
    for nid, n, end in zip(nids.tolist(), sizes.tolist(), np.cumsum(sizes).tolist()):
        h, d = hashes[end - n : end], df[end - n : end]
        some = d > 1
        h, d = h[some], d[some]
        alone = n - len(h)
        prefix = h[np.lexsort((h, d))][: max(0, _spare(n, least) + 1 - alone)]
        if len(prefix):
            grp = xxh3_128_digest(np.int64(n).tobytes() + prefix.tobytes())
            out.append((nid, n, alone, prefix.view(np.int64), grp, parities(h, n), h.tobytes()))
    return pd.DataFrame(out, columns=["nid", "n", "alone", "prefix", "grp", "bits", "s"])


def _may(n: Column, at: Column, m: Column, bt: Column, least: int) -> Column:
    """Whether sets of n and m hashes that share their hashes at positions at and bt first can be alike, by size and by what is left."""
    return (F.least(n, m) * 100 >= F.greatest(n, m) * least) & (F.least(n - at, m - bt) * (100 + least) >= (n + m) * least)


def _verified(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) of nodes of ``_ordered`` whose sets are alike, written."""
    marks, sets = nodes.select("nid", "n", "alone", "bits"), nodes.select("nid", "n", "s")

    @F.pandas_udf("boolean")
    def may(left: pd.Series, n: pd.Series, right: pd.Series, m: pd.Series, alone: pd.Series) -> pd.Series:
        return pd.Series([may_be_alike(*row, least) for row in zip(left, n, right, m, alone)], dtype=bool)

    @F.pandas_udf("boolean")
    def ok(left: pd.Series, n: pd.Series, right: pd.Series, m: pd.Series) -> pd.Series:
        rows = zip(left, n, right, m)
        return pd.Series([alike(np.frombuffer(a, "<u8"), x, np.frombuffer(b, "<u8"), y, least) for a, x, b, y in rows], dtype=bool)

    # pairs are few bytes each; written, their size is known before any set moves, and of sets only those in a pair do
    pairs = pairs.select("a", "b").join(marks.toDF("a", "na", "xa", "pa"), "a").join(marks.toDF("b", "nb", "xb", "pb"), "b")
    pairs = written(pairs.where(may("pa", "na", "pb", "nb", F.col("xa") + F.col("xb"))).select("a", "b"), "pairs")
    right = sets.toDF("b", "nb", "sb").join(pairs.select("b").distinct(), "b", "left_semi")
    met = pairs.join(sets.toDF("a", "na", "sa"), "a").join(right, "b")
    return written(met.where(ok("sa", "na", "sb", "nb")).select("a", "b"), "verified")


def _joined(links: DataFrame) -> DataFrame:
    return written(components(links), "components")


def _of(found: DataFrame, node: str, name: str) -> DataFrame:
    return found.select(F.col("node").alias(node), F.col("component").alias(name))


def _links(nodes: DataFrame, least: int) -> DataFrame:
    """nodes of ``_ordered`` -> components (node, component) over all pairs that are alike."""
    sets = nodes.select("nid", "n", "s")
    members = nodes.select("nid", "n", "grp")
    groups = nodes.groupBy("grp").agg(F.min("nid").alias("first"), F.count(F.lit(1)).alias("size"), F.first("n").alias("n"), F.first("alone").alias("alone"), F.first("prefix").alias("prefix"))
    groups = written(groups, "prefix-groups")
    # groups are known by their first members; what an entry needs beside a hash and its position is fetched where it is looked at
    index = groups.select("first", "n", "alone", F.posexplode("prefix").alias("i", "key")).select("key", "first", "n", (F.col("alone") + F.col("i")).alias("at"))
    heads = index.groupBy("key").agg(F.min(F.struct("first", "n", "at")).alias("h"), F.max("first").alias("last")).where("h.first <> last")
    heads = heads.select("key", F.col("h.first").alias("head"), F.col("h.n").alias("hn"), F.col("h.at").alias("hat"))
    c = F.col
    near = index.join(heads, "key").where((c("first") != c("head")) & _may(c("n"), c("at"), c("hn"), c("hat"), least))
    near = written(near.select(c("first").alias("a"), c("head").alias("b")).distinct(), "near")
    # every member and the first of its group, every group and one head; then the other heads that this left apart
    own = members.join(groups.where("size > 1").select("grp", "first"), "grp").where("nid <> first").select(c("nid").alias("a"), c("first").alias("b"))
    links = _verified(own.unionByName(near.groupBy("a").agg(F.min("b").alias("b"))), nodes, least)
    found = _joined(links)
    apart = near.join(_of(found, "a", "ca"), "a", "left").join(_of(found, "b", "cb"), "b", "left")
    links = links.unionByName(_verified(apart.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"), nodes, least))
    found = _joined(links)
    # entries and groups that still hold several components, in full: parts of groups by their first members, then the members
    at = written(members.join(_of(found, "nid", "c"), "nid", "left").select("nid", "grp", F.coalesce("c", "nid").alias("c")), "members")
    parts = written(at.groupBy("grp", "c").agg(F.min("nid").alias("rep"), F.count(F.lit(1)).alias("many")), "parts-of-groups")
    # what stands before a hash in the prefix, at most BEFORE hashes: a pair that shares one of them is looked at there
    held = parts.join(groups.select("grp", "first", c("n").alias("size"), "alone", "prefix"), "grp")
    held = written(held.withColumn("lead", F.slice("prefix", 1, BEFORE)), "parts-in-order")
    index = held.select("rep", "first", "c", F.posexplode("prefix").alias("i", "key"))
    mixed = index.groupBy("key").agg(*[f(x).alias(f"{k}_{x}") for x in ("first", "c") for k, f in (("lo", F.min), ("hi", F.max))], F.count(F.lit(1)).alias("n"))
    mixed = written(mixed.where("lo_c <> hi_c AND lo_first <> hi_first").select("key", "n"), "mixed")
    rows = index.select("key", "rep", "i").join(mixed, "key").join(held.select("rep", "many", "size", "alone", "lead", "c"), "rep")
    rows = rows.select(F.lit(0).alias("tab"), "key", "rep", "many", "size", (c("alone") + c("i")).alias("at"), F.slice("lead", F.lit(1), F.least("i", F.lit(BEFORE))).alias("before"), "c", "n")
    split = parts.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    inner = held.join(split, "grp")
    none = F.array().cast("array<bigint>")
    rows = rows.unionByName(inner.select(F.lit(1).alias("tab"), F.xxhash64("grp").alias("key"), "rep", "many", "size", F.lit(0).alias("at"), none.alias("before"), "c", "n"))
    dealt = deal(rows, F.xxhash64("rep", F.lit(13)), MOST).repartition(*TASK).sortWithinPartitions(*TASK, "side", "rep")

    def tasks(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
        for frame, starts in whole_tasks(frames, size):
            for a, b in zip(starts, [*starts[1:], len(frame)]):
                yield frame.iloc[a:b]

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for task in tasks(frames, 8192):
            i, j = _candidates(task, least)
            if len(i):
                yield task.iloc[np.unique(np.r_[i, j])]

    def ask_again(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for task in tasks(frames, 2048):
            i, j = _candidates(task, least)
            ok = _close(task, i, j, least)
            if ok.any():
                yield task.iloc[np.unique(np.r_[i[ok], j[ok]])][cols]

    def decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for task in tasks(frames, 512):
            i, j = _candidates(task, least)
            if len(i):
                sets = [np.frombuffer(x, "<u8") for x in task["s"]]
                yield pd.DataFrame(_decided(task, sets, i, j, least), columns=["a", "b", "linked"])

    cols = [*TASK, "side", "rep", "many", "size", "at", "before", "c"]
    kinds = dict(dealt.dtypes)
    ddl = ", ".join(f"{x} {kinds[x]}" for x in cols)

    def met(asked: DataFrame, *what: str) -> DataFrame:
        mine = nodes.select(c("nid").alias("rep"), *what).join(asked.select("rep").distinct(), "rep", "left_semi")
        return asked.join(mine, "rep").repartition(*TASK).sortWithinPartitions(*TASK, "side", "rep")

    asked = written(dealt.select(*cols).mapInPandas(ask, ddl), "asked")
    # the parities tell most pairs that are not alike before any set moves
    asked = written(met(asked, "alone", "bits").mapInPandas(ask_again, ddl), "asked-again")
    told = written(met(asked, "s").mapInPandas(decide, "a bigint, b bigint, linked boolean"), "decided")
    links = links.unionByName(told.where("linked").select("a", "b"))
    found = _joined(links)
    part = written(parts.join(_of(found, "rep", "now"), "rep", "left").withColumn("now", F.coalesce("now", "rep")), "parts-now")
    side = lambda x: part.select(*[c(k).alias(f"{k}_{x}") for k in ("grp", "c", "rep", "many", "now")])
    still = told.where("NOT linked").select("a", "b").distinct().join(side("a"), c("a") == c("rep_a")).join(side("b"), c("b") == c("rep_b")).where("now_a <> now_b")
    still = written(still.drop("now_a", "now_b", "rep_a", "rep_b"), "pairs-to-expand")
    if still.isEmpty():
        return found
    return _joined(links.unionByName(_expanded(still, at.join(sets, "nid"), least)))


def _expanded(pairs: DataFrame, members: DataFrame, least: int) -> DataFrame:
    """pairs of parts of groups (a, grp_a, c_a, many_a, ... b), each part of one component, and members (nid, grp, c, n, s) -> (a, b): a link for
    each pair of chunks of members that has any, written."""
    chunks = {x: F.ceil(F.col(f"many_{x}") / F.lit(float(MOST))).cast("int") for x in "ab"}
    pairs = pairs.withColumns({"na": chunks["a"], "nb": chunks["b"]})
    none = F.lit(0)

    def dealt(x: str, other: str) -> DataFrame:
        met = pairs.select("a", "b", f"grp_{x}", f"c_{x}", "na", "nb").join(members.toDF("nid", f"grp_{x}", f"c_{x}", "n", "s"), [f"grp_{x}", f"c_{x}"])
        mine = F.pmod(F.xxhash64("nid", F.lit(14)), F.col(f"n{x}")).cast("int")
        all_ = F.explode(F.sequence(none, F.col(f"n{other}") - 1))
        return met.select("a", "b", mine.alias(f"i{x}"), all_.alias(f"i{other}"), F.lit(int(x == "b")).alias("side"), "nid", "n", "s")

    def decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, first, links = None, [], []
        for frame in frames:
            for a, b, i, j, side, nid, n, s in frame.itertuples(index=False, name=None):
                if (a, b, i, j) != task:
                    task, first, done = (a, b, i, j), [], False
                mine = np.frombuffer(s, "<u8")
                if not side:
                    first.append((nid, n, mine))
                elif not done:
                    hit = next((x for x, m, t in first if alike(t, m, mine, n, least)), None)
                    if hit is not None:
                        done = True
                        links.append((max(hit, nid), min(hit, nid)))
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")
            links = []

    cols = ["a", "b", "ia", "ib"]
    rows = dealt("a", "b").unionByName(dealt("b", "a")).select(*cols, "side", "nid", "n", "s").repartition(*cols).sortWithinPartitions(*cols, "side")
    return written(rows.mapInPandas(decide, "a bigint, b bigint"), "expanded")


def _candidates(task: pd.DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in one task of the pairs that different components hold and that sizes and positions allow.

    A pair that shares one of the hashes before is a pair of that hash's entry, and left to it.
    """
    n, at, c, side, rep = (task[k].to_numpy().astype(np.int64) for k in ("size", "at", "c", "side", "rep"))
    lanes = np.flatnonzero(side == 0)
    alone = bool((task["ci"] == task["cj"]).iloc[0])
    asks = lanes if alone else np.flatnonzero(side == 1)
    if not len(lanes) or not len(asks):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x, y = lanes[None, :], asks[:, None]
    big, small = np.maximum(n[x], n[y]), np.minimum(n[x], n[y])
    rest = np.minimum(n[x] - at[x], n[y] - at[y])
    ok = (c[x] != c[y]) & (small * 100 >= big * least) & (rest * (100 + least) >= (n[x] + n[y]) * least)
    if alone:
        ok &= rep[y] > rep[x]
    if not ok.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = task["before"].tolist()
    size = np.array([len(b) for b in before])
    if size.any():
        _, spot = np.unique(np.concatenate([np.asarray(b, np.int64) for b in before]), return_inverse=True)
        held = np.zeros((len(task), int(spot.max()) + 1), np.float32)
        held[np.repeat(np.arange(len(task)), size), spot] = 1
        ok &= held[asks] @ held[lanes].T == 0
    i, j = np.nonzero(ok)
    return asks[i], lanes[j]


def _close(task: pd.DataFrame, i: np.ndarray, j: np.ndarray, least: int) -> np.ndarray:
    """Which pairs of a task may be alike by their parities, or stand for several pairs of members, of which these tell nothing."""
    bits, n, alone, many = (task[k].tolist() for k in ("bits", "size", "alone", "many"))
    rows = zip(i.tolist(), j.tolist())
    return np.array([many[a] * many[b] > 1 or may_be_alike(bits[a], n[a], bits[b], n[b], alone[a] + alone[b], least) for a, b in rows], bool)


def _decided(task: pd.DataFrame, sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, least: int) -> list[tuple[int, int, bool]]:
    """(a, b, True) for pairs that are alike and join what neither components nor earlier pairs join, (a, b, False) for those that stay
    apart where one stands for several members."""
    rep, n, many = task["rep"].tolist(), task["size"].tolist(), task["many"].tolist()
    label = task["c"].tolist()
    parent = {x: x for x in label}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out, apart = [], []
    for a, b in zip(i.tolist(), j.tolist()):
        x, y = root(label[a]), root(label[b])
        if x == y:
            continue
        if alike(sets[a], n[a], sets[b], n[b], least):
            parent[x] = y
            out.append((rep[a], rep[b], True))
        elif many[a] * many[b] > 1:
            apart.append((a, b))
    return out + [(rep[a], rep[b], False) for a, b in apart if root(label[a]) != root(label[b])]


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """(key, n_shingles, component_id): a row for each row of docs."""
    bounded_batches(docs)
    rows = _marks(docs, key, text, shingle)
    spare = _spare(F.col("n"), least)
    total = rows.agg(F.sum(spare + F.greatest(F.lit(1), spare))).first()[0] or 0
    k = _shared(docs, text, shingle, least, _bits(total))
    nodes = rows.where("n > 0").groupBy("g").agg(F.first("n").alias("n"), F.first("ref").alias("ref"), F.min("dk").alias("dk"))
    need = F.greatest(F.lit(1), _spare(F.ceil(F.col("n") * least / 100), least))
    left = nodes.join(k, "ref").where(F.col("k") >= need)
    left = written(left.select("g", "n", "dk", F.monotonically_increasing_id().alias("nid")), "nodes")
    body = text_or_empty(text)
    # of the texts only those of nodes travel, and some few more; always by a shuffle, so that the cost grows evenly
    most = math.ceil(math.log2(max(1, NODE_BITS * left.count())))
    maybe = _maybe(left, "dk", min(MOST_BITS, max(LEAST_BITS, most)))
    bodies = docs.select(_key(key, body).alias("dk"), body.alias("t")).where(maybe("dk"))
    bodies = bodies.join(left.select("dk", "nid").hint("merge"), "dk").select("nid", "t")
    lots = _lots(bodies, shingle)
    size = left.agg(F.sum("n")).first()[0] or 0
    found = _links(_ordered(lots, least, _bits(size)), least)
    # names
    names = left.select("nid", "g")
    linked = found.join(names, F.col("node") == F.col("nid")).select("g", "component")
    least_id = rows.where("n > 0").groupBy("g").agg(F.min("id").alias("id")).join(linked, "g", "left")
    least_id = written(least_id.select("g", "id", F.coalesce(F.col("component").cast("string"), F.hex("g")).alias("c")), "set-groups")
    named = least_id.select("g", "c").join(least_id.groupBy("c").agg(F.min("id").alias("component_id")), "c").select("g", "component_id")
    empty = rows.where("n = 0").select(F.col("id").alias(key), F.col("n").cast("bigint").alias("n_shingles"), F.col("id").alias("component_id"))
    return rows.where("n > 0").join(named, "g").select(F.col("id").alias(key), F.col("n").cast("bigint").alias("n_shingles"), "component_id").unionByName(empty)
