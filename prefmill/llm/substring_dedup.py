"""Exact removal of repeated substrings by a distributed, sampled suffix sort.

A byte is removed if some ``width``-byte string over it also starts earlier: in a
document with a smaller key, or further left in the same document. Strings never cross
documents and are judged on the input.

1. Sampling. In every window of ``width`` bytes, one ``GRAM``-byte string (the one with
   the smallest hash, leftmost) is its anchor; equal windows have equal anchors at equal
   offsets. Windows with one anchor are consecutive and form a run. In a stretch of a short period
   (rules, padding, zeros) every run has the anchor of the run before; where the bytes one period earlier are the same,
   all its windows repeat their own document, which is known at once: such runs are marked and go no further. Hashes of all other
   anchors are dealt out by value, and runs whose anchor occurs once are done.
2. Suffix sort. The remaining runs' bytes are dealt out by anchor. In a task, runs with
   equal bytes collapse into their earliest; the windows of what is left are sorted as
   suffixes to a depth of ``width`` by deep-shallow sorting (``suffix_sort``), and of each
   class with a common prefix of ``width`` all but the earliest are marked.
3. The runs of hot anchors (more than ``HOT``) are dealt out in salted parts and sorted so
   first; what is left of them, each window once a part, is then dealt out by its own
   bytes and sorted again.
4. Marked stretches meet their document again, which is cut and hashed.

Texts travel zstandard-compressed. Parts have a bounded share of an average corpus; a task
works through its parts one after another. What one anchor has is not bounded: all its
(document, place) pairs, 22 bytes each, meet in one task before its runs are salted.

Defined cases: a null text is empty; texts shorter than ``width`` lose nothing; rows
with equal keys count as different documents in an order fixed by their text's digest; a null key
is larger than any other; very long texts are cut into overlapping pieces of CHUNK bytes for
sampling; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefmill.llm.common import bounded_batches, release, text_or_empty, written
from prefmill.llm.suffix_sort import sort_to_depth

WIDTH = 100
GRAM = 48
HOT = 1 << 16
CHUNK = 1 << 19
FLUSH = 1 << 20
ANCHORS_PER_PART = 1 << 17
RUNS_PER_PART = 1 << 17
#: More parts than ONE_LEVEL are dealt out in two steps, and no shuffle has more tasks than MOST_TASKS: a task works part by part.
ONE_LEVEL = 1 << 14
MOST_TASKS = 20_000
RUNS_PER_FLUSH = 1 << 16
WINDOWS_PER_SORT = 1 << 17
#: Windows of one record of a stretch that repeats itself.
LONGEST = 60_000
_BASE = 0x9E3779B97F4A7C15
_PLACE = 24


def _byte_values() -> np.ndarray:
    """A pseudo-random odd number for each byte value."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each position, by doubling."""
    power, length = _byte_values()[data], 1
    out: np.ndarray | None = None
    done = 0
    while True:
        if size & length:
            if out is None:
                out, done = power, length
            else:
                n = len(data) - done - length + 1
                out = out[:n] * np.uint64(pow(_BASE, length, 1 << 64)) + power[done : done + n]
                done += length
        if done == size:
            break
        n = len(data) - 2 * length + 1
        power = power[:n] * np.uint64(pow(_BASE, length, 1 << 64)) + power[length : length + n]
        length *= 2
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while 2 * length <= width:
        x = np.minimum(x[: len(x) - length], x[length:])
        length *= 2
    rest = width - length
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def periodic(data: np.ndarray, begin: np.ndarray, start: np.ndarray, size: np.ndarray, anchor: np.ndarray, same: np.ndarray, width: int) -> np.ndarray:
    """Which runs hold only windows that stand already one period earlier in their document.

    same: whether a run's anchor equals that of the run before, in the same document. Their distance is the period to look at; the
    bytes decide.
    """
    out = np.zeros(len(start), bool)
    back = np.diff(anchor, prepend=0)
    ask = np.flatnonzero(same & (start - back >= begin))
    for d in np.unique(back[ask]).tolist():
        mine = ask[back[ask] == d]
        differ = np.zeros(len(data) + 1, np.int64)
        np.cumsum(data[d:] != data[:-d], out=differ[d + 1 :])
        out[mine] = differ[start[mine] + size[mine] + width - 1] == differ[start[mine]]
    return out


def runs(data: np.ndarray, begin: np.ndarray, end: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Runs of the documents data[begin:end] (laid end to end): document, first window within it, windows, anchor hash, and
    whether all its windows are known to repeat the document itself (``periodic``)."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))
    if len(data) < width:
        return none
    gram = min(GRAM, width // 2)
    h = gram_hashes(data, gram)
    mask = np.uint64((1 << _PLACE) - 1)
    key = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
    least = sliding_min(key, width - gram + 1)
    count = np.maximum(end - begin - width + 1, 0)
    doc = np.repeat(np.arange(len(begin)), count)
    window = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + begin[doc]
    if not len(window):
        return none
    anchor = (least[window] & mask).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
    size = np.diff(np.r_[first, len(window)])
    d, start, at, name = doc[first], window[first], anchor[first], h[anchor[first]]
    same = np.r_[False, (name[1:] == name[:-1]) & (d[1:] == d[:-1])]
    return d, start - begin[d], size, name, periodic(data, begin[d], start, size, at, same, width)


def text_runs(texts: list[bytes], width: int = WIDTH) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of many texts, by pieces of about CHUNK bytes; document numbers are positions in texts."""
    batch: list[tuple[int, int, bytes]] = []
    held = 0

    def flush() -> tuple[np.ndarray, ...]:
        data = np.frombuffer(b"".join(b for _, _, b in batch), np.uint8)
        size = np.array([len(b) for _, _, b in batch], np.int64)
        end = np.cumsum(size)
        d, at, n, h, known = runs(data, end - size, end, width)
        numbers = np.array([x for x, _, _ in batch], np.int64)
        shift = np.array([x for _, x, _ in batch], np.int64)
        return numbers[d], at + shift[d], n, h, known

    for i, t in enumerate(texts):
        # pieces of a long text overlap by width - 1 bytes: each window is in one piece
        for k in range(0, max(1, len(t) - width + 1), CHUNK):
            piece = t[k : k + CHUNK + width - 1]
            if len(piece) < width:
                continue
            batch.append((i, k, piece))
            held += len(piece)
            if held >= CHUNK:
                yield flush()
                batch, held = [], 0
    if batch:
        yield flush()


SAMPLE_DDL = "part bigint, names binary, doc binary, at binary, n binary, h binary"


def _pack_anchors(held: list[tuple[np.ndarray, ...]], parts: int) -> pd.DataFrame:
    """Anchors (document, first window, windows, hash) -> a packed row for each part."""
    ids, at, n, h = (np.concatenate(x) for x in zip(*held))
    part = (h % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part, ids, at, n, h = part[order], ids[order], at[order], n[order], h[order]
    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    out = []
    for a, b in zip(cut, np.r_[cut[1:], len(part)]):
        names, index = np.unique(ids[a:b], return_inverse=True)
        out.append(
            (int(part[a]), names.astype("<i8").tobytes(), index.astype("<u4").tobytes(), at[a:b].astype("<u4").tobytes(),
             n[a:b].astype("<u2").tobytes(), h[a:b].astype("<u8").tobytes())
        )
    return pd.DataFrame(out, columns=["part", "names", "doc", "at", "n", "h"])


def _pack_known(ids: np.ndarray, at: np.ndarray, n: np.ndarray, parts: int) -> pd.DataFrame:
    """Runs that repeat their own document -> one packed row without hashes, neighbours joined."""
    new = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (at[1:] != at[:-1] + n[:-1])])
    total = np.add.reduceat(n, new)
    pieces = -(-total // LONGEST)
    of = np.repeat(np.arange(len(new)), pieces)
    k = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    ids, at, n = ids[new][of], at[new][of] + k * LONGEST, np.minimum(LONGEST, total[of] - k * LONGEST)
    names, index = np.unique(ids, return_inverse=True)
    row = (int(ids[0]) % parts, names.astype("<i8").tobytes(), index.astype("<u4").tobytes(), at.astype("<u4").tobytes(), n.astype("<u2").tobytes(), b"")
    return pd.DataFrame([row], columns=["part", "names", "doc", "at", "n", "h"])


def _plain_anchors(b: tuple) -> tuple[np.ndarray, ...]:
    """The anchors of a packed row (names, doc, at, n, h)."""
    ids = np.frombuffer(b[0], "<i8")[np.frombuffer(b[1], "<u4")]
    return ids, np.frombuffer(b[2], "<u4"), np.frombuffer(b[3], "<u2"), np.frombuffer(b[4], "<u8")


def _deal_again(parts: int):
    """Packed anchors of coarse parts -> packed anchors of ``parts`` parts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for f in frames:
            known = f["h"].map(len) == 0
            if known.any():
                yield f[known]
            for r in f.loc[~known, ["names", "doc", "at", "n", "h"]].itertuples(index=False, name=None):
                held.append(_plain_anchors(r))
                rows += len(held[-1][0])
                if rows >= FLUSH:
                    yield _pack_anchors(held, parts)
                    held, rows = [], 0
        if held:
            yield _pack_anchors(held, parts)

    return run


def _sample(width: int, parts: int):
    """Documents (_id, _t) -> packed anchors, a row for each part and flush."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def flush() -> pd.DataFrame:
            return _pack_anchors(held, parts)

        for f in frames:
            ids = f["_id"].to_numpy()
            for d, at, n, h, known in text_runs([t.encode("utf-8", "surrogatepass") for t in f["_t"]], width):
                if known.any():
                    yield _pack_known(ids[d[known]], at[known], n[known], parts)
                    d, at, n, h = d[~known], at[~known], n[~known], h[~known]
                held.append((ids[d], at, n, h))
                rows += len(d)
                if rows >= FLUSH:
                    yield flush()
                    held, rows = [], 0
        if rows:
            yield flush()

    return run


def _repeated(hot: int):
    """Packed anchors of a part -> runs whose anchor occurs more than once, packed for each document."""

    def one(blocks: list[tuple]) -> pd.DataFrame:
        ids, at, n, h = (np.concatenate(x) for x in zip(*[_plain_anchors(b[1:]) for b in blocks]))
        order = np.argsort(h, kind="stable")
        h = h[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        size = np.diff(np.r_[first, len(h)])
        times = np.repeat(size, size)
        keep = times > 1
        order, h, times = order[keep], h[keep], times[keep]
        salts = -(-times // hot)
        ids, at, n = ids[order], at[order], n[order]
        by = np.argsort(ids, kind="stable")
        ids, at, n, h, salts = ids[by], at[by], n[by], h[by], salts[by]
        cut = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)
        out = [
            (int(ids[a]), at[a:b].tobytes(), n[a:b].tobytes(), h[a:b].tobytes(), salts[a:b].astype("<u4").tobytes())
            for a, b in zip(cut, np.r_[cut[1:], len(ids)])
        ]
        return pd.DataFrame(out, columns=["_id", "at", "n", "h", "salts"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, blocks = None, []
        for f in frames:
            for r in f.itertuples(index=False, name=None):
                if not r[5]:  # nothing is asked of these
                    ids, index = np.frombuffer(r[1], "<i8"), np.frombuffer(r[2], "<u4")
                    at, n = np.frombuffer(r[3], "<u4"), np.frombuffer(r[4], "<u2")
                    own = [np.flatnonzero(index == k) for k in range(len(ids))]
                    yield pd.DataFrame([(int(i), at[o].tobytes(), n[o].tobytes(), b"", b"") for i, o in zip(ids, own)], columns=["_id", "at", "n", "h", "salts"])
                    continue
                if r[0] != part and blocks:
                    yield one(blocks)
                    blocks = []
                part = r[0]
                blocks.append(r)
        if blocks:
            yield one(blocks)

    return run


def _contexts(width: int, parts: int):
    """Documents with the runs to look at -> packed runs with their bytes, a row for each part and flush."""
    import zlib

    names = ["part", "g", "salt", "hot", "ids", "at", "size", "bodies"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        plain = zstandard.ZstdDecompressor().decompress
        pack = zstandard.ZstdCompressor(level=3).compress
        held: list[tuple] = []

        def flush() -> pd.DataFrame:
            g, salt, hot, ids, at = (np.array(x) for x in zip(*(r[:5] for r in held)))
            body = [r[5] for r in held]
            size = np.fromiter(map(len, body), np.int64, len(body))
            mixed = (g.astype(np.int64).view(np.uint64) >> np.uint64(20)) + salt.astype(np.uint64) * np.uint64(_BASE)
            part = (mixed % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((g, part))
            cut = np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1]])
            out = []
            for a, b in zip(cut, np.r_[cut[1:], len(order)]):
                o = order[a:b]
                out.append(
                    (int(part[o[0]]), g[o].astype("<i8").tobytes(), salt[o].astype("<u4").tobytes(), hot[o].astype("<u2").tobytes(),
                     ids[o].astype("<i8").tobytes(), at[o].astype("<u4").tobytes(), size[o].astype("<u2").tobytes(),
                     pack(b"".join([body[i] for i in o.tolist()])))
                )
            held.clear()
            return pd.DataFrame(out, columns=names)

        for f in frames:
            for i, z, lists in zip(f["_id"], f["_z"], f["runs"]):
                t = plain(z)
                for x in lists:
                    at, n = np.frombuffer(x["at"], "<u4").tolist(), np.frombuffer(x["n"], "<u2").tolist()
                    h, salts = np.frombuffer(x["h"], "<i8").tolist(), np.frombuffer(x["salts"], "<u4").tolist()
                    for a, k, g, s in zip(at, n, h, salts):
                        salt = zlib.crc32(b"%d %d" % (i, a)) % s if s > 1 else 0
                        held.append((g, salt, s > 1, i, a, t[a : a + k + width - 1]))
                if len(held) >= RUNS_PER_FLUSH:
                    yield flush()
        if held:
            yield flush()

    return run


CONTEXT_DDL = "part bigint, g binary, salt binary, hot binary, ids binary, at binary, size binary, bodies binary"


def repeats(group: np.ndarray, ids: np.ndarray, at: np.ndarray, body: list[bytes], width: int) -> tuple[np.ndarray, ...]:
    """(run, step) of every window in the runs that equals an earlier one of its group, then of those that do not.

    Many windows are sorted in several lots; windows with equal first 8 bytes share one.
    """
    size = np.array([len(b) for b in body], np.int64)
    end = np.cumsum(size)
    count = size - width + 1
    run = np.repeat(np.arange(len(body), dtype=np.int32), count)
    step = (np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)).astype(np.int32)
    buffer = np.frombuffer(b"".join(body), np.uint8)
    start = (end - size)[run] + step
    lots = -(-len(run) // WINDOWS_PER_SORT)
    lot = np.zeros(len(run), np.int64)
    if lots > 1:
        h = np.zeros(len(run), np.uint64)
        for k in range(8):
            h = (h + buffer[start + k] + np.uint64(1)) * np.uint64(_BASE)
            h ^= h >> np.uint64(29)
        lot = (h % np.uint64(lots)).astype(np.int64)
    later, first = [], []
    for k in range(lots):
        mine = np.flatnonzero(lot == k) if lots > 1 else np.arange(len(run))
        order, cls = sort_to_depth(buffer, start[mine], group[run[mine]], width)
        mine = mine[order]
        i, w = ids[run[mine]], at[run[mine]] + step[mine]
        by = np.lexsort((w, i, cls))
        again = np.r_[False, cls[by][1:] == cls[by][:-1]]
        later.append(mine[by][again])
        first.append(mine[by][~again])
    a, b = np.concatenate(later), np.concatenate(first)
    return run[a], step[a], run[b], step[b]


def spans(ids: np.ndarray, at: np.ndarray, width: int) -> pd.DataFrame:
    """Window starts as stretches of bytes, neighbours joined."""
    by = np.lexsort((at, ids))
    ids, at = ids[by], at[by]
    cut = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (at[1:] - at[:-1] > width)]) if len(ids) else np.zeros(0, np.int64)
    last = np.r_[cut[1:], len(ids)] - 1
    return pd.DataFrame({"_id": ids[cut], "a": at[cut], "b": at[last] + width})


MARK = ["_id", "a", "b", "g", "body"]


def mark(g: np.ndarray, salt: np.ndarray, hot: np.ndarray, ids: np.ndarray, at: np.ndarray, body: list[bytes], width: int) -> Iterator[pd.DataFrame]:
    """Runs in any order -> marked stretches; the windows of hot anchors that are left come back with their bytes (b = -1)."""
    order = np.lexsort((at, ids, salt, g))
    k = np.stack([g[order], salt[order]])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(np.r_[False, (k[:, 1:] != k[:, :-1]).any(axis=0)])
    earliest: dict[tuple[int, bytes], int] = {}
    kept, gone = [], []
    for r, x in zip(order.tolist(), group[order].tolist()):
        (kept if earliest.setdefault((x, body[r]), r) == r else gone).append(r)
    if gone:
        i = np.array(gone)
        yield pd.DataFrame({"_id": ids[i], "a": at[i], "b": at[i] + [len(body[r]) for r in gone]}).reindex(columns=MARK)
    left = np.array(kept, np.int64)
    # a run alone under its anchor repeats nothing: its own windows have the anchor at different places
    left = left[hot[left] | (np.bincount(group[left], minlength=len(order) + 1)[group[left]] > 1)]
    ends = np.flatnonzero(np.r_[group[left][1:] != group[left][:-1], True]) + 1
    a = 0
    while a < len(left):
        b = int(ends[min(np.searchsorted(ends, a + 4096), len(ends) - 1)])  # whole groups
        part = left[a:b]
        run, step, run1, step1 = repeats(group[part], ids[part], at[part], [body[r] for r in part], width)
        if len(run):
            yield spans(ids[part[run]], at[part[run]] + step, width).reindex(columns=MARK)
        one = hot[part[run1]]
        if one.any():
            i, k = part[run1[one]], step1[one].tolist()
            text = [body[r][x : x + width] for r, x in zip(i.tolist(), k)]
            yield pd.DataFrame({"_id": ids[i], "a": at[i] + np.array(k), "b": -1, "g": g[i], "body": text})
        a = b


def _mark_packed(width: int):
    """Packed runs sorted by part -> what mark() gives for each part."""

    def one(blocks: list[tuple]) -> Iterator[pd.DataFrame]:
        import zstandard

        plain = zstandard.ZstdDecompressor().decompress
        field = lambda k, kind: np.concatenate([np.frombuffer(b[k], kind) for b in blocks])
        body: list[bytes] = []
        for b in blocks:
            text = plain(b[7])
            end = np.cumsum(np.frombuffer(b[6], "<u2").astype(np.int64)).tolist()
            body += [text[x:y] for x, y in zip([0, *end], end)]
        yield from mark(field(1, "<i8"), field(2, "<u4").astype(np.int64), field(3, "<u2").astype(bool), field(4, "<i8"), field(5, "<u4").astype(np.int64), body, width)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks: list[tuple] = []
        for f in frames:
            for r in f.itertuples(index=False, name=None):
                if blocks and blocks[0][0] != r[0]:
                    yield from one(blocks)
                    blocks = []
                blocks.append(r)
        if blocks:
            yield from one(blocks)

    return run


def _mark_windows(width: int):
    """Single windows sorted by the hash of their bytes -> marked stretches."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(f: pd.DataFrame) -> Iterator[pd.DataFrame]:
            none = np.zeros(len(f), np.int64)
            yield from mark(f["g"].to_numpy(), none, none.astype(bool), f["_id"].to_numpy(), f["at"].to_numpy(), f["body"].tolist(), width)

        held: list[pd.DataFrame] = []
        for frame in frames:
            if len(frame):
                held.append(frame)
            if sum(map(len, held)) < 40000:
                continue
            f = pd.concat(held, ignore_index=True)
            last = int(np.searchsorted(f["g"].to_numpy(), f["g"].iat[-1]))
            if last:
                yield from done(f.iloc[:last])
            held = [f.iloc[last:]]
        if held:
            yield from done(pd.concat(held, ignore_index=True))

    return run


def _known(width: int):
    """Packed runs that repeat their own document -> marked stretches."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for i, at, n in zip(f["_id"], f["at"], f["n"]):
                a = np.frombuffer(at, "<u4").astype(np.int64)
                yield pd.DataFrame({"_id": np.full(len(a), i), "a": a, "b": a + np.frombuffer(n, "<u2") + width - 1})

    return run


MARK_DDL = "_id bigint, a bigint, b bigint, g bigint, body binary"


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents with their marked stretches -> what is removed and what is left."""
    import zstandard

    plain = zstandard.ZstdDecompressor().decompress
    for f in frames:
        out = []
        for i, z, marks in zip(f["_id"], f["_z"], f["marks"]):
            data = plain(z) if z else b""
            kept, removed, n, done, end = [], [], 0, 0, -1
            for a, b in sorted((m["a"], m["b"]) for m in (marks if marks is not None else ())):
                if a > end:
                    if end >= 0:
                        removed.append((start, end))
                    start, end = a, b
                else:
                    end = max(end, b)
            if end >= 0:
                removed.append((start, end))
            for a, b in removed:
                kept.append(data[done:a])
                n += b - a
                done = b
            kept.append(data[done:])
            rest = b"".join(kept)
            out.append((i, len(data), n, len(removed), hashlib.sha256(rest).hexdigest(), [[a, b] for a, b in removed]))
        yield pd.DataFrame(out, columns=["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


CUT_DDL = "_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<array<bigint>>"


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, spans [[start, end), ...]): a row for each row of docs."""
    if not 8 <= width <= 30_000:
        raise ValueError("width must be from 8 to 30000 bytes")
    spark = bounded_batches(docs).sparkSession
    rows = docs.select(F.col(key).alias("_key"), text_or_empty(text).alias("_t"))
    n, known, size = rows.agg(F.count(F.lit(1)), F.count_distinct("_key"), F.sum(F.octet_length("_t"))).first()
    plain = known == n and dict(docs.dtypes)[key] in ("bigint", "int", "smallint", "tinyint")
    if plain:
        rows = rows.withColumn("_id", F.col("_key").cast("bigint"))
    else:  # keys repeat or are missing: number the rows in key order
        # the range partitioner samples these columns on the driver: the digest, not the text
        order = [F.col("_key").asc_nulls_last(), F.sha2(F.encode("_t", "UTF-8"), 256)]
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        rows = written(rows.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    parts = max(1, -(-int(size or 0) // (27 * ANCHORS_PER_PART)))

    @F.pandas_udf(T.BinaryType())
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for texts in batches:
            yield pd.Series([pack(t.encode("utf-8", "surrogatepass")) for t in texts], dtype=object)

    sampled = rows.select("_id", "_t").mapInPandas(_sample(width, parts), SAMPLE_DDL)
    if parts > ONE_LEVEL:  # rows of so many parts would hold an anchor or two each: deal out by coarse parts first
        coarse = math.isqrt(parts)
        parts = coarse * -(-parts // coarse)
        sampled = rows.select("_id", "_t").mapInPandas(_sample(width, coarse), SAMPLE_DDL).repartition(min(coarse, MOST_TASKS), "part").mapInPandas(_deal_again(parts), SAMPLE_DDL)
    sampled = sampled.repartition(min(parts, MOST_TASKS), "part").sortWithinPartitions("part")
    again = sampled.mapInPandas(_repeated(HOT), "_id bigint, at binary, n binary, h binary, salts binary")
    again = written(again, "repeated-anchors")
    release(spark)
    known = again.where(F.octet_length("h") == 0).select("_id", "at", "n").mapInPandas(_known(width), "_id bigint, a bigint, b bigint")
    again = again.where(F.octet_length("h") > 0)
    todo = again.groupBy("_id").agg(F.collect_list(F.struct("at", "n", "h", "salts")).alias("runs"))
    found = again.agg(F.sum(F.octet_length("n"))).first()[0] or 0
    parts = max(1, -(-int(found) // RUNS_PER_PART))
    contexts = rows.select("_id", packed("_t").alias("_z")).join(todo, "_id").mapInPandas(_contexts(width, parts), CONTEXT_DDL)
    contexts = contexts.repartition(min(parts, MOST_TASKS), "part").sortWithinPartitions("part")
    marked = written(contexts.mapInPandas(_mark_packed(width), MARK_DDL), "marked")
    release(spark)
    # what hot anchors left over: single windows, dealt out by their bytes
    hot = marked.where("b < 0").select(F.xxhash64("body").alias("g"), "_id", F.col("a").alias("at"), "body")
    hot = hot.repartition("g").sortWithinPartitions("g").mapInPandas(_mark_windows(width), MARK_DDL)
    marks = marked.where("b >= 0").select("_id", "a", "b").unionByName(hot.select("_id", "a", "b")).unionByName(known)
    marks = marks.groupBy("_id").agg(F.collect_list(F.struct("a", "b")).alias("marks"))
    done = rows.select("_id", packed("_t").alias("_z")).join(marks, "_id", "left").mapInPandas(_cut, CUT_DDL)
    if plain:
        return done.withColumnRenamed("_id", key)
    return rows.select("_id", F.col("_key").alias(key)).join(done, "_id").drop("_id")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    return remove_repeats(docs, key, text, width).select(key, "n_bytes", "n_removed", "n_spans", "kept_sha256")
