"""Deep-shallow suffix sorting for batches of short texts.

Shallow: multikey sorting on 8-byte characters. All suffixes are sorted by their class
so far and their next 8 bytes; equal ones stay in one class and only classes of several
suffixes take the next character, down to a depth of SHALLOW bytes. Deep: what is still
tied shares a long prefix, so each such class is ordered through a blind trie: inner
nodes hold only the position at which their subtrees branch and one byte for each
branch, a search reads just those bytes and then compares with a single suffix.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32


class BlindTrie:
    """Strings in order, with equal ones together; the strings themselves live in the leaves."""

    def __init__(self, first: bytes, name: int) -> None:
        self.root: list = [None, first, [name]]  # leaf: [None, string, names]; inner node: [position, {byte: node}]

    def add(self, s: bytes, name: int) -> None:
        # blind search: follow the branch bytes, skip what lies between
        node = self.root
        while node[0] is not None:
            p = node[0]
            c = s[p] if p < len(s) else -1
            node = node[1].get(c) or next(iter(node[1].values()))
        other = node[1]
        if other == s:
            node[2].append(name)
            return
        lcp = common_prefix(s, other)
        # descend again to where the true common prefix ends
        node = self.root
        above, via = None, None
        while node[0] is not None and node[0] < lcp:
            above, via = node, (s[node[0]] if node[0] < len(s) else -1)
            node = node[1][via]
        leaf = [None, s, [name]]
        mine = s[lcp] if lcp < len(s) else -1
        if node[0] == lcp:
            node[1][mine] = leaf
            return
        theirs = other[lcp] if lcp < len(other) else -1
        split = [lcp, {theirs: node, mine: leaf}]
        if above is None:
            self.root = split
        else:
            above[1][via] = split

    def classes(self) -> list[list[int]]:
        """The names of equal strings, class after class in ascending order of the strings."""
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if node[0] is None:
                out.append(node[2])
            else:
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
        return out


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


def sort_to_depth(buffer: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order the suffixes at ``starts`` within their groups by their first ``depth`` bytes.

    buffer: bytes, at least depth + 8 beyond the last start. Returns (order, cls): the
    positions of starts in (group, suffix) order, and for each position in that order the
    number of its class of equal prefixes.
    """
    n = len(starts)
    padded = np.concatenate([buffer, np.zeros(8, np.uint8)]).astype(np.uint64)
    char = np.zeros(len(buffer) + 1, np.uint64)  # the 8 bytes at each position as one character
    for k in range(8):
        char = (char << np.uint64(8)) | padded[k : k + len(char)]
    order = np.argsort(group, kind="stable")
    cls = np.zeros(n, np.int64)
    g = group[order]
    cls = np.cumsum(np.r_[False, g[1:] != g[:-1]]) if n else cls
    shallow = min(SHALLOW, depth) // 8 * 8
    for at in range(0, shallow, 8):
        tied = np.r_[False, cls[1:] == cls[:-1]]
        tied |= np.r_[tied[1:], False]
        where = np.flatnonzero(tied)
        if not len(where):
            break
        key = char[starts[order[where]] + at]
        by = np.lexsort((key, cls[where]))
        order[where] = order[where[by]]
        key = key[by]
        new = np.r_[False, cls[1:] != cls[:-1]]
        fresh = np.zeros(n, bool)
        fresh[where[1:]] = key[1:] != key[:-1]
        cls = np.cumsum(new | fresh)
    tied = np.flatnonzero(np.r_[False, cls[1:] == cls[:-1]])
    if not len(tied) or shallow >= depth:
        return order, cls
    # deep: one blind trie for each class of several suffixes
    raw = buffer.tobytes()
    first = np.searchsorted(cls, np.unique(cls[tied]), "left")
    last = np.searchsorted(cls, np.unique(cls[tied]), "right")
    fresh = np.zeros(n, bool)
    begin = starts.tolist()
    for a, b in zip(first.tolist(), last.tolist()):
        names = order[a:b].tolist()
        s = [raw[begin[i] + shallow : begin[i] + depth] for i in names]
        if b - a == 2:  # a trie of two leaves
            if s[0] != s[1]:
                fresh[a + 1] = True
                if s[1] < s[0]:
                    order[a], order[a + 1] = names[1], names[0]
            continue
        if s.count(s[0]) == len(s):
            continue
        trie = BlindTrie(s[0], names[0])
        for x, name in zip(s[1:], names[1:]):
            trie.add(x, name)
        at = a
        for k, same in enumerate(trie.classes()):
            order[at : at + len(same)] = same
            fresh[at] = k > 0
            at += len(same)
    return order, np.cumsum(np.r_[False, cls[1:] != cls[:-1]] | fresh)
