"""An immutable rope: a balanced tree whose leaves cache how many units and code points they hold.

Units are whatever a caller counts in: code points, or the pieces that a pattern cuts a
text into. A tree is split at a unit rank or at a code-point rank in one walk from the
root; parts are joined again without touching the leaves that stay whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Units of a leaf that ``build`` makes.
LEAF = 2048


class Rope:
    """A leaf (text, and where its units end if they are not code points) or a pair of ropes."""

    __slots__ = ("ends", "height", "left", "points", "right", "text", "units")

    def __init__(self, text: str = "", ends: list[int] | None = None, left: Rope | None = None, right: Rope | None = None) -> None:
        self.text, self.ends, self.left, self.right = text, ends, left, right
        if left is None:
            self.points = len(text)
            self.units = len(text) if ends is None else len(ends)
            self.height = 0
        else:
            self.points = left.points + right.points
            self.units = left.units + right.units
            self.height = 1 + max(left.height, right.height)

    def leaves(self) -> Iterator[Rope]:
        """From left to right."""
        todo = [self]
        while todo:
            r = todo.pop()
            if r.left is None:
                yield r
            else:
                todo += (r.right, r.left)

    def __str__(self) -> str:
        return "".join([r.text for r in self.leaves()])


EMPTY = Rope()


def unit_ends(text: str, pattern: re.Pattern[str]) -> list[int]:
    """Where each unit ends: after every match, left to right; what follows the last match is a unit of its own."""
    ends = [m.end() for m in pattern.finditer(text) if m.end() > m.start()]
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return ends


def build(text: str, pattern: re.Pattern[str] | None = None, leaf: int = LEAF) -> Rope:
    """The rope of a whole text, with code points as units, or those of a pattern."""
    if pattern is None:
        level = [Rope(text[i : i + leaf]) for i in range(0, len(text), leaf)]
    else:
        ends, level, start = unit_ends(text, pattern), [], 0
        for i in range(0, len(ends), leaf):
            part = ends[i : i + leaf]
            level.append(Rope(text[start : part[-1]], [e - start for e in part]))
            start = part[-1]
    while len(level) > 1:
        pairs = [Rope(left=a, right=b) for a, b in zip(level[::2], level[1::2])]
        level = pairs + level[len(level) - len(level) % 2 :]
    return level[0] if level else EMPTY


def _pair(a: Rope, b: Rope) -> Rope:
    """a and b under one node, turned once where one is two levels higher."""
    if a.height > b.height + 1:
        if a.left.height >= a.right.height:
            return Rope(left=a.left, right=Rope(left=a.right, right=b))
        return Rope(left=Rope(left=a.left, right=a.right.left), right=Rope(left=a.right.right, right=b))
    if b.height > a.height + 1:
        if b.right.height >= b.left.height:
            return Rope(left=Rope(left=a, right=b.left), right=b.right)
        return Rope(left=Rope(left=a, right=b.left.left), right=Rope(left=b.left.right, right=b.right))
    return Rope(left=a, right=b)


def join(a: Rope, b: Rope) -> Rope:
    """a followed by b; the lower tree is hung in where the higher one has its height."""
    if not a.points:
        return b
    if not b.points:
        return a
    if a.height > b.height + 1:
        return _pair(a.left, join(a.right, b))
    if b.height > a.height + 1:
        return _pair(join(a, b.left), b.right)
    return Rope(left=a, right=b)


def split(rope: Rope, rank: int, by_points: bool = False) -> tuple[Rope, Rope]:
    """The first ``rank`` units (or code points) and the rest. A code-point rank within a unit cuts that unit in two."""
    size = rope.points if by_points else rope.units
    if rank <= 0:
        return EMPTY, rope
    if rank >= size:
        return rope, EMPTY
    if rope.left is not None:
        first = rope.left.points if by_points else rope.left.units
        if rank <= first:
            a, b = split(rope.left, rank, by_points)
            return a, join(b, rope.right)
        a, b = split(rope.right, rank - first, by_points)
        return join(rope.left, a), b
    if rope.ends is None:
        return Rope(rope.text[:rank]), Rope(rope.text[rank:])
    at = rank if by_points else rope.ends[rank - 1]
    before = [e for e in rope.ends if e < at] + [at]
    after = [e - at for e in rope.ends if e > at]
    return Rope(rope.text[:at], before), Rope(rope.text[at:], after)
