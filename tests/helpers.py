"""Comparison of a DataFrame with SQL."""

from __future__ import annotations


def plain(x):
    """A value as both engines show it."""
    if x is None or (isinstance(x, float) and x != x):
        return "null"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float)) or type(x).__name__ in ("Decimal",):
        return f"{float(x):.9g}"
    return str(x)


def same_rows(frame, sql, duck) -> None:
    """frame and the SQL's rows agree as multisets, columns matched by name."""
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    order = sorted(names)
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in cursor.fetchall())
    ours = sorted(tuple(plain(r[c]) for c in order) for r in frame.collect())
    assert ours == theirs
