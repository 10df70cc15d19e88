"""Fill-in-the-middle: texts rearranged around sentinels, on ropes, and back.

A text is cut at two unit ranks that its key's SHA-256 draws; a rope is split there and
the parts joined again with sentinel leaves. Units are code points, or what a pattern
matches from left to right. Three forms:

* ``psm``: <P> prefix <S> suffix <M> middle
* ``spm``: <S> suffix <P> prefix <M> middle
* ``plain``: the text as it is, for an empty text, one that holds a sentinel, and by lot

``restored`` undoes it from the output and the form alone: the sentinels' code-point ranks
cut the output's rope, and the parts are joined in the old order. A sentinel begins with its only
"<" and ends with its only ">", so none can straddle a cut, and a text without sentinels is
always told apart again.

Everything is within the row: no shuffle, and one text in memory at a time beside its
Arrow batch.

Defined cases: a null text is empty; a null key draws as an empty one; rows with equal keys and texts
give equal rows; a part may be empty; very long texts are handled whole; other columns
are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.llm import rope
from prefmill.llm.common import bounded_batches, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 lots of the third number those from this on stay plain; of 100 lots of the fourth those below this are spm.
PLAIN_FROM, SPM_BELOW = 90, 20
SEED = "1"


def lots(key: Column, seed: str = SEED) -> list[Column]:
    """Four numbers: the first four 8-digit groups of the SHA-256 of "seed:key"."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def rearranged(tree: rope.Rope, low: int, high: int, form: str) -> tuple[rope.Rope, int, int]:
    """The rope of the output, and the code points of prefix and middle."""
    first, suffix = rope.split(tree, high)
    prefix, middle = rope.split(first, low)
    order = ((PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle)) if form == "psm" else ((SUFFIX, suffix), (PREFIX, prefix), (MIDDLE, middle))
    out = rope.EMPTY
    for sentinel, part in order:
        out = rope.join(rope.join(out, rope.Rope(sentinel, [len(sentinel)])), part)
    return out, prefix.points, middle.points


def inverted(output: str, form: str) -> str:
    """The text that ``rearranged`` was given."""
    if form == "plain":
        return output
    tree = rope.build(output)
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    parts = {}
    for sentinel in (MIDDLE, second, first):  # from the right, so that the ranks on the left stay
        tree, tail = rope.split(tree, output.index(sentinel), by_points=True)
        parts[sentinel] = rope.split(tail, len(sentinel), by_points=True)[1]
    return str(rope.join(rope.join(parts[PREFIX], parts[MIDDLE]), parts[SUFFIX]))


def cut(text: str, h: tuple[int, int, int, int], pattern: re.Pattern[str] | None = None) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of prefix and middle, output) of one whole text."""
    tree = rope.build(text, pattern)
    n = tree.units
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= PLAIN_FROM:
        return n, "plain", None, None, text
    form = "spm" if h[3] % 100 < SPM_BELOW else "psm"
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    out, prefix, middle = rearranged(tree, low, high, form)
    return n, form, prefix, middle, str(out)


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str | None = None, seed: str = SEED) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output): a row for each row of docs.

    unit: a regular expression whose matches are the units; None: each code point is one.
    """
    bounded_batches(docs)
    pattern = re.compile(unit) if unit else None

    @F.pandas_udf("struct<n bigint, form string, prefix_chars bigint, middle_chars bigint, output string>")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, *h in batches:
            rows = [cut(t, x, pattern) for t, *x in zip(texts, *h)]
            out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
            yield out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    made = docs.select(F.col(key).alias(key), run(text_or_empty(text), *lots(F.col(key), seed)).alias("_m"))
    return made.select(key, "_m.*")


def restored(output: str = "output", form: str = "form") -> Column:
    """The exact text, from the output and the form."""

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for outputs, forms in batches:
            yield pd.Series([inverted(o, f) for o, f in zip(outputs, forms)], dtype=object)

    return run(F.col(output), F.col(form))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256), the texts cut by code points."""
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return transform(docs, key, text).select(
        key, "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(restored()).alias("restored_sha256"),
    )


def oracle_sql() -> str:
    """DuckDB SQL for the rows of ``report`` over documents."""
    groups = ", ".join(f"CAST('0x' || substr(d, {1 + 8 * i}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
    drawn AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, {groups} FROM texts),
    cuts AS (
        SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
            CASE WHEN n = 0 OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}') OR h3 % 100 >= {PLAIN_FROM} THEN 'plain'
                WHEN h4 % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form
        FROM drawn),
    parts AS (SELECT *, substr(t, 1, lo) AS p, substr(t, lo + 1, hi - lo) AS m, substr(t, hi + 1) AS s FROM cuts)
    SELECT doc_id, n, form,
        CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
            ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
        sha256(t) AS restored_sha256
    FROM parts"""
