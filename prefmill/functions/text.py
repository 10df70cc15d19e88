"""Text functions as Column expressions, with the Unicode rules of the data's writers."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefmill.functions.json import once

#: White space at either end, Unicode-wide, with the four separator controls.
_ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(text: Column) -> Column:
    """Without white space at both ends, including NBSP and the like."""
    return F.regexp_replace(text, _ENDS, "")


def fence_strip(text: Column) -> Column:
    """Without a Markdown fence at the very start and one at the very end; then stripped.

    The closing fence goes even where no opening one was found; null counts as empty.
    """
    bare = F.coalesce(text, F.lit(""))
    for fence in (r"(?i)\A```json\s*", r"\A```\s*", r"```\s*\z"):
        bare = F.regexp_replace(bare, fence, "")
    return strip(bare)


def words(text: Column) -> Column:
    """The distinct runs of letters a-z and digits with over two characters, lower-cased, sorted."""
    found = F.regexp_extract_all(text, F.lit("(?iu)([a-z0-9]+)"), 1)
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, F.lower), lambda w: F.length(w) > 2)))


def squeezed(text: Column) -> Column:
    """Lower case with single spaces: for comparing wordings."""
    return strip(F.regexp_replace(F.lower(text), r"(?U)[\s\x1c-\x1f]+", " "))


@cache
def _foldings() -> tuple[str, str, dict[str, str]]:
    """Characters that fold to one character, what they fold to, and those that fold to several; from Unicode's own data."""
    every = {c: c.casefold() for c in map(chr, range(sys.maxunicode + 1)) if c.casefold() != c}
    one = {c: f for c, f in every.items() if len(f) == 1}
    return "".join(one), "".join(one.values()), {c: f for c, f in every.items() if len(f) > 1}


def fold(text: Column) -> Column:
    """Full case folding, as Unicode defines it: the sharp s is ss, all sigmas are one, ligatures come apart.

    Most texts take one translation. Those with a character that folds to several are gone through a character at a time.
    """
    source, to, several = _foldings()
    plain = F.translate(text, source, to)
    table = F.create_map(*[F.lit(x) for kv in several.items() for x in kv])
    letters = F.regexp_extract_all(plain, F.lit("(?s)."), F.lit(0))
    apart = F.array_join(F.transform(letters, lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    return F.when(text.rlike(f"[{''.join(several)}]"), apart).otherwise(plain)


def contains_fold(text: Column, part: Column) -> Column:
    """Whether text contains part, whatever the case."""
    return F.contains(fold(text), fold(part))


#: Wording that talks about the material instead of teaching it.
META_PHRASES = ("this lesson", "this course", "success criteria", "evidence moves", "weekly check")


def meta_phrases(text: Column, phrases: Sequence[str] = META_PHRASES) -> Column:
    """An issue code for each of the phrases that text contains."""

    def found(low: Column) -> Column:
        codes = [F.when(F.contains(low, F.lit(p)), F.lit("meta-language:" + p.replace(" ", "-"))) for p in phrases]
        return F.filter(F.array(*codes), lambda x: x.isNotNull())

    return once(F.lower(text), found)


#: Names of the reserved turn markers, written <|name> and <name|>.
MARKERS = ("turn", "channel", "tool", "tool_call", "tool_response")


def neutral(text: Column) -> Column:
    """Reserved markers in user text, defused by a space."""
    names = "|".join(sorted(MARKERS, key=len, reverse=True))
    text = F.regexp_replace(text, rf"<\|({names})>", "< |$1>")
    return F.regexp_replace(text, rf"<({names})\|>", "<$1| >")


def chat_prompt(messages: Column) -> Column:
    """An array of (role, content) as one prompt that ends where the model's turn begins."""

    def turn(m: Column) -> Column:
        role = F.when(m["role"] == "assistant", "model").otherwise(m["role"])
        return F.concat(F.lit("<|turn>"), role, F.lit("\n"), neutral(strip(m["content"])), F.lit("<turn|>\n"))

    return F.concat(F.array_join(F.transform(messages, turn), ""), F.lit("<|turn>model\n"))


def short(text: Column, least: int) -> Column:
    """Whether a text has fewer than ``least`` characters once stripped; null counts as empty."""
    return F.length(strip(F.coalesce(text, F.lit("")))) < least


def tensor_name(name: Column, prefix: str, to: str) -> Column:
    """The name of an adapter's tensor in the other layout: prefix swapped, .lora_a as .lora_A.weight; null if it is none."""
    stem = F.regexp_extract(name, rf"^\Q{prefix}\E(.+)\.lora_[ab]$", 1)
    good = (stem != "") & ~stem.startswith(".") & ~F.contains(stem, F.lit(".."))
    side = F.when(name.endswith(".lora_a"), ".lora_A.weight").otherwise(".lora_B.weight")
    return F.when(good, F.concat(F.lit(to), stem, side))


def distinct_in_order(values: Column) -> Column:
    """A list with each value once, where it first stands; nulls go."""
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull()))
