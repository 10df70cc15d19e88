"""A first check of a new teacher: one prerequisite question with a known answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefmill.functions import json as J


def canary_issues(answer: Column, missing: list[str], cited: list[str]) -> Column:
    """Issues of an answer (JSON text) that should find the student not eligible, miss exactly ``missing`` and cite ``cited``."""
    v = J.value(answer)
    list_of = lambda name: J.strings(J.get(v, f"$.{name}"))
    want = lambda x: F.array(*map(F.lit, x))
    eligible = J.get(v, "$.eligible")
    right = F.coalesce((J.kind(eligible) == "boolean") & ~eligible.try_cast("boolean"), F.lit(False))
    rules = [
        ("eligibility", ~right),
        ("missing-prerequisite", ~F.coalesce(list_of("missing") == want(missing), F.lit(False))),
        ("catalog-citations", ~F.coalesce(F.size(F.array_except(want(cited), list_of("citations"))) == 0, F.lit(False))),
    ]
    found = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules]), lambda x: x.isNotNull())
    return F.when(F.size(J.parse_codes(answer)) > 0, F.array(F.lit("json"))).otherwise(found)
