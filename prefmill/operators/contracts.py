"""Issues of model answers, by task contract, as one array of codes for each row.

An answer is a JSON text and an oracle is the JSON text of what is right. A contract is
a table of rules; a rule is a pair of an issue code and a Column that is true where the
issue holds. Comparisons are loose as the data's are: numbers by value, true as 1;
eligible and answerDeferred want a real boolean.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.functions import json as J
from prefmill.functions.text import contains_fold, short, strip
from prefmill.operators.lessons import is_kind, items, lesson_issues

#: The fields of each contract's answers.
FIELDS = {
    "prerequisite-json-v1": ["eligible", "missingImmediate", "recommendedSequence", "explanation", "citations"],
    "schedule-json-v1": ["feasible", "sectionIds", "totalCredits", "conflicts", "explanation", "citations"],
    "degree-audit-json-v1": ["complete", "remainingByGroup", "eligibleOptions", "explanation", "citations"],
    "uncertainty-json-v1": ["answer", "known", "needed", "nextAction", "citations"],
    "tutor-json-v1": ["diagnosis", "hint", "workedExplanation", "checkQuestion", "checkAnswer", "citations"],
    "tool-call-json-v1": ["tool", "arguments", "reason", "answerDeferred"],
    "safety-json-v1": ["boundary", "cannotDo", "canHelpWith", "nextStep"],
}
#: Least lengths of free text.
LEAST = {
    "prerequisite-json-v1": {"explanation": 20},
    "schedule-json-v1": {"explanation": 20},
    "degree-audit-json-v1": {"explanation": 20},
    "uncertainty-json-v1": {"nextAction": 15},
    "tool-call-json-v1": {"reason": 15},
    "safety-json-v1": {"cannotDo": 15, "nextStep": 15},
}
#: Contracts for lesson kernels. Data that names them otherwise is read with ``kernels=``.
KERNELS = ("lesson-kernel-json-v1",)


def is_kernel(contract: Column, kernels: tuple[str, ...] = KERNELS) -> Column:
    return contract.isin(*kernels)


Rule = tuple[str, Column]


def plain(v: Column) -> Column:
    """A form in which equal values are equal texts: numbers as doubles, booleans as numbers, keys sorted."""
    k = J.kind(v)
    number = F.when(k == "boolean", F.when(v.try_cast("boolean"), 1.0).otherwise(0.0)).when(k.isin("integer", "number"), v.try_cast("double"))
    return F.when(v.isNull(), "null").otherwise(F.coalesce(F.concat(F.lit("#"), number.cast("string")), F.to_json(v)))


def differs(a: Column, b: Column) -> Column:
    return ~plain(a).eqNullSafe(plain(b))


def at(v: Column, name: str) -> Column:
    return J.get(v, f"$.{name}")


def string(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "string")


def citations(v: Column, oracle: Column) -> list[Rule]:
    given = J.strings(at(v, "citations"))
    ids = lambda name: F.coalesce(J.strings(at(oracle, name)), F.array().cast("array<string>"))
    return [
        ("citations-not-string-array", given.isNull()),
        ("hallucinated-citation", F.size(F.array_except(given, ids("allowedCitations"))) > 0),
        ("missing-required-citation", F.size(F.array_except(ids("requiredCitations"), given)) > 0),
    ]


def boolean_is(v: Column, want: Column) -> Column:
    return F.coalesce((J.kind(v) == "boolean") & (v.try_cast("boolean") == want), F.lit(False))


def _prerequisite(v: Column, o: Column) -> list[Rule]:
    allowed = at(o, "allowedRecommendedSequences").try_cast("array<variant>")
    allowed = F.coalesce(allowed, F.array(at(o, "recommendedSequence")))
    mine = plain(at(v, "recommendedSequence"))
    return [
        ("wrong-eligibility", ~boolean_is(at(v, "eligible"), at(o, "eligible").try_cast("boolean"))),
        ("wrong-missingImmediate", differs(at(v, "missingImmediate"), at(o, "missingImmediate"))),
        ("wrong-recommendedSequence", ~F.exists(allowed, lambda x: plain(x) == mine)),
    ]


def _same(*names: str) -> Callable[[Column, Column], list[Rule]]:
    return lambda v, o: [(f"wrong-{n}", differs(at(v, n), at(o, n))) for n in names]


def _schedule(v: Column, o: Column) -> list[Rule]:
    none = F.coalesce(F.to_json(at(v, "conflicts")) == "[]", F.lit(False))
    return [*_same("feasible", "sectionIds", "totalCredits")(v, o), ("unexpected-conflicts", ~none)]


def _uncertainty(v: Column, o: Column) -> list[Rule]:
    items = lambda n: F.when(J.kind(at(v, n)) == "array", at(v, n).try_cast("array<variant>"))
    want = string(o, "neededContains")
    told = F.exists(items("needed"), lambda x: contains_fold(J.text_of(x), want))
    return [
        ("unsupported-answer", differs(at(v, "answer"), at(o, "answer"))),
        ("known-not-list", ~F.coalesce(F.size(items("known")) > 0, F.lit(False))),
        ("missing-information-not-identified", ~F.coalesce(told, F.lit(False))),
    ]


def _tutor(v: Column, o: Column) -> list[Rule]:
    least = at(o, "minimumLengths").try_cast("map<string,int>")
    both = F.concat_ws(" ", J.text_of(at(v, "workedExplanation")), J.text_of(at(v, "checkAnswer")))
    fields = v.try_cast("map<string,variant>")
    # every name that the oracle bounds, whichever it is
    low = lambda n, k: F.length(strip(F.coalesce(J.text_of(F.try_element_at(fields, n)), F.lit("")))) < k
    found = F.transform(F.map_keys(F.map_filter(least, low)), lambda n: F.concat(F.lit("short-text:"), n))
    return [
        ("short-text:checkAnswer", short(J.text_of(at(v, "checkAnswer")), 1)),
        ("expected-answer-absent", ~contains_fold(both, string(o, "answerContains"))),
        ("", found),
    ]


def _tool(v: Column, o: Column) -> list[Rule]:
    a = at(v, "arguments")
    is_object = F.coalesce(J.kind(a) == "object", F.lit(False))
    keys = J.keys(a) == F.array(F.lit("courseCodes"), F.lit("term"))
    return [
        ("wrong-tool", differs(at(v, "tool"), at(o, "tool"))),
        ("arguments-not-object", ~is_object),
        ("wrong-course-codes", is_object & differs(at(a, "courseCodes"), at(o, "courseCodes"))),
        ("wrong-term", is_object & differs(at(a, "term"), at(o, "term"))),
        ("wrong-argument-keys", is_object & ~keys),
        ("answer-not-deferred", ~boolean_is(at(v, "answerDeferred"), F.lit(True))),
    ]


def _safety(v: Column, o: Column) -> list[Rule]:
    items = F.when(J.kind(at(v, "canHelpWith")) == "array", at(v, "canHelpWith").try_cast("array<variant>"))
    right = F.coalesce(F.size(items) == F.try_variant_get(o, "$.alternativeCount", "int"), F.lit(False))
    return [
        ("wrong-boundary", differs(at(v, "boundary"), at(o, "boundary"))),
        ("wrong-alternative-count", ~right),
        ("weak-alternative", right & F.exists(items, lambda x: F.length(strip(F.coalesce(x.try_cast("string"), F.to_json(x)))) < 15)),
    ]


RULES: dict[str, Callable[[Column, Column], list[Rule]]] = {
    "prerequisite-json-v1": _prerequisite,
    "schedule-json-v1": _schedule,
    "degree-audit-json-v1": _same("complete", "remainingByGroup", "eligibleOptions"),
    "uncertainty-json-v1": _uncertainty,
    "tutor-json-v1": _tutor,
    "tool-call-json-v1": _tool,
    "safety-json-v1": _safety,
}


def _codes(rules: list[Rule]) -> Column:
    """The codes of the rules that hold; a rule without a code brings an array of its own."""
    own = [F.coalesce(c, F.array().cast("array<string>")) for n, c in rules if not n]
    found = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules if n]), lambda x: x.isNotNull())
    return F.concat(found, *own) if own else found


def _kernel(v: Column, o: Column) -> Column:
    def extra(lessons: Column) -> Column:
        # without lessons there is an empty one, which differs in everything
        blank = lessons.isNull() | F.coalesce(F.size(lessons) == 0, F.lit(False))
        return J.once(F.get(lessons, F.lit(0)), lambda one: J.once(blank, lambda none: J.once(is_kind(one, "object"), lambda there: _codes(rules(one, none, there)))))

    def rules(one: Column, blank: Column, is_object: Column) -> list[Rule]:
        differ = lambda name: J.once(at(one, name), lambda mine: J.once(at(o, name), lambda right: differs(mine, right)))
        return [("wrong-lesson-id", blank | (is_object & differ("lessonId"))), ("source-facts-changed", blank | (is_object & differ("facts")))]

    return F.concat(lesson_issues(v), J.once(items(at(v, "lessons")), extra))


def validate(
    rows: DataFrame, contract: str = "contract", answer: str = "answer", oracle: str = "oracle", out: str = "issues", only: tuple[str, ...] | None = None,
    kernels: tuple[str, ...] = KERNELS,
) -> DataFrame:
    """rows with the sorted, distinct issues of each answer.

    only: the contracts that occur, where that is known; it keeps the plan small. kernels: the names of lesson-kernel contracts. The parsed answer and oracle are named intermediate columns, so each is parsed once.
    """
    t = rows.withColumns({"_v": J.value(F.col(answer)), "_o": F.try_parse_json(oracle)}).withColumn("_codes", J.codes_of(F.col("_v")))
    v, o = F.col("_v"), F.col("_o")
    found = F.array(F.lit("unknown-contract"))
    if only is None or any(c in kernels for c in only):
        found = F.when(is_kernel(F.col(contract), kernels), _kernel(v, o)).otherwise(found)
    for name, rules in RULES.items():
        if only is not None and name not in only:
            continue
        every = [*rules(v, o), *[(f"short-text:{n}", short(J.text_of(at(v, n)), k)) for n, k in LEAST.get(name, {}).items()]]
        if "citations" in FIELDS[name]:
            every += citations(v, o)
        issues = F.concat(J.exact_keys(J.keys(v), FIELDS[name]), _codes(every))
        found = F.when(F.col(contract) == name, issues).otherwise(found)
    issues = F.when(F.size("_codes") > 0, F.col("_codes")).otherwise(F.array_sort(F.array_distinct(found)))
    return t.withColumn(out, issues).drop("_codes", "_v", "_o")


def _put(v: Column, name: str, new: Column) -> Column:
    """The text of a JSON object with one field replaced by JSON text; keys come out sorted."""
    fields = F.map_filter(v.try_cast("map<string,variant>"), lambda k, _: k != name)
    fields = F.map_concat(fields, F.create_map(F.lit(name), F.try_parse_json(new)))
    entries = F.transform(F.array_sort(F.map_entries(F.transform_values(fields, lambda _, x: F.to_json(x)))), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"]))
    return F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}"))


def _set(text: Column, name: str, new: Column) -> Column:
    return _put(F.try_parse_json(text), name, new)


#: Fixed value: what the rejected lesson claims.
UNSOUND = "An unsupported fact was added without a source."


def _unsound(v: Column) -> Column:
    """The text of an answer whose first lesson has UNSOUND as its first fact."""

    def edited(lesson: Column) -> Column:
        facts = at(lesson, "facts").try_cast("array<string>")
        changed = J.once(facts, lambda x: F.to_json(F.concat(F.array(F.lit(UNSOUND)), F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0))))))
        return _put(v, "lessons", F.concat(F.lit("["), _put(lesson, "facts", changed), F.lit("]")))

    return J.once(J.get(v, "$.lessons[0]"), edited)


def rejected(contract: Column, answer: Column, oracle: Column, kernels: tuple[str, ...] = KERNELS) -> Column:
    """The answer with one wrong edit, as JSON text with sorted keys; null for an unknown contract."""
    o, v = F.try_parse_json(oracle), F.try_parse_json(answer)
    left = at(v, "remainingByGroup").try_cast("map<string,bigint>")
    first = F.array_min(F.map_keys(left))
    more = F.to_json(F.transform_values(left, lambda k, n: F.when(k == first, n + 1).otherwise(n)))
    eligible = at(o, "eligible").try_cast("boolean")
    return (
        F.when(contract == "prerequisite-json-v1", _set(answer, "eligible", F.when(eligible, "false").otherwise("true")))
        .when(contract == "schedule-json-v1", _set(answer, "totalCredits", (at(o, "totalCredits").try_cast("bigint") + 3).cast("string")))
        .when(contract == "degree-audit-json-v1", _set(answer, "remainingByGroup", more))
        .when(contract == "uncertainty-json-v1", _set(answer, "answer", F.lit('"yes"')))
        .when(contract == "tutor-json-v1", _set(answer, "citations", F.lit('["invented-source"]')))
        .when(contract == "tool-call-json-v1", _set(answer, "answerDeferred", F.lit("false")))
        .when(contract == "safety-json-v1", _set(answer, "canHelpWith", F.lit("[]")))
        .when(is_kernel(contract, kernels), J.once(v, _unsound))
    )


def construct_rejected(
    rows: DataFrame, contract: str = "contract", answer: str = "answer", oracle: str = "oracle", only: tuple[str, ...] | None = None, kernels: tuple[str, ...] = KERNELS
) -> DataFrame:
    """rows with ``rejected`` and its ``rejected_issues``.

    An edit that passes, or an unknown contract, is an error of the task: the query fails. A null answer
    has no edit. Answers that have ``issues`` already were never admitted, and their edits are not looked at.
    """
    edited = rows.withColumn("rejected", rejected(F.col(contract), F.col(answer), F.col(oracle), kernels))
    out = validate(edited, contract, "rejected", oracle, "rejected_issues", only, kernels)
    asked = F.col(answer).isNotNull() & ((F.size("issues") == 0) if "issues" in rows.columns else F.lit(True))
    passes = asked & (F.col("rejected").isNull() | (F.size("rejected_issues") == 0))
    told = F.raise_error(F.concat(F.lit("no wrong edit of an answer to "), F.coalesce(F.col(contract), F.lit("(none)"))))
    return out.withColumn("rejected_issues", F.when(passes, told.cast("array<string>")).otherwise(F.col("rejected_issues")))
