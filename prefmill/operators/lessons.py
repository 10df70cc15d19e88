"""Issues of lessons, multiple-choice items, key terms and bundles of them (JSON variants).

Each shape is a table of text fields with least lengths plus a few structural rules;
issues of nested items carry the item's index as a prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefmill.functions import json as J
from prefmill.functions.text import fold, meta_phrases, short, squeezed, strip, words

#: The kinds of responses.
KINDS = ("lesson", "mc-item", "key-term", "source-bundle")
#: Field, least length, issue code.
TERM_TEXTS = (("tr", 2, "key-term-tr"), ("df", 20, "key-term-df"), ("eg", 12, "key-term-eg"), ("mi", 12, "key-term-mi"), ("cx", 18, "key-term-cx"))
ITEM_TEXTS = (("q", 12, "mc-question"), ("ex", 18, "mc-explanation"))
#: Object field, code if it is none, its texts, (list field, size, code).
PARTS = (
    ("scenario", "scenario-not-object", (("su", 35, "scenario-setup"), ("ma", 20, "scenario-materials")), None),
    ("discussionPrompt", "discussion-not-object", (("pr", 20, "discussion-question"), ("tn", 20, "discussion-tension")), ("po", 3, "discussion-positions-count")),
    ("assignmentCore", "assignment-not-object", (("td", 45, "assignment-description"),), ("pa", 4, "assignment-parameters-count")),
    ("studyGuide", "study-guide-not-object", (("sm", 60, "study-guide-summary"), ("rs", 30, "study-guide-strategy")), None),
)


def at(v: Column, name: str) -> Column:
    return J.get(v, f"$.{name}")


def is_kind(v: Column, kind: str) -> Column:
    return F.coalesce(J.kind(v) == kind, F.lit(False))


def items(v: Column) -> Column:
    """The elements of an array, null for anything else."""
    return v.try_cast("array<variant>")


def codes(*rules: tuple[str, Column]) -> Column:
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules]), lambda x: x.isNotNull())


def texts(v: Column, table: tuple) -> list[tuple[str, Column]]:
    return [(code, short(J.text_of(at(v, name)), least)) for name, least, code in table]


def of_all(values: Column, prefix: str, check) -> Column:
    """The issues of every element as prefix-index:issue."""
    each = F.transform(values, lambda x, i: F.transform(check(x), lambda c: F.concat(F.lit(prefix + "-"), i.cast("string"), F.lit(":"), c)))
    return F.flatten(each)


def term_issues(v: Column) -> Column:
    def found(text: Column) -> Column:
        return F.concat(
            codes(*[(code, F.length(text[n]) < least) for n, least, code in TERM_TEXTS], ("key-term-mi-equals-cx", squeezed(text["mi"]) == squeezed(text["cx"]))),
            J.once(words(text["mi"]), lambda w: codes(("key-term-mi-repeats-df", (F.size(w) > 0) & (w == words(text["df"]))))),
        )

    stripped = F.struct(*[strip(J.text_of(at(v, n))).alias(n) for n, _, _ in TERM_TEXTS])
    return F.when(is_kind(v, "object"), J.once(stripped, found)).otherwise(F.array(F.lit("key-term-not-object")))


def _option_issues(options: Column) -> Column:
    four = F.coalesce(F.size(options) == 4, F.lit(False))
    cleaned = F.transform(options, lambda x: strip(J.text_of(x)))
    wrong = J.once(cleaned, lambda x: codes(("mc-option-empty", F.array_contains(x, "")), ("mc-options-duplicate", F.size(F.array_distinct(F.transform(x, fold))) != 4)))
    return F.when(four, wrong).otherwise(F.array(F.lit("mc-options-count")))


def _index_issues(index: Column, limit: Column, need: Column) -> Column:
    """Issues of the numbers of the facts that an item rests on."""

    def found(lists: Column) -> Column:
        whole = F.forall(lists, lambda x: is_kind(x, "integer") & F.coalesce((x.try_cast("bigint") >= 0) & (x.try_cast("bigint") < limit), F.lit(False)))
        once = F.size(F.array_distinct(F.transform(lists, lambda x: F.to_json(x)))) == F.size(lists)
        wrong = codes(("mc-fact-index-invalid", ~F.coalesce(whole & once, F.lit(False))))
        return F.when(F.coalesce(F.size(lists).between(1, 2), F.lit(False)), wrong).otherwise(F.array(F.lit("mc-fact-index-count")))

    asked = need | F.coalesce(J.kind(index) != "null", F.lit(False))
    return F.when(asked, J.once(items(index), found)).otherwise(F.array().cast("array<string>"))


def item_issues(v: Column, facts: Column | None = None, need_facts: bool | Column = False) -> Column:
    answer = at(v, "ai")
    good_answer = is_kind(answer, "integer") & F.coalesce(answer.try_cast("bigint").between(0, 3), F.lit(False))
    keys = F.coalesce(J.keys(v), F.array().cast("array<string>"))
    index = F.when(F.array_contains(keys, "fi"), at(v, "fi")).otherwise(at(v, "sourceFactIndexes"))
    need = F.lit(need_facts) if isinstance(need_facts, bool) else need_facts
    limit = facts if facts is not None else F.lit(2**31)
    found = F.concat(
        J.once(items(at(v, "op")), _option_issues),
        codes(("mc-answer-index", ~good_answer), *texts(v, ITEM_TEXTS)),
        J.once(index, lambda x: _index_issues(x, limit, need)),
    )
    return F.when(is_kind(v, "object"), found).otherwise(F.array(F.lit("mc-not-object")))


def _part_issues(part: Column, none: str, table: tuple, sized: tuple | None) -> Column:
    rules = texts(part, table)
    if sized:
        field, n, code = sized
        rules.append((code, ~F.coalesce(F.size(items(at(part, field))) == n, F.lit(False))))
    return F.when(is_kind(part, "object"), codes(*rules)).otherwise(F.array(F.lit(none)))


def one_lesson(v: Column) -> Column:
    """Issues of a lesson. What several rules ask of is bound by ``once``: a name that only stands for an expression has its parts read
    again at each mention, and mentions within mentions multiply."""
    empty = F.array().cast("array<string>")

    def of_facts(facts: Column) -> Column:
        short_one = codes(("fact-too-short", F.exists(facts, lambda x: short(J.text_of(x), 20))))
        return F.when(_sized(facts, 5), short_one).otherwise(F.array(F.lit("facts-count")))

    def of_lists(lists: Column) -> Column:
        facts, terms, mc = lists["facts"], lists["terms"], lists["mc"]
        three, four = _sized(terms, 3), _sized(mc, 4)
        known = F.when(_sized(facts, 5), 5).otherwise(0)
        return F.concat(
            codes(("lesson-id", short(J.text_of(at(v, "lessonId")), 3))),
            of_facts(facts),
            codes(("key-terms-count", ~three), ("mc-count", ~four)),
            *[J.once(at(v, name), lambda part, rest=rest: _part_issues(part, *rest)) for name, *rest in PARTS],
            F.when(three, of_all(terms, "key-term", term_issues)).otherwise(empty),
            F.when(four, J.once(known, lambda k: of_all(mc, "mc", lambda x: item_issues(x, k, True)))).otherwise(empty),
            meta_phrases(F.to_json(v)),
        )

    lists = F.struct(items(at(v, "facts")).alias("facts"), items(at(v, "keyTerms")).alias("terms"), items(at(v, "mc")).alias("mc"))
    return F.when(is_kind(v, "object"), J.once(lists, of_lists)).otherwise(F.array(F.lit("lesson-not-object")))


def _sized(values: Column, n: int) -> Column:
    return F.coalesce(F.size(values) == n, F.lit(False))


def lesson_issues(v: Column) -> Column:
    """Issues of {"lessons": [lesson]}."""

    def found(lessons: Column) -> Column:
        return F.when(_sized(lessons, 1), J.once(F.get(lessons, F.lit(0)), one_lesson)).otherwise(F.array(F.lit("lessons-count")))

    return J.once(items(at(v, "lessons")), found)


def bundle_issues(v: Column) -> Column:
    """Issues of {"mcItems": [...], "keyTerms": [...]}."""
    some = lambda x: F.coalesce(F.size(x) > 0, F.lit(False))
    return F.concat(
        J.once(items(at(v, "mcItems")), lambda mc: F.when(some(mc), of_all(mc, "mc", item_issues)).otherwise(F.array(F.lit("bundle-mc-count")))),
        J.once(items(at(v, "keyTerms")), lambda terms: F.when(some(terms), of_all(terms, "key-term", term_issues)).otherwise(F.array(F.lit("bundle-key-term-count")))),
    )


def response_issues(kind: Column, v: Column, bad: Column) -> Column:
    """Issues of a response of a kind: lesson, mc-item, key-term or source-bundle; bad: its parse codes."""
    found = (
        F.when(kind == "lesson", lesson_issues(v))
        .when(kind == "mc-item", item_issues(v, None, F.array_contains(J.keys(v), "fi")))
        .when(kind == "key-term", term_issues(v))
        .when(kind == "source-bundle", bundle_issues(v))
        .otherwise(F.array(F.lit("unknown-response-kind")))
    )
    return F.when(F.size(bad) > 0, bad).otherwise(found)


def validate_responses(rows: DataFrame, kind: str = "kind", text: str = "text", kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """rows with issues and score of each response (JSON text). ``kinds`` names the kinds that occur, to keep the plan small.

    The parsed response is a named column, so it is parsed once.
    """
    parsed = rows.withColumn("_v", J.value(F.col(text))).withColumn("_bad", J.codes_of(F.col("_v")))
    v, bad = F.col("_v"), F.col("_bad")
    if len(kinds) == 1 and kinds[0] in ONE:
        issues = F.when(F.size(bad) > 0, bad).when(F.col(kind) == kinds[0], ONE[kinds[0]](v)).otherwise(F.array(F.lit("unknown-response-kind")))
    else:
        issues = response_issues(F.col(kind), v, bad)
    out = parsed.withColumn("issues", issues).drop("_bad", "_v")
    return out.withColumn("score", response_score(F.col("issues")))


def response_score(issues: Column) -> Column:
    """1 without issues, 0 if unreadable or of an unknown kind, else less by a twelfth for each issue."""
    fatal = F.arrays_overlap(issues, F.array(*map(F.lit, ("invalid-json", "root-not-object", "unknown-response-kind"))))
    n = F.size(issues)
    return F.when(n == 0, 1.0).when(fatal, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - F.least(F.lit(1.0), n.cast("double") / 12)))


#: The check of each kind, for rows of one kind.
ONE = {
    "lesson": lesson_issues,
    "mc-item": lambda v: item_issues(v, None, F.array_contains(J.keys(v), "fi")),
    "key-term": term_issues,
    "source-bundle": bundle_issues,
}
