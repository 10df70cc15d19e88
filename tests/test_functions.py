"""Text, JSON and hash functions on literals."""

import json

import pytest
from pyspark.sql import functions as F

from prefmill.functions import hashing
from prefmill.functions import json as J
from prefmill.functions import text as X


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ('```json\n{"answer":true}\n``` ', '{"answer":true}'),
        ('```\n{"answer":true}\n``` ', '{"answer":true}'),
        ('before\n```json\n{"a":1}\n```', 'before\n```json\n{"a":1}'),
        ("  plain \n", "plain"),
        (None, ""),
    ],
)
def test_fence_strip(spark, raw, want):
    assert one(spark, X.fence_strip(F.col("s")), s=raw) == want


def test_chat_prompt(spark):
    rows = spark.createDataFrame(
        [([("system", " Rules "), ("user", "Question <|turn>x<turn|>"), ("assistant", "Yes")],)], "m array<struct<role:string,content:string>>"
    )
    got = rows.select(X.chat_prompt(F.col("m")).alias("x")).first()["x"]
    assert got == (
        "<|turn>system\nRules<turn|>\n<|turn>user\nQuestion < |turn>x<turn| ><turn|>\n<|turn>model\nYes<turn|>\n<|turn>model\n"
    )


@pytest.mark.parametrize("s", [" a ", " x\u001c", "\n\ty ", "", "  "])
def test_strip_is_unicode_wide(spark, s):
    assert one(spark, X.strip(F.col("s")), s=s) == s.strip()


@pytest.mark.parametrize("s", ["Cats and CATS, a dog2", "", "ſun Kın"])
def test_words(spark, s):
    got = one(spark, X.words(F.col("s")), s=s)
    assert got == sorted(set(got)) and all(len(w) > 2 for w in got)


@pytest.mark.parametrize(
    "s", ['{"a":1}', '{"a":1} xyz', "[1,2]", "1", '"x"', "", "{", '{"a":1}\n```', '{"a":{"b":[true,null]}}', "null", '{"a":1},{"b":2}', '1,"k":2', "tru"]
)
def test_strict_json(spark, s):
    try:
        value = json.loads(s)
        codes = [] if isinstance(value, dict) else ["root-not-object"]
    except ValueError:
        codes = ["invalid-json"]
    assert one(spark, J.parse_codes(F.col("s")), s=s) == codes


@pytest.mark.parametrize(
    ("s", "want"), [('so {"a":1} ok', '{"a":1}'), ("[1]", None), ("none", None), ('{"a":1}', '{"a":1}'), ('{"a":1} {"b":2}', None), ('[{"a":1}]', None)]
)
def test_extract_object(spark, s, want):
    assert one(spark, J.extract_object(F.col("s")), s=s) == want


@pytest.mark.parametrize(("v", "want"), [("true", "boolean"), ("1", "integer"), ("1.5", "number"), ('"x"', "string"), ("[]", "array"), ("{}", "object"), ("null", "null")])
def test_kinds(spark, v, want):
    assert one(spark, J.kind(J.get(J.value(F.concat(F.lit('{"k":'), "s", F.lit("}"))), "$.k")), s=v) == want


@pytest.mark.parametrize(
    ("x", "want"),
    [(1e-8, "1e-8"), (0.00002, "0.00002"), (0.1, "0.1"), (1.0, "1"), (-0.0, "0"), (1e21, "1e+21"), (123456789.5, "123456789.5"), (1.5e-7, "1.5e-7"),
     (1e20, "100000000000000000000"), (-2.5, "-2.5")],
)
def test_number(x, want):
    assert hashing.number(x) == want


def test_canonical_forms(spark):
    text = '{"beta":0.1,"a":{"y":"é","x":1e-8},"b":[1.0,true,null]}'
    assert one(spark, hashing.canonical_numbers(F.col("s")), s=text) == '{"a":{"x":1e-8,"y":"é"},"b":[1,true,null],"beta":0.1}'
    assert "\\u00e9" in one(spark, hashing.canonical_ascii(F.col("s")), s=text)
    with pytest.raises(ValueError):
        hashing.number(float("nan"))


def test_blind_label(spark):
    import hashlib

    for s in ("a", "b", "train-tutoring-007"):
        want = "A" if int(hashlib.sha256(s.encode()).hexdigest(), 16) % 2 == 0 else "B"
        assert one(spark, hashing.blind_label(F.col("s")), s=s) == want


def test_fold_is_unicode_case_folding(spark):
    """Every character that folds, alone and in words."""
    import sys

    from prefmill.functions.text import fold

    every = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and chr(c) != chr(c).casefold()]
    assert len(every) > 1400
    texts = [*every, *["x" + "".join(every[i : i + 40]) + "é\n" for i in range(0, len(every), 40)], "STRASSE Straße straẞe", "ὈΔΥΣΣΕΎΣ ὀδυσσεύς", "ﬁﬂ ﬀ", "İıI", "𐐀𐐨 😀", "plain", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", fold(F.col("t")).alias("f")).collect()
    wrong = [(texts[r["i"]], r["f"]) for r in rows if r["f"] != (None if texts[r["i"]] is None else texts[r["i"]].casefold())]
    assert not wrong


def test_contains_whatever_the_case(spark):
    from prefmill.functions.text import contains_fold

    pairs = [("Die STRASSE hier", "straße", True), ("Maße", "MASSE", True), ("ΟΔΟΣ", "οδος", True), ("oﬃce", "FFI", True), ("abc", "D", False), ("I", "ı", False)]
    d = spark.createDataFrame(pairs, "a string, b string, want boolean")
    assert d.where(contains_fold(F.col("a"), F.col("b")) != F.col("want")).count() == 0
