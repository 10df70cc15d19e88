from __future__ import annotations

import random

import pytest

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def make_docs(seed: int = 1, n: int = 120) -> list[tuple]:
    """Small documents with copies, near-copies, empty, null, one-word and long ones."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9))) for _ in range(300)]
    say = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    base = [say(r.randrange(30, 90)) for _ in range(12)]
    texts = []
    for i in range(n):
        if i % 5 == 0:
            texts.append(r.choice(base))
        elif i % 5 == 1:
            w = r.choice(base).split()
            w[r.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
        elif i % 5 == 2:
            texts.append(say(20) + "\n" + r.choice(base) + "\n" + say(20))
        else:
            texts.append(say(r.randrange(1, 120)))
    texts += ["", None, "word", "two words", "é ü ñ\tTAB", say(3000)]
    return [(i, t, r.choice(["en", "de", None]), f"src{r.choice([0, 0, 0, 1, 9, 19])}", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def small(spark):
    return spark.createDataFrame(make_docs(), DDL).repartition(3).cache()


def own_names() -> set[str]:
    """Every name that the operators' sources write in quotes: all column names they use are among them."""
    import re
    from pathlib import Path

    import prefmill.llm

    found = set()
    for path in Path(prefmill.llm.__file__).parent.glob("*.py"):
        found |= set(re.findall(r"""["']([A-Za-z_][A-Za-z0-9_]{0,15})["']""", path.read_text()))
    return {x.lower() for x in found}


@pytest.fixture(scope="session")
def odd(spark):
    """Null keys, repeated rows, equal keys with different texts, and columns whose names operators use themselves."""
    rows = [
        (None, "no key here at all", "en", "src1", 1), (None, None, None, None, None), (5, "same row twice", "en", "src2", 2), (5, "same row twice", "en", "src2", 2),
        (5, "another text with this key", "en", "src2", 2), (7, "", "de", "src0", 0), (9, "x" * 300, "fr", "src3", 300), (-3, "negative key", "es", "src4", 3),
    ]
    names = own_names() - {"doc_id", "text", "lang", "source", "n_chars", "quality", "toxic", "label"}
    from pyspark.sql import functions as F

    d = spark.createDataFrame(rows, DDL)
    return d.select("*", *[F.lit("clash").alias(n) for n in sorted(names)])


@pytest.fixture(scope="session")
def none(small):
    return small.where("doc_id < -1000")
