"""Every registered query against its SQL."""

import pytest

from helpers import same_rows
from prefmill.plans import load
from prefmill.plans.files import TABLES

QUERIES, ORACLES = load()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    frame = QUERIES[name](spark, sf)
    if name in ORACLES:
        same_rows(frame, ORACLES[name].replace(TABLES, sf), duck)
    else:
        assert frame.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() >= 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["lesson_kernels", "rejected_lessons"])
def test_lessons_are_read_once(spark, sf, name):
    """A value that several rules ask of stands in the plan once, and the rows, few bytes each, are dealt to all cores."""
    frame = QUERIES[name](spark, sf)
    assert frame._jdf.queryExecution().analyzed().toString().count("schema_of_variant") < 200
    assert frame.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
