"""Predicates and their source rules."""

import pytest
from pyspark.sql import functions as F

from postline.operators import filters


def test_lookback_rounding():
    assert filters.lookback_days("zip_recruiter", 5) == 1 and filters.lookback_days("zip_recruiter", 50) == 2
    assert filters.lookback_days("naukri", 23) == 0 and filters.lookback_days("linkedin", 12) == 0.5
    assert [filters.lookback_days("google", h) for h in (24, 72, 168, 169)] == [1, 3, 7, 30]
    assert [filters.batch_hours(m) for m in (1, 60, 61)] == [1, 1, 2]


def test_source_names():
    assert filters.pick_sources("Zip-Recruiter") == ["zip_recruiter"]
    assert "greenhouse" not in filters.pick_sources() and "bdjobs" in filters.pick_sources()
    with pytest.raises(ValueError, match="unknown sources"):
        filters.pick_sources(["nowhere"])


def test_country_words_need_boundaries(spark):
    df = spark.createDataFrame([("Plus, Hungary",), ("US",), ("Austin, us ",), (None,)], "x string")
    assert [r["x"] for r in filters.by_country(df, "usa", ["x"]).collect()] == ["US", "Austin, us "]


def test_filters_compare_numbers_as_numbers(spark):
    df = spark.createDataFrame([("1.0", "Yes"), ("1", None), ("x", "")], "n string, t string")
    rules = ({"path": "n", "in": [1, 2]}, {"path": "t", "exists": False})
    assert df.where(filters.compile_filters(rules, F.col)).count() == 1


def test_explode_matching_places(spark):
    kind = "places array<struct<city:string,country:string>>, land string"
    rows = [([("a", "il"), ("b", "us"), ("c", "il")], "us"), ([("d", "us")], "il"), ([], "us"), (None, "il")]
    got = filters.explode_matching(spark.createDataFrame(rows, kind), "places", "land", "il").collect()
    assert [r["place"] and r["place"]["city"] for r in got] == ["a", "c", None, None]
