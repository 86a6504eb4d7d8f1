"""Repeated values found by a filter first, against the counts of all values."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagscope.operators import repeated_values, unique_failures, unique_failures_of_repeats, uniqueness


def test_packed_places_come_back():
    places = np.unique(np.random.default_rng(0).integers(0, 1 << 61, 1000))
    twice = np.arange(len(places)) % 3 == 0
    found = uniqueness._unpacked(uniqueness._packed(places, twice))
    assert found[0].tolist() == places.tolist() and found[1].tolist() == twice.tolist()


def large(spark):
    """Values of which a few repeat, far apart, and one fills a third of the rows."""
    ids = spark.range(0, 60_000, 1, 6)
    value = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") > 59_900, F.col("id") - 50_000).otherwise(F.col("id"))
    return ids.select(value.alias("v"), (F.col("id") % 7).alias("k"), F.col("id").cast("string").alias("w"))


@pytest.mark.parametrize("limits", [{}, {"CHUNK": 500}, {"SLICE_BITS": 8}, {"CHANCE_BITS": 40, "MOST_BITS": 8}, {"MOST_SENT": 0}])
def test_equals_the_counts_of_all_values(spark, rows, monkeypatch, limits):
    """Whatever is held, sliced, shared by chance or too much to broadcast."""
    for name, value in limits.items():
        monkeypatch.setattr(uniqueness, name, value)
    df = large(spark)
    for keys in ((), ("k",)):
        expected = unique_failures(df, "m", ["v", "w"], keys)
        assert rows(unique_failures_of_repeats(df, "m", ["v", "w"], keys)) == rows(expected)
    found = {r["text"]: r["n"] for r in repeated_values(df, ["v", "w"]).collect()}
    assert found.pop("-1") == 20_000
    assert len(found) == 33 and set(found.values()) == {2}


def test_few_places_are_suspect(spark):
    """What is sent to be counted grows with the values that repeat, not with the rows."""
    df = large(spark)
    suspects = uniqueness.suspect_places(df, ["v", "w"], (), 120_000)
    assert 34 <= suspects.count() <= 5_000
    many = uniqueness.suspect_places(df, ["w"], (), 1 << 24)
    assert many.count() <= 5
    plan = repeated_values(df, ["w"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_sketch_takes_a_few_bytes_per_value():
    """As the shuffle compresses it, and less than the 8 bytes of a hash."""
    random = np.random.default_rng(3)
    places = np.unique(random.integers(0, 1 << 40, 1 << 18))
    sent = uniqueness._packed(places, np.zeros(len(places), bool))
    assert len(zlib.compress(sent, 1)) < 4 * len(places)


def test_odd_rows(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), (None, 1), (None, 1), ("c", None), ("c", None), ("", 2)], "k string, d int")
    assert rows(repeated_values(df, ["d"], ["k"])) == [("b", "d", "1", 2), (None, "d", "1", 2)]
    assert rows(unique_failures_of_repeats(df, "m", ["k", "d"])) == [("m", "d", "unique", 1), ("m", "k", "unique", 2)]
    assert rows(unique_failures_of_repeats(df.limit(0), "m", ["d"])) == [("m", "d", "unique", 0)]
