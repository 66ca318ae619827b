"""Lookup joins against brute force, with hot, missing and repeated keys."""

import random

from pyspark.sql import functions as F

from crmweave.operators import lookup
from crmweave.operators.lookup import anti_join, lookup_join, unique_lookup


def skewed_rows(n=3000):
    """A third of the rows on one known key, a sixth on an unknown one, a tenth without key."""
    rng = random.Random(3)
    keys = []
    for i in range(n):
        draw = rng.random()
        if draw < 0.33:
            keys.append("hot")
        elif draw < 0.5:
            keys.append("hot-unknown")
        elif draw < 0.6:
            keys.append(None)
        else:
            keys.append(str(rng.randrange(2000)))
    return list(enumerate(keys))


NAMES = {str(i): f"n{i}" for i in range(0, 2000, 3)} | {"hot": "hottest"}


def test_left_join_on_skewed_keys(join_mode, frame):
    rows = skewed_rows()
    facts = frame(rows, "row int, k string")
    names = frame(list(NAMES.items()), "key string, name string")
    got = lookup_join(facts, names, "k", "key").collect()
    assert sorted((r.row, r.k, r.name) for r in got) == [(i, k, NAMES.get(k)) for i, k in rows]


def test_null_keys_of_the_lookup_match_nothing(join_mode, frame):
    facts = frame([(1, None), (2, "a")], "row int, k string")
    names = frame([(None, "null"), ("a", "A")], "key string, name string")
    got = lookup_join(facts, names, "k", "key").collect()
    assert sorted((r.row, r.name) for r in got) == [(1, None), (2, "A")]


def test_null_values_of_hot_keys_stay_null(join_mode, frame):
    facts = frame([(i, "a") for i in range(50)], "row int, k string")
    names = frame([("a", None)], "key string, name string")
    got = lookup_join(facts, names, "k", "key").collect()
    assert len(got) == 50 and {r.name for r in got} == {None}


def test_ids_of_any_type_are_compared_as_text(join_mode, frame):
    facts = frame([(1, 7), (2, 8)], "row int, k long")
    names = frame([("7", "seven"), ("08", "eight")], "key string, name string")
    got = lookup_join(facts, names, "k", "key").collect()
    assert sorted((r.row, r.name) for r in got) == [(1, "seven"), (2, None)]


def test_filler_keys_never_meet_real_keys(join_mode, frame):
    """Real keys that look like the keys used for spreading are still only themselves."""
    facts = frame([(1, None), (2, "!0"), (3, "=a"), (4, "a")], "row int, k string")
    names = frame([("!0", "x"), ("=a", "y"), ("a", "z")], "key string, name string")
    got = lookup_join(facts, names, "k", "key").collect()
    assert sorted((r.row, r.name) for r in got) == [(1, None), (2, "x"), (3, "y"), (4, "z")]


def test_anti_join_on_skewed_keys(join_mode, frame):
    rows = skewed_rows()
    facts = frame(rows, "row int, k string")
    keys = frame([(k,) for k in NAMES] * 2 + [(None,)], "key string")
    left = {r.row for r in anti_join(facts, keys, "k", "key").collect()}
    assert left == {i for i, k in rows if k not in NAMES}


def test_unique_lookup_takes_the_last_row(frame):
    rows = [("a", "1", 1), ("a", "3", 2), ("a", "2", 3), ("b", None, 1), (None, "x", 9)]
    table = frame(rows, "key string, value string, at int")
    ordered = unique_lookup(table, "key", ["value"], "at").collect()
    largest = unique_lookup(table, "key", ["value"]).collect()
    assert {r.key: r.value for r in ordered} == {"a": "2", "b": None}
    assert {r.key: r.value for r in largest} == {"a": "3", "b": None}


def test_large_lookups_are_not_broadcast(spark, frame):
    facts = frame(skewed_rows(), "row int, k string")
    names = frame(list(NAMES.items()), "key string, name string")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "1024b")
        plan = lookup_join(facts, names, "k", "key")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert "SortMergeJoin" in plan and "approx_top_k" in plan
    plan = lookup_join(facts, names, "k", "key")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "approx_top_k" not in plan


def test_hot_rows_are_spread_over_the_shuffle(spark, frame, monkeypatch):
    """No task of the shuffle join gets much more than its share of the rows."""
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *_: False)
    facts = frame(skewed_rows(8000), "row int, k string")
    names = frame(list(NAMES.items()), "key string, name string")
    aqe = "spark.sql.adaptive.enabled"
    try:
        spark.conf.set(aqe, "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = lookup_join(facts, names, "k", "key")
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set(aqe, "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760b")
    assert sum(r["count"] for r in sizes) == 8000
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1500
