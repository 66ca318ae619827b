import ast
import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmweave.functions import cleaning

# Texts that have to come out of cleaning in one way.
NULLED = ["NaN", "Infinity", "-Infinity"]
KEPT = [
    "Nan", "nan", "NAN", "-NaN", "inf", "-inf", "Inf", "INF", "+inf", "  NaN  ", "infinity", "N/A",
    "None", "NA", "n/a", "null", "NULL", "<NA>", "#N/A", "1.#IND", "", "CEO", "Infinity Ward",
    "nanjing",
]
REPAIRED = {
    "1,234,567": "1234567", "12,345.67": "12345.67", "1,316": "1316", "298,": "298", "1,2,3": "123",
}
NOT_REPAIRED = ["12,34", "[1, 2, 3]", "Smith, John", "New York, NY", "94538", "01,316"]
CONTAINERS = [
    "1,316", "1,234,567", "12,345.67", "298,", "1,2", "(1, 2)", "[1, 2]", "{'a': 1}", "1, 2, 3",
]
NOT_CONTAINERS = ["94538", "1316", "01,316", "CEO", "Smith, John", "New York, NY", ""]

# Cases of our own.
REPAIRED |= {" 1,316 ": "1316", "-1,316": "-1316", "10,000": "10000", "1,050.5": "1050.5"}
NOT_REPAIRED += ["1,050", ",", "1,2", "1,316.", "1 ,316", "\u00a01,316"]
CONTAINERS += [
    "{1, 2}", "set()", "b'x', 1", "None, 1", "'a', 'b'", " [1]", "()", "-1, 2",
]
NOT_CONTAINERS += ["(1)", "[0, null]", "{", "foo(1, 2)"]


def values(spark, items):
    return spark.createDataFrame([(v,) for v in items], "v string")


def apply(spark, items, column):
    rows = values(spark, items).select("v", column.alias("r")).collect()
    return {r.v: r.r for r in rows}


def test_nonfinite_tokens_become_null(spark):
    result = apply(spark, NULLED + KEPT, cleaning.null_nonfinite("v"))
    assert all(result[v] is None for v in NULLED)
    assert all(result[v] == v for v in KEPT)


def test_grouped_numbers_lose_their_commas(spark):
    result = apply(spark, [*REPAIRED, *NOT_REPAIRED], cleaning.repair_comma_number("v"))
    assert {v: result[v] for v in REPAIRED} == REPAIRED
    assert all(result[v] == v for v in NOT_REPAIRED)


def test_containers_are_told_from_text(spark):
    result = apply(spark, CONTAINERS + NOT_CONTAINERS, cleaning.is_container_literal("v"))
    assert [v for v in CONTAINERS if not result[v]] == []
    assert [v for v in NOT_CONTAINERS if result[v]] == []


def _parses_to_container(value):
    try:
        return isinstance(ast.literal_eval(value), (tuple, list, dict, set))
    except Exception:
        return False


def test_comma_numbers_are_containers_of_digits(spark):
    """What is repaired agrees with the literal parser on random number-like text."""
    rng = random.Random(7)
    items = sorted({"".join(rng.choices("0012,,.+- 9", k=rng.randint(1, 9))) for _ in range(20000)})
    result = apply(spark, items, cleaning.is_comma_number("v"))

    def expected(value):
        bare = value.strip()
        sign = bare[1:] if bare[:1] in ("+", "-") else bare
        whole, _, fraction = sign.partition(".")
        shape = (
            "," in whole
            and set(whole) <= set("0123456789,")
            and ("." not in sign or (fraction.isascii() and fraction.isdigit()))
        )
        head, _, tail = sign.partition(",")
        decimal_comma = head.isdigit() and tail.isdigit() and len(tail) <= 2
        digits = any(c.isdigit() for c in whole.replace(",", ""))
        return shape and digits and not decimal_comma and _parses_to_container(value)

    assert [v for v in items if bool(result[v]) != expected(v)] == []


def test_flag_agrees_with_the_literal_parser(spark):
    rng = random.Random(11)
    pieces = ["1", "'a'", "x", ",", " ", "(", ")", "[", "]", "{", "}", ":", "None", "set()", "-", "b''"]
    items = sorted({"".join(rng.choices(pieces, k=rng.randint(1, 6))) for _ in range(8000)})
    result = apply(spark, items, cleaning.is_container_literal("v"))
    hints = (",", "[", "{", "(")
    wrong = [
        v for v in items
        if result[v] != (any(h in v for h in hints) and _parses_to_container(v))
    ]
    assert wrong == []


def test_record_is_cleaned_to_its_leaves(spark):
    schema = (
        "id string, title string, amount double, at timestamp, o struct<a:string,b:string>,"
        " l array<string>, m map<string,string>, deep array<struct<x:array<string>,y:double>>,"
        " n int, empty struct<a:string>"
    )
    row = (
        "1,316", "NaN", float("nan"), datetime(2026, 6, 30, 1, 11, 40, 684000),
        ("-Infinity", "ok"), ["NaN", "keep", "inf"], {"NaN": "298,", "k": "Infinity"},
        [([None, "1,2,3"], float("nan"))], 5, None,
    )
    frame = spark.createDataFrame([row], schema)
    got = cleaning.sanitize_record(frame).collect()[0].asDict(recursive=True)
    assert got == {
        "id": "1316", "title": None, "amount": None, "at": "2026-06-30T01:11:40.684000Z",
        "o": {"a": None, "b": "ok"}, "l": [None, "keep", "inf"],
        "m": {"NaN": "298", "k": None}, "deep": [{"x": [None, "123"], "y": None}],
        "n": 5, "empty": None,
    }
    assert frame.collect()[0].id == "1,316"


def test_names_with_dots_survive(spark):
    frame = spark.createDataFrame([("NaN", ("1,316",))], "`a.b` string, `c d` struct<`x.y`:string>")
    got = cleaning.sanitize_record(frame).collect()[0].asDict(recursive=True)
    assert got == {"a.b": None, "c d": {"x.y": "1316"}}


def test_zone_free_timestamps_format_the_same(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 03:04:05.000006' AS t, CAST(NULL AS TIMESTAMP) AS z")
    got = frame.select(
        cleaning.iso_timestamp("t").alias("t"), cleaning.iso_timestamp("z").alias("z")
    ).collect()[0]
    assert (got.t, got.z) == ("2024-01-02T03:04:05.000006Z", None)


@pytest.mark.parametrize(
    "ddl, value, leaves",
    [
        ("v string", "a", ["a"]),
        ("v array<string>", ["a", None], ["a", None]),
        ("v struct<a:string,b:array<string>,c:int>", ("x", ["y"], 1), ["x", "y"]),
        ("v map<string,string>", {"k": "z"}, ["z"]),
    ],
)
def test_text_leaves(spark, ddl, value, leaves):
    frame = spark.createDataFrame([(value,)], ddl)
    sql = cleaning.text_leaves_sql("v", frame.schema["v"].dataType)
    assert frame.select(F.expr(sql).alias("l")).collect()[0].l == leaves


def test_numbers_have_no_text_leaves():
    assert cleaning.text_leaves_sql("v", T.ArrayType(T.LongType())) is None


def test_json_text_of_cleaned_record(spark):
    frame = spark.createDataFrame([("NaN", 1.5)], "a string, b double")
    text = cleaning.sanitize_record(frame).select(F.to_json(F.struct("*")).alias("j")).collect()[0].j
    assert json.loads(text) == {"b": 1.5}
