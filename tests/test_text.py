import json
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from crmweave.functions import jsontext, text


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("r")).collect()[0].r


@pytest.mark.parametrize(
    "website, domain",
    [
        ("HTTP://www.Ab.com/x?y", "ab.com"),
        ("https://ab.com?q=1/2", "ab.com"),
        ("\t ab.com:8080/x\n", "ab.com:8080"),
        ("ab.com#top", "ab.com#top"),
        ("WWW.ab.com", "ab.com"),
        ("https://https://ab.com", "https:"),
        ("https://", None),
        ("www.", None),
        ("  ", None),
        (None, None),
        ("/path", None),
    ],
)
def test_domain_from_website(spark, website, domain):
    assert one(spark, website, text.domain_from_website(F.col("v"))) == domain


@pytest.mark.parametrize(
    "email, company",
    [("a@b@C.com ", "c.com"), ("none", None), ("a@", None), ("a@ ", None), (None, None)],
)
def test_company_from_email(spark, email, company):
    assert one(spark, email, text.company_from_email(F.col("v"))) == company


@pytest.mark.parametrize(
    "raw", ["a/b c+d@e.com", "~x*y%z", "ünï@x.de", "plain@x.com", " sp @x", "a&b=c?d#e;f,g:h!'()"]
)
def test_percent_encoding(spark, raw):
    assert one(spark, raw, text.percent_encode(F.col("v"))) == quote(raw, safe="")


@pytest.mark.parametrize(
    "raw, ids",
    [
        (None, None), ("", None), ("[]", None), (" , ", None), ('[0, "3", null]', ["0", "3"]),
        ("1, 4,", ["1", "4"]), ("2", ["2"]), ('"1"', ['"1"']), ("[9", ["[9"]), ("a", ["a"]),
        ("[null]", None), ('{"a": 1}', ['{"a": 1}']),
    ],
)
def test_list_ids(spark, raw, ids):
    assert one(spark, raw, text.parse_list_ids("v")) == ids


def test_list_ids_of_native_arrays(spark):
    frame = spark.createDataFrame([([1, None, 3],), ([],), (None,)], "v array<int>")
    got = [r.r for r in frame.select(text.parse_list_ids("v", is_array=True).alias("r")).collect()]
    assert got == [["1", "3"], None, None]


def test_owner_name(spark):
    frame = spark.createDataFrame(
        [(" Ann", "Lee ", "a"), (None, "Lee", "a"), (" ", None, "a"), (None, None, None)],
        "f string, l string, e string",
    )
    name = text.owner_full_name(F.col("f"), F.col("l"), F.col("e"))
    assert [r.n for r in frame.select(name.alias("n")).collect()] == ["Ann Lee", "Lee", "a", None]


def test_strip_removes_all_white_space(spark):
    every = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    assert one(spark, f"{every}x y{every}", text.strip(F.col("v"))) == "x y"


LEAVES = [
    "True", "FALSE", "true ", 'x,"true",', '"true"', ':"true"', "a:", ",", "[", "\\", '\\"true"',
    "t\nrue", "", None, "yes",
]


@pytest.mark.parametrize("left", LEAVES)
@pytest.mark.parametrize("right", LEAVES)
def test_bool_strings_only_change_whole_leaves(spark_rows, left, right):
    got = json.loads(spark_rows[left, right])

    def turn(v):
        return v.lower() == "true" if v is not None and v.lower() in ("true", "false") else v

    a, b = turn(left), turn(right)
    assert got == {"true": a, "b": [b, a], "c": {"false": b}, "m": {left or "": b}}


@pytest.fixture(scope="module")
def spark_rows(spark):
    rows = [(a, b) for a in LEAVES for b in LEAVES]
    frame = spark.createDataFrame(rows, "l string, r string")
    shaped = frame.selectExpr(
        "l AS `true`", "array(r, l) AS b", "struct(r AS `false`) AS c", "map(coalesce(l, ''), r) AS m"
    )
    out = shaped.select("`true`", "c.false", jsontext.json_with_bools(shaped.schema).alias("j"))
    return {(r[0], r[1]): r.j for r in out.collect()}


def test_nested_nulls_are_kept(spark):
    frame = spark.sql(
        "SELECT CAST(NULL AS STRING) AS a, named_struct('x', CAST(NULL AS STRING), 'y', 1) AS s,"
        " CAST(NULL AS STRUCT<x: STRING>) AS n, array(named_struct('t', 'TRUE'), NULL) AS l,"
        " map('k', CAST(NULL AS STRING)) AS m, CAST(NULL AS INT) AS i, true AS b"
    )
    text = frame.select(jsontext.json_with_bools(frame.schema).alias("j")).collect()[0].j
    assert json.loads(text) == {
        "a": None, "s": {"x": None, "y": 1}, "n": None, "l": [{"t": True}, None],
        "m": {"k": None}, "i": None, "b": True,
    }
