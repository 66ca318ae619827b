import json
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from crmweave.operators.dedupe import latest_per_key
from crmweave.operators.enrich import list_lookup
from crmweave.session import scratch_path
from crmweave.sinks import snapshots
from crmweave.sinks.singer import observed_types, singer_records, singer_schema, write_singer
from crmweave.sinks.snapshots import CommitConflict, SnapshotStore
from crmweave.sources import merging, tenants
from crmweave.sources.id_maps import LINE, read_id_map
from crmweave.sources.streams import read_typed, scan_stream

LINES = [
    ("", []),
    ("   ", []),
    ('{"a":"junk"}] x', []),
    ('{"type":"RECORD","stream":"s","record":{"a":"junk"}} ] x', []),
    ("not json", []),
    ("[1, 2]", []),
    ("5", []),
    ('{"type":"SCHEMA","stream":"s","schema":{}}', []),
    ('{"type":"STATE","value":{"a":1}}', []),
    ('{"type":"RECORD","stream":"s","record":{"a":"1"}}', ["1"]),
    ('{"type":"RECORD","record":{"a":"2","b":[{"x":1},{"y":"} {"}]}}', ["2"]),
    ('{"type":"RECORD","stream":null,"record":{"a":"3"}}', ["3"]),
    ('{"type":"RECORD","stream":"other","record":{"a":"x"}}', []),
    ('{"type":"RECORD","stream":"s","a":"4"}', ["4"]),
    ('  {"a":"5"}\t', ["5"]),
    ('{"a":"6","n":NaN}', ["6"]),
    ("{'a':'x'}", []),
    ('{"a":"x"} {"a":"y"}', []),
    ('{"a":"x"},{"a":"y"}', []),
    ('{"a":"x"}}', []),
    ('{"a":"x",}', []),
    ('{"a":"x"', []),
    ('{"a":"7} x"}', ["7} x"]),
    ('{"type":"OTHER","a":"8"}', ["8"]),
    ('{"type":5,"a":"9"}', ["9"]),
    ('{}', [None]),
]


def test_record_lines(spark, tmp_path):
    (tmp_path / "s.jsonl").write_text("\n".join(line for line, _ in LINES), encoding="utf-8")
    got = scan_stream(spark, str(tmp_path), "s", "a string").collect()
    expected = [v for _, found in LINES for v in found]
    assert sorted(map(str, (r.a for r in got))) == sorted(map(str, expected))


def test_record_files_of_every_name(spark, tmp_path):
    for name in ["s.singer", "s-1.json", "s-2.jsonl", "s", "other.json", "s.txt"]:
        (tmp_path / name).write_text('{"a":"%s"}\n' % name)
    got = {r.a for r in scan_stream(spark, str(tmp_path), "s", "a string").collect()}
    assert got == {"s.singer", "s-1.json", "s-2.jsonl", "s"}
    raw = scan_stream(spark, str(tmp_path), "s").collect()
    assert {r.a for r in raw} == got


def test_parquet_wins_and_schemas_merge(spark, tmp_path):
    spark.range(2).selectExpr("id AS a").write.parquet(str(tmp_path / "s.parquet"))
    spark.range(3).selectExpr("id AS a", "'x' AS b").write.parquet(str(tmp_path / "s-20260101.parquet"))
    spark.range(9).write.parquet(str(tmp_path / "sx.parquet"))
    (tmp_path / "s.json").write_text('{"a": 1}')
    got = scan_stream(spark, str(tmp_path), "s")
    assert sorted(got.columns) == ["a", "b"] and got.count() == 5
    typed = read_typed(spark, str(tmp_path), "s", "a long, c string")
    assert typed.columns == ["a", "c"] and typed.count() == 5


def test_absent_stream_has_no_rows(spark, tmp_path):
    assert scan_stream(spark, str(tmp_path), "s", "a string").count() == 0
    assert scan_stream(spark, str(tmp_path), "s").columns == []


def test_id_maps_are_text_and_keep_their_order(spark, tmp_path):
    rows = [("007", "R1"), ("007", "R9"), ("007", "R2"), ("8", "")]
    text = "RemoteId,extra,InputId\n" + "".join(f"{r},x,{i}\n" for i, r in rows)
    (tmp_path / "contacts_f1.snapshot.csv").write_text(text)
    got = read_id_map(spark, str(tmp_path), "contacts", "f1")
    assert [(r.InputId, r.RemoteId) for r in got.collect()] == [
        ("007", "R1"), ("007", "R9"), ("007", "R2"), ("8", None)
    ]
    from crmweave.operators.enrich import account_lookup

    lined = read_id_map(spark, str(tmp_path), "contacts", "f1", with_line=True)
    assert {r.InputId: r.RemoteId for r in account_lookup(lined, LINE).collect()} == {"007": "R2"}
    assert read_id_map(spark, str(tmp_path), "contacts", "f2") is None
    (tmp_path / "bad_f1.snapshot.csv").write_text("a,b\n1,2\n")
    assert read_id_map(spark, str(tmp_path), "bad", "f1", malformed="absent") is None
    with pytest.raises(ValueError):
        read_id_map(spark, str(tmp_path), "bad", "f1")


def test_tenant_configs(spark, tmp_path):
    config = {
        "about": {"name": "x"},
        "version": 2,
        "sync": {"mapping": {"F1": {
            "contacts/Contact": {"hq.city": "City", "a": "A"},
            "contacts/Lead": {"b": "B"},
            "a/b/c": {"x": "y"},
            "accounts/Account": {"n": "Name"},
        }}},
    }
    (tmp_path / "one.json").write_text(json.dumps(config, indent=1))
    (tmp_path / "broken.json").write_text("{")
    configs = tenants.read_tenant_configs(spark, str(tmp_path / "*.json"))
    mapping = tenants.load_mapping(configs).collect()
    assert [(m.ord, m.target, m.connector, m.pos, m.source_field, m.target_field) for m in mapping] == [
        (0, "contacts", "Contact", 0, "hq.city", "City"),
        (0, "contacts", "Contact", 1, "a", "A"),
        (1, "contacts", "Lead", 0, "b", "B"),
        (3, "accounts", "Account", 0, "n", "Name"),
    ]
    tenant = mapping[0].tenant
    by_target = tenants.tenant_mapping(tenants.mapping_by_target(configs), tenant, "F1")
    assert by_target == {"contacts": {"b": "B"}, "a": {"x": "y"}, "accounts": {"n": "Name"}}
    by_connector = tenants.tenant_mapping(tenants.mapping_by_connector(configs), tenant, "F1")
    assert list(sorted(by_connector)) == ["Account", "Contact", "Lead"]


def test_record_lines_drop_nulls_at_the_top_only(spark):
    df = spark.createDataFrame(
        [('{"a":null,"b":1}', "1", None), (None, None, None)], "data string, id string, x string"
    )
    got = [r.line for r in singer_records(df, 'c"s', {"data": "object"}).collect()]
    head = '{"type":"RECORD","stream":"c\\"s","record":'
    assert got == [head + '{"data":{"a":null,"b":1},"id":"1"}}', head + "{}}"]
    only = singer_records(df.select("data"), "s", {"data": "object"}).collect()[0].line
    assert json.loads(only)["record"] == {"data": {"a": None, "b": 1}}


def test_schema_line(spark):
    df = spark.sql("SELECT 1 AS n, array(1) AS l, struct(1 AS a) AS s, map('k', 1) AS m, '{}' AS data")
    line = json.loads(singer_schema(df, "s", {"data": "object"}))
    base = ["null", "boolean", "string", "integer", "number"]
    assert line["key_properties"] == []
    assert {k: v["type"] for k, v in line["schema"]["properties"].items()} == {
        "n": base, "l": base + ["array"], "s": base + ["object"], "m": base + ["object"],
        "data": base + ["object"],
    }


def test_observed_types(spark):
    df = spark.createDataFrame([("{}", None), (" [1]", None)], "a string, b string")
    got = {r.column_name: (r.has_object, r.has_array) for r in observed_types(df, ("a", "b")).collect()}
    assert got == {"a": (True, True), "b": (False, False)}


def test_written_stream_opens_with_its_schema(spark, tmp_path):
    df = spark.range(0, 100, 1, 4).selectExpr("cast(id AS string) AS id")
    path = write_singer(df, "s", str(tmp_path))
    files = sorted((tmp_path / "s").glob("*/part-*"))
    lines = [line for f in files for line in f.read_text().splitlines()]
    assert path.endswith("/s") and len(lines) == 101
    assert [json.loads(x)["type"] for x in lines] == ["SCHEMA"] + ["RECORD"] * 100
    assert write_singer(df.limit(0), "empty", str(tmp_path)) is None
    assert [p.read_text() for p in (tmp_path / "empty").glob("*/part-*") if p.stat().st_size] == []


def stage(spark, folder, name, sql):
    spark.sql(sql).coalesce(1).write.parquet(str(folder / name))


def test_files_of_different_types(spark, tmp_path):
    stage(spark, tmp_path, "s-1.parquet", "SELECT 1 AS id, 1.5D AS x, named_struct('a', 1) AS n, array(1) AS l, true AS b")
    stage(spark, tmp_path, "s-2.parquet", "SELECT 'a' AS id, 2 AS x, named_struct('a', 'q', 'z', 2L) AS n, array('p') AS l, 7 AS b")
    stage(spark, tmp_path, "s-3.parquet", "SELECT 3L AS id, named_struct('a', 5) AS n, DATE'2024-01-02' AS d")
    stage(spark, tmp_path, "s-4.parquet", "SELECT TIMESTAMP'2024-01-03 04:05:06' AS d, 4 AS id, array(3) AS n")
    rows = scan_stream(spark, str(tmp_path), "s", with_line=True)
    assert rows.columns[:-1] == ["id", "x", "n", "l", "b", "d"] and rows.columns[-1] == LINE
    found = [r[:-1] for r in sorted(rows.collect(), key=lambda r: r[-1])]
    assert [r[0] for r in found] == ["1", "a", "3", "4"] and [r[1] for r in found] == [1.5, 2.0, None, None]
    assert [r[2] for r in found] == ['{"a":1}', '{"a":"q","z":2}', '{"a":5}', "[3]"]
    assert [r[3] for r in found] == [["1"], ["p"], None, None] and [r[4] for r in found] == ["true", "7", None, None]
    assert [str(r[5]) for r in found] == ["None", "None", "2024-01-02 00:00:00", "2024-01-03 04:05:06"]


def test_a_folder_whose_files_disagree(spark, tmp_path):
    for n, sql in enumerate(["SELECT 1 AS id", "SELECT 'a' AS id", "SELECT 2 AS id", "SELECT 3 AS id, 1 AS y"]):
        spark.sql(sql).coalesce(1).write.mode("append").parquet(str(tmp_path / "s.parquet"))
    found = scan_stream(spark, str(tmp_path), "s")
    assert sorted(map(tuple, found.collect()), key=str) == [("1", None), ("2", None), ("3", 1), ("a", None)]
    calls = merging.schema_groups(spark, [str(p) for p in sorted((tmp_path / "s.parquet").glob("part*"))])
    assert sorted(len(files) for _, files in calls) == [1, 3]


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("float", "double", "double"),
    ("void", "int", "int"), ("decimal(10,2)", "bigint", "decimal(21,2)"), ("decimal(38,30)", "bigint", "double"),
    ("decimal(10,2)", "decimal(5,4)", "decimal(12,4)"), ("decimal(10,2)", "float", "double"),
    ("boolean", "int", "string"), ("date", "string", "string"), ("array<int>", "array<string>", "array<string>"),
    ("struct<a:int>", "struct<b:string,a:bigint>", "struct<a:bigint,b:string>"), ("struct<a:int>", "int", "string"),
])
def test_common_types(spark, a, b, want):
    kind = lambda t: spark.sql(f"SELECT CAST(NULL AS {t}) AS x").schema["x"].dataType
    assert merging.common_type(kind(a), kind(b)).simpleString() == want


@pytest.mark.parametrize("schema", [None, "listId string, name string"])
def test_the_last_row_of_record_files_wins(spark, tmp_path, schema):
    lines = [{"listId": "1", "name": "old"}, {"listId": "2", "name": "zz"}, {"listId": "1", "name": "a new"}]
    (tmp_path / "lists-1.jsonl").write_text("\n".join(map(json.dumps, lines)))
    (tmp_path / "lists-2.jsonl").write_text('{"type": "RECORD", "stream": "lists", "record": {"listId": "2", "name": "b"}}')
    rows = scan_stream(spark, str(tmp_path), "lists", schema, with_line=True)
    assert {r.listId: r.name for r in latest_per_key(rows, "listId", LINE).collect()} == {"1": "a new", "2": "b"}
    assert dict(list_lookup(rows).collect()) == {"1": "a new", "2": "b"}


def test_record_files_without_records_have_no_line(spark, tmp_path):
    (tmp_path / "s.jsonl").write_text('{"type": "STATE"}\n')
    assert scan_stream(spark, str(tmp_path), "s", with_line=True).columns == []


def keyed(spark, ids, value="x"):
    rows = [(None if i is None else str(i), value) for i in ids]
    return spark.createDataFrame(rows, "externalId string, v string")


def test_snapshots_count_once_committed(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.read("a") is None
    states = {"a": store.upsert("a", keyed(spark, range(3))), "b": store.upsert("b", keyed(spark, [1]))}
    assert SnapshotStore(spark, str(tmp_path)).read("a") is None
    store.commit(states)
    one, two = (SnapshotStore(spark, str(tmp_path)) for _ in range(2))
    assert one.read("a").count() == 3 and one.read("b").count() == 1
    one.commit({"a": one.upsert("a", keyed(spark, [2, 3, None], "y"))})
    # The second run started from the same commit; what it would write is out of date.
    with pytest.raises(CommitConflict):
        two.commit({"a": two.upsert("a", keyed(spark, range(9)))})
    now = SnapshotStore(spark, str(tmp_path))
    found = sorted((r.externalId or "", r.v) for r in now.read("a").collect())
    assert found == [("", "y"), ("0", "x"), ("1", "x"), ("2", "y"), ("3", "y")]
    assert now.read("b").count() == 1
    # A stored row without a key lasts for one version.
    now.commit({"a": now.upsert("a", keyed(spark, [5]))})
    assert {r.externalId for r in now.read("a").collect()} == {"0", "1", "2", "3", "5"}


def test_untouched_parts_keep_their_files(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.commit({"a": store.upsert("a", keyed(spark, range(500)))})
    before = dict(store.states["a"])
    store.commit({"a": store.upsert("a", keyed(spark, [7], "y"))})
    changed = {k for k, v in store.states["a"].items() if before[k] != v}
    assert before["parts"] == "64" and len(before) == 65 and len(changed) == 1
    assert store.read("a").count() == 500 and store.read("a").where("v = 'y'").count() == 1
    assert store.upsert("a", keyed(spark, [])) == store.states["a"]


def test_one_of_two_writers_wins(spark, tmp_path):
    """Fifty rounds of two threads that commit from one base."""
    for n in range(1, 51):
        stores = [SnapshotStore(spark, str(tmp_path)) for _ in range(2)]
        start = threading.Barrier(2)

        def commit(i, stores=stores, start=start, n=n):
            start.wait()
            try:
                stores[i].commit({"a": {"0": f"round{n}-of{i}"}})
            except CommitConflict:
                return "lost"
            return f"round{n}-of{i}"

        with ThreadPoolExecutor(2) as pool:
            ends = list(pool.map(commit, range(2)))
        assert sorted(e == "lost" for e in ends) == [False, True]
        [commit_file] = (tmp_path / "_commits").glob(f"commit={n:08d}")
        assert len(commit_file.read_text().splitlines()) == 1
        assert SnapshotStore(spark, str(tmp_path)).states["a"]["0"] == next(e for e in ends if e != "lost")
    assert not list((tmp_path / "_commits").glob("_draft*"))


def test_a_writer_that_lost_takes_back_its_tables(spark, tmp_path):
    one, two = (SnapshotStore(spark, str(tmp_path)) for _ in range(2))
    states = [s.upsert("a", keyed(spark, [n])) for n, s in enumerate((one, two))]
    one.commit({"a": states[0]})
    with pytest.raises(CommitConflict):
        two.commit({"a": states[1]})
    assert len(list((tmp_path / "a").glob("table=*"))) == 1
    assert [r.externalId for r in SnapshotStore(spark, str(tmp_path)).read("a").collect()] == ["0"]


def test_commits_written_as_folders_are_read(spark, tmp_path):
    spark.range(3).selectExpr("CAST(id AS string) AS externalId").write.parquet(str(tmp_path / "a/table=1/__part=5"))
    states = '{"a": {"5": "table=1/__part=5"}}'
    spark.createDataFrame([(states,)], "v string").coalesce(1).write.text(str(tmp_path / "_commits/commit=00000003"))
    store = SnapshotStore(spark, str(tmp_path))
    assert store.base == 3 and store.read("a").count() == 3
    store.commit({})
    assert SnapshotStore(spark, str(tmp_path)).base == 4


@pytest.mark.parametrize("before,after", [(64, 65), (64, 200), (65, 130), (4, 31)])
def test_added_parts_take_keys_from_one_part_each(spark, before, after):
    key = F.col("id").cast("string")
    rows = spark.range(20000).select(
        snapshots.part_of(key, before).alias("old"), snapshots.part_of(key, after).alias("new")
    ).distinct().collect()
    assert {r.new for r in rows} == set(range(after)) and {r.old for r in rows} == set(range(before))
    assert all(snapshots._old_part(r.new, before) == r.old for r in rows)


def test_a_state_that_outgrows_its_parts_splits_some(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.commit({"a": store.upsert("a", keyed(spark, range(2000)))})
    before = dict(store.states["a"])
    reader = SnapshotStore(spark, str(tmp_path))
    size = sum(f.stat().st_size for f in (tmp_path / "a").rglob("*.parquet"))
    growing = SnapshotStore(spark, str(tmp_path), part_bytes=size // 70)
    growing.commit({"a": growing.upsert("a", keyed(spark, [7, 5000], "y"))})
    after = growing.states["a"]
    added = int(after["parts"]) - 64
    assert 5 <= added <= 8
    kept = {k for k in before if before[k] == after.get(k)}
    # What is split is rewritten, and the parts of the two keys; all others keep their files.
    assert set(map(str, range(added))) & kept == set() and len(kept) >= 64 - added - 2
    rows = growing.read("a").collect()
    assert len(rows) == 2001 and {r.externalId for r in rows if r.v == "y"} == {"7", "5000"}
    assert reader.read("a").where("v = 'x'").count() == 2000
    fresh = SnapshotStore(spark, str(tmp_path))
    fresh.commit({"a": fresh.upsert("a", keyed(spark, [1999], "z"))})
    assert fresh.read("a").count() == 2001 and fresh.states["a"]["parts"] == after["parts"]


def test_parts_get_files_by_their_size(spark, tmp_path, frame, monkeypatch):
    """Files of small parts would outgrow the state: one each, and several once they are large."""

    def files(root, rows):
        store = SnapshotStore(spark, str(tmp_path / root), part_bytes=400)
        for batch in rows:
            store.commit({"a": store.upsert("a", batch)})
        assert sorted(int(r.externalId) for r in store.read("a").collect()) == list(range(2000))
        return len(store.read("a").inputFiles()), len(store.states["a"]) - 1

    schema = "externalId string, v string"
    halves = [frame([(str(i), "x") for i in range(n, n + 1000)], schema) for n in (0, 1000)]
    # Writers this small would else be put back into one task.
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        made, parts = files("small", halves)
        assert parts > 64 and made == parts
        monkeypatch.setattr(snapshots, "FILE_BYTES", 40)
        made, parts = files("large", halves)
        assert made > 2 * parts
    finally:
        spark.conf.set(name, before)


def test_only_the_parts_of_a_batch_are_read(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.read("a", keyed(spark, [1])) is None
    store.commit({"a": store.upsert("a", keyed(spark, range(500)))})
    batch = keyed(spark, [7, 8, 9000, None])
    few, whole = store.read("a", batch), store.read("a")
    parts = {p.split("__part=")[1].split("/")[0] for p in few.inputFiles()}
    assert len(parts) <= 3 and {r.externalId for r in few.collect()} >= {"7", "8"}
    assert len(few.inputFiles()) < len(whole.inputFiles()) / 10
    missing = store.read("a", keyed(spark, [None]))
    assert missing.count() == 0 and missing.columns == whole.columns


def test_old_state_is_removed(spark, tmp_path):
    for n in range(1, 7):
        store = SnapshotStore(spark, str(tmp_path))
        store.commit({"a": store.upsert("a", keyed(spark, [1], str(n)))})
    assert len(list((tmp_path / "a").glob("table=*/__part=*"))) == 3
    assert len(list((tmp_path / "_commits").glob("commit=*"))) == 3
    assert [r.v for r in SnapshotStore(spark, str(tmp_path)).read("a").collect()] == ["6"]


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(shared) and one != two


def test_schema_lines_follow_the_json_of_their_rows(spark, tmp_path):
    rows = [('{"a":1}', "[1]", None), (None, ' {"b":2}', None), ("{}", None, None)]
    df = spark.createDataFrame(rows, "data string, mixed string, none string").repartition(3)
    path = write_singer(df, "s", str(tmp_path), ("data", "mixed", "none"))
    line = json.loads(spark.read.text(f"{path}/0-schema").first().value)
    base = ["null", "boolean", "string", "integer", "number"]
    assert {k: v["type"] for k, v in line["schema"]["properties"].items()} == {
        "data": base + ["object"], "mixed": base + ["object", "array"], "none": base,
    }
    assert write_singer(df.limit(0), "empty", str(tmp_path), ("data",)) is None
