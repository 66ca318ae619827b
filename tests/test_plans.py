"""Physical plans: what is read, and what is shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from crmweave.operators.dedupe import drop_sent
from crmweave.operators.lookup import large_lookups
from crmweave.plans import hubspot, marketo, salesforce
from crmweave.session import write_and_read


@pytest.fixture
def contacts(spark, tmp_path):
    path = str(tmp_path / "contacts")
    spark.range(100).selectExpr(
        "cast(id AS string) AS id", "concat('u', id, '@x.com') AS email", "id % 2 = 0 AS archived",
        "cast(id AS string) AS accountId", "'x' AS unused", "'true' AS globalUnsubscribe",
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(contacts):
    text = plan(hubspot.read_stream(contacts, "contacts", hubspot.Lookups()))
    assert "Or(IsNull(archived),Not(EqualTo(archived,true)))" in text
    assert "IsNotNull(email)" in text
    assert "Exchange" not in text


def test_only_needed_columns_are_read(contacts):
    text = plan(hubspot.unsubscribe_requests(contacts))
    assert "ReadSchema: struct<email:string,globalUnsubscribe:string>" in text
    mapped = salesforce.contacts_write(
        contacts, {"Lead": {"email": "Email"}}, None, dynamic_contact_mapping=True, unique_ids=True
    ).records["Lead"]
    text = plan(mapped)
    assert "ReadSchema: struct<id:string,email:string,accountId:string>" in text
    assert "Exchange" not in text and "Join" not in text


def test_reads_without_lookups_are_one_stage(contacts):
    text = plan(marketo.read_stream(contacts.drop("archived")))
    assert "Exchange" not in text and "Join" not in text


def test_small_lookups_are_broadcast(spark, contacts, tmp_path):
    path = str(tmp_path / "map")
    spark.range(10).selectExpr("cast(id AS string) AS InputId", "concat('R', id) AS RemoteId").write.parquet(path)
    id_map = spark.read.parquet(path)
    text = plan(hubspot.contacts_write(contacts.withColumn("externalId", F.col("id")), id_map))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text and "hashpartitioning" not in text
    routed = salesforce.contacts_write(
        contacts, {"Contact": {"accountId": "AccountId"}}, id_map,
        dynamic_contact_mapping=True, unique_ids=True,
    ).records["Contact"]
    # One join finds both the route and the account's CRM id.
    assert plan(routed).count("BroadcastHashJoin") == 1


def sized_out(df):
    """Exchanges of the plan besides those of the hot-key sketch, and scans of a table."""
    text = plan(df)
    return text.count("Exchange hashpartitioning") - text.count("Exchange hashpartitioning(g#")


def test_a_large_id_map_is_shuffled_once_per_side(spark, contacts, tmp_path):
    path = str(tmp_path / "map")
    spark.range(10).selectExpr("cast(id AS string) AS InputId", "'x' AS RemoteId").write.parquet(path)
    with large_lookups():
        unsent = drop_sent(contacts.withColumn("externalId", F.col("id")), spark.read.parquet(path))
    # Facts and keys for the join, keys and hot keys for the hot answers, and the sketch's own.
    assert sized_out(unsent) <= 5
    assert plan(unsent).count("FileScan") <= 4


def wide_exchanges(df, column):
    """Exchanges of the plan that move a column."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\n]*)\]", text)
    return sum(f"{column}#" in columns for columns in moved)


@pytest.fixture
def hubspot_tables(frame):
    people = [
        (str(i), f"u{i}@x", f"wide{i}", str(i % 7) if i % 3 else None, i % 5 if i % 4 else None,
         [None, "[1, 2]", "2,9", "", '["1"]'][i % 5], i % 11 == 0, "old", i)
        for i in range(300)
    ] + [("hot", "h@x", "wide", "3", 2, "[1]", False, "old", 0)] * 200
    contacts = frame(
        people,
        "id string, email string, wide string, associatedcompanyid string, hubspot_owner_id int,"
        " _hg_list_memberships string, archived boolean, accountId string, __combine int",
    )
    owners = frame([(str(i), f"O{i}", None, f"o{i}@x") for i in range(4)],
                   "id string, firstName string, lastName string, email string")
    lists = frame([("1", "One"), ("2", "Two")], "listId string, name string")
    accounts = frame([(str(i), f"A{i}") for i in range(5)], "InputId string, RemoteId string")
    return contacts, hubspot.prepare_lookups(owners, lists, accounts)


def test_rows_are_moved_once_for_all_large_lookups(spark, hubspot_tables):
    contacts, lookups = hubspot_tables
    small = hubspot.enrich_read(contacts, "contacts", lookups)
    assert wide_exchanges(small, "wide") == 0
    expected = sorted(map(str, small.collect()))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        large = hubspot.enrich_read(contacts, "contacts", lookups)
        assert wide_exchanges(large, "wide") == 1
        got = sorted(map(str, large.collect()))
    finally:
        spark.conf.set(threshold, before)
    assert small.columns == large.columns
    assert got == expected and len(got) == 472


@pytest.mark.parametrize("absent", ["associatedcompanyid", "hubspot_owner_id", "_hg_list_memberships"])
def test_large_lookups_without_a_key_column(hubspot_tables, absent):
    contacts, lookups = hubspot_tables
    contacts = contacts.drop(absent)
    small = hubspot.enrich_read(contacts, "contacts", lookups)
    with large_lookups():
        large = hubspot.enrich_read(contacts, "contacts", lookups)
    assert small.columns == large.columns
    assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))


def test_large_lookups_with_lists_as_arrays(hubspot_tables):
    contacts, lookups = hubspot_tables
    arrays = contacts.withColumn("_hg_list_memberships", F.expr(
        "CASE __combine % 4 WHEN 0 THEN array('1', NULL, '2') WHEN 1 THEN array('1, 2') WHEN 2 THEN array() END"))
    small = hubspot.enrich_read(arrays, "contacts", lookups)
    with large_lookups():
        large = hubspot.enrich_read(arrays, "contacts", lookups)
        empty = hubspot.enrich_read(arrays.limit(0), "contacts", lookups)
    assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
    assert empty.count() == 0


def test_chained_joins_read_the_batch_once_each_way(spark, contacts, tmp_path):
    """Contacts are read for their data and for hot keys, whatever is chained behind."""
    path = str(tmp_path / "map")
    spark.range(10).selectExpr("cast(id AS string) AS InputId", "'x' AS RemoteId").write.parquet(path)
    id_map = spark.read.parquet(path)
    old = contacts.selectExpr("id AS externalId", "email AS Email", "accountId AS AccountId")
    old.write.parquet(str(tmp_path / "old"))
    old = spark.read.parquet(str(tmp_path / "old"))
    made = iter(range(100))

    def written(df, label, by=None):
        return write_and_read(df, str(tmp_path / f"{label}{next(made)}"), by)

    with large_lookups():
        result = salesforce.contacts_write(
            contacts, {"Contact": {"email": "Email", "accountId": "AccountId"}}, id_map,
            sent={"Contact": id_map}, snapshots={"Contact": old}, dynamic_contact_mapping=True,
            materialise=written,
        )
    text = plan(result.records["Contact"])
    assert f"{tmp_path}/contacts" not in text.replace("contacts.routed", "routed")
    assert text.count("FileScan") <= 10


def test_each_person_object_reads_its_own_part_of_the_routed_rows(spark, contacts, tmp_path):
    path = str(tmp_path / "map")
    spark.range(10).selectExpr("cast(id AS string) AS InputId", "'x' AS RemoteId").write.parquet(path)
    people = contacts.withColumn("accountId", F.expr("CASE WHEN id < '5' THEN accountId END"))
    written = {}

    def keep(df, label, by=None):
        if label != "contacts.routed":
            return df
        written[label] = write_and_read(df, str(tmp_path / label), by)
        return written[label]

    mapping = {s: {"email": "Email"} for s in ("Contact", "Lead")}
    for batch, found in ((people, ["Contact", "Lead"]), (people.limit(0), [])):
        result = salesforce.contacts_write(
            batch, mapping, spark.read.parquet(path), dynamic_contact_mapping=True,
            unique_ids=True, materialise=keep,
        ).records
        assert sorted(result) == found
        for stream, records in result.items():
            text = plan(records)
            # The batch is not read again, and of the routed rows one folder is.
            assert f"{tmp_path}/contacts]" not in text and text.count("FileScan") == 1
            assert re.search(rf"PartitionFilters: \[[^]]*__route#\d+ = {stream}\)", text)
            assert "Join" not in text
        assert sum(df.count() for df in result.values()) == written["contacts.routed"].count()
        tmp_path = tmp_path / "empty"
