"""Operators on small frames, expected values worked out by hand or by plain Python."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from crmweave.functions.cleaning import sanitize_record
from crmweave.functions.jsontext import json_with_bools
from crmweave.operators import accounts, dedupe, enrich, envelope, filters, mapping, nesting, reports
from crmweave.session import stay_lazy, write_table
from crmweave.sinks.singer import singer_records


def rows(df):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=str)


# Field mapping

def copy_by_copy(columns, record, fields):
    """The mapping rule, one copy after the other."""
    fields = fields if "remote_id" in fields else fields | {"remote_id": "Id"}
    data = dict(record)
    for column in columns:
        if column in fields:
            data[fields[column]] = data[column]
    out = {t: data[t] for t in fields.values() if t in data}
    if "id" in record:
        out["externalId"] = record["id"]
    return out


@pytest.mark.parametrize(
    "fields",
    [
        {"name": "Name"},
        {"name": "email", "email": "id", "id": "remote_id"},
        {"email": "name", "name": "email"},
        {"name": "X", "email": "X", "absent": "Y"},
        {"name": "absent", "email": "name"},
        {"remote_id": "RemoteKey", "id": "externalId"},
        {"absent": "name"},
    ],
)
def test_mapping_follows_the_copies(spark, fields):
    columns = ["id", "name", "email", "remote_id"]
    record = dict(zip(columns, ["1", "n", "e", "r"]))
    df = spark.createDataFrame([tuple(record.values())], ", ".join(f"{c} string" for c in columns))
    mapped = mapping.map_fields(df, fields)
    expected = copy_by_copy(columns, record, fields)
    assert mapped.columns == list(expected)
    assert rows(mapped) == [expected]


def test_mapping_is_one_projection(spark):
    df = spark.range(3).selectExpr("cast(id AS string) AS id", "'a' AS name", "'b' AS email")
    plan = mapping.map_fields(df, {"name": "email", "email": "Mail"})
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Project") == 1


def test_missing_mapping_is_an_error(spark):
    df = spark.createDataFrame([("1",)], "id string")
    with pytest.raises(ValueError):
        mapping.map_stream(df, "contacts", {})
    with pytest.raises(ValueError):
        mapping.map_stream(df, "contacts", {"accounts": {"a": "b"}})
    assert mapping.map_stream(df, "contacts", {"contacts": {}}).columns == ["externalId"]


# Nesting

def as_json(df):
    return [json.loads(r.j) for r in df.select(F.to_json(F.struct("*")).alias("j")).collect()]


def test_nesting(spark):
    ddl = (
        "id int, `hq.city` string, `hq.geo.lat` double, hq string, `f[*].amount` int,"
        " `f[*].by[*]` string, `f[*].by[*].x` string, `bare[*]` string"
    )
    data = [
        (1, "B", 1.5, "old", 5, "x", None, "k"),
        (2, None, 2.5, "old", None, None, "y", None),
        (3, None, None, "old", None, None, None, None),
    ]
    got = as_json(nesting.nest_columns(spark.createDataFrame(data, ddl)))
    assert got == [
        {"id": 1, "bare[*]": "k", "hq": {"city": "B", "geo.lat": 1.5},
         "f": [{"amount": 5, "by": ["x"]}]},
        {"id": 2, "hq": {"geo.lat": 2.5}, "f": [{"by": ["y"]}]},
        {"id": 3},
    ]


def test_arrays_win_over_structs_of_one_name(spark):
    df = spark.createDataFrame([("a", "b")], "`p.x` string, `p[*].y` string")
    assert as_json(nesting.nest_columns(df)) == [{"p": [{"y": "b"}]}]


def test_nesting_without_special_names_changes_nothing(spark):
    df = spark.createDataFrame([("a",)], "x string")
    assert nesting.nest_columns(df).columns == ["x"]


# Envelope

def test_nulls_in_data_stay_and_nested_nulls_go(spark):
    ddl = "Id int, Email string, v double, `a.x` string, `a.y` string, s struct<n:string>"
    df = spark.createDataFrame([(1, "e@x", float("nan"), "q", None, (None,))], ddl)
    row = envelope.wrap_envelope(
        nesting.nest_columns(df), "SALESFORCE", id_field="Id", lookup_field="Email"
    ).collect()[0]
    assert json.loads(row.data) == {
        "Id": 1, "Email": "e@x", "v": None, "s": {"n": None}, "a": {"x": "q"},
    }
    assert (row.sourceRecordId, row.source, row.lookupKey) == ("1", "SALESFORCE", "e@x")


def test_lookup_filter_comes_before_cleaning(spark):
    df = spark.createDataFrame([("1,316", "NaN"), ("2", " \t"), ("3", None)], "id string, email string")
    got = envelope.wrap_envelope(df, "X", "contacts", sanitize=True).collect()
    assert [(r.sourceRecordId, r.lookupKey, json.loads(r.data)) for r in got] == [
        ("1316", None, {"id": "1316", "email": None})
    ]


def test_missing_columns(spark):
    df = spark.createDataFrame([("1",)], "id string")
    with pytest.raises(ValueError):
        envelope.wrap_envelope(df, "X", "contacts")
    empty = envelope.wrap_envelope(df, "X", "contacts", on_missing="empty")
    assert empty.count() == 0 and empty.columns[0] == "data"
    assert envelope.wrap_envelope(df, "X", "contacts", on_missing="passthrough") is df


def test_default_fields(spark):
    assert envelope.default_lookup_field("Leads") == "email"
    assert envelope.default_lookup_field("Account") == "domain"
    assert envelope.default_id_field(spark.createDataFrame([(1,)], "Id int")) == "Id"


# Filters

def test_flags_of_every_type(spark):
    df = spark.createDataFrame(
        [(1, True, "true", 2), (2, False, " 1\n", 0), (3, None, "no", None), (4, None, None, 1)],
        "id int, b boolean, t string, n int",
    )
    assert [r.id for r in filters.drop_flagged(df, "b").collect()] == [2, 3, 4]
    assert [r.id for r in filters.drop_flagged(df, "t").collect()] == [3, 4]
    assert [r.id for r in filters.drop_flagged(df, "n").collect()] == [2, 3]
    assert filters.drop_flagged(df, "absent") is df


@pytest.mark.parametrize(
    "pending, free",
    [
        (None, True), ("", True), (" NULL ", True), ("None", True), ("[]", True), ("[ ]", True),
        ('["f"]', False), ('["g", "f"]', False), ('["ff"]', True), ("[f", False), ("g,f", False),
        ("ff", False), ("g", True), ('["g"] f', False), ('[["f"]]', True), ("[1]", True),
    ],
)
def test_pending_fields(spark, pending, free):
    df = spark.createDataFrame([(pending,)], f"{filters.PENDING_COLUMN} string")
    assert filters.approval_gate(df, "f").count() == int(free)


def test_pending_arrays_and_rejections(spark):
    df = spark.createDataFrame(
        [(["f"], None), (["g"], " none "), (None, "why"), (["g", None], ""), ([], "NULL")],
        f"{filters.PENDING_COLUMN} array<string>, {filters.REJECTION_COLUMN} string",
    )
    got = [getattr(r, filters.PENDING_COLUMN) for r in filters.approval_gate(df, "f").collect()]
    assert got == [["g"], ["g", None], []]
    assert filters.approval_gate(df.select(filters.REJECTION_COLUMN), "f").count() == 4


# Dedupe and state

def test_drop_sent(join_mode, frame):
    df = frame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "externalId string, n int")
    sent = frame([("a", "r"), ("b", "r"), (None, "r")], "InputId string, RemoteId string")
    changed = frame([("b",)], "externalId string")
    assert dedupe.drop_sent(df, None) is df
    assert [r["n"] for r in rows(dedupe.drop_sent(df, sent))] == [3]
    assert {r["n"] for r in rows(dedupe.drop_sent(df, sent, changed))} == {2, 3}
    assert {r["n"] for r in rows(dedupe.drop_sent(df, sent, changed, write_table))} == {2, 3}
    assert [r["n"] for r in rows(dedupe.drop_sent(df, sent, None, write_table))] == [3]
    with pytest.raises(ValueError):
        dedupe.drop_sent(df.drop("externalId"), sent)
    with pytest.raises(ValueError):
        dedupe.drop_sent(df, sent.drop("InputId"))


def test_changed_ids(join_mode, frame):
    old = frame([("a", "1"), ("b", "2"), ("c", "3")], "externalId string, v string")
    new = frame([("a", "1"), ("b", "9"), ("d", "4"), ("a", "1")], "externalId string, v string")
    stored = dedupe.detect_changed(old, None)
    assert {r["externalId"] for r in rows(dedupe.detect_changed(new, stored))} == {"b", "d"}
    swapped = new.select("v", "externalId")
    assert {r["externalId"] for r in rows(dedupe.detect_changed(swapped, stored))} == {"b", "d"}


def test_copies_with_different_content_settle(join_mode, frame):
    batch = frame([("a", "1"), ("a", "2")], "externalId string, v string")
    stored = dedupe.detect_changed(batch, None)
    assert dedupe.detect_changed(batch, stored).count() == 0


def test_upsert(join_mode, frame):
    old = frame([("a", "old"), ("b", "old"), (None, "old")], "externalId string, v string")
    new = frame(
        [("a", "x", 1), ("a", "y", 2), ("c", "z", 1), (None, "p", 1), (None, "q", 1)],
        "externalId string, v string, at int",
    )
    merged = dedupe.upsert_snapshot(old, new, order_by="at")
    got = sorted(((r.externalId, r.v) for r in merged.collect()), key=str)
    assert got == sorted(
        [("a", "y"), ("b", "old"), ("c", "z"), (None, "p"), (None, "q")], key=str
    )


# Accounts

ID_MAP = [("a1", "R1"), ("a2", None), ("a1", "R0"), ("a3", "R3")]
CONTACTS = [(1, "a1"), (2, "a2"), (3, "a9"), (4, None), (5, "  "), (6, "a3")]


def test_routing_of_contacts(join_mode, frame):
    contacts = frame(CONTACTS, "id int, accountId string")
    id_map = frame(ID_MAP, "InputId string, RemoteId string")
    routed = accounts.route_contacts(contacts, id_map)
    assert {r.id: r["__route"] for r in routed.collect()} == {
        1: "Contact", 2: "Held", 3: "Held", 4: "Lead", 5: "Lead", 6: "Contact",
    }
    people, leads = accounts.split_contact_lead(contacts, id_map)
    assert people.columns == leads.columns == ["id", "accountId"]
    assert sorted(r.id for r in people.collect()) == [1, 6]
    assert sorted(r.id for r in leads.collect()) == [2, 3, 4, 5]
    held = accounts.hold_back_pending(contacts, id_map)
    assert sorted(r.id for r in held.collect()) == [1, 4, 5, 6]


def test_contacts_without_account_column_are_leads(frame):
    contacts = frame([(1,)], "id int")
    assert accounts.route_contacts(contacts, None).collect()[0]["__route"] == "Lead"
    with pytest.raises(ValueError):
        accounts.split_contact_lead(contacts, None)


def test_account_ids_are_attached(join_mode, frame):
    people = frame(CONTACTS, "id int, AccountId string")
    id_map = frame(ID_MAP, "InputId string, RemoteId string")
    got = {r.id: (r.InputAccountId, r.AccountId) for r in
           accounts.attach_account_id(people, id_map).collect()}
    assert got == {
        1: ("a1", "R1"), 2: ("a2", None), 3: ("a9", None), 4: (None, None), 5: ("  ", None),
        6: ("a3", "R3"),
    }


def test_no_synced_account_leaves_account_ids_alone(join_mode, frame):
    people = frame(CONTACTS, "id int, AccountId string")
    unsynced = frame([("a1", None)], "InputId string, RemoteId string")
    got = {r.id: r.AccountId for r in accounts.attach_account_id(people, unsynced).collect()}
    assert got == dict(CONTACTS)
    assert accounts.attach_account_id(people, None) is people


def test_crm_account_ids_resolve_to_app_ids(join_mode, frame):
    people = frame([(1, "R1"), (2, "R9"), (3, None)], "Id int, AccountId string")
    id_map = frame([("a1", "R1"), ("a2", None)], "InputId string, RemoteId string")
    got = accounts.resolve_sf_account(people, id_map)
    assert {r.Id: (r.AccountId, r.accountId) for r in got.collect()} == {
        1: ("R1", "a1"), 2: ("R9", None), 3: (None, None),
    }


def test_companies_resolve_to_accounts(join_mode, frame):
    contacts = frame([(1, 10), (2, 11), (3, None)], "id int, associatedcompanyid long")
    lookup = enrich.account_lookup(
        frame([("10", "u1"), ("12", None), (None, "u2")], "InputId string, RemoteId string")
    )
    got = accounts.resolve_company_account(contacts, lookup)
    assert got.columns == ["id", "accountId"]
    assert {r.id: r.accountId for r in got.collect()} == {1: "u1", 2: None, 3: None}
    none = accounts.resolve_company_account(contacts, None)
    assert {r.accountId for r in none.collect()} == {None}


def test_people_of_an_object(frame):
    routed = accounts.route_contacts(
        frame(CONTACTS, "id int, accountId string"), frame(ID_MAP, "InputId string, RemoteId string")
    )
    pick = lambda crm, s: accounts.select_contact_data(crm, s, routed).count()
    assert (pick("salesforce", "Contact"), pick("salesforce", "Lead"), pick("hubspot", "x")) == (2, 2, 6)
    with pytest.raises(ValueError):
        pick("salesforce", "x")


# Enrichment

def test_owner_details(join_mode, frame):
    owners = frame(
        [(1, " Ann", None, "a@x", False), (2, None, None, "b@x", None), (3, "C", "D", "c@x", True)],
        "id int, firstName string, lastName string, email string, archived boolean",
    )
    contacts = frame([("x", "1"), ("y", "2"), ("z", "3"), ("w", None)], "id string, hubspot_owner_id string")
    lookup = enrich.owner_lookup(owners)
    got = enrich.enrich_owner(contacts, lookup, "hubspot_owner_id")
    assert got.columns == ["id", "crmOwnerName", "crmOwnerEmail"]
    assert {r.id: (r.crmOwnerName, r.crmOwnerEmail) for r in got.collect()} == {
        "x": ("Ann", "a@x"), "y": ("b@x", "b@x"), "z": (None, None), "w": (None, None),
    }
    without = enrich.enrich_owner(contacts, None, "hubspot_owner_id")
    assert without.columns == ["id", "hubspot_owner_id", "crmOwnerName", "crmOwnerEmail"]


@pytest.mark.parametrize("kind", ["text", "array"])
def test_list_memberships(join_mode, frame, kind):
    lists = frame([(i, f"L{i}") for i in range(3000)] + [(5000, None)], "listId int, name string")
    ids = {1: [7, 2999, 9999], 2: [5000], 3: None, 4: [], 5: [7, 7]}
    if kind == "text":
        data = [(k, None if v is None else json.dumps(v)) for k, v in ids.items()]
        contacts = frame(data, "id int, _hg_list_memberships string")
    else:
        contacts = frame(list(ids.items()), "id int, _hg_list_memberships array<int>")
    got = enrich.enrich_list_memberships(contacts, enrich.list_lookup(lists))
    assert got.columns == ["id", "crmListMembershipDetails"]
    name = lambda i: f"L{i}" if i < 3000 else ""
    assert {
        r.id: r.crmListMembershipDetails and [(d.id, d.name) for d in r.crmListMembershipDetails]
        for r in got.collect()
    } == {k: [(str(i), name(i)) for i in v] if v else None for k, v in ids.items()}


def test_memberships_without_lookup_or_column(frame):
    contacts = frame([(1, "7")], "id int, _hg_list_memberships string")
    got = enrich.enrich_list_memberships(contacts, None).collect()[0]
    assert [(d.id, d.name) for d in got.crmListMembershipDetails] == [("7", "")]
    bare = enrich.enrich_list_memberships(contacts.select("id"), None).collect()[0]
    assert bare.crmListMembershipDetails is None


# Reports

def test_sanitize_report(frame):
    df = frame(
        [("NaN", ["1,316", "x"], ("[1]",)), ("ok", ["NaN", None], ("12,34",)), (None, None, None)],
        "a string, l array<string>, s struct<`it's`:string>",
    )
    got = {(r.column_name, r.reason): r.n for r in reports.sanitize_report(df).collect()}
    assert got == {
        ("a", "nonfinite"): 1, ("l", "comma_number"): 1, ("l", "nonfinite"): 1,
        ("s", "flagged_container"): 2,
    }


def test_nan_is_no_flag(frame):
    rows = [(1, float("nan")), (2, 1.0), (3, 0.0), (4, None)]
    df = frame(rows, "n int, archived double")
    assert [r.n for r in filters.drop_archived(df).orderBy("n").collect()] == [1, 3, 4]


def test_no_infinite_number_leaves(spark, frame):
    rows = [(1, float("inf"), [float("-inf"), 2.5]), (2, float("nan"), [1.0])]
    cleaned = sanitize_record(frame(rows, "n int, v double, w array<double>")).orderBy("n").collect()
    assert [(r.v, r.w) for r in cleaned] == [(None, [None, 2.5]), (None, [1.0])]


@pytest.mark.parametrize("ignored", ["true", "false"])
def test_json_does_not_depend_on_the_session(spark, frame, ignored):
    setting = "spark.sql.jsonGenerator.ignoreNullFields"
    df = frame([("True", None, Decimal("1.10"))], "a string, b string, c decimal(5,2)")
    try:
        spark.conf.set(setting, ignored)
        line = singer_records(df, "s").first()[0]
        words = df.select(json_with_bools(df.schema).alias("j")).first()[0]
    finally:
        spark.conf.unset(setting)
    assert line == '{"type":"RECORD","stream":"s","record":{"a":"True","c":"1.10"}}'
    assert words == '{"a":true,"b":null,"c":1.10}'


def test_latest_per_key_keeps_all_keyless_rows(frame):
    rows = [("1", "a", 1), ("1", "b", 2), ("2", "c", 1), (None, "d", 1), (None, "d", 1)]
    df = frame(rows, "k string, v string, at int")
    for materialise in (stay_lazy, write_table):
        got = dedupe.latest_per_key(df, "k", "at", materialise).collect()
        assert sorted((r.k or "", r.v) for r in got) == [("", "d"), ("", "d"), ("1", "b"), ("2", "c")]
