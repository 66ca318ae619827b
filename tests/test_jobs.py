"""Whole runs over folders: what is written, and what a second run writes."""

import json

import pytest

from crmweave.plans import jobs
from crmweave.plans.jobs import SyncRun

SF_MAPPING = {
    "accounts/Account": {"name": "Name", "domain": "Website"},
    "contacts/Contact": {"firstName": "FirstName", "email": "Email", "accountId": "AccountId"},
    "contacts/Lead": {"firstName": "FirstName", "email": "Email"},
}


@pytest.fixture
def world(spark, tmp_path):
    class World:
        def __init__(self):
            self.runs = 0
            for name in ("input", "snapshots"):
                (tmp_path / name).mkdir()

        def stage(self, name, rows, schema):
            path = str(tmp_path / "input" / f"{name}.parquet")
            spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(path)

        def acknowledge(self, name, pairs):
            path = tmp_path / "snapshots" / f"{name}_F1.snapshot.csv"
            lines = [f"{a},{b}" for a, b in pairs]
            path.write_text("\n".join(["InputId,RemoteId", *lines]) + "\n")

        def run(self, job, mapping, **options):
            """Run a job; the records it wrote, by stream."""
            self.runs += 1
            out = tmp_path / f"out{self.runs}"
            run = SyncRun(
                spark, str(tmp_path / "input"), str(tmp_path / "snapshots"), str(out), "F1", mapping
            )
            job(run, **options)
            self.counts = run.counts
            assert not (out / "_scratch").exists()
            written = {}
            for folder in sorted(out.iterdir()) if out.exists() else []:
                lines = [
                    json.loads(line)
                    for part in sorted(folder.glob("*/part-*"))
                    for line in part.read_text().splitlines()
                ]
                if not lines:
                    continue
                assert lines[0]["type"] == "SCHEMA" and lines[0]["stream"] == folder.name
                assert all(m["type"] == "RECORD" for m in lines[1:])
                written[folder.name] = sorted((m["record"] for m in lines[1:]), key=json.dumps)
            return written

    return World()


def ids(records, key="externalId"):
    return sorted(r[key] for r in records)


def test_accounts_are_sent_once_until_they_change(world, join_mode):
    schema = "id string, name string, domain string"
    accounts = [("1", "A", "NaN"), ("2", "B", "b.com"), ("3", "C", "1,316")]
    world.stage("accounts", accounts, schema)
    mapping = {"accounts/Account": SF_MAPPING["accounts/Account"]}
    first = world.run(jobs.salesforce_write, mapping)
    assert first["Account"] == [
        {"Name": "A", "externalId": "1"},
        {"Name": "B", "Website": "b.com", "externalId": "2"},
        {"Name": "C", "Website": "1316", "externalId": "3"},
    ]
    # Not acknowledged: sent again. Acknowledged: not.
    world.acknowledge("Account", [("1", "R1")])
    assert ids(world.run(jobs.salesforce_write, mapping)["Account"]) == ["2", "3"]
    world.acknowledge("Account", [("1", "R1"), ("2", "R2"), ("3", "R3")])
    assert world.run(jobs.salesforce_write, mapping) == {}
    world.stage("accounts", [accounts[0], ("2", "B2", "b.com"), accounts[2]], schema)
    assert world.run(jobs.salesforce_write, mapping) == {
        "Account": [{"Name": "B2", "Website": "b.com", "externalId": "2"}]
    }
    assert world.run(jobs.salesforce_write, mapping) == {}


def test_hubspot_accounts_and_unsubscribes(world):
    world.stage("accounts", [("1", "A", "x"), ("2", "B", "y")], "id string, name string, hs_object_id string")
    world.stage(
        "contacts",
        [("7", "a/b@x.com", "true", "[]", None), ("8", " ", "1", None, None),
         ("9", "c@x.com", "True", '["globalUnsubscribe"]', None), ("10", "d@x.com", "1", None, "no")],
        "externalId string, email string, globalUnsubscribe string,"
        " pendingCriticalFieldsForCrmSync string, rejectionReason string",
    )
    world.acknowledge("people", [("8", "R8")])
    mapping = {"accounts/companies": {}, "contacts/people": {"a": "b"}}
    got = world.run(jobs.hubspot_write, mapping)
    assert got["companies"] == [
        {"id": "1", "name": "A", "externalId": "1"}, {"id": "2", "name": "B", "externalId": "2"}
    ]
    assert ids(got["people"]) == ["10", "7", "9"]
    assert all("globalUnsubscribe" not in r for r in got["people"])
    assert got["unsubscribe_requests"] == [{
        "email": "a/b@x.com",
        "path": "communication-preferences/v4/statuses/a%2Fb%40x.com/unsubscribe-all?channel=EMAIL",
    }]
    assert world.counts == {"globalUnsubscribe": {"pending": 1, "rejected": 1, "skipped": 2}}
    world.acknowledge("companies", [("1", "R1"), ("2", "R2")])
    assert "companies" not in world.run(jobs.hubspot_write, mapping)


def test_salesforce_people_over_several_runs(world):
    schema = "id string, firstName string, email string, accountId string"
    world.acknowledge("Account", [("a1", "R1"), ("a2", "")])
    world.stage(
        "contacts",
        [("1", "Linked", "l@x.com", "a1"), ("2", "Held", "h@x.com", "a2"),
         ("3", "Lead", "q@Y.com", None), ("4", "Lead", None, " ")],
        schema,
    )
    first = world.run(jobs.salesforce_write, SF_MAPPING, dynamic_contact_mapping=True)
    assert first == {
        "Contact": [{"FirstName": "Linked", "Email": "l@x.com", "AccountId": "R1", "externalId": "1"}],
        "Lead": [
            {"FirstName": "Lead", "Email": "q@Y.com", "externalId": "3", "Company": "y.com"},
            {"FirstName": "Lead", "externalId": "4"},
        ],
    }
    assert world.counts == {"contacts": {"total": 4, "contacts": 1, "leads": 3, "held_back": 1}}
    # The next batch has other people. Leads 3 and 4 were sent, 4 was acknowledged; contact 1
    # was not, so it comes again. The account of 2 has arrived.
    world.acknowledge("Account", [("a1", "R1"), ("a2", "R2")])
    world.acknowledge("Lead", [("4", "L4")])
    world.stage("contacts", [("2", "Held", "h@x.com", "a2"), ("5", "New", "n@x.com", None)], schema)
    second = world.run(jobs.salesforce_write, SF_MAPPING, dynamic_contact_mapping=True)
    assert ids(second["Contact"]) == ["1", "2"] and ids(second["Lead"]) == ["3", "5"]
    assert {r["externalId"]: r["AccountId"] for r in second["Contact"]} == {"1": "R1", "2": "R2"}
    # A row of the batch is emitted even when it was acknowledged.
    world.acknowledge("Lead", [("3", "L3"), ("4", "L4"), ("5", "L5")])
    third = world.run(jobs.salesforce_write, SF_MAPPING, dynamic_contact_mapping=True)
    assert ids(third["Lead"]) == ["5"]
    # Without leads in the batch, leads still open are not sent again by this run.
    world.acknowledge("Lead", [("4", "L4")])
    world.stage("contacts", [("2", "Held", "h@x.com", "a2")], schema)
    fourth = world.run(jobs.salesforce_write, SF_MAPPING, dynamic_contact_mapping=True)
    assert list(fourth) == ["Contact"]
    world.stage("contacts", [("6", "New", "z@x.com", "")], schema)
    assert ids(world.run(jobs.salesforce_write, SF_MAPPING, dynamic_contact_mapping=True)["Lead"]) == ["3", "5", "6"]


def test_people_are_conserved(world):
    schema = "id string, firstName string, email string, accountId string"
    people = [(str(i), "x", None, [None, "", "a1", "a2", "zz"][i % 5]) for i in range(100)]
    world.acknowledge("Account", [("a1", "R1"), ("a2", "R2")])
    world.stage("contacts", people, schema)
    got = world.run(jobs.salesforce_write, SF_MAPPING, dynamic_contact_mapping=True)
    assert (len(got["Contact"]), len(got["Lead"])) == (40, 40)


def test_without_the_split_everyone_is_a_contact(world):
    world.stage("contacts", [("1", "A", "a@x.com", "a1"), ("2", "B", None, None)],
                "id string, firstName string, email string, accountId string")
    got = world.run(jobs.salesforce_write, SF_MAPPING)
    assert list(got) == ["Contact"] and ids(got["Contact"]) == ["1", "2"]
    assert got["Contact"][0]["AccountId"] == "a1"


def test_write_needs_a_mapping(world):
    with pytest.raises(ValueError):
        world.run(jobs.salesforce_write, {})
    with pytest.raises(ValueError):
        world.run(jobs.hubspot_write, {})


def test_salesforce_read(world):
    world.stage("Account", [("A1", "http://www.x.com/y", False), ("A2", None, False), ("A3", "z.com", True)],
                "Id string, Website string, IsDeleted boolean")
    world.stage("Contact", [("C1", "a@x", "A1"), ("C2", " ", "A1"), ("C3", "b@x", "A9")],
                "Id string, Email string, AccountId string")
    world.stage("Lead", [("L1", "l@x", "K")], "Id string, Email string, `Address.City` string")
    world.stage("Other", [("O1",)], "Id string")
    world.acknowledge("Account", [("app1", "A1")])
    got = world.run(jobs.salesforce_read, SF_MAPPING)
    assert world.counts == {
        "Account": {"total": 3, "flagged": 1, "without_lookup_key": 1},
        "Contact": {"total": 3, "flagged": 0, "without_lookup_key": 1},
        "Lead": {"total": 1, "flagged": 0, "without_lookup_key": 0},
    }
    assert got["accounts"] == [{
        "data": {"Id": "A1", "Website": "http://www.x.com/y", "IsDeleted": False, "domain": "x.com"},
        "sourceRecordId": "A1", "source": "SALESFORCE", "lookupKey": "x.com",
    }]
    assert {r["sourceRecordId"]: r["data"] for r in got["contacts"]} == {
        "C1": {"Id": "C1", "Email": "a@x", "AccountId": "A1", "accountId": "app1"},
        "C3": {"Id": "C3", "Email": "b@x", "AccountId": "A9", "accountId": None},
        "L1": {"Id": "L1", "Email": "l@x", "Address": {"City": "K"}},
    }


def test_hubspot_read(world, join_mode):
    world.stage(
        "contacts",
        [("1", "a@x", "true", None, "10", "5", "[7, 8]"), ("2", "b@x", "no", True, None, None, None),
         ("3", "", "no", None, None, None, None)],
        "id string, email string, flag string, archived boolean, hubspot_owner_id string,"
        " associatedcompanyid string, _hg_list_memberships string",
    )
    world.stage("companies", [("9", "x.com")], "id string, domain string")
    world.stage("owners", [("10", "Ann", None, "o@x")], "id string, firstName string, lastName string, email string")
    world.stage("lists", [(7, "Seven")], "listId int, name string")
    world.acknowledge("accounts", [("5", "uuid5")])
    assert world.run(jobs.hubspot_read, {}) == {}
    got = world.run(jobs.hubspot_read, {"contacts/contacts": {}, "accounts/companies": {}})
    assert got["contacts"] == [{
        "data": {
            "id": "1", "email": "a@x", "flag": True, "archived": None, "accountId": "uuid5",
            "crmOwnerName": "Ann", "crmOwnerEmail": "o@x",
            "crmListMembershipDetails": [{"id": "7", "name": "Seven"}, {"id": "8", "name": ""}],
        },
        "sourceRecordId": "1", "source": "HUBSPOT", "lookupKey": "a@x",
    }]
    assert world.counts == {
        "contacts": {"total": 3, "flagged": 1, "without_lookup_key": 1},
        "contacts.enriched": {"total": 2, "with_account": 1, "with_memberships": 1},
        "companies": {"total": 1, "flagged": 0, "without_lookup_key": 0},
    }
    company = got["accounts"][0]["data"]
    assert company == {
        "id": "9", "domain": "x.com", "hubspot_owner_id": None, "is_public": None,
        "crmOwnerName": None, "crmOwnerEmail": None, "crmListMembershipDetails": None,
    }


def test_marketo_both_ways(world, join_mode):
    world.stage("contacts", [("1", "a@x", "s"), ("2", "b@x", "s")],
                "externalId string, email string, inferredCity string")
    world.acknowledge("leads", [("1", "M1")])
    assert world.run(jobs.marketo_write, {}) == {"leads": [{"externalId": "2", "email": "b@x"}]}
    world.stage("leads", [(1, "a@x"), (2, None)], "id int, email string")
    got = world.run(jobs.marketo_read, {"contacts/leads": {"a": "b"}})
    assert got == {"contacts": [{
        "data": {"id": 1, "email": "a@x"}, "sourceRecordId": "1", "source": "MARKETO",
        "lookupKey": "a@x",
    }]}


def test_plain_streams(world):
    world.stage("tasks", [("1", "a"), ("2", "NaN")], "id string, title string")
    mapping = {"tasks/Task": {"title": "Subject"}}
    assert world.run(lambda run: jobs.passthrough_write(run, "tasks"), mapping) == {
        "Task": [{"id": "1", "title": "a"}, {"id": "2"}]
    }
    world.acknowledge("Task", [("1", "T1")])
    assert world.run(lambda run: jobs.mapped_write(run, "tasks"), mapping) == {
        "Task": [{"externalId": "2"}]
    }


def test_a_run_that_breaks_leaves_no_state(world, monkeypatch):
    """Accounts are written before contacts; if those fail, the accounts count as not handled."""
    schema = "id string, name string, domain string"
    people = "id string, firstName string, email string, accountId string"
    world.stage("accounts", [("1", "A", "a.com")], schema)
    world.stage("contacts", [("7", "x", "x@x.com", None)], people)
    world.run(jobs.salesforce_write, SF_MAPPING)
    world.acknowledge("Account", [("1", "R1")])
    world.stage("accounts", [("1", "B", "a.com")], schema)

    def broken(*args, **options):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs.salesforce, "contacts_write", broken)
        with pytest.raises(RuntimeError):
            world.run(jobs.salesforce_write, SF_MAPPING)
    again = world.run(jobs.salesforce_write, SF_MAPPING)
    assert again["Account"] == [{"Name": "B", "Website": "a.com", "externalId": "1"}]
    assert "Account" not in world.run(jobs.salesforce_write, SF_MAPPING)


def test_a_malformed_id_map_stops_a_write(world, tmp_path):
    world.stage("contacts", [("1", "a@x")], "externalId string, email string")
    (tmp_path / "snapshots" / "leads_F1.snapshot.csv").write_text("inputId,RemoteId\n1,M1\n")
    with pytest.raises(ValueError):
        world.run(jobs.marketo_write, {})
    # A read may do without.
    (tmp_path / "snapshots" / "accounts_F1.snapshot.csv").write_text("inputId,RemoteId\n1,M1\n")
    world.stage("contacts", [("1", "a@x")], "id string, email string")
    assert list(world.run(jobs.hubspot_read, {"contacts/contacts": {}})) == ["contacts"]


def test_the_last_line_of_an_id_map_counts(world):
    world.stage("contacts", [("1", "a@x", "7")], "id string, email string, associatedcompanyid string")
    world.acknowledge("accounts", [("7", "zzz-old"), ("7", "aaa-new")])
    got = world.run(jobs.hubspot_read, {"contacts/contacts": {}})
    assert got["contacts"][0]["data"]["accountId"] == "aaa-new"


def test_the_last_row_of_a_batch_counts(world):
    rows = [("1", "zz", "1@x", None), ("1", "aa", "1@x", None)]
    world.stage("contacts", rows, "id string, firstName string, email string, accountId string")
    got = world.run(jobs.salesforce_write, {"contacts/Contact": {"firstName": "FirstName"}})
    assert [r["FirstName"] for r in got["Contact"]] in (["aa"], ["zz"])  # two files: by file name


def test_record_files_have_their_columns(world, tmp_path):
    lines = ['{"id": "1", "email": "a@x"}', '{"id": "2", "email": "b@x", "age": 3}',
             '{"id": "3", "email": "c@x"}] junk']
    (tmp_path / "input" / "contacts-1.jsonl").write_text("\n".join(lines) + "\n")
    got = world.run(jobs.hubspot_read, {"contacts/contacts": {}})["contacts"]
    assert {r["sourceRecordId"]: r["data"]["age"] for r in got} == {"1": None, "2": 3}


def test_a_run_from_a_tenant_document(spark, tmp_path):
    document = {"about": {}, "crm": {"mapping": {"F1": {
        "tasks/Task": {"title": "Subject"}, "other": {"a": "b"}}, "F2": {"x/Y": {}}}}}
    configs = spark.createDataFrame([("t1", json.dumps(document)), ("t2", "{}")], "tenant string, config string")
    (tmp_path / "in").mkdir()
    spark.createDataFrame([("1", "a")], "id string, title string").write.parquet(str(tmp_path / "in" / "tasks.parquet"))
    run = SyncRun.of_tenant(configs, "t1", "F1", str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "out"))
    assert run.by_target["tasks"] == {"title": "Subject"} and run.stream_names == {"tasks": "Task"}
    path = jobs.mapped_write(run, "tasks")
    lines = [r.value for r in spark.read.text(f"{path}/1-records").collect()]
    assert [json.loads(line)["record"] for line in lines] == [{"Subject": "a", "externalId": "1"}]
