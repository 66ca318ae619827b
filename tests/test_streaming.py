import json

from crmweave.plans import marketo
from crmweave.plans.jobs import ENVELOPE_JSON
from crmweave.streaming.incremental import stream_files, write_available

SCHEMA = "id string, email string"


def test_new_files_are_written_once(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder, out = tmp_path / "input", tmp_path / "out"
    folder.mkdir()

    def stage(name, rows):
        table = pa.table({"id": [r[0] for r in rows], "email": [r[1] for r in rows]})
        pq.write_table(table, folder / name)

    def run():
        source = stream_files(spark, str(folder), "leads", SCHEMA)
        write_available(
            source, marketo.read_stream, "leads", str(out), str(tmp_path / "check"), ENVELOPE_JSON
        ).awaitTermination(120)
        lines = [
            json.loads(line)
            for part in sorted(out.glob("batch=*/leads/*/part-*"))
            for line in part.read_text().splitlines()
        ]
        return sorted(m["record"]["sourceRecordId"] for m in lines if m["type"] == "RECORD")

    stage("leads.parquet", [("1", "a@x"), ("2", None)])
    stage("others.parquet", [("9", "z@x")])
    assert run() == ["1"]
    assert run() == ["1"]
    stage("leads-20260101.parquet", [("3", "c@x")])
    assert run() == ["1", "3"]
