"""The job over string-keyed tables in the export's own layouts; scripts; publishing after failed runs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quillmart import __main__ as cli
from quillmart.operators import staging
from quillmart.operators.attributes import WAREHOUSE_FIELDS
from quillmart.plans.job import ADHERENCE_MART, ITEM_MART
from quillmart.session import scratch_dir
from quillmart.sources.query import run_query
from quillmart.sources.sink import SnapshotTable, publish_mart, read_mart
from quillmart.sources.warehouse import SOURCE_NAMES, bind_sources
from quillmart.streaming.sync_stream import upsert_batch

STAMP = dt.datetime(2024, 3, 1)


def _table(spark, layout, rows, types):
    cols = list(layout.values())
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in cols)
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)


@pytest.fixture(scope="module")
def mapping(spark):
    up = {"WhenUpsertedIntoDataStore": STAMP}
    times = {c: "timestamp_ntz" for c in ("WhenUpsertedIntoDataStore", "CreatedAt", "ModifiedAt", "DueAt", "CompletedAt", "StartOn")}
    flags = {c: "boolean" for c in ("IsDeleted", "Completed", "Archived")}
    types = {**times, **flags, "DueOn": "date", "DueDate": "timestamp_ntz"}
    task = {**up, "Gid": "t1", "Name": "first", "IsDeleted": False, "AssigneeUserGID": "u1", "CreatedAt": STAMP, "ModifiedAt": STAMP,
            "DueOn": dt.date(2024, 3, 9), "Completed": True, "CompletedByUserGID": "u1", "CompletedAt": STAMP + dt.timedelta(days=2)}
    values = [{**up, "TaskGID": "t1", "CustomFieldGID": f, "DisplayValue": name} for f, name in WAREHOUSE_FIELDS if "date" not in name]
    frames = {
        "task": _table(spark, staging.WAREHOUSE_TASK, [task, {**task, "Gid": "t2", "IsDeleted": True}], types),
        "task_project": _table(spark, staging.WAREHOUSE_TASK_PROJECT, [{**up, "TaskGID": "t1", "ProjectGID": "1201"}], types),
        "project": _table(spark, staging.WAREHOUSE_PROJECT, [{**up, "Gid": "1201", "Name": "project one"}], types),
        "user": _table(spark, staging.WAREHOUSE_USER, [{**up, "GID": "u1", "Name": "Una", "Email": "una@example.com"}], types),
        "field_value": _table(spark, staging.WAREHOUSE_FIELD_VALUE, values, types),
        "pay_rate": spark.createDataFrame([("una@example.com", STAMP, "Lead")], "worker_email string, effective_from timestamp_ntz, position_title string"),
        "workers": spark.createDataFrame([("una@example.com", '["Max"]', '["Dir"]')], "work_email_address_copy string, manager_name string, director_name string"),
        "company": spark.createDataFrame(
            [("c1", "Acme", "https://app.example.com/0/1201/list", "Active", "o1", "o1", STAMP, None, False)],
            "id string, property_name string, property_asana_project string, property_client_status string, property_brand_director string, "
            "property_brand_manager string, property_effective_from timestamp_ntz, property_effective_to timestamp_ntz, is_deleted boolean"),
        "deal_company": spark.createDataFrame([("c1", "d1")], "company_id string, deal_id string"),
        "deal": spark.createDataFrame([("d1", "closedwon", "new", STAMP, False)],
                                      "deal_id string, deal_pipeline_stage_id string, property_dealtype string, "
                                      "property_effective_from timestamp_ntz, is_deleted boolean"),
        "owner": spark.createDataFrame([("o1", "Olga", "Orr")], "owner_id string, first_name string, last_name string"),
    }
    base, out = scratch_dir(spark, "warehouse"), {}
    for name, df in frames.items():
        out[name] = f"{base}/{name}"
        df.write.parquet(out[name])
    return out


def test_job_over_bound_tables(spark, mapping, tmp_path, capsys):
    assert set(mapping) == set(SOURCE_NAMES)
    names = tmp_path / "tables.json"
    names.write_text(json.dumps(mapping))
    out = scratch_dir(spark, "warehouse-marts")
    cli.main(["--tables", str(names), "--out", out, "--as-of", "2024-04-01T00:00:00", "--today", "2024-04-01"])
    item, adherence = read_mart(spark, f"{out}/{ITEM_MART}"), read_mart(spark, f"{out}/{ADHERENCE_MART}")
    assert len(item.columns) == 51 and len(adherence.columns) == 49
    row = item.first()
    assert item.count() == 1 and (row.task_id, row.project_name, row.company_name, row.task_assignee_name) == ("t1", "project one", "Acme", "Una")
    assert row.cf_task_type_cswo_wp == "cf_task_type_cswo_wp" and row.company_brand_director == "Olga Orr"


def test_binding_wants_every_source(spark, mapping):
    with pytest.raises(ValueError, match="owner"):
        bind_sources(spark, {k: v for k, v in mapping.items() if k != "owner"})


def test_project_staging_has_all_columns(spark, mapping):
    staged = staging.stage(spark.read.parquet(mapping["project"]), staging.WAREHOUSE_PROJECT)
    assert len(staged.columns) == 19 and dict(staged.dtypes)["project_due_date"] == "date"


def test_script_from_a_file(spark, tmp_path):
    p = tmp_path / "script.sql"
    p.write_text("CREATE OR REPLACE TEMPORARY VIEW script_v AS SELECT 1 AS one; -- a; comment\nSELECT one + 1 AS two, ';' AS semi FROM script_v;\n")
    assert run_query(spark, path=str(p)).first().asDict() == {"two": 2, "semi": ";"}
    with pytest.raises(ValueError):
        (tmp_path / "two").mkdir()
        for n in "ab":
            (tmp_path / "two" / n).write_text("SELECT 1")
        run_query(spark, path=f"file://{tmp_path}/two")


def test_a_half_written_version_blocks_nothing(spark):
    base = scratch_dir(spark, "half")
    table = SnapshotTable(spark, base)
    table.commit(spark.range(3))
    spark.range(9).write.parquet(f"{base}/{table.attempt()}")  # no log entry: the run failed
    assert table.current().count() == 3
    assert table.commit(spark.range(5)) == 2 and table.current().count() == 5
    marts = scratch_dir(spark, "half-mart")
    df = spark.range(10).select("id", F.expr("timestamp_ntz '2000-01-01' + make_interval(0, 0, 0, int(id))").alias("t"))
    publish_mart(df, marts, "t", ["id"])
    df.write.parquet(f"{marts}/{table.attempt()}")
    assert read_mart(spark, marts).count() == 10
    publish_mart(df.where("id < 6"), marts, "t", ["id"])
    assert read_mart(spark, marts).count() == 6
    some = read_mart(spark, marts, days=("2000-01-02", dt.date(2000, 1, 3)))
    assert sorted(r.id for r in some.collect()) == [1, 2]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__day" in plan


def test_streams_skip_only_their_own_epochs(spark):
    table = SnapshotTable(spark, scratch_dir(spark, "epochs"))
    batch = lambda k: spark.createDataFrame([(k, "x")], "k long, s string")
    table.commit(spark.createDataFrame([(0, "old", None)], "k long, s string, _synced_at timestamp_ntz"))
    assert upsert_batch(table, batch(1), 0, "k", stream="a") and upsert_batch(table, batch(2), 1, "k", stream="a")
    assert upsert_batch(table, batch(3), 0, "k", stream="b")  # a new checkpoint folder starts at epoch 0 again
    assert not upsert_batch(table, batch(9), 1, "k", stream="a")
    assert table.streams() == {"a": 1, "b": 0}
    assert sorted(r.k for r in table.current().collect()) == [0, 1, 2, 3]
