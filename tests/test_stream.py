"""The file stream: restarts, replays, rejected records, touched days, and the archive."""

import json
import os

from pyspark.sql import functions as F

from starload.plans import commits
from starload.schemas import RAW_VISIT, STG_TRAFFIC
from starload.streaming import ingest
from starload.streaming.ingest import stream_dead_letters, stream_epochs, stream_ingest_orders_to_table, stream_ingest_to_table

from test_landing import order

T0, DAY = 1704067200, 86400


def land(src, name, recs, file="part-0.json"):
    d = src / f"batch={name}"
    d.mkdir(parents=True, exist_ok=True)
    (d / file).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in recs))


def visit(sid, views, t):
    return {"session_id": sid, "visit_time": t, "page_views": views, "session_duration": 1.0}


def views(df):
    return {r.session_id: r.page_views for r in df.collect()}


def left_files(src):
    return [f for _, _, files in os.walk(src) for f in files if f.endswith(".json")]


def test_restart_continues_from_what_was_committed(spark, tmp_path):
    src, table = tmp_path / "src", str(tmp_path / "table")
    land(src, "202401010000", [visit("a", 1, T0), visit("b", 2, T0 + 1)])
    assert stream_ingest_to_table(spark, str(src), table).count() == 2
    # restart over the same table and source: only the new file is read, merged into what was committed
    land(src, "202401010400", [visit("b", 5, T0 + 14400), visit("c", 1, T0 + 14401)])
    assert views(stream_ingest_to_table(spark, str(src), table)) == {"a": 1, "b": 5, "c": 1}


def test_triggers_write_touched_days_and_reject_aside(spark, tmp_path):
    src, table = tmp_path / "src", str(tmp_path / "table")
    land(src, "1", [visit("a", 1, T0), visit("b", 2, T0 + DAY), visit("c", 3, T0 + 2 * DAY)])
    stream_ingest_to_table(spark, str(src), table)
    first = commits.state(spark, table)
    bad = json.dumps(visit("x", "many", T0))
    land(src, "2", [visit("b", 9, T0 + 3 * DAY), bad, "{broken"])  # b moves from day 2 to day 4
    assert views(stream_ingest_to_table(spark, str(src), table)) == {"a": 1, "b": 9, "c": 3}
    second = commits.state(spark, table)
    assert first.parts("rows") == ["20240101", "20240102", "20240103"] and second.parts("rows") == ["20240101", "20240103", "20240104"]
    assert all(second.paths["rows", p] == first.paths["rows", p] for p in ("20240101", "20240103"))
    wrote = {(r.epoch, r.part) for r in stream_epochs(spark, table).collect() if r.table == "rows"}
    assert wrote == {(0, "20240101"), (0, "20240102"), (0, "20240103"), (1, "20240104")}
    letters = {r.raw_record: (r.record_key, r.reason.split(";")[0]) for r in stream_dead_letters(spark, table).collect()}
    assert letters == {bad: ("x", "bad page_views"), "{broken": (None, "malformed record")}
    # the same records in another file, and an older form of b: nothing changes but the letter's file
    land(src, "3", [visit("a", 1, T0), visit("b", 2, T0 + DAY)])
    assert views(stream_ingest_to_table(spark, str(src), table)) == {"a": 1, "b": 9, "c": 3}


def test_an_epoch_that_comes_again_is_skipped(spark, tmp_path, monkeypatch):
    src, table = tmp_path / "src", str(tmp_path / "table")
    land(src, "1", [visit("a", 1, T0)])
    sinks = []
    real = ingest.stream_ingest

    def twice(spark, path, schema, checkpoint, archive, sink, **kw):
        def replayed(batch, epoch):
            sink(batch, epoch)
            sinks.append(commits.commits(spark, table))
            sink(batch.withColumn("page_views", F.lit("7")), epoch)

        return real(spark, path, schema, checkpoint, archive, replayed, **kw)

    monkeypatch.setattr(ingest, "stream_ingest", twice)
    assert views(stream_ingest_to_table(spark, str(src), table)) == {"a": 1} and sinks == [[0]]


def test_consumed_files_lie_in_the_archive(spark, tmp_path):
    src, table = tmp_path / "src", str(tmp_path / "table")
    for k in range(3):
        land(src, str(k), [visit(f"s{k}", k, T0 + k)])
    stream_ingest_to_table(spark, str(src), table, max_files_per_trigger=1)  # three epochs in one run
    assert left_files(src) == [] and len(left_files(f"{table}_archive")) == 3
    assert [e for e in commits.commits(spark, table)] == [0, 1, 2]
    archived = f"{table}_archive{src}/batch=1/part-0.json"
    assert json.loads(open(archived).read())["session_id"] == "s1"


def test_orders_without_lines_are_rejected(spark, tmp_path):
    src, table = tmp_path / "src", str(tmp_path / "table")
    land(src, "1", [order(), order(order_id="O2", item_list=[])])
    assert [r.order_id for r in stream_ingest_orders_to_table(spark, str(src), table).collect()] == ["O1"]
    assert [(r.record_key, r.reason) for r in stream_dead_letters(spark, table).collect()] == [("O2", "no line")]


def test_nothing_landed(spark, tmp_path):
    (tmp_path / "src").mkdir()
    out = stream_ingest_to_table(spark, str(tmp_path / "src"), str(tmp_path / "table"))
    assert out.count() == 0 and out.columns == STG_TRAFFIC.names


def test_load_batch_runs_source_transform_and_sink(spark, tmp_path):
    src = tmp_path / "src"
    land(src, "1", [visit("a", 1, T0), visit("b", "x", T0)])
    from starload.sources.landing import ingest_traffic, read_landed

    rejected = []
    got = ingest.load_batch(read_landed(spark, str(src), RAW_VISIT), ingest_traffic, lambda rows: [r.session_id for r in rows.collect()],
                            lambda bad: rejected.extend(r.session_id for r in bad.collect()))
    assert (got, rejected) == (["a"], ["b"])
    assert ingest.load_batch(spark.range(3), lambda df: df.where("id > 0"), lambda rows: rows.count()) == 2
