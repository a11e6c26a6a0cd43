"""File sources, landing, anti-join, resend dedup and streaming ingest."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from pulseframe.sources import exports as S
from pulseframe.streaming import streams as ST

DOC = {"data": {"metrics": [{"name": "step_count", "units": "count",
                             "data": [{"date": "2026-07-20 08:00:00 +0200", "qty": 5}]}]}}


def write_files(folder, names, doc=DOC):
    os.makedirs(folder, exist_ok=True)
    for n in names:
        with open(os.path.join(folder, n), "w") as f:
            f.write(json.dumps(doc, indent=2))   # multi-line documents


def test_read_exports_whole_files_json_only(spark, tmpdir_path):
    write_files(tmpdir_path, ["a.json", "b.json", "notes.txt"])
    df = S.read_exports(spark, tmpdir_path, ingested_at="2026-07-21 05:00:00")
    rows = df.collect()
    assert sorted(r["_source_file"] for r in rows) == ["a.json", "b.json"]
    assert all(json.loads(r["data"]) == DOC for r in rows)
    assert rows[0]["_ingested_at"] == dt.datetime(2026, 7, 21, 5)
    assert rows[0]["file_modification_time"] is not None
    un = S.unwrap(df).first()
    assert un["_was_wrapped"] and json.loads(un["data"]) == DOC["data"]


def test_only_new_and_append(spark, tmpdir_path):
    write_files(tmpdir_path, ["a.json", "b.json", "c.json"])
    listing = S.read_exports(spark, tmpdir_path, ingested_at="2026-07-21 05:00:00")
    landed = listing.filter(F.col("_source_file") == "a.json")
    new = S.only_new(listing, landed)
    assert sorted(r["_source_file"] for r in new.collect()) == ["b.json", "c.json"]
    target = os.path.join(tmpdir_path, "_landed")
    S.land(new.select("data", "_ingested_at", "_source_file"), target)
    back = S.read_landed(spark, target)
    assert sorted(r["_source_file"] for r in back.collect()) == ["b.json", "c.json"]
    assert back.first()["_ingested_at"] == dt.datetime(2026, 7, 21, 5)
    # nothing new: the anti-join is empty and an append adds nothing
    assert S.only_new(listing, listing).count() == 0


def test_drop_exact_resends(spark):
    df = spark.createDataFrame([
        ("x", dt.datetime(2026, 7, 20), "first.json"), ("x", dt.datetime(2026, 7, 21), "again.json"),
        ("y", dt.datetime(2026, 7, 19), "other.json")], "data string, _ingested_at timestamp, _source_file string")
    got = sorted((r["_source_file"], r["copies"]) for r in S.drop_exact_resends(df).collect())
    assert got == [("first.json", 2), ("other.json", 1)]


def test_landing_path(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 7, 20, 8, 5, 9), "abc.json")], "t timestamp, n string")
    assert df.select(S.landing_path("t", "n")).first()[0] == "raw/exports/2026/07/20/20260720_080509_abc.json"


def test_stream_ingest_reads_each_file_once(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "in")
    bronze, ckpt = os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "ckpt")
    write_files(landing, ["a.json", "b.json"])
    ST.ingest_files(spark, landing, bronze, ckpt, max_files=1, glob="*.json")
    write_files(landing, ["c.json"])
    ST.ingest_files(spark, landing, bronze, ckpt, max_files=1, glob="*.json")
    ST.ingest_files(spark, landing, bronze, ckpt, max_files=1, glob="*.json")
    names = sorted(r["_source_file"] for r in spark.read.parquet(bronze).collect())
    assert names == ["a.json", "b.json", "c.json"]


def test_stream_exports_same_columns_as_batch(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "in")
    write_files(landing, ["a.json", "b.json"])
    stream = S.stream_exports(spark, landing, max_files=1)
    batch = S.read_exports(spark, landing)
    assert stream.columns == batch.columns
    out, ckpt = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck")
    q = (stream.writeStream.format("parquet").option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    got = spark.read.parquet(out).collect()
    assert sorted(r["_source_file"] for r in got) == ["a.json", "b.json"]
    assert all(json.loads(r["data"]) == DOC for r in got)


def test_reading_schema_profile(spark):
    from pulseframe.operators.flatten import explode_readings, reading_schema_profile, reading_shapes
    doc = {"metrics": [{"name": "m", "units": "u", "data": [
        {"date": "2026-07-20 08:00:00 +0200", "qty": 1},
        {"date": "2026-07-20 09:00:00 +0200", "qty": "2"}]}]}
    b = spark.createDataFrame([(json.dumps(doc), None, dt.datetime(2026, 7, 21), "f.json")],
                              "data string, _rescued_data string, _ingested_at timestamp, _source_file string")
    rows = explode_readings(b)
    prof = reading_schema_profile(rows).first()
    assert prof["n_readings"] == 2 and "qty" in prof["reading_schema"]
    assert [tuple(r) for r in reading_shapes(rows).collect()] == [("m", "date,qty", 2)]


def test_a_long_string_does_not_lose_its_file(spark):
    from pulseframe.operators.flatten import explode_readings, unparsed_documents
    doc = {"metrics": [{"name": "m", "units": "u", "data": [{"date": "2026-07-20 08:00:00 +0200", "qty": 1}]}], "note": "x" * 20_500_000}
    b = spark.createDataFrame([(json.dumps(doc), dt.datetime(2026, 7, 21), "long.json"), ("{", dt.datetime(2026, 7, 21), "bad.json"),
                               (None, dt.datetime(2026, 7, 21), "none.json")], "data string, _ingested_at timestamp, _source_file string")
    assert [r["value_qty"] for r in explode_readings(b).collect()] == [1.0]
    assert sorted(tuple(r) for r in unparsed_documents(b).collect()) == [("bad.json", "no_metrics_read"), ("none.json", "no_document")]


def test_file_names_stay_distinct_beyond_five_digits(spark):
    from pulseframe.sources import driver_tables as D
    events = spark.createDataFrame([(i, dt.datetime(2024, 1, 1), 1, "click", 1.0) for i in (2_500_001, 25_000_001, 25_000_251)],
                                   "event_id long, ts timestamp, user_id long, event_type string, value double")
    files = {r[0] for r in D.file_readings(events).filter("_source_file NOT LIKE '%resend%'").select("_source_file").collect()}
    assert files == {"export_10000.json", "export_100000.json", "export_100001.json"}


def test_folder_ingested_twice_adds_nothing_and_keeps_bytes(spark, tmpdir_path):
    folder, target = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "bronze")
    write_files(folder, ["a.json", "b.json", "notes.txt"])
    assert S.ingest_folder(spark, folder, target, "2026-07-21 05:00:00") == 2
    assert S.ingest_folder(spark, folder, target, "2026-07-22 05:00:00") == 0
    write_files(folder, ["c.json"])
    assert S.ingest_folder(spark, folder, target, "2026-07-22 05:00:00") == 1
    rows = S.read_landed(spark, target).collect()
    assert sorted(os.path.basename(r["_source_file"]) for r in rows) == ["a.json", "b.json", "c.json"]
    assert all(r["content_bytes"] == len(r["data"].encode()) and not r["data"].endswith("\n") for r in rows)
    assert len({r["request_id"] for r in rows}) == 3 and len(os.listdir(target)) >= 2


def test_landing_keeps_documents_of_one_name_and_time_apart(spark, tmpdir_path):
    at = dt.datetime(2026, 7, 21, 5)
    df = spark.createDataFrame([("{}", at, "same.json"), ("[]\n", at, "same.json")], "data string, _ingested_at timestamp, _source_file string")
    S.land(df, os.path.join(tmpdir_path, "t"))
    assert sorted(r["data"] for r in S.read_landed(spark, os.path.join(tmpdir_path, "t")).collect()) == ["[]\n", "{}"]


def test_bodies_of_first_copies(spark):
    rows = [("x", dt.datetime(2026, 7, 20), "a", 1), ("x", dt.datetime(2026, 7, 20), "a", 1), ("y", None, None, 2)]
    df = spark.createDataFrame(rows, "data string, _ingested_at timestamp, _source_file string, k int")
    got = S.with_bodies(S.drop_exact_resends(df), df).collect()
    assert sorted((r["data"], r["copies"], r["k"]) for r in got) == [("x", 2, 1), ("y", 1, 2)]


def test_stream_targets_are_current_after_late_files(spark, tmpdir_path):
    path = lambda n: os.path.join(tmpdir_path, n)

    def land_file(name, qty, modified):
        doc = {"metrics": [{"name": "step_count", "units": "n", "data": [{"date": "2026-07-20 08:00:00 +0200", "qty": qty}]}]}
        spark.createDataFrame([(json.dumps(doc), None, dt.datetime(2026, 7, 21), name, dt.datetime(2026, 7, 21, modified))],
                              "data string, _rescued_data string, _ingested_at timestamp, _source_file string, file_modification_time timestamp"
                              ).write.mode("append").parquet(path("bronze"))

    def run():
        keys = ["metric_name", "date"]
        ST.scd1_stream(spark, path("bronze"), path("one"), path("c1"), keys, [F.col("file_modification_time")], F.to_date("date"))
        ST.scd2_stream(spark, path("bronze"), path("events"), path("two"), path("c2"), keys, "file_modification_time", ["value_qty"], F.to_date("date"))
        return ([r["value_qty"] for r in ST.read_parts(spark, path("one")).collect()],
                [(r["value_qty"], r["__START_AT"].hour, r["__END_AT"].hour if r["__END_AT"] else None)
                 for r in ST.read_parts(spark, path("two")).orderBy("__START_AT").collect()])

    land_file("a.json", 1, 1)
    land_file("b.json", 2, 5)
    assert run() == ([2.0], [(1.0, 1, 5), (2.0, 5, None)])
    land_file("late.json", 3, 3)
    assert run() == ([2.0], [(1.0, 1, 3), (3.0, 3, 5), (2.0, 5, None)])
    assert run() == ([2.0], [(1.0, 1, 3), (3.0, 3, 5), (2.0, 5, None)])


def test_silver_of_one_metric_spans_tasks(spark, tmpdir_path):
    from pulseframe.plans.silver import write_silver
    rows = spark.range(400_000).selectExpr("'step_count' AS metric_name", "id", "uuid() AS value_raw")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_silver(rows, os.path.join(tmpdir_path, "s"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    parts = [f for f in os.listdir(os.path.join(tmpdir_path, "s", "metric_name=step_count")) if f.endswith(".parquet")]
    assert len(parts) > 1


def test_landed_files_keep_their_modification_time_and_revised_ones_are_new(spark, tmpdir_path):
    folder, names, revisions = (os.path.join(tmpdir_path, n) for n in ("in", "by-name", "by-revision"))
    write_files(folder, ["a.json", "b.json"])
    for name, t in (("a.json", 1_700_000_000), ("b.json", 1_700_000_100)):
        os.utime(os.path.join(folder, name), (t, t))

    def ingest():
        return (S.ingest_folder(spark, folder, names, "2026-07-21 05:00:00"),
                S.ingest_folder(spark, folder, revisions, "2026-07-21 05:00:00", keys=S.BY_REVISION))
    assert ingest() == (2, 2) and ingest() == (0, 0)
    write_files(folder, ["a.json"], {"data": {"metrics": []}})
    os.utime(os.path.join(folder, "a.json"), (1_700_000_200, 1_700_000_200))
    assert ingest() == (0, 1)
    got = [(os.path.basename(r["_source_file"]), int(r["file_modification_time"].timestamp())) for r in S.read_landed(spark, revisions).collect()]
    assert sorted(got) == [("a.json", 1_700_000_000), ("a.json", 1_700_000_200), ("b.json", 1_700_000_100)]


def test_a_landing_table_that_cannot_be_read_raises(spark, tmpdir_path):
    folder, target = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "t")
    write_files(folder, ["a.json"])
    os.makedirs(os.path.join(target, "ingest_date=2026-07-01"))
    with open(os.path.join(target, "ingest_date=2026-07-01", "part-0.parquet"), "w") as f:
        f.write("broken")
    with pytest.raises(Exception):
        S.ingest_folder(spark, folder, target)


def merge(path, rows, spark):
    from pulseframe.operators.latest import latest_by
    from pulseframe.session import scratch
    with scratch(spark) as keep:
        ST._merge_parts(path, rows, lambda both: latest_by(both, ["k"], [F.col("seq")]), keep)
    return sorted((tuple(r) for r in ST.read_parts(spark, path).select(*sorted(ST.read_parts(spark, path).columns)).collect()), key=repr)


def test_stream_targets_keep_old_rows_when_columns_change(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    one = spark.createDataFrame([("k1", 1, "p"), ("k2", 1, "p"), ("k9", 1, "q")], "k string, seq int, _part string")
    assert merge(path, one, spark) == [("k1", 1), ("k2", 1), ("k9", 1)]
    new = spark.createDataFrame([("k3", 2, "p", "x")], "k string, seq int, _part string, extra string")
    exp = [("x", "k3", 2), (None, "k1", 1), (None, "k2", 1), (None, "k9", 1)]
    assert merge(path, new, spark) == sorted(exp, key=repr)          # a new column
    assert merge(path, new, spark) == sorted(exp, key=repr)          # the same batch replayed
    fewer = spark.createDataFrame([("k1", 3, "p")], "k string, seq int, _part string")
    exp = [("x", "k3", 2), (None, "k1", 3), (None, "k2", 1), (None, "k9", 1)]
    assert merge(path, fewer, spark) == sorted(exp, key=repr)        # a column that is missing now
    with pytest.raises(Exception):                                   # any other failure is one
        merge(path, spark.createDataFrame([("k1", "z", "p")], "k string, seq string, _part string"), spark)
    assert ST.read_parts(spark, path).count() == 4
    kept = [d for d in os.listdir(spark.sparkContext.getCheckpointDir().rsplit("/", 1)[0].replace("file:", "")) if "folded" in d]
    assert kept == []


def test_stream_keeps_each_content_once_within_the_time(spark, tmpdir_path):
    path = lambda n: os.path.join(tmpdir_path, n)

    def run(*files):
        rows = [(body, None, dt.datetime(2026, 7, 21) - dt.timedelta(days=age), name, None) for name, body, age in files]
        spark.createDataFrame(rows, "data string, _rescued_data string, _ingested_at timestamp, _source_file string, file_modification_time timestamp"
                              ).coalesce(1).write.mode("append").parquet(path("bronze"))
        ST.dedup_stream(spark, path("bronze"), path("out"), path("ck"), "1 hour")
        return sorted(r["_source_file"] for r in spark.read.parquet(path("out")).collect())

    assert run(("a", "x", 0), ("b", "y", 0)) == ["a", "b"]
    assert run(("again", "x", 0), ("c", "z", 90)) == ["a", "b", "c"]  # an old load time is not late
    assert run(("again", "x", 0), ("twice1", "w", 0), ("twice2", "w", 0))[:3] == ["a", "b", "c"]
    assert spark.read.parquet(path("out")).count() == 4


def test_stream_log_has_an_event_per_batch_and_survives_a_replay(spark, tmpdir_path):
    from pulseframe.operators import expectations as X
    path = lambda n: os.path.join(tmpdir_path, n)
    good = {"date": "2026-07-20 08:00:00 +0200", "qty": 1}
    for k, readings in enumerate(([good, {"date": "bad"}], [good, good, good], [])):
        doc = {"metrics": [{"name": "step_count", "units": "n", "data": readings}]}
        spark.createDataFrame([(json.dumps(doc), None, dt.datetime(2026, 7, 21), f"f{k}", None)],
                              "data string, _rescued_data string, _ingested_at timestamp, _source_file string, file_modification_time timestamp"
                              ).coalesce(1).write.mode("append").parquet(path("bronze"))
        for _ in range(2):  # the second time as after a failure before the commit
            ST.flatten_stream_logged(spark, path("bronze"), path("silver"), path("log"), path("ck"), at="2026-07-22 00:00:00")
            commit = os.path.join(path("ck"), "commits", str(k))
            if _ == 0:
                for f in (commit, os.path.join(path("ck"), "commits", f".{k}.crc")):
                    os.path.exists(f) and os.remove(f)
    log = X.read_events(spark, path("log"))
    assert sorted(r["batch_id"] for r in log.collect()) == [0, 1, 2]
    tot = {r["expectation"]: (r["num_batches"], r["cumulative_passed"], r["cumulative_dropped"]) for r in X.expectation_totals(log).collect()}
    assert tot == {"valid_date": (3, 4, 1), "valid_metric_name": (3, 5, 0)}
    assert {(r["passed_records"], r["dropped_records"]) for r in X.expectation_latest(log).collect()} == {(0, 0)}  # one time: the last batch
    assert spark.read.parquet(path("silver")).count() == 4


def test_batch_files_bound_the_number_of_batches():
    assert [ST.batch_files(n, least=4) for n in (0, 1, 12, 16, 17, 100, 600)] == [4, 4, 4, 4, 5, 25, 150]
    assert all(-(-n // ST.batch_files(n)) <= ST.MICRO_BATCHES for n in range(1, 700))


@pytest.mark.parametrize("query, stream, runs", [("stream_resend_dedup", "dedup_stream", 2), ("stream_expectation_log", "flatten_stream_logged", 1)])
def test_batches_of_a_stream_do_not_grow_with_its_files(spark, tmpdir_path, monkeypatch, query, stream, runs):
    from pulseframe.plans import registry
    n_files, run, batches = 36, getattr(ST, stream), []
    # events of one document each; 0, 20, 40.. are sent once more without readings, 10, 30, 50.. with others
    spark.range(0, 120).selectExpr("id * 250 AS event_id", "timestamp'2024-01-01 08:00:00' AS ts", "id AS user_id",
                                   "'click' AS event_type", "id * 1.0D AS value").write.parquet(os.path.join(tmpdir_path, "events.parquet"))

    def counted(*args, **kw):
        q = run(*args, **kw)
        batches.append(sum(p["numInputRows"] > 0 for p in q.recentProgress))
        return q
    monkeypatch.setattr(ST, stream, counted)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n_files))
    try:
        rows = registry.QUERIES[query](spark, tmpdir_path).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert len(batches) == runs and all(1 < b <= ST.MICRO_BATCHES for b in batches)
    if query == "stream_resend_dedup":  # 120 documents and 12 exports of every tenth again; the copies add none
        assert len({r["_source_file"] for r in rows}) == len(rows) == 132 and all(r["intact"] for r in rows)
        assert not any(r["_source_file"].startswith("copy_") for r in rows)
    else:
        assert {r["expectation"]: r["cumulative_passed"] + r["cumulative_dropped"] for r in rows} == {"valid_date": 126, "valid_metric_name": 126}
