"""Schema evolution with rescued data: nothing of a reading is lost."""

import datetime as dt
import json
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pulseframe.operators import schema_evolution as E
from pulseframe.streaming import streams as ST

SCALARS = st.one_of(st.none(), st.booleans(), st.integers(-10 ** 9, 10 ** 9), st.floats(-1e6, 1e6, allow_nan=False).map(lambda x: round(x, 3)), st.text(max_size=5))
VALUES = st.one_of(SCALARS, st.lists(SCALARS, max_size=2), st.dictionaries(st.sampled_from("xyz"), SCALARS, max_size=2))
READINGS = st.lists(st.dictionaries(st.sampled_from(["qty", "Qty", "date", "a b", "é\"\\", "avg", "Avg", ""]), VALUES, max_size=5), min_size=1, max_size=8)


def texts(spark, readings):
    return spark.createDataFrame([(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(readings)], "i int, value_raw string")


def joined(row, fields):
    """The reading put together again from its columns and the rescued data."""
    out = json.loads(row["_rescued_data"]) if row["_rescued_data"] else {}
    for f, kind in fields:
        v = row["reading"][f]
        if v is not None:
            out[f] = json.loads(v) if kind in ("object", "array") else v
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=READINGS, second=READINGS)
def test_columns_and_rescued_data_are_the_whole_reading(spark, first, second):
    import tempfile
    log = os.path.join(tempfile.mkdtemp(prefix="pf-test-"), "log")
    for batch, readings in enumerate((first, second)):
        rows = texts(spark, readings)
        fields = E.evolve(spark, log, E.fields_of(rows), batch)
        assert len({f.lower() for f, _ in fields}) == len(fields)
        got = sorted(E.read_with_schema(rows, fields, keep=["i"]).collect(), key=lambda r: r["i"])
        for r, exp in zip(got, readings):
            if not fields:
                assert json.loads(r["_rescued_data"]) == exp
                continue
            back = joined(r, fields)
            # a null under a known field is the column's null
            assert back == {k: v for k, v in exp.items() if v is not None or k not in dict(fields)}
            rest = json.loads(r["_rescued_data"]) if r["_rescued_data"] else {}
            assert all(k not in dict(fields) or E.COLUMN_TYPES[dict(fields)[k]] != "double" or not isinstance(v, (int, float)) or isinstance(v, bool)
                       for k, v in rest.items())


def test_types_stay_and_new_fields_add_versions(spark, tmpdir_path):
    log = os.path.join(tmpdir_path, "log")
    one = texts(spark, [{"qty": 1, "s": "x"}, {"qty": "2"}, {"qty": 3.5, "Avg": 1}, {"avg": 2}])
    assert E.evolve(spark, log, E.fields_of(one), 0) == [("Avg", "number"), ("qty", "number"), ("s", "string")]
    two = texts(spark, [{"qty": "a", "s": 5, "new": [1]}, {"AVG": 4}])
    fields = E.evolve(spark, log, E.fields_of(two), 1)
    assert fields == [("Avg", "number"), ("qty", "number"), ("s", "string"), ("new", "array")]
    assert E.evolve(spark, log, E.fields_of(two), 1) == fields  # a replayed batch
    assert E.evolve(spark, log, E.fields_of(one), 2) == fields  # nothing new: no version
    assert sorted(tuple(r) for r in E.schema_versions(spark, log).collect()) == [
        (1, "Avg", "number"), (1, "qty", "number"), (1, "s", "string"), (2, "new", "array")]
    got = sorted(E.read_with_schema(two, fields, keep=["i"]).collect(), key=lambda r: r["i"])
    assert json.loads(got[0]["_rescued_data"]) == {"qty": "a", "s": 5} and got[0]["reading"]["new"] == "[1]"
    assert json.loads(got[1]["_rescued_data"]) == {"AVG": 4}


def test_fields_beyond_the_most_stay_rescued_and_odd_readings_whole(spark, tmpdir_path):
    rows = texts(spark, [{"a": 1, "b": 2}, {"a": 1, "c": 3}, "[1, 2]", "not json", "null"])
    fields = E.evolve(spark, os.path.join(tmpdir_path, "log"), E.fields_of(rows, max_fields=1), 0, 1)
    assert fields == [("a", "number")]
    got = [r["_rescued_data"] for r in sorted(E.read_with_schema(rows, fields, keep=["i"]).collect(), key=lambda r: r["i"])]
    assert got == ['{"b":2}', '{"c":3}', "[1, 2]", "not json", "null"]
    assert E.stored_fields(spark, os.path.join(tmpdir_path, "none")) == []


def test_stream_adds_versions_and_reads_as_one_table(spark, tmpdir_path):
    path = lambda n: os.path.join(tmpdir_path, n)

    def run(name, reading):
        doc = {"metrics": [{"name": "step_count", "units": "n", "data": [reading]}]}
        spark.createDataFrame([(json.dumps(doc), None, dt.datetime(2026, 7, 21), name, dt.datetime(2026, 7, 20))],
                              "data string, _rescued_data string, _ingested_at timestamp, _source_file string, file_modification_time timestamp"
                              ).write.mode("append").parquet(path("bronze"))
        ST.evolving_stream(spark, path("bronze"), path("t"), path("log"), path("ck"))

    run("a", {"date": "d1", "qty": 1})
    run("b", {"date": 7, "qty": 2, "unit": "kg"})
    rows = {r["source_file"]: r for r in ST.read_evolving(spark, path("t"), path("log")).collect()}
    assert rows["a"]["reading"].asDict() == {"date": "d1", "qty": 1.0, "unit": None} and rows["a"]["_rescued_data"] is None
    assert rows["b"]["reading"].asDict() == {"date": None, "qty": 2.0, "unit": "kg"} and rows["b"]["_rescued_data"] == '{"date":7}'
