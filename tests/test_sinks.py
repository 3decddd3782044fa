"""Alert sinks: one row per id, whoever writes it and however often."""
import glob
import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from framewatch.sources import sinks

SCHEMA = "incident_id string, camera_id string, reasons array<struct<type:string,message:string>>"
ODD = ("a/b=c", "", "id \n1", "é%2F", "007")


@pytest.fixture
def alerts(spark):
    def make(ids, camera="camera_1"):
        return spark.createDataFrame([(i, camera, [("drift", f"of {i}")]) for i in ids], SCHEMA)
    return make


def _read(spark, path, df):
    return sorted(sinks.read_alerts(spark, path, df.schema, "incident_id").collect(), key=str)


def _files(path):
    return glob.glob(os.path.join(path, "id_bucket=*", "id_key=*", "**", "part-*"), recursive=True)


def test_two_writers_at_once_leave_one_row_per_id(spark, alerts, tmp_path):
    path = str(tmp_path / "incidents")
    same, other = alerts(f"i{k}" for k in range(12)), alerts(f"j{k}" for k in range(12))
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda df: sinks.write_incidents(df, path), [same, same, other]))
    assert _read(spark, path, same) == sorted(same.unionByName(other).collect(), key=str)


def test_replays_replace_and_later_writers_add(spark, alerts, tmp_path):
    path = str(tmp_path / "incidents")
    first = alerts(["a", "b"])
    for _ in range(3):
        sinks.write_incidents(first, path)
    assert len(_files(path)) == 2                       # a replay leaves the table as it was
    sinks.write_incidents(alerts(["b", "c"], camera="camera_2"), path)
    got = _read(spark, path, first)
    assert [(r["incident_id"], r["camera_id"]) for r in sorted(got)] == [("a", "camera_1"), ("b", "camera_2"), ("c", "camera_2")]
    assert got == sorted(spark.read.schema(first.schema).json(path).select(*first.columns).collect(), key=str)


def test_a_write_reads_nothing_of_the_table(spark, alerts, tmp_path):
    path = str(tmp_path / "incidents")
    sinks.write_incidents(alerts(["a"]), path)
    for f in _files(path):
        open(f, "w").write("not json at all")
    crc = glob.glob(os.path.join(path, "**", ".*.crc"), recursive=True)
    assert crc                                          # a read of the broken file would fail
    sinks.write_incidents(alerts(["b"]), path)
    assert len(_files(path)) == 2


def test_odd_missing_and_repeated_ids(spark, alerts, tmp_path):
    path = str(tmp_path / "incidents")
    rows = alerts([*ODD, None])
    twice = rows.unionByName(rows).unionByName(alerts([ODD[0]], camera="camera_0"))
    sinks.write_incidents(twice, path)
    sinks.write_incidents(twice, path)
    got = _read(spark, path, rows)
    assert sorted(str(r["incident_id"]) for r in got) == sorted(map(str, [*ODD, None]))
    assert {r["camera_id"] for r in got if r["incident_id"] == ODD[0]} == {"camera_0"}  # the first by its text


def test_an_empty_write_leaves_the_table(spark, alerts, tmp_path):
    path = str(tmp_path / "incidents")
    rows = alerts(["a"])
    sinks.write_incidents(rows, path)
    sinks.write_incidents(rows.limit(0), path)
    assert _read(spark, path, rows) == rows.collect()
