from __future__ import annotations

import json
import os
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import plan, rows
from silverair.operators import quality
from silverair.schemas import DIM_URBANITY_SCORE, FACT_WEATHER
from silverair.session import scratch_path
from silverair.sinks import files, versions, warehouse
from silverair.sources import files as sources
from silverair.sources.tables import day_spine, optional_scan, run_sql, scan


def parquet_files(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_scratch_is_in_the_folder_of_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first.startswith(root) and first != second


def test_scratch_on_a_cluster_must_be_shared(monkeypatch, tmp_path):
    class Context:
        applicationId = "app-1"

        def __init__(self, master):
            self.master, self.folder = master, None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = f"file:{folder}/x"

    class Session:
        def __init__(self, master, folder=None):
            self.sparkContext = Context(master)
            self.conf = type("Conf", (), {"get": staticmethod(lambda name, default: folder)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session("spark://host:7077"), "a")
    assert scratch_path(Session("yarn", "hdfs:///shared/"), "a").startswith("hdfs:///shared/silverair/app-1/a-")
    monkeypatch.setattr("tempfile.mkdtemp", lambda prefix: str(tmp_path))
    assert scratch_path(Session("local[2]"), "a").startswith(f"file:{tmp_path}/x/silverair/app-1/a-")


def test_append_and_table_registration(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    files.append(df, path, table="appended")
    files.append(df, path, table="appended")
    assert scan(spark, "appended").count() == 6
    assert all(".snappy." in f for f in parquet_files(path))
    spark.sql("DROP TABLE appended")
    assert scan(spark, path, "id bigint").count() == 6


def test_optional_scan(spark, tmp_path):
    path = str(tmp_path / "none")
    assert optional_scan(spark, path, "id bigint") is None
    assert optional_scan(spark, "no_such_table") is None
    spark.range(2).write.parquet(path)
    assert optional_scan(spark, path, "id bigint").count() == 2
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        optional_scan(spark, str(broken), "id bigint").count()


def test_scan_prunes_and_pushes(spark, tmp_path):
    path = str(tmp_path / "w")
    FACT_WEATHER.empty(spark).write.parquet(path)
    df = scan(spark, path, FACT_WEATHER.ddl).filter("weather_code = 3").select("dw_unique_key")
    assert "ReadSchema: struct<dw_unique_key:string,weather_code:int>" in plan(df)
    assert "EqualTo(weather_code,3)" in plan(df)


def test_run_sql_leaves_no_view(spark):
    df = run_sql(spark, "SELECT a.id FROM {a} a JOIN {b} b ON a.id = b.id", {"a": spark.range(5), "b": spark.range(3, 9)})
    assert rows(df, "id") == [(3,), (4,)]
    assert spark.catalog.listTables() == []


def test_day_spine_includes_both_ends(spark):
    days = day_spine(spark.range(1), F.lit("2020-01-01").cast("date"), F.lit("2030-12-31").cast("date"))
    assert days.count() == 4018
    assert days.agg(F.min("full_date").cast("string"), F.max("full_date").cast("string")).first() == ("2020-01-01", "2030-12-31")


def test_latest_file(spark, tmp_path):
    for name, at in (("b", 100), ("a", 300), ("c", 300), ("d", 200)):
        path = tmp_path / "in" / name
        spark.createDataFrame([(name,)], "v string").coalesce(1).write.parquet(str(path))
        os.utime(parquet_files(path)[0], (at, at))
    (tmp_path / "in" / "new.txt").write_text("newer, but no parquet")
    prefix = str(tmp_path / "in")
    assert rows(sources.read_latest(spark, prefix, "v string")) == [("a",)]
    os.utime(parquet_files(tmp_path / "in" / "d")[0], (301, 301))
    assert rows(sources.read_latest(spark, prefix, "v string")) == [("d",)]
    with pytest.raises(FileNotFoundError):
        sources.latest_file(spark, prefix, "*.orc")


def test_with_ordinal_follows_files_and_rows(spark, tmp_path):
    spark.range(100).repartition(5).orderBy(F.desc("id")).write.parquet(str(tmp_path / "o"))
    df = sources.with_ordinal(spark.read.schema("id bigint").parquet(str(tmp_path / "o")))
    assert [r[0] for r in rows(df, "file_ordinal", "row_ordinal")] == list(range(99, -1, -1))


def test_read_results_stamps_every_row(spark, tmp_path):
    answers = [
        {"sensor": 7, "results": [{"value": 1.5}, {"value": 2.5}], "url": "u1", "called_at": "t1"},
        {"sensor": 8, "results": [], "url": "u2", "called_at": "t2"},
        {"sensor": 9, "url": "u3"},
        {"sensor": 10, "results": [{"value": 4.0}]},
    ]
    (tmp_path / "r.json").write_text("\n".join(map(json.dumps, answers)) + "\n{broken\n")
    got = rows(sources.read_results(spark, str(tmp_path / "r.json"), "struct<value: double>", "sensor int"), "value")
    assert got[:2] == [(7, 1.5, "u1", "t1"), (7, 2.5, "u1", "t1")]
    assert got[2][:2] == (10, 4.0) and got[2][2].endswith("r.json") and got[2][3].startswith("20")


def test_replace_partitions(spark, tmp_path):
    path = str(tmp_path / "days")
    schema = "v int, record_date string"

    def write(data):
        df = files.with_month_partition(spark.createDataFrame(data, schema), "record_date")
        files.replace_partitions(df, path, ["year", "month", "record_date"])

    write([(1, "2026-01-29"), (2, "2026-01-30"), (3, "30.01.2026")])
    write([(5, "2026-01-30"), (6, "2026-02-01")])
    stored = spark.read.schema(f"{schema}, year string, month string").parquet(path)
    assert rows(stored.select("v", "year", "month", "record_date"), "v") == [
        (1, "2026", "01", "2026-01-29"),
        (3, "unknown_year", "unknown_month", "30.01.2026"),
        (5, "2026", "01", "2026-01-30"),
        (6, "2026", "02", "2026-02-01"),
    ]


def test_land_skips_empty_frames(spark, tmp_path):
    run_at = F.lit("2026-04-05 01:02:03").cast("timestamp")
    at = datetime(2026, 4, 5, 6, 7, 8, 123456)
    df = spark.createDataFrame([(1, at)], "a int, at timestamp")
    for kind in ("json", "parquet"):
        path = str(tmp_path / kind)
        assert files.land(df.filter("a > 1"), path, run_at, kind) == 0
        assert [f for f in os.listdir(path) if not f.startswith((".", "_"))] == []
        assert [files.land(df, path, run_at, kind) for _ in range(2)] == [1, 1]
        assert os.listdir(f"{path}/year=2026/month=04/day=05")
        stored = scan(spark, path, "a int, at timestamp, year string, month string, day string", kind)
        assert rows(stored) == [(1, at, "2026", "04", "05")] * 2


def test_refresh_publishes_whole_versions(spark, tmp_path):
    root = str(tmp_path / "fact")
    assert versions.current(spark, root) is None
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, root, "id bigint")
    first = versions.refresh(spark.range(3), root, now=datetime(2026, 1, 1, tzinfo=UTC))
    # Reading the published version and replacing it in one plan is safe.
    doubled = versions.read_current(spark, root, "id bigint").select((F.col("id") * 2).alias("id"))
    second = versions.refresh(doubled, root, {"window": "all"}, [F.max("id").alias("top")])
    assert (first["rows"], second["rows"], second["top"]) == (3, 3, 4)
    assert rows(versions.read_current(spark, root, "id bigint"), "id") == [(0,), (2,), (4,)]
    assert rows(versions.manifest(spark, root).select("rows", "details"), "details") == [(3, '{"window": "all"}'), (3, "{}")]

    def reject(_):
        raise quality.QualityError("bad")

    with pytest.raises(quality.QualityError):
        versions.refresh(spark.range(9), root, validate=reject)
    assert versions.current(spark, root)["version"] == second["version"]
    old_files = len(parquet_files(first["path"]))
    assert versions.retain(spark, root, 1) == 0 and versions.retain(spark, root, 2, timedelta(0)) == 0
    opened = spark.read.parquet(first["path"])
    assert opened.count() == 3
    assert old_files and versions.retain(spark, root, 1, timedelta(0)) == old_files
    assert not os.path.exists(first["path"]) and versions.retain(spark, root, 1, timedelta(0)) == 0
    assert versions.manifest(spark, root).count() == 1
    assert versions.read_current(spark, root, "id bigint").count() == 3


def test_refresh_with_no_rows(spark, tmp_path):
    root = str(tmp_path / "empty")
    assert versions.refresh(DIM_URBANITY_SCORE.empty(spark), root)["rows"] == 0
    assert versions.read_current(spark, root, DIM_URBANITY_SCORE.ddl).count() == 0


def test_balanced_splits_a_hot_partition(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(200_000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("day"), F.rand(1).alias("v"))
        files.append(df, str(tmp_path / "t"), ["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(parquet_files(tmp_path / "t" / "day=hot")) > 3
    assert scan(spark, str(tmp_path / "t"), "v double, day string").count() == 200_000


class RecordingWriter:
    """Stands in for a DataFrameWriter; no database is started for a test."""

    def __init__(self):
        self.settings, self.how, self.saved = {}, None, False

    def format(self, name):
        return self.option("format", name)

    def option(self, name, value):
        self.settings[name] = value
        return self

    def options(self, **given):
        self.settings.update(given)
        return self

    def mode(self, how):
        self.how = how
        return self

    def save(self):
        self.saved = True


@pytest.mark.parametrize(("write", "mode", "truncate"), [(warehouse.append, "append", None), (warehouse.replace, "overwrite", "true")])
def test_warehouse_writer(spark, monkeypatch, write, mode, truncate):
    recorded, frames = RecordingWriter(), []
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.write", property(lambda df: frames.append(df) or recorded))
    ints = FACT_WEATHER.empty(spark).withColumns({"date_id": F.lit(20260101), "sys_source_id": F.lit(7)})
    write(ints.select(*reversed(ints.columns)), FACT_WEATHER, {"url": "jdbc:x", "user": "me", "password": "secret"})
    assert recorded.saved and recorded.how == mode and recorded.settings.get("truncate") == truncate
    assert recorded.settings["dbtable"] == "fact_weather" and recorded.settings["format"] == "jdbc"
    assert recorded.settings["user"] == "me" and int(recorded.settings["numPartitions"]) == warehouse.CONNECTIONS
    # Columns leave in the order and with the types of the declared table.
    assert frames[-1].dtypes == [(n, k) for n, (k, _) in FACT_WEATHER.columns.items()]


def test_conform_refuses_missing_columns(spark):
    with pytest.raises(AnalysisException):
        FACT_WEATHER.conform(spark.range(1))
