"""Readers, writers, audit, publishing and the staged jobs."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tripspark import schema as S
from tripspark.ml import modeling
from tripspark.plans import benchmarks, jobs, proxy, publish
from tripspark.sources import audit, readers, shared, writers


def test_telemetry_csv_missing_markers(spark, tmp_path):
    header = ",".join(S.RAW_TELEMETRY_HEADERS)
    values = ["1.5", "10", "3", "1000", "42.1", "-83.2", "null", "NaN"] + ["null"] * 14
    (tmp_path / "week1.csv").write_text(header + "\n" + ",".join(values) + "\n")
    row = readers.read_telemetry_csv(spark, str(tmp_path / "*.csv")).first()
    assert row["vehid"] == "10" and row["speed"] is None and row["maf"] != row["maf"]


def test_jdbc_options():
    options = readers.jdbc_options("jdbc:x", "trips", split_by="vehid", lower=1, upper=600,
                                   partitions=4)
    assert options["partitionColumn"] == "vehid" and options["numPartitions"] == "4"
    assert "partitionColumn" not in readers.jdbc_options("jdbc:x", "vehicles")
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "trips", split_by="vehid")


def test_file_audit(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text('x,"y, z",w\n1,2,3\n4,5,6\n')
    (tmp_path / "sub" / "B.CSV").write_text("x\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "note.txt").write_text("hello")
    rows = {r["file_name"]: r for r in audit.file_audit(spark, str(tmp_path)).collect()}
    assert (rows["a.csv"]["rows"], rows["a.csv"]["columns"]) == (2, 3)
    assert (rows["B.CSV"]["rows"], rows["B.CSV"]["columns"]) == (0, 1)
    assert (rows["empty.csv"]["rows"], rows["empty.csv"]["columns"]) == (0, 0)
    assert rows["note.txt"]["rows"] is None and rows["note.txt"]["extension"] == ".txt"
    assert rows[audit.TOTAL]["rows"] == 2
    assert audit.path_size(spark, str(tmp_path)).first()["size_bytes"] == sum(
        os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(tmp_path) for f in fs)


def test_small_csv_is_one_sorted_file(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_small_csv(spark.range(100).orderBy(F.desc("id")), path, sort=["id"])
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(path, parts[0])) as file:
        assert file.read().split() == ["id", *map(str, range(100))]


def test_declared_columns_are_bound_by_position(spark):
    df = spark.createDataFrame([("t", "c", "int")], "a string, b string, c string")
    assert publish.as_declared(df, publish.DASHBOARD_COLUMNS["column_types"]).columns == [
        "table_name", "column_name", "data_type"]
    with pytest.raises(ValueError):
        publish.as_declared(df, publish.DASHBOARD_COLUMNS["table_overview"])


def test_publishing_skips_missing_artifacts(spark, tmp_path):
    df = spark.createDataFrame([("t", "c", "int")], "a string, b string, c string")
    report = publish.publish_dashboard(spark, {"column_types": df}, str(tmp_path), prefix="p_")
    status = {r["table_name"]: r["status"] for r in report.collect()}
    assert len(status) == 18 and status["p_stage4_column_types"] == "published"
    assert list(status.values()).count("missing") == 17
    assert spark.table("p_stage4_column_types").first()["data_type"] == "int"


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_all_jobs_in_order(spark, sf, tmp_path):
    """CSV files in, published dashboard tables out."""
    root = str(tmp_path)
    proxy.raw_telemetry(spark, sf).drop("sample_id").toDF(*S.RAW_TELEMETRY_HEADERS).write.option(
        "header", True).option("nullValue", "null").csv(f"{root}/raw/trips")
    proxy.raw_vehicles(spark, sf).write.option("header", True).csv(f"{root}/raw/vehicles")
    jobs.ingest(spark, f"{root}/raw/trips", f"{root}/raw/vehicles", f"{root}/warehouse")
    writers.write_small_csv(audit.file_audit(spark, f"{root}/raw"), f"{root}/audit/data_audit")
    jobs.profile(spark, f"{root}/warehouse", f"{root}/profiles")
    jobs.explore(spark, f"{root}/warehouse", f"{root}/analytics", f"{root}/csv",
                 max_gap_s=proxy.MAX_GAP_S)
    jobs.select_features(spark, f"{root}/analytics", f"{root}/prepared")
    small = {"LinearRegression": {"regParam": [0.1]}, "GBTRegressor": {"maxDepth": [2]},
             "RandomForestRegressor": {"numTrees": [3]}}
    specs = modeling.default_specs(small)
    specs[2].model.setMaxIter(2)
    jobs.train(spark, f"{root}/prepared", f"{root}/models", specs, folds=2)
    jobs.benchmark(spark, f"{root}/warehouse", f"{root}/analytics", f"{root}/bench",
                   {"LinearRegression": specs[0].model})
    ablation = readers.read_csv(spark, f"{root}/bench/ml_benchmark").collect()
    assert {r["feature_set"] for r in ablation} == {"all_features", "selected_features"}
    sources = jobs.dashboard_sources(f"{root}/audit", f"{root}/profiles", f"{root}/prepared",
                                     f"{root}/models", f"{root}/bench")
    report = jobs.publish_all(spark, f"{root}/analytics", sources, f"{root}/dashboard").collect()
    assert {r["status"] for r in report} == {"published"} and len(report) == 28
    for r in report:
        assert spark.table(r["table_name"]).count() > 0, r["table_name"]
    features = spark.table("stage2_trip_features")
    assert features.columns == S.TRIP_FEATURE_SCHEMA.names
    assert spark.table("stage4_best_model").count() == 1
    assert spark.table("stage4_data_audit").where("file_path = '__TOTAL__'").count() == 1
    for name in spark.catalog.listTables():
        spark.sql(f"DROP TABLE IF EXISTS {name.name}")


def test_storage_variants(spark, sf, tmp_path):
    out = benchmarks.bench_storage(proxy.table(spark, sf, "orders"), str(tmp_path),
                                   [("parquet", "snappy"), ("csv", "gzip"), ("avro", "snappy")])
    rows = out.collect()
    assert {r["format"] for r in rows} >= {"parquet", "csv"}
    assert all(r["read_rows"] == r["source_rows"] and r["hdfs_size_mb"] > 0 for r in rows)


def test_sizes_and_records_of_awkward_files(spark, tmp_path):
    from tripspark.sources import audit
    (tmp_path / "a b+c").mkdir()
    (tmp_path / "a b+c" / "t 1.csv").write_text('a,"b,c"\n1,"x\ny"\n2,z\n')
    (tmp_path / "plain%20.csv").write_text("a\n1\n")
    (tmp_path / "empty.csv").write_text("")
    assert audit.path_size(spark, str(tmp_path)).first()["size_bytes"] == 20 + 4
    found = {r["file_name"]: r for r in audit.file_audit(
        spark, str(tmp_path), multiline=True).collect()}
    assert set(found) == {"t 1.csv", "plain%20.csv", "empty.csv", audit.TOTAL}
    assert (found["t 1.csv"]["rows"], found["t 1.csv"]["columns"]) == (2, 2)
    assert (found["plain%20.csv"]["rows"], found["empty.csv"]["rows"]) == (1, 0)
    by_line = audit.file_audit(spark, str(tmp_path)).where("file_name = 't 1.csv'").first()
    assert by_line["rows"] == 3


def test_ingest_reports_violations(spark, tmp_path):
    from tripspark import schema as S
    from tripspark.plans import jobs
    names = S.TELEMETRY_SCHEMA.names
    header = ",".join(S.RAW_TELEMETRY_HEADERS)
    row = dict.fromkeys(names, "1")
    lines = [header] + [",".join({**row, **change}.values()) for change in (
        {}, {"vehid": "9"}, {"vehid": "9"}, {"time": "null"})]
    (tmp_path / "week.csv").write_text("\n".join(lines) + "\n")
    sheet = "vehid,vehtype,eng_dis\n1,ICE,2.0\n"
    (tmp_path / "one.csv").write_text(sheet)
    (tmp_path / "two.csv").write_text("vehid,vehclass,eng_dis\n1,Car,1.0\n2,Car,1.0\n")
    found = jobs.ingest(spark, str(tmp_path / "week.csv"),
                        f"{tmp_path}/one.csv,{tmp_path}/two.csv", str(tmp_path / "out"))
    assert sorted(map(tuple, found.collect())) == [
        ("foreign_key", "9", 2), ("not_null", "time", 1), ("primary_key", "1", 2)]
    vehicles = spark.read.parquet(f"{tmp_path}/out/vehicles")
    assert vehicles.count() == 3 and {"vehtype", "vehclass"} <= set(vehicles.columns)


def test_tables_are_written_without_a_checkpoint_setting(tmp_path):
    """A session whose configuration names no folder falls back to a temporary one, once."""
    code = ("from pyspark.sql import SparkSession\n"
            "from tripspark.sources.shared import materialise, shared_dir\n"
            "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
            ".getOrCreate()\n"
            "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
            "assert materialise(spark.range(3)).count() == 3\n"
            "assert shared_dir(spark) == shared_dir(spark)\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path), "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
