"""The staged batch jobs: ingest, profile, explore, select features, train, publish.

Each job reads tables by path and writes tables below an output folder, so a job can be rerun
alone and no job holds results of another in memory.
"""

import argparse
import functools

from pyspark.sql import SparkSession, functions as F

from .. import schema as S
from ..ml import evaluation, modeling
from ..operators import cleaning, insights, joins, profiling, quality, selection, trips
from ..sources import audit, readers, writers
from . import benchmarks, publish


def ingest(spark, telemetry_csv, vehicles_csv, out):
    """Weekly CSV files and the vehicle sheets to Parquet, and the violations of their constraints.

    ``vehicles_csv`` is one path or several with commas between; sheets may lack columns.  Rows are
    loaded as they are; what a database would refuse is written to ``violations`` and returned.
    """
    writers.write_parquet(readers.read_telemetry_csv(spark, telemetry_csv), f"{out}/trips")
    sheets = []
    for path in vehicles_csv.split(",") if isinstance(vehicles_csv, str) else vehicles_csv:
        sheet = readers.read_csv(spark, path, sep=",")
        sheets.append(sheet if "eng_dis" in sheet.columns else cleaning.prepare_vehicles(sheet))
    writers.write_parquet(functools.reduce(cleaning.union_loose, sheets), f"{out}/vehicles")
    writers.write_parquet(violations(spark.read.parquet(f"{out}/trips"),
                                     spark.read.parquet(f"{out}/vehicles")), f"{out}/violations")
    return spark.read.parquet(f"{out}/violations")


def violations(telemetry, vehicles):
    """(constraint, name, n_rows): duplicate vehicles, missing values, unknown vehicles."""
    same = [c for c in S.MANDATORY_TELEMETRY if c in telemetry.columns]
    parts = [
        quality.duplicate_keys(vehicles, ["vehid"]).select(
            F.lit("primary_key").alias("constraint"), F.col("vehid").cast("string").alias("name"),
            "n_rows"),
        quality.null_violations(telemetry, same).where("null_rows > 0").select(
            F.lit("not_null"), "column_name", "null_rows"),
        quality.null_violations(vehicles, ["vehid"]).where("null_rows > 0").select(
            F.lit("not_null"), F.concat(F.lit("vehicles."), "column_name"), "null_rows"),
        quality.unknown_references(telemetry, vehicles).select(
            F.lit("foreign_key"), F.col("vehid").cast("string"), "n_rows"),
    ]
    return functools.reduce(lambda a, b: a.union(b), parts)


def ingest_database(spark, url, out, driver=None, lower=None, upper=None, partitions=4,
                    **extra) -> None:
    """Both base tables from a database; telemetry in parallel ranges of the vehicle id."""
    vehicles = readers.read_jdbc(spark, url, "vehicles", driver=driver, **extra)
    telemetry = readers.read_jdbc(spark, url, "trips", driver=driver, split_by="vehid",
                                  lower=lower, upper=upper, partitions=partitions, **extra)
    writers.write_parquet(vehicles, f"{out}/vehicles")
    writers.write_parquet(telemetry, f"{out}/trips")


def profile(spark, warehouse, out, names=("trips", "vehicles"), exact=False) -> None:
    """The six profile tables of the warehouse tables."""
    paths = {n: f"{warehouse}/{n}" for n in names}
    tables = {n: spark.read.parquet(p) for n, p in paths.items()}
    reports = {
        "table_overview": profiling.overview(tables, paths),
        "column_types": profiling.column_types(tables),
        "missingness": profiling.missing_values(tables),
        "numeric_summary": profiling.numeric_summary(tables),
        "numeric_quantiles": profiling.numeric_quantiles(tables, exact),
        "categorical_summary": profiling.categorical_summary(tables, exact),
    }
    for name, df in reports.items():
        writers.write_small_csv(df, f"{out}/{name}", sort=df.columns[:2])


def explore(spark, warehouse, out, csv_out=None, max_gap_s=S.MAX_GAP_S, tie=None) -> None:
    """Cleaned tables, report tables and the trip feature table."""
    raw = spark.read.parquet(f"{warehouse}/trips").withColumnsRenamed(
        {"long": "lon", "_long": "lon"})
    vehicles = cleaning.nan_to_null(spark.read.parquet(f"{warehouse}/vehicles"))
    vehicles = vehicles.withColumn("vehid", vehicles["vehid"].cast("string"))

    def csv(name):
        return f"{csv_out}/{name}" if csv_out else None

    writers.write_dual(vehicles, f"{out}/vehicles_raw", csv("vehicles_raw"))
    writers.write_parquet(cleaning.cast_ids(cleaning.nan_to_null(raw)), f"{out}/trips_raw")
    clean = spark.read.parquet(f"{out}/trips_raw")
    writers.write_parquet(joins.enriched_telemetry(clean, vehicles), f"{out}/trips_enriched")

    # Everything below reads the written tables instead of repeating the cleaning.
    samples = spark.read.parquet(f"{out}/trips_enriched")
    vehicles = spark.read.parquet(f"{out}/vehicles_raw")
    # Report name -> (table, order of its rows in the small CSV).
    reports = {
        "eda_data_characteristics": (insights.data_characteristics(
            samples, vehicles, len(raw.columns)), ["metric"]),
        "eda_missingness": (insights.missingness(samples), ["feature"]),
        "insight_01_vehicle_type_distribution": (
            insights.vehicle_type_distribution(samples, vehicles), ["vehicle_type"]),
        "insight_02_fuel_by_vehicle_type": (
            insights.fuel_by_vehicle_type(samples, vehicles), ["vehicle_type"]),
        "insight_03_fuel_by_speed_bin": (insights.fuel_by_speed_bin(samples), ["speed_bin_kmh"]),
        "insight_04_stop_go_vs_fuel": (insights.fuel_by_driving_mode(samples), ["driving_mode"]),
        "insight_05_temperature_hvac_fuel": (insights.temperature_hvac(samples), ["oat_bin_c"]),
        "insight_06_engine_displacement_fuel": (
            insights.displacement_fuel(samples, vehicles), ["eng_dis"]),
        "insight_07_geo_activity": (insights.geo_activity(samples), ["lat_bin", "long_bin"]),
    }
    for name, (df, order) in reports.items():
        writers.write_dual(df, f"{out}/{name}", csv(name), sort=order, small=True)
    if csv_out:
        fuel = insights.histogram(samples, insights.FUEL, 0.0, 25.0)
        writers.write_small_csv(fuel, csv("fuel_rate_histogram"), sort=["bin"])
        coverage = insights.coverage_after_estimate(samples)
        writers.write_small_csv(coverage, csv("coverage_after_estimate"), sort=["column_name"])

    features = trips.trip_features(samples, vehicles, tie=tie, max_gap_s=max_gap_s)
    writers.write_parquet(features, f"{out}/trip_features")
    if csv_out:
        longest = trips.longest_trips(spark.read.parquet(f"{out}/trip_features"))
        writers.write_small_csv(longest, csv("trip_features_sample"))


def select_features(spark, analytics, out, k=S.SELECT_K, bins=32, seed=S.SEED) -> None:
    """Selection report, train and test tables and their metadata."""
    rows_path = f"{out}/modelling_rows"
    writers.write_parquet(
        selection.modelling_rows(spark.read.parquet(f"{analytics}/trip_features")), rows_path)
    rows = spark.read.parquet(rows_path)
    writers.write_dual(selection.feature_selection(rows, k=k, bins=bins),
                       f"{out}/feature_selection", f"{out}/csv/feature_selection",
                       sort=["feature_type", "rank"], small=True)
    numeric, categorical = selection.selected_names(
        spark.read.parquet(f"{out}/feature_selection"))
    prepared = selection.prepare(rows, numeric, categorical)
    paths = {"train": f"{out}/train", "test": f"{out}/test"}
    for path, part in zip(paths.values(), selection.split_train_test(prepared, seed=seed)):
        writers.write_parquet(part, path)
    metadata = selection.split_metadata(
        *[spark.read.parquet(p) for p in paths.values()], *paths.values())
    writers.write_small_csv(metadata, f"{out}/csv/train_test_metadata")


def train(spark, prepared, out, specs=None, **options) -> dict:
    """Train all models; write models, predictions and report tables; return the reports."""
    parts = [spark.read.parquet(f"{prepared}/{part}") for part in ("train", "test")]
    results = modeling.train_all(specs or modeling.default_specs(), *parts,
                                 model_root=f"{out}/models", **options)
    for result in results:
        writers.write_csv(evaluation.prediction_report(result.predictions),
                          f"{out}/model{result.summary['model_index']}_predictions")
    best = modeling.best_result(results)
    name = best.summary["model"]
    predictions = evaluation.prediction_report(best.predictions)
    log = modeling.training_log(spark, results)
    metrics = evaluation.normalized_evaluation(modeling.evaluation_table(spark, results))
    numbered = functools.reduce(lambda a, b: a.unionByName(b), [
        evaluation.prediction_rows(r.predictions, r.summary["model"], order=[
            k for k in S.TRIP_KEYS if k in r.predictions.columns]) for r in results])
    reports = {
        "model_metrics_long": evaluation.unpivot_metrics(metrics),
        "best_model_by_rmse": evaluation.best_model(metrics),
        "model_prediction_rows": numbered,
        "table_counts": profiling.table_counts(dict(zip(("train", "test"), parts))),
        "model_evaluation": modeling.evaluation_table(spark, results),
        "model_training_log": log,
        "model_cv_results": modeling.cv_results(spark, results),
        "best_model": log.where(log["model"] == name),
        "specific_prediction": evaluation.specific_prediction(predictions, name),
        "model_prediction_samples": evaluation.prediction_samples(predictions),
    }
    for report, df in reports.items():
        writers.write_small_csv(df, f"{out}/{report}")
    return reports


def benchmark(spark, warehouse, analytics, out, models=None) -> dict:
    """The ingest, storage, processing and model benchmark reports."""
    telemetry = spark.read.parquet(f"{warehouse}/trips")
    vehicles = spark.read.parquet(f"{warehouse}/vehicles")
    features = spark.read.parquet(f"{analytics}/trip_features")
    reports = {
        "ingest_benchmark": benchmarks.bench_ingest(telemetry, f"{out}/ingest"),
        "storage_benchmark": benchmarks.bench_storage(features, f"{out}/storage"),
        "processing_benchmark": benchmarks.bench_processing(telemetry, vehicles, features),
        "ml_benchmark": modeling.feature_ablation(features, models),
    }
    for name, df in reports.items():
        writers.write_small_csv(df, f"{out}/{name}")
    return reports


def publish_all(spark, analytics, sources: dict, out):
    """Publish the report tables and every dashboard artifact found at its path."""
    artifacts = {name: readers.read_csv(spark, path) for name, path in sources.items()
                 if publish._exists(spark, path)}
    return (publish.publish_reports(spark, analytics)
            .unionByName(publish.publish_dashboard(spark, artifacts, out)))


def dashboard_sources(audit_path, profiles, prepared, models, bench) -> dict:
    """Where the jobs above leave each dashboard artifact."""
    places = {
        audit_path: ("data_audit",),
        profiles: ("table_overview", "column_types", "missingness", "numeric_summary",
                   "numeric_quantiles", "categorical_summary"),
        f"{prepared}/csv": ("feature_selection", "train_test_metadata"),
        models: ("model_evaluation", "model_training_log", "model_cv_results", "best_model",
                 "specific_prediction", "model_prediction_samples"),
        bench: ("ingest_benchmark", "storage_benchmark", "processing_benchmark"),
    }
    return {name: f"{place}/{name}" for place, held in places.items() for name in held}


def _parser():
    parser = argparse.ArgumentParser(prog="python -m tripspark.plans.jobs", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def add(name, *paths):
        job = jobs.add_parser(name)
        for path in paths:
            job.add_argument(path)
        return job
    add("ingest", "telemetry_csv", "vehicles_csv", "warehouse")
    add("audit", "root", "out").add_argument("--multiline", action="store_true")
    add("profile", "warehouse", "out")
    add("explore", "warehouse", "out").add_argument("--csv-out")
    add("select", "analytics", "out")
    add("train", "prepared", "out").add_argument("--preset", choices=["three", "two"],
                                                 default="three")
    add("benchmark", "warehouse", "analytics", "out")
    add("publish", "analytics", "audit", "profiles", "prepared", "models", "bench", "out")
    return parser


def main(argv=None) -> None:
    a = _parser().parse_args(argv)
    spark = (SparkSession.builder.appName("tripspark-" + a.job)
             # Hash the per-trip sketches instead of falling back to sorting at 128 groups.
             .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "100000")
             .getOrCreate())
    if a.job == "ingest":
        ingest(spark, a.telemetry_csv, a.vehicles_csv, a.warehouse).show(truncate=False)
    elif a.job == "audit":
        listing = audit.file_audit(spark, a.root, multiline=a.multiline)
        writers.write_small_csv(listing, f"{a.out}/data_audit")
    elif a.job == "profile":
        profile(spark, a.warehouse, a.out)
    elif a.job == "explore":
        explore(spark, a.warehouse, a.out, a.csv_out)
    elif a.job == "select":
        select_features(spark, a.analytics, a.out)
    elif a.job == "train":
        specs = modeling.two_model_specs() if a.preset == "two" else modeling.default_specs()
        train(spark, a.prepared, a.out, specs)
    elif a.job == "benchmark":
        benchmark(spark, a.warehouse, a.analytics, a.out)
    elif a.job == "publish":
        sources = dashboard_sources(a.audit, a.profiles, a.prepared, a.models, a.bench)
        publish_all(spark, a.analytics, sources, a.out).show(truncate=False)


if __name__ == "__main__":
    main()
