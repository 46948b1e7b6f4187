"""Numbered forecast runs: one Parquet table, one partition folder per run.

Beside the run folders lie small files that keep readers and writers apart and cheap: ``_claims`` says which job owns which
number, ``_index/schema`` holds the union of all runs' columns in versions, and ``_index/dates`` the dates of each run, from which
the winning run of each date is found without reading forecasts.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.runs import next_run_id, run_summary, winners
from shelfcast.sources import files

RUN_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("age_sales_category", T.StringType()),
    T.StructField("age_category", T.StringType()),
    T.StructField("sales_category", T.StringType()),
    T.StructField("style", T.StringType()),
    T.StructField("forecast_method", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("forecast", T.DoubleType()),
    T.StructField("run_id", T.IntegerType()),
])

FILE_COLUMNS = {"files": "bigint", "bytes": "bigint", "last_modified": "timestamp"}


class RunOwned(RuntimeError):
    """Another job owns the run number."""


def _claim_path(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/_claims/run-{number}"


def new_owner() -> str:
    """A token for a job.  A job that may be resubmitted passes one of its own, so that its second attempt owns its run."""
    return uuid.uuid4().hex


def claim_run_id(spark: SparkSession, path: str, owner: str | None = None) -> int:
    """A number for a new run that no other job has or will get.

    The claim is a file that holds the owner's token, and the file system lets one job alone create it.  An owner that has
    claimed a number already, in an attempt before this one, gets that number again.
    """
    claimed = [name.removeprefix("run-") for name in files.names(spark, f"{path.rstrip('/')}/_claims")] if owner else []
    for number in sorted((int(name) for name in claimed if name.isdigit()), reverse=True):
        if owner_of(spark, path, number) == owner:
            return number
    owner = owner or new_owner()
    number = stored_next_run_id(spark, path)
    while not files.create_once(spark, _claim_path(path, number), owner):
        number += 1
    return number


def owner_of(spark: SparkSession, path: str, run_id: int) -> str | None:
    """The token that owns a run number, or None if nobody does."""
    return files.read_text(spark, _claim_path(path, run_id))


def _own(spark: SparkSession, path: str, run_id: int, owner: str) -> None:
    if files.create_once(spark, _claim_path(path, run_id), owner) or owner_of(spark, path, run_id) == owner:
        return
    raise RunOwned(f"run {run_id} of {path} belongs to another job")


def write_run(forecast: DataFrame, path: str, run_id: int, owner: str) -> None:
    """Store one run next to the others.  Runs a job.

    Only the owner of the number may write it; a number that nobody has claimed is claimed first.  Only this
    run's own folder is replaced, so a resubmitted job leaves the same table and never a second copy of its rows.  The run's
    dates are written last, so ``latest_runs`` sees the whole run or nothing of it.
    """
    spark = forecast.sparkSession
    _own(spark, path, run_id, owner)
    _log_schema(spark, path, forecast.schema)
    (forecast.withColumn("run_id", F.lit(run_id).cast("int"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(path))
    _write_dates(spark, path, [run_id])


# The union of the runs' columns

def _schema_folder(path: str) -> str:
    return f"{path.rstrip('/')}/_index/schema"


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Columns of all runs, from the newest version alone; None where no run was written through ``write_run``."""
    numbers = files.versions(spark, _schema_folder(path))
    if not numbers:
        return None
    return T.StructType.fromJson(json.loads(files.read_text(spark, files.version_path(_schema_folder(path), numbers[-1]))))


def _log_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Add a run's columns to the union.  Runs of known columns add no version."""
    folder, fields = _schema_folder(path), [f for f in schema if f.name != "run_id"]
    while True:
        numbers = files.versions(spark, folder)
        number = numbers[-1] if numbers else 0
        known = stored_schema(spark, path) if numbers else T.StructType([])
        types = {f.name: f.dataType for f in known}
        for f in fields:
            if f.name in types and types[f.name] != f.dataType:
                raise ValueError(f"column {f.name} is {f.dataType.simpleString()} here and "
                                 f"{types[f.name].simpleString()} in earlier runs of {path}")
        fresh = [T.StructField(f.name, f.dataType) for f in fields if f.name not in types]
        if not fresh:
            return
        union = T.StructType([*known, *fresh])
        if files.create_once(spark, files.version_path(folder, number + 1), union.json()):
            return


# Dates of each run

def _dates_path(path: str) -> str:
    return f"{path.rstrip('/')}/_index/dates"


def _write_dates(spark: SparkSession, path: str, run_ids: list[int]) -> None:
    """The dates of some runs, from the date column of their files."""
    stored = sorted(_numbers(spark, path) & set(run_ids))
    if not stored:  # a run without rows has no folder
        return
    runs = spark.read.schema("date date, run_id int").option("basePath", path).parquet(
        *[f"{path.rstrip('/')}/run_id={number}" for number in stored])
    (runs.select("date", "run_id").distinct().repartition("run_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(_dates_path(path)))


def _numbers(spark: SparkSession, path: str) -> set[int]:
    found = (name.removeprefix("run_id=") for name in files.names(spark, path) if name.startswith("run_id="))
    return {int(number) for number in found if number.isdigit()}


def index_runs(spark: SparkSession, path: str) -> None:
    """Write what ``write_run`` keeps beside the runs for runs that were stored without it."""
    missing = sorted(_numbers(spark, path) - _numbers(spark, _dates_path(path)))
    if missing:
        _log_schema(spark, path, spark.read.options(mergeSchema="true", basePath=path).parquet(
            *[f"{path.rstrip('/')}/run_id={number}" for number in missing]).schema)
        _write_dates(spark, path, missing)


def latest_runs(spark: SparkSession, path: str) -> DataFrame:
    """For each date, the rows of the highest-numbered run that has that date; see ``operators.runs.latest_run_per_date``.

    The winning (date, run) pairs come from the runs' dates.  They are broadcast, one row for each calendar date, and prune
    the forecast table's partitions when it is scanned: a run that wins no date is not read.
    """
    index_runs(spark, path)
    dates = _open(spark, _dates_path(path), T.StructType.fromDDL("date date, run_id int"))
    if dates is None:
        return _no_runs(spark)
    # Spark prunes by a table only if that table is filtered; run numbers start at 1.
    return read_runs(spark, path).join(F.broadcast(winners(dates.where("run_id > 0"))), ["date", "run_id"], "left_semi")


# Reading

def _open(spark: SparkSession, path: str, schema: T.StructType | None = None,
          **options: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if nothing was stored there yet."""
    reader = spark.read.options(**options)
    try:
        return (reader.schema(schema) if schema else reader).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _no_runs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RUN_SCHEMA)


def read_runs(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Every stored run.  Columns are matched by name; a column a run lacks is null.

    The columns are those of the store's schema log, so no file is opened to find them.  Without a log, in a store that was not
    written through ``write_run``, they are collected from the footers of all files, by a job on the executors.
    """
    logged = schema or stored_schema(spark, path)
    if logged is not None and "run_id" not in logged.names:
        logged = T.StructType([*logged, T.StructField("run_id", T.IntegerType())])
    runs = _open(spark, path, logged) if logged else _open(spark, path, mergeSchema="true")
    # A schema log is written before the first run is.
    return _no_runs(spark) if runs is None or not _numbers(spark, path) else runs


def read_run(spark: SparkSession, path: str, run_id: int) -> DataFrame:
    """One run, empty if it was never stored.  Only its folder is listed and read."""
    run = _open(spark, f"{path.rstrip('/')}/run_id={run_id}", basePath=path)
    return _no_runs(spark) if run is None else run


def list_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row per run, ascending: rows, date span, files, bytes and last change."""
    runs = _open(spark, path, RUN_SCHEMA)
    if runs is None:
        return run_summary(_no_runs(spark)).select("*", *[
            F.lit(None).cast(kind).alias(name) for name, kind in FILE_COLUMNS.items()])
    # A first pass per file keeps each file's size from being counted once per row.
    per_file = runs.select(
        "run_id", "date", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified")
    ).groupBy("run_id", "file").agg(
        F.count(F.lit(1)).alias("rows"), F.min("date").alias("first"), F.max("date").alias("last"),
        F.max("size").alias("size"), F.max("modified").alias("modified"))
    return per_file.groupBy("run_id").agg(
        F.sum("rows").alias("forecast_rows"), F.min("first").alias("first_date"),
        F.max("last").alias("last_date"), F.count(F.lit(1)).alias("files"),
        F.sum("size").alias("bytes"), F.max("modified").alias("last_modified")).orderBy("run_id")


def stored_next_run_id(spark: SparkSession, path: str) -> int:
    """The number the next run should take.  Runs a job that reads run folders, not columns."""
    if not _numbers(spark, path):
        return 1
    return next_run_id(_open(spark, path, RUN_SCHEMA)).first()["next_run_id"]
