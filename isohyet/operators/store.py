"""Writing, auditing and maintaining stores of Parquet tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Numbers of the series kinds in data set names.
DSN_NUMBER = {"WIND": 11, "SOLR": 12, "PREC": 10, "PEVT": 13, "DEWP": 14, "CLOU": 15, "ATEM": 16, "NH4D": 17, "NH4W": 18, "NO3D": 19, "NO3W": 20}
ROLLUP_UNITS = {"H": "hour", "D": "day", "MS": "month", "A": "year"}
ROLLUPS = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min}


def save_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> None:
    """One directory per key; the rows of a key are gathered by AQE, not in one task."""
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).option("compression", "snappy").parquet(path)


def save_results(results: DataFrame, path: str, model: str) -> DataFrame:
    """Writes the rows without an error under model= and metzone=; returns the rows with one."""
    good = results.filter(F.col("error").isNull()).drop("error").withColumn("model", F.lit(model))
    save_partitioned(good, path, ["model", "metzone"])
    return results.filter(F.col("error").isNotNull())


def scratch(spark: SparkSession) -> str:
    """A new folder's path in the shared checkpoint folder, which the session names in spark.checkpoint.dir; a temporary one is set only on a local master."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="isohyet-checkpoint-"))
    return f"{sc.getCheckpointDir()}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder, so that a plan that goes on from them in several branches stays small."""
    scratch(df.sparkSession)
    return df.checkpoint(eager=True)


def read_partition(spark: SparkSession, path: str, **equal: object) -> DataFrame:
    df = spark.read.parquet(path)
    for name, value in equal.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def compact(spark: SparkSession, source: str, target: str, time: str = "time", rows_per_file: int = 2_000_000) -> None:
    """Many small files to few, ordered by time."""
    spark.read.option("mergeSchema", "true").parquet(source).repartitionByRange(F.col(time)).sortWithinPartitions(time).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(target)


def append_new(spark: SparkSession, batch: DataFrame, target: str, keys: list[str]) -> None:
    """Appends the rows of a batch whose keys the store lacks."""
    have = existing(spark, target)
    if have is not None:
        batch = batch.join(have.select(*keys).distinct(), keys, "left_anti")
    batch.write.mode("append").parquet(target)


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def update(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full join in which new values win and gaps keep the old ones."""
    values = [c for c in old.columns if c not in keys]
    joined = old.alias("o").join(new.alias("n"), keys, "full")
    return joined.select(*keys, *[F.coalesce(F.col(f"n.{v}"), F.col(f"o.{v}")).alias(v) for v in values])


def audit(df: DataFrame, unit: Column, least_steps: int = 24) -> DataFrame:
    """Units (files, days) with too few steps or with other cells than the unit that has the most (the last of these by name).

    Cell sets are equal if their sizes and two sums of 64-bit hashes are, which
    needs no list of cells.
    """
    cell = lambda k: F.xxhash64("lat_idx", "lon_idx", F.lit(k)).cast("decimal(38,0)")
    steps = df.groupBy(unit.alias("unit")).agg(F.count_distinct("time").alias("steps"))
    cells = df.select(unit.alias("unit"), "lat_idx", "lon_idx").distinct()
    shapes = cells.groupBy("unit").agg(F.count(F.lit(1)).cast("int").alias("cells"), F.sum(cell(0)).alias("_a"), F.sum(cell(1)).alias("_b"))
    seen = steps.join(shapes, "unit")
    best = seen.agg(F.max_by(F.struct("cells", "_a", "_b"), F.struct("cells", F.col("unit").cast("string"))).alias("best")).first()["best"]
    same = F.lit(True) if best is None else (F.col("cells") == best["cells"]) & (F.col("_a") == F.lit(best["_a"])) & (F.col("_b") == F.lit(best["_b"]))
    return seen.select("unit", "steps", "cells", ((F.col("steps") < least_steps) | ~same).alias("bad"))


def changed_by_day(spark: SparkSession, path: str) -> DataFrame:
    """Files below a path by the day of their last change: day, files (their number), paths (sorted)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.to_date("modificationTime").alias("day"))
    return files.groupBy("day").agg(F.count(F.lit(1)).alias("files"), F.array_sort(F.collect_list("path")).alias("paths"))


def file_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows of every Parquet file below a path; only footers and the metadata column are read."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path).select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))


def save_weights(weights: DataFrame, path: str, key: str) -> None:
    """A weight table, the cells of a polygon together."""
    weights.repartition(key).sortWithinPartitions(key, "lat_idx", "lon_idx").write.mode("overwrite").option("compression", "zstd").parquet(path)


# The read-through store -----------------------------------------------------------------------------


def lacking(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """The (date, variable) pairs of wanted that are not among those of have."""
    return wanted.join(have.select("date", "variable").distinct(), ["date", "variable"], "left_anti")


def missing_units(spark: SparkSession, manifest: str, wanted: DataFrame) -> DataFrame:
    """The (date, variable) pairs of wanted that a store's manifest lacks."""
    have = existing(spark, manifest)
    return wanted if have is None else lacking(wanted, have)


def read_through(spark: SparkSession, path: str, wanted: DataFrame, load: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of the wanted (date, variable) pairs; what the store lacks is loaded once and kept.

    The store holds tidy rows (date, variable, ...) in folders of a run and a date,
    and a manifest of the pairs that each run has loaded, so that a pair without
    rows is not loaded again.  ``load`` makes the rows of the missing pairs.  Rows
    count only once their run stands in the manifest, and of a pair that two runs
    have loaded the first by name counts: a run that dies leaves nothing that is
    read, and writers at the same time double nothing.
    """
    rows, manifest = f"{path}/rows", f"{path}/manifest"
    absent = cut(missing_units(spark, manifest, wanted.select("date", "variable").distinct()))
    if not absent.isEmpty():
        run = F.lit(uuid.uuid4().hex)
        loaded = load(absent).join(absent, ["date", "variable"], "left_semi")
        loaded.withColumn("run", run).write.mode("append").partitionBy("run", "date").parquet(rows)
        absent.withColumn("run", run).write.mode("append").parquet(manifest)
    have, told = existing(spark, rows), existing(spark, manifest)
    if have is None or told is None:
        return load(wanted.limit(0))
    chosen = told.join(wanted.select("date", "variable").distinct(), ["date", "variable"], "left_semi").groupBy("date", "variable").agg(F.min("run").alias("run"))
    typed = have.withColumns({"date": F.col("date").cast("date"), "run": F.col("run").cast("string")})
    return typed.join(chosen, ["date", "variable", "run"], "left_semi").drop("run")


def dsn(kind: Column, zone: Column) -> Column:
    """Data set number: the kind's number followed by the zone's."""
    table = F.create_map(*[F.lit(x) for pair in DSN_NUMBER.items() for x in pair])
    return F.concat(table[kind].cast("string"), F.coalesce(zone, F.lit(0)).cast("string")).cast("int")


def dsn_rows(zones: DataFrame, key: str, kinds: dict[str, str], time: str = "time") -> DataFrame:
    """dsn, time, value of zone series whose columns are of the named kinds (kind to column)."""
    long = zones.select(key, time, *[F.col(c).cast("double").alias(k) for k, c in kinds.items()]).unpivot([key, time], list(kinds), "kind", "value")
    return long.dropna(subset=["value"]).select(dsn(F.col("kind"), F.col(key)).alias("dsn"), time, "value")


def export_dsn(spark: SparkSession, rows: DataFrame, path: str, mode: str = "append") -> None:
    """Writes data sets by number: append leaves those alone that are there; update lets new values win.

    An update writes the merged data sets that it touches beside the table first,
    then puts their folders in the place of the old ones; other data sets are
    neither read nor written.  One writer at a time.
    """
    have = existing(spark, path)
    if mode not in ("append", "update"):
        raise ValueError("mode must be append or update")
    if have is None or mode == "append":
        new = rows if have is None else rows.join(have.select("dsn").distinct(), "dsn", "left_anti")
        save_partitioned(new, path, ["dsn"], "append")
        return
    touched = have.select("dsn", "time", "value").join(rows.select("dsn").distinct(), "dsn", "left_semi")
    merged = cut(update(touched, rows, ["dsn", "time"]))
    merged.hint("rebalance", "dsn").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dsn").option("compression", "snappy").parquet(path)


def dsn_summary(rows: DataFrame) -> DataFrame:
    """dsn, kind number, zone, first and last time and the number of values of each data set."""
    text = F.col("dsn").cast("string")
    made = rows.groupBy("dsn").agg(F.min("time").alias("first"), F.max("time").alias("last"), F.count(F.lit(1)).alias("n"))
    return made.withColumns({"kind": F.substring(text, 1, 2).cast("int"), "zone": F.substring(text, 3, 9).cast("int")})


def roll_up(df: DataFrame, keys: list[str], value: str, unit: str = "D", how: str = "sum", time: str = "time") -> DataFrame:
    if unit not in ROLLUP_UNITS or how not in ROLLUPS:
        raise ValueError(f"unit must be one of {', '.join(ROLLUP_UNITS)} and how one of {', '.join(ROLLUPS)}")
    return df.groupBy(*keys, F.date_trunc(ROLLUP_UNITS[unit], F.col(time)).cast("timestamp_ntz").alias(time)).agg(ROLLUPS[how](value).alias(value))
