"""Resampling, label alignment, spines and audits of time series.

Periods are left-closed and left-labelled.  ``asof`` aligns by labels: the row
with the greatest label at or before a time wins even if its value is missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isohyet.functions.cols import ratio

DAY = "INTERVAL '1' DAY"


def hours(n: Column | int) -> Column:
    return F.make_dt_interval(F.lit(0), n if isinstance(n, Column) else F.lit(n))


def period_start(time: Column, unit: str = "day", offset_hours: int = 0) -> Column:
    """Label of the period that holds a time; date_trunc forgets NTZ, so it is cast back."""
    moved = time - hours(offset_hours) if offset_hours else time
    label = F.date_trunc(unit, moved).cast("timestamp_ntz")
    return label + hours(offset_hours) if offset_hours else label


def epoch_seconds(time: Column | str) -> Column:
    """Whole seconds since 1970 of a time without a zone, whatever zone the session has (clocks that jump would move a cast)."""
    at = F.col(time) if isinstance(time, str) else time
    return F.unix_date(F.to_date(at)).cast("long") * 86_400 + F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)


#: Steps that one row explodes to.
STEPS = 10_000


def spine(df: DataFrame, keys: list[str], time: str = "time", step: str = "INTERVAL '1' HOUR", until: str | None = None) -> DataFrame:
    """Every step from the least to the greatest time of all rows, for each key; runs of steps are dealt out before they are made.

    The first time travels as text and the length as an interval, so neither the
    driver's nor the session's time zone can move it.
    """
    first, last = F.min(F.col(time).cast("timestamp_ntz")), F.max(F.col(until or time).cast("timestamp_ntz"))
    ends = df.agg(first.cast("string").alias("a"), (last - first).alias("long")).first()
    named = df.select(*keys).distinct() if keys else df.sparkSession.range(1).drop("id")
    if ends["a"] is None:
        return named.withColumn(time, F.lit(None).cast("timestamp_ntz")).limit(0)
    seconds = df.sparkSession.sql(f"SELECT unix_seconds(TIMESTAMP'1970-01-01 00:00:00+00:00' + {step}) AS s").first()["s"]
    whole = int(ends["long"].total_seconds()) // seconds
    second = lambda n: F.lit(ends["a"]).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))
    runs = named.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(whole // STEPS).cast("long"))))
    if whole >= STEPS:
        runs = runs.repartition(*keys, "_run")
    steps = runs.withColumn("_n", F.explode(F.sequence(F.col("_run") * STEPS, F.least(F.col("_run") * STEPS + (STEPS - 1), F.lit(whole).cast("long")))))
    return steps.select(*keys, second(F.col("_n") * seconds).alias(time))


def resample(df: DataFrame, keys: list[str], aggregates: list[Column], unit: str = "day", offset_hours: int = 0, time: str = "time") -> DataFrame:
    return df.groupBy(*keys, period_start(F.col(time), unit, offset_hours).alias(time)).agg(*aggregates)


def complete(df: DataFrame, keys: list[str], fill: dict[str, float], time: str = "time", step: str | None = "INTERVAL '1' HOUR") -> DataFrame:
    """Adds the missing steps; the columns in fill get that value there.

    Without a step it is that of all times together, which keys may lack but which
    must be regular: irregular times are an error.
    """
    step = step or f"INTERVAL '{infer_step_seconds(df, time)}' SECOND"
    full = spine(df, keys, time, step).join(df, [*keys, time], "left")
    return full.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


#: Days of a bucket of the as-of joins.
BUCKET_DAYS = 32


def _bucket(time: Column) -> Column:
    return F.floor(epoch_seconds(time) / (86_400 * BUCKET_DAYS))


def _both(fine: DataFrame, coarse: DataFrame, keys: list[str], values: list[str], time: str) -> tuple[DataFrame, DataFrame]:
    """The union of both sides by time bucket, with _told (label and values) in the coarse rows; and, by key and bucket, the labels _carry before and _ahead after it.

    A key of any length is dealt over its buckets; between them only the edges'
    labels are carried, a row for each bucket.
    """
    told = F.struct(F.col(time).alias("_label"), *values)
    kind = coarse.select(told.alias("x")).schema["x"].dataType
    rows = fine.withColumns({"_told": F.lit(None).cast(kind), "_fine": F.lit(1)}).unionByName(
        coarse.select(*keys, time, told.alias("_told"), F.lit(0).alias("_fine")), allowMissingColumns=True
    )
    rows = rows.withColumn("_at", _bucket(F.col(time)))
    label = F.when(F.col("_fine") == 0, F.col(time))
    edges = rows.groupBy(*keys, "_at").agg(F.max_by("_told", label).alias("_last"), F.min_by("_told", label).alias("_first"))
    held = Window.partitionBy(*keys).orderBy("_at")
    before, after = held.rowsBetween(Window.unboundedPreceding, -1), held.rowsBetween(1, Window.unboundedFollowing)
    carry = F.last("_last", ignorenulls=True).over(before).alias("_carry")
    return rows, edges.select(*keys, "_at", carry, F.first("_first", ignorenulls=True).over(after).alias("_ahead"))


def asof(fine: DataFrame, coarse: DataFrame, keys: list[str], values: list[str], time: str = "time", label: str | None = None) -> DataFrame:
    """Backward as-of join by label, without tolerance, over the union of both sides in time buckets."""
    rows, carried = _both(fine, coarse, keys, values, time)
    order = Window.partitionBy(*keys, "_at").orderBy(time, "_fine").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.join(carried, [*keys, "_at"]).withColumn("_got", F.coalesce(F.last("_told", ignorenulls=True).over(order), "_carry")).filter("_fine = 1")
    made = found.withColumns({v: F.col(f"_got.{v}") for v in values})
    return (made.withColumn(label, F.col("_got._label")) if label else made).drop("_told", "_fine", "_got", "_at", "_carry", "_ahead")


def asof_forward(fine: DataFrame, coarse: DataFrame, keys: list[str], values: list[str], time: str = "time") -> DataFrame:
    """As-of join to the least label at or after a time (backward fill)."""
    rows, carried = _both(fine, coarse, keys, values, time)
    order = Window.partitionBy(*keys, "_at").orderBy(time, F.desc("_fine")).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    found = rows.join(carried, [*keys, "_at"]).withColumn("_got", F.coalesce(F.first("_told", ignorenulls=True).over(order), "_ahead")).filter("_fine = 1")
    return found.withColumns({v: F.col(f"_got.{v}") for v in values}).drop("_told", "_fine", "_got", "_at", "_carry", "_ahead")


def asof_nearest(fine: DataFrame, coarse: DataFrame, keys: list[str], value: str, time: str = "time") -> DataFrame:
    """The value of the nearest label; the earlier one if both are as far."""
    rows, carried = _both(fine, coarse, keys, [value], time)
    back = Window.partitionBy(*keys, "_at").orderBy(time, "_fine").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy(*keys, "_at").orderBy(time, F.desc("_fine")).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    met = rows.join(carried, [*keys, "_at"])
    found = met.withColumns({
        "_p": F.coalesce(F.last("_told", ignorenulls=True).over(back), "_carry"), "_n": F.coalesce(F.first("_told", ignorenulls=True).over(ahead), "_ahead"),
    }).filter("_fine = 1")
    earlier = F.col("_n").isNull() | (F.col("_p").isNotNull() & ((F.col(time) - F.col("_p._label")) <= (F.col("_n._label") - F.col(time))))
    return found.withColumn(value, F.when(earlier, F.col(f"_p.{value}")).otherwise(F.col(f"_n.{value}"))).drop("_told", "_fine", "_p", "_n", "_at", "_carry", "_ahead")


def upsample(df: DataFrame, keys: list[str], period_hours: int = 24, time: str = "time", unit: str = "day") -> DataFrame:
    """Forward fill: each label's row is repeated for every hour of its period, the last one's as well; unit month asks for whole months."""
    last = F.col(time) + hours(period_hours - 1) if unit == "day" else F.col(time) + F.expr("INTERVAL '1' MONTH") - hours(1)
    return df.withColumn(time, F.explode(F.sequence(F.col(time), last, F.expr("INTERVAL '1' HOUR"))))


def shift_values(df: DataFrame, keys: list[str], value: str, steps: int, time: str = "time") -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(time)
    return df.withColumn(value, F.lead(value, -steps).over(order) if steps < 0 else F.lag(value, steps).over(order))


def gaps(df: DataFrame, keys: list[str], time: str = "time") -> DataFrame:
    """Largest distance of neighbouring times in hours, per key; within time buckets first, then between their edges."""
    micros = lambda x: epoch_seconds(x) * 1_000_000 + F.expr(f"CAST(date_format({x}, 'SSSSSS') AS LONG)")
    times = df.select(*keys, time).distinct().withColumn("_at", _bucket(F.col(time)))
    step = micros(time) - F.lag(micros(time)).over(Window.partitionBy(*keys, "_at").orderBy(time))
    inner = times.withColumn("_gap", step).groupBy(*keys, "_at").agg(F.max("_gap").alias("_gap"), F.min(micros(time)).alias("_a"), F.max(micros(time)).alias("_b"))
    between = F.col("_a") - F.lag("_b").over(Window.partitionBy(*keys).orderBy("_at"))
    return inner.withColumn("_edge", between).groupBy(*keys).agg((F.greatest(F.max("_gap"), F.max("_edge")) / 3.6e9).alias("max_gap_hours"))


def infer_step_seconds(df: DataFrame, time: str = "time", fallback: int = 86_400) -> int:
    """The one distance between neighbouring times; a single time gives the fallback, irregular times a ValueError.

    n distinct times that are all multiples of (last - first) / (n - 1) after the
    first are every one of them, so no order of all times is needed.
    """
    seconds = df.select(epoch_seconds(time).alias("s")).dropna().distinct()
    ends = seconds.agg(F.count("s").alias("n"), F.min("s").alias("a"), F.max("s").alias("b")).first()
    if ends["n"] < 2:
        return fallback
    step, rest = divmod(ends["b"] - ends["a"], ends["n"] - 1)
    if rest or seconds.filter((F.col("s") - ends["a"]) % step != 0).count():
        raise ValueError(f"times are irregular: {ends['n']} of them in {ends['b'] - ends['a']} seconds")
    return int(step)


def missing_labels(have: DataFrame, start: str, end: str, column: str = "date") -> DataFrame:
    """The days from start to end that ``have`` lacks."""
    expected = have.sparkSession.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}')) AS {column}")
    return expected.join(have.select(column).distinct(), column, "left_anti")


def between(df: DataFrame, start: str, end: str, time: str = "time") -> DataFrame:
    """Rows of a label range, both ends included."""
    return df.filter(F.col(time).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))


def days(spark: SparkSession, start: str, end: str, column: str = "date") -> DataFrame:
    """The days from start up to, but without, end."""
    return spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}' - INTERVAL '1' DAY)) AS {column}")


def count_per_period(df: DataFrame, keys: list[str], name: str = "n", unit: str = "day", offset_hours: int = 0, time: str = "time") -> DataFrame:
    """Every row with the number of rows in its period."""
    placed = df.withColumn("_period", period_start(F.col(time), unit, offset_hours))
    return placed.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*keys, "_period"))).drop("_period")


def merge(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full join of two tables of variables on their coordinates."""
    return left.join(right, keys, "full")


def in_index(df: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose coordinates are in the index."""
    return df.join(index.select(*keys), keys, "left_semi")


def long_concat(df: DataFrame, keys: list[str], values: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    """One row per key and variable."""
    return df.unpivot(keys, values, name, value)


def compare(df: DataFrame, target: str, calculated: str) -> DataFrame:
    """ratio and residual of a target against a calculated column."""
    return df.withColumns({"ratio": ratio(target, calculated), "residual": F.col(target) - F.col(calculated)})


def concat(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts; columns that a part lacks are missing there."""
    made, *rest = parts
    for part in rest:
        made = made.unionByName(part, allowMissingColumns=True)
    return made


def first_rows(df: DataFrame, keys: list[str], values: list[str], time: str = "time") -> DataFrame:
    """The values of each key's first row in time."""
    found = F.min_by(F.struct(time, *values), F.struct(time, *values)).alias("_f")
    return df.groupBy(*keys).agg(found).select(*keys, f"_f.{time}", *[f"_f.{v}" for v in values])


def expected_but_missing(expected: DataFrame, have: DataFrame) -> DataFrame:
    return expected.subtract(have)
