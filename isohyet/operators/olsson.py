"""Microcanonical cascades with position and volume classes, after Olsson and Guntner.

A wet box splits in two halves: all to the first, all to the second, or x and 1 - x.
The chances depend on the box's position in its rain (isolated, starting, enclosed,
ending, by whether its neighbours are wet) and on its volume (above or below the mean
of its position).  Both the statistics of a fine series and the cascade itself find
neighbours by the number of a box, in equi-joins; no series is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isohyet.operators.store import cut
from isohyet.operators.time import epoch_seconds, infer_step_seconds

POSITIONS = ("isolated", "starting", "enclosed", "ending")
#: Bins of the share that the first half takes where both are wet.
BINS = 7
LEVELS = 5
#: Chances (first alone, second alone) where a class was never seen.
UNSEEN = (0.25, 0.25)


#: Boxes of a stretch in which neighbours are looked for; a box at its edge is told to the next stretch as well.
STRETCH = 4096


def _classed(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Wet boxes (keys, box, v) with their position, and above: whether v is over the mean of keys and position."""
    place = F.pmod(F.col("box"), F.lit(STRETCH))
    own = F.floor(F.col("box") / STRETCH)
    to = F.array_compact(F.array(F.struct(own.alias("s"), F.lit(False).alias("guest")), F.when(place == 0, F.struct((own - 1).alias("s"), F.lit(True).alias("guest"))), F.when(place == STRETCH - 1, F.struct((own + 1).alias("s"), F.lit(True).alias("guest")))))
    told = boxes.filter("v > 0").withColumn("_to", F.explode(to))
    order = Window.partitionBy(*keys, "_to.s").orderBy("box")
    before, after = F.coalesce(F.lag("box").over(order) == F.col("box") - 1, F.lit(False)), F.coalesce(F.lead("box").over(order) == F.col("box") + 1, F.lit(False))
    seen = told.withColumns({"_before": before, "_after": after}).filter("NOT _to.guest")
    position = F.when(F.col("_before") & F.col("_after"), "enclosed").when(F.col("_after"), "starting").when(F.col("_before"), "ending").otherwise("isolated")
    placed = seen.withColumn("position", position).drop("_before", "_after", "_to")
    mean = placed.groupBy(*keys, "position").agg(F.avg("v").alias("_mean"))
    return placed.join(mean, [*keys, "position"]).withColumn("above", F.col("v") > F.col("_mean")).drop("_mean")


def statistics(fine: DataFrame, key: str, value: str, time: str = "time", levels: int = LEVELS, step_seconds: int | None = None) -> DataFrame:
    """key, position, above, n, first, second, shares: chances of a split that leaves all to one half, and counts of the shares in BINS bins.

    Boxes of 2 to 2**levels steps are counted together; their numbers count steps
    since 1970, so boxes of all keys lie alike.  Missing values count as 0.
    """
    step = step_seconds or infer_step_seconds(fine, time)
    at = F.floor(epoch_seconds(time) / step)
    steps = fine.select(F.col(key), at.alias("_at"), F.coalesce(value, F.lit(0.0)).alias("v")).filter("v > 0")
    scaled = steps.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(levels))))
    half = F.floor(F.col("_at") / F.pow(F.lit(2.0), F.col("level") - 1))
    halves = scaled.groupBy(key, "level", F.floor(half / 2).alias("box")).agg(F.sum(F.when(half % 2 == 0, F.col("v")).otherwise(0.0)).alias("a"), F.sum(F.when(half % 2 == 1, F.col("v")).otherwise(0.0)).alias("b"))
    boxes = _classed(halves.withColumn("v", F.col("a") + F.col("b")), [key, "level"])
    share = F.least(F.floor(F.col("a") / F.col("v") * BINS), F.lit(BINS - 1))
    both = (F.col("a") > 0) & (F.col("b") > 0)
    counts = [F.sum((both & (share == k)).cast("long")).alias(f"_s{k}") for k in range(BINS)]
    made = boxes.groupBy(key, "position", "above").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("b") <= 0).cast("long")).alias("_1"), F.sum((F.col("a") <= 0).cast("long")).alias("_2"), *counts)
    return made.select(key, "position", "above", "n", (F.col("_1") / F.col("n")).alias("first"), (F.col("_2") / F.col("n")).alias("second"), F.array(*[f"_s{k}" for k in range(BINS)]).alias("shares"))


def _uniform(seed: int | Column, key: str, level: int, part: int) -> Column:
    """A number in [0, 1) from the hash of seed, key, day, level and box."""
    told = F.md5(F.concat_ws("|", *[x.cast("string") for x in (seed if isinstance(seed, Column) else F.lit(seed), F.col(key), epoch_seconds("time"), F.lit(level), F.col("idx"))]))
    return F.conv(F.substring(told, 8 * part + 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _share(u: Column, counts: Column) -> Column:
    """A share from binned counts by inversion; even over (0, 1) where there are none."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    aim = u * total
    # bins whose counts end at or before the aim, and what they hold
    passed = F.aggregate(counts, F.struct(F.lit(0).alias("k"), F.lit(0).cast("long").alias("held"), F.lit(False).alias("done")), lambda a, x: F.when(
        a["done"] | (a["held"] + x > aim), F.struct(a["k"].alias("k"), a["held"].alias("held"), F.lit(True).alias("done"))
    ).otherwise(F.struct((a["k"] + 1).alias("k"), (a["held"] + x).alias("held"), F.lit(False).alias("done"))))
    inside = (aim - passed["held"]) / F.get(counts, passed["k"])
    return F.when(total > 0, (passed["k"] + inside) / BINS).otherwise(u)


def cascade(daily: DataFrame, key: str, value: str, stats: DataFrame, seed: int | Column = 0, levels: int = LEVELS) -> DataFrame:
    """key, time (day), idx, value of the 2**levels parts of each positive day; every day keeps its total.

    Days are labelled a day apart.  At each level neighbours are found by number,
    so a box at the edge of a day looks into the day beside it.  Each level is
    written once, as its boxes are classed and split in branches.  Classes that the
    statistics lack split by UNSEEN.
    """
    now = daily.filter(F.col(value) > 0).select(key, "time", F.lit(0).cast("long").alias("idx"), F.col(value).cast("double").alias("v"))
    told = cut(stats.select(key, "position", "above", "first", "second", "shares"))
    for level in range(levels):
        boxes = now.withColumn("box", F.floor(epoch_seconds("time") / 86_400) * (1 << level) + F.col("idx"))
        met = _classed(boxes, [key]).join(told, [key, "position", "above"], "left")
        first, second = F.coalesce("first", F.lit(UNSEEN[0])), F.coalesce("second", F.lit(UNSEEN[1]))
        u = met.withColumns({"_u": _uniform(seed, key, level, 0), "_w": _uniform(seed, key, level, 1)})
        x = F.when(F.col("_u") < first, 1.0).when(F.col("_u") < first + second, 0.0).otherwise(_share(F.col("_w"), F.coalesce("shares", F.array(*[F.lit(0).cast("long")] * BINS))))
        split = u.withColumn("_x", x)
        both = F.array(F.struct((F.col("idx") * 2).alias("idx"), (F.col("v") * F.col("_x")).alias("v")), F.struct((F.col("idx") * 2 + 1).alias("idx"), (F.col("v") * (1 - F.col("_x"))).alias("v")))
        now = cut(split.select(key, "time", F.explode(both).alias("h")).select(key, "time", "h.idx", "h.v").filter("v > 0"))
    return now.withColumnRenamed("v", "value")
