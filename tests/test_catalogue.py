import duckdb
import pytest

from isohyet.plans import catalogue, feeds, grids  # noqa: F401
from isohyet.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for t in "nation supplier part orders lineitem events pages".split():
        made.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return made


def rows(df):
    df = df[sorted(df)]
    text = lambda x: "NULL" if x is None or x != x else f"{x:.9g}" if isinstance(x, float) else str(x)
    return sorted(tuple(map(text, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_oracle(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLE[name]).df()
    assert sorted(got) == sorted(want)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_oracle(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_values_without_oracle(spark):
    """What must hold of the queries that SQL can't express: totals, ranges and one row a key."""
    from pyspark.sql import functions as F

    from isohyet.plans.grids import _midnight

    hours = QUERIES["olsson_hours"](spark, SF)
    assert hours.count() == hours.select("zone", "time").distinct().count() and hours.filter("precip_mm < 0 OR precip_mm IS NULL").count() == 0
    made = {(r.zone, r.d): r.s for r in hours.groupBy("zone", F.to_date("time").alias("d")).agg(F.sum("precip_mm").alias("s")).collect()}
    for r in _midnight(spark, SF).collect():
        if (r.zone, r.time.date()) in made and r.precip_mm > 0 and r.time.date() not in (min(d for _, d in made), max(d for _, d in made)):
            assert made[r.zone, r.time.date()] == pytest.approx(r.precip_mm, abs=1e-4)
    fit = QUERIES["cascade_fit"](spark, SF).toPandas()
    assert len(fit) == fit["zone"].nunique()
    rain = QUERIES["precip_hybrid_fitted"](spark, SF)
    assert rain.filter("precip_mm < 0").count() == 0 and rain.count() == rain.select("zone", "time").distinct().count()


def test_entry_imports():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
