import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import partials, series
from tidemark.session import scratch_path

BASE = datetime(2024, 3, 1, 0, 0, 3, 250_000)


def frame(spark, points):
    data = [(k, BASE + timedelta(microseconds=int(t * 1e6)), v) for k, t, v in points]
    return spark.createDataFrame(data, "k string, t timestamp, v bigint")


def drawn(seed, n, span):
    """Points with ties in time and value, a hot key, nulls, and a key with nulls only."""
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["b", "c"]
    out = [
        (rng.choice(keys), rng.randrange(span * 2) / 2, rng.choice([None, *range(8), -3]))
        for _ in range(n)
    ]
    return [*out, ("null", span / 3, None), ("one", span / 2, 5), out[0], out[1]]


def store(spark, base="10 seconds"):
    path = scratch_path(spark, "partials")
    return partials.SeriesPartials(spark, path, ["k"], "t", "v", base)


@pytest.mark.parametrize(
    "seed, span, min_step", [(1, 300, "10 seconds"), (2, 90, "1 minute"), (3, 4000, "11 seconds")]
)
def test_series_of_partials_equals_series_of_rows(spark, seed, span, min_step):
    points = drawn(seed, 600, span)
    rng = random.Random(seed)
    place = [rng.randrange(3) for _ in points]
    part = lambda n: frame(spark, [p for p, d in zip(points, place, strict=True) if d == n])
    held = store(spark)
    held.add(2, part(2))  # deliveries come in no order, and bins are spread over them
    held.add(1, part(1))
    for since in (None, str(BASE + timedelta(seconds=span / 7))):
        want = series.make_series(frame(spark, points), ["k"], "t", "v", min_step, since=since)
        assert rows(held.series(part(0), min_step, since)) == rows(want)


def test_any_single_cut_of_a_bin_keeps_both_largest_values(spark):
    points = [("k", t, v) for t, v in enumerate([3, 9, 1, 4, 4, 7, 2, 9, 5, 0])]
    kept = partials.kept_rows(frame(spark, points), ["k"], "t", "v", "1 hour").collect()
    found = [((r.t - BASE).total_seconds(), r.v) for r in kept]
    assert len(found) < len(points)
    for cut in range(11):
        for side in (lambda t: t < cut, lambda t: t >= cut):
            want = [v for _, t, v in points if side(t)]
            assert max((v for t, v in found if side(t)), default=None) == max(want, default=None)


def test_kept_rows_do_not_grow_with_the_rows(spark):
    one = [("k", t % 3600, t % 20) for t in range(4000)]
    many = frame(spark, one).selectExpr("*", "explode(sequence(1, 50)) AS copy")
    counted = [partials.kept_rows(df, ["k"], "t", "v", "1 hour").count() for df in (frame(spark, one), many)]
    assert counted[0] == counted[1] <= 2 * 2 * 20


def test_delivery_tried_again_and_unfinished_ones(spark):
    points = drawn(5, 60, 100)
    held = store(spark)
    assert held.deliveries() == []
    assert rows(held.rows(frame(spark, points))) == rows(frame(spark, points))
    held.add(1, frame(spark, [("k", 0, 99)]))
    held.add(1, frame(spark, points))
    # Rows without their mark are of a delivery that stopped half way.
    frame(spark, [("x", 1, 1)]).write.parquet(f"{held.path}/rows/{partials.DELIVERY}=7")
    assert held.deliveries() == [1]
    nothing = frame(spark, [])
    want = series.make_series(frame(spark, points), ["k"], "t", "v", "10 seconds")
    assert rows(held.series(nothing, "10 seconds")) == rows(want)
    held.add(2, nothing)
    assert rows(held.series(nothing, "10 seconds")) == rows(want)


def test_step_shorter_than_the_base_is_refused(spark):
    with pytest.raises(ValueError):
        store(spark, "1 minute").series(frame(spark, []), "59 seconds")


def test_refresh_reads_the_partials_and_the_open_day_only(spark, conf):
    conf(spark__sql__maxMetadataStringLength="1000")
    table = scratch_path(spark, "days")
    points = [(f"s{t % 4}", t * 600, t % 9) for t in range(700)]
    frame(spark, points).selectExpr("*", "to_date(t) AS day").write.partitionBy("day").parquet(table)
    source = spark.read.parquet(table)
    last = source.selectExpr("CAST(max(day) AS STRING) AS d").first().d
    held = store(spark, "1 hour")
    held.add(1, source.where(f"day < DATE '{last}'"))
    refreshed = held.series(source.where(f"day = DATE '{last}'"), "1 hour")
    assert rows(refreshed) == rows(series.make_series(source, ["k"], "t", "v", "1 hour"))
    plan = refreshed._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("(day#" in s and f" = {last})" in s or "_delivery=1" in s for s in scans)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_partials_by_more_columns_serve_filters_and_fewer_columns(spark):
    rng = random.Random(9)
    points = frame(spark, drawn(9, 500, 200)).withColumn("area", F.expr("concat('N', pmod(v + second(t), 3))"))
    parts = points.randomSplit([1.0, 1.0], seed=rng.randrange(100))
    path = scratch_path(spark, "partials")
    held = partials.SeriesPartials(spark, path, ["k", "area"], "t", "v", "10 seconds")
    held.add(1, parts[0])
    end = points.agg(F.max("t")).first()[0] + timedelta(microseconds=1)
    for chosen in ("true", "area = 'N1'"):
        want = series.make_series(points.where(chosen), ["k"], "t", "v", "12 seconds", str(end))
        found = held.rows(parts[1]).where(chosen)
        assert rows(series.make_series(found, ["k"], "t", "v", "12 seconds", str(end))) == rows(want)
