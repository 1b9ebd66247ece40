from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import series
from tidemark.operators.alerts import AlertLog
from tidemark.plans import stations

NOW = datetime(2024, 5, 1, 12, 0, 0)
SCHEMA = (
    "BikepointID string, Street string, Neighbourhood string, Latitude double, Longitude double, "
    "No_Bikes bigint, No_Empty_Docks bigint, EnqueuedTime timestamp, EventID bigint"
)


def event(number, station, street, area, bikes, docks, minutes_ago, seconds=0):
    at = NOW - timedelta(minutes=minutes_ago, seconds=seconds)
    return (station, street, area, 51.5, -0.1, bikes, docks, at, number)


@pytest.fixture(scope="module")
def readings(spark):
    return spark.createDataFrame(
        [
            event(1, "BP_1", "Elm", "North", 4, 6, 50),
            event(2, "BP_1", "Elm", "North", 9, 1, 10),
            event(3, "BP_1", "Elm", "North", 7, 3, 10),  # same time, later id
            event(4, "BP_2", "Oak", "", 0, 0, 5),
            event(5, "BP_2", "Oak", "", 2, 8, 60),  # exactly an hour old
            event(6, "BP_3", "Oak", None, 5, 5, 0),
            event(7, "BP_4", "Elm", "South", 1, 9, 600),
        ],
        SCHEMA,
    )


def test_base_and_choices(readings):
    assert stations.base(readings).count() == 7
    assert stations.base(readings, [], ["Oak"]).count() == 3
    assert stations.base(readings, ["North", "South"], ["Elm"]).count() == 4
    assert rows(stations.street_choices(readings, ["South"])) == [("Elm",)]
    assert stations.neighbourhood_choices(readings).count() == 4
    assert rows(stations.points_on_street(readings, "Elm")) == [("BP_1",), ("BP_4",)]


def test_recent_is_strict_and_takes_a_moment(readings):
    assert {r.EventID for r in stations.recent(readings).collect()} == {1, 2, 3, 4, 6}
    earlier = stations.recent(readings, "1 hour", "2024-05-01 11:30:00")
    assert {r.EventID for r in earlier.collect()} == {1, 2, 3, 4, 5, 6}


def test_latest_state_breaks_ties_by_id(readings):
    latest = {r.BikepointID: r.EventID for r in stations.latest_state(readings).collect()}
    assert latest == {"BP_1": 3, "BP_2": 4, "BP_3": 6}
    assert stations.latest_state(readings, age=None).columns[0] == "BikepointID"


def test_change_and_ranking(readings):
    full = stations.fullest(stations.base(readings))
    assert [tuple(r) for r in full.collect()] == [
        ("BP_1", "North", "Elm", 7, 3, 3),
        ("BP_3", None, "Oak", 5, 5, 0),
        ("BP_2", "", "Oak", 0, 0, 0),  # no places: rate is null and comes last
    ]
    empty = stations.fullest(stations.base(readings), n=2, emptiest=True)
    assert [r.BikepointID for r in empty.collect()] == ["BP_3", "BP_1"]
    change = stations.station_change(stations.base(readings))
    assert "No_Bikes1" in change.columns and "No_Empty_Docks1" in change.columns


def test_map_has_a_row_per_dock_count(readings):
    got = rows(stations.map_points(readings).select("BikepointID", "available docks"))
    assert got == [
        ("BP_1", "1 @BP_1"), ("BP_1", "3 @BP_1"), ("BP_1", "6 @BP_1"),
        ("BP_2", "0 @BP_2"), ("BP_3", "5 @BP_3"),
    ]


def test_sums(readings):
    assert rows(stations.bikes_per_street(readings)) == [("Elm", 21), ("Oak", 7)]
    assert [tuple(r) for r in stations.streets_with_most_docks(readings, 1).collect()] == [("Elm", 19)]
    assert [tuple(r) for r in stations.most_popular_point(readings).collect()] == [("BP_1", 20)]
    assert ("North", 3) in rows(stations.points_per_neighbourhood(readings))
    assert [tuple(r) for r in stations.bikes_per_neighbourhood(readings).collect()] == [
        ("North", 20), ("Unidentified", 7), ("South", 1),
    ]
    assert rows(stations.bikes_per_day(readings)) == [(datetime(2024, 5, 1), 28)]
    assert [tuple(r) for r in stations.points_per_street(readings).collect()] == [
        ("Elm", 4, 19), ("Oak", 3, 13),
    ]
    assert rows(stations.bikes_per_place(readings)) == [(-0.1, 51.5, 28)]


def test_counts(readings):
    assert [tuple(r) for r in stations.event_counts(readings).collect()] == [
        ("Total", 7, 1), ("Last hour", 5, 2), ("Last minute", 1, 3),
    ]


def test_matrix_levels(readings):
    matrix = stations.matrix(readings)
    by_level = {r.level: r.n for r in matrix.groupBy("level").agg(F.count("*").alias("n")).collect()}
    assert by_level == {0: 4, 1: 4, 2: 4, 3: 1}
    assert rows(matrix.where("level = 3")) == [(None, None, None, 3, 28, 32)]


def test_previous_change(readings):
    got = {
        (r.BikepointID, r.EventID): (r.CountChange, r.EmptyCountChange)
        for r in stations.previous_change(readings).collect()
    }
    assert got == {
        ("BP_1", 3): (2, -2),  # the row before it has 9 bikes and 1 dock
        ("BP_1", 2): (None, None),
        ("BP_2", 4): (2, 8),
        ("BP_2", 5): (None, None),
        ("BP_3", 6): (None, None),
        ("BP_4", 7): (None, None),
    }


def test_rank_filter_runs_before_the_shuffle(readings):
    plan = stations.previous_change(readings)._jdf.queryExecution().executedPlan().toString()
    after = plan.index("Exchange hashpartitioning(BikepointID")
    assert plan.index("WindowGroupLimit", after) > after  # partial limit below the exchange
    assert plan.count("Exchange") == 1


def test_dashboard_tiles(readings):
    tiles = stations.dashboard(readings, streets=["Elm"], now="2024-05-01 12:00:00")
    assert {name: df.count() for name, df in tiles.items()} == {
        "fullest": 1, "emptiest": 1, "map": 3, "bikes_per_street": 1, "event_counts": 3,
        "docks_fine": 100, "docks_daily": 1, "neighbourhood_choices": 4, "street_choices": 2,
    }


# --- series -------------------------------------------------------------------------


def expected_series(points, start, end, step):
    """Plain Python: {key: [value per bin]} for points (key, second, value)."""
    bins = -(-(end - start) // step)
    out = {}
    for key in {k for k, t, _ in points if start <= t < end}:
        known = {}
        for k, t, v in points:
            if k == key and start <= t < end and v is not None:
                b = (t - start) // step
                known[b] = max(known.get(b, v), v)
        line = []
        for b in range(bins):
            left = max((x for x in known if x <= b), default=None)
            right = min((x for x in known if x >= b), default=None)
            if not known:
                line.append(0.0)
            elif left is None:
                line.append(float(known[right]))
            elif right is None or left == right:
                line.append(float(known[left]))
            else:
                line.append(
                    known[left] + (known[right] - known[left]) * ((b - left) / (right - left))
                )
        out[key] = line
    return out


def series_frame(spark, points):
    base = datetime(2024, 1, 1)
    data = [(k, base + timedelta(seconds=t), v) for k, t, v in points]
    return spark.createDataFrame(data, "k string, t timestamp, v bigint")


def check_series(spark, points, now=None, since=None, min_step="10 seconds", step=10):
    df = series_frame(spark, points)
    base = datetime(2024, 1, 1)
    text = lambda s: None if s is None else str(base + timedelta(seconds=s))
    made = series.make_series(df, ["k"], "t", "v", min_step, text(now), text(since))
    start = max(min(t for _, t, _ in points), since if since is not None else 0)
    end = now if now is not None else max(t for _, t, _ in points)
    step = max((end - start) / 100, step)
    assert step == int(step)
    want = expected_series(points, start, end, int(step))
    got = {}
    for r in made.orderBy("k", "bin").collect():
        assert r.bin_time == base + timedelta(seconds=start + r.bin * int(step))
        got.setdefault(r.k, []).append(r.v)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key])


def test_series_gap_edges_and_empty(spark):
    points = [
        ("a", 0, 10), ("a", 55, 20), ("a", 58, 26), ("a", 80, 2),  # gap and two in a bin
        ("one", 30, 7),  # a single point is flat
        ("null", 40, None),  # no value at all is 0
        ("mixed", 20, None), ("mixed", 60, 4), ("mixed", 70, None),
        ("late", 500, 3),  # outside the range
    ]
    check_series(spark, points, now=100)
    check_series(spark, points, now=100, since=25)


def test_series_end_is_excluded(spark):
    df = series_frame(spark, [("a", 0, 1), ("a", 20, 9)])
    last = df.selectExpr("CAST(MAX(t) AS STRING) AS t").first().t
    made = series.make_series(df, ["k"], "t", "v", "10 seconds", now=last)
    assert [(r.bin, r.v) for r in made.orderBy("bin").collect()] == [(0, 1.0), (1, 1.0)]
    # Without a given end the series goes just past the newest row.
    whole = series.make_series(df, ["k"], "t", "v", "10 seconds")
    assert [(r.bin, r.v) for r in whole.orderBy("bin").collect()] == [(0, 1.0), (1, 5.0), (2, 9.0)]


def test_series_step_is_a_hundredth_of_the_range(spark):
    df = series_frame(spark, [("a", 0, 1), ("a", 500, 5), ("a", 1000, 9)])
    assert series.make_series(df, ["k"], "t", "v", "1 second").count() == 101


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b"]), st.integers(0, 99), st.one_of(st.none(), st.integers(0, 50))
        ),
        min_size=1,
        max_size=12,
    )
)
def test_series_matches_brute_force(spark, points):
    check_series(spark, points, now=120)


def test_totals_truncate_and_alert(spark, readings):
    filled = spark.createDataFrame(
        [("a", datetime(2024, 1, 1), 2.9), ("b", datetime(2024, 1, 1), 3.9)],
        "k string, bin_time timestamp, v double",
    )
    total = series.total_per_bin(filled, "v", "docks")
    assert rows(total) == [(datetime(2024, 1, 1), 5)]
    assert series.at_least(total, "docks", 5).count() == 1
    assert series.at_least(total, "docks", 6).count() == 0
    assert stations.dock_alerts(readings, threshold=1).count() == 1


def test_now_does_not_follow_the_selection(spark):
    """An area whose last event is old has no recent rows, and no counts of the last hour."""
    from pyspark.sql import functions as F

    rows_ = [
        ("BP_1", "Elm", "Old", 1, 1, "2024-01-01 00:00:00"),
        ("BP_2", "Oak", "New", 1, 1, "2024-01-09 00:00:00"),
    ]
    table = spark.createDataFrame(
        rows_,
        "BikepointID string, Street string, Neighbourhood string, No_Bikes long,"
        " No_Empty_Docks long, at string",
    ).select(
        "*",
        F.col("at").cast("timestamp").alias("EnqueuedTime"),
        F.lit(1.0).alias("Latitude"),
        F.lit(1.0).alias("Longitude"),
        F.lit(1).alias("EventID"),
    )
    tiles = stations.dashboard(table, ["Old"])
    assert tiles["fullest"].count() == 0 == tiles["map"].count()
    assert [r.Count for r in tiles["event_counts"].collect()] == [1, 0, 0]
    assert tiles["docks_daily"].count() == 9
    assert stations.latest_state(table).select("BikepointID").collect()[0][0] == "BP_2"


def test_series_keeps_the_newest_rows(spark):
    """A key seen only at the newest moment is in the series, also if it is the only moment."""
    frame = spark.createDataFrame(
        [("a", 0, 5), ("b", 100, 7)], "k string, s long, v long"
    ).selectExpr("k", "timestamp_seconds(s) AS t", "v")
    made = series.make_series(frame, ["k"], "t", "v", "10 seconds")
    assert {r.k for r in made.collect()} == {"a", "b"}
    one = series.make_series(frame.where("k = 'b'"), ["k"], "t", "v", "10 seconds")
    assert [(r.k, r.v) for r in one.collect()] == [("b", 7.0)]


def test_alerts_are_raised_once_corrected_and_cleared(spark, tmp_path):
    log = AlertLog(spark, str(tmp_path / "alerts"), "day", "int")
    series = lambda *r: spark.createDataFrame(list(r), "day int, value int")
    run = lambda n, *r: sorted((e.day, e.value, e.event) for e in log.run(n, series(*r), 10).collect())
    assert run(1, (1, 12), (2, 9), (None, 50), (4, None)) == [(1, 12.0, "raised")]
    again = [(1, 12), (2, 10), (3, 30)]
    assert run(2, *again) == [(2, 10.0, "raised"), (3, 30.0, "raised")]
    assert run(2, *again) == [(2, 10.0, "raised"), (3, 30.0, "raised")]  # tried again
    assert run(3, *again) == []
    # Day 1 is out of the range now, day 2 was corrected to less, day 3 to more.
    assert run(4, (2, 8), (3, 31)) == [(2, 10.0, "cleared"), (3, 31.0, "corrected")]
    assert run(5, (2, 11), (3, 31)) == [(2, 11.0, "raised")]
    assert rows(log.standing(5)) == [(1, 12.0), (2, 11.0), (3, 31.0)]
    assert run(6) == []
    with pytest.raises(ValueError):
        log.run(0, series(), 10)
