import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.plans import stations
from tidemark.streaming import live, progress, sinks, sources, windows

START = datetime(2024, 5, 1)


@pytest.fixture(autouse=True)
def few_partitions(conf):
    """A state store for each of two partitions, not of eight."""
    conf(spark__sql__shuffle__partitions="2")


def put(folder, name, records, age=0):
    """A JSON line file; ``age`` orders files by modification time."""
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("\n".join(json.dumps(r) for r in records) + "\n")
    os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))


def bike(street, second, bikes, station="BP_1", docks=1):
    return {
        "BikepointID": station,
        "Street": street,
        "No_Bikes": bikes,
        "No_Empty_Docks": docks,
        "EnqueuedTime": (START + timedelta(seconds=second)).isoformat() + "Z",
    }


def drain(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_device_files_arrive_in_steps_and_restart(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    put(source, "data.txt", [{"device": "Dev1", "status": "ok"}] * 3)
    put(source, "old.txt", [{"device": "Dev2", "status": "error"}], age=1)

    def run():
        stream = sources.device_status(spark, str(source))
        return drain(sinks.append_files(stream, out, checkpoint))

    first = run()
    assert len([p for p in first.recentProgress if p["numInputRows"]]) == 2  # a file per batch
    assert spark.read.parquet(out).count() == 4
    put(source, "more-data.txt", [{"device": "Dev1", "status": "error"}] * 2, age=2)
    run()
    assert spark.read.parquet(out).count() == 6
    run()  # nothing new: the checkpoint remembers what was read
    assert rows(spark.read.parquet(out).groupBy("device", "status").count()) == [
        ("Dev1", "error", 2), ("Dev1", "ok", 3), ("Dev2", "error", 1),
    ]


@pytest.fixture
def bikes(tmp_path):
    """Three files in time order; 00:00:05 lies on a window border."""
    source = tmp_path / "bikes"
    put(source, "1.json", [bike("Elm", 0, 4), bike("Elm", 4, 6), bike("Oak", 5, 1)], age=0)
    put(source, "2.json", [bike("Elm", 7, 2), bike("Oak", 9, 3)], age=10)
    put(source, "3.json", [bike("Elm", 20, 8), bike("Elm", 21, 1)], age=20)
    return source


def end(second):
    return START + timedelta(seconds=second)


def test_tumbling_windows_append_closed_ones(spark, bikes, tmp_path):
    stream = windows.tumbling_bikes(
        sources.station_events(spark, str(bikes)), lateness="2 seconds"
    )
    assert stream.dtypes == [
        ("Street", "string"), ("SUM_No_Bikes", "double"), ("Window_End_Time", "timestamp"),
    ]
    out = str(tmp_path / "out")
    drain(sinks.append_files(stream, out, str(tmp_path / "cp")))
    assert rows(spark.read.parquet(out)) == [
        ("Elm", 10.0, end(5)), ("Elm", 2.0, end(10)), ("Oak", 4.0, end(10)),
    ]


def test_update_sink_equals_batch(spark, bikes, tmp_path):
    out = str(tmp_path / "out")
    stream = windows.tumbling_bikes(sources.station_events(spark, str(bikes)), lateness="1 hour")
    drain(sinks.update_files(stream, out, str(tmp_path / "cp")))
    key = ["Street", "Window_End_Time"]
    schema = "Street string, SUM_No_Bikes double, Window_End_Time timestamp"
    current = sinks.current_results(spark, out, schema, key)
    batch = (
        spark.read.schema("Street string, No_Bikes bigint, EnqueuedTime timestamp")
        .json(str(bikes))
        .groupBy("Street", F.window("EnqueuedTime", "5 seconds").end.alias("Window_End_Time"))
        .agg(F.sum("No_Bikes").cast("double").alias("SUM_No_Bikes"))
    )
    assert rows(current) == rows(batch.select("Street", "Window_End_Time", "SUM_No_Bikes"))
    # Oak 00:00:05-10 changed in two batches, so it was written twice
    assert spark.read.parquet(out).where("Street = 'Oak'").count() == 2


def test_late_rows_beyond_the_watermark_are_dropped(spark, bikes, tmp_path):
    put(bikes, "4.json", [bike("Elm", 1, 100)], age=30)
    out = str(tmp_path / "out")
    stream = windows.tumbling_bikes(
        sources.station_events(spark, str(bikes)), lateness="2 seconds"
    )
    drain(sinks.append_files(stream, out, str(tmp_path / "cp")))
    assert ("Elm", 10.0, end(5)) in rows(spark.read.parquet(out))


def test_stream_alerts(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(source, "1.json", [bike("Elm", 0, 0, "BP_1", 5), bike("Elm", 1, 0, "BP_2", 9)])
    put(source, "2.json", [bike("Elm", 2, 0, "BP_1", 12)], age=5)
    daily = windows.docks_per_window(
        sources.station_events(spark, str(source)), "1 day", "1 hour"
    )
    stream = windows.alerts(daily, "docks", 9)
    drain(sinks.update_files(stream, out, str(tmp_path / "cp")))
    alerts = sinks.current_results(
        spark, out, "BikepointID string, docks bigint, window_start timestamp",
        ["BikepointID", "window_start"],
    )
    assert rows(alerts) == [("BP_1", START, 12), ("BP_2", START, 9)]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    """The folder of a batch is overwritten, as after a failure in the middle."""
    out = tmp_path / "out"
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    for _ in range(2):
        df.write.mode("overwrite").parquet(f"{out}/{sinks.BATCH}=0")
    df.withColumn("v", F.lit(2)).write.parquet(f"{out}/{sinks.BATCH}=1")
    assert rows(sinks.current_results(spark, str(out), "k string, v int", ["k"])) == [("a", 2)]


def test_parse_station_events(spark):
    body = json.dumps({"BikepointID": "BP_1", "Street": "Elm", "No_Bikes": 4})
    messages = spark.createDataFrame(
        [(body, START), ("broken", START)], "body string, at timestamp"
    )
    parsed = sources.parse_station_events(messages, "body", "at")
    assert parsed.columns[-1] == "EnqueuedTime" and len(parsed.columns) == 8
    assert rows(parsed.select("BikepointID", "No_Bikes")) == [("BP_1", 4), (None, None)]


def event(n, second, bikes=1, docks=1, station="BP_1", street="Elm"):
    return {**bike(street, 0, bikes, station, docks), "EnqueuedTime": (START + timedelta(seconds=second)).isoformat() + "Z", "EventID": n}


def events(spark, source):
    return sources.station_events(spark, str(source), more="EventID bigint")


def as_table(spark, source):
    return spark.read.schema(events(spark, source).schema).json(str(source))


@pytest.mark.parametrize("bucket", ["1 minute", "20 minutes"])
def test_rolling_counts_equal_the_report_after_every_batch(spark, tmp_path, bucket):
    """Times come in no order; the last files move the windows by microseconds and by hours."""
    rng = random.Random(4)
    start = 7200
    files = [[event(k * 100 + i, start + rng.uniform(0, 5000)) for i in range(40)] for k in range(3)]
    newest = start + 5000.000900
    edge = [newest, newest - 3600, newest - 3600 + 0.000001, newest - 60, newest - 59.999999, newest - 3600 - 0.0005]
    files += [[event(500 + i, t) for i, t in enumerate(edge)], [event(600, newest + 0.0000005)], [event(700, newest + 9000), event(701, start)]]
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    state_rows = []
    for k, records in enumerate(files):
        put(source, f"{k}.json", records, age=10 * k)
        counts = live.rolling_counts(events(spark, source), "4 hours", bucket=bucket, shards=2)
        query = drain(sinks.update_files(counts, out, checkpoint))
        state_rows += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
        want = rows(stations.event_counts(as_table(spark, source)))
        assert rows(live.current_counts(spark, out)) == want, k
    assert dict((label, n) for label, n, _ in want) == {"Total": 129, "Last hour": 1, "Last minute": 1}
    # Five hours later no row of the first files can come any more: their state is gone.
    put(source, "last.json", [event(800, newest + 30_000)], age=1000)
    query = drain(sinks.update_files(counts_again(spark, source, bucket), out, checkpoint))
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 2 < max(state_rows)
    assert rows(live.current_counts(spark, out)) == rows(stations.event_counts(as_table(spark, source)))


def counts_again(spark, source, bucket):
    return live.rolling_counts(events(spark, source), "4 hours", bucket=bucket, shards=2)


def test_rolling_counts_without_rows(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "1.json", [{**event(1, 0), "EnqueuedTime": None}])
    out = str(tmp_path / "out")
    drain(sinks.update_files(live.rolling_counts(events(spark, source), "1 hour"), out, str(tmp_path / "cp")))
    assert rows(live.current_counts(spark, out)) == []


def test_closed_windows_report_late_events(spark, tmp_path):
    """A minute of lateness; redelivered events count once and the state stays small."""
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    batches = [[event(100 * k + i, 300 * k + 6 * i, bikes=2) for i in range(50)] for k in range(6)]
    batches[1].append(batches[0][40])  # again, while it is remembered
    batches[3].append(event(1000, 299, bikes=7))  # four minutes behind the second file's newest
    batches[3].append(batches[0][3])  # again, long after
    for k, records in enumerate(batches):
        put(source, f"{k}.json", records, age=10 * k)
    stream = windows.closed_windows(events(spark, source), "EventID")
    query = drain(sinks.append_files(stream, out, checkpoint))
    report = progress.batches(spark, query).where("input_rows > 0").orderBy("batch").collect()
    assert [r.input_rows for r in report] == [50, 51, 50, 52, 50, 50]
    assert [r.late_rows for r in report] == [0, 0, 0, 2, 0, 0]
    assert max(r.state_rows for r in report) < 300 and len(report) == 6
    closed = spark.read.parquet(out)
    newest = 300 * 5 + 6 * 49
    assert closed.count() == closed.select("Street", "Window_End_Time").distinct().count()
    assert closed.agg(F.sum("n_events"), F.max("SUM_No_Bikes")).first() == (sum(300 * k + 6 * i < (newest - 60) // 5 * 5 for k in range(6) for i in range(50)), 2.0)


def test_station_state_equals_the_table(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    rng = random.Random(9)
    all_events = [event(i, rng.randrange(500), rng.randrange(20), rng.randrange(20), f"BP_{i % 7}") for i in range(120)]
    for k in range(3):
        put(source, f"{k}.json", all_events[40 * k : 40 * k + 40] + all_events[:: 10 + k], age=10 * k)
        state = live.station_state(events(spark, source))
        query = drain(sinks.update_files(state, out, checkpoint))
        current = sinks.current_results(spark, out, state.schema.toDDL(), ["BikepointID"])
        assert rows(current) == rows(stations.station_change(stations.base(as_table(spark, source))))
        assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 7


def test_broker_messages(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    body = json.dumps({"BikepointID": "BP_1", "Street": "Elm", "No_Bikes": 4})
    put(source, "1.json", [{"body": b, "EnqueuedTime": START.isoformat() + "Z"} for b in (body, "broken", None)])
    parsed = sources.parse_station_events(sources.broker_messages(spark, str(source)), "body", "EnqueuedTime")
    drain(sinks.append_files(parsed, out, str(tmp_path / "cp")))
    stored = spark.read.parquet(out).select("BikepointID", "No_Bikes", "EnqueuedTime")
    assert rows(stored) == [("BP_1", 4, START), (None, None, START), (None, None, START)]
