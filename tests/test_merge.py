import re
from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import joins, keys, merge
from tidemark.operators.versions import VERSION, ChangeLog

TABLE = "k string, d date, v int"
D = date(2020, 1, 1)


@pytest.fixture(autouse=True)
def few_partitions(conf):
    conf(spark__sql__shuffle__partitions="2")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, *data):
    return spark.createDataFrame(list(data), TABLE)


def test_insert_only_leaves_matches_alone(spark):
    target = table(spark, ("a", D, 1))
    updates = table(spark, ("a", D, 9), ("b", D, 2))
    assert rows(merge.merge(target, updates, ["k", "d"])) == [("a", D, 1), ("b", D, 2)]


def test_null_key_is_inserted_every_time(spark):
    target = table(spark, (None, D, 1))
    updates = table(spark, (None, D, 1))
    assert merge.merge(target, updates, ["k", "d"]).count() == 2
    assert merge.merge(target, updates, ["k", "d"], null_safe=True).count() == 1


def test_copies_inside_a_batch_are_all_inserted(spark):
    target = table(spark)
    updates = table(spark, ("a", D, 1), ("a", D, 1), ("a", D, 2))
    once = merge.merge(target, updates, ["k", "d"])
    assert once.count() == 3
    assert merge.merge(once, updates, ["k", "d"]).count() == 3


def test_upsert(spark):
    target = table(spark, ("a", D, 1), ("b", D, 5), (None, D, 7))
    updates = table(spark, ("a", D, 9), ("c", D, 2))
    merged = merge.merge(target, updates, ["k", "d"], when_matched={"v": "t.v + u.v"})
    assert rows(merged) == [(None, D, 7), ("a", D, 10), ("b", D, 5), ("c", D, 2)]


def test_upsert_with_own_insert_values(spark):
    target = table(spark, ("a", D, 1))
    updates = table(spark, ("b", D, 2))
    merged = merge.merge(
        target,
        updates,
        ["k"],
        when_matched={"v": "u.v"},
        when_not_matched={"k": "upper(u.k)", "v": "u.v * 2"},
    )
    assert rows(merged) == [("B", None, 4), ("a", D, 1)]


def test_ambiguous_update_fails_but_unmatched_copies_do_not(spark):
    target = table(spark, ("a", D, 1))
    twice = table(spark, ("a", D, 2), ("a", D, 3))
    with pytest.raises(Exception, match="several update rows"):
        merge.merge(target, twice, ["k"], when_matched={"v": "u.v"}).collect()
    unmatched = table(spark, ("b", D, 2), ("b", D, 3))
    assert merge.merge(target, unmatched, ["k"], when_matched={"v": "u.v"}).count() == 3


@settings(max_examples=10, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3)), max_size=8),
    st.lists(st.tuples(st.sampled_from(["a", "b", "d", None]), st.integers(0, 3)), max_size=8),
)
def test_merge_twice_equals_merge_once(spark, target, updates):
    """For rows with a full key; checked against plain Python."""
    t = spark.createDataFrame(target, "k string, v int")
    u = spark.createDataFrame(updates, "k string, v int")
    once = merge.merge(t, u, ["k"])
    known = {k for k, _ in target if k is not None}
    expected = target + [r for r in updates if r[0] not in known]
    assert rows(once) == sorted(expected, key=lambda r: tuple(map(str, r)))
    twice = merge.merge(once, u, ["k"]).where("k is not null")
    assert rows(twice) == rows(once.where("k is not null"))


def test_merge_into_table_reads_and_appends(spark, database):
    name = f"{database}.t"
    table(spark, ("a", D, 1)).write.saveAsTable(name)
    updates = table(spark, ("a", D, 9), ("b", D, 2))
    for _ in range(2):
        merge.merge_into_table(spark, name, updates, ["k", "d"])
    assert rows(spark.table(name)) == [("a", D, 1), ("b", D, 2)]


def test_only_rows_within_the_tables_dates_are_joined(spark, database, conf):
    """Before, all updates were shuffled; those outside the dates cannot match."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    name, early, late = f"{database}.dated", date(2023, 1, 1), date(2025, 1, 1)
    table(spark).write.saveAsTable(name)
    first = table(spark, ("a", D, 1), ("b", date(2024, 9, 1), 2), (None, D, 3), ("z", None, 4))
    assert "Join" not in plan_of(merge.rows_to_append(spark.table(name), first, ["k", "d"]))
    merge.merge_into_table(spark, name, first, ["k", "d"])
    second = [("a", D, 9), ("b", date(2024, 9, 1), 9), ("b", D, 5), ("a", early, 6), ("a", late, 7), ("a", late, 7), (None, D, 8), ("z", None, 9)]
    new = merge.rows_to_append(spark.table(name), table(spark, *second), ["k", "d"])
    assert "Union" in plan_of(new) and plan_of(new).count("SortMergeJoin") == 1
    assert rows(new) == rows(table(spark, *second[2:]))
    merge.merge_into_table(spark, name, table(spark, *second), ["k", "d"])
    assert spark.table(name).count() == 10


def test_conditional_update_keeps_types_and_null_conditions(spark):
    df = spark.createDataFrame(
        [(Decimal("10.00"), "Mountain Bikes"), (Decimal("10.00"), None)],
        "ListPrice decimal(12,2), Category string",
    )
    done = merge.conditional_update(
        df, F.col("Category") == "Mountain Bikes", {"ListPrice": F.col("ListPrice") * 0.9}
    )
    assert done.schema == df.schema
    assert rows(done) == [
        (Decimal("10.00"), None),
        (Decimal("9.00"), "Mountain Bikes"),
    ]


def test_hot_key_is_split_in_shuffled_join(spark, conf):
    """A third of the rows share a key, and a third of the table another one."""
    conf(
        spark__sql__shuffle__partitions="32",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
    )
    n = 120_000
    ids = spark.range(n, numPartitions=8)
    third = F.col("id") % 3 == 0
    hot = F.when(third, F.lit("hot"))
    own = F.concat(F.lit("k"), F.col("id"))
    big = ids.select(hot.otherwise(own).alias("k"), F.sha2(own, 256).alias("pad"))
    known = ids.select(
        F.when(third, F.lit("other")).otherwise(own).alias("k"), F.lit(1).alias("x")
    )
    missing = joins.rows_without_match(big, known, ["k"])
    assert missing.where("k = 'hot'").count() == n // 3
    assert len(missing.collect()) == n // 3
    assert "skew=true" in missing._jdf.queryExecution().executedPlan().toString()

    dimension = known.where("k <> 'other'")
    joined = joins.lookup(big, dimension, ["k"], ["x"])
    assert len(joined.collect()) == n
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_dense_numbers_over_many_partitions(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = spark.range(10_000, numPartitions=7).select(
        F.sha2(F.col("id").cast("string"), 256).alias("k")
    )
    numbered = keys.dense_row_numbers(df, ["k"], "n")
    got = numbered.orderBy("k").collect()
    assert [r.n for r in got] == list(range(1, 10_001))
    assert numbered.columns == ["k", "n"]


def test_new_members_get_keys_above_the_old(spark):
    members = spark.createDataFrame(
        [("b", "x"), ("a", "x"), ("c", None), ("z", "x")], "name string, mail string"
    )
    old = spark.createDataFrame([("z", "x", 41)], "name string, mail string, id bigint")
    fresh = keys.key_new_members(members, old, ["name", "mail"], "id")
    assert rows(fresh) == [("a", "x", 42), ("b", "x", 43), ("c", None, 44)]
    assert fresh.columns == ["name", "mail", "id"]
    empty = old.where("false")
    assert {r.id for r in keys.key_new_members(members, empty, ["name", "mail"], "id").collect()} == {
        1,
        2,
        3,
        4,
    }


@pytest.fixture
def log(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "log"), "id int, v string", ["id"])
    frame = lambda *r: spark.createDataFrame(list(r), "id int, v string")
    log.commit(0, "WRITE", {"insert": frame((1, "a"), (2, "b"), (3, "c"))})
    log.update(1, F.col("id") == 2, {"v": F.lit("B")})
    log.merge(2, frame((4, "d"), (3, "C")), when_matched={"v": "u.v"})
    log.commit(3, "REVISION", {"delete": frame((1, "a")), "update": frame((4, "D"))})
    log.merge(4, frame((1, "again"), (2, "kept")))
    log.merge(5, frame((1, "same")))
    return log


def test_versions(log):
    assert rows(log.as_of(0)) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(log.as_of(1)) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(log.as_of(2)) == [(1, "a"), (2, "B"), (3, "C"), (4, "d")]
    assert rows(log.as_of(3)) == [(2, "B"), (3, "C"), (4, "D")]
    assert rows(log.as_of(4)) == [(1, "again"), (2, "B"), (3, "C"), (4, "D")] == rows(log.as_of(5))


def test_a_read_starts_at_a_snapshot(spark, tmp_path):
    """Many versions, a snapshot every three: one snapshot and the versions after it are read."""
    path = tmp_path / "log"
    log = ChangeLog(spark, str(path), "id int, v int", ["id"], snapshot_every=3)
    plain = ChangeLog(spark, str(tmp_path / "plain"), "id int, v int", ["id"])
    state = dict.fromkeys([None, *range(20)], 0)
    states = {}
    for version in range(9):
        if version == 0:
            changes = {"insert": list(state.items())}
        else:
            new, gone, moved = 100 + version, version + 1 if version < 19 else None, version % 20
            changes = {"insert": [(new, version)], "delete": [(gone, 0)] if gone in state and gone is not None else []}
            if moved in state and moved != gone:
                changes["update"] = [(moved, version)]
        frames = {k: spark.createDataFrame(r, "id int, v int").coalesce(1) for k, r in changes.items() if r}
        log.commit(version, "W", frames)
        if version <= 4:
            plain.commit(version, "W", frames)
        for k, v in changes.get("insert", []) + changes.get("update", []):
            state[k] = v
        for k, _ in changes.get("delete", []):
            state.pop(k, None)
        states[version] = sorted(state.items(), key=str)
    assert log.snapshots() == [3, 6]
    for version in (0, 2, 3, 5, 8):
        assert sorted((tuple(r) for r in log.as_of(version).collect()), key=str) == states[version]
    assert rows(plain.as_of(4)) == rows(log.as_of(4))
    read = log.as_of(8)
    assert {f.split("_version=")[1][0] for f in read.inputFiles() if "/snapshots/" in f} == {"6"}
    scans = [x for x in read._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x and "_change:string" in x]
    assert scans and all(re.search(rf"{VERSION}#\d+ > 6\), \({VERSION}#\d+ <= 8", s) for s in scans)


def test_an_unmarked_snapshot_is_not_read(spark, tmp_path):
    """A crash after the snapshot and before its mark, then another try."""
    log = ChangeLog(spark, str(tmp_path / "log"), "id int, v string", ["id"])
    log.commit(0, "WRITE", {"insert": spark.createDataFrame([(1, "a")], "id int, v string")})
    log.update(1, F.lit(True), {"v": F.lit("b")})
    wrong = spark.createDataFrame([(9, "half")], "id int, v string")
    wrong.write.parquet(f"{log.path}/snapshots/_version=1")
    assert log.snapshots() == [] and rows(log.as_of(1)) == [(1, "b")]
    for _ in range(2):
        log.snapshot(1)
        assert log.snapshots() == [1] and rows(log.as_of(1)) == [(1, "b")]
    assert rows(log.as_of(0)) == [(1, "a")]


def test_history_and_repeated_commit(spark, log):
    log.commit(1, "UPDATE", {"update": spark.createDataFrame([(2, "B")], "id int, v string")})
    assert rows(log.history()) == [
        (0, "WRITE", 3, 0, 0),
        (1, "UPDATE", 0, 1, 0),
        (2, "MERGE", 1, 1, 0),
        (3, "REVISION", 0, 1, 1),
        (4, "MERGE", 1, 0, 0),
        (5, "MERGE", 0, 0, 0),
    ]
    with pytest.raises(ValueError, match="upsert"):
        log.commit(6, "MERGE", {"upsert": log.as_of(0)})


def test_as_of_prunes_versions(log):
    plan = log.as_of(1)._jdf.queryExecution().toString()
    assert "(_version#" in plan and "PartitionFilters: [isnotnull(_version" in plan
