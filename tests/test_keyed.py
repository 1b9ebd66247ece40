"""Keyed tables, their feed of added rows, and the layers built from it."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_jobs import FIRST, SECOND
from tidemark.operators import keyed
from tidemark.operators.keyed import KeyedTable
from tidemark.plans import medallion, medallion_feed

SCHEMA = "id long, day date, note string"


@pytest.fixture(autouse=True)
def few_partitions(conf):
    conf(spark__sql__shuffle__partitions="2")


def lines(spark, *records):
    return spark.createDataFrame([(i, d and date.fromisoformat(d), n) for i, d, n in records], SCHEMA)


@pytest.fixture
def table(spark, database):
    return KeyedTable(spark, f"{database}.lines", SCHEMA, ["id", "day"], "day", 4).create_if_absent()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_merge_adds_new_keys_and_all_copies_of_them(spark, table):
    assert table.position() == 0 and rows(table.rows()) == []
    table.merge(lines(spark, (1, "2024-01-05", "a"), (2, "2024-02-05", "b"), (None, None, "n")), 1)
    table.merge(lines(spark, (1, "2024-01-05", "x"), (1, "2024-02-05", "c"), (3, "2024-01-09", "d"), (3, "2024-01-09", "d"), (None, None, "n")), 2)
    table.merge(lines(spark), 3)
    assert table.position() == 3
    assert sorted(r.note for r in table.rows().collect()) == ["a", "b", "c", "d", "d", "n", "n"]
    assert sorted(r.note for r in table.changes(1, 2).collect()) == ["c", "d", "d", "n"]
    assert rows(table.changes(2, 3)) == []
    assert table.rows().columns == ["id", "day", "note"]


def test_a_failed_batch_is_invisible_and_tried_again(spark, table):
    table.merge(lines(spark, (1, "2024-01-05", "a")), 1)
    second = lines(spark, (1, "2024-01-05", "a"), (2, "2024-01-06", "b"), (None, "2024-01-06", "n"))
    half = table.missing(second, 2)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    half.where("id = 2").write.mode("overwrite").insertInto(table.name)  # and then it stops
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    assert table.position() == 1 and table.rows().count() == 1
    for _ in range(2):
        table.merge(second, 2)
        assert sorted(r.note for r in table.rows().collect()) == ["a", "b", "n"]


def test_a_merge_neither_shuffles_the_table_nor_reads_other_months(spark, table, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    table.merge(lines(spark, *[(i, f"2024-{1 + i % 12:02d}-05", "a") for i in range(200)]), 1)
    plan = plan_of(table.missing(lines(spark, (1, "2024-02-05", "x"), (900, "2024-03-05", "y")), 2))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "Bucketed: true" in scan and "SelectedBucketsCount: 4 out of 4" in plan
    assert "_period#" in scan and re.search(r"_period#\d+ IN \(202402,202403\)", scan)
    assert "note" not in scan.split("ReadSchema")[1]
    # One exchange, of the delivered rows; the branch of the table has none.
    assert plan.count("Exchange hashpartitioning") == 1
    depth = plan.splitlines().index(next(x for x in plan.splitlines() if "FileScan" in x))
    above = [x for x in plan.splitlines()[:depth] if "Exchange" in x]
    assert len(above) == 1 and table.missing(lines(spark, (1, "2024-02-05", "x")), 2).count() == 0


def test_a_large_merge_is_not_held_to_the_buckets(spark, table, conf, monkeypatch):
    """Beyond the rows of a bucket both sides are shuffled to the session's partitions."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="16")
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 20)
    table.merge(lines(spark, *[(i, "2024-01-05", "a") for i in range(80)], (None, None, "n")), 1)
    second = lines(spark, *[(i, "2024-01-05", "b") for i in range(40, 120)], (None, None, "m"))
    plan = plan_of(table.missing(second, 2))
    assert "Bucketed: true" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert re.search(r"Exchange hashpartitioning\([^)]*, 16\)", plan)
    table.merge(second, 2)
    assert sorted(r.id for r in table.changes(1, 2).collect() if r.id is not None) == [*range(80, 120)]
    assert table.rows().count() == 122


def test_the_first_batch_meets_no_join(spark, table):
    assert "Join" not in plan_of(table.missing(lines(spark, (1, "2024-01-05", "a")), 1))


def test_joins_with_a_dimension_have_more_tasks_than_its_bucket(spark, database, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="16")
    names = KeyedTable(spark, f"{database}.names", "id long, note string", ["id"], None, 1)
    names.create_if_absent().merge(spark.range(50).withColumn("note", F.lit("a")), 1)
    found = spark.range(100).join(names.rows(), "id", "left")
    assert "Bucketed: true" not in plan_of(found)
    assert re.search(r"Exchange hashpartitioning\([^)]*, 16\)", plan_of(found))
    assert found.where("note = 'a'").count() == 50
    again = names.missing(spark.range(100).withColumn("note", F.lit("b")), 2)
    assert re.search(r"Exchange hashpartitioning\([^)]*, 16\)", plan_of(again))
    assert again.count() == 50


def test_the_feed_reads_the_new_batch_only(spark, table):
    table.merge(lines(spark, *[(i, "2024-01-05", "a") for i in range(50)]), 1)
    table.merge(lines(spark, (100, "2024-01-05", "b"), (101, "2024-02-05", "b")), 2)
    added = table.changes(1, 2)
    assert added.count() == 2
    assert {f.split("_batch=")[1].split("/")[0] for f in added.inputFiles()} == {"2"}
    assert "PartitionFilters: [isnotnull(_batch" in plan_of(added)


def counts(found):
    return {name: table.rows().count() for name, table in found.items()}


def test_gold_follows_the_deliveries(spark, database, tmp_path):
    first, second = tmp_path / "first", tmp_path / "second"
    for folder, text in ((first, FIRST), (second, FIRST + SECOND)):
        folder.mkdir()
        (folder / "sales.csv").write_text(text)
    found = medallion_feed.run(spark, f"{first}/*.csv", database, buckets=2)
    assert counts(found) == {
        "sales_silver": 5, "dimdate_gold": 3, "dimcustomer_gold": 3, "dimproduct_gold": 3,
        "factsales_gold": 5,
    }
    old = rows(found["dimcustomer_gold"].rows())
    medallion_feed.run(spark, f"{second}/*.csv", database, buckets=2)
    assert counts(found) == {
        "sales_silver": 7, "dimdate_gold": 5, "dimcustomer_gold": 5, "dimproduct_gold": 3,
        "factsales_gold": 7,
    }
    customers = found["dimcustomer_gold"].rows()
    assert set(old) < set(rows(customers))
    ids = [r.CustomerID for r in customers.collect()]
    assert sorted(ids) == [1, 2, 3, 4, 5]
    assert found["sales_silver"].position(medallion_feed.GOLD) == 2
    before = counts(found)
    medallion_feed.run(spark, f"{second}/*.csv", database, buckets=2)
    assert counts(found) == before  # the same files again add nothing


def test_gold_equals_a_full_run(spark, database, tmp_path):
    from tidemark.session import scratch_database

    (tmp_path / "1.csv").write_text(FIRST + SECOND)
    fed = medallion_feed.run(spark, f"{tmp_path}/*.csv", database, buckets=2)
    full = medallion.run(spark, f"{tmp_path}/*.csv", scratch_database(spark, "full"))
    for name, frame in full.items():
        assert rows(fed[name].rows()) == rows(frame.select(fed[name].columns)), name


def test_gold_starts_again_after_a_failure(spark, database, tmp_path, monkeypatch):
    """Customers are in, the facts are not: the next run leaves one of each."""
    (tmp_path / "1.csv").write_text(FIRST + SECOND)
    original = medallion_feed.fact_sales
    monkeypatch.setattr(medallion_feed, "fact_sales", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        medallion_feed.run(spark, f"{tmp_path}/*.csv", database, buckets=2)
    monkeypatch.setattr(medallion_feed, "fact_sales", original)
    found = medallion_feed.tables(spark, database, 2)
    assert medallion_feed.to_gold(found) == 1
    assert counts(found)["dimcustomer_gold"] == 5 and counts(found)["factsales_gold"] == 7
    facts = found["factsales_gold"].rows()
    assert facts.where(F.col("CustomerID").isNull()).count() == 1
    assert medallion_feed.to_gold(found) == 1 and facts.count() == 7
