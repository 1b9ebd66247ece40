"""End-to-end jobs and the registered queries against their SQL."""

from datetime import date

import pytest

import __spark_entry__
from tests.conftest import rows
from tidemark.checks import compare, oracles, queries
from tidemark.plans import medallion
from tidemark.schemas import ORDERS_CSV
from tidemark.session import build_session

SMALL = "/root/testdata/sf0.001"

FIRST = """SO1,1,2019-07-31,Ada Lane,ada@example.com,"Trail-9 Blue, 48",1,100.0,8.0
SO1,2,2019-07-31,Ada Lane,ada@example.com,Pump,2,10.0,1.6
SO2,1,2020-02-01,,none@example.com,"Trail-9 Blue, 48",1,100.0,8.0
SO3,1,2021-05-05,Ben Van Dyk,ben@example.com,"Sock, ",3,5.0,1.2
SO3,1,2021-05-05,Ben Van Dyk,ben@example.com,"Sock, ",3,5.0,1.2
"""
SECOND = """SO4,1,2021-06-01,Cy Ng,cy@example.com,Pump,1,10.0,0.8
SO5,1,2021-06-02,Dee Ox,,Pump,1,10.0,0.8
"""


def counts(tables):
    return {name: df.count() for name, df in tables.items()}


def test_medallion_runs(spark, database, tmp_path):
    (tmp_path / "1.csv").write_text(FIRST)
    first = counts(medallion.run(spark, f"{tmp_path}/*.csv", database))
    assert first == {
        "sales_silver": 5, "dimdate_gold": 3, "dimcustomer_gold": 3, "dimproduct_gold": 3,
        "factsales_gold": 5,
    }
    old = rows(spark.table(f"{database}.dimcustomer_gold"))
    assert counts(medallion.run(spark, f"{tmp_path}/*.csv", database)) == first

    (tmp_path / "2.csv").write_text(SECOND)
    medallion.run(spark, f"{tmp_path}/*.csv", database)
    customers = spark.table(f"{database}.dimcustomer_gold")
    assert set(old) < set(rows(customers))
    ids = [r.CustomerID for r in customers.collect()]
    assert len(set(ids)) == len(ids) == 5
    new = {r.CustomerName: r.CustomerID for r in customers.where("CustomerID > 3").collect()}
    assert set(new) == {"Cy Ng", "Dee Ox"}
    fact = spark.table(f"{database}.factsales_gold")
    assert fact.count() == 7 and fact.where("CustomerID is null").count() == 1
    # A null e-mail finds no customer, so its line and member come again with each run.
    again = counts(medallion.run(spark, f"{tmp_path}/*.csv", database))
    assert again["factsales_gold"] == 8 and again["sales_silver"] == 7
    silver = spark.table(f"{database}.sales_silver")
    assert silver.where("CustomerName = 'Unknown'").count() == 1
    assert silver.where("FileName like '%1.csv'").count() == 5
    assert silver.where("IsFlagged").count() == 2


def test_two_runs_write_both_deliveries_from_one_pass(spark, monkeypatch):
    made = []

    def sales(spark, sf):
        """Four lines, one of them without a date; each pass over them is counted."""
        days = ["1995-02-01", "1999-02-01", "1999-02-01", None]
        data = [(f"SO{i}", 1, d and date.fromisoformat(d), f"N {i}", f"{i}@x", "Pump", 1, 1.0, 0.1) for i, d in enumerate(days)]
        seen = spark.sparkContext.accumulator(0)
        made.append(seen)

        def count(batches):
            for batch in batches:
                seen.add(len(batch))
                yield batch

        return spark.createDataFrame(data, ORDERS_CSV).mapInPandas(count, ORDERS_CSV)

    monkeypatch.setattr(queries.td, "sales", sales)
    for name in ("medallion_second_run", "medallion_totals"):
        found = queries.registered()[name](spark, SMALL).collect()
        assert sum(seen.value for seen in made) == 4, name
        made.clear()
        if name == "medallion_totals":
            assert sorted((r.Year, r.line_count, r.quantity, r.buyers) for r in found) == [(1995, 1, 1, 1), (1999, 2, 2, 2)]
        else:
            assert {r.table_name: r.row_count for r in found}["sales_silver"] == 3


def test_gold_totals_count_a_shared_email_once(spark):
    day = date(2020, 1, 1)
    tables = {
        "dimcustomer_gold": spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "CustomerID long, Email string"),
        "dimproduct_gold": spark.createDataFrame([(1, "Pump"), (2, "Pump")], "ItemID long, ItemName string"),
        "dimdate_gold": spark.createDataFrame([(day, 2020)], "OrderDate date, Year int"),
        "factsales_gold": spark.createDataFrame(
            [(c, i, day, 2) for c, i in ((1, 1), (1, 2), (2, 1), (3, 1), (3, 1), (4, 2), (None, 1))],
            "CustomerID long, ItemID long, OrderDate date, Quantity int",
        ),
    }
    totals = queries._gold_totals(tables)
    assert rows(totals) == [(2020, "Pump", 6, 12, 2)]
    assert totals.columns == ["Year", "ItemName", "line_count", "quantity", "buyers"]


@pytest.fixture(scope="module")
def sql():
    return compare.sql_connection(SMALL)


@pytest.mark.parametrize("name", sorted(queries.registered()))
def test_query_equals_sql(spark, sql, name):
    difference = compare.compare(spark, sql, SMALL, name)
    if name == "series_alert" and difference == "both results are empty":
        return  # the smallest data set never reaches the threshold
    assert difference == ""


def test_every_query_has_sql():
    assert set(oracles.oracle_sql()) == set(queries.registered())


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["OrderYear", "GrossRevenue"]


@pytest.mark.parametrize(
    "name", sorted(set(queries.registered()) - {n for n in queries.registered() if n.startswith("stream_")})
)
def test_plans_have_no_cross_join(spark, name):
    if name.startswith(("medallion", "shop_build", "load_", "table_", "copy_", "typed_m", "sales_p")):
        pytest.skip("writes tables; its plan is a scan of them")
    plan = queries.registered()[name](spark, SMALL)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scans_are_pruned(spark):
    plan = queries.registered()["yearly_revenue"](spark, SMALL)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice" in plan
    assert "o_totalprice" not in plan.split("== Physical Plan ==")[1]


def test_session_settings(spark):
    assert build_session() is not None
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
