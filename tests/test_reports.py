from datetime import date
from decimal import Decimal

import pytest

from tests.conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import aggregates, cleaning, dimensions, quality, star
from tidemark.plans import reports, sales, shop, warehouse


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(
        [
            ("SO1", 1, date(2019, 7, 31), "Ada Lane", "ada@x", "Trail-9 Blue, 48", 1, 100.0, 8.0),
            ("SO1", 2, date(2019, 8, 1), "Ada Lane", "ada@x", "Pump", 2, 10.0, 1.6),
            ("SO2", 1, date(2020, 2, 1), "", "none@x", "Trail-9 Blue, 48", 1, 100.0, 8.0),
            ("SO3", 1, date(2021, 5, 5), "Ben Van Dyk", "ben@x", "Sock, ", 3, 5.0, 1.2),
            ("SO3", 1, date(2021, 5, 5), "Ben Van Dyk", "ben@x", "Sock, ", 3, 5.0, 1.2),
            ("SO4", 1, None, None, None, "Pump", 1, 10.0, 0.8),
        ],
        "SalesOrderNumber string, SalesOrderLineNumber int, OrderDate date, CustomerName string, "
        "Email string, Item string, Quantity int, UnitPrice double, Tax double",
    )


def test_clean_sales(orders):
    cleaned = cleaning.clean_sales(orders, "2019-08-01")
    assert rows(cleaned.select("SalesOrderNumber", "CustomerName", "IsFlagged").distinct()) == [
        ("SO1", "Ada Lane", False),
        ("SO1", "Ada Lane", True),
        ("SO2", "Unknown", False),
        ("SO3", "Ben Van Dyk", False),
        ("SO4", "Unknown", False),
    ]


def test_provenance(spark, tmp_path, orders):
    orders.coalesce(1).write.parquet(str(tmp_path / "p"))
    df = cleaning.with_provenance(spark.read.parquet(str(tmp_path / "p")))
    first = df.first()
    assert first.FileName.startswith("file:") and first.FileName.endswith(".parquet")
    assert dict(df.dtypes)["CreatedTS"] == "date" and first.CreatedTS == first.ModifiedTS


def test_filters(orders):
    assert cleaning.where_in(orders, {"Item": [], "Email": None}).count() == 6
    assert cleaning.where_in(orders, {"Item": ["Pump"], "Email": ["ada@x"]}).count() == 1
    between = cleaning.where_between(orders, "OrderDate", "2019-07-31", "2020-02-01")
    assert between.count() == 3  # both ends count, null does not


def test_yearly_reports(orders):
    assert [tuple(r) for r in sales.yearly_orders(orders).collect()] == [
        (None, 1), (2019, 2), (2020, 1), (2021, 2),
    ]
    assert [tuple(r) for r in sales.yearly_revenue_and_orders(orders).collect()] == [
        (None, Decimal("10.80"), 1),
        ("2019", Decimal("129.60"), 1),
        ("2020", Decimal("108.00"), 1),
        ("2021", Decimal("32.40"), 1),
    ]


def test_customers(orders):
    assert sales.distinct_customers(orders).count() == 4
    assert rows(sales.distinct_customers(orders, "Trail-9 Blue, 48")) == [
        ("", "none@x"), ("Ada Lane", "ada@x"),
    ]
    assert rows(aggregates.row_counts(orders, ["CustomerName", "Email"])) == [(6, 4)]
    assert rows(aggregates.row_counts(orders.where("false"), ["Email"])) == [(0, 0)]


def test_sum_numeric_takes_all_numbers(orders):
    totals = aggregates.sum_numeric(orders.select("Item", "Quantity", "UnitPrice"), ["Item"])
    assert totals.columns == ["Item", "sum_Quantity", "sum_UnitPrice"]
    assert ("Pump", 3, 20.0) in rows(totals)


def test_transform_orders(orders):
    shaped = cleaning.transform_orders(orders)
    assert shaped.columns[3:7] == ["Year", "Month", "FirstName", "LastName"]
    assert ("Ben", "Van", 2021, 5) in rows(
        shaped.select("FirstName", "LastName", "Year", "Month")
    )


def test_categories(spark):
    products = spark.createDataFrame(
        [("A", 1.0), ("A", 3.0), ("B", 5.0), ("C", 2.0)], "Category string, ListPrice double"
    )
    stats = sales.category_stats(products)
    assert ("A", 2, 1.0, 3.0, 2.0) in rows(stats)
    assert [tuple(r) for r in sales.largest_categories(stats, 2).collect()] == [("A", 2), ("B", 1)]
    assert [r.Category for r in sales.dearest_categories(stats, 3).collect()] == ["B", "A", "C"]


def test_dimensions(orders):
    assert rows(dimensions.date_dimension(orders))[0][:4] == (date(2019, 7, 31), 31, 7, 2019)
    assert (date(2021, 5, 5), 5, 5, 2021, "May-2021", "202105") in rows(
        dimensions.date_dimension(orders)
    )
    assert ("Ben Van Dyk", "ben@x", "Ben", "Van") in rows(dimensions.customer_dimension(orders))
    assert ("Sock, ", "Sock", "") in rows(dimensions.product_dimension(orders))
    week = dimensions.warehouse_date_dimension(orders.where("OrderDate is not null"), "OrderDate")
    assert (20210505, date(2021, 5, 5), 4, "Wednesday", 5, 5, "May", 2021) in rows(week)


def test_fact_keys_and_missing_members(spark, orders):
    customers = spark.createDataFrame(
        [("Ada Lane", "ada@x", 1), ("Ben Van Dyk", "ben@x", 2)],
        "CustomerName string, Email string, CustomerID bigint",
    )
    products = spark.createDataFrame(
        [("Pump", "", 1), ("Trail-9 Blue", "48", 2), ("Sock", "", 3)],
        "ItemName string, ItemInfo string, ItemID bigint",
    )
    fact = star.fact_sales(orders, customers, products)
    assert rows(fact.select("CustomerID", "ItemID")) == [
        (1, 1), (1, 2), (2, 3), (2, 3), (None, 1), (None, 2),
    ]


def test_items_that_split_alike_are_one_product(spark):
    items = ["Pump", "Pump, ", "A, B, C", "A, B, D", None]
    lines = spark.createDataFrame(
        [(item, "Ada Lane", "ada@x", date(2021, 5, 5), 1, 1.0, 0.1) for item in items],
        "Item string, CustomerName string, Email string, OrderDate date, Quantity int,"
        " UnitPrice double, Tax double",
    )
    members = dimensions.product_dimension(lines)
    keyed = members.withColumn("ItemID", F.xxhash64("ItemName", "ItemInfo"))
    customers = lines.select("CustomerName", "Email").distinct().withColumn("CustomerID", F.lit(1))
    assert rows(members.select("ItemName", "ItemInfo")) == [("A", "B"), (None, ""), ("Pump", "")]
    fact = star.fact_sales(lines, customers, keyed)
    assert fact.count() == len(items)
    assert fact.where("ItemID IS NULL").count() == 1


def test_star_measures_match_the_plain_join(spark):
    fact = spark.createDataFrame(
        [(1, 1, 10), (1, 2, 20), (2, 1, 30), (9, 1, 40)], "p int, c int, q int"
    )
    p = spark.createDataFrame([(1, "red"), (2, "blue")], "p int, colour string")
    c = spark.createDataFrame([(1, "N"), (2, "S")], "c int, region string")
    relations = [star.Relation("p", "P", "p"), star.Relation("c", "C", "c")]
    by_colour = star.measures_by(
        fact, {"P": p, "C": c}, relations, {"P": ["colour"]}, {"q": "sum", "c": "count"}
    )
    assert rows(by_colour) == [("blue", 30, 1), ("red", 30, 2), (None, 40, 1)] or rows(
        by_colour
    ) == [(None, 40, 1), ("blue", 30, 1), ("red", 30, 2)]
    both = star.measures_by(
        fact, {"P": p, "C": c}, relations, {"P": ["colour"], "C": ["region"]}, {"q": "sum"}
    )
    assert ("red", "N", 10) in rows(both) and (None, "N", 40) in rows(both)
    wide = star.expand(fact, {"P": p, "C": c}, relations, {"C": ["region"]})
    assert wide.columns == ["p", "c", "q", "region"]


def test_sales_by_region_drops_unknown_keys(spark):
    fact = spark.createDataFrame(
        [(20240101, 1, Decimal(5)), (20240101, 1, Decimal(6)), (20240102, 7, Decimal(9))],
        "SalesOrderDateKey int, CustomerKey int, SalesTotal decimal(18,0)",
    )
    dates = spark.createDataFrame(
        [(20240101, 2024, 1, "January")], "DateKey int, Year int, Month int, MonthName string"
    )
    customers = spark.createDataFrame([(1, "North")], "CustomerKey int, CountryRegion string")
    assert rows(warehouse.sales_by_region(fact, dates, customers)) == [
        (2024, 1, "January", "North", Decimal(11))
    ]


# --- trading ------------------------------------------------------------------


@pytest.fixture(scope="module")
def trading(spark):
    return {
        "products": spark.createDataFrame(
            [(1, "Tea", 18.0, 1), (2, "Jam", 81.0, 2), (3, "Salt", 5.0, 1)],
            "ProductID int, ProductName string, UnitPrice double, CategoryID int",
        ),
        "categories": spark.createDataFrame(
            [(1, "Drinks"), (2, "Spreads")], "CategoryID int, CategoryName string"
        ),
        "details": spark.createDataFrame(
            [(10, 1, 18.0, 2, 0.29), (10, 2, 81.0, 1, 0.0), (11, 1, 0.05, 1, 0.1)],
            "OrderID int, ProductID int, UnitPrice double, Quantity int, Discount double",
        ),
        "orders": spark.createDataFrame(
            [
                (10, 7, 1, date(1998, 1, 2), date(1998, 2, 2), date(1998, 1, 31)),
                (11, 7, 2, date(1997, 1, 2), date(1997, 2, 2), None),
            ],
            "OrderID int, CustomerID int, EmployeeID int, OrderDate date, RequiredDate date, "
            "ShippedDate date",
        ),
        "customers": spark.createDataFrame([(7,), (8,)], "CustomerID int"),
        "employees": spark.createDataFrame(
            [(1, "Lane", "Ada", "UK")],
            "EmployeeID int, LastName string, FirstName string, Country string",
        ),
    }


def test_customer_order_history(trading):
    tables = [trading[n] for n in ("products", "details", "orders", "customers")]
    assert rows(reports.customer_order_history(*tables, customer_id=7)) == [("Jam", 1), ("Tea", 3)]
    assert reports.customer_order_history(*tables, customer_id=8).count() == 0
    assert rows(reports.customer_order_history(*tables)) == [(7, "Jam", 1), (7, "Tea", 3)]


def test_order_details(trading):
    got = rows(reports.order_details(trading["products"], trading["details"], 10))
    assert got == [("Jam", 81.0, 1, 0, Decimal("81.00")), ("Tea", 18.0, 2, 29, Decimal("25.56"))]
    # 0.05 * 0.9 = 0.045 is a tie and rounds up
    assert rows(reports.order_details(trading["products"], trading["details"], 11)) == [
        ("Tea", 0.05, 1, 10, Decimal("0.05"))
    ]


def test_shipping_reports(trading):
    args = (trading["orders"], trading["details"])
    assert rows(reports.sales_by_year(*args, "1998-01-31", "1998-01-31")) == [
        (date(1998, 1, 31), 10, Decimal("106.5600"), "1998")
    ]
    assert reports.sales_by_year(*args, "1998-02-01", "1999-01-01").count() == 0
    assert rows(reports.employee_sales(trading["employees"], *args, "1998-01-01", "1998-12-31")) == [
        ("UK", "Lane", "Ada", date(1998, 1, 31), 10, Decimal("106.5600"))
    ]
    assert [r.OrderID for r in reports.customer_orders(trading["orders"], 7).collect()] == [10, 11]


def test_sales_by_category_and_default_year(trading):
    tables = [trading[n] for n in ("details", "orders", "products", "categories")]
    assert rows(reports.sales_by_category(*tables, "Drinks", "1998")) == [("Tea", Decimal("26"))]
    assert rows(reports.sales_by_category(*tables, "Drinks", "2015")) == [("Tea", Decimal("26"))]
    assert rows(reports.sales_by_category(*tables, "Drinks", "1997")) == [("Tea", Decimal("0"))]


def test_most_expensive(trading):
    assert [tuple(r) for r in reports.most_expensive_products(trading["products"], 2).collect()] == [
        ("Jam", 81.0), ("Tea", 18.0),
    ]


# --- shop -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def seeds(spark):
    return (
        spark.createDataFrame(
            [(1, "Ada", "L"), (2, "Ben", "D"), (3, "Cy", "E")],
            "id int, first_name string, last_name string",
        ),
        spark.createDataFrame(
            [
                (10, 1, date(2018, 1, 1), "completed"),
                (11, 1, date(2018, 2, 1), "lost"),
                (12, 2, date(2018, 3, 1), "placed"),
                (12, 2, date(2018, 3, 2), "placed"),
                (None, 2, date(2018, 4, 1), "placed"),
            ],
            "id int, user_id int, order_date date, status string",
        ),
        spark.createDataFrame(
            [
                (1, 10, "credit_card", 1000),
                (2, 10, "coupon", 250),
                (3, 11, "gift_card", 0),
                (4, 99, "bank_transfer", 700),
            ],
            "id int, order_id int, payment_method string, amount int",
        ),
    )


def staged(seeds):
    return (
        shop.stage_customers(seeds[0]),
        shop.stage_orders(seeds[1]),
        shop.stage_payments(seeds[2]),
    )


def test_customer_mart(seeds):
    assert rows(shop.customer_mart(*staged(seeds))) == [
        (1, "Ada", "L", date(2018, 1, 1), date(2018, 2, 1), 2, Decimal("12.50")),
        (2, "Ben", "D", date(2018, 3, 1), date(2018, 4, 1), 2, None),
        (3, "Cy", "E", None, None, None, None),
    ]


def test_payments_by_customer_has_a_null_group(seeds):
    _, orders, payments = staged(seeds)
    assert rows(shop.payments_by_customer(orders, payments)) == [
        (1, Decimal("12.50")),
        (None, Decimal("7.00")),
    ]


def test_order_mart(seeds):
    _, orders, payments = staged(seeds)
    mart = shop.order_mart(orders, payments)
    assert mart.columns[4:] == [
        "credit_card_amount", "coupon_amount", "bank_transfer_amount", "gift_card_amount", "amount",
    ]
    zero = Decimal("0.00")
    assert (10, 1, date(2018, 1, 1), "completed", Decimal("10.00"), Decimal("2.50"), zero, zero,
            Decimal("12.50")) in rows(mart)
    assert mart.where("amount is null").count() == 3


def test_build_reports_failures(spark, seeds, database):
    results = {
        (r.table_name, r.test_name, r.column_name): (r.failures, r.passed)
        for r in shop.build(spark, *seeds, database).collect()
    }
    assert results["stg_orders", "unique", "order_id"] == (1, False)
    assert results["stg_orders", "not_null", "order_id"] == (1, False)
    assert results["stg_orders", "accepted_values", "status"] == (1, False)
    assert results["stg_payments", "accepted_values", "payment_method"] == (0, True)
    assert results["orders", "not_null", "amount"] == (3, False)
    assert results["orders", "relationships", "customer_id"] == (0, True)
    assert len(results) == 20
    assert spark.catalog.tableExists(f"{database}.customers")


def test_seed_files(spark, tmp_path):
    (tmp_path / "raw_customers.csv").write_text("id,first_name,last_name\n1,Ada,L\n")
    (tmp_path / "raw_orders.csv").write_text("id,user_id,order_date,status\n10,1,2018-01-01,placed\n")
    (tmp_path / "raw_payments.csv").write_text("id,order_id,payment_method,amount\n1,10,coupon,250\n")
    customers, orders, payments = shop.read_seeds(spark, str(tmp_path))
    mart = shop.customer_mart(*staged((customers, orders, payments)))
    assert rows(mart) == [
        (1, "Ada", "L", date(2018, 1, 1), date(2018, 1, 1), 1, Decimal("2.50"))
    ]


def test_relationships_counts_rows_and_skips_null(spark):
    child = spark.createDataFrame([(1,), (5,), (5,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(quality.relationships(child, "t", "k", parent, "k")) == [
        ("t", "relationships", "k", 2)
    ]


def test_table_checks_come_from_one_scan(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a", None), (1, "b", 2.0), (None, "z", None), (3, None, 1.0)],
        "k int, kind string, x double",
    )
    df.write.parquet(str(tmp_path / "t"))
    check = quality.Check
    done = quality.table_checks(
        spark.read.parquet(str(tmp_path / "t")),
        "t",
        [
            check("unique", "k"),
            check("not_null", "k"),
            check("not_null", "x"),
            check("accepted_values", "kind", ["a", "b"]),
        ],
    )
    assert done._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [tuple(r) for r in done.collect()] == [
        ("t", "unique", "k", 1),
        ("t", "not_null", "k", 1),
        ("t", "not_null", "x", 2),
        ("t", "accepted_values", "kind", 1),
    ]
    assert [r.failures for r in quality.table_checks(df.where("false"), "t", [check("not_null", "k")]).collect()] == [0]


def exchanges(df):
    """Hash exchanges of a plan."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_big_sides_are_shuffled_once(spark, conf, trading, seeds):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
    )
    _, orders, payments = staged(seeds)
    assert exchanges(shop.order_mart(orders, payments)) == 2
    subtotals = reports.shipped_subtotals(
        trading["orders"], trading["details"], "1998-01-01", "1998-12-31"
    )
    assert exchanges(subtotals) == 2
    history = reports.customer_order_history(
        *[trading[n] for n in ("products", "details", "orders", "customers")]
    )
    # Customers, orders, both by order, details, sums by product, products, and the last sum.
    assert exchanges(history) <= 8
