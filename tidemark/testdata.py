"""The generated benchmark tables reshaped into the tables the reports read.

Each adapter reads whole tables and joins only what the asked columns need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)")


def _cents(column: str) -> Column:
    """Money with two decimals as a whole number of cents, in integer arithmetic from there."""
    return F.floor(F.col(column) * 100 + 0.5)


def _customer_name() -> Column:
    """Customers of one segment have no name, to give the cleaning work."""
    name = F.replace(F.col("c_name"), F.lit("#"), F.lit(" "))
    return F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("")).otherwise(name)


def _email() -> Column:
    address = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")))
    return F.concat(address, F.lit("@example.com"))


def _item() -> Column:
    """Items of one type have no second part."""
    full = F.concat("p_name", F.lit(", "), "p_brand")
    return F.when(F.col("p_type") == "ECONOMY", F.col("p_name")).otherwise(full)


SALES_COLUMNS = (
    "SalesOrderNumber",
    "SalesOrderLineNumber",
    "OrderDate",
    "CustomerName",
    "Email",
    "Item",
    "Quantity",
    "UnitPrice",
    "Tax",
)


def sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order lines with customer and item; only needed tables are joined."""
    wanted = columns or SALES_COLUMNS
    of_order = {
        "SalesOrderNumber": F.concat(F.lit("SO"), F.col("o_orderkey")),
        "OrderDate": F.col("o_orderdate").cast("date"),
    }
    of_customer = {"CustomerName": _customer_name(), "Email": _email()}
    of_part = {"Item": _item()}
    # Text is built on the side that has fewest rows, before the join repeats it.
    rows = read(spark, sf_dir, "lineitem")
    customer = _chosen(of_customer, wanted)
    order = _chosen(of_order, wanted)
    if customer or order:
        orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", *order)
        if customer:
            # Joined to the orders first, so that the far more lines move once less.
            customers = read(spark, sf_dir, "customer").select("c_custkey", *customer)
            orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    item = _chosen(of_part, wanted)
    if item:
        parts = read(spark, sf_dir, "part").select("p_partkey", *item)
        rows = rows.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    price, quantity = _cents("l_extendedprice"), F.col("l_quantity")
    of_line = {
        "SalesOrderLineNumber": F.col("l_linenumber"),
        "Quantity": quantity.cast("int"),
        "UnitPrice": F.floor(price / quantity) / 100,
        "Tax": F.floor((price * _cents("l_tax") + 50) / 100) / 100,
    }
    return rows.select([of_line[c].alias(c) if c in of_line else F.col(c) for c in wanted])


def _chosen(made: dict[str, Column], wanted: tuple[str, ...]) -> list[Column]:
    return [column.alias(name) for name, column in made.items() if name in wanted]


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("Category"),
        _money("p_retailprice").alias("ListPrice"),
    )


# --- shop ------------------------------------------------------------


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.substring_index("c_name", "#", 1).alias("first_name"),
        F.substring_index("c_name", "#", -1).alias("last_name"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(status == "F", "completed")
        .when(status == "O", "placed")
        .when(status == "P", "shipped")
        .otherwise(status)
        .alias("status"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as payments; the ids repeat, so the uniqueness test finds failures."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return read(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.when(flag == "R", "coupon")
        .when(flag == "A", "bank_transfer")
        .when(status == "O", "credit_card")
        .otherwise("gift_card")
        .alias("payment_method"),
        _cents("l_extendedprice").alias("amount"),
    )


# --- sales warehouse ------------------------------------------------------------


def warehouse_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").cast("int").alias("SalesOrderKey"),
        date_key(F.col("o_orderdate")).alias("SalesOrderDateKey"),
        F.col("l_partkey").cast("int").alias("ProductKey"),
        F.col("o_custkey").cast("int").alias("CustomerKey"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.floor((_cents("l_extendedprice") + 50) / 100).cast("decimal(18,0)").alias("SalesTotal"),
    )


def warehouse_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, nations = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    none = F.lit(None).cast("string")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("int").alias("CustomerKey"),
        F.col("c_name").alias("CustomerAltKey"),
        none.alias("Title"),
        F.substring_index("c_name", "#", 1).alias("FirstName"),
        F.substring_index("c_name", "#", -1).alias("LastName"),
        none.alias("AddressLine1"),
        none.alias("City"),
        F.col("c_mktsegment").alias("StateProvince"),
        F.col("n_name").alias("CountryRegion"),
        none.alias("PostalCode"),
    )


def warehouse_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("ProductKey"),
        F.col("p_brand").alias("ProductAltKey"),
        F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("Category"),
        F.round(_money("p_retailprice"), 0).cast("decimal(18,0)").alias("ListPrice"),
    )


# --- trading ------------------------------------------------------------


def trading_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.concat("p_name", F.lit(" "), "p_partkey").alias("ProductName"),
        _money("p_retailprice").alias("UnitPrice"),
        F.concat(F.lit("C-"), "p_type").alias("CategoryID"),
    )


def trading_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = read(spark, sf_dir, "part").select("p_type").distinct()
    return kind.select(
        F.concat(F.lit("C-"), "p_type").alias("CategoryID"), F.col("p_type").alias("CategoryName")
    )


def trading_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_partkey").alias("ProductID"),
        F.col("l_extendedprice").alias("UnitPrice"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("l_discount").alias("Discount"),
    )


def trading_orders(spark: SparkSession, sf_dir: str, shipped: bool = True) -> DataFrame:
    """Orders; the supplier of an order's lines with the lowest key is its employee."""
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderdate").cast("date").alias("OrderDate"),
        F.date_add(F.col("o_orderdate").cast("date"), 28).alias("RequiredDate"),
    )
    if not shipped:
        return orders
    lines = (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("OrderID"))
        .agg(
            F.max("l_shipdate").cast("date").alias("ShippedDate"),
            F.min("l_suppkey").alias("EmployeeID"),
        )
    )
    return orders.join(lines, "OrderID", "left")


def trading_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("CustomerID"))


def trading_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers, nations = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("EmployeeID"),
        F.substring_index("s_name", "#", -1).alias("LastName"),
        F.substring_index("s_name", "#", 1).alias("FirstName"),
        F.col("n_name").alias("Country"),
    )


# --- stations ------------------------------------------------------------


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as station readings."""
    k = F.get_json_object("props", "$.k").cast("int")
    user = F.col("user_id")
    area = F.pmod(user, F.lit(7))
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("BP_"), user).alias("BikepointID"),
        F.col("event_type").alias("Street"),
        F.when(area == 0, F.lit(""))
        .otherwise(F.concat(F.lit("N"), area.cast("string")))
        .alias("Neighbourhood"),
        (F.lit(51.0) + user.cast("double") / 4096).alias("Latitude"),
        (F.lit(-1.0) + user.cast("double") / 8192).alias("Longitude"),
        F.pmod(k, F.lit(30)).cast("bigint").alias("No_Bikes"),
        F.floor(k / 10).cast("bigint").alias("No_Empty_Docks"),
        F.col("ts").cast("timestamp").alias("EnqueuedTime"),
        F.col("event_id").alias("EventID"),
    )
