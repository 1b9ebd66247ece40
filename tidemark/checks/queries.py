"""One query per report or operator, over the generated benchmark tables.

Every query takes ``(spark, sf_dir)`` and reads whole tables. Results are cast
to types that compare the same everywhere: decimals to double after all sums,
dates and times to text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from tidemark import schemas, session
from tidemark import testdata as td
from tidemark.operators import (
    aggregates,
    cleaning,
    dimensions,
    keys,
    merge,
    quality,
    series,
    star,
)
from tidemark.operators.alerts import AlertLog
from tidemark.operators.versions import ChangeLog
from tidemark.plans import landing, medallion, reports, sales, shop, stations, warehouse
from tidemark.plans import medallion_feed as medallion_feed_plan
from tidemark.sources import readers, writers
from tidemark.streaming import live, progress, sinks, sources, windows

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the checked runs; the generated data spans 1995 to 2001.
FLAG_BEFORE = "1998-08-01"
FIRST_LOAD_BEFORE = "1996-01-01"
SHIPPED_FROM, SHIPPED_TO = "1997-01-01", "1998-12-31"

_REGISTRY: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


def portable(df: DataFrame, nullable_numbers: tuple[str, ...] = ()) -> DataFrame:
    """Cast to types that every engine renders alike.

    Whole numbers that may be null are given as double.
    """
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType) or field.name in nullable_numbers:
            column = column.cast("double")
        elif isinstance(field.dataType, DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, TimestampType | TimestampNTZType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(column.alias(field.name))
    return df.select(columns)


def query(*nullable_numbers: str) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(build(spark, sf_dir.rstrip("/")), nullable_numbers)

        _REGISTRY[build.__name__] = run
        return build

    return register


# --- sales ------------------------------------------------------------


def clean(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return cleaning.clean_sales(td.sales(spark, sf, *columns), FLAG_BEFORE)


def silver(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Cleaned sales written once, for queries that read them several times."""
    path = session.scratch_path(spark, "silver")
    rows = clean(spark, sf, *columns)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@query()
def sales_clean(spark, sf):
    return clean(spark, sf)


@query()
def sales_transformed(spark, sf):
    return cleaning.transform_orders(td.sales(spark, sf))


@query()
def customer_counts(spark, sf):
    return aggregates.row_counts(
        td.sales(spark, sf, "CustomerName", "Email"), ["CustomerName", "Email"]
    )


@query()
def customers_distinct(spark, sf):
    return sales.distinct_customers(td.sales(spark, sf, "CustomerName", "Email"))


@query()
def customers_by_item(spark, sf):
    rows = td.sales(spark, sf, "CustomerName", "Email", "Item")
    return sales.distinct_customers(rows, item="small ring")


@query()
def product_quantity(spark, sf):
    return sales.product_quantity(td.sales(spark, sf, "Item", "Quantity"))


@query()
def yearly_orders(spark, sf):
    return sales.yearly_orders(td.sales(spark, sf, "OrderDate"))


@query()
def yearly_revenue(spark, sf):
    return sales.yearly_revenue(
        td.sales(spark, sf, "OrderDate", "Quantity", "UnitPrice", "Tax")
    )


@query()
def yearly_revenue_orders(spark, sf):
    return sales.yearly_revenue_and_orders(
        td.sales(spark, sf, "SalesOrderNumber", "OrderDate", "Quantity", "UnitPrice", "Tax")
    )


def _rounded_average(df: DataFrame) -> DataFrame:
    return df.withColumn("AvgPrice", F.round(F.col("AvgPrice").cast("double"), 4))


@query()
def category_stats(spark, sf):
    return _rounded_average(sales.category_stats(td.products(spark, sf)))


@query()
def category_top10(spark, sf):
    return sales.largest_categories(sales.category_stats(td.products(spark, sf)))


@query()
def category_avg_top6(spark, sf):
    return _rounded_average(
        sales.dearest_categories(sales.category_stats(td.products(spark, sf)))
    )


# --- files and tables ------------------------------------------------------------


@query()
def sales_csv_roundtrip(spark, sf):
    path = session.scratch_path(spark, "orders_csv")
    writers.csv(td.sales(spark, sf), path, header=False)
    return readers.csv_files(spark, f"{path}/*.csv", schemas.ORDERS_CSV_WIDE)


@query()
def products_header_csv(spark, sf):
    path = session.scratch_path(spark, "products_csv")
    writers.csv(td.products(spark, sf), path)
    return readers.csv_with_header(spark, path, schemas.PRODUCTS_CSV)


@query()
def products_positional_csv(spark, sf):
    path = session.scratch_path(spark, "products_plain")
    writers.csv(td.products(spark, sf), path, header=False)
    return readers.csv_positional(spark, path)


@query()
def typed_csv_load(spark, sf):
    """Prices of one category are words, which a typed column turns into null."""
    path = session.scratch_path(spark, "products_text")
    source = td.products(spark, sf).select(
        "ProductID",
        "ProductName",
        "Category",
        F.when(F.col("Category") == "PROMO", F.lit("on request"))
        .otherwise(F.col("ListPrice").cast("string"))
        .alias("ListPrice"),
    )
    writers.csv(source, path)
    return readers.csv_typed(spark, path, schemas.PRODUCTS_TYPED)


@query()
def typed_csv_replace(spark, sf):
    """A typed table that a second, complete delivery replaces."""
    name = f"{session.scratch_database(spark, 'refresh')}.products"
    products = td.products(spark, sf)
    for delivery in (products.where(F.col("Category") < "M"), products):
        path = session.scratch_path(spark, "delivery")
        writers.csv(delivery, path)
        landing.refresh_products(spark, path, name)
    return spark.table(name)


@query()
def table_limit(spark, sf):
    """Rows of a named table in no set order: their number, and how many the table holds."""
    name = f"{session.scratch_database(spark, 'limit')}.products"
    writers.managed_table(td.products(spark, sf), name)
    known = readers.table(spark, name).select("ProductID", F.lit(True).alias("known"))
    return (
        readers.table(spark, name, limit=7)
        .join(known, "ProductID", "left")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_if("known").alias("known_rows"))
    )


@query()
def provenance_counts(spark, sf):
    """Rows per delivered folder, and how many carry today's date twice."""
    root = session.scratch_path(spark, "deliveries")
    rows = td.sales(spark, sf)
    early = F.col("OrderDate") < FIRST_LOAD_BEFORE
    writers.csv(rows.where(early), f"{root}/early", header=False)
    writers.csv(rows.where(~early), f"{root}/late", header=False)
    read = readers.csv_files(spark, f"{root}/*/*.csv", schemas.ORDERS_CSV_WIDE)
    today = F.current_timestamp().cast("date")
    dated = (F.col("CreatedTS") == today) & (F.col("ModifiedTS") == today)
    folder = F.element_at(F.split("FileName", "/"), -2).alias("folder")
    return (
        cleaning.with_provenance(read)
        .groupBy(folder)
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_if(dated).alias("dated_today"))
    )


@query()
def copy_csv(spark, sf):
    first, second = session.scratch_path(spark, "copy"), session.scratch_path(spark, "copy")
    writers.copy_delimited(td.sales(spark, sf), first)
    writers.copy_delimited(readers.delimited(spark, first), second, separator="|")
    return readers.typed(
        readers.delimited(spark, second, separator="|"), schemas.ORDERS_CSV_WIDE
    )


@query()
def sales_partition_year(spark, sf):
    root = session.scratch_path(spark, "by_month")
    writers.partitioned_parquet(
        cleaning.transform_orders(td.sales(spark, sf)), root, ["Year", "Month"]
    )
    return readers.parquet_subtree(spark, root, "Year=1997/Month=*")


def _trips(spark: SparkSession, sf: str) -> DataFrame:
    shipped = F.col("l_shipdate").cast("timestamp")
    return td.read(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("vendorID"),
        shipped.alias("lpepPickupDatetime"),
        (shipped + F.expr("INTERVAL 1 hour")).alias("lpepDropoffDatetime"),
        F.col("l_linenumber").alias("passengerCount"),
        F.col("l_quantity").alias("tripDistance"),
        F.col("l_partkey").alias("puLocationId"),
        F.col("l_suppkey").alias("doLocationId"),
        F.col("l_discount").alias("pickupLongitude"),
        F.col("l_tax").alias("pickupLatitude"),
        F.col("l_tax").alias("dropoffLongitude"),
        F.col("l_discount").alias("dropoffLatitude"),
        F.col("l_linenumber").alias("rateCodeID"),
        F.col("l_returnflag").alias("storeAndFwdFlag"),
        F.col("l_linenumber").alias("paymentType"),
        F.col("l_extendedprice").alias("fareAmount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mtaTax"),
        F.lit("0.3").alias("improvementSurcharge"),
        F.col("l_discount").alias("tipAmount"),
        F.lit(0.0).alias("tollsAmount"),
        F.lit(None).cast("double").alias("ehailFee"),
        F.col("l_extendedprice").alias("totalAmount"),
        F.lit(1).alias("tripType"),
        F.year(shipped).alias("puYear"),
        F.month(shipped).alias("puMonth"),
    )


@query()
def typed_mapping_load(spark, sf):
    root = session.scratch_path(spark, "trips")
    writers.partitioned_parquet(_trips(spark, sf), root, ["puYear", "puMonth"])
    database = session.scratch_database(spark, "trips")
    delivered = _trips(spark, sf).drop("puYear", "puMonth").schema
    loaded = readers.mapped_parquet(spark, root, schemas.TRIP_COLUMNS, delivered)
    writers.managed_table(loaded, f"{database}.green_trips")
    return readers.table(spark, f"{database}.green_trips")


@query()
def table_append(spark, sf):
    name = f"{session.scratch_database(spark, 'append')}.products"
    products = td.products(spark, sf)
    writers.append_table(products.where(F.col("Category") < "M"), name)
    writers.append_table(products.where(F.col("Category") >= "M"), name)
    return spark.table(name)


@query()
def table_external(spark, sf):
    database = session.scratch_database(spark, "external")
    path = session.scratch_path(spark, "external_products")
    writers.external_table(td.products(spark, sf), f"{database}.products", path)
    writers.register_files(spark, f"{database}.products_again", path)
    return spark.table(f"{database}.products_again")


@query()
def table_create_if_absent(spark, sf):
    name = f"{session.scratch_database(spark, 'create')}.dimdate_gold"
    writers.create_if_absent(spark, name, schemas.DIM_DATE_GOLD)
    dates = dimensions.date_dimension(td.sales(spark, sf, "OrderDate"))
    writers.append_table(dates, name)
    writers.create_if_absent(spark, name, schemas.DIM_DATE_GOLD)
    return spark.table(name)


@query()
def load_sales(spark, sf):
    path = session.scratch_path(spark, "new_sales")
    delivered = td.sales(spark, sf).withColumnsRenamed(
        {"Email": "EmailAddress", "Tax": "TaxAmount"}
    )
    writers.csv(delivered, path)
    name = f"{session.scratch_database(spark, 'landing')}.new_sales"
    landing.load(spark, "sales", path, name)
    return spark.table(name)


@query()
def typed_warehouse_load(spark, sf):
    return readers.typed_load(td.warehouse_customers(spark, sf), schemas.DIM_CUSTOMER)


@query()
def typed_dim_date(spark, sf):
    return readers.typed_load(_warehouse_dates(spark, sf), schemas.DIM_DATE)


@query()
def typed_dim_product(spark, sf):
    return readers.typed_load(td.warehouse_products(spark, sf), schemas.DIM_PRODUCT)


@query()
def typed_fact_sales(spark, sf):
    return readers.typed_load(td.warehouse_fact(spark, sf), schemas.FACT_SALES_ORDER)


# --- dimensions and facts ------------------------------------------------------------


@query()
def dim_date(spark, sf):
    return dimensions.date_dimension(td.sales(spark, sf, "OrderDate"))


@query()
def dim_date_warehouse(spark, sf):
    return dimensions.warehouse_date_dimension(td.read(spark, sf, "orders"), "o_orderdate")


@query()
def dim_customer(spark, sf):
    return dimensions.customer_dimension(clean(spark, sf, "OrderDate", "CustomerName", "Email"))


@query()
def dim_product(spark, sf):
    return dimensions.product_dimension(td.sales(spark, sf, "Item"))


def _keyed(spark, members: DataFrame, schema: str, natural: list[str], key: str) -> DataFrame:
    """A dimension after its first load."""
    empty = spark.createDataFrame([], schema)
    return keys.key_new_members(members, empty, natural, key).select(empty.columns)


def _keyed_customers(spark, rows: DataFrame) -> DataFrame:
    return _keyed(
        spark,
        dimensions.customer_dimension(rows),
        schemas.DIM_CUSTOMER_GOLD,
        medallion.CUSTOMER_KEY,
        "CustomerID",
    )


def _keyed_products(spark, rows: DataFrame) -> DataFrame:
    return _keyed(
        spark,
        dimensions.product_dimension(rows),
        schemas.DIM_PRODUCT_GOLD,
        medallion.PRODUCT_KEY,
        "ItemID",
    )


@query()
def dim_customer_keys(spark, sf):
    """A first load and a second one whose new customers get keys above the old."""
    rows = silver(spark, sf, "OrderDate", "CustomerName", "Email")
    existing = _keyed_customers(spark, rows.where(F.col("OrderDate") < FIRST_LOAD_BEFORE))
    fresh = keys.key_new_members(
        dimensions.customer_dimension(rows), existing, medallion.CUSTOMER_KEY, "CustomerID"
    )
    return existing.unionByName(fresh)


@query()
def dim_product_keys(spark, sf):
    rows = td.sales(spark, sf, "OrderDate", "Item")
    existing = _keyed_products(spark, rows.where(F.col("OrderDate") < FIRST_LOAD_BEFORE))
    fresh = keys.key_new_members(
        dimensions.product_dimension(rows), existing, medallion.PRODUCT_KEY, "ItemID"
    )
    return existing.unionByName(fresh.select(existing.columns))


@query()
def fact_sales(spark, sf):
    rows = silver(spark, sf)
    return star.fact_sales(rows, _keyed_customers(spark, rows), _keyed_products(spark, rows))


@query()
def merge_insert_only(spark, sf):
    rows = silver(spark, sf)
    first = rows.where(F.col("OrderDate") < FIRST_LOAD_BEFORE)
    return merge.merge(first, rows, medallion.SILVER_KEY)


@query()
def merge_upsert(spark, sf):
    orders = td.read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
    )
    target = orders.where(F.col("order_date") < "1999-01-01")
    updates = orders.where(F.col("order_date") >= "1997-01-01").withColumn(
        "status", F.lower("status")
    )
    return merge.merge(
        target,
        updates,
        ["order_id"],
        when_matched={"status": "u.status", "amount": "t.amount + u.amount"},
    )


def _cheaper(products: DataFrame) -> dict:
    return {"ListPrice": products["ListPrice"] * F.expr("0.9BD")}


@query()
def conditional_update(spark, sf):
    products = td.products(spark, sf)
    return merge.conditional_update(
        products, F.col("Category") == "STANDARD", _cheaper(products)
    )


def _product_log(spark: SparkSession, sf: str) -> ChangeLog:
    """A load, 10 % off one category, a mixed version, a merge, and one that changes nothing.

    The mixed version withdraws one category and renames another; the merge
    brings the withdrawn products back with a new name.
    """
    log = ChangeLog(
        spark,
        session.scratch_path(spark, "product_log"),
        "ProductID int, ProductName string, Category string, ListPrice decimal(12,2)",
        ["ProductID"],
    )
    products = td.products(spark, sf)
    log.commit(0, "WRITE", {"insert": products})
    log.update(1, F.col("Category") == "STANDARD", {"ListPrice": F.expr("ListPrice * 0.9BD")})
    current = log.as_of(1)
    renamed = current.where(F.col("Category") == "ECONOMY").withColumn(
        "ProductName", F.upper("ProductName")
    )
    gone = current.where(F.col("Category") == "PROMO")
    log.commit(2, "REVISION", {"update": renamed, "delete": gone})
    back = products.where(F.col("Category").isin("PROMO", "STANDARD")).withColumn(
        "ProductName", F.concat("ProductName", F.lit(" II"))
    )
    log.merge(3, back, when_matched={"ProductName": "u.ProductName"})
    log.commit(4, "MERGE", {})
    return log


@query()
def version_as_of(spark, sf):
    log = _product_log(spark, sf)
    states = [log.as_of(v).withColumn("version", F.lit(v)) for v in range(5)]
    return reduce(DataFrame.unionByName, states)


@query()
def version_snapshots(spark, sf):
    """States of a log that writes a snapshot every third version."""
    log = ChangeLog(
        spark,
        session.scratch_path(spark, "snapshot_log"),
        "ProductID int, ProductName string, Category string, ListPrice decimal(12,2)",
        ["ProductID"],
        snapshot_every=3,
    )
    log.commit(0, "WRITE", {"insert": td.products(spark, sf)})
    for v in range(1, 8):
        dearer = F.expr(f"CAST(ListPrice + {v} AS DECIMAL(12,2))")
        log.update(v, F.col("ProductID") % 5 == v % 5, {"ListPrice": dearer})
    states = [log.as_of(v).withColumn("version", F.lit(v)) for v in (0, 2, 3, 5, 7)]
    return reduce(DataFrame.unionByName, states)


@query()
def version_history(spark, sf):
    return _product_log(spark, sf).history()


@query()
def medallion_second_run(spark, sf):
    """Row counts after a first load and a second one that repeats it and adds more."""
    tables = _two_runs(spark, sf, "medallion")
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def _two_runs(spark: SparkSession, sf: str, label: str) -> dict[str, DataFrame]:
    """The full job over a first delivery, then over it and a second one.

    Both deliveries, which leave out lines without a date, are written from one
    pass over the lines, as compressed files. A task keeps a file of each open,
    which saves it a sort.
    """
    root = session.scratch_path(spark, "bronze")
    early = F.col("OrderDate") < FIRST_LOAD_BEFORE
    delivery = F.when(early, "first").when(~early, "second")
    rows = td.sales(spark, sf).withColumn("delivery", delivery).where("delivery IS NOT NULL")
    writer = rows.write.partitionBy("delivery").option("compression", "gzip")
    open_files = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(open_files)
    spark.conf.set(open_files, 2)
    try:
        writer.option("header", False).csv(root)
    finally:
        spark.conf.set(open_files, before)
    database = session.scratch_database(spark, label)
    for folder in ("first", "*"):
        pattern = f"{root}/delivery={folder}/*.csv.gz"
        tables = medallion.run(spark, pattern, database, FLAG_BEFORE)
    return tables


def _deliveries(spark: SparkSession, sf: str, label: str):
    """Two bronze deliveries, the second with all rows of the first, and a database."""
    rows = td.sales(spark, sf)
    root = session.scratch_path(spark, "bronze")
    early = F.col("OrderDate") < FIRST_LOAD_BEFORE
    writers.csv(rows.where(early), f"{root}/first", header=False)
    writers.csv(rows, f"{root}/second", header=False)
    return [f"{root}/{d}/*.csv" for d in ("first", "second")], session.scratch_database(spark, label)


@query()
def medallion_feed(spark, sf):
    """Rows of every table after two deliveries, and those that each brought to gold."""
    deliveries, database = _deliveries(spark, sf, "feed")
    for pattern in deliveries:
        tables = medallion_feed_plan.run(spark, pattern, database, FLAG_BEFORE, buckets=4, period="yyyy")
    one = F.count(F.lit(1)).alias("row_count")
    counts = [t.rows().agg(one).select(F.lit(n).alias("part"), "row_count") for n, t in tables.items()]
    fed = tables["sales_silver"]
    counts += [
        fed.changes(k - 1, k).agg(one).select(F.lit(f"delivery {k}").alias("part"), "row_count")
        for k in (1, 2)
    ]
    return reduce(DataFrame.unionByName, counts)


@query()
def medallion_feed_totals(spark, sf):
    """Gold facts of two deliveries by year and item name, read through their keys."""
    deliveries, database = _deliveries(spark, sf, "fed")
    for pattern in deliveries:
        tables = medallion_feed_plan.run(spark, pattern, database, FLAG_BEFORE, buckets=4, period="yyyy")
    return _gold_totals({name: table.rows() for name, table in tables.items()})


@query()
def medallion_totals(spark, sf):
    """Gold facts read through their keys, by year and item name, after two runs."""
    return _gold_totals(_two_runs(spark, sf, "gold"))


def _gold_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """The facts are summed per customer where the join with the customers has put them.

    An e-mail of one dimension row counts once per such sum; only e-mails of
    several rows are brought together to be counted.
    """
    customers = tables["dimcustomer_gold"].select("CustomerID", "Email")
    several = customers.groupBy("Email").agg((F.count("CustomerID") > 1).alias("several"))
    products = tables["dimproduct_gold"].select("ItemID", "ItemName")
    dates = tables["dimdate_gold"].select("OrderDate", "Year")
    bought = (
        tables["factsales_gold"]
        .join(dates, "OrderDate")
        .join(products, "ItemID")
        .join(customers.join(several, "Email", "left"), "CustomerID")
        .groupBy("CustomerID", "Email", "several", "Year", "ItemName")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("Quantity").alias("quantity"))
    )
    one, more = F.when(~F.col("several"), F.col("Email")), F.when(F.col("several"), F.col("Email"))
    return bought.groupBy("Year", "ItemName").agg(
        F.sum("lines").alias("line_count"),
        F.sum("quantity").alias("quantity"),
        (F.count(one) + F.count_distinct(more)).alias("buyers"),
    )


@query()
def table_described(spark, sf):
    """Columns of a table as described, its rows, and that it is gone once dropped."""
    name = f"{session.scratch_database(spark, 'described')}.nation"
    writers.managed_table(td.read(spark, sf, "nation"), name)
    listed = writers.describe(spark, name).select("col_name", "data_type").collect()
    columns = [tuple(r) for r in listed[: next(i for i, r in enumerate(listed) if not r.col_name)]]
    rows = spark.table(name).count()
    writers.drop_table(spark, name)
    gone = not spark.catalog.tableExists(name)
    found = spark.createDataFrame(columns, "col_name string, data_type string")
    return found.select("*", F.lit(rows).cast("bigint").alias("row_count"), F.lit(gone).alias("gone"))


# --- shop ------------------------------------------------------------


@query("number_of_orders")
def shop_seeds(spark, sf):
    """The customer mart from delivered seed files."""
    folder = session.scratch_path(spark, "seeds")
    for name in ("customers", "orders", "payments"):
        raw = getattr(td, f"raw_{name}")(spark, sf)
        writers.csv(raw, f"{folder}/raw_{name}.csv")
    customers, orders, payments = shop.read_seeds(spark, folder)
    return shop.customer_mart(
        shop.stage_customers(customers), shop.stage_orders(orders), shop.stage_payments(payments)
    )


def _staged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        shop.stage_customers(td.raw_customers(spark, sf)),
        shop.stage_orders(td.raw_orders(spark, sf)),
        shop.stage_payments(td.raw_payments(spark, sf)),
    )


@query()
def stg_customers(spark, sf):
    return _staged(spark, sf)[0]


@query()
def stg_orders(spark, sf):
    return _staged(spark, sf)[1]


@query()
def stg_payments(spark, sf):
    return _staged(spark, sf)[2]


@query("number_of_orders")
def mart_customers(spark, sf):
    return shop.customer_mart(*_staged(spark, sf))


@query()
def mart_orders(spark, sf):
    _, orders, payments = _staged(spark, sf)
    return shop.order_mart(orders, payments)


@query("customer_id")
def payments_by_customer(spark, sf):
    """Only orders of later years are known, so early payments form the null group."""
    _, orders, payments = _staged(spark, sf)
    known = orders.where(F.col("order_date") >= FIRST_LOAD_BEFORE)
    return shop.payments_by_customer(known, payments)


@query()
def quality_unique(spark, sf):
    customers, orders, payments = _staged(spark, sf)
    return quality.report(
        quality.unique(customers, "stg_customers", "customer_id"),
        quality.unique(orders, "stg_orders", "order_id"),
        quality.unique(payments, "stg_payments", "payment_id"),
    )


@query()
def quality_not_null(spark, sf):
    _, orders, payments = _staged(spark, sf)
    mart = shop.order_mart(orders, payments)
    return quality.report(
        quality.not_null(
            mart,
            "orders",
            [
                "order_id",
                "customer_id",
                *[f"{m}_amount" for m in shop.PAYMENT_METHODS],
                "amount",
            ],
        )
    )


@query()
def quality_accepted_values(spark, sf):
    _, orders, payments = _staged(spark, sf)
    return quality.report(
        quality.accepted_values(orders, "stg_orders", "status", shop.ORDER_STATES),
        quality.accepted_values(orders, "open_orders", "status", ["placed"]),
        quality.accepted_values(payments, "stg_payments", "payment_method", shop.PAYMENT_METHODS),
    )


@query()
def quality_relationships(spark, sf):
    customers, orders, payments = _staged(spark, sf)
    late = orders.where(F.col("order_date") >= FIRST_LOAD_BEFORE)
    return quality.report(
        quality.relationships(orders, "orders", "customer_id", customers, "customer_id"),
        quality.relationships(payments, "payments", "order_id", orders, "order_id"),
        quality.relationships(payments, "late_payments", "order_id", late, "order_id"),
    )


@query()
def shop_build(spark, sf):
    """The whole marts build: staging views, mart tables, all data tests."""
    return shop.build(
        spark,
        td.raw_customers(spark, sf),
        td.raw_orders(spark, sf),
        td.raw_payments(spark, sf),
        session.scratch_database(spark, "shop"),
    )


# --- warehouse and star ------------------------------------------------------------


def _warehouse_dates(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.warehouse_date_dimension(td.read(spark, sf, "orders"), "o_orderdate")


@query()
def sales_by_region(spark, sf):
    return warehouse.sales_by_region(
        td.warehouse_fact(spark, sf),
        _warehouse_dates(spark, sf),
        td.warehouse_customers(spark, sf),
    )


@query()
def star_measures(spark, sf):
    return star.measures_by(
        td.warehouse_fact(spark, sf),
        {
            "DimProduct": td.warehouse_products(spark, sf),
            "DimCustomer": td.warehouse_customers(spark, sf),
            "DimDate": _warehouse_dates(spark, sf),
        },
        star.WAREHOUSE_RELATIONS,
        {"DimProduct": ["Category"], "DimCustomer": ["CountryRegion"], "DimDate": ["Year"]},
        star.WAREHOUSE_MEASURES,
    )


@query()
def star_measures_gold(spark, sf):
    rows = silver(spark, sf)
    customers, products = _keyed_customers(spark, rows), _keyed_products(spark, rows)
    measures = star.measures_by(
        star.fact_sales(rows, customers, products),
        {
            "dimproduct_gold": products,
            "dimcustomer_gold": customers,
            "dimdate_gold": dimensions.date_dimension(rows),
        },
        star.GOLD_RELATIONS,
        {"dimproduct_gold": ["ItemName"], "dimdate_gold": ["yyyymm"]},
        star.GOLD_MEASURES,
    )
    return measures.withColumns(
        {c: F.round(c, 2) for c in ("sum_UnitPrice", "sum_Tax")}
    )


# --- trading reports ------------------------------------------------------------


@query()
def cust_order_hist(spark, sf):
    return reports.customer_order_history(
        td.trading_products(spark, sf),
        td.trading_details(spark, sf),
        td.trading_orders(spark, sf, shipped=False),
        td.trading_customers(spark, sf),
        customer_id=42,
    )


@query()
def cust_order_hist_all(spark, sf):
    return reports.customer_order_history(
        td.trading_products(spark, sf),
        td.trading_details(spark, sf),
        td.trading_orders(spark, sf, shipped=False),
        td.trading_customers(spark, sf),
    )


@query()
def cust_orders_detail(spark, sf):
    return reports.order_details(
        td.trading_products(spark, sf), td.trading_details(spark, sf), order_id=1024
    )


@query()
def cust_orders_detail_all(spark, sf):
    return reports.order_details(td.trading_products(spark, sf), td.trading_details(spark, sf))


@query()
def cust_orders_orders(spark, sf):
    return reports.customer_orders(td.trading_orders(spark, sf), customer_id=42)


@query()
def cust_orders_orders_all(spark, sf):
    return reports.customer_orders(td.trading_orders(spark, sf))


@query()
def employee_sales(spark, sf):
    return reports.employee_sales(
        td.trading_employees(spark, sf),
        td.trading_orders(spark, sf),
        td.trading_details(spark, sf),
        SHIPPED_FROM,
        SHIPPED_TO,
    )


@query()
def sales_by_year(spark, sf):
    return reports.sales_by_year(
        td.trading_orders(spark, sf),
        td.trading_details(spark, sf),
        SHIPPED_FROM,
        SHIPPED_TO,
    )


@query()
def sales_by_category(spark, sf):
    """A year the report does not know, so the default year is used."""
    return reports.sales_by_category(
        td.trading_details(spark, sf),
        td.trading_orders(spark, sf, shipped=False),
        td.trading_products(spark, sf),
        td.trading_categories(spark, sf),
        "STANDARD",
        "2001",
    )


@query()
def ten_most_expensive(spark, sf):
    return reports.most_expensive_products(td.trading_products(spark, sf))


# --- stations ------------------------------------------------------------


def _rate_rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("fill_rate", F.round("fill_rate", 6))


@query()
def station_filter(spark, sf):
    rows = stations.base(td.stations(spark, sf), ["N1", "N3"], ["click", "view"])
    return _rate_rounded(rows)


@query()
def station_choices(spark, sf):
    return stations.street_choices(td.stations(spark, sf), ["N2"])


@query()
def station_neighbourhoods(spark, sf):
    return stations.neighbourhood_choices(td.stations(spark, sf))


@query()
def station_points_on_street(spark, sf):
    return stations.points_on_street(td.stations(spark, sf), "click")


@query()
def station_latest(spark, sf):
    return _rate_rounded(stations.latest_state(stations.base(td.stations(spark, sf))))


@query()
def station_latest_all(spark, sf):
    return _rate_rounded(stations.latest_state(stations.base(td.stations(spark, sf)), age=None))


@query()
def station_latest_filtered(spark, sf):
    """The last day of the table, not of the chosen neighbourhoods."""
    table = td.stations(spark, sf)
    chosen = stations.base(table, ["N1", "N2"])
    return _rate_rounded(stations.latest_state(chosen, "1 day", stations.newest(table)))


@query()
def dashboard_tiles(spark, sf):
    """Rows and sums of every dashboard tile with a neighbourhood chosen."""
    tiles = stations.dashboard(td.stations(spark, sf), ["N3"])
    sums = {
        "fullest": "No_Bikes",
        "emptiest": "No_Empty_Docks",
        "map": "No_Empty_Docks",
        "bikes_per_street": "countBikes",
        "event_counts": "Count",
        "docks_fine": "Available Docks",
        "docks_daily": "Available Docks",
        "neighbourhood_choices": None,
        "street_choices": None,
    }
    counted = [
        tile.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.coalesce(F.sum(f"`{sums[name]}`") if sums[name] else F.lit(0), F.lit(0))
            .cast("bigint")
            .alias("total"),
        ).select(F.lit(name).alias("tile"), "row_count", "total")
        for name, tile in tiles.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query()
def station_change_all(spark, sf):
    return _rate_rounded(stations.station_change(stations.base(td.stations(spark, sf))))


@query()
def station_change_top10(spark, sf):
    return stations.fullest(stations.base(td.stations(spark, sf)), age="1 day")


@query()
def station_available_top10(spark, sf):
    return stations.fullest(stations.base(td.stations(spark, sf)), age="1 day", emptiest=True)


@query()
def station_map(spark, sf):
    return stations.map_points(td.stations(spark, sf))


@query()
def station_map_all(spark, sf):
    return stations.map_points(td.stations(spark, sf), age=None)


@query()
def station_street_bikes(spark, sf):
    return stations.bikes_per_street(td.stations(spark, sf))


@query()
def station_top_street_docks(spark, sf):
    return stations.streets_with_most_docks(td.stations(spark, sf))


@query()
def station_top_point(spark, sf):
    return stations.most_popular_point(td.stations(spark, sf))


@query()
def station_area_counts(spark, sf):
    return stations.points_per_neighbourhood(td.stations(spark, sf))


@query()
def station_neighbourhood(spark, sf):
    return stations.bikes_per_neighbourhood(td.stations(spark, sf))


@query()
def station_neighbourhood_order(spark, sf):
    """The place of every row in the sorted report."""
    report = stations.bikes_per_neighbourhood(td.stations(spark, sf))
    at = report.withColumn("_at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.orderBy("_at"))
    return at.select(place.alias("place"), "Neighbourhood")


@query()
def station_daily(spark, sf):
    return stations.bikes_per_day(td.stations(spark, sf))


@query()
def station_counts(spark, sf):
    return stations.event_counts(td.stations(spark, sf))


@query()
def station_matrix(spark, sf):
    return stations.matrix(td.stations(spark, sf))


@query()
def station_street_nonnull(spark, sf):
    return stations.points_per_street(td.stations(spark, sf))


@query()
def station_geo(spark, sf):
    return stations.bikes_per_place(td.stations(spark, sf))


@query("CountChange", "EmptyCountChange")
def station_prev_change(spark, sf):
    return stations.previous_change(td.stations(spark, sf))


@query()
def station_limit(spark, sf):
    """Ten rows in no set order: their number, and how many of them the table holds."""
    table = td.stations(spark, sf)
    known = table.select("EventID", F.lit(True).alias("known"))
    return (
        table.limit(10)
        .join(known, "EventID", "left")
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_if("known").alias("known_rows"))
    )


# --- series ------------------------------------------------------------


@query()
def series_daily_docks(spark, sf):
    return stations.available_docks(td.stations(spark, sf), "1 day")


@query()
def series_2min_docks(spark, sf):
    return stations.available_docks(td.stations(spark, sf), "2 minutes")


@query()
def series_per_station(spark, sf):
    """The filled series of every station, before it is summed."""
    filled = series.make_series(
        td.stations(spark, sf), [stations.STATION], stations.TIME, "No_Empty_Docks", "1 day"
    )
    return filled.withColumn("No_Empty_Docks", F.round("No_Empty_Docks", 6))


def _delivered_docks(spark, rows):
    """Partials of closed days, a late delivery among them, and the rows of the open day."""
    open_day = F.date_trunc("day", stations.newest(rows))
    closed = rows.where(F.col(stations.TIME) < open_day)
    partials = stations.dock_partials(spark, session.scratch_path(spark, "partials"))
    partials.add(1, closed.where("EventID % 3 <> 0"))
    partials.add(2, closed.where("EventID % 3 = 0"))
    return partials, rows.where(F.col(stations.TIME) >= open_day)


@query()
def series_from_partials(spark, sf):
    partials, unread = _delivered_docks(spark, td.stations(spark, sf))
    reports = [
        stations.refreshed_docks(partials, unread, step).withColumn("report", F.lit(name))
        for name, step in {"daily": "1 day", "fine": "2 minutes"}.items()
    ]
    return reduce(DataFrame.unionByName, reports)


@query()
def dashboard_from_partials(spark, sf):
    """The series tiles of a neighbourhood when the dashboard is given partials."""
    rows = td.stations(spark, sf)
    partials, unread = _delivered_docks(spark, rows)
    tiles = stations.dashboard(rows, ["N3"], partials=partials, unread=unread)
    reports = [tiles[name].withColumn("tile", F.lit(name)) for name in ("docks_fine", "docks_daily")]
    return reduce(DataFrame.unionByName, reports)


@query()
def series_alert(spark, sf):
    return stations.dock_alerts(td.stations(spark, sf), threshold=900)


@query()
def alert_runs(spark, sf):
    """Events of three scheduled runs: without a third of the rows, with all, and again."""
    rows = td.stations(spark, sf)
    end = stations.newest(rows) + F.expr("INTERVAL 1 microsecond")
    log = AlertLog(spark, session.scratch_path(spark, "alerts"), "day", "date", "docks")
    deliveries = [rows.where("EventID % 3 <> 0"), rows, rows]
    events = [
        stations.dock_alert_run(log, k, delivered, 60, end).withColumn("run", F.lit(k))
        for k, delivered in enumerate(deliveries, start=1)
    ]
    return reduce(DataFrame.unionByName, events)


# --- streams ------------------------------------------------------------


def _run(stream_query) -> None:
    stream_query.awaitTermination()
    error = stream_query.exception()
    if error is not None:
        raise error


# Files of a streamed backlog, one micro-batch each; they come in no order of time.
BACKLOG_FILES = 4
ANY_LATENESS = "3650 days"
_TIMES = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _backlog(spark: SparkSession, rows: DataFrame, label: str, more: str | None = None) -> DataFrame:
    """Station events as a stream of JSON line files that takes one at a time."""
    path = session.scratch_path(spark, label)
    rows.repartition(BACKLOG_FILES).write.option("timestampFormat", _TIMES).json(path)
    return sources.station_events(spark, path, more=more)


# Days of arrivals in one micro-batch, and the most of them.
STEP_DAYS, STEPS = 6, 5
# Every fifth event comes later than it happened, by up to so many hours.
LONG_DELAY, SHORT_DELAY = 288, 48


def _arrivals(spark: SparkSession, rows: DataFrame, label: str, delay_hours: int) -> DataFrame:
    """Station events in the order of arrival, some days of arrivals in each micro-batch."""
    path = session.scratch_path(spark, label)
    delay = F.when(F.col("EventID") % 5 == 0, F.col("EventID") * 7919 % delay_hours).otherwise(0)
    first = rows.agg(F.min(F.unix_micros("EnqueuedTime")).alias("first")).scalar()
    hours = (F.unix_micros("EnqueuedTime") - first) / 3_600_000_000 + delay
    step = F.least(F.floor(hours / (24 * STEP_DAYS)), F.lit(STEPS - 1))
    for k in range(STEPS):  # files are taken by their age
        files = rows.where(step == k).repartition(1)
        files.write.mode("append").option("timestampFormat", _TIMES).json(path)
    return sources.station_events(spark, path, more="EventID bigint")


@query()
def stream_files(spark, sf):
    """Device status files through a checkpointed stream into a table."""
    events = td.read(spark, sf, "events").select(
        F.concat(F.lit("Dev"), "user_id").alias("device"), F.col("event_type").alias("status")
    )
    path = session.scratch_path(spark, "devices")
    events.write.json(path)
    out, checkpoint = (session.scratch_path(spark, n) for n in ("iot", "iot_checkpoint"))
    _run(
        sinks.append_files(
            sources.device_status(spark, path, files_per_trigger=1), out, checkpoint
        )
    )
    stored = spark.read.schema(schemas.DEVICE_STATUS).parquet(out)
    return stored.groupBy("device", "status").agg(F.count(F.lit(1)).alias("readings"))


@query()
def stream_tumbling(spark, sf):
    """All 5-second windows of a backlog that arrives in several batches, out of order."""
    events = _backlog(spark, td.stations(spark, sf).drop("EventID"), "bikes")
    out, checkpoint = (session.scratch_path(spark, n) for n in ("windows", "windows_checkpoint"))
    summed = windows.tumbling_bikes(events, lateness=ANY_LATENESS)
    _run(sinks.update_files(summed, out, checkpoint))
    return sinks.current_results(
        spark,
        out,
        "Street string, SUM_No_Bikes double, Window_End_Time timestamp",
        ["Street", "Window_End_Time"],
    )


@query()
def stream_alert(spark, sf):
    """Days on which a station reached nine free docks, from an update sink."""
    events = _backlog(spark, td.stations(spark, sf).drop("EventID"), "docks")
    out, checkpoint = (session.scratch_path(spark, n) for n in ("alerts", "alerts_checkpoint"))
    daily = windows.docks_per_window(events, "1 day", ANY_LATENESS)
    _run(sinks.update_files(windows.alerts(daily, "docks", 9), out, checkpoint))
    return sinks.current_results(
        spark,
        out,
        "BikepointID string, docks bigint, window_start timestamp",
        ["BikepointID", "window_start"],
    )


def _closed(spark: SparkSession, sf: str):
    """Run the closing windows over late arrivals: the folder written and the finished stream."""
    events = _arrivals(spark, td.stations(spark, sf), "late", LONG_DELAY)
    out, checkpoint = (session.scratch_path(spark, n) for n in ("closed", "closed_checkpoint"))
    stream = sinks.append_files(windows.closed_windows(events, "EventID", lateness="1 day"), out, checkpoint)
    _run(stream)
    return out, stream


@query()
def stream_closed_windows(spark, sf):
    """Windows that a watermark of one day closed, without the events that came later."""
    out, _ = _closed(spark, sf)
    schema = "Street string, SUM_No_Bikes double, n_events bigint, Window_End_Time timestamp"
    return spark.read.schema(schema).parquet(out)


@query()
def stream_late_events(spark, sf):
    """Events of each micro-batch and those of them that came too late for their window."""
    _, stream = _closed(spark, sf)
    report = progress.batches(spark, stream).where("input_rows > 0")
    place = F.row_number().over(Window.orderBy("batch")) - 1
    return report.select(place.alias("step"), "input_rows", "late_rows")


@query()
def stream_counts(spark, sf):
    """Counters kept by a stream whose events come up to two days late."""
    events = _arrivals(spark, td.stations(spark, sf), "counted", SHORT_DELAY)
    out, checkpoint = (session.scratch_path(spark, n) for n in ("counts", "counts_checkpoint"))
    counts = live.rolling_counts(events, "2 days", bucket="1 day", shards=2)
    _run(sinks.update_files(counts, out, checkpoint))
    return live.current_counts(spark, out)


@query()
def stream_station_change(spark, sf):
    """Newest state and change of every station, from a backlog that delivers a fifth twice."""
    rows = td.stations(spark, sf)
    events = _backlog(
        spark, rows.unionByName(rows.where("EventID % 5 = 0")), "states", "EventID bigint"
    )
    out, checkpoint = (session.scratch_path(spark, n) for n in ("states_out", "states_checkpoint"))
    state = live.station_state(events)
    _run(sinks.update_files(state, out, checkpoint))
    return _rate_rounded(
        sinks.current_results(spark, out, state.schema.toDDL(), [stations.STATION])
    )


@query("bikes")
def stream_broker(spark, sf):
    """Events per street from broker messages, a tenth of which is no JSON."""
    rows = td.stations(spark, sf)
    event = F.to_json(F.struct(*schemas.struct(schemas.STATION_EVENTS).names))
    body = F.when(F.col("EventID") % 10 == 0, F.concat(F.lit("!"), event)).otherwise(event)
    path = session.scratch_path(spark, "messages")
    messages = rows.select(body.alias("body"), "EnqueuedTime").repartition(BACKLOG_FILES)
    messages.write.option("timestampFormat", _TIMES).json(path)
    out, checkpoint = (session.scratch_path(spark, n) for n in ("broker", "broker_checkpoint"))
    parsed = sources.parse_station_events(
        sources.broker_messages(spark, path), "body", "EnqueuedTime"
    )
    _run(sinks.append_files(parsed, out, checkpoint))
    stored = spark.read.schema(schemas.STATION_TABLE).parquet(out)
    return stored.groupBy("Street").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("No_Bikes").alias("bikes"),
        F.max("EnqueuedTime").alias("last_arrival"),
    )
