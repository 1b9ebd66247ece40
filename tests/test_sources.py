from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import schemas
from tidemark.plans import landing
from tidemark.session import scratch_path, shared_root
from tidemark.sources import readers, writers

ORDERS = """SO1,1,2019-07-31,Ada Lane,ada@example.com,"Trail-9 Blue, 48",1,100.0,8.0
SO1,2,2019-07-31,Ada Lane,ada@example.com,Pump,2,10.0,1.6
"""
MORE_ORDERS = """SO2,1,2020-02-01,,none@example.com,"Trail-9 Blue, 48",1,100.0,8.0
SO3,1,2021-05-05,Ben Van Dyk,,"Sock, ",3,5.0,1.2
"""


def test_csv_files_glob(spark, tmp_path):
    (tmp_path / "2019.csv").write_text(ORDERS)
    (tmp_path / "2020.csv").write_text(MORE_ORDERS)
    df = readers.csv_files(spark, f"{tmp_path}/*.csv", schemas.ORDERS_CSV)
    assert df.count() == 4
    assert df.schema["Tax"].dataType.simpleString() == "float"
    assert {r.Item for r in df.collect()} == {"Trail-9 Blue, 48", "Pump", "Sock, "}


def test_positional_names_and_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,x\n2,y\n")
    df = readers.csv_positional(spark, str(tmp_path))
    assert df.columns == ["_c0", "_c1"]
    assert rows(df) == [("1", "x"), ("2", "y")]


def test_header_csv_with_schema(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "ProductID,ProductName,Category,ListPrice\n1,Trail-9,Mountain Bikes,99.5\n"
    )
    df = readers.csv_with_header(spark, str(tmp_path), schemas.PRODUCTS_CSV)
    assert rows(df) == [(1, "Trail-9", "Mountain Bikes", 99.5)]


def test_csv_typed_keeps_quotes_and_nulls_bad_numbers(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        'ProductID,ProductName,Category,ListPrice\n1,"Trail",A,9.5\nx,Road,B,cheap\n'
    )
    df = readers.csv_typed(spark, str(tmp_path), schemas.PRODUCTS_TYPED)
    assert rows(df) == [(1, '"Trail"', "A", 9.5), (None, "Road", "B", None)]


def test_copy_changes_dialect(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "s.csv").write_text('a,b\n1,"x, ""y"""\n2,z|w\n')
    first = spark.read.option("header", True).option("escape", '"').csv(str(source))
    out = str(tmp_path / "out")
    writers.copy_delimited(first, out, separator="|")
    again = readers.delimited(spark, out, separator="|")
    assert rows(again) == [("1", 'x, "y"'), ("2", "z|w")]


def test_partitioned_tree(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 2020, 1), (2, 2021, 1), (3, 2021, 2)], "v int, Year int, Month int"
    )
    root = str(tmp_path / "tree")
    writers.partitioned_parquet(df, root, ["Year", "Month"])
    part = readers.parquet_subtree(spark, root, "Year=2021/Month=*")
    assert rows(part.select("v", "Year", "Month")) == [(2, 2021, 1), (3, 2021, 2)]
    whole = spark.read.parquet(root).where("Year = 2021")
    assert "PartitionFilters: [isnotnull(Year" in whole._jdf.queryExecution().toString()


def test_mapped_load_ignores_folders(spark, tmp_path):
    df = spark.createDataFrame([(7, 1.5, 2020)], "vendor bigint, fare double, puYear int")
    root = str(tmp_path / "trips")
    writers.partitioned_parquet(df, root, ["puYear"])
    mapping = [
        schemas.ColumnMap("vendor", "vendorID", "int"),
        schemas.ColumnMap("fare", "fareAmount", "double"),
    ]
    loaded = readers.mapped_parquet(spark, root, mapping, df.drop("puYear").schema)
    assert loaded.dtypes == [("vendorID", "int"), ("fareAmount", "double")]
    assert rows(loaded) == [(7, 1.5)]
    assert len(schemas.TRIP_COLUMNS) == 23


def test_tables(spark, database, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    managed, external, again = (f"{database}.{n}" for n in ("managed", "external", "again"))
    writers.managed_table(df, managed)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS|already exists"):
        writers.managed_table(df, managed)
    writers.append_table(df, managed)
    assert spark.table(managed).count() == 4
    assert readers.table(spark, managed, limit=3).count() == 3
    writers.replace_table(df, managed)
    assert spark.table(managed).count() == 2

    path = str(tmp_path / "files")
    writers.external_table(df, external, path)
    writers.register_files(spark, again, path)
    assert rows(spark.table(again)) == [(1, "a"), (2, "b")]
    kinds = {r.col_name: r.data_type for r in writers.describe(spark, external).collect()}
    assert kinds["Type"] == "EXTERNAL"
    writers.drop_table(spark, external)
    assert not spark.catalog.tableExists(external)
    assert spark.read.parquet(path).count() == 2  # the files outlive the table


def test_create_if_absent(spark, database):
    name = f"{database}.dim"
    assert writers.create_if_absent(spark, name, schemas.DIM_DATE_GOLD)
    assert spark.table(name).columns[0] == "OrderDate"
    assert not writers.create_if_absent(spark, name, schemas.DIM_DATE_GOLD)


def test_models_as_view_and_table(spark, database):
    df = spark.range(3)
    assert writers.materialise(df, "some_view", "view").count() == 3
    assert writers.materialise(df, f"{database}.model", "table").count() == 3
    with pytest.raises(ValueError):
        writers.materialise(df, "x", "index")


def test_typed_load_checks(spark):
    good = spark.createDataFrame(
        [(1, "K", 1, 20240101, 2, Decimal("7.6"))],
        "SalesOrderKey int, x string, ProductKey int, SalesOrderDateKey int, CustomerKey int,"
        "SalesTotal decimal(10,1)",
    ).withColumn("Quantity", F.lit("3"))
    loaded = readers.typed_load(good, schemas.FACT_SALES_ORDER)
    assert rows(loaded) == [(1, 20240101, 1, 2, 3, Decimal("8"))]
    bad = good.withColumn("ProductKey", F.lit(None).cast("int"))
    with pytest.raises(Exception, match="ProductKey: null"):
        readers.typed_load(bad, schemas.FACT_SALES_ORDER).collect()
    kept, rejected = readers.reject_null_keys(bad, schemas.FACT_SALES_ORDER)
    assert (kept.count(), rejected.count()) == (0, 1)


def test_typed_load_text_length(spark):
    df = spark.createDataFrame(
        [(1, "x" * 51, 1, date(2020, 1, 1), Decimal("10.00"))],
        "employee_id int, name string, department_id int, hire_date date, salary decimal(10,2)",
    )
    with pytest.raises(Exception, match="name: text longer than 50"):
        readers.typed_load(df, schemas.EMPLOYEES).collect()


@pytest.mark.parametrize(
    "schema",
    [schemas.DEPARTMENTS, schemas.PROJECTS, schemas.ASSIGNMENTS, schemas.DIM_DATE, schemas.DIM_PRODUCT],
)
def test_warehouse_schemas_load(spark, schema):
    fields = schemas.struct(schema).fields
    empty = spark.createDataFrame([], ", ".join(f"{f.name} string" for f in fields))
    assert readers.typed_load(empty, schema).columns == [f.name for f in fields]


def test_landing_loads_append(spark, database, tmp_path):
    (tmp_path / "sales.csv").write_text(
        "SalesOrderNumber,SalesOrderLineNumber,OrderDate,CustomerName,EmailAddress,Item,"
        "Quantity,UnitPrice,TaxAmount\n"
        "SO1,1,2021-05-05,Ada Lane,a@example.com,Pump,1,10.0,0.8\n"
        "SO2,1,not a date,Cher,c@example.com,Pump,1,10.0,0.8\n"
    )
    name = f"{database}.new_sales"
    for _ in range(2):
        landing.load(spark, "sales", str(tmp_path), name)
    got = spark.table(name)
    assert got.count() == 4
    assert rows(got.select("Year", "Month", "FirstName", "LastName").distinct()) == [
        (2021, 5, "Ada", "Lane"),
        (None, None, "Cher", None),
    ]


def test_products_load_and_refresh(spark, database, tmp_path):
    (tmp_path / "p.csv").write_text("ProductID,ProductName,Category,ListPrice\n1,Trail,A,9.5\n")
    text, typed = f"{database}.products_text", f"{database}.products"
    landing.load(spark, "products", str(tmp_path), text)
    assert rows(spark.table(text)) == [("1", "Trail", "A", "9.5")]
    for _ in range(2):
        landing.refresh_products(spark, str(tmp_path), typed)
    assert rows(spark.table(typed)) == [(1, "Trail", "A", 9.5)]


def test_scratch_is_under_the_configured_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_root(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
