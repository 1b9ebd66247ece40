"""Declared schemas as DDL text. Nothing in this package infers a schema from data."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql.types import StructType


def struct(ddl: str) -> StructType:
    """The parsed form of a schema below; needs a running session."""
    return StructType.fromDDL(ddl)


# The columns, types and order of all files and tables below.

# --- sales files and tables -------------------------------------------------

ORDERS_CSV = (
    "SalesOrderNumber string, SalesOrderLineNumber int, OrderDate date, CustomerName string, "
    "Email string, Item string, Quantity int, UnitPrice float, Tax float"
)

# Same columns with wider money.
ORDERS_CSV_WIDE = (
    "SalesOrderNumber string, SalesOrderLineNumber int, OrderDate date, CustomerName string, "
    "Email string, Item string, Quantity int, UnitPrice double, Tax double"
)

PRODUCTS_CSV = "ProductID int, ProductName string, Category string, ListPrice double"

PRODUCTS_TYPED = "ProductID bigint, ProductName string, Category string, ListPrice double"

SALES_SILVER = (
    "SalesOrderNumber string, SalesOrderLineNumber int, OrderDate date, CustomerName string, "
    "Email string, Item string, Quantity int, UnitPrice float, Tax float, FileName string, "
    "IsFlagged boolean, CreatedTS date, ModifiedTS date"
)

DIM_DATE_GOLD = (
    "OrderDate date, Day int, Month int, Year int, mmmyyyy string, yyyymm string"
)
DIM_CUSTOMER_GOLD = (
    "CustomerName string, Email string, First string, Last string, CustomerID bigint"
)
DIM_PRODUCT_GOLD = "ItemName string, ItemID bigint, ItemInfo string"
FACT_SALES_GOLD = (
    "CustomerID bigint, ItemID bigint, OrderDate date, Quantity int, UnitPrice float, Tax float"
)

# --- sales warehouse ----------------------------------------------------------

DIM_CUSTOMER = (
    "CustomerKey int not null, CustomerAltKey varchar(50), Title varchar(5), "
    "FirstName varchar(50) not null, LastName varchar(50), AddressLine1 varchar(200), "
    "City varchar(50), StateProvince varchar(50), CountryRegion varchar(50), PostalCode varchar(20)"
)
DIM_DATE = (
    "DateKey int not null, DateAltKey date not null, DayOfWeek int not null, "
    "WeekDayName varchar(10), DayOfMonth int not null, Month int not null, "
    "MonthName varchar(12), Year int not null"
)
DIM_PRODUCT = (
    "ProductKey int not null, ProductAltKey varchar(25), ProductName varchar(50) not null, "
    "Category varchar(50), ListPrice decimal(18,0)"
)
FACT_SALES_ORDER = (
    "SalesOrderKey int not null, SalesOrderDateKey int not null, ProductKey int not null, "
    "CustomerKey int not null, Quantity int, SalesTotal decimal(18,0)"
)

# --- staff warehouse ----------------------------------------------------------

EMPLOYEES = (
    "employee_id int, name varchar(50), department_id int, hire_date date, salary decimal(10,2)"
)
DEPARTMENTS = (
    "department_id int, department_name varchar(50), manager varchar(50), location varchar(50)"
)
PROJECTS = (
    "project_id int, project_name varchar(50), department_id int, budget decimal(12,2), "
    "start_date date"
)
ASSIGNMENTS = (
    "assignment_id int, employee_id int, project_id int, assigned_date date, role varchar(50)"
)

# --- shop seeds -----------------------------------------------------------------

RAW_CUSTOMERS = "id int, first_name string, last_name string"
RAW_ORDERS = "id int, user_id int, order_date date, status string"
RAW_PAYMENTS = "id int, order_id int, payment_method string, amount int"

# --- streams ----------------------------------------------------------------------

STATION_EVENTS = (
    "BikepointID string, Street string, Neighbourhood string, Latitude double, "
    "Longitude double, No_Bikes bigint, No_Empty_Docks bigint"
)
STATION_TABLE = (
    "BikepointID string, Street string, Neighbourhood string, Latitude double, "
    "Longitude double, No_Bikes bigint, No_Empty_Docks bigint, EnqueuedTime timestamp"
)
BROKER_MESSAGES = "body string, EnqueuedTime timestamp"
DEVICE_STATUS = "device string not null, status string not null"


class ColumnMap(NamedTuple):
    """One column of a mapped load: where it comes from, its new name and type."""

    source: str
    target: str
    type: str


# Column names and sink types of the green-taxi trip load.
TRIP_COLUMNS = [
    ColumnMap("vendorID", "vendorID", "int"),
    ColumnMap("lpepPickupDatetime", "lpepPickupDatetime", "timestamp"),
    ColumnMap("lpepDropoffDatetime", "lpepDropoffDatetime", "timestamp"),
    ColumnMap("passengerCount", "passengerCount", "int"),
    ColumnMap("tripDistance", "tripDistance", "double"),
    ColumnMap("puLocationId", "puLocationId", "string"),
    ColumnMap("doLocationId", "doLocationId", "string"),
    ColumnMap("pickupLongitude", "pickupLongitude", "double"),
    ColumnMap("pickupLatitude", "pickupLatitude", "double"),
    ColumnMap("dropoffLongitude", "dropoffLongitude", "double"),
    ColumnMap("dropoffLatitude", "dropoffLatitude", "double"),
    ColumnMap("rateCodeID", "rateCodeID", "int"),
    ColumnMap("storeAndFwdFlag", "storeAndFwdFlag", "string"),
    ColumnMap("paymentType", "paymentType", "int"),
    ColumnMap("fareAmount", "fareAmount", "double"),
    ColumnMap("extra", "extra", "double"),
    ColumnMap("mtaTax", "mtaTax", "double"),
    ColumnMap("improvementSurcharge", "improvementSurcharge", "string"),
    ColumnMap("tipAmount", "tipAmount", "double"),
    ColumnMap("tollsAmount", "tollsAmount", "double"),
    ColumnMap("ehailFee", "ehailFee", "double"),
    ColumnMap("totalAmount", "totalAmount", "double"),
    ColumnMap("tripType", "tripType", "int"),
]
