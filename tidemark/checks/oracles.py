"""SQL for the registered queries, for an engine with the tables as views."""

from __future__ import annotations

FLAG_BEFORE = "1998-08-01"
FIRST_LOAD_BEFORE = "1996-01-01"
SHIPPED_FROM, SHIPPED_TO = "1997-01-01", "1998-12-31"

# --- the benchmark tables in the shape the reports read --------------------------

SALES = """
sales AS (
  SELECT 'SO' || l_orderkey AS SalesOrderNumber,
         l_linenumber AS SalesOrderLineNumber,
         CAST(o_orderdate AS DATE) AS OrderDate,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE replace(c_name, '#', ' ') END
           AS CustomerName,
         lower(replace(c_name, '#', '.')) || '@example.com' AS Email,
         CASE WHEN p_type = 'ECONOMY' THEN p_name ELSE p_name || ', ' || p_brand END AS Item,
         CAST(l_quantity AS INTEGER) AS Quantity,
         CAST(CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)
              // CAST(l_quantity AS BIGINT) AS DECIMAL(12,0)) * 0.01 AS DECIMAL(12,2)) AS UnitPrice,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
              AS DECIMAL(12,2)) AS Tax
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
)"""

CLEAN = f"""{SALES},
clean AS (
  SELECT SalesOrderNumber, SalesOrderLineNumber, OrderDate,
         CASE WHEN CustomerName IS NULL OR CustomerName = '' THEN 'Unknown' ELSE CustomerName END
           AS CustomerName,
         Email, Item, Quantity, UnitPrice, Tax,
         COALESCE(OrderDate < DATE '{FLAG_BEFORE}', FALSE) AS IsFlagged
  FROM sales
)"""

# A missing second part is empty text; second words and parts beyond are dropped.
SECOND_WORD = "CASE WHEN contains({0}, ' ') THEN split_part({0}, ' ', 2) END"
ITEM_NAME = "split_part(Item, ', ', 1)"
ITEM_INFO = "split_part(Item, ', ', 2)"

TABLE_ROWS = f"""WITH {CLEAN}
SELECT 'sales_silver' AS part, COUNT(*) AS row_count FROM clean
UNION ALL SELECT 'dimdate_gold', COUNT(DISTINCT OrderDate) FROM clean
UNION ALL SELECT 'dimcustomer_gold', COUNT(DISTINCT (CustomerName, Email)) FROM clean
UNION ALL SELECT 'dimproduct_gold', COUNT(DISTINCT ({ITEM_NAME}, {ITEM_INFO})) FROM clean
UNION ALL SELECT 'factsales_gold', COUNT(*) FROM clean"""
GOLD_TOTALS = f"""WITH {CLEAN}
SELECT CAST(year(OrderDate) AS INTEGER) AS Year, {ITEM_NAME} AS ItemName,
       COUNT(*) AS line_count, CAST(SUM(Quantity) AS BIGINT) AS quantity,
       COUNT(DISTINCT Email) AS buyers
FROM clean GROUP BY ALL"""

PRODUCTS = """
products AS (
  SELECT CAST(p_partkey AS INTEGER) AS ProductID, p_name AS ProductName, p_type AS Category,
         CAST(p_retailprice AS DECIMAL(12,2)) AS ListPrice
  FROM part
)"""
PRODUCTS_OUT = "ProductID, ProductName, Category, CAST(ListPrice AS DOUBLE) AS ListPrice"

SHOP = """
stg_customers AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name
  FROM customer
),
stg_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'placed'
                            WHEN 'P' THEN 'shipped' ELSE o_orderstatus END AS status
  FROM orders
),
stg_payments AS (
  SELECT l_orderkey * 10 + l_linenumber AS payment_id, l_orderkey AS order_id,
         CASE WHEN l_returnflag = 'R' THEN 'coupon' WHEN l_returnflag = 'A' THEN 'bank_transfer'
              WHEN l_linestatus = 'O' THEN 'credit_card' ELSE 'gift_card' END AS payment_method,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS amount
  FROM lineitem
),
mart_orders AS (
  SELECT o.*, c.credit_card_amount, c.coupon_amount, c.bank_transfer_amount,
         c.gift_card_amount, c.amount
  FROM stg_orders o
  LEFT JOIN (
    SELECT order_id, SUM(amount) AS amount,
           COALESCE(SUM(amount) FILTER (payment_method = 'credit_card'), 0)
             AS credit_card_amount,
           COALESCE(SUM(amount) FILTER (payment_method = 'coupon'), 0) AS coupon_amount,
           COALESCE(SUM(amount) FILTER (payment_method = 'bank_transfer'), 0)
             AS bank_transfer_amount,
           COALESCE(SUM(amount) FILTER (payment_method = 'gift_card'), 0) AS gift_card_amount
    FROM stg_payments GROUP BY order_id
  ) c USING (order_id)
),
mart_customers AS (
  SELECT customer_id, first_name, last_name, MIN(order_date) AS first_order,
         MAX(order_date) AS most_recent_order, NULLIF(COUNT(order_id), 0) AS number_of_orders,
         SUM(mart_orders.amount) AS customer_lifetime_value
  FROM stg_customers LEFT JOIN mart_orders USING (customer_id)
  GROUP BY customer_id, first_name, last_name
)"""
ORDER_STATES = "('placed', 'shipped', 'completed', 'return_pending', 'returned')"
METHODS = "('credit_card', 'coupon', 'bank_transfer', 'gift_card')"

WAREHOUSE = """
fact AS (
  SELECT CAST(l_orderkey AS INTEGER) AS SalesOrderKey,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS SalesOrderDateKey,
         CAST(l_partkey AS INTEGER) AS ProductKey, CAST(o_custkey AS INTEGER) AS CustomerKey,
         CAST(l_quantity AS INTEGER) AS Quantity,
         ROUND(CAST(l_extendedprice AS DECIMAL(12,2)), 0) AS SalesTotal
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
dates AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, d AS DateAltKey,
         CAST(dayofweek(d) + 1 AS INTEGER) AS DayOfWeek, strftime(d, '%A') AS WeekDayName,
         CAST(day(d) AS INTEGER) AS DayOfMonth, CAST(month(d) AS INTEGER) AS Month,
         strftime(d, '%B') AS MonthName, CAST(year(d) AS INTEGER) AS Year
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
),
customers AS (
  SELECT CAST(c_custkey AS INTEGER) AS CustomerKey, c_name AS CustomerAltKey,
         CAST(NULL AS VARCHAR) AS Title, split_part(c_name, '#', 1) AS FirstName,
         split_part(c_name, '#', 2) AS LastName, CAST(NULL AS VARCHAR) AS AddressLine1,
         CAST(NULL AS VARCHAR) AS City, c_mktsegment AS StateProvince,
         n_name AS CountryRegion, CAST(NULL AS VARCHAR) AS PostalCode
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

TRADING = """
tproducts AS (
  SELECT p_partkey AS ProductID, p_name || ' ' || p_partkey AS ProductName,
         CAST(p_retailprice AS DECIMAL(12,2)) AS UnitPrice, 'C-' || p_type AS CategoryID
  FROM part
),
categories AS (
  SELECT DISTINCT 'C-' || p_type AS CategoryID, p_type AS CategoryName FROM part
),
details AS (
  SELECT l_orderkey AS OrderID, l_partkey AS ProductID,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS UnitPrice,
         CAST(l_quantity AS INTEGER) AS Quantity, CAST(l_discount AS DECIMAL(4,2)) AS Discount
  FROM lineitem
),
torders AS (
  SELECT o_orderkey AS OrderID, o_custkey AS CustomerID, CAST(o_orderdate AS DATE) AS OrderDate,
         CAST(o_orderdate AS DATE) + 28 AS RequiredDate, ShippedDate, EmployeeID
  FROM orders LEFT JOIN (
    SELECT l_orderkey, CAST(MAX(l_shipdate) AS DATE) AS ShippedDate, MIN(l_suppkey) AS EmployeeID
    FROM lineitem GROUP BY l_orderkey
  ) ON o_orderkey = l_orderkey
),
employees AS (
  SELECT s_suppkey AS EmployeeID, split_part(s_name, '#', 2) AS LastName,
         split_part(s_name, '#', 1) AS FirstName, n_name AS Country
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
subtotals AS (
  SELECT OrderID, SUM(Quantity * (1 - Discount) * UnitPrice) AS Subtotal
  FROM details GROUP BY OrderID
)"""
LINE_AMOUNT = "Quantity * (1 - Discount) * d.UnitPrice"
DETAIL_OUT = f"""ProductName, CAST(ROUND(d.UnitPrice, 2) AS DOUBLE) AS UnitPrice, Quantity,
  CAST(Discount * 100 AS INTEGER) AS Discount,
  CAST(ROUND(CAST({LINE_AMOUNT} AS DECIMAL(19,4)), 2) AS DOUBLE) AS ExtendedPrice"""

STATIONS = """
stations AS (
  SELECT 'BP_' || user_id AS BikepointID, event_type AS Street,
         CASE WHEN user_id % 7 = 0 THEN '' ELSE 'N' || (user_id % 7) END AS Neighbourhood,
         CAST(51.0 AS DOUBLE) + CAST(user_id AS DOUBLE) / 4096 AS Latitude,
         CAST(-1.0 AS DOUBLE) + CAST(user_id AS DOUBLE) / 8192 AS Longitude,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 30 AS No_Bikes,
         CAST(json_extract_string(props, '$.k') AS BIGINT) // 10 AS No_Empty_Docks,
         ts AS EnqueuedTime, event_id AS EventID
  FROM events
),
base AS (
  SELECT *, ROUND(CAST(No_Bikes AS DOUBLE) / NULLIF(No_Bikes + No_Empty_Docks, 0), 6) AS fill_rate
  FROM stations
),
newest AS (SELECT MAX(EnqueuedTime) AS t FROM stations)"""
TIME_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
STATE_OUT = f"""BikepointID, Street, Neighbourhood, Latitude, Longitude, No_Bikes, No_Empty_Docks,
  {TIME_TEXT.format('EnqueuedTime')} AS EnqueuedTime, EventID, fill_rate"""
LATEST_FIRST = "PARTITION BY BikepointID ORDER BY EnqueuedTime DESC, EventID DESC"


EVENT_COUNTS = f"""WITH {STATIONS}
SELECT 'Total' AS Label, COUNT(*) AS Count, 1 AS "Order" FROM stations
UNION ALL
SELECT 'Last hour', COUNT(*), 2 FROM stations, newest WHERE EnqueuedTime > t - INTERVAL 1 HOUR
UNION ALL
SELECT 'Last minute', COUNT(*), 3 FROM stations, newest
WHERE EnqueuedTime > t - INTERVAL 1 MINUTE"""
# Events by micro-batch; from the third on, those up to a day before the newest event of the
# micro-batches before the last one are late. A watermark has whole milliseconds.
ARRIVALS = (
    STATIONS
    + """,
arrived AS (
  SELECT *, epoch_us(EnqueuedTime) AS us,
         CASE WHEN EventID % 5 = 0 THEN EventID * 7919 % {delay} ELSE 0 END AS delayed
  FROM stations
),
steps AS (
  SELECT *, least(4, ((us - (SELECT MIN(us) FROM arrived)) // 3600000000 + delayed) // 144) AS step
  FROM arrived
),
judged AS (
  SELECT s.*, (SELECT MAX(us) // 1000 * 1000 - 86400000000 FROM steps e WHERE e.step <= s.step - 2)
    AS late_until
  FROM steps s
)"""
)


def latest(condition: str) -> str:
    return f"""WITH {STATIONS}
SELECT {STATE_OUT} FROM (
  SELECT *, ROW_NUMBER() OVER ({LATEST_FIRST}) AS rn FROM base, newest WHERE {condition}
) WHERE rn = 1"""


def change(condition: str) -> str:
    """Newest and oldest values per station under a condition."""
    return f"""WITH {STATIONS},
numbered AS (
  SELECT *, ROW_NUMBER() OVER ({LATEST_FIRST}) AS newest_rn,
         ROW_NUMBER() OVER (PARTITION BY BikepointID ORDER BY EnqueuedTime, EventID) AS oldest_rn
  FROM base, newest WHERE {condition}
),
ends AS (
  SELECT n.BikepointID, n.Neighbourhood, n.Street, n.No_Bikes, n.No_Empty_Docks, n.fill_rate,
         o.No_Empty_Docks AS No_Empty_Docks1, o.No_Bikes AS No_Bikes1,
         n.No_Bikes - o.No_Bikes AS Bikes_change
  FROM numbered n JOIN numbered o USING (BikepointID)
  WHERE n.newest_rn = 1 AND o.oldest_rn = 1
)"""


def station_map(condition: str) -> str:
    return f"""WITH {STATIONS},
labelled AS (
  SELECT *, No_Empty_Docks || ' @' || BikepointID AS label
  FROM stations, newest WHERE {condition}
)
SELECT BikepointID, Latitude, Longitude, label AS "available docks",
       {TIME_TEXT.format('EnqueuedTime')} AS EnqueuedTime, No_Empty_Docks
FROM (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY BikepointID, Latitude, Longitude, label
    ORDER BY EnqueuedTime DESC, EventID DESC) AS rn
  FROM labelled
) WHERE rn = 1"""


def series(min_step_us: int, condition: str = "TRUE") -> str:
    """Grid, known points and linear fill, one row per station and bin."""
    return f"""WITH {STATIONS},
range_ AS (
  SELECT epoch_us(MIN(EnqueuedTime)) AS a, epoch_us(ANY_VALUE(t)) + 1 AS b
  FROM stations, newest WHERE {condition}
),
grid AS (SELECT a, b, GREATEST((b - a) // 100, {min_step_us}) AS s FROM range_),
known AS (
  SELECT BikepointID, (epoch_us(EnqueuedTime) - a) // s AS bin, MAX(No_Empty_Docks) AS v
  FROM stations, grid
  WHERE epoch_us(EnqueuedTime) >= a AND epoch_us(EnqueuedTime) < b AND {condition}
  GROUP BY ALL
),
cells AS (
  SELECT k.BikepointID, g.bin, known.v
  FROM (SELECT DISTINCT BikepointID FROM known) k
  CROSS JOIN (
    SELECT UNNEST(generate_series(CAST(0 AS BIGINT), (b - a - 1) // s)) AS bin FROM grid
  ) g
  LEFT JOIN known ON known.BikepointID = k.BikepointID AND known.bin = g.bin
),
around AS (
  SELECT BikepointID, bin,
         MAX(CASE WHEN v IS NOT NULL THEN bin END) OVER up AS b0,
         MIN(CASE WHEN v IS NOT NULL THEN bin END) OVER down AS b1
  FROM cells
  WINDOW up AS (PARTITION BY BikepointID ORDER BY bin ROWS UNBOUNDED PRECEDING),
         down AS (PARTITION BY BikepointID ORDER BY bin
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
filled AS (
  SELECT x.BikepointID, x.bin,
         CASE WHEN b0 IS NULL AND b1 IS NULL THEN 0.0
              WHEN b0 IS NULL THEN CAST(p1.v AS DOUBLE)
              WHEN b1 IS NULL OR b0 = b1 THEN CAST(p0.v AS DOUBLE)
              ELSE CAST(p0.v AS DOUBLE) + (CAST(p1.v AS DOUBLE) - CAST(p0.v AS DOUBLE))
                   * (CAST(x.bin - b0 AS DOUBLE) / CAST(b1 - b0 AS DOUBLE)) END AS v
  FROM around x
  LEFT JOIN known p0 ON p0.BikepointID = x.BikepointID AND p0.bin = b0
  LEFT JOIN known p1 ON p1.BikepointID = x.BikepointID AND p1.bin = b1
),
placed AS (
  SELECT BikepointID, bin, v, {TIME_TEXT.format('make_timestamp(a + bin * s)')} AS bin_time
  FROM filled, grid
)"""


TOTAL_DOCKS = """
SELECT bin_time, CAST(SUM(CAST(trunc(v) AS BIGINT)) AS BIGINT) AS "Available Docks"
FROM placed GROUP BY bin_time"""

DAY_US, TWO_MINUTES_US = 86_400_000_000, 120_000_000


def dashboard_tiles(area: str) -> str:
    """Rows and sums of the dashboard tiles of one neighbourhood."""
    here = f"Neighbourhood = '{area}'"
    hour = f"{here} AND EnqueuedTime > t - INTERVAL 1 HOUR"

    def tile(name: str, total: str, rows: str) -> str:
        return f"""SELECT '{name}' AS tile, COUNT(*) AS row_count,
  CAST(COALESCE(SUM({total}), 0) AS BIGINT) AS total FROM ({rows})"""

    stations = f"WITH {STATIONS} "
    tiles = [
        tile("fullest", "No_Bikes", change(hour)
             + " SELECT * FROM ends ORDER BY fill_rate DESC NULLS LAST, BikepointID LIMIT 10"),
        tile("emptiest", "No_Empty_Docks", change(hour)
             + " SELECT * FROM ends ORDER BY fill_rate NULLS LAST, BikepointID LIMIT 10"),
        tile("map", "No_Empty_Docks", station_map(hour)),
        tile("bikes_per_street", "n",
             f"{stations}SELECT SUM(No_Bikes) AS n FROM stations WHERE {here} GROUP BY Street"),
        f"""SELECT 'event_counts', 3, COUNT(*) + COUNT(*) FILTER (EnqueuedTime > t - INTERVAL 1 HOUR)
  + COUNT(*) FILTER (EnqueuedTime > t - INTERVAL 1 MINUTE)
  FROM ({stations}SELECT EnqueuedTime, t FROM stations, newest WHERE {here})""",
        tile("docks_fine", '"Available Docks"', series(TWO_MINUTES_US, here) + TOTAL_DOCKS),
        tile("docks_daily", '"Available Docks"', series(DAY_US, here) + TOTAL_DOCKS),
        tile("neighbourhood_choices", "0", f"{stations}SELECT DISTINCT Neighbourhood FROM stations"),
        tile("street_choices", "0", f"{stations}SELECT DISTINCT Street FROM stations WHERE {here}"),
    ]
    return "\nUNION ALL\n".join(tiles)

SALES_LINE = """SalesOrderNumber, SalesOrderLineNumber,
  strftime(OrderDate, '%Y-%m-%d') AS OrderDate, CustomerName, Email, Item, Quantity,
  CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(Tax AS DOUBLE) AS Tax"""

# A CSV file does not tell empty from missing text; Spark reads both as null.
SALES_FROM_CSV = f"""{SALES},
from_csv AS (SELECT * REPLACE (NULLIF(CustomerName, '') AS CustomerName) FROM sales)"""

TRANSFORMED = f"""SalesOrderNumber, SalesOrderLineNumber,
  strftime(OrderDate, '%Y-%m-%d') AS OrderDate,
  CAST(year(OrderDate) AS INTEGER) AS Year, CAST(month(OrderDate) AS INTEGER) AS Month,
  split_part(CustomerName, ' ', 1) AS FirstName,
  {SECOND_WORD.format('CustomerName')} AS LastName,
  Email, Item, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(Tax AS DOUBLE) AS Tax"""

DIM_DATE = """
SELECT strftime(d, '%Y-%m-%d') AS OrderDate, CAST(day(d) AS INTEGER) AS Day,
       CAST(month(d) AS INTEGER) AS Month, CAST(year(d) AS INTEGER) AS Year,
       strftime(d, '%b-%Y') AS mmmyyyy, strftime(d, '%Y%m') AS yyyymm
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE EXISTS (
  SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey))"""

CATEGORY_STATS = f"""{PRODUCTS},
stats AS (
  SELECT Category, COUNT(*) AS NumProducts, CAST(MIN(ListPrice) AS DOUBLE) AS MinPrice,
         CAST(MAX(ListPrice) AS DOUBLE) AS MaxPrice,
         ROUND(CAST(SUM(ListPrice) AS DOUBLE) / COUNT(*), 4) AS AvgPrice
  FROM products GROUP BY Category
)"""


def keyed(source: str, columns: str, order: str, key: str) -> str:
    """A dimension after a first load and a second one."""
    return f"""
members AS (SELECT DISTINCT {columns} FROM {source}),
early AS (SELECT DISTINCT {columns} FROM {source} WHERE OrderDate < DATE '{FIRST_LOAD_BEFORE}'),
existing AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS {key} FROM early),
fresh AS (
  SELECT m.*, (SELECT COALESCE(MAX({key}), 0) FROM existing)
              + ROW_NUMBER() OVER (ORDER BY {order}) AS {key}
  FROM members m
  WHERE NOT EXISTS (SELECT 1 FROM early e WHERE {same_key('e', 'm', order)})
)"""


def same_key(left: str, right: str, columns: str) -> str:
    names = [c.strip() for c in columns.split(",")]
    return " AND ".join(f"{left}.{c} = {right}.{c}" for c in names)


ALL_KEYS = f"""
dim_customers AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY CustomerName, Email) AS CustomerID
  FROM (SELECT DISTINCT CustomerName, Email FROM clean)
),
dim_products AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY ItemName, ItemInfo) AS ItemID
  FROM (SELECT DISTINCT {ITEM_NAME} AS ItemName, {ITEM_INFO} AS ItemInfo FROM clean)
),
facts AS (
  SELECT CustomerID, ItemID, OrderDate, Quantity, UnitPrice, Tax, ItemName
  FROM clean
  LEFT JOIN dim_customers USING (CustomerName, Email)
  LEFT JOIN dim_products
    ON ItemName = {ITEM_NAME} AND ItemInfo = {ITEM_INFO}
)"""

TEST_ROW = """SELECT '{table}' AS table_name, '{test}' AS test_name, '{column}' AS column_name,
  CAST(({count}) AS BIGINT) AS failures"""


def data_tests(*tests: tuple[str, str, str, str]) -> str:
    rows = "\nUNION ALL\n".join(
        TEST_ROW.format(table=t, test=k, column=c, count=n) for t, k, c, n in tests
    )
    return f"WITH {SHOP}\nSELECT *, failures = 0 AS passed FROM (\n{rows}\n)"


def unique(label: str, table: str, column: str) -> tuple[str, str, str, str]:
    count = (
        f"SELECT COUNT(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING COUNT(*) > 1)"
    )
    return label, "unique", column, count


def not_null(label: str, table: str, column: str) -> tuple[str, str, str, str]:
    return label, "not_null", column, f"SELECT COUNT(*) FROM {table} WHERE {column} IS NULL"


def accepted(label: str, table: str, column: str, values: str) -> tuple[str, str, str, str]:
    count = f"SELECT COUNT(DISTINCT {column}) FROM {table} WHERE {column} NOT IN {values}"
    return label, "accepted_values", column, count


def related(
    label: str, child: str, column: str, parent: str, condition: str = "TRUE"
) -> tuple[str, str, str, str]:
    count = (
        f"SELECT COUNT(*) FROM {child} c WHERE c.{column} IS NOT NULL AND NOT EXISTS ("
        f"SELECT 1 FROM {parent} p WHERE p.{column} = c.{column} AND {condition})"
    )
    return label, "relationships", column, count


AMOUNTS = (
    "credit_card_amount",
    "coupon_amount",
    "bank_transfer_amount",
    "gift_card_amount",
    "amount",
)
STAGING_TESTS = (
    unique("stg_customers", "stg_customers", "customer_id"),
    not_null("stg_customers", "stg_customers", "customer_id"),
    unique("stg_orders", "stg_orders", "order_id"),
    not_null("stg_orders", "stg_orders", "order_id"),
    accepted("stg_orders", "stg_orders", "status", ORDER_STATES),
    unique("stg_payments", "stg_payments", "payment_id"),
    not_null("stg_payments", "stg_payments", "payment_id"),
    accepted("stg_payments", "stg_payments", "payment_method", METHODS),
)
ORDER_NULL_TESTS = tuple(
    not_null("orders", "mart_orders", c) for c in ("order_id", "customer_id", *AMOUNTS)
)
MART_TESTS = (
    unique("customers", "mart_customers", "customer_id"),
    not_null("customers", "mart_customers", "customer_id"),
    unique("orders", "mart_orders", "order_id"),
    *ORDER_NULL_TESTS,
    related("orders", "mart_orders", "customer_id", "mart_customers"),
    accepted("orders", "mart_orders", "status", ORDER_STATES),
)

SHIPPED = f"ShippedDate BETWEEN DATE '{SHIPPED_FROM}' AND DATE '{SHIPPED_TO}'"
VERSIONED = f"""{PRODUCTS},
v0 AS (SELECT * FROM products),
v1 AS (
  SELECT * REPLACE (CAST(CASE WHEN Category = 'STANDARD' THEN ROUND(ListPrice * 0.9, 2)
                              ELSE ListPrice END AS DECIMAL(12,2)) AS ListPrice) FROM v0
),
v2 AS (
  SELECT * REPLACE (CASE WHEN Category = 'ECONOMY' THEN upper(ProductName)
                         ELSE ProductName END AS ProductName) FROM v1 WHERE Category <> 'PROMO'
),
v3 AS (
  SELECT * REPLACE (CASE WHEN Category = 'STANDARD' THEN ProductName || ' II'
                         ELSE ProductName END AS ProductName) FROM v2
  UNION ALL
  SELECT * REPLACE (ProductName || ' II' AS ProductName) FROM v0 WHERE Category = 'PROMO'
)"""


def oracle_sql() -> dict[str, str]:
    return {
        # sales
        "sales_clean": f"WITH {CLEAN} SELECT {SALES_LINE}, IsFlagged FROM clean",
        "sales_transformed": f"WITH {SALES} SELECT {TRANSFORMED} FROM sales",
        "customer_counts": f"""WITH {SALES}
SELECT COUNT(*) AS row_count, COUNT(DISTINCT (CustomerName, Email)) AS distinct_count
FROM sales""",
        "customers_distinct": f"WITH {SALES} SELECT DISTINCT CustomerName, Email FROM sales",
        "customers_by_item": f"""WITH {SALES}
SELECT DISTINCT CustomerName, Email FROM sales WHERE Item = 'small ring'""",
        "product_quantity": f"""WITH {SALES}
SELECT Item, CAST(SUM(Quantity) AS BIGINT) AS "sum_Quantity" FROM sales GROUP BY Item""",
        "yearly_orders": f"""WITH {SALES}
SELECT CAST(year(OrderDate) AS INTEGER) AS Year, COUNT(*) AS "count"
FROM sales GROUP BY 1 ORDER BY 1""",
        "yearly_revenue": f"""WITH {SALES}
SELECT CAST(year(OrderDate) AS INTEGER) AS OrderYear,
       CAST(SUM(UnitPrice * Quantity + Tax) AS DOUBLE) AS GrossRevenue
FROM sales GROUP BY 1 ORDER BY 1""",
        "yearly_revenue_orders": f"""WITH {SALES}
SELECT CAST(year(OrderDate) AS VARCHAR) AS OrderYear,
       CAST(SUM(UnitPrice * Quantity + Tax) AS DOUBLE) AS GrossRevenue,
       COUNT(DISTINCT SalesOrderNumber) AS YearlyCounts
FROM sales GROUP BY 1 ORDER BY 1""",
        "category_stats": f"WITH {CATEGORY_STATS} SELECT * FROM stats",
        "category_top10": f"""WITH {CATEGORY_STATS}
SELECT Category, NumProducts FROM stats ORDER BY NumProducts DESC, Category LIMIT 10""",
        "category_avg_top6": f"""WITH {CATEGORY_STATS}
SELECT Category, MinPrice, MaxPrice, AvgPrice FROM stats ORDER BY AvgPrice DESC, Category
LIMIT 6""",
        # files and tables
        "sales_csv_roundtrip": f"WITH {SALES_FROM_CSV} SELECT {SALES_LINE} FROM from_csv",
        "copy_csv": f"WITH {SALES_FROM_CSV} SELECT {SALES_LINE} FROM from_csv",
        "products_header_csv": f"WITH {PRODUCTS} SELECT {PRODUCTS_OUT} FROM products",
        "products_positional_csv": f"""WITH {PRODUCTS}
SELECT CAST(ProductID AS VARCHAR) AS _c0, ProductName AS _c1, Category AS _c2,
       CAST(ListPrice AS VARCHAR) AS _c3
FROM products""",
        "typed_csv_load": f"""WITH {PRODUCTS}
SELECT CAST(ProductID AS BIGINT) AS ProductID, ProductName, Category,
       CASE WHEN Category <> 'PROMO' THEN CAST(ListPrice AS DOUBLE) END AS ListPrice
FROM products""",
        "typed_csv_replace": f"""WITH {PRODUCTS}
SELECT * REPLACE (CAST(ProductID AS BIGINT) AS ProductID) FROM (
  SELECT {PRODUCTS_OUT} FROM products)""",
        "table_limit": f"""WITH {PRODUCTS}
SELECT COUNT(*) AS row_count, COUNT(*) AS known_rows FROM (SELECT * FROM products LIMIT 7)""",
        "provenance_counts": f"""WITH {SALES}
SELECT CASE WHEN OrderDate < DATE '{FIRST_LOAD_BEFORE}' THEN 'early' ELSE 'late' END AS folder,
       COUNT(*) AS row_count, COUNT(*) AS dated_today
FROM sales GROUP BY 1""",
        "sales_partition_year": f"""WITH {SALES}
SELECT {TRANSFORMED} FROM sales WHERE year(OrderDate) = 1997""",
        "typed_mapping_load": f"""
SELECT CAST(l_suppkey AS INTEGER) AS "vendorID",
       {TIME_TEXT.format('l_shipdate')} AS "lpepPickupDatetime",
       {TIME_TEXT.format('l_shipdate + INTERVAL 1 HOUR')} AS "lpepDropoffDatetime",
       l_linenumber AS "passengerCount", l_quantity AS "tripDistance",
       CAST(l_partkey AS VARCHAR) AS "puLocationId",
       CAST(l_suppkey AS VARCHAR) AS "doLocationId",
       l_discount AS "pickupLongitude", l_tax AS "pickupLatitude",
       l_tax AS "dropoffLongitude", l_discount AS "dropoffLatitude",
       l_linenumber AS "rateCodeID", l_returnflag AS "storeAndFwdFlag",
       l_linenumber AS "paymentType", l_extendedprice AS "fareAmount",
       CAST(0.5 AS DOUBLE) AS "extra", CAST(0.5 AS DOUBLE) AS "mtaTax",
       '0.3' AS "improvementSurcharge", l_discount AS "tipAmount",
       CAST(0 AS DOUBLE) AS "tollsAmount", CAST(NULL AS DOUBLE) AS "ehailFee",
       l_extendedprice AS "totalAmount", 1 AS "tripType"
FROM lineitem""",
        "table_append": f"WITH {PRODUCTS} SELECT {PRODUCTS_OUT} FROM products",
        "table_external": f"WITH {PRODUCTS} SELECT {PRODUCTS_OUT} FROM products",
        "table_create_if_absent": DIM_DATE,
        "load_sales": f"""WITH {SALES_FROM_CSV}
SELECT SalesOrderNumber, CAST(SalesOrderLineNumber AS VARCHAR) AS SalesOrderLineNumber,
       CAST(OrderDate AS VARCHAR) AS OrderDate,
       CAST(year(OrderDate) AS INTEGER) AS Year, CAST(month(OrderDate) AS INTEGER) AS Month,
       split_part(CustomerName, ' ', 1) AS FirstName,
       {SECOND_WORD.format('CustomerName')} AS LastName, Email AS EmailAddress, Item,
       CAST(Quantity AS VARCHAR) AS Quantity, CAST(CAST(UnitPrice AS DOUBLE) AS VARCHAR) AS UnitPrice,
       CAST(CAST(Tax AS DOUBLE) AS VARCHAR) AS TaxAmount
FROM from_csv""",
        "typed_warehouse_load": f"WITH {WAREHOUSE} SELECT * FROM customers",
        "typed_dim_date": f"""WITH {WAREHOUSE}
SELECT * REPLACE (strftime(DateAltKey, '%Y-%m-%d') AS DateAltKey) FROM dates""",
        "typed_dim_product": """
SELECT CAST(p_partkey AS INTEGER) AS ProductKey, p_brand AS ProductAltKey,
       p_name AS ProductName, p_type AS Category,
       CAST(ROUND(CAST(p_retailprice AS DECIMAL(12,2)), 0) AS DOUBLE) AS ListPrice
FROM part""",
        "typed_fact_sales": f"""WITH {WAREHOUSE}
SELECT * REPLACE (CAST(SalesTotal AS DOUBLE) AS SalesTotal) FROM fact""",
        # dimensions and facts
        "dim_date": DIM_DATE,
        "dim_date_warehouse": f"""WITH {WAREHOUSE}
SELECT * REPLACE (strftime(DateAltKey, '%Y-%m-%d') AS DateAltKey) FROM dates""",
        "dim_customer": f"""WITH {CLEAN}
SELECT CustomerName, Email, split_part(CustomerName, ' ', 1) AS First,
       {SECOND_WORD.format('CustomerName')} AS Last
FROM (SELECT DISTINCT CustomerName, Email FROM clean)""",
        "dim_product": f"""WITH {SALES}
SELECT MIN(Item) AS Item, {ITEM_NAME} AS ItemName, {ITEM_INFO} AS ItemInfo
FROM sales GROUP BY {ITEM_NAME}, {ITEM_INFO}""",
        "dim_customer_keys": f"""WITH {CLEAN},
{keyed('clean', 'CustomerName, Email', 'CustomerName, Email', 'CustomerID')}
SELECT CustomerName, Email, split_part(CustomerName, ' ', 1) AS First,
       {SECOND_WORD.format('CustomerName')} AS Last, CustomerID
FROM (SELECT * FROM existing UNION ALL SELECT * FROM fresh)""",
        "dim_product_keys": f"""WITH {SALES},
items AS (SELECT OrderDate, {ITEM_NAME} AS ItemName, {ITEM_INFO} AS ItemInfo FROM sales),
{keyed('items', 'ItemName, ItemInfo', 'ItemName, ItemInfo', 'ItemID')}
SELECT ItemName, ItemID, ItemInfo FROM (SELECT * FROM existing UNION ALL SELECT * FROM fresh)""",
        "fact_sales": f"""WITH {CLEAN}, {ALL_KEYS}
SELECT CustomerID, ItemID, strftime(OrderDate, '%Y-%m-%d') AS OrderDate, Quantity,
       CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(Tax AS DOUBLE) AS Tax
FROM facts""",
        "merge_insert_only": f"""WITH {CLEAN},
target AS (SELECT * FROM clean WHERE OrderDate < DATE '{FIRST_LOAD_BEFORE}')
SELECT {SALES_LINE}, IsFlagged FROM (
  SELECT * FROM target
  UNION ALL
  SELECT u.* FROM clean u WHERE NOT EXISTS (
    SELECT 1 FROM target t
    WHERE {same_key('t', 'u', 'SalesOrderNumber, OrderDate, CustomerName, Item')})
)""",
        "merge_upsert": """WITH o AS (
  SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
         o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS amount
  FROM orders
),
target AS (SELECT * FROM o WHERE order_date < DATE '1999-01-01'),
updates AS (
  SELECT order_id, order_date, lower(status) AS status, amount FROM o
  WHERE order_date >= DATE '1997-01-01'
)
SELECT COALESCE(t.order_id, u.order_id) AS order_id,
       strftime(COALESCE(t.order_date, u.order_date), '%Y-%m-%d') AS order_date,
       COALESCE(u.status, t.status) AS status,
       CAST(COALESCE(t.amount, 0) + COALESCE(u.amount, 0) AS DOUBLE) AS amount
FROM target t FULL JOIN updates u ON t.order_id = u.order_id""",
        "conditional_update": f"WITH {VERSIONED} SELECT {PRODUCTS_OUT} FROM v1",
        "version_as_of": f"""WITH {VERSIONED}
SELECT {PRODUCTS_OUT}, version FROM (
  SELECT *, 0 AS version FROM v0 UNION ALL SELECT *, 1 FROM v1 UNION ALL SELECT *, 2 FROM v2
  UNION ALL SELECT *, 3 FROM v3 UNION ALL SELECT *, 4 FROM v3
)""",
        "version_snapshots": f"""WITH {PRODUCTS}
SELECT ProductID, ProductName, Category, version,
       CAST(ListPrice + (
         SELECT COALESCE(SUM(s), 0) FROM unnest(range(1, 8)) r(s) WHERE s <= version AND s % 5 = ProductID % 5
       ) AS DOUBLE) AS ListPrice
FROM products, (VALUES (0), (2), (3), (5), (7)) AS v(version)""",
        "version_history": f"""WITH {PRODUCTS},
n AS (
  SELECT COUNT(*) AS every, COUNT(*) FILTER (Category = 'STANDARD') AS standard,
         COUNT(*) FILTER (Category = 'ECONOMY') AS economy,
         COUNT(*) FILTER (Category = 'PROMO') AS promo
  FROM products
)
SELECT 0 AS version, 'WRITE' AS operation, every AS rows_inserted,
       CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted FROM n
UNION ALL SELECT 1, 'UPDATE', 0, standard, 0 FROM n
UNION ALL SELECT 2, 'REVISION', 0, economy, promo FROM n
UNION ALL SELECT 3, 'MERGE', promo, standard, 0 FROM n
UNION ALL SELECT 4, 'MERGE', 0, 0, 0 FROM n""",
        "medallion_second_run": f"SELECT part AS table_name, row_count FROM ({TABLE_ROWS})",
        "medallion_feed": f"""{TABLE_ROWS}
UNION ALL SELECT 'delivery 1', COUNT(*) FROM clean WHERE OrderDate < DATE '{FIRST_LOAD_BEFORE}'
UNION ALL SELECT 'delivery 2', COUNT(*) FROM clean WHERE OrderDate >= DATE '{FIRST_LOAD_BEFORE}'""",
        "medallion_totals": GOLD_TOTALS,
        "medallion_feed_totals": GOLD_TOTALS,
        # shop
        "stg_customers": f"WITH {SHOP} SELECT * FROM stg_customers",
        "stg_orders": f"""WITH {SHOP}
SELECT * REPLACE (strftime(order_date, '%Y-%m-%d') AS order_date) FROM stg_orders""",
        "stg_payments": f"""WITH {SHOP}
SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM stg_payments""",
        "mart_customers": f"""WITH {SHOP}
SELECT customer_id, first_name, last_name,
       strftime(first_order, '%Y-%m-%d') AS first_order,
       strftime(most_recent_order, '%Y-%m-%d') AS most_recent_order,
       CAST(number_of_orders AS DOUBLE) AS number_of_orders,
       CAST(customer_lifetime_value AS DOUBLE) AS customer_lifetime_value
FROM mart_customers""",
        "shop_seeds": f"""WITH {SHOP}
SELECT customer_id, first_name, last_name,
       strftime(first_order, '%Y-%m-%d') AS first_order,
       strftime(most_recent_order, '%Y-%m-%d') AS most_recent_order,
       CAST(number_of_orders AS DOUBLE) AS number_of_orders,
       CAST(customer_lifetime_value AS DOUBLE) AS customer_lifetime_value
FROM mart_customers""",
        "mart_orders": f"""WITH {SHOP}
SELECT order_id, customer_id, strftime(order_date, '%Y-%m-%d') AS order_date, status,
       CAST(credit_card_amount AS DOUBLE) AS credit_card_amount,
       CAST(coupon_amount AS DOUBLE) AS coupon_amount,
       CAST(bank_transfer_amount AS DOUBLE) AS bank_transfer_amount,
       CAST(gift_card_amount AS DOUBLE) AS gift_card_amount, CAST(amount AS DOUBLE) AS amount
FROM mart_orders""",
        "payments_by_customer": f"""WITH {SHOP}
SELECT CAST(o.customer_id AS DOUBLE) AS customer_id, CAST(SUM(p.amount) AS DOUBLE) AS total_amount
FROM stg_payments p
LEFT JOIN (SELECT * FROM stg_orders WHERE order_date >= DATE '{FIRST_LOAD_BEFORE}') o
  ON p.order_id = o.order_id
GROUP BY o.customer_id""",
        "quality_unique": data_tests(
            unique("stg_customers", "stg_customers", "customer_id"),
            unique("stg_orders", "stg_orders", "order_id"),
            unique("stg_payments", "stg_payments", "payment_id"),
        ),
        "quality_not_null": data_tests(*ORDER_NULL_TESTS),
        "quality_accepted_values": data_tests(
            accepted("stg_orders", "stg_orders", "status", ORDER_STATES),
            accepted("open_orders", "stg_orders", "status", "('placed')"),
            accepted("stg_payments", "stg_payments", "payment_method", METHODS),
        ),
        "quality_relationships": data_tests(
            related("orders", "stg_orders", "customer_id", "stg_customers"),
            related("payments", "stg_payments", "order_id", "stg_orders"),
            related(
                "late_payments",
                "stg_payments",
                "order_id",
                "stg_orders",
                f"p.order_date >= DATE '{FIRST_LOAD_BEFORE}'",
            ),
        ),
        "shop_build": data_tests(*STAGING_TESTS, *MART_TESTS),
        # warehouse and star
        "sales_by_region": f"""WITH {WAREHOUSE}
SELECT Year AS CalendarYear, Month AS MonthOfYear, MonthName, CountryRegion AS SalesRegion,
       CAST(SUM(SalesTotal) AS DOUBLE) AS SalesRevenue
FROM fact
JOIN dates ON SalesOrderDateKey = DateKey
JOIN customers USING (CustomerKey)
GROUP BY ALL""",
        "star_measures": f"""WITH {WAREHOUSE}
SELECT p_type AS Category, CountryRegion, Year,
       COUNT(SalesOrderKey) AS "count_SalesOrderKey",
       CAST(SUM(Quantity) AS BIGINT) AS "sum_Quantity",
       CAST(SUM(SalesTotal) AS DOUBLE) AS "sum_SalesTotal"
FROM fact
LEFT JOIN part ON ProductKey = p_partkey
LEFT JOIN customers USING (CustomerKey)
LEFT JOIN dates ON SalesOrderDateKey = DateKey
GROUP BY ALL""",
        "star_measures_gold": f"""WITH {CLEAN}, {ALL_KEYS}
SELECT ItemName, strftime(OrderDate, '%Y%m') AS yyyymm,
       CAST(SUM(Quantity) AS BIGINT) AS "sum_Quantity",
       CAST(SUM(UnitPrice) AS DOUBLE) AS "sum_UnitPrice", CAST(SUM(Tax) AS DOUBLE) AS "sum_Tax"
FROM facts GROUP BY ALL""",
        # trading reports
        "cust_order_hist": f"""WITH {TRADING}
SELECT ProductName, CAST(SUM(Quantity) AS BIGINT) AS Total
FROM tproducts JOIN details USING (ProductID) JOIN torders USING (OrderID)
WHERE CustomerID = 42 GROUP BY ProductName""",
        "cust_order_hist_all": f"""WITH {TRADING}
SELECT CustomerID, ProductName, CAST(SUM(Quantity) AS BIGINT) AS Total
FROM tproducts JOIN details USING (ProductID) JOIN torders USING (OrderID)
GROUP BY CustomerID, ProductName""",
        "cust_orders_detail": f"""WITH {TRADING}
SELECT {DETAIL_OUT} FROM tproducts p JOIN details d ON p.ProductID = d.ProductID
WHERE OrderID = 1024""",
        "cust_orders_detail_all": f"""WITH {TRADING}
SELECT OrderID, {DETAIL_OUT} FROM tproducts p JOIN details d ON p.ProductID = d.ProductID""",
        "cust_orders_orders": f"""WITH {TRADING}
SELECT OrderID, strftime(OrderDate, '%Y-%m-%d') AS OrderDate,
       strftime(RequiredDate, '%Y-%m-%d') AS RequiredDate,
       strftime(ShippedDate, '%Y-%m-%d') AS ShippedDate
FROM torders WHERE CustomerID = 42 ORDER BY OrderID""",
        "cust_orders_orders_all": f"""WITH {TRADING}
SELECT CustomerID, OrderID, strftime(OrderDate, '%Y-%m-%d') AS OrderDate,
       strftime(RequiredDate, '%Y-%m-%d') AS RequiredDate,
       strftime(ShippedDate, '%Y-%m-%d') AS ShippedDate
FROM torders""",
        "employee_sales": f"""WITH {TRADING}
SELECT Country, LastName, FirstName, strftime(ShippedDate, '%Y-%m-%d') AS ShippedDate, OrderID,
       CAST(Subtotal AS DOUBLE) AS SaleAmount
FROM torders JOIN subtotals USING (OrderID) JOIN employees USING (EmployeeID) WHERE {SHIPPED}""",
        "sales_by_year": f"""WITH {TRADING}
SELECT strftime(ShippedDate, '%Y-%m-%d') AS ShippedDate, OrderID,
       CAST(Subtotal AS DOUBLE) AS Subtotal, strftime(ShippedDate, '%Y') AS Year
FROM torders JOIN subtotals USING (OrderID) WHERE {SHIPPED}""",
        "sales_by_category": f"""WITH {TRADING}
SELECT ProductName,
       CAST(ROUND(SUM(CAST({LINE_AMOUNT} AS DECIMAL(14,2))), 0) AS DOUBLE) AS TotalPurchase
FROM details d
JOIN torders USING (OrderID)
JOIN tproducts p ON p.ProductID = d.ProductID
JOIN categories USING (CategoryID)
WHERE CategoryName = 'STANDARD' AND strftime(OrderDate, '%Y') = '1998'
GROUP BY ProductName ORDER BY ProductName""",
        "ten_most_expensive": f"""WITH {TRADING}
SELECT ProductName AS TenMostExpensiveProducts, CAST(UnitPrice AS DOUBLE) AS UnitPrice
FROM tproducts ORDER BY tproducts.UnitPrice DESC, ProductName LIMIT 10""",
        # stations
        "station_filter": f"""WITH {STATIONS}
SELECT {STATE_OUT} FROM base
WHERE Neighbourhood IN ('N1', 'N3') AND Street IN ('click', 'view')""",
        "station_choices": f"""WITH {STATIONS}
SELECT DISTINCT Street FROM stations WHERE Neighbourhood IN ('N2')""",
        "station_neighbourhoods": f"""WITH {STATIONS}
SELECT DISTINCT Neighbourhood FROM stations""",
        "station_points_on_street": f"""WITH {STATIONS}
SELECT DISTINCT BikepointID FROM stations WHERE Street = 'click'""",
        "station_latest": latest("EnqueuedTime > t - INTERVAL 1 HOUR"),
        "station_latest_all": latest("TRUE"),
        "station_latest_filtered": latest(
            "EnqueuedTime > t - INTERVAL 1 DAY AND Neighbourhood IN ('N1', 'N2')"
        ),
        "station_change_all": change("TRUE") + "\nSELECT * FROM ends",
        "stream_station_change": change("TRUE") + "\nSELECT * FROM ends",
        "station_change_top10": change("EnqueuedTime > t - INTERVAL 1 DAY")
        + """
SELECT BikepointID, Neighbourhood, Street, No_Bikes, No_Empty_Docks, Bikes_change
FROM ends ORDER BY fill_rate DESC NULLS LAST, BikepointID LIMIT 10""",
        "station_available_top10": change("EnqueuedTime > t - INTERVAL 1 DAY")
        + """
SELECT BikepointID, Neighbourhood, Street, No_Bikes, No_Empty_Docks, Bikes_change
FROM ends ORDER BY fill_rate ASC NULLS LAST, BikepointID LIMIT 10""",
        "station_map": station_map("EnqueuedTime > t - INTERVAL 1 HOUR"),
        "station_map_all": station_map("TRUE"),
        "station_street_bikes": f"""WITH {STATIONS}
SELECT Street, CAST(SUM(No_Bikes) AS BIGINT) AS "countBikes" FROM stations GROUP BY Street""",
        "station_top_street_docks": f"""WITH {STATIONS}
SELECT Street, CAST(SUM(No_Empty_Docks) AS BIGINT) AS "countEmptyDocks"
FROM stations GROUP BY Street ORDER BY 2 DESC, Street LIMIT 5""",
        "station_top_point": f"""WITH {STATIONS}
SELECT BikepointID, CAST(SUM(No_Bikes) AS BIGINT) AS SumOfBikes
FROM stations GROUP BY BikepointID ORDER BY 2 DESC, BikepointID LIMIT 1""",
        "station_area_counts": f"""WITH {STATIONS}
SELECT Neighbourhood, COUNT(*) AS count_ FROM stations GROUP BY Neighbourhood""",
        "station_neighbourhood": f"""WITH {STATIONS}
SELECT COALESCE(NULLIF(Neighbourhood, ''), 'Unidentified') AS Neighbourhood,
       CAST(SUM(No_Bikes) AS BIGINT) AS "Total Number of Bikes"
FROM stations GROUP BY 1 ORDER BY 2 DESC, 1""",
        "station_neighbourhood_order": f"""WITH {STATIONS}
SELECT CAST(ROW_NUMBER() OVER (ORDER BY bikes DESC, Neighbourhood) AS INTEGER) AS place,
       Neighbourhood
FROM (
  SELECT CASE WHEN Neighbourhood = '' THEN 'Unidentified' ELSE Neighbourhood END
           AS Neighbourhood, SUM(No_Bikes) AS bikes
  FROM stations GROUP BY 1
)""",
        "station_daily": f"""WITH {STATIONS}
SELECT {TIME_TEXT.format("date_trunc('day', EnqueuedTime)")} AS day,
       CAST(SUM(No_Bikes) AS BIGINT) AS "countBikes"
FROM stations GROUP BY 1""",
        "station_counts": EVENT_COUNTS,
        "stream_counts": EVENT_COUNTS,
        "station_matrix": f"""WITH {STATIONS}
SELECT Neighbourhood, Street, BikepointID,
       CAST(GROUPING(Neighbourhood) + GROUPING(Street) + GROUPING(BikepointID) AS INTEGER)
         AS level,
       CAST(SUM(No_Bikes) AS BIGINT) AS No_Bikes,
       CAST(SUM(No_Empty_Docks) AS BIGINT) AS No_Empty_Docks
FROM stations GROUP BY ROLLUP (Neighbourhood, Street, BikepointID)""",
        "station_street_nonnull": f"""WITH {STATIONS}
SELECT Street, COUNT(BikepointID) AS point_count,
       CAST(SUM(No_Empty_Docks) AS BIGINT) AS empty_docks
FROM stations GROUP BY Street ORDER BY point_count DESC, Street""",
        "station_geo": f"""WITH {STATIONS}
SELECT Longitude, Latitude, CAST(SUM(No_Bikes) AS BIGINT) AS bikes
FROM stations GROUP BY Longitude, Latitude""",
        "station_prev_change": f"""WITH {STATIONS}
SELECT BikepointID, Street, Neighbourhood, Latitude, Longitude, No_Bikes, No_Empty_Docks,
       {TIME_TEXT.format('EnqueuedTime')} AS EnqueuedTime, EventID,
       CAST(LAG(No_Bikes) OVER w - No_Bikes AS DOUBLE) AS "CountChange",
       CAST(LAG(No_Empty_Docks) OVER w - No_Empty_Docks AS DOUBLE) AS "EmptyCountChange"
FROM (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER ({LATEST_FIRST}) AS rn FROM stations) WHERE rn <= 2
)
WINDOW w AS (PARTITION BY BikepointID ORDER BY EnqueuedTime, EventID)""",
        "station_limit": f"""WITH {STATIONS}
SELECT COUNT(*) AS row_count, COUNT(*) AS known_rows FROM (SELECT * FROM stations LIMIT 10)""",
        "dashboard_tiles": dashboard_tiles("N3"),
        # series
        "series_daily_docks": series(DAY_US) + TOTAL_DOCKS,
        "series_2min_docks": series(TWO_MINUTES_US) + TOTAL_DOCKS,
        "series_per_station": series(DAY_US)
        + """
SELECT BikepointID, bin, bin_time, ROUND(v, 6) AS No_Empty_Docks FROM placed""",
        "series_from_partials": f"""
SELECT 'daily' AS report, bin_time, "Available Docks" FROM ({series(DAY_US)}{TOTAL_DOCKS})
UNION ALL
SELECT 'fine', bin_time, "Available Docks" FROM ({series(TWO_MINUTES_US)}{TOTAL_DOCKS})""",
        "dashboard_from_partials": f"""
SELECT 'docks_fine' AS tile, bin_time, "Available Docks"
FROM ({series(TWO_MINUTES_US, "Neighbourhood = 'N3'")}{TOTAL_DOCKS})
UNION ALL
SELECT 'docks_daily', bin_time, "Available Docks"
FROM ({series(DAY_US, "Neighbourhood = 'N3'")}{TOTAL_DOCKS})""",
        "series_alert": f"""SELECT * FROM ({series(DAY_US)}{TOTAL_DOCKS})
WHERE "Available Docks" >= 900""",
        "alert_runs": f"""WITH r1 AS (
  SELECT left(bin_time, 10) AS day, CAST("Available Docks" AS DOUBLE) AS docks
  FROM ({series(DAY_US, 'EventID % 3 <> 0')}{TOTAL_DOCKS})
),
r2 AS (
  SELECT left(bin_time, 10) AS day, CAST("Available Docks" AS DOUBLE) AS docks
  FROM ({series(DAY_US)}{TOTAL_DOCKS})
)
SELECT 1 AS run, 'raised' AS event, day, docks FROM r1 WHERE docks >= 60
UNION ALL
SELECT 2, 'raised', day, docks FROM r2
WHERE docks >= 60 AND day NOT IN (SELECT day FROM r1 WHERE docks >= 60)
UNION ALL
SELECT 2, 'corrected', day, r2.docks FROM r2 JOIN r1 USING (day)
WHERE r1.docks >= 60 AND r2.docks >= 60 AND r1.docks <> r2.docks
UNION ALL
SELECT 2, 'cleared', day, r1.docks FROM r2 JOIN r1 USING (day)
WHERE r1.docks >= 60 AND r2.docks < 60""",
        # streams
        "stream_files": """
SELECT 'Dev' || user_id AS device, event_type AS status, COUNT(*) AS readings
FROM events GROUP BY ALL""",
        "stream_tumbling": f"""WITH {STATIONS}
SELECT Street, CAST(SUM(No_Bikes) AS DOUBLE) AS "SUM_No_Bikes",
       {TIME_TEXT.format('make_timestamp(w)')} AS "Window_End_Time"
FROM (
  SELECT Street, No_Bikes, (epoch_us(EnqueuedTime) // 5000000 + 1) * 5000000 AS w FROM stations
)
GROUP BY Street, w""",
        "stream_alert": f"""WITH {STATIONS}
SELECT BikepointID, MAX(No_Empty_Docks) AS docks,
       {TIME_TEXT.format("date_trunc('day', EnqueuedTime)")} AS window_start
FROM stations GROUP BY BikepointID, date_trunc('day', EnqueuedTime)
HAVING MAX(No_Empty_Docks) >= 9""",
        "stream_closed_windows": f"""WITH {ARRIVALS.format(delay=288)}
SELECT Street, CAST(SUM(No_Bikes) AS DOUBLE) AS "SUM_No_Bikes", COUNT(*) AS n_events,
       {TIME_TEXT.format('make_timestamp(w)')} AS "Window_End_Time"
FROM (
  SELECT Street, No_Bikes, (us // 5000000 + 1) * 5000000 AS w FROM judged
  WHERE late_until IS NULL OR us > late_until
)
WHERE w <= (SELECT MAX(us) // 1000 * 1000 - 86400000000 FROM judged)
GROUP BY Street, w""",
        "stream_late_events": f"""WITH {ARRIVALS.format(delay=288)}
SELECT CAST(step AS INTEGER) AS step, COUNT(*) AS input_rows,
       COUNT(*) FILTER (us <= late_until) AS late_rows
FROM judged GROUP BY step""",
        "stream_broker": f"""WITH {STATIONS}
SELECT CASE WHEN EventID % 10 <> 0 THEN Street END AS Street, COUNT(*) AS events,
       CAST(SUM(CASE WHEN EventID % 10 <> 0 THEN No_Bikes END) AS DOUBLE) AS bikes,
       {TIME_TEXT.format('MAX(EnqueuedTime)')} AS last_arrival
FROM stations GROUP BY 1""",
        "table_described": """SELECT * FROM (VALUES
  ('n_nationkey', 'int'), ('n_name', 'string'), ('n_regionkey', 'int')
) AS c(col_name, data_type), (SELECT COUNT(*) AS row_count, TRUE AS gone FROM nation)""",
    }
