"""Shop marts: staging, customer and order marts, and their data tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import amount_of, cents_to_units, units
from tidemark.operators import quality
from tidemark.operators.aggregates import sum_where
from tidemark.schemas import RAW_CUSTOMERS, RAW_ORDERS, RAW_PAYMENTS
from tidemark.sources.readers import csv_with_header
from tidemark.sources.writers import materialise

# The accepted payment methods and order states.
PAYMENT_METHODS = ["credit_card", "coupon", "bank_transfer", "gift_card"]
ORDER_STATES = ["placed", "shipped", "completed", "return_pending", "returned"]


def read_seeds(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three delivered seed files, typed."""
    return (
        csv_with_header(spark, f"{folder}/raw_customers.csv", RAW_CUSTOMERS),
        csv_with_header(spark, f"{folder}/raw_orders.csv", RAW_ORDERS),
        csv_with_header(spark, f"{folder}/raw_payments.csv", RAW_PAYMENTS),
    )


def stage_customers(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("customer_id"), "first_name", "last_name")


def stage_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("order_id"), F.col("user_id").alias("customer_id"), "order_date", "status"
    )


def stage_payments(raw: DataFrame) -> DataFrame:
    """Amounts arrive in cents."""
    return raw.select(
        F.col("id").alias("payment_id"),
        "order_id",
        "payment_method",
        cents_to_units(F.col("amount")).alias("amount"),
    )


def _paid_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.sum(units(F.col("amount"))).alias("_paid"))


def customer_mart(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Customers with their order dates, order count and lifetime value.

    Payments are summed per order before they meet the orders; from there one
    aggregation per customer gives dates, count and value. A customer without
    orders keeps nulls. Payments of unknown orders belong to no customer.
    """
    paid = _paid_per_order(payments)
    per_customer = (
        orders.join(paid, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("most_recent_order"),
            F.count("order_id").alias("number_of_orders"),
            amount_of(F.sum("_paid")).alias("customer_lifetime_value"),
        )
    )
    return customers.join(per_customer, "customer_id", "left").select(
        "customer_id",
        "first_name",
        "last_name",
        "first_order",
        "most_recent_order",
        "number_of_orders",
        "customer_lifetime_value",
    )


def payments_by_customer(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Paid amount per customer; payments of unknown orders form a null group."""
    paid = _paid_per_order(payments)
    owners = orders.select("order_id", "customer_id")
    return (
        paid.join(owners, "order_id", "left")
        .groupBy("customer_id")
        .agg(amount_of(F.sum("_paid")).alias("total_amount"))
    )


def order_mart(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with the paid amount in total and per payment method."""
    paid = sum_where(payments, ["order_id"], "payment_method", PAYMENT_METHODS, "amount")
    return orders.join(paid, "order_id", "left").select(
        "order_id",
        "customer_id",
        "order_date",
        "status",
        *[f"{m}_amount" for m in PAYMENT_METHODS],
        F.col("total_amount").alias("amount"),
    )


def staging_tests(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    check = quality.Check
    return quality.report(
        quality.table_checks(
            customers,
            "stg_customers",
            [check("unique", "customer_id"), check("not_null", "customer_id")],
        ),
        quality.table_checks(
            orders,
            "stg_orders",
            [
                check("unique", "order_id"),
                check("not_null", "order_id"),
                check("accepted_values", "status", ORDER_STATES),
            ],
        ),
        quality.table_checks(
            payments,
            "stg_payments",
            [
                check("unique", "payment_id"),
                check("not_null", "payment_id"),
                check("accepted_values", "payment_method", PAYMENT_METHODS),
            ],
        ),
    )


def mart_tests(customers: DataFrame, orders: DataFrame) -> DataFrame:
    check = quality.Check
    amounts = [*[f"{m}_amount" for m in PAYMENT_METHODS], "amount"]
    return quality.report(
        quality.table_checks(
            customers,
            "customers",
            [check("unique", "customer_id"), check("not_null", "customer_id")],
        ),
        quality.table_checks(
            orders,
            "orders",
            [
                check("unique", "order_id"),
                *[check("not_null", c) for c in ("order_id", "customer_id", *amounts)],
                check("accepted_values", "status", ORDER_STATES),
            ],
        ),
        quality.relationships(orders, "orders", "customer_id", customers, "customer_id"),
    )


def build(
    spark: SparkSession,
    raw_customers: DataFrame,
    raw_orders: DataFrame,
    raw_payments: DataFrame,
    database: str,
) -> DataFrame:
    """Build staging views and mart tables, then test both; returns the test rows."""
    customers = materialise(stage_customers(raw_customers), "stg_customers", "view")
    orders = materialise(stage_orders(raw_orders), "stg_orders", "view")
    payments = materialise(stage_payments(raw_payments), "stg_payments", "view")
    customer_table = materialise(
        customer_mart(customers, orders, payments), f"{database}.customers", "table"
    )
    order_table = materialise(order_mart(orders, payments), f"{database}.orders", "table")
    return quality.report(
        staging_tests(customers, orders, payments).drop("passed"),
        mart_tests(customer_table, order_table).drop("passed"),
    )
