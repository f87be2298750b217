"""The whole run: raw files to bronze, silver, core tables and marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from courierlake.plans import core, insights, marts, quality, silver
from courierlake.plans.staging import STAGED_COLUMNS, staged
from courierlake.plans.timeline import order_milestones, order_refunds, with_outcome
from courierlake.session import scratch_path, setting, shuffle_width, stored_bytes, unless_given
from courierlake.sources import lake, raw
from courierlake.sources.schemas import RAW_TABLES

# What a task reads of raw files and bronze: packed, about 10 times as many bytes of rows come
# out. With Spark's 128 MB, the sort before a deduplication's shuffle spills.
PACKED_BYTES = 16 * 1024**2
SIMPLE_TABLES = ("order_items", "restaurants", "riders", "refunds", "support_tickets")


def build_silver(
    spark: SparkSession, bronze_path: str, silver_path: str, as_of: dt.datetime | None = None
) -> DataFrame:
    """Write every silver table; returns the quality report of the written tables."""

    def bronze(name: str) -> DataFrame:
        return lake.read(spark, f"{bronze_path}/{name}")

    lake.write(
        silver.latest_orders(bronze("orders")),
        f"{silver_path}/orders",
        "order_date",
        finish=lambda rows: silver.finish_orders(rows, as_of),
    )
    ids = silver.unknown_orders(bronze("delivery_events"), bronze("orders"))
    ids_path = scratch_path(spark, "unknown-orders")
    lake.write(ids, ids_path)
    unknown = spark.read.schema(ids.schema).parquet(ids_path)
    lake.write(
        silver.silver_events(bronze("delivery_events"), bronze("orders"), unknown),
        f"{silver_path}/delivery_events",
    )
    for name in SIMPLE_TABLES:
        lake.write(silver.silver(name, bronze(name)), f"{silver_path}/{name}")
    return quality.quality_report(
        {
            "orders": (lake.read(spark, f"{silver_path}/orders"), silver.ORDER_FLAGS),
            "delivery_events": (
                lake.read(spark, f"{silver_path}/delivery_events"),
                silver.EVENT_FLAGS,
            ),
        }
    )


def build_models(
    spark: SparkSession,
    database: str = "default",
    as_of: dt.date | None = None,
    calendar: tuple[dt.date, dt.date] | None = None,
) -> dict[str, DataFrame]:
    """Staging views, core tables and marts over the silver tables of `database`.

    The order fact is written first and everything else about deliveries reads
    it back, so the order-event join runs once. `calendar` gives the first and
    last day of dim_date, by default those of the orders.
    """
    tables: dict[str, DataFrame] = {}

    def publish(
        name: str,
        df: DataFrame,
        as_: str = "table",
        partition_by: str | None = None,
        finish: lake.Finish | None = None,
    ) -> None:
        full_name = name if as_ == "view" else f"{database}.{name}"
        tables[name] = lake.publish(df, full_name, as_, partition_by, finish)

    publish("time_slots", lake.time_slots(spark))
    for name in STAGED_COLUMNS:
        publish(f"stg_{name}", staged(name, spark.table(f"{database}.{name}")), "view")
    orders, refunds = tables["stg_orders"], tables["stg_refunds"]

    publish(
        "fct_orders",
        order_milestones(orders, tables["stg_delivery_events"]),
        partition_by="order_date",
        finish=lambda rows: core.fct_orders(with_outcome(rows)),
    )
    fact = tables["fct_orders"]
    publish("dim_restaurants", core.dim_restaurants(tables["stg_restaurants"], fact))
    publish("dim_riders", core.dim_riders(tables["stg_riders"]))
    days = core.date_range(spark, *calendar) if calendar else core.order_date_range(fact)
    publish("dim_date", core.dim_date(days))

    publish("mart_sla_breach_analysis", marts.sla_breach_analysis(fact))
    publish(
        "mart_restaurant_prep_delays",
        marts.restaurant_prep_delays(fact, tables["stg_restaurants"], as_of),
    )
    publish("mart_refund_drivers", marts.refund_drivers(order_refunds(orders, refunds)))
    publish(
        "mart_rider_performance", marts.rider_performance(fact, tables["stg_riders"], as_of)
    )
    publish("mart_weekly_trends", marts.weekly_trends(orders, refunds))
    return tables


def ask(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five standing questions on the published marts."""
    return {
        "worst_sla_slots": insights.worst_sla_slots(tables["mart_sla_breach_analysis"]),
        "riskiest_restaurants": insights.riskiest_restaurants(
            tables["mart_restaurant_prep_delays"]
        ),
        "refund_split": insights.refund_split(tables["mart_refund_drivers"]),
        "star_riders": insights.star_riders(tables["mart_rider_performance"]),
        "latest_weeks": insights.latest_weeks(tables["mart_weekly_trends"]),
    }


def check(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The expectations on the published tables, and the share test of the refund mart."""
    expected = {name: tables[name] for name in quality.EXPECTATIONS}
    return {
        "expectations": quality.check_tables(expected),
        "refund_shares_off": quality.refund_shares_off(tables["mart_refund_drivers"]),
    }


def run(
    spark: SparkSession,
    raw_path: str,
    lake_path: str,
    database: str = "default",
    as_of: dt.datetime | None = None,
    json_lines: bool = True,
    order_buckets: int | None = None,
    calendar: tuple[dt.date, dt.date] | None = None,
) -> dict[str, DataFrame]:
    """Everything, from raw files to published marts and their checks.

    Next to the published tables, the result holds `dq_report`, `expectations`
    and `refund_shares_off`.
    """
    width = shuffle_width(spark, stored_bytes(spark, raw_path))
    codec = unless_given(spark, "spark.sql.parquet.compression.codec", "zstd")
    with setting(spark, "spark.sql.shuffle.partitions", str(width)), codec:
        bronze_path, silver_path = f"{lake_path}/bronze", f"{lake_path}/silver"
        with unless_given(spark, "spark.sql.files.maxPartitionBytes", str(PACKED_BYTES)):
            raw.ingest_all(spark, raw_path, bronze_path, json_lines=json_lines)
            report = build_silver(spark, bronze_path, silver_path, as_of)
        lake.load_tables(spark, silver_path, RAW_TABLES, database, order_buckets)
        tables = build_models(spark, database, as_of.date() if as_of else None, calendar)
    return {**tables, "dq_report": report, **check(tables)}
