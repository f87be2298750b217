"""Quality summaries of flagged tables, and assertions that return violations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.functions import percent_of


def flag_summary(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Per flag column: all records, flagged records and their percentage.

    One pass over `df` for any number of flags. Missing flag columns are
    skipped; the percentage of an empty table is 0.
    """
    present = [flag for flag in flags if flag in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *(F.count_if(F.col(flag)).alias(flag) for flag in present),
    )
    per_flag = F.array(
        *(
            F.struct(F.lit(flag).alias("dq_flag"), F.col(flag).alias("flagged_count"))
            for flag in present
        )
    )
    share = F.round(percent_of(F.col("flagged_count"), F.col("total_records")), 2)
    return counts.select("total_records", F.inline(per_flag)).select(
        "dq_flag",
        "total_records",
        "flagged_count",
        F.coalesce(share, F.lit(0.0)).alias("flagged_pct"),
    )


def quality_report(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """`flag_summary` of several tables, with the table's name."""
    summaries = [
        flag_summary(df, flags).select(F.lit(name).alias("table_name"), "*")
        for name, (df, flags) in tables.items()
    ]
    return reduce(DataFrame.unionByName, summaries)


def format_report(summary: DataFrame) -> str:
    """The report as text; one line per flag."""
    lines = [
        f"{row.table_name}.{row.dq_flag}: {row.flagged_count} of {row.total_records}"
        f" ({row.flagged_pct}%)"
        for row in summary.orderBy("table_name", "dq_flag").collect()
    ]
    return "\n".join(lines)


def order_value_review(orders: DataFrame) -> DataFrame:
    """Record, missing-customer and invalid-value counts of silver orders."""
    return orders.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("_dq_has_null_customer").alias("null_customer_count"),
        F.count_if("_dq_invalid_order_value").alias("invalid_value_count"),
    )


# --- Assertions: no rows means passed ------------------------------------------------


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Values of `column` that occur more than once; NULLs are ignored."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def refund_shares_off(mart: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """The sum of the refund count percentages, unless it is 100."""
    total = mart.agg(F.sum("refund_count_pct").alias("total_pct"))
    return total.where(F.abs(F.col("total_pct") - 100) > tolerance)


# Checks per table: (unique columns, columns without NULLs).
EXPECTATIONS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "stg_orders": (("order_id",), ("order_id", "order_value")),
    "stg_delivery_events": ((), ("order_id",)),
    "stg_restaurants": (("restaurant_id",), ("restaurant_id",)),
    "stg_riders": (("rider_id",), ("rider_id",)),
    "stg_refunds": (("refund_id",), ("refund_id",)),
    "stg_support_tickets": (("ticket_id",), ("ticket_id",)),
    "dim_restaurants": (("restaurant_id",), ("restaurant_id",)),
    "dim_riders": (("rider_id",), ("rider_id",)),
    "fct_orders": (("order_id",), ("order_id",)),
}


def _violations(name: str, df: DataFrame) -> DataFrame:
    """All checks of one table in one pass: rows are counted per unique key first."""
    unique, required = EXPECTATIONS[name]
    nulls = {c: F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in required}
    if unique:
        (key,) = unique
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), *nulls.values())
        repeated = F.count_if((F.col("rows") > 1) & F.col(key).isNotNull())
        counts = per_key.agg(
            repeated.alias(f"unique {key}"),
            *(F.coalesce(F.sum(f"null {c}"), F.lit(0)).alias(f"not_null {c}") for c in required),
        )
    else:
        counts = df.agg(*(n.alias(f"not_null {c}") for c, n in nulls.items()))
    checks = F.array(
        *(F.struct(F.lit(c).alias("check"), F.col(c).alias("violations")) for c in counts.columns)
    )
    return counts.select(F.lit(name).alias("table_name"), F.inline(checks))


def check_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of violations per expectation of the given tables.

    Pass stored tables: on a lazy model the optimizer may drop a join that a
    check does not need, and with it what the check would find.
    """
    return reduce(DataFrame.unionByName, [_violations(name, df) for name, df in tables.items()])
