"""Small tables by hand."""

import datetime as dt

from pyspark.sql import functions as F

from courierlake.plans import silver
from courierlake.sources.schemas import RAW_TABLES


def at(text):
    return dt.datetime.fromisoformat(text)


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def raw_table(spark, name, *rows, **extra):
    """Rows as dicts; columns left out are NULL."""
    schema = RAW_TABLES[name].schema
    values = [tuple(row.get(column) for column in schema.names) for row in rows]
    df = spark.createDataFrame(values, schema)
    return df.withColumns(extra) if extra else df


def staged_orders(spark, *rows):
    """Orders with sensible defaults, calendar columns and flags."""
    defaults = {
        "customer_id": "c1",
        "restaurant_id": "r1",
        "city": "PUNE",
        "order_ts": at("2026-01-19 12:00:00"),
        "promised_delivery_ts": at("2026-01-19 12:40:00"),
        "status": "delivered",
        "order_value": 100.0,
        "payment_mode": "UPI",
    }
    df = raw_table(spark, "orders", *({**defaults, **row} for row in rows))
    return silver.flag_orders(silver.add_order_calendar(df), at("2030-01-01")).withColumn(
        "_ingested_at", F.lit(None).cast("timestamp_ntz")
    )


def events(spark, *rows):
    """(order, type, time[, rider]) tuples."""
    return raw_table(
        spark,
        "delivery_events",
        *(
            {
                "order_id": row[0],
                "event_type": row[1],
                "event_ts": at(row[2]) if row[2] else None,
                "rider_id": row[3] if len(row) > 3 else None,
            }
            for row in rows
        ),
    )


def rows_of(df, *columns):
    """Rows as tuples, sorted as text."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
