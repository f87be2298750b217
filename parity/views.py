"""Delivery tables as seen through the TPC-H-like test tables.

`FIXTURES.md` lists the definitions; `parity/oracle.py` repeats them in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.functions.cleaning import EVENT_TYPES
from courierlake.operators.joins import flag_orphans
from courierlake.plans import silver
from courierlake.plans.staging import staged
from courierlake.plans.timeline import delivery_timeline
from courierlake.sources.schemas import RAW_TABLES, schema_of

AS_OF = dt.datetime(2001, 6, 1)

# Given schemas spare a job per table that would read the files' footers.
TEST_TABLES = {
    "nation": schema_of(n_nationkey="integer", n_name="string", n_regionkey="integer"),
    "customer": schema_of(
        c_custkey="long",
        c_name="string",
        c_nationkey="integer",
        c_acctbal="double",
        c_mktsegment="string",
    ),
    "supplier": schema_of(
        s_suppkey="long", s_name="string", s_nationkey="integer", s_acctbal="double"
    ),
    "orders": schema_of(
        o_orderkey="long",
        o_custkey="long",
        o_orderstatus="string",
        o_totalprice="double",
        o_orderdate="timestamp_ntz",
        o_orderpriority="string",
    ),
    "lineitem": schema_of(
        l_orderkey="long",
        l_partkey="long",
        l_suppkey="long",
        l_linenumber="integer",
        l_quantity="double",
        l_extendedprice="double",
        l_discount="double",
        l_tax="double",
        l_returnflag="string",
        l_linestatus="string",
        l_shipdate="timestamp_ntz",
    ),
    "conversations": schema_of(conv_id="long", turn="long", role="string", text="string"),
}

# lineitem has line numbers 1 to 7; six steps and the delivery.
LINE_EVENTS = (*EVENT_TYPES[:6], "delivered")
LINE_REASONS = ("Delay", "Missing_Items", "Cancellation", "Wrong_Order", "Quality_Issue")


class Views:
    """Delivery-domain DataFrames over the test tables in `path`."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TEST_TABLES[name]).parquet(f"{self.path}/{name}.parquet")

    # --- raw ---------------------------------------------------------------------

    def order_times(self) -> DataFrame:
        """Order id and order time, all that events need of an order."""
        return self.table("orders").select(
            _text("o_orderkey").alias("order_id"), _order_time().alias("order_ts")
        )

    def _placed_orders(self) -> DataFrame:
        """The columns that `_order_columns` reads."""
        customers = self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        orders = self.table("orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
        return orders.select(*self.table("orders").columns, "n_name")

    def raw_orders(self) -> DataFrame:
        return self._placed_orders().select(
            *_order_columns(),
            _quarters("o_totalprice").alias("order_value"),
            F.col("o_orderpriority").alias("payment_mode"),
        )

    def raw_events(self) -> DataFrame:
        delay = 6 * F.col("l_linenumber") + F.col("l_partkey") % 31
        lines = self.table("lineitem").select(
            _text("l_orderkey").alias("order_id"),
            F.when(F.col("l_linenumber") >= 5, _text("l_suppkey")).alias("rider_id"),
            "l_linenumber",
            F.make_dt_interval(mins=delay.cast("int")).alias("_delay"),
            (F.col("l_discount") * 10).alias("latitude"),
            (F.col("l_tax") * 10).alias("longitude"),
            *_versions(),
        )
        return _join_by_order(lines, self.order_times()).select(
            "order_id",
            "rider_id",
            _pick(LINE_EVENTS).alias("event_type"),
            (F.col("order_ts") + F.col("_delay")).alias("event_ts"),
            "latitude",
            "longitude",
            "_ingested_at",
            "_batch_id",
        )

    def bronze_events(self) -> DataFrame:
        """Events with defects: every 11th part an unknown type, some orders
        unknown or missing, some riders lost.

        What follows from the order id or the line number is made after the
        join, as in all these views: numbers are shuffled, not their names.
        """
        part = F.col("_part")
        events = self.table("lineitem").select(
            _text("l_orderkey").alias("_order"),
            (F.col("l_partkey") % 13 == 0).alias("_lost"),
            (F.col("l_partkey") % 17 == 0).alias("_missing"),
            F.when((F.col("l_linenumber") >= 5) & (F.col("l_partkey") % 7 > 0), _text("l_suppkey"))
            .alias("rider_id"),
            (F.col("l_partkey") % 11 == 0).alias("_teleported"),
            "l_linenumber",
            (6 * F.col("l_linenumber") + F.col("l_partkey") % 31).cast("int").alias("_part"),
            (F.col("l_discount") * 10).alias("latitude"),
            (F.col("l_tax") * 10).alias("longitude"),
            *_versions(),
        )
        times = self.order_times().select(F.col("order_id").alias("_order"), "order_ts")
        return events.join(times.hint("merge"), "_order").select(
            F.when(F.col("_lost"), F.concat(F.lit("lost-"), "_order"))
            .when(F.col("_missing"), None)
            .otherwise(F.col("_order"))
            .alias("order_id"),
            "rider_id",
            F.when(F.col("_teleported"), "teleported").otherwise(_pick(LINE_EVENTS)).alias("event_type"),
            (F.col("order_ts") + F.make_dt_interval(mins=part)).alias("event_ts"),
            "latitude",
            "longitude",
            "_ingested_at",
            "_batch_id",
        )

    def bronze_orders(self) -> DataFrame:
        """A log of order versions, one per line item, with untidy fields.

        Joined by the numeric key, so that the rows do not arrive partitioned
        by the order id: the versions of an order shall meet as they would in
        a stored log, in the shuffle of the deduplication.
        """
        price = _quarters("l_extendedprice")
        value = F.when(F.col("l_discount") == 0, -price).when(F.col("l_discount") == 0.01, 0.0).otherwise(price)
        lines = self.table("lineitem").select(
            "l_orderkey",
            (F.col("l_quantity") > 3).alias("_has_customer"),
            (F.col("l_tax") > 0).alias("_has_payment"),
            ((F.col("l_linenumber") == 7) & (F.col("l_tax") == 0.08)).alias("_corrupt"),
            value.alias("order_value"),
            *_versions(),
        )
        untidy_city = F.concat(F.lit("  "), F.lower("city"), F.lit(" "))
        orders = self._placed_orders().hint("merge")
        placed = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            *lines.columns, *_order_columns(), F.col("o_orderpriority").alias("payment_mode")
        )
        return placed.select(
            "order_id",
            F.when(F.col("_has_customer"), F.col("customer_id")).alias("customer_id"),
            "restaurant_id",
            untidy_city.alias("city"),
            "order_ts",
            "promised_delivery_ts",
            F.concat(F.lit(" "), "status", F.lit(" ")).alias("status"),
            "order_value",
            F.when(F.col("_has_payment"), F.concat(F.lit(" "), F.lower("payment_mode"))).alias(
                "payment_mode"
            ),
            F.when(F.col("_corrupt"), F.concat_ws(",", "order_id", "status")).alias("_corrupt_record"),
            "_ingested_at",
            "_batch_id",
        )

    def raw_order_items(self) -> DataFrame:
        return self.table("lineitem").select(
            _text("l_orderkey").alias("order_id"),
            _text("l_partkey").alias("item_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").alias("item_price"),
            F.col("l_linestatus").alias("cuisine_type"),
            *_versions(),
        )

    def raw_refunds(self) -> DataFrame:
        """Refunds of returned lines; as lines repeat, so do refund ids."""
        return (
            self.table("lineitem")
            .where(F.col("l_returnflag") == "R")
            .select(
                F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("refund_id"),
                _text("l_orderkey").alias("order_id"),
                F.col("l_shipdate").alias("refund_ts"),
                _pick(LINE_REASONS).alias("refund_reason"),
                _quarters(F.col("l_extendedprice") * F.col("l_discount")).alias("refund_amount"),
                *_versions(),
            )
        )

    def raw_restaurants(self) -> DataFrame:
        """One restaurant per block of 40 customer keys, described by its customers."""
        balance = F.max("c_acctbal")
        band = (
            F.when(balance >= 9900, "A")
            .when(balance >= 9800, "B")
            .when(balance >= 9700, "C")
            .otherwise("D")
        )
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(_restaurant("c_custkey").alias("restaurant_id"))
            .agg(
                F.min("n_name").alias("city"),
                F.min("c_mktsegment").alias("cuisine_type"),
                band.alias("rating_band"),
                F.date_add(
                    F.lit(dt.date(1994, 1, 1)), F.min("c_custkey").cast("int") % 5000
                ).alias("onboarding_date"),
                F.lit(AS_OF.isoformat(sep=" ")).cast("timestamp_ntz").alias("_ingested_at"),
            )
        )

    def raw_riders(self) -> DataFrame:
        supplier = F.col("s_suppkey")
        shift = (
            F.when(supplier % 3 == 0, "morning").when(supplier % 3 == 1, "evening").otherwise("night")
        )
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                _text("s_suppkey").alias("rider_id"),
                F.col("n_name").alias("city"),
                shift.alias("shift_type"),
                F.date_add(F.lit(dt.date(1994, 1, 1)), supplier.cast("int")).alias("joining_date"),
                F.lit(AS_OF.isoformat(sep=" ")).cast("timestamp_ntz").alias("_ingested_at"),
            )
        )

    def raw_tickets(self) -> DataFrame:
        """One ticket version per turn of a conversation."""
        turn = F.col("turn").cast("int")
        return self.table("conversations").select(
            F.concat(F.lit("T"), _text("conv_id")).alias("ticket_id"),
            _text("conv_id").alias("order_id"),
            F.col("role").alias("ticket_type"),
            (_at("2001-01-01") + F.make_dt_interval(mins=turn)).alias("created_ts"),
            F.when(turn == 0, "open").otherwise("resolved").alias("resolution_status"),
            (_at("2001-01-01") + F.make_dt_interval(days=turn)).alias("_ingested_at"),
        )

    def raw(self, name: str) -> DataFrame:
        return {
            "orders": self.raw_orders,
            "order_items": self.raw_order_items,
            "restaurants": self.raw_restaurants,
            "riders": self.raw_riders,
            "refunds": self.raw_refunds,
            "support_tickets": self.raw_tickets,
            "delivery_events": self.raw_events,
        }[name]()

    # --- silver and staging --------------------------------------------------------

    def clean_orders(self) -> DataFrame:
        """Orders are unique in the test tables, so only columns are added."""
        return silver.flag_orders(silver.add_order_calendar(self.raw_orders()), AS_OF)

    def orders(self) -> DataFrame:
        rows = self.clean_orders().withColumn("_ingested_at", _at(AS_OF.isoformat(sep=" ")))
        return staged("orders", rows)

    def events(self) -> DataFrame:
        """Every line item has its order, so no event is an orphan."""
        return staged("delivery_events", flag_orphans(self.raw_events(), None))

    def refunds(self) -> DataFrame:
        return self.clean("refunds")

    def clean(self, name: str) -> DataFrame:
        return staged(name, silver.silver_simple(self.raw(name), RAW_TABLES[name].key))

    def restaurants(self) -> DataFrame:
        return staged("restaurants", self.raw_restaurants())

    def riders(self) -> DataFrame:
        return staged("riders", self.raw_riders())

    def timeline(self) -> DataFrame:
        return delivery_timeline(self.orders(), self.events())


def _join_by_order(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items with their orders, left partitioned and sorted by order id.

    What follows groups by order id, so the shuffle of the merge join is the
    only one. Broadcasting small orders would move that shuffle behind the
    join, where the rows are wider. The key is text on both sides, as a cast
    after the join would lose the partitioning.
    """
    return lines.join(orders.hint("merge"), "order_id")


def _order_columns():
    """What the view of orders takes from an order, its customer and nation."""
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "P", "in_progress")
        .when(F.col("o_orderstatus") == "O", "cancelled")
    )
    allowed = F.make_dt_interval(mins=(50 + F.col("o_custkey") % 20).cast("int"))
    return [
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        _restaurant("o_custkey").alias("restaurant_id"),
        F.upper("n_name").alias("city"),
        _order_time().alias("order_ts"),
        (_order_time() + allowed).alias("promised_delivery_ts"),
        status.alias("status"),
    ]


def _restaurant(key: str):
    """Every 40 customer keys in a row share a restaurant, so restaurants grow with the data."""
    return F.floor(F.col(key) / 40).cast("bigint").cast("string")


def _text(name: str):
    return F.col(name).cast("string")


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _order_time():
    """Order dates carry no time of day; the key supplies the hour."""
    return F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))


def _quarters(amount):
    """Amounts in steps of 0.25: their sums are exact in any order."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.floor(amount * 4) / 4


def _pick(names):
    """The name at the position of the line number, NULL beyond the last."""
    return F.get(F.array(*(F.lit(name) for name in names)), F.col("l_linenumber") - 1)


def _versions():
    """Ship time and return flag stand for ingest time and batch."""
    return [F.col("l_shipdate").alias("_ingested_at"), F.col("l_returnflag").alias("_batch_id")]
