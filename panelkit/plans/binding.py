"""An entity x date panel derived from order tables.

Entity = nation, region = region, date = order date, flow = quantity sold, second flow =
returned quantity. Counters are running sums; population and people covered are derived so
that all thresholds of the operators have rows on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.operators.features import feature_panel
from panelkit.plans.model import Model, build_all
from panelkit.session import materialise

ROLLOUT_START = "1997-01-01"

_stored: dict[tuple[str, str, str], Any] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity and returned quantity per nation and order date.

    Each join is preceded by an aggregate on its key: line items are summed per order before
    they meet the orders, and orders per customer and day before they meet the customers. A
    customer or order with a large part of all rows therefore reaches its join as a few rows.
    """
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)
    per_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum("l_quantity").alias("new_cases"), F.sum(returned).alias("new_deaths"))
    )
    sums = (F.sum("new_cases").alias("new_cases"), F.sum("new_deaths").alias("new_deaths"))
    per_customer = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("date"))
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("o_custkey", "date")
        .agg(*sums)
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("country_id"), "date")
        .agg(*sums)
    )


def order_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel: flows, counters, population, people covered, per nation and day."""
    nations = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("country_id"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
        )
    )
    entity = Window.partitionBy("country_id")
    so_far = entity.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_rollout = F.when(F.col("date") >= F.lit(ROLLOUT_START).cast("date"), F.col("new_cases"))
    rollout = F.coalesce(in_rollout, F.lit(0.0))
    return (
        order_flows(spark, sf_dir)
        .join(nations, "country_id")
        .withColumns(
            {
                "total_cases": F.sum("new_cases").over(so_far),
                "total_deaths": F.sum("new_deaths").over(so_far),
                "_done": F.sum(rollout).over(so_far).cast("long"),
                "_all": F.sum("new_cases").over(entity).cast("long"),
                "population": (F.lit(250_000) * (F.col("country_id") + 1)).cast("long"),
            }
        )
        .withColumn("people_vaccinated", F.expr("population * _done div _all"))
        .withColumn(
            "people_fully_vaccinated", F.expr("people_vaccinated * (1 + country_id % 4) div 4")
        )
        .drop("_done", "_all")
    )


def gappy_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel with nulls: every fifth nation lacks its values on days 7, 14, 21 and 28 of a
    month, and every sixth its population before 1998."""
    gap = (F.col("country_id") % 5 == 0) & (F.dayofmonth("date") % 7 == 0)
    early = (F.col("country_id") % 6 == 0) & (F.col("date") < F.lit("1998-01-01").cast("date"))
    lost = ("new_cases", "new_deaths", "total_cases", "total_deaths", "people_vaccinated")
    panel = shared_panel(spark, sf_dir)
    return panel.withColumns(
        {c: F.when(~gap, F.col(c)) for c in lost}
        | {"population": F.when(~early, F.col("population"))}
    )


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], Any]) -> Any:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = build()
    return _stored[key]


def shared_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as a stored table, written once per application: it has many readers."""
    return _once(
        spark, sf_dir, "panel", lambda: materialise(order_panel(spark, sf_dir), "panel")
    )


def shared_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty text feed as a stored table."""
    return _once(spark, sf_dir, "feed", lambda: materialise(raw_feed(spark, sf_dir), "feed"))


def shared_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature panel as a stored table."""
    return _once(
        spark,
        sf_dir,
        "features",
        lambda: materialise(feature_panel(shared_panel(spark, sf_dir)), "features"),
    )


def shared_model(spark: SparkSession, sf_dir: str) -> Model:
    """Dimensional model with stored tables."""
    return _once(spark, sf_dir, "model", lambda: build_all(shared_features(spark, sf_dir)))


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as a dirty text feed: padded and aliased names, mixed date formats, unreadable
    dates and numbers, corrections, earlier versions of rows (``seq`` 0), and daily world totals."""
    panel = shared_panel(spark, sf_dir)
    key = F.col("country_id")
    day = F.dayofmonth("date")
    number = F.col("new_cases")
    text = (
        F.when(day == 28, F.lit("n/a"))
        .when(day % 10 == 3, (-number).cast("string"))
        .otherwise(number.cast("string"))
    )
    date = (
        F.when(key % 4 == 0, F.date_format("date", "yyyy-MM-dd"))
        .when(key % 4 == 1, F.date_format("date", "yyyy/MM/dd"))
        .when(key % 4 == 2, F.date_format("date", "MM/dd/yyyy"))
        .otherwise(F.date_format("date", "yyyyMMdd"))
    )
    name = F.when(key == 3, F.lit("Nation Three")).otherwise(F.col("country"))
    final = panel.select(
        F.concat(F.lit("\t "), name, F.lit(" ")).alias("Location"),
        F.when(key % 7 != 6, F.col("region")).alias("Continent"),
        F.when((key == 5) & (day == 13), F.lit("not a date")).otherwise(date).alias("Date"),
        F.lit(1).alias("Seq"),
        text.alias("New Cases"),
        F.when(day != 15, F.col("total_cases")).cast("string").alias("Total-Cases"),
        F.col("new_deaths").cast("string").alias("New/Deaths"),
        F.when((key % 6 != 0) | (F.year("date") > 1997), F.col("population"))
        .cast("string")
        .alias("Population"),
    )
    earlier = (
        final.withColumn("Seq", F.lit(0))
        .withColumn("New Cases", F.lit("1"))
        .withColumn("Total-Cases", F.lit("2"))
    )
    world = panel.groupBy("date").agg(F.sum("new_cases").alias("n")).select(
        F.lit("World").alias("Location"),
        F.lit(None).cast("string").alias("Continent"),
        F.date_format("date", "yyyy-MM-dd").alias("Date"),
        F.lit(1).alias("Seq"),
        F.col("n").cast("string").alias("New Cases"),
        F.lit(None).cast("string").alias("Total-Cases"),
        F.lit(None).cast("string").alias("New/Deaths"),
        F.lit(None).cast("string").alias("Population"),
    )
    return final.union(earlier).union(world)
