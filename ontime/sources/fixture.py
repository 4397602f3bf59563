"""Flight-shaped view over the driver's ``lineitem`` table (FIXTURES F5).

A pure projection: no join, no filter, so it is one narrow stage over the
Parquet scan and grows with the table.  Text columns carry ``'NA'`` tokens the
way the on-time CSV does, so the cleaning operators have something to clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.session import keep_compiled


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _as_text(c):
    return c.cast("int").cast("string")


def flights_from_lineitem(li: DataFrame) -> DataFrame:
    """Raw flight rows (strings where the CSV can hold ``NA``)."""
    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    k50 = ok % 50
    dep_na = k50 == 0
    arr_na = k50.isin(0, 1)
    ship = F.col("l_shipdate")
    qty = F.col("l_quantity").cast("int")
    return li.select(
        F.year(ship).alias("Year"),
        F.month(ship).alias("Month"),
        F.dayofmonth(ship).alias("DayofMonth"),
        (F.weekday(ship) + 1).alias("DayOfWeek"),
        F.when(dep_na, F.lit("NA")).otherwise(_as_text((pk % 24) * 100 + sk % 60)).alias("DepTime"),
        ((pk % 24) * 100 + ln * 5).cast("int").alias("CRSDepTime"),
        F.when(arr_na, F.lit("NA")).otherwise(_as_text(((pk + ln) % 24) * 100 + sk % 60)).alias("ArrTime"),
        (((pk + ln) % 24) * 100 + 30).cast("int").alias("CRSArrTime"),
        F.when(dep_na, F.lit("NA")).otherwise((qty - 25).cast("string")).alias("DepDelay"),
        F.when(arr_na, F.lit("NA")).otherwise(
            (qty - 30 + F.round(F.col("l_discount") * 100).cast("int") + ln).cast("string")).alias("ArrDelay"),
        F.floor(F.col("l_extendedprice") / 40).cast("int").alias("Distance"),
        F.when(dep_na, F.lit(1)).otherwise(F.lit(0)).cast("int").alias("Cancelled"),
        F.round(F.col("l_tax") * 100).cast("int").alias("TaxiIn"),
        F.round(F.col("l_discount") * 200).cast("int").alias("TaxiOut"),
        F.col("l_returnflag").alias("UniqueCarrier"),
        sk.alias("Origin"),
        ok.alias("l_orderkey"),
        ln.alias("l_linenumber"),
    )


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``fl`` view for one scale-factor folder."""
    return flights_from_lineitem(read_table(keep_compiled(spark), sf_dir, "lineitem"))
