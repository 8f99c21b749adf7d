"""Trips and positions derived from the given tables, which hold no coordinates themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.sources.messages import encode_positions


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per line item."""
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn(
            "start",
            F.expr("l_shipdate + make_dt_interval(0, 0, CAST((l_orderkey * 37 + l_linenumber * 101) % 1440 AS INT), 0)"),
        )
        .select(
            F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("trip_key"),
            F.expr("-74.05D + ((l_partkey * 7919 + l_suppkey * 31) % 400) / 10000D").alias("longitude"),
            F.expr("40.70D + ((l_orderkey * 104729 + l_linenumber * 17) % 400) / 10000D").alias("latitude"),
            F.col("start").cast("string").alias("datetime"),
            F.expr("start + make_dt_interval(0, 0, 0, 300 + l_linenumber * 60)").cast("string").alias("dropoff"),
            (F.col("l_quantity").cast("int") % 7).alias("passengers"),
        )
    )


def trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips as comma text, many of them damaged in one of the ways the parser must notice."""
    fault = F.conv(F.substring(F.md5("trip_key"), 1, 2), 16, 10).cast("int")
    texts = trips(spark, sf_dir).select(
        fault.alias("fault"),
        "datetime",
        "dropoff",
        F.col("passengers").cast("string").alias("p"),
        F.col("longitude").cast("string").alias("lon"),
        F.col("latitude").cast("string").alias("lat"),
    )
    good = F.concat_ws(",", F.lit("V1"), "datetime", "dropoff", "p", F.lit("1.5"), "lon", "lat")

    def line(passengers=F.col("p"), lon=F.col("lon"), datetime=F.col("datetime"), rest=()):
        return F.concat_ws(",", F.lit("V1"), datetime, "dropoff", passengers, F.lit("1.5"), lon, "lat", *rest)

    damaged = (
        F.when(F.col("fault") == 0, F.lit("vendor,pickup,dropoff,passengers,distance,longitude,latitude"))
        .when(F.col("fault") == 1, F.concat_ws(",", F.lit("V1"), "datetime"))
        .when(F.col("fault") == 2, line(rest=[F.lit(text) for text in ("1", "N", "", "x", "2.5")]))
        .when(F.col("fault") == 3, line(passengers=F.concat("p", F.lit(".0"))))
        .when(F.col("fault") == 4, line(passengers=F.lit("")))
        .when(F.col("fault") == 5, line(passengers=F.concat(F.lit(" "), "p", F.lit(" "))))
        .when(F.col("fault") == 6, line(lon=F.lit("nan")))
        .when(F.col("fault") == 7, line(lon=F.lit("inf")))
        .when(F.col("fault") == 8, line(lon=F.lit("3d")))
        .when(F.col("fault") == 9, line(datetime=F.lit("2008-5-3 5:6:7")))
        .when(F.col("fault") == 10, line(datetime=F.lit("2008-05-13 15:62:35")))
        .when(F.col("fault") == 11, line(passengers=F.lit("x")))
        .when(F.col("fault") == 12, line(passengers=F.lit(str(2**63 - 1))))
        .otherwise(good)
    )
    return texts.select(damaged.alias("value"))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vehicle position per event."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("vehicle_id"),
        F.expr("-74.05D + ((user_id * 7919 + event_id * 31) % 400) / 10000D").alias("longitude"),
        F.expr("40.70D + ((user_id * 104729 + event_id * 17) % 400) / 10000D").alias("latitude"),
        F.substring(F.col("ts").cast("string"), 1, 19).alias("datetime"),
        "event_id",
    )


def two_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions, and each second event again a month later and some minutes earlier."""
    moment = F.col("datetime").cast("timestamp_ntz") + F.make_interval(months=F.lit(1), mins=-(F.col("event_id") % 50).cast("int"))
    later = positions(spark, sf_dir).filter("event_id % 2 = 0").withColumns(
        {"datetime": moment.cast("string"), "event_id": F.col("event_id") + 10_000_000}
    )
    return positions(spark, sf_dir).unionByName(later)


def odd_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions, some of them off the area, without a cell, of an odd vehicle or at no real time."""
    fault = F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 2), 16, 10).cast("int")
    lon, text = F.col("longitude"), F.col("datetime")
    return positions(spark, sf_dir).withColumns(
        {
            "longitude": F.when(fault < 20, lon + 1).when(fault < 30, F.lit(float("nan"))).when(fault < 40, F.lit(1e12)).otherwise(lon),
            "vehicle_id": F.when(fault.between(40, 59), F.concat(F.lit("abc"), "vehicle_id")).otherwise(F.col("vehicle_id")),
            "datetime": F.when(fault.between(60, 79), F.concat(F.substring(text, 1, 14), F.lit("62:00"))).otherwise(text),
        }
    )


def position_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions as tab text, some lines damaged."""
    fault = F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 2), 16, 10).cast("int")
    lon = F.when(fault == 1, F.lit("3d")).otherwise(F.col("longitude").cast("string"))
    whole = F.concat_ws("\t", F.col("latitude").cast("string"), lon, "datetime", "vehicle_id")
    short = F.concat_ws("\t", F.col("latitude").cast("string"), "datetime")
    line = F.when(fault == 0, F.lit("latitude\tlongitude\tdatetime\tvehicle_id")).when(fault == 2, short)
    line = line.when(fault == 3, F.concat(F.lit("  "), whole, F.lit("\textra "))).otherwise(whole)
    return positions(spark, sf_dir).select(line.alias("value"))


def position_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The positions as JSON messages, some of them cut off in the middle."""
    fault = F.conv(F.substring(F.md5("value"), 1, 2), 16, 10).cast("int")
    messages = encode_positions(positions(spark, sf_dir))
    return messages.withColumn("value", F.when(fault == 0, F.substring("value", 1, 20)).otherwise(F.col("value")))
