"""Landed air-quality records derived from ``events``, so the refresh's own
silver and gold builders run on driver data.

One record per (user, event type, day), in the landed layout: text
attributes and 24 text hour cells ``h01 .. h24`` (the day's per-hour sum of
values). The attributes are rules of the user id, chosen to exercise the
repairs: some units spelled ``ug/m3``, some coordinates mis-scaled, some
altitudes with a decimal, some latitudes out of range; a few hour cells are
``'n/a'`` or empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import exact_sum
from ..operators.reshape import pivot_hours
from ..session import ensure_checkpoint_dir
from ..sources.tables import read_table
from . import driver_map as DM
from . import features as FE
from . import gold
from .silver import silver_measures

# Fixed values of the derivation (text spellings and modular rules).
UNIT_OLD, UNIT_NEW = "ug/m3", "µg/m3"
DAY_SUFFIX = "T00:00:00.000"


def _u(m: int) -> F.Column:
    return F.col("user_id") % F.lit(m)


def landed_records(spark: SparkSession, base: str) -> DataFrame:
    ev = read_table(spark, base, "events", ["ts", "user_id", "event_type", "value"])
    # The per-hour exact sums, then each hour's cell is picked out of its day.
    hourly = ev.groupBy("user_id", "event_type", F.to_date("ts").alias("d"),
                        (F.hour("ts") + 1).cast("int").alias("h")).agg(
        exact_sum("value", DM.SCALE).alias("s"))
    sums = pivot_hours(hourly, ["user_id", "event_type", "d"], "h", F.max("s"))

    def cell(h: int) -> F.Column:
        v = F.col(f"h{h:02d}")
        junk = (F.col("user_id") + F.lit(h)) % F.lit(11)
        return (F.when(v.isNull(), F.lit(None).cast("string"))
                 .when(junk == 0, F.lit("n/a"))
                 .when(junk == 1, F.lit(""))
                 .otherwise(v.cast("string")))

    wide = sums.select("user_id", "event_type", "d", *[cell(h).alias(f"h{h:02d}") for h in range(1, 25)])
    uid = F.col("user_id").cast("string")
    lat = (F.when(_u(17) == 0, F.lit("39.5"))
            .when(_u(5) == 0, (F.lit(4130000) + F.col("user_id")).cast("string"))
            .otherwise(F.concat(F.lit("41."), F.lpad(uid, 4, "0"))))
    lon = (F.when(_u(7) == 0, (F.lit(21000000) + F.col("user_id") * 10).cast("string"))
            .otherwise(F.concat(F.lit("2."), F.lpad(uid, 4, "0"))))
    alt = F.when(_u(2) == 0, (_u(500)).cast("string")).otherwise(
        F.concat((_u(500)).cast("string"), F.lit(".6")))
    return wide.select(
        F.lpad(uid, 8, "0").alias("codi_eoi"),
        F.concat(F.lit("Estacio "), uid).alias("nom_estacio"),
        F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit(DAY_SUFFIX)).alias("data"),
        F.col("event_type").alias("magnitud"),
        F.upper("event_type").alias("contaminant"),
        F.when(_u(2) == 0, F.lit(UNIT_OLD)).otherwise(F.lit(UNIT_NEW)).alias("unitats"),
        F.when(_u(3) == 0, F.lit("traffic")).otherwise(F.lit("background")).alias("tipus_estacio"),
        F.lit("urban").alias("area_urbana"),
        F.lit("Barcelona").alias("municipi"),
        F.lit("Barcelonès").alias("nom_comarca"),
        alt.alias("altitud"), lat.alias("latitud"), lon.alias("longitud"),
        *[F.col(f"h{h:02d}") for h in range(1, 25)])


def silver(spark: SparkSession, base: str) -> DataFrame:
    """Silver from the landed records; only the columns a query uses are made."""
    return silver_measures(landed_records(spark, base))


def dim_station(spark: SparkSession, base: str) -> DataFrame:
    return gold.dim_station(silver(spark, base))


def dim_pollutant(spark: SparkSession, base: str) -> DataFrame:
    return gold.dim_pollutant(silver(spark, base))


def dim_calendar(spark: SparkSession, base: str) -> DataFrame:
    return gold.dim_calendar(silver(spark, base))


def features(spark: SparkSession, base: str) -> DataFrame:
    """The refresh's five-table star (fact, pollutant, station, calendar,
    hourly weather) over the landed gold tables, then the daily base per
    pollutant and the window features. The hourly weather is the
    ``view``-event stand-in of ``driver_map``."""
    # Written once, as the refresh does: the fact and three dimensions read it.
    ensure_checkpoint_dir(spark)
    s = silver(spark, base).checkpoint(eager=True)
    daily = FE.star_daily(gold.fact_measures(s, with_id=False), gold.dim_pollutant(s),
                          gold.dim_station(s), gold.dim_calendar(s), DM.context(spark, base),
                          ["magnitud"], DM.MIN_HOURS, scale=DM.SCALE)
    return FE.ml_features(daily, ["magnitud"], scale=DM.SCALE)


def fact_with_ids(spark: SparkSession, base: str) -> DataFrame:
    return gold.fact_measures(silver(spark, base), with_id=True)
