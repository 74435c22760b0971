"""Queries for the published findings, the read path of landed payloads, written
tables and series with gaps, each with its SQL.

Landed payloads are derived from the driver tables as JSON text, some of it cut, and
go through the same parsing as files do; written tables go to the checkpoint folder
and are read back. The hourly series with gaps has one reading per pollutant and
hour; by rule, some days are missing and some are short, so that the minimum of
hours and the difference between rows and calendar days act.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions.numeric import exact_mean, exact_sum, parts_mean, scaled_round
from ..operators.aggregates import gap_audit
from ..operators.star import per_key, pruned
from ..operators.windows import holdout
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources import landing
from ..sources.bronze import select_weather_range, weather_payload_rows
from ..sources.schemas import WEATHER_BRONZE, WEATHER_VARIABLES
from ..sources.sinks import export_csv, write_table
from . import driver_map as DM
from . import features as FE
from . import gold
from . import landed_map as LM
from . import models
from . import sqltext as S
from .catalog import SC, _features, query, r1
from .silver import silver_measures, silver_weather

# Fixed values of the derivations: the stand-in for the guideline of 10 µg/m³, the
# records that land cut, the hours without a temperature, and the range of weather.
GUIDELINE = 40.0
CUT_EVERY, BLANK_EVERY = 13, 17
WEATHER_FROM = "2024-01-05"


# ---------------------------------------------------------------- findings (R-1)

def station_levels(fact, pollutants, stations, pollutant, scale):
    """Mean of a pollutant per station, with its type: the fact is summed per
    station before it meets the station table."""
    target = pruned(fact, pollutants, "magnitud", F.col("contaminant") == pollutant)
    sums = per_key(target, ["codi_eoi"], {"valor": scale})
    return sums.join(stations.select("codi_eoi", "nom_estacio", "tipus_estacio"), "codi_eoi")


def type_ratio(scale, over="traffic", under="background"):
    """Aggregate over station levels: mean of all readings of one type of station over that of another."""
    mean = lambda kind: parts_mean("valor", scale, F.col("tipus_estacio") == kind)
    return F.try_divide(mean(over), mean(under))


def _levels(spark, base):
    # Written once: the fact and two dimensions read it.
    ensure_checkpoint_dir(spark)
    s = LM.silver(spark, base).select(
        "codi_eoi", "magnitud", "contaminant", "unitats", "data", "hora", "valor",
        *gold.STATION_ATTRIBUTES, "latitud", "longitud").checkpoint(eager=True)
    return station_levels(gold.fact_measures(s, with_id=False), gold.dim_pollutant(s),
                          gold.dim_station(s), DM.TARGET_POLLUTANT, SC)


_LEVELS = S.with_(S.LANDED, f"""lv AS (
  SELECT codi_eoi, ANY_VALUE(nom_estacio) AS nom_estacio, ANY_VALUE(tipus_estacio) AS tipus_estacio,
         {S.rnd(S.xmean('valor'), 1)} AS mitjana
  FROM silver WHERE contaminant = '{DM.TARGET_POLLUTANT}' GROUP BY codi_eoi)""")


@query("finding_station_ratio", S.with_(S.LANDED) + f"""
SELECT {S.rnd(S.xmean("CASE WHEN tipus_estacio = 'traffic' THEN valor END") + " / "
              + S.xmean("CASE WHEN tipus_estacio = 'background' THEN valor END"), 3)} AS rao_transit_fons
FROM silver WHERE contaminant = '{DM.TARGET_POLLUTANT}'""")
def finding_station_ratio(spark, base):
    """Published finding: traffic stations against background stations."""
    return _levels(spark, base).agg(
        scaled_round(type_ratio(SC), 3).alias("rao_transit_fons"))


@query("finding_above_guideline", _LEVELS + f"""
SELECT nom_estacio, mitjana, mitjana > {GUIDELINE} AS supera,
       COUNT(*) FILTER (WHERE mitjana > {GUIDELINE}) OVER () AS n_superen
FROM lv""")
def finding_above_guideline(spark, base):
    """Published finding: the stations whose mean exceeds the guideline, and how
    many there are."""
    lv = _levels(spark, base).groupBy("codi_eoi").agg(
        F.any_value("nom_estacio", True).alias("nom_estacio"),
        r1(parts_mean("valor", SC)).alias("mitjana"))
    out = lv.select("nom_estacio", "mitjana", (F.col("mitjana") > GUIDELINE).alias("supera"))
    return out.withColumn("n_superen", out.agg(F.count_if("supera")).scalar())


# ---------------------------------------------------------------- read path

@query("read_path", S.with_(S.LANDED) + f"""
, n AS (SELECT codi_eoi, CAST(codi_eoi AS INTEGER) % {CUT_EVERY} = 0 AS dolent FROM landed)
SELECT 'dolents' AS estat, COUNT(*) AS registres, CAST(0 AS BIGINT) AS mesures, NULL::DOUBLE AS suma
FROM n WHERE dolent
UNION ALL
SELECT 'bons', (SELECT COUNT(*) FROM n WHERE NOT dolent), COUNT(*), {S.rnd(S.xsum('valor'), 2)}
FROM silver WHERE CAST(codi_eoi AS INTEGER) % {CUT_EVERY} <> 0""")
def read_path(spark, base):
    """Landed records as JSON text, every 13th station's cut in the middle: parsed
    leniently, bad records apart, good ones through the silver layer."""
    wide = LM.landed_records(spark, base)
    text = F.to_json(F.struct(*wide.columns))
    cut = F.col("codi_eoi").cast("int") % CUT_EVERY == 0
    texts = wide.select(F.when(cut, F.substring(text, F.lit(1), (F.length(text) / 2).cast("int")))
                        .otherwise(text).alias("text"))
    # Written once, as a landing is: the bad and the good records are read from it.
    ensure_checkpoint_dir(spark)
    landed = landing.parse_records(texts, "text").checkpoint(eager=True)
    bad = landed.where(landing.is_bad()).agg(
        F.lit("dolents").alias("estat"), F.count(F.lit(1)).alias("registres"),
        F.lit(0).cast("long").alias("mesures"), F.lit(None).cast("double").alias("suma"))
    good = landing.good(landed)
    kept = silver_measures(good).agg(
        F.count(F.lit(1)).alias("mesures"), scaled_round(exact_sum("valor", SC), 2).alias("suma"))
    counted = good.agg(F.count(F.lit(1)).alias("registres"))
    return bad.unionByName(kept.select(
        F.lit("bons").alias("estat"), counted.scalar().alias("registres"), "mesures", "suma"))


@query("weather_read_path", S.with_(S.CONTEXT_HOURS) + f"""
SELECT data, CAST(hora AS BIGINT) AS hora, temperatura, humitat, precipitacio,
       vent_velocitat, vent_direccio, pressio
FROM ctx_h
WHERE data BETWEEN DATE '{WEATHER_FROM}' AND CAST(current_date - INTERVAL 6 DAY AS DATE)
  AND (day(data) * 24 + hora) % {BLANK_EVERY} <> 0""")
def weather_read_path(spark, base):
    """One landed payload per day as JSON text -> parallel arrays -> hourly rows,
    from a start to today minus six days; hours without a temperature are dropped."""
    h = DM.context_hours(spark, base)
    blank = (F.day("data") * 24 + F.col("hora")) % BLANK_EVERY == 0
    stamp = F.concat(F.date_format("data", "yyyy-MM-dd"), F.lit("T"),
                     F.lpad((F.col("hora") - 1).cast("string"), 2, "0"), F.lit(":00"))
    silver = ("temperatura", "humitat", "precipitacio", "vent_velocitat", "vent_direccio", "pressio")
    entry = F.struct(stamp.alias("time"), *(
        (F.when(~blank, F.col(s)) if s == "temperatura" else F.col(s)).alias(v)
        for s, v in zip(silver, WEATHER_VARIABLES)))
    day = h.groupBy("data").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    payload = day.select(F.to_json(F.struct(F.struct(
        *(F.col("e")[f].alias(f) for f in ("time", *WEATHER_VARIABLES))).alias("hourly")),
        {"ignoreNullFields": "false"}).alias("text"))
    parsed = payload.select(F.from_json("text", WEATHER_BRONZE, {"mode": "FAILFAST"}).alias("p"))
    rows = weather_payload_rows(parsed.select("p.*"))
    return silver_weather(select_weather_range(rows, WEATHER_FROM))


# ---------------------------------------------------------------- written tables

@query("written_fact", S.with_(S.MEASURES) + f"""
SELECT magnitud, COUNT(*) AS n, MIN(id_temps) AS primer, MAX(id_temps) AS ultim,
       {S.rnd(S.xsum('valor'), 2)} AS suma, (SELECT COUNT(*) FROM m) AS escrites
FROM m GROUP BY magnitud""")
def written_fact(spark, base):
    """The fact written as the refresh does (rebalanced by pollutant, sorted, rows
    counted while writing) and read back."""
    out = scratch_path(spark, "written_fact")
    n = write_table(DM.fact(spark, base), out, "fets_mesures", ("magnitud",),
                    sort_by=("id_temps", "hora"))
    fets = spark.read.schema(
        "codi_eoi string, id_temps int, hora int, valor double, magnitud string").parquet(
        os.path.join(out, "fets_mesures"))
    return fets.groupBy("magnitud").agg(
        F.count(F.lit(1)).alias("n"), F.min("id_temps").alias("primer"),
        F.max("id_temps").alias("ultim"), scaled_round(exact_sum("valor", SC), 2).alias("suma"),
        F.lit(n).cast("long").alias("escrites"))


@query("csv_round_trip", S.with_(S.MEASURES, S.CAL) + """
SELECT CAST(id_temps AS VARCHAR) AS id_temps, CAST(data AS VARCHAR) AS data, dia_setmana,
       CASE WHEN es_cap_setmana THEN 'True' ELSE 'False' END AS es_cap_setmana FROM cal""")
def csv_round_trip(spark, base):
    """The calendar as exported for the dashboard, read back as text."""
    out = scratch_path(spark, "csv")
    export_csv(DM.calendar(spark, base), out, "dim_temps", single_file=True)
    text = spark.read.option("header", True).csv(os.path.join(out, "dim_temps"))
    return text.select("id_temps", "data", "dia_setmana", "es_cap_setmana")


# ---------------------------------------------------------------- model rows

@query("model_rows", S.with_(S.MEASURES, S.CAL, S.CONTEXT, S.FEATURES) + f"""
SELECT magnitud, data, {", ".join(models.FEATURES)}, CAST(es_cap_setmana AS INTEGER) AS es_cap_setmana
FROM feat WHERE no2_lag7 IS NOT NULL AND no2_mm7 IS NOT NULL""")
def model_rows(spark, base):
    """The boosted trees' input: complete lags, the 17 features, the flag as 0/1."""
    return models.model_frame(_features(spark, base)).select(
        "magnitud", "data", *models.FEATURES, "es_cap_setmana")


@query("naive_forecast", S.with_(S.MEASURES, S.CAL, S.CONTEXT, S.FEATURES) + f"""
SELECT magnitud, data, no2_mitja AS y, no2_lag1 AS yhat, {models.EU_ANNUAL_LIMIT}::DOUBLE AS limit_ue
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY magnitud ORDER BY data DESC) AS rn FROM feat)
WHERE rn <= {models.DRIVER_TEST_DAYS}""")
def naive_forecast(spark, base):
    """Forecast rows as the models write them, of yesterday's value."""
    held = holdout(_features(spark, base), models.SERIES, "data", models.DRIVER_TEST_DAYS)
    return models.forecast_output(held.where("es_test").select(
        "magnitud", "data", F.col("no2_mitja").alias("y"), F.col("no2_lag1").alias("yhat")),
        models.SERIES)


# ---------------------------------------------------------------- series with gaps (A5, K1)

def _gap(data, magnitud, hora):
    """Whole days that are missing and afternoons of short days, by rule."""
    turn = (F.datediff(data, F.lit("1970-01-01").cast("date")) + F.length(magnitud)) % 6
    return (turn == 0) | ((turn == 1) & (hora > 12))


_GAPS = f"""m_all AS ({S.MEASURES.split("AS (", 1)[1]},
m AS (
  SELECT magnitud, data, id_temps, hora, {S.rnd(S.xmean('valor'), 2)} AS valor
  FROM (SELECT *, (datediff('day', DATE '1970-01-01', data) + length(magnitud)) % 6 AS torn FROM m_all)
  WHERE NOT (torn = 0 OR (torn = 1 AND hora > 12))
  GROUP BY magnitud, data, id_temps, hora)"""


def _gap_base(spark, base):
    """The daily base of one reading per pollutant and hour, with gaps."""
    m = DM.measures(spark, base).where(~_gap(F.col("data"), F.col("magnitud"), F.col("hora")))
    hourly = m.groupBy("magnitud", "data", "id_temps", "hora").agg(
        scaled_round(exact_mean("valor", SC), 2).alias("valor"))
    joined = DM.calendar_attributes(hourly.join(DM.context(spark, base), ["id_temps", "hora"]))
    return FE.daily_base(joined, ["magnitud"], DM.MIN_HOURS, scale=SC)


@query("feature_table_gaps", S.with_(_GAPS, S.CAL, S.CONTEXT, S.FEATURES) + "SELECT * FROM feat")
def feature_table_gaps(spark, base):
    """Days with fewer than 18 hours leave the table, and lags count the rows that
    are left."""
    return FE.ml_features(_gap_base(spark, base), ["magnitud"])


@query("feature_table_gaps_calendar", S.with_(_GAPS, S.CAL, S.CONTEXT, S.CALENDAR_FEATURES)
       + "SELECT * FROM feat_cal")
def feature_table_gaps_calendar(spark, base):
    """The same days with lags and means over calendar days."""
    return FE.calendar_gap_features(_gap_base(spark, base), ["magnitud"])


@query("gap_audit_gaps", S.with_(_GAPS, S.CAL, S.CONTEXT, S.FEATURES) + """
SELECT magnitud, CAST(datediff('day', MIN(data), MAX(data)) + 1 AS BIGINT) AS dies_esperats,
       COUNT(*) AS dies_amb_dades FROM feat GROUP BY magnitud""")
def gap_audit_gaps(spark, base):
    """Days expected against days present, where days are missing."""
    return gap_audit(_gap_base(spark, base), "data", ["magnitud"])
