"""Named queries over the driver tables: each is the Spark job for one
operator or user-level product of the original, paired with equivalent SQL
that DuckDB runs as an independent oracle.

Every query reads whole tables. Output columns carry the same names and
types on both sides; means are fixed-point and rounding is binary
(``functions.numeric``), so results are compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.json_fields import json_text
from ..functions.numeric import exact_mean, exact_sum, parts_mean, scaled_round, weighted_mean
from ..operators import quality as Q
from ..operators.aggregates import dim_by_key, distribution, gap_audit, grouped_stats, range_stats
from ..operators.calendar import calendar_dim
from ..operators.dense_id import dense_ids
from ..operators.joins import coverage, last_days, scalars_row, with_total
from ..operators.metrics import regression_metrics
from ..operators.quantile import exact_quantile
from ..operators.reshape import in_range, pivot_hours, unpivot, unpivot_hours, valid_measurements
from ..operators.star import corr_of_sums, per_key, pruned
from ..operators.windows import holdout
from ..sources.bronze import select_newest, weather_payload_rows
from ..sources.tables import read_table
from . import driver_map as DM
from . import features as FE
from . import landed_map as LM
from . import sqltext as S
from .silver import measure_checks, silver_weather, weather_checks

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


r1 = lambda c: scaled_round(c, 1)
r2 = lambda c: scaled_round(c, 2)
SC = DM.SCALE


def _daily_base(spark: SparkSession, base: str) -> DataFrame:
    # Readings are summed per pollutant and hour before they meet the weather.
    fact = DM.measures(spark, base).select("magnitud", "data", "id_temps", "hora", "valor")
    sums = per_key(fact, ["magnitud", "data", "id_temps", "hora"], {"valor": SC})
    joined = DM.calendar_attributes(sums.join(DM.context(spark, base), ["id_temps", "hora"]))
    return FE.daily_of_sums(joined, ["magnitud"], DM.MIN_HOURS, scale=SC)


def _features(spark: SparkSession, base: str) -> DataFrame:
    """The daily feature table: one row per series and day."""
    return FE.ml_features(_daily_base(spark, base), ["magnitud"])


def _target_fact(spark: SparkSession, base: str) -> DataFrame:
    """Fact rows of the target pollutant, selected through the pollutant
    dimension as the original does (``WHERE c.contaminant = ...``): the
    dimension's matching keys are a filter of the fact's scan."""
    return pruned(DM.fact(spark, base), DM.pollutants(spark, base), "magnitud",
                  F.col("contaminant") == DM.TARGET_POLLUTANT)


# ---------------------------------------------------------------- silver

@query("silver_measures", S.with_(S.MEASURES) + "SELECT * FROM m")
def silver_measures(spark, base):
    return DM.measures(spark, base)


@query("unpivot_clean", """
SELECT columna, COUNT(*) AS n, """ + S.rnd(S.xsum("valor"), 2) + """ AS suma
FROM (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
      ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME columna VALUE valor)
WHERE valor IS NOT NULL AND valor >= 0 AND valor < 1000
GROUP BY columna""")
def unpivot_clean(spark, base):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    long = unpivot(read_table(spark, base, "lineitem", cols), [], cols, "columna", "valor")
    return (long.where(in_range("valor"))
                .groupBy("columna")
                .agg(F.count(F.lit(1)).alias("n"), r2(exact_sum("valor", SC)).alias("suma")))


@query("wide_hours_unpivot", S.with_("""cells AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS d, CAST(hour(ts) + 1 AS INTEGER) AS hora,
         """ + S.xsum("value") + """ AS valor
  FROM events WHERE value >= 0 AND value < 1000
  GROUP BY ALL)""") + """
SELECT hora, COUNT(*) AS n_celles, """ + S.rnd(S.xsum("valor"), 2) + """ AS suma
FROM cells WHERE valor >= 0 AND valor < 1000 GROUP BY hora""")
def wide_hours_unpivot(spark, base):
    """Events -> landed wide layout (one text cell per hour) -> long again,
    through the same unpivot + text-parse filter as the silver layer."""
    m = DM.measures(spark, base)
    cell = (exact_sum("valor", SC)).cast("string")
    wide = pivot_hours(m, ["codi_eoi", "magnitud", "data"], "hora", cell)
    long = unpivot_hours(wide, ["codi_eoi", "magnitud", "data"])
    long = valid_measurements(long, "valor", ["codi_eoi", "magnitud"])
    return long.groupBy("hora").agg(F.count(F.lit(1)).alias("n_celles"),
                                    r2(exact_sum("valor", SC)).alias("suma"))


@query("try_parse_filter", """
SELECT event_type, COUNT(*) AS n, """ + S.rnd(S.xsum("k"), 2) + """ AS suma_k
FROM (SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
WHERE k >= 0 AND k < 50
GROUP BY event_type""")
def try_parse_filter(spark, base):
    ev = read_table(spark, base, "events", ["event_type", "props"])
    ev = ev.withColumn("k_text", json_text("props", "k"))
    kept = valid_measurements(ev, "k_text", [], 0.0, 50.0, out_col="k")
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                          r2(exact_sum("k", SC)).alias("suma_k"))


@query("unit_replace", """
SELECT REPLACE(o_orderpriority, 'NOT SPECIFIED', 'UNSPECIFIED') AS prioritat, COUNT(*) AS n
FROM orders GROUP BY 1""")
def unit_replace(spark, base):
    o = read_table(spark, base, "orders", ["o_orderpriority"])
    return (o.select(F.replace("o_orderpriority", F.lit("NOT SPECIFIED"), F.lit("UNSPECIFIED"))
                     .alias("prioritat"))
             .groupBy("prioritat").agg(F.count(F.lit(1)).alias("n")))


@query("rescale_case", """
SELECT c_mktsegment, COUNT(*) AS n, COUNT(*) FILTER (WHERE c_acctbal > 1000) AS n_reescalats,
       """ + S.rnd("MIN(b)", 6) + """ AS minim, """ + S.rnd("MAX(b)", 6) + """ AS maxim
FROM (SELECT c_mktsegment, c_acctbal,
             CASE WHEN c_acctbal > 1000 THEN c_acctbal / 1000.0 ELSE c_acctbal END AS b
      FROM customer)
GROUP BY c_mktsegment""")
def rescale_case(spark, base):
    c = read_table(spark, base, "customer", ["c_mktsegment", "c_acctbal"])
    b = F.when(F.col("c_acctbal") > 1000, F.col("c_acctbal") / F.lit(1000.0)).otherwise(F.col("c_acctbal"))
    return (c.withColumn("b", b).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("c_acctbal") > 1000).alias("n_reescalats"),
        scaled_round(F.min("b"), 6).alias("minim"),
        scaled_round(F.max("b"), 6).alias("maxim")))


# ---------------------------------------------------------------- gold dims

@query("calendar_dim", S.with_(S.calendar("cal", "orders", "CAST(o_orderdate AS DATE)"))
       + "SELECT * FROM cal")
def calendar_dim_q(spark, base):
    o = read_table(spark, base, "orders", ["o_orderdate"]).select(
        F.to_date("o_orderdate").alias("d"))
    return calendar_dim(o, "d")


@query("season_bucket", """
SELECT estacio_any, COUNT(*) AS n, """ + S.rnd(S.xmean("o_totalprice"), 2) + """ AS preu_mitja
FROM (SELECT o_totalprice,
             CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Hivern'
                  WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Primavera'
                  WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Estiu'
                  ELSE 'Tardor' END AS estacio_any
      FROM orders)
GROUP BY estacio_any""")
def season_bucket(spark, base):
    o = read_table(spark, base, "orders", ["o_orderdate", "o_totalprice"])
    return (o.withColumn("estacio_any", D.season(F.month("o_orderdate")))
             .groupBy("estacio_any")
             .agg(F.count(F.lit(1)).alias("n"),
                  r2(exact_mean("o_totalprice", SC)).alias("preu_mitja")))


@query("month_means", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS "any", CAST(month(o_orderdate) AS INTEGER) AS mes,
       COUNT(*) AS n, """ + S.rnd(S.xmean("o_totalprice"), 2) + """ AS preu_mitja
FROM orders GROUP BY 1, 2""")
def month_means(spark, base):
    o = read_table(spark, base, "orders", ["o_orderdate", "o_totalprice"])
    return (o.groupBy(F.year("o_orderdate").alias("any"), F.month("o_orderdate").alias("mes"))
             .agg(F.count(F.lit(1)).alias("n"),
                  r2(exact_mean("o_totalprice", SC)).alias("preu_mitja")))


@query("dim_by_key", """
SELECT o_custkey AS codi, ANY_VALUE(c_name) AS nom, ANY_VALUE(c_mktsegment) AS segment,
       ANY_VALUE(c_nationkey) AS nacio, """ + S.rnd(S.xmean("o_totalprice"), 6) + """ AS preu_mitja,
       COUNT(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY o_custkey""")
def dim_by_key_q(spark, base):
    """One row per customer. The orders are aggregated per key before the
    join (one row per customer reaches the shuffle join, not one per order);
    the attributes are functionally dependent on the key, so taking them
    after the join is equivalent to ANY_VALUE over the joined rows."""
    o = read_table(spark, base, "orders", ["o_custkey", "o_totalprice"])
    c = read_table(spark, base, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"])
    per = o.groupBy(F.col("o_custkey").alias("codi")).agg(
        scaled_round(exact_mean("o_totalprice", SC), 6).alias("preu_mitja"),
        F.count(F.lit(1)).alias("n"))
    attrs = dim_by_key(c.withColumnRenamed("c_custkey", "codi"), "codi",
                       ("c_name", "c_mktsegment", "c_nationkey"))
    return (per.join(attrs, "codi")
               .select("codi", F.col("c_name").alias("nom"), F.col("c_mktsegment").alias("segment"),
                       F.col("c_nationkey").alias("nacio"), "preu_mitja", "n"))


@query("dim_pollutant", S.with_(S.MEASURES, S.POLLUTANTS) + "SELECT * FROM p")
def dim_pollutant_q(spark, base):
    return DM.pollutants(spark, base)


@query("dense_id", """
SELECT MIN(id) AS min_id, MAX(id) AS max_id, COUNT(*) AS n_files, COUNT(DISTINCT id) AS n_distinct
FROM (SELECT ROW_NUMBER() OVER () AS id FROM lineitem)""")
def dense_id_q(spark, base):
    li = read_table(spark, base, "lineitem", ["l_orderkey", "l_linenumber"])
    # A plain Parquet scan has stable splits, so the ids are the same on
    # every evaluation and retry without checkpointing the table first.
    ids = dense_ids(li, "id", checkpoint=False)
    return ids.agg(F.min("id").alias("min_id"), F.max("id").alias("max_id"),
                   F.count(F.lit(1)).alias("n_files"),
                   F.count_distinct("id").alias("n_distinct"))


@query("context_dim", S.with_(S.CONTEXT) + "SELECT * FROM ctx")
def context_dim(spark, base):
    return DM.context(spark, base)


@query("weather_rows", S.with_(S.CONTEXT_HOURS) + """
SELECT data, CAST(hora AS BIGINT) AS hora, temperatura, humitat, precipitacio,
       vent_velocitat, vent_direccio, pressio FROM ctx_h""")
def weather_rows(spark, base):
    """Hourly context -> one landed payload per day (parallel arrays, at
    most 24 entries each) -> rows again through the weather reader and the
    silver-weather parse."""
    h = DM.context_hours(spark, base)
    ts_text = F.concat(F.date_format("data", "yyyy-MM-dd"), F.lit("T"),
                       F.lpad((F.col("hora") - 1).cast("string"), 2, "0"), F.lit(":00"))
    entry = F.struct(ts_text.alias("time"),
                     F.col("temperatura").alias("temperature_2m"),
                     F.col("humitat").alias("relative_humidity_2m"),
                     F.col("precipitacio").alias("precipitation"),
                     F.col("vent_velocitat").alias("wind_speed_10m"),
                     F.col("vent_direccio").alias("wind_direction_10m"),
                     F.col("pressio").alias("surface_pressure"))
    day = h.groupBy("data").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    fields = ["time", "temperature_2m", "relative_humidity_2m", "precipitation",
              "wind_speed_10m", "wind_direction_10m", "surface_pressure"]
    payload = day.select(F.struct(*[F.col("e")[f].alias(f) for f in fields]).alias("hourly"))
    return silver_weather(weather_payload_rows(payload))


# ---------------------------------------------------------------- facts, exports

@query("daily_fact", S.with_(S.MEASURES) + """
SELECT codi_eoi, magnitud, id_temps,
       """ + S.rnd(S.xmean("valor"), 2) + """ AS valor_mitja,
       """ + S.rnd("MAX(valor)", 2) + """ AS valor_max,
       """ + S.rnd("MIN(valor)", 2) + """ AS valor_min,
       COUNT(*) AS hores_amb_dada
FROM m GROUP BY codi_eoi, magnitud, id_temps""")
def daily_fact(spark, base):
    return grouped_stats(DM.fact(spark, base), ["codi_eoi", "magnitud", "id_temps"], "valor",
                         stats=("mean", "max", "min", "count"), digits=2, scale=SC,
                         names={"count": "hores_amb_dada"})


@query("hourly_profile_year", S.with_(S.MEASURES, S.CAL) + """
SELECT f.codi_eoi, f.magnitud, t."any", f.hora, """ + S.rnd(S.xmean("f.valor"), 2) + """ AS valor_mitja
FROM m f JOIN cal t ON f.id_temps = t.id_temps
GROUP BY f.codi_eoi, f.magnitud, t."any", f.hora""")
def hourly_profile_year(spark, base):
    cal = DM.calendar(spark, base).select("id_temps", "any")
    j = DM.fact(spark, base).join(cal, "id_temps")
    return grouped_stats(j, ["codi_eoi", "magnitud", "any", "hora"], "valor",
                         stats=("mean",), digits=2, scale=SC)


@query("hourly_profile", S.with_(S.MEASURES, S.POLLUTANTS) + """
SELECT f.hora, """ + S.rnd(S.xmean("f.valor"), 1) + """ AS no2_mitja
FROM m f JOIN p c ON f.magnitud = c.magnitud
WHERE c.contaminant = '""" + DM.TARGET_POLLUTANT + """'
GROUP BY f.hora""")
def hourly_profile(spark, base):
    return grouped_stats(_target_fact(spark, base), ["hora"], "valor", stats=("mean",),
                         digits=1, scale=SC, names={"mean": "no2_mitja"}).orderBy("hora")


@query("star_mean", """
SELECT n_name, r_name, """ + S.rnd(S.xmean("o_totalprice"), 1) + """ AS preu_mitja,
       """ + S.rnd("MAX(o_totalprice)", 1) + """ AS preu_max, COUNT(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey
WHERE c_mktsegment = 'BUILDING'
GROUP BY n_name, r_name""")
def star_mean(spark, base):
    """orders ⋈ customer ⋈ nation ⋈ region for one market segment, mean /
    max / count of the order price per nation. Orders are first reduced to
    one partial row per customer (fixed-point sum, count, max), so the join
    with customer moves one row per customer rather than one per order; the
    partials are combined per nation after the joins."""
    o = read_table(spark, base, "orders", ["o_custkey", "o_totalprice"])
    per = per_key(o, ["o_custkey"], {"o_totalprice": SC})
    c = (read_table(spark, base, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
         .where(F.col("c_mktsegment") == "BUILDING"))
    n = read_table(spark, base, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, base, "region", ["r_regionkey", "r_name"])
    j = (per.join(c, per.o_custkey == c.c_custkey)
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    return j.groupBy("n_name", "r_name").agg(
        r1(parts_mean("o_totalprice", SC)).alias("preu_mitja"),
        r1(F.max("o_totalprice_max")).alias("preu_max"),
        F.sum("_rows").cast("long").alias("n"))


# ---------------------------------------------------------------- fact x context

def _ctx_sums(spark, base, squares=False):
    """The target's readings summed per hour, beside that hour's weather."""
    sums = per_key(_target_fact(spark, base), ["id_temps", "hora"], {"valor": SC}, squares)
    return sums.join(DM.context(spark, base), ["id_temps", "hora"])


def _ctx_grouped(spark, base, key):
    return _ctx_sums(spark, base).groupBy(key).agg(
        r1(parts_mean("valor", SC)).alias("no2_mitja"),
        F.sum("_rows").cast("long").alias("num_mesures"))


_CTX_FROM = """
FROM m f JOIN p c ON f.magnitud = c.magnitud
         JOIN ctx x ON f.id_temps = x.id_temps AND f.hora = x.hora
WHERE c.contaminant = '""" + DM.TARGET_POLLUTANT + "'"


@query("wind_means", S.with_(S.MEASURES, S.POLLUTANTS, S.CONTEXT) + """
SELECT x.categoria_vent, """ + S.rnd(S.xmean("f.valor"), 1) + """ AS no2_mitja, COUNT(*) AS num_mesures"""
       + _CTX_FROM + " GROUP BY x.categoria_vent ORDER BY no2_mitja DESC")
def wind_means(spark, base):
    return _ctx_grouped(spark, base, "categoria_vent").orderBy(F.col("no2_mitja").desc(),
                                                               "categoria_vent")


@query("rain_means", S.with_(S.MEASURES, S.POLLUTANTS, S.CONTEXT) + """
SELECT x.plou, """ + S.rnd(S.xmean("f.valor"), 1) + """ AS no2_mitja, COUNT(*) AS num_mesures"""
       + _CTX_FROM + " GROUP BY x.plou")
def rain_means(spark, base):
    return _ctx_grouped(spark, base, "plou")


@query("weekend_mean", S.with_(S.MEASURES, S.POLLUTANTS, S.CAL) + """
SELECT t.es_cap_setmana, """ + S.rnd(S.xmean("f.valor"), 1) + """ AS no2_mitja
FROM m f JOIN p c ON f.magnitud = c.magnitud JOIN cal t ON f.id_temps = t.id_temps
WHERE c.contaminant = '""" + DM.TARGET_POLLUTANT + """'
GROUP BY t.es_cap_setmana""")
def weekend_mean(spark, base):
    cal = DM.calendar(spark, base).select("id_temps", "es_cap_setmana")
    j = per_key(_target_fact(spark, base), ["id_temps"], {"valor": SC}).join(cal, "id_temps")
    return j.groupBy("es_cap_setmana").agg(r1(parts_mean("valor", SC)).alias("no2_mitja"))


@query("month_context", S.with_(S.MEASURES, S.POLLUTANTS, S.CAL, S.CONTEXT) + """
SELECT t.mes, """ + S.rnd(S.xmean("f.valor"), 1) + """ AS no2_mitja,
       """ + S.rnd(S.xmean("x.temperatura"), 1) + """ AS temp_mitja
FROM m f JOIN p c ON f.magnitud = c.magnitud
         JOIN cal t ON f.id_temps = t.id_temps
         JOIN ctx x ON f.id_temps = x.id_temps AND f.hora = x.hora
WHERE c.contaminant = '""" + DM.TARGET_POLLUTANT + """'
GROUP BY t.mes""")
def month_context(spark, base):
    cal = DM.calendar(spark, base).select("id_temps", "mes")
    j = _ctx_sums(spark, base).join(cal, "id_temps")
    return j.groupBy("mes").agg(
        r1(parts_mean("valor", SC)).alias("no2_mitja"),
        r1(weighted_mean("temperatura", "_rows", SC)).alias("temp_mitja")).orderBy("mes")


@query("corr_matrix", S.with_(S.MEASURES, S.POLLUTANTS, S.CONTEXT) + """
SELECT """ + ",\n       ".join(
    f"{S.rnd(f'CORR(f.valor, x.{c})', 3)} + 0.0 AS corr_{n}"
    for n, c in (("temperatura", "temperatura"), ("vent", "vent_velocitat"),
                 ("humitat", "humitat"), ("pressio", "pressio"))) + _CTX_FROM)
def corr_matrix(spark, base):
    j = _ctx_sums(spark, base, squares=True)
    return j.agg(*[scaled_round(corr_of_sums("valor", c), 3).alias(f"corr_{n}")
                   for n, c in (("temperatura", "temperatura"), ("vent", "vent_velocitat"),
                                ("humitat", "humitat"), ("pressio", "pressio"))])


@query("coverage", S.with_(S.MEASURES, S.CONTEXT) + """
SELECT a AS amb_context, t AS total_fets,
       """ + S.rnd("CAST(a AS DOUBLE) * 100.0 / CAST(t AS DOUBLE)", 1) + """ AS percentatge
FROM (SELECT (SELECT COUNT(*) FROM m f JOIN ctx x ON f.id_temps = x.id_temps AND f.hora = x.hora) AS a,
             (SELECT COUNT(*) FROM m) AS t)""")
def coverage_q(spark, base):
    return coverage(DM.fact(spark, base), DM.context(spark, base), ["id_temps", "hora"])


@query("finding_ratio", S.with_(S.MEASURES, S.POLLUTANTS, S.CONTEXT) + """
SELECT """ + S.rnd("(calma - fort) * 100.0 / calma", 1) + """ AS caiguda_vent_fort,
       """ + S.rnd("(sec - pluja) * 100.0 / sec", 1) + """ AS caiguda_pluja
FROM (SELECT
  """ + S.xmean("CASE WHEN x.categoria_vent = 'Calma' THEN f.valor END") + """ AS calma,
  """ + S.xmean("CASE WHEN x.categoria_vent = 'Fort' THEN f.valor END") + """ AS fort,
  """ + S.xmean("CASE WHEN NOT x.plou THEN f.valor END") + """ AS sec,
  """ + S.xmean("CASE WHEN x.plou THEN f.valor END") + """ AS pluja""" + _CTX_FROM + ")")
def finding_ratio(spark, base):
    """The published findings: percent drop of the target with strong wind
    (against calm) and with rain (against dry hours)."""
    mean = lambda kept: parts_mean("valor", SC, kept)
    means = _ctx_sums(spark, base).agg(
        mean(F.col("categoria_vent") == D.WIND_CALM).alias("calma"),
        mean(F.col("categoria_vent") == D.WIND_STRONG).alias("fort"),
        mean(~F.col("plou")).alias("sec"),
        mean(F.col("plou")).alias("pluja"))
    return means.select(
        r1(F.try_divide((F.col("calma") - F.col("fort")) * F.lit(100.0), F.col("calma")))
        .alias("caiguda_vent_fort"),
        r1(F.try_divide((F.col("sec") - F.col("pluja")) * F.lit(100.0), F.col("sec")))
        .alias("caiguda_pluja"))


# ---------------------------------------------------------------- checks

@query("quality_report", S.with_(S.MEASURES, S.CONTEXT) + """
SELECT 'silver' AS taula, 'hora_fora_rang' AS "check", COUNT(*) FILTER (WHERE hora < 1 OR hora > 24) AS violacions FROM m
UNION ALL SELECT 'silver', 'valor_fora_rang', COUNT(*) FILTER (WHERE valor < 0 OR valor > 999.99) FROM m
UNION ALL SELECT 'silver', 'nuls_critics', COUNT(*) FILTER (WHERE valor IS NULL OR codi_eoi IS NULL) FROM m
UNION ALL SELECT 'context', 'temperatura_fora_rang', COUNT(*) FILTER (WHERE temperatura < 20 OR temperatura > 200) FROM ctx
UNION ALL SELECT 'context', 'humitat_fora_rang', COUNT(*) FILTER (WHERE humitat < 0 OR humitat > 100) FROM ctx
UNION ALL SELECT 'context', 'hora_fora_rang', COUNT(*) FILTER (WHERE hora < 1 OR hora > 24) FROM ctx
UNION ALL SELECT 'context', 'clau_duplicada', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT)
          FROM (SELECT COUNT(*) AS n FROM ctx GROUP BY id_temps, hora)""", )
def quality_report(spark, base):
    silver = Q.check_report(DM.fact(spark, base), [
        ("hora_fora_rang", Q.outside("hora", 1, 24)),
        ("valor_fora_rang", Q.outside("valor", 0, 999.99)),
        ("nuls_critics", Q.any_null("valor", "codi_eoi")),
    ], table="silver")
    ctx = DM.context(spark, base)
    ctx_checks = Q.check_report(ctx, [
        ("temperatura_fora_rang", Q.outside("temperatura", 20, 200)),
        ("humitat_fora_rang", Q.outside("humitat", 0, 100)),
        ("hora_fora_rang", Q.outside("hora", 1, 24)),
    ], table="context")
    dup = Q.key_uniqueness(ctx, ["id_temps", "hora"], "clau_duplicada").select(
        F.lit("context").alias("taula"), "check", "violacions", "ok")
    return silver.unionByName(ctx_checks).unionByName(dup).drop("ok")


@query("weather_checks_report", S.with_(S.MEASURES, S.CONTEXT) + """
SELECT 'silver_meteo' AS taula, 'temperatura_impossible' AS "check",
       COUNT(*) FILTER (WHERE temperatura < -20 OR temperatura > 50) AS violacions FROM ctx
UNION ALL SELECT 'silver_meteo', 'humitat_fora_rang', COUNT(*) FILTER (WHERE humitat < 0 OR humitat > 100) FROM ctx
UNION ALL SELECT 'silver_meteo', 'hora_fora_rang', COUNT(*) FILTER (WHERE hora < 1 OR hora > 24) FROM ctx""")
def weather_checks_report(spark, base):
    """The weather checks with their real limits, on the hourly stand-in."""
    return weather_checks(DM.context(spark, base)).drop("ok")


@query("pollutant_list", S.with_(S.MEASURES) + """
SELECT magnitud, contaminant, unitats, COUNT(*) OVER () AS total
FROM (SELECT DISTINCT magnitud, contaminant, unitats FROM m) ORDER BY contaminant""")
def pollutant_list(spark, base):
    dim = DM.pollutants(spark, base).select("magnitud", "contaminant", "unitats")
    return with_total(dim).orderBy("contaminant")


@query("table_total", "SELECT n_name, n_regionkey, COUNT(*) OVER () AS total FROM nation")
def table_total(spark, base):
    return with_total(read_table(spark, base, "nation", ["n_name", "n_regionkey"]))


@query("calendar_range", S.with_(S.MEASURES, S.CAL) + """
SELECT MIN(data) AS des_de, MAX(data) AS fins_a, COUNT(*) AS dies FROM cal""")
def calendar_range(spark, base):
    return range_stats(DM.calendar(spark, base), "data")


@query("gap_audit", S.with_(S.MEASURES) + """
SELECT codi_eoi, CAST(datediff('day', MIN(data), MAX(data)) + 1 AS BIGINT) AS dies_esperats,
       COUNT(*) AS dies_amb_dades
FROM (SELECT DISTINCT codi_eoi, data FROM m) GROUP BY codi_eoi""")
def gap_audit_q(spark, base):
    return gap_audit(DM.measures(spark, base), "data", ["codi_eoi"])


# ---------------------------------------------------------------- features

@query("feature_table", S.with_(S.MEASURES, S.CAL, S.CONTEXT, S.FEATURES) + "SELECT * FROM feat")
def feature_table(spark, base):
    return _features(spark, base)


@query("lag_corr", S.with_(S.MEASURES, S.CAL, S.CONTEXT, S.FEATURES) + """
SELECT magnitud, """ + ",\n       ".join(
    f"{S.rnd(f'CORR(no2_mitja, {c})', 3)} + 0.0 AS {n}"
    for n, c in (("lag1", "no2_lag1"), ("mitjana_3d", "no2_mm3"), ("mitjana_7d", "no2_mm7"),
                 ("vent", "vent_velocitat"), ("temperatura", "temperatura"))) + """
FROM feat WHERE no2_lag7 IS NOT NULL GROUP BY magnitud""")
def lag_corr(spark, base):
    return FE.lag_correlations(_features(spark, base), ["magnitud"])


@query("distribution", S.with_(S.MEASURES, S.CAL, S.CONTEXT, S.FEATURES) + """
SELECT magnitud, """ + S.rnd("MIN(no2_mitja)", 1) + """ AS minim,
       """ + S.rnd(S.xmean("no2_mitja"), 1) + """ AS mitjana,
       """ + S.rnd("MEDIAN(no2_mitja)", 1) + """ AS mediana,
       """ + S.rnd("MAX(no2_mitja)", 1) + """ AS maxim,
       """ + S.rnd("STDDEV_SAMP(no2_mitja)", 1) + """ AS desviacio,
       COUNT(*) FILTER (WHERE no2_mitja = 0) AS num_zeros,
       COUNT(*) FILTER (WHERE no2_mitja < 5) AS num_sota_5
FROM feat GROUP BY magnitud""")
def distribution_q(spark, base):
    return distribution(_features(spark, base), "no2_mitja", ["magnitud"], digits=1, scale=SC)


@query("station_medians", S.with_(S.MEASURES) + """
SELECT codi_eoi, MEDIAN(valor) AS mediana FROM m GROUP BY codi_eoi""")
def station_medians(spark, base):
    """The exact median of all raw readings of each station, by refined
    histograms: no task holds a station's readings."""
    return exact_quantile(DM.measures(spark, base), "valor", ["codi_eoi"])


@query("pollutant_medians", S.with_(S.MEASURES) + """
SELECT magnitud, MEDIAN(valor) AS mediana FROM m GROUP BY magnitud""")
def pollutant_medians(spark, base):
    """The exact median per pollutant, groups of a large share of all readings."""
    return exact_quantile(DM.measures(spark, base), "valor", ["magnitud"])


@query("last_30_days", S.with_(S.MEASURES, S.CAL, S.CONTEXT, S.FEATURES) + """
SELECT magnitud, """ + S.rnd("MIN(no2_mitja)", 1) + """ AS minim,
       """ + S.rnd(S.xmean("no2_mitja"), 1) + """ AS mitjana,
       """ + S.rnd("MAX(no2_mitja)", 1) + """ AS maxim, COUNT(*) AS n
FROM feat WHERE data >= (SELECT CAST(MAX(data) - INTERVAL 30 DAY AS DATE) FROM feat)
GROUP BY magnitud""")
def last_30_days(spark, base):
    """The last 30 days of all series, bounded by a scalar subquery."""
    recent = last_days(_features(spark, base), "data", 30)
    return recent.groupBy("magnitud").agg(
        r1(F.min("no2_mitja")).alias("minim"), r1(exact_mean("no2_mitja", SC)).alias("mitjana"),
        r1(F.max("no2_mitja")).alias("maxim"), F.count(F.lit(1)).alias("n"))


@query("last_n_days", S.with_(S.MEASURES, S.CAL, S.CONTEXT, S.FEATURES) + """
SELECT f.magnitud, """ + S.rnd("MIN(no2_mitja)", 1) + """ AS minim,
       """ + S.rnd(S.xmean("no2_mitja"), 1) + """ AS mitjana,
       """ + S.rnd("MAX(no2_mitja)", 1) + """ AS maxim, COUNT(*) AS n
FROM feat f JOIN (SELECT magnitud, MAX(data) AS md FROM feat GROUP BY magnitud) x
     ON f.magnitud = x.magnitud
WHERE f.data >= CAST(x.md - INTERVAL 7 DAY AS DATE)
GROUP BY f.magnitud""")
def last_n_days(spark, base):
    recent = last_days(_features(spark, base), "data", 7, by=["magnitud"])
    return recent.groupBy("magnitud").agg(
        r1(F.min("no2_mitja")).alias("minim"),
        r1(exact_mean("no2_mitja", SC)).alias("mitjana"),
        r1(F.max("no2_mitja")).alias("maxim"),
        F.count(F.lit(1)).alias("n"))


@query("year_month_means", S.with_(S.MEASURES, S.CAL, S.CONTEXT, S.FEATURES) + """
SELECT magnitud, any_, mes, """ + S.rnd(S.xmean("no2_mitja"), 1) + """ AS no2_mitja, COUNT(*) AS n
FROM feat GROUP BY magnitud, any_, mes""")
def year_month_means(spark, base):
    return (_features(spark, base).groupBy("magnitud", "any_", "mes")
            .agg(r1(exact_mean("no2_mitja", SC)).alias("no2_mitja"),
                 F.count(F.lit(1)).alias("n"))
            .orderBy("magnitud", "any_", "mes"))


@query("holdout_split", S.with_(S.MEASURES, S.CAL, S.CONTEXT, S.FEATURES) + """
SELECT magnitud, es_test, COUNT(*) AS n, MIN(data) AS des_de, MAX(data) AS fins_a
FROM (SELECT magnitud, data,
             ROW_NUMBER() OVER (PARTITION BY magnitud ORDER BY data DESC) <= 7 AS es_test
      FROM feat)
GROUP BY magnitud, es_test""")
def holdout_split(spark, base):
    h = holdout(_features(spark, base), ["magnitud"], "data", 7)
    return h.groupBy("magnitud", "es_test").agg(
        F.count(F.lit(1)).alias("n"), F.min("data").alias("des_de"), F.max("data").alias("fins_a"))


@query("naive_metrics", S.with_(S.MEASURES, S.CAL, S.CONTEXT, S.FEATURES) + """
SELECT magnitud,
       """ + S.rnd("AVG(ABS(y - yhat))", 4) + """ AS mae,
       """ + S.rnd("SQRT(AVG((y - yhat) * (y - yhat)))", 4) + """ AS rmse,
       """ + S.rnd("AVG(ABS(y - yhat) / ABS(y)) * 100.0", 4) + """ AS mape,
       """ + S.rnd("1.0 - SUM((y - yhat) * (y - yhat)) / (VAR_POP(y) * COUNT(*))", 4) + """ AS r2,
       COUNT(*) AS n, COUNT(*) FILTER (WHERE y = 0) AS n_mape_skip
FROM (SELECT magnitud, no2_mitja AS y, no2_lag1 AS yhat,
             ROW_NUMBER() OVER (PARTITION BY magnitud ORDER BY data DESC) AS rn
      FROM feat)
WHERE rn <= 7 AND y IS NOT NULL AND yhat IS NOT NULL
GROUP BY magnitud""")
def naive_metrics(spark, base):
    """Persistence forecast (yesterday's mean) scored on each series'
    hold-out days: the SQL-checkable baseline for the learned models."""
    h = holdout(_features(spark, base), ["magnitud"], "data", 7).where("es_test")
    return regression_metrics(h, "no2_mitja", "no2_lag1", ["magnitud"], digits=4)


# ---------------------------------------------------------------- sort / limit

@query("top_k", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderdate DESC, o_orderkey LIMIT 50""")
def top_k(spark, base):
    o = read_table(spark, base, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"])
    return o.orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").asc()).limit(50)


# ---------------------------------------------------------------- flagship

@query("daily_weekend_profile", S.with_(S.MEASURES, S.CAL, """d AS (SELECT codi_eoi, magnitud, id_temps, """ + S.rnd(S.xmean("valor"), 2) + """ AS valor_mitja
      FROM m GROUP BY codi_eoi, magnitud, id_temps)""") + """
SELECT d.magnitud, t.es_cap_setmana, """ + S.rnd(S.xmean("d.valor_mitja"), 2) + """ AS mitjana_diaria,
       COUNT(*) AS n_dies
FROM d JOIN cal t ON d.id_temps = t.id_temps
GROUP BY d.magnitud, t.es_cap_setmana""")
def daily_weekend_profile(spark, base):
    """Daily export fact -> calendar -> mean of the daily means per
    pollutant and weekend flag."""
    daily = grouped_stats(DM.fact(spark, base), ["codi_eoi", "magnitud", "id_temps"], "valor",
                          stats=("mean",), digits=2, scale=SC)
    cal = DM.calendar(spark, base).select("id_temps", "es_cap_setmana")
    return (daily.join(cal, "id_temps").groupBy("magnitud", "es_cap_setmana")
            .agg(r2(exact_mean("valor_mitja", SC)).alias("mitjana_diaria"),
                 F.count(F.lit(1)).alias("n_dies")))


# ---------------------------------------------------------------- more products

@query("station_means", """
SELECT s_name AS nom_estacio, n_name AS tipus_estacio,
       """ + S.rnd(S.xmean("l_quantity"), 1) + """ AS no2_mitja,
       """ + S.rnd("MAX(l_quantity)", 1) + """ AS no2_max, COUNT(*) AS num_mesures
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE l_returnflag = 'R'
GROUP BY s_name, n_name""")
def station_means(spark, base):
    """Per-station mean, max and count for one pollutant, on lineitem
    (station = supplier, pollutant = return flag, reading = quantity).
    Readings are first reduced to one partial row per station key (exact
    fixed-point sums), so the join with the station table moves one row per
    station instead of one per reading; the partials are then combined by
    station name and type."""
    li = (read_table(spark, base, "lineitem", ["l_suppkey", "l_returnflag", "l_quantity"])
          .where(F.col("l_returnflag") == "R"))
    per = per_key(li, ["l_suppkey"], {"l_quantity": SC})
    sup = read_table(spark, base, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    nat = read_table(spark, base, "nation", ["n_nationkey", "n_name"])
    j = (per.join(sup, per.l_suppkey == sup.s_suppkey)
            .join(nat, F.col("s_nationkey") == F.col("n_nationkey")))
    out = j.groupBy(F.col("s_name").alias("nom_estacio"), F.col("n_name").alias("tipus_estacio")).agg(
        r1(parts_mean("l_quantity", SC)).alias("no2_mitja"),
        r1(F.max("l_quantity_max")).alias("no2_max"),
        F.sum("_rows").cast("long").alias("num_mesures"))
    return out.orderBy(F.col("no2_mitja").desc(), "nom_estacio")


@query("source_selection", """
SELECT o_orderkey, o_orderdate, o_orderstatus, o_totalprice FROM orders
WHERE o_orderstatus = 'F'
ORDER BY o_orderdate DESC, o_orderkey LIMIT 100""")
def source_selection(spark, base):
    """The landed-source cut: one value of a filter column, newest N by
    date with a key tie-break (a per-task top-N, then a merge)."""
    o = read_table(spark, base, "orders", ["o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"])
    return select_newest(o, "F", 100, order_col="o_orderdate", tie_break=["o_orderkey"],
                         where_col="o_orderstatus")


@query("feature_table_calendar", S.with_(S.MEASURES, S.CAL, S.CONTEXT, S.CALENDAR_FEATURES)
       + "SELECT * FROM feat_cal")
def feature_table_calendar(spark, base):
    """Feature table where lags and trailing means count calendar days
    (missing days are NULL inside the window) instead of rows."""
    return FE.calendar_gap_features(_daily_base(spark, base), ["magnitud"])


@query("gap_audit_series", S.with_(S.MEASURES, S.CAL, S.CONTEXT, S.FEATURES) + """,
dies AS (SELECT DISTINCT data FROM feat),
rang AS (SELECT MIN(data) AS ini, MAX(data) AS fi FROM feat)
SELECT (SELECT CAST(datediff('day', ini, fi) + 1 AS BIGINT) FROM rang) AS dies_esperats,
       (SELECT COUNT(*) FROM dies) AS dies_amb_dades""")
def gap_audit_series(spark, base):
    """Days expected against days present on the feature table, as two
    scalar subqueries side by side."""
    f = _features(spark, base)
    rng = f.agg((F.datediff(F.max("data"), F.min("data")) + 1).cast("long").alias("dies_esperats"))
    days = f.select("data").distinct().agg(F.count(F.lit(1)).alias("dies_amb_dades"))
    return scalars_row(rng, days)


@query("station_list", """
SELECT o_custkey AS codi, ANY_VALUE(c_name) AS nom, ANY_VALUE(c_mktsegment) AS segment,
       ANY_VALUE(c_nationkey) AS nacio
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY o_custkey ORDER BY nom""")
def station_list(spark, base):
    """The station list ordered by name, from the dimension built out of the
    fact (Q1)."""
    return dim_by_key_q(spark, base).select("codi", "nom", "segment", "nacio").orderBy(
        F.col("nom").asc_nulls_last(), "codi")


# ---------------------------------------------------------------- the refresh's own builders

@query("landed_silver", S.with_(S.LANDED) + "SELECT * FROM silver")
def landed_silver(spark, base):
    """Landed wide text records -> silver with the refresh's own builder:
    unpivot of 24 hour cells, text parse and range filter, unit spelling,
    coordinate repair, text altitude to integer."""
    return LM.silver(spark, base)


@query("landed_checks", S.with_(S.LANDED) + """
SELECT 'silver_mesures' AS taula, "check", violacions, violacions = 0 AS ok FROM (
  SELECT 'latitud_fora_rang' AS "check", COUNT(*) FILTER (WHERE latitud < 40 OR latitud > 43) AS violacions FROM silver
  UNION ALL SELECT 'longitud_fora_rang', COUNT(*) FILTER (WHERE longitud < 0 OR longitud > 4) FROM silver
  UNION ALL SELECT 'hora_fora_rang', COUNT(*) FILTER (WHERE hora < 1 OR hora > 24) FROM silver
  UNION ALL SELECT 'nuls_critics', COUNT(*) FILTER (WHERE valor IS NULL OR codi_eoi IS NULL) FROM silver)""")
def landed_checks(spark, base):
    return measure_checks(LM.silver(spark, base))


@query("landed_dim_station", S.with_(S.LANDED) + """
SELECT codi_eoi, ANY_VALUE(nom_estacio) AS nom_estacio, ANY_VALUE(tipus_estacio) AS tipus_estacio,
       ANY_VALUE(area_urbana) AS area_urbana, ANY_VALUE(municipi) AS municipi,
       ANY_VALUE(nom_comarca) AS nom_comarca, ANY_VALUE(altitud) AS altitud,
       """ + S.rnd("AVG(latitud)", 6) + """ AS latitud, """ + S.rnd("AVG(longitud)", 6) + """ AS longitud
FROM silver GROUP BY codi_eoi""")
def landed_dim_station(spark, base):
    return LM.dim_station(spark, base)


@query("landed_dim_pollutant", S.with_(S.LANDED) + """
SELECT magnitud, ANY_VALUE(contaminant) AS contaminant, ANY_VALUE(unitats) AS unitats
FROM silver GROUP BY magnitud""")
def landed_dim_pollutant(spark, base):
    return LM.dim_pollutant(spark, base)


@query("landed_calendar", S.with_(S.LANDED, S.calendar("cal", "silver", "data")) + "SELECT * FROM cal")
def landed_calendar(spark, base):
    return LM.dim_calendar(spark, base)


@query("landed_fact_ids", S.with_(S.LANDED) + """
SELECT COUNT(*) AS n_files, COUNT(*) AS n_distinct, CAST(1 AS BIGINT) AS min_id,
       COUNT(*) AS max_id FROM silver""")
def landed_fact_ids(spark, base):
    """``fets_mesures`` with dense ids; the oracle states the property
    (ids are exactly 1..n, all distinct)."""
    f = LM.fact_with_ids(spark, base)
    return f.agg(F.count(F.lit(1)).alias("n_files"), F.count_distinct("id_mesura").alias("n_distinct"),
                 F.min("id_mesura").alias("min_id"), F.max("id_mesura").alias("max_id"))


@query("landed_features", S.with_(S.LANDED, S.CONTEXT, S.calendar("lcal", "silver", "data"),
                                  S.LANDED_STAR, S.DAILY, S.feat("feat", "base"))
       + "SELECT * FROM feat")
def landed_features(spark, base):
    return LM.features(spark, base)


@query("newest_cut", """
SELECT o_orderkey, o_orderdate, o_orderstatus, o_totalprice FROM orders
WHERE o_orderstatus = 'F'
ORDER BY o_orderdate DESC, o_orderkey LIMIT 2000""")
def newest_cut(spark, base):
    """A large source cut (newest 2,000 by date, key tie-break) through the
    distributed top-N: per-date and per-key counts find the cut-off, then a
    filter keeps the rows; no task gathers rows from the others."""
    o = read_table(spark, base, "orders", ["o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"])
    return select_newest(o, "F", 2000, order_col="o_orderdate", tie_break=["o_orderkey"],
                         where_col="o_orderstatus")
