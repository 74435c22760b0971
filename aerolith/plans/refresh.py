"""Full refresh of the air-quality lake: landed JSON -> bronze -> silver ->
gold star -> daily features -> CSV exports.

Each layer is written as Parquet and read back by the next one, so every
stage starts from files (a stable input after an executor loss, and a cut
in the lineage). All tables go into the folder of a new version, which readers
see only once the last one is written (``sources.versions``). Landed records that
cannot be read are kept in ``quarantena``, and a landing ledger counts every file
(``sources.landing``). Quality checks and the join-coverage figure are returned
as small report DataFrames instead of being printed.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import coverage
from ..operators.quality import key_uniqueness, raise_on_failure
from ..sources import landing, versions
from ..sources.bronze import read_weather_json, select_newest, select_weather_range
from ..sources.sinks import export_csv, write_table
from . import exports, features, gold, silver

SERIES = ("codi_eoi", "nom_estacio", "magnitud", "contaminant")


@dataclass
class RefreshConfig:
    municipi: str | None = "Barcelona"
    limit: int | None = None            # newest N landed records; None keeps all
    air_json_lines: bool = False        # landed air files are JSON Lines (splittable)
    weather_start: str = "2023-08-23"
    weather_end: str | None = None
    min_hours: int = 18
    rain_threshold: float = 0.0
    calm_below: float = 5.0
    moderate_below: float = 15.0
    scale: int | None = None            # fixed-point decimals of readings, if known
    export: bool = True
    fail_on_check: bool = False
    max_bad_records: int = 0            # landed records that may be left out, in quarantine


@dataclass
class RefreshResult:
    counts: dict[str, int] = field(default_factory=dict)
    checks: DataFrame | None = None
    coverage: DataFrame | None = None
    correlations: DataFrame | None = None
    landing: DataFrame | None = None    # per landed file: records, bad, in bronze, left out
    path: str | None = None             # the published version's folder


def _read(spark: SparkSession, out: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(out, name))


def run(spark: SparkSession, air_path: str, weather_path: str, lake: str,
        cfg: RefreshConfig | None = None) -> RefreshResult:
    cfg = cfg or RefreshConfig()
    out = versions.begin(lake)
    res = RefreshResult(path=out)
    n = res.counts

    # Landing: every record with its file, bad ones apart, a ledger of the files.
    write_table(landing.read_air_landing(spark, air_path, multi_line=not cfg.air_json_lines),
                out, "landing_qualitat_aire")
    landed = _read(spark, out, "landing_qualitat_aire")
    write_table(landing.ledger(landed), out, "landing_fitxers")
    n["quarantena"] = write_table(landing.quarantine(landed), out, "quarantena")
    files = _read(spark, out, "landing_fitxers")
    landing.check_limit(spark, files, cfg.max_bad_records, os.path.join(out, "quarantena"))

    # Bronze: landed payloads as they are (text for air, arrays zipped for weather).
    air = select_newest(landing.good(landed), cfg.municipi, cfg.limit).drop("bytes", "modificat")
    n["bronze_qualitat_aire"] = write_table(air, out, "bronze_qualitat_aire")
    res.landing = landing.reconcile(files, _read(spark, out, "bronze_qualitat_aire"))
    met = select_weather_range(read_weather_json(spark, weather_path),
                               cfg.weather_start, cfg.weather_end)
    n["bronze_meteo"] = write_table(met, out, "bronze_meteo")

    # Silver.
    n["silver_mesures"] = write_table(
        silver.silver_measures(_read(spark, out, "bronze_qualitat_aire")), out, "silver_mesures")
    n["silver_meteo"] = write_table(
        silver.silver_weather(_read(spark, out, "bronze_meteo")), out, "silver_meteo")
    s = _read(spark, out, "silver_mesures")
    sm = _read(spark, out, "silver_meteo")
    checks = silver.measure_checks(s).unionByName(silver.weather_checks(sm))

    # Gold. The fact reads the written silver files, whose splits are stable,
    # so the dense ids need no extra checkpoint.
    n["dim_estacio"] = write_table(gold.dim_station(s, cfg.scale), out, "dim_estacio")
    n["dim_contaminant"] = write_table(gold.dim_pollutant(s), out, "dim_contaminant")
    n["dim_temps"] = write_table(gold.dim_calendar(s), out, "dim_temps")
    fact = gold.dense_ids_fact(s)
    n["fets_mesures"] = write_table(fact, out, "fets_mesures", partition_by=("magnitud",),
                                    sort_by=("id_temps", "hora"))
    n["dim_meteo"] = write_table(
        gold.dim_weather(sm, cfg.rain_threshold, cfg.calm_below, cfg.moderate_below),
        out, "dim_meteo")

    fets = _read(spark, out, "fets_mesures")
    dims = {t: _read(spark, out, t) for t in ("dim_estacio", "dim_contaminant", "dim_temps",
                                              "dim_meteo")}
    res.coverage = coverage(fets, dims["dim_meteo"], ["id_temps", "hora"])
    checks = checks.unionByName(
        key_uniqueness(dims["dim_meteo"], ["id_temps", "hora"], "meteo_clau_duplicada")
        .select(F.lit("dim_meteo").alias("taula"), "check", "violacions", "ok"))
    res.checks = checks

    # Daily features for every series.
    joined = features.star(fets, dims["dim_contaminant"], dims["dim_estacio"],
                           dims["dim_temps"], dims["dim_meteo"])
    base = features.daily_base(joined, list(SERIES), cfg.min_hours, cfg.scale)
    n["gold_features_base"] = write_table(base, out, "gold_features_base")
    feats = features.ml_features(_read(spark, out, "gold_features_base"), list(SERIES))
    n["gold_features_ml"] = write_table(feats, out, "gold_features_ml")
    res.correlations = features.lag_correlations(_read(spark, out, "gold_features_ml"),
                                                 list(SERIES))

    if cfg.export:
        exp = os.path.join(out, "export")
        for t in ("dim_estacio", "dim_contaminant", "dim_temps"):
            n[f"csv_{t}"] = export_csv(dims[t], exp, t, single_file=True)
        n["csv_dim_meteo"] = export_csv(dims["dim_meteo"], exp, "dim_meteo")
        n["csv_fets_diari"] = export_csv(exports.daily_fact(fets), exp, "fets_diari")
        n["csv_perfil_horari"] = export_csv(
            exports.hourly_profile(fets, dims["dim_temps"]), exp, "perfil_horari")
        n["csv_gold_features_ml"] = export_csv(_read(spark, out, "gold_features_ml"), exp,
                                               "gold_features_ml")
    if cfg.fail_on_check:
        raise_on_failure(checks)
    versions.publish(spark, lake, out)
    return res


def single_series(features_ml: DataFrame, station: str = "Barcelona (Eixample)",
                  pollutant: str = "NO2") -> DataFrame:
    """The original's one-series feature table (one station, one pollutant)."""
    return (features_ml.where((F.col("nom_estacio") == station) & (F.col("contaminant") == pollutant))
            .drop(*SERIES))
