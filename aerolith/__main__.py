"""Command-line entry point, for ``spark-submit`` or ``python -m aerolith``.

  refresh  landed JSON -> bronze -> silver -> gold -> features -> CSV exports
  train    boosted-tree run and seasonal ablation on the written feature table

The session comes from the cluster configuration (``getOrCreate``); the
checkpoint folder is the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="aerolith")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("--air", required=True)
    r.add_argument("--weather", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--municipi", default="Barcelona")
    r.add_argument("--limit", type=int, default=None)
    r.add_argument("--weather-start", default="2023-08-23")
    r.add_argument("--weather-end", default=None)
    r.add_argument("--json-lines", action="store_true", help="landed air files are JSON Lines")
    r.add_argument("--no-export", action="store_true")
    r.add_argument("--fail-on-check", action="store_true")
    r.add_argument("--max-bad-records", type=int, default=0,
                   help="landed records that may be left out (kept in quarantine)")
    t = sub.add_parser("train")
    t.add_argument("--lake", required=True)
    t.add_argument("--station", default="Barcelona (Eixample)")
    t.add_argument("--pollutant", default="NO2")
    t.add_argument("--test-days", type=int, default=60)
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"aerolith-{a.cmd}").getOrCreate()
    if a.cmd == "refresh":
        from .plans import refresh
        cfg = refresh.RefreshConfig(municipi=a.municipi, limit=a.limit, air_json_lines=a.json_lines,
                                    weather_start=a.weather_start, weather_end=a.weather_end,
                                    export=not a.no_export, fail_on_check=a.fail_on_check,
                                    max_bad_records=a.max_bad_records)
        res = refresh.run(spark, a.air, a.weather, a.out, cfg)
        print(json.dumps(res.counts))
        res.checks.show(truncate=False)
        res.coverage.show()
    else:
        from pyspark.sql import functions as F

        from .plans import models
        from .sources import versions
        lake = versions.current(spark, a.lake)
        feats = spark.read.parquet(os.path.join(lake, "gold_features_ml")).where(
            (F.col("nom_estacio") == a.station) & (F.col("contaminant") == a.pollutant))
        series = ["codi_eoi", "magnitud"]
        res = models.run_gbt(spark, feats, a.lake, series, a.test_days)
        res["metrics"].show()
        res["importance"].show()
        models.run_seasonal_ablation(spark, feats, a.lake, series, a.test_days).show()


if __name__ == "__main__":
    main()
