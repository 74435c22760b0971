"""End-to-end refresh on the hand-made landing files (tests/fixtures.py)."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from aerolith.plans import refresh
from aerolith.sources import landing, versions
from aerolith.sources.sinks import write_table
from fixtures import write_landing


@pytest.fixture(scope="module")
def lake(spark, scratch):
    root = os.path.join(scratch, "refresh")
    air, met = write_landing(root)
    out = os.path.join(root, "lake")
    res = refresh.run(spark, air, met, out, refresh.RefreshConfig(weather_end="2024-01-31"))
    return spark, out, res


def t(lake, name):
    spark, out, _ = lake
    return spark.read.parquet(os.path.join(versions.current(spark, out), name))


def test_counts(lake):
    _, _, res = lake
    c = res.counts
    assert c["bronze_qualitat_aire"] == 11          # Girona record filtered
    assert c["silver_mesures"] == 161 + 24 + 3      # A NO2, A O3, B edge cases
    assert c["fets_mesures"] == c["silver_mesures"]
    assert c["dim_estacio"] == 2
    assert c["dim_contaminant"] == 2
    assert c["dim_temps"] == 8                      # gap day 2024-01-06 included
    assert c["bronze_meteo"] == 192
    assert c["silver_meteo"] == 191                 # NULL temperature hour dropped
    assert c["dim_meteo"] == 191


def test_silver_edge_cases(lake):
    b = t(lake, "silver_mesures").where(F.col("codi_eoi") == "08019042")
    rows = sorted((r.hora, r.valor) for r in b.collect())
    assert rows == [(3, 12.5), (9, 999.9), (10, 0.0)]
    r = b.first()
    assert r.unitats == "µg/m3" and r.unitats.encode() == b"\xc2\xb5g/m3"
    assert r.latitud == pytest.approx(41.37878) and r.longitud == pytest.approx(2.1331)
    assert r.altitud == 26
    assert r.data == dt.date(2024, 1, 2)


def test_checks_and_coverage(lake):
    _, _, res = lake
    checks = {r["check"]: r["violacions"] for r in res.checks.collect()}
    assert set(checks) >= {"latitud_fora_rang", "longitud_fora_rang", "hora_fora_rang",
                           "nuls_critics", "temperatura_impossible", "humitat_fora_rang",
                           "meteo_clau_duplicada"}
    assert all(v == 0 for v in checks.values())
    cov = res.coverage.first()
    assert (cov.amb_context, cov.total_fets, cov.percentatge) == (187, 188, 99.5)


def test_dims(lake):
    st = {r.codi_eoi: r for r in t(lake, "dim_estacio").collect()}
    assert st["08019043"].latitud == 41.385315      # mean of two spellings, 6 decimals
    assert st["08019042"].nom_estacio == "Barcelona (Sants)"
    pol = {r.magnitud: r.unitats for r in t(lake, "dim_contaminant").collect()}
    assert pol == {"8": "µg/m3", "14": "µg/m3"}
    sunday = t(lake, "dim_temps").where(F.col("data") == dt.date(2024, 1, 7)).first()
    assert (sunday.id_temps, sunday.dia_setmana_num, sunday.dia_setmana, sunday.nom_mes,
            sunday.es_cap_setmana, sunday.estacio_any, sunday.trimestre) == (
        20240107, 0, "Sunday", "January", True, "Hivern", 1)


def test_weather_buckets(lake):
    m = t(lake, "dim_meteo")
    hours = sorted(r.hora for r in m.select("hora").distinct().collect())
    assert hours == list(range(1, 25))
    # 2024-01-03 10:00 has NULL wind -> Fort, 11:00 NULL rain -> dry.
    r10 = m.where((F.col("id_temps") == 20240103) & (F.col("hora") == 11)).first()
    r11 = m.where((F.col("id_temps") == 20240103) & (F.col("hora") == 12)).first()
    assert r10.vent_velocitat is None and r10.categoria_vent == "Fort"
    assert r11.precipitacio is None and r11.plou is False
    cats = {(r.vent_velocitat, r.categoria_vent) for r in m.where("vent_velocitat IS NOT NULL").collect()}
    assert cats == {(4.9, "Calma"), (5.0, "Moderat"), (15.0, "Fort")}


def test_dense_fact_ids(lake):
    f = t(lake, "fets_mesures")
    agg = f.agg(F.min("id_mesura"), F.max("id_mesura"), F.count_distinct("id_mesura"),
                F.count(F.lit(1))).first()
    assert tuple(agg) == (1, 188, 188, 188)


def test_features(lake):
    feats = refresh.single_series(t(lake, "gold_features_ml")).orderBy("data").collect()
    assert [r.data.day for r in feats] == [1, 2, 3, 4, 5, 8]   # day 7 has 17 hours
    assert [r.no2_mitja for r in feats] == [1, 2, 3, 4, 5, 7]
    assert [r.no2_lag1 for r in feats] == [None, 1, 2, 3, 4, 5]  # row lag skips the gap
    assert [r.no2_mm3 for r in feats] == [None, 1, 1.5, 2, 3, 4]
    assert [r.no2_mm7 for r in feats] == [None, 1, 1.5, 2, 2.5, 3]
    assert all(r.no2_lag7 is None for r in feats)
    assert feats[-1].hores_amb_dada == 23
    assert len(feats[0].__fields__) == 23
    sev = t(lake, "gold_features_ml").where("contaminant = 'O3'").collect()
    assert len(sev) == 1 and sev[0].no2_mitja == 50


def test_exports(lake):
    _, _, res = lake
    exp = os.path.join(res.path, "export")
    for name in ("dim_estacio", "dim_contaminant", "dim_temps", "dim_meteo", "fets_diari",
                 "perfil_horari", "gold_features_ml"):
        files = glob.glob(os.path.join(exp, name, "part-*.csv"))
        assert files, name
    (dim_file,) = glob.glob(os.path.join(exp, "dim_estacio", "part-*.csv"))
    with open(dim_file, encoding="utf-8") as f:
        header = f.readline().strip()
        body = f.read()
    assert header.startswith("codi_eoi,")
    assert "08019043" in body                      # leading zero kept
    (cal_file,) = glob.glob(os.path.join(exp, "dim_temps", "part-*.csv"))
    with open(cal_file, encoding="utf-8") as f:
        text = f.read()
    assert "True" in text and "False" in text and "true" not in text
    assert res.counts["csv_fets_diari"] == 9       # A NO2 7 days + A O3 + B


def test_cli_refresh_and_train(spark, scratch):
    from aerolith.__main__ import main
    root = os.path.join(scratch, "cli")
    air, met = write_landing(root)
    lake = os.path.join(root, "lake")
    main(["refresh", "--air", air, "--weather", met, "--out", lake, "--weather-end", "2024-01-31"])
    out = versions.current(spark, lake)
    assert spark.read.parquet(os.path.join(out, "gold_features_ml")).count() == 7
    main(["train", "--lake", lake, "--test-days", "2"])
    runs = spark.read.parquet(os.path.join(lake, "runs"))
    assert {"seasonal_sense_meteo", "seasonal_amb_meteo"} <= {r.run_name for r in runs.collect()}
    fc = spark.read.parquet(os.path.join(lake, "forecasts", "seasonal_amb_meteo"))
    assert fc.count() == 2 and set(fc.columns) >= {"y", "yhat", "yhat_lower", "yhat_upper", "limit_ue"}


SF01 = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF01), reason="driver tables absent")
def test_refresh_on_driver_landing(spark, scratch):
    """The full refresh over landed JSON Lines derived from the sf0.01
    events: its silver equals the oracle-checked ``landed_silver`` query, and
    a pollutant filter on the written lake prunes fact partitions."""
    import contextlib
    import io

    from aerolith.plans import features as FE
    from aerolith.plans import landed_map as LM
    from fixtures import weather_payload
    import json

    root = os.path.join(scratch, "driver_landing")
    air = os.path.join(root, "air")
    met = os.path.join(root, "met")
    LM.landed_records(spark, SF01).write.json(air)
    os.makedirs(met)
    with open(os.path.join(met, "m.json"), "w") as f:
        json.dump(weather_payload(), f)
    lake = os.path.join(root, "lake")
    res = refresh.run(spark, air, met, lake,
                      refresh.RefreshConfig(weather_end="2024-02-28", export=False,
                                            air_json_lines=True))
    silver = spark.read.parquet(os.path.join(res.path, "silver_mesures"))
    assert res.counts["silver_mesures"] == LM.silver(spark, SF01).count()
    assert silver.exceptAll(LM.silver(spark, SF01)).count() == 0
    rd = lambda n: spark.read.parquet(os.path.join(res.path, n))
    j = FE.star(rd("fets_mesures"), rd("dim_contaminant"), rd("dim_estacio"), rd("dim_temps"),
                rd("dim_meteo"), pollutant="CLICK")
    q = FE.daily_base(j, ["codi_eoi", "magnitud"], 1)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    assert "dynamicpruningexpression(magnitud" in buf.getvalue()
    assert q.count() > 0


def test_failed_refresh_leaves_the_old_version_whole(spark, scratch, monkeypatch):
    """A refresh that dies between two tables changes nothing that readers see."""
    root = os.path.join(scratch, "torn")
    air, met = write_landing(root)
    lake = os.path.join(root, "lake")
    cfg = refresh.RefreshConfig(weather_end="2024-01-31", export=False)
    with pytest.raises(FileNotFoundError):
        versions.current(spark, lake)
    first = refresh.run(spark, air, met, lake, cfg)
    names = ["silver_mesures", "dim_estacio", "fets_mesures", "dim_meteo", "gold_features_ml"]
    read = lambda: {n: sorted(map(str, spark.read.parquet(
        os.path.join(versions.current(spark, lake), n)).collect())) for n in names}
    before = read()

    class Killed(RuntimeError):
        pass

    def dying(df, base, name, *a, **k):
        if name == "dim_meteo":
            raise Killed
        return write_table(df, base, name, *a, **k)

    monkeypatch.setattr(refresh, "write_table", dying)
    with pytest.raises(Killed):
        refresh.run(spark, air, met, lake, refresh.RefreshConfig(
            weather_end="2024-01-31", export=False, municipi="Girona"))
    assert versions.current(spark, lake) == first.path and read() == before
    monkeypatch.undo()
    second = refresh.run(spark, air, met, lake, cfg)
    assert versions.current(spark, lake) == second.path != first.path
    assert os.path.isdir(first.path)               # a reader may still hold it
    versions.expire(spark, lake, keep=1)
    assert not os.path.isdir(first.path) and len(read()["fets_mesures"]) == 188


def test_bad_records_are_kept_apart_and_counted(spark, scratch):
    root = os.path.join(scratch, "bad")
    air, met = write_landing(root)
    whole = os.path.join(air, "qualitat_aire.json")
    with open(whole, encoding="utf-8") as f:
        text = f.read()
    with open(os.path.join(air, "cut.json"), "w", encoding="utf-8") as f:
        f.write(text[:len(text) // 2])
    lake = os.path.join(root, "lake")
    cfg = refresh.RefreshConfig(weather_end="2024-01-31", export=False)
    with pytest.raises(landing.BadRecords, match="cut.json"):
        refresh.run(spark, air, met, lake, cfg)
    with pytest.raises(FileNotFoundError):
        versions.current(spark, lake)
    cfg.max_bad_records = 1
    res = refresh.run(spark, air, met, lake, cfg)
    assert res.counts["quarantena"] == 1 and res.counts["bronze_qualitat_aire"] == 11
    (bad,) = spark.read.parquet(os.path.join(res.path, "quarantena")).collect()
    assert bad.registre.startswith("[") and bad.fitxer.endswith("cut.json")
    files = {os.path.basename(r.fitxer): r for r in res.landing.collect()}
    assert all(r.ok for r in files.values())
    cut, good = files["cut.json"], files["qualitat_aire.json"]
    assert (cut.registres, cut.dolents, cut.bronze, cut.fora_seleccio) == (1, 1, 0, 0)
    assert (good.registres, good.dolents, good.bronze, good.fora_seleccio) == (12, 0, 11, 1)
    stamp = spark.read.parquet(os.path.join(res.path, "landing_fitxers")).where(
        "fitxer LIKE '%qualitat_aire.json'").first()
    assert stamp.bytes == os.path.getsize(whole) and stamp.modificat is not None


def test_landing_hash_follows_the_records(spark, scratch):
    import json
    root = os.path.join(scratch, "hashes")
    os.makedirs(root)
    recs = [{"codi_eoi": "1", "h01": "2"}, {"codi_eoi": "2"}]
    for name, rows in (("a", recs), ("b", recs[::-1]), ("c", [*recs, recs[0]]), ("d", recs[:1] * 2)):
        with open(os.path.join(root, f"{name}.jsonl"), "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
    with open(os.path.join(root, "e.jsonl"), "w") as f:
        f.write(json.dumps(recs[0]) + "\n{\"codi_eoi\": \"2\n")
    found = {os.path.basename(r.fitxer)[0]: r for r in landing.ledger(
        landing.read_air_landing(spark, root, multi_line=False)).collect()}
    assert found["a"].empremta == found["b"].empremta
    assert len({r.empremta for r in found.values()}) == 4
    assert (found["e"].registres, found["e"].dolents) == (2, 1)


def test_fact_files_follow_bytes_and_ranges_skip_row_groups(spark, scratch):
    """Partitions by pollutant get few files whatever the number of tasks, and a
    range of days reads only the row groups that hold it."""
    rows = spark.range(60_000, numPartitions=40).selectExpr(
        "CAST(id % 3 AS STRING) AS magnitud", "CAST(20240101 + id % 90 AS INT) AS id_temps",
        "CAST(id % 24 + 1 AS INT) AS hora", "CAST(id AS DOUBLE) AS valor")
    key = "parquet.block.size"
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set(key, str(64 << 10))
    try:
        write_table(rows, scratch, "layout", ("magnitud",), sort_by=("id_temps", "hora"))
        write_table(rows, scratch, "plain")
    finally:
        hadoop.unset(key)
    files = glob.glob(os.path.join(scratch, "layout", "magnitud=*", "part-*.parquet"))
    assert 3 <= len(files) <= 6

    def scanned(name):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            df = spark.read.parquet(os.path.join(scratch, name)).where(
                "id_temps BETWEEN 20240110 AND 20240112 AND magnitud = '1'")
            plan = df._jdf.queryExecution().executedPlan()
            plan.executeCollect()
            return plan.collectLeaves().head().metrics().apply("numOutputRows").value()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 0 < scanned("layout") < scanned("plain") / 4
