"""Landed-file readers and the source selection."""

import json
import os

from pyspark.sql import functions as F

from aerolith.sources.bronze import read_air_json, read_weather_json, select_newest, select_weather_range
from aerolith.operators.topn import top_n
from fixtures import air_records, weather_payload


def test_newest_n_is_deterministic_with_ties(spark):
    rows = [("2024-01-02", "b", "8"), ("2024-01-02", "a", "8"), ("2024-01-02", "a", "14"),
            ("2024-01-01", "c", "8"), ("2024-01-03", "z", "8")]
    df = spark.createDataFrame([(d, k, m, "Barcelona") for d, k, m in rows],
                               "data string, codi_eoi string, magnitud string, municipi string")
    got = [(r.data, r.codi_eoi, r.magnitud) for r in select_newest(df, "Barcelona", 3).collect()]
    assert got == [("2024-01-03", "z", "8"), ("2024-01-02", "a", "14"), ("2024-01-02", "a", "8")]


def test_newest_n_is_exact_with_duplicates_and_nulls(spark):
    rows = [("2024-01-02", "a", "8")] * 3 + [("2024-01-02", None, "8"), (None, "a", "8"),
            ("2024-01-03", "b", None), ("2024-01-01", "a", "8"), (None, None, None)]
    df = spark.createDataFrame([(*r, "Barcelona") for r in rows],
                               "data string, codi_eoi string, magnitud string, municipi string")
    last = lambda v: (v is None, v or "")
    rows.sort(key=lambda r: (last(r[1]), last(r[2])))
    rows.sort(key=lambda r: r[0] or "", reverse=True)
    for n in range(1, len(rows) + 1):
        got = [tuple(r)[:3] for r in select_newest(df, "Barcelona", n).collect()]
        assert sorted(got, key=str) == sorted(rows[:n], key=str), n
    one, three = (top_n(df, 2, [(k, False) for k in keys]).count()
                  for keys in (["data"], ["data", "codi_eoi", "magnitud"]))
    assert one == three == 2


def test_json_lines_and_arrays_read_the_same(spark, scratch):
    root = os.path.join(scratch, "sources")
    os.makedirs(root, exist_ok=True)
    recs = air_records()
    with open(os.path.join(root, "array.json"), "w", encoding="utf-8") as f:
        json.dump(recs, f, ensure_ascii=False)
    lines_dir = os.path.join(root, "lines")
    os.makedirs(lines_dir, exist_ok=True)
    with open(os.path.join(lines_dir, "part.jsonl"), "w", encoding="utf-8") as f:
        for r in recs:
            f.write(json.dumps(r, ensure_ascii=False) + "\n")
    a = read_air_json(spark, os.path.join(root, "array.json"))
    b = read_air_json(spark, lines_dir, multi_line=False)
    assert a.count() == b.count() == len(recs)
    assert a.exceptAll(b).count() == 0
    assert a.where(F.col("codi_eoi") == "08019043").first().codi_eoi == "08019043"   # text kept


def test_weather_reader_and_range(spark, scratch):
    path = os.path.join(scratch, "sources", "meteo.json")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(weather_payload(), f)
    rows = read_weather_json(spark, path)
    assert rows.count() == 192
    first = rows.orderBy("time").first()
    assert first.time == "2024-01-01T00:00" and first.temperature_2m == 10.0
    assert select_weather_range(rows, "2024-01-02", "2024-01-03").count() == 48
