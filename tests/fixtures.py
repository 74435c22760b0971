"""Hand-made landed payloads covering the edge cases of the original SQL.

Station A (Eixample, NO2): full days 2024-01-01..05 with every hour equal to
the day number (daily means 1..5), 2024-01-07 with only 17 valid hours, no
record on 2024-01-06, full day 2024-01-08 with value 7.
Station B (Sants, NO2, unit spelled ``ug/m3``, coordinates mis-scaled) on
2024-01-02 with the text edge cases in h03..h11.
"""

from __future__ import annotations

import datetime as dt
import json
import os

A = dict(codi_eoi="08019043", nom_estacio="Barcelona (Eixample)", magnitud="8",
         contaminant="NO2", unitats="µg/m3", tipus_estacio="traffic", area_urbana="urban",
         municipi="Barcelona", nom_comarca="Barcelonès", altitud="26",
         latitud="41.385315", longitud="2.1538")
B = dict(codi_eoi="08019042", nom_estacio="Barcelona (Sants)", magnitud="8",
         contaminant="NO2", unitats="ug/m3", tipus_estacio="background", area_urbana="urban",
         municipi="Barcelona", nom_comarca="Barcelonès", altitud="25.6",
         latitud="4137878", longitud="21331000")


def _ts(d: dt.date) -> str:
    return f"{d.isoformat()}T00:00:00.000"


def air_records() -> list[dict]:
    recs = []
    for day, v in [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (8, 7)]:
        r = dict(A, data=_ts(dt.date(2024, 1, day)))
        r.update({f"h{h:02d}": str(v) for h in range(1, 25)})
        recs.append(r)
    # Day 5 repeated for a second pollutant (O3) so dimensions see two keys.
    o3 = dict(A, magnitud="14", contaminant="O3", data=_ts(dt.date(2024, 1, 5)))
    o3.update({f"h{h:02d}": "50" for h in range(1, 25)})
    recs.append(o3)
    # 17 valid hours only: absent from the features (HAVING >= 18).
    r = dict(A, data=_ts(dt.date(2024, 1, 7)), latitud="41.385316")
    r.update({f"h{h:02d}": "6" for h in range(1, 18)})
    recs.append(r)
    # Text edge cases.
    b = dict(B, data=_ts(dt.date(2024, 1, 2)))
    b.update(h03="12.5", h04=None, h05="", h06="n/a", h07="-1", h08="1000",
             h09="999.9", h10="0", h11="NaN")
    recs.append(b)
    # Dropped: no station code, no pollutant name, another municipality.
    recs.append(dict(A, codi_eoi=None, data=_ts(dt.date(2024, 1, 3)), h01="5"))
    recs.append(dict(A, contaminant=None, data=_ts(dt.date(2024, 1, 3)), h01="5"))
    recs.append(dict(A, municipi="Girona", data=_ts(dt.date(2024, 1, 3)), h01="5"))
    return recs


def weather_payload() -> dict:
    times, temp, hum, prec, wind, wdir, pres = [], [], [], [], [], [], []
    start = dt.datetime(2024, 1, 1)
    for i in range(8 * 24):
        t = start + dt.timedelta(hours=i)
        times.append(t.strftime("%Y-%m-%dT%H:%M"))
        temp.append(10.0 + (i % 24) / 2)
        hum.append(60.0)
        prec.append(0.1 if i % 2 else 0.0)
        wind.append([4.9, 5.0, 15.0][i % 3])
        wdir.append(180.0)
        pres.append(1013.0)
    # 2024-01-08 05:00 has no temperature: the hour is dropped.
    temp[7 * 24 + 5] = None
    # NULL wind -> 'Fort'; NULL rain -> not raining.
    wind[2 * 24 + 10] = None
    prec[2 * 24 + 11] = None
    return {"latitude": 41.3874, "longitude": 2.1686, "timezone": "Europe/Madrid",
            "hourly": {"time": times, "temperature_2m": temp, "relative_humidity_2m": hum,
                       "precipitation": prec, "wind_speed_10m": wind,
                       "wind_direction_10m": wdir, "surface_pressure": pres}}


def write_landing(root: str) -> tuple[str, str]:
    air_dir = os.path.join(root, "landing", "air")
    met_dir = os.path.join(root, "landing", "meteo")
    os.makedirs(air_dir, exist_ok=True)
    os.makedirs(met_dir, exist_ok=True)
    with open(os.path.join(air_dir, "qualitat_aire.json"), "w", encoding="utf-8") as f:
        json.dump(air_records(), f, ensure_ascii=False, indent=2)
    with open(os.path.join(met_dir, "meteo.json"), "w", encoding="utf-8") as f:
        json.dump(weather_payload(), f, ensure_ascii=False, indent=2)
    return air_dir, met_dir
