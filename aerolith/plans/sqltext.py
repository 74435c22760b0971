"""SQL text for the DuckDB oracle queries: the same fixed-point means and
binary rounding as ``functions.numeric``, and the driver-table mapping of
``driver_map`` as common table expressions."""

from __future__ import annotations

from . import driver_map as DM


def fp(c: str, scale: int = 2) -> str:
    return f"CAST(ROUND(({c}) * {10 ** scale}.0) AS BIGINT)"


def xsum(c: str, scale: int = 2) -> str:
    return f"(CAST(SUM({fp(c, scale)}) AS DOUBLE) / {10 ** scale}.0)"


def xmean(c: str, scale: int = 2) -> str:
    return f"({xsum(c, scale)} / CAST(COUNT({c}) AS DOUBLE))"


def rnd(e: str, digits: int) -> str:
    return f"(ROUND(({e}) * {10 ** digits}.0) / {10 ** digits}.0)"


def date_key(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


MEASURES = f"""m AS (
  SELECT CAST(user_id AS VARCHAR) AS codi_eoi, event_type AS magnitud,
         upper(event_type) AS contaminant, 'events' AS unitats,
         CAST(ts AS DATE) AS data, {date_key('ts')} AS id_temps,
         CAST(hour(ts) + 1 AS INTEGER) AS hora, value AS valor
  FROM events
  WHERE value >= 0 AND value < 1000 AND user_id IS NOT NULL AND event_type IS NOT NULL)"""

CONTEXT_HOURS = f"""ctx_h AS (
  SELECT CAST(ts AS DATE) AS data, CAST(hour(ts) + 1 AS INTEGER) AS hora,
         {rnd(xmean('value'), 2)} AS temperatura,
         CAST(COUNT(*) AS DOUBLE) AS humitat,
         MIN(value) AS precipitacio,
         MAX(value) AS vent_velocitat,
         {rnd(xmean('k'), 2)} AS vent_direccio,
         {rnd(xsum('value'), 2)} AS pressio
  FROM (SELECT ts, value, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
        FROM events
        WHERE event_type = '{DM.CONTEXT_EVENT_TYPE}' AND value >= 0 AND value < 1000)
  GROUP BY 1, 2)"""

CONTEXT = f"""{CONTEXT_HOURS},
ctx AS (
  SELECT {date_key('data')} AS id_temps, hora, temperatura, humitat, precipitacio,
         vent_velocitat, vent_direccio, pressio,
         CASE WHEN precipitacio > {DM.RAIN_THRESHOLD} THEN TRUE ELSE FALSE END AS plou,
         CASE WHEN vent_velocitat < {DM.CALM_BELOW} THEN 'Calma'
              WHEN vent_velocitat < {DM.MODERATE_BELOW} THEN 'Moderat'
              ELSE 'Fort' END AS categoria_vent
  FROM ctx_h)"""

POLLUTANTS = """p AS (
  SELECT magnitud, ANY_VALUE(contaminant) AS contaminant, ANY_VALUE(unitats) AS unitats
  FROM m GROUP BY magnitud)"""


def calendar(name: str, source: str, date_expr: str) -> str:
    """Calendar CTE ``name`` spanning MIN..MAX of ``date_expr`` over ``source``."""
    return f"""{name} AS (
  SELECT {date_key('d')} AS id_temps, d AS data,
         CAST(year(d) AS INTEGER) AS "any", CAST(month(d) AS INTEGER) AS mes,
         CAST(quarter(d) AS INTEGER) AS trimestre,
         CAST(dayofweek(d) AS INTEGER) AS dia_setmana_num,
         dayname(d) AS dia_setmana, monthname(d) AS nom_mes,
         dayofweek(d) IN (0, 6) AS es_cap_setmana,
         CASE WHEN month(d) IN (12, 1, 2) THEN 'Hivern'
              WHEN month(d) IN (3, 4, 5) THEN 'Primavera'
              WHEN month(d) IN (6, 7, 8) THEN 'Estiu'
              ELSE 'Tardor' END AS estacio_any
  FROM (SELECT CAST(UNNEST(generate_series(ini, fi, INTERVAL 1 DAY)) AS DATE) AS d
        FROM (SELECT MIN({date_expr}) AS ini, MAX({date_expr}) AS fi FROM {source}) r))"""


CAL = calendar("cal", "m", "data")

J_EVENTS = """j AS (
  SELECT f.magnitud, f.valor, t.data, t.dia_setmana_num, t.es_cap_setmana, t.mes,
         t."any" AS any_, x.temperatura, x.humitat, x.precipitacio, x.vent_velocitat, x.pressio
  FROM m f JOIN cal t ON f.id_temps = t.id_temps
           JOIN ctx x ON f.id_temps = x.id_temps AND f.hora = x.hora)"""

DAILY = f"""base AS (
  SELECT magnitud, data,
         {rnd(xmean('valor'), 2)} AS no2_mitja,
         {rnd('MAX(valor)', 2)} AS no2_max,
         {rnd(xmean('temperatura'), 2)} AS temperatura,
         {rnd(xmean('humitat'), 2)} AS humitat,
         {rnd(xsum('precipitacio'), 2)} AS precipitacio,
         {rnd(xmean('vent_velocitat'), 2)} AS vent_velocitat,
         {rnd('MAX(vent_velocitat)', 2)} AS vent_max,
         {rnd(xmean('pressio'), 2)} AS pressio,
         ANY_VALUE(dia_setmana_num) AS dia_setmana_num,
         ANY_VALUE(es_cap_setmana) AS es_cap_setmana,
         ANY_VALUE(mes) AS mes, ANY_VALUE(any_) AS any_,
         COUNT(*) AS hores_amb_dada
  FROM j GROUP BY magnitud, data HAVING COUNT(*) >= {DM.MIN_HOURS})"""

BASE = J_EVENTS + ",\n" + DAILY


def feat(name: str, source: str) -> str:
    """Lag / trailing-mean / cyclic columns over ``source`` per series."""
    return f"""{name} AS (
  SELECT *,
         LAG(no2_mitja, 1) OVER w AS no2_lag1,
         LAG(no2_mitja, 2) OVER w AS no2_lag2,
         LAG(no2_mitja, 7) OVER w AS no2_lag7,
         {rnd(f"CAST(SUM({fp('no2_mitja')}) OVER w3 AS DOUBLE) / 100.0 / CAST(COUNT(no2_mitja) OVER w3 AS DOUBLE)", 2)} AS no2_mm3,
         {rnd(f"CAST(SUM({fp('no2_mitja')}) OVER w7 AS DOUBLE) / 100.0 / CAST(COUNT(no2_mitja) OVER w7 AS DOUBLE)", 2)} AS no2_mm7,
         LAG(vent_velocitat, 1) OVER w AS vent_lag1,
         LAG(precipitacio, 1) OVER w AS precip_lag1,
         {rnd('SIN(2 * PI() * dayofyear(data) / 365.0)', 4)} AS dia_any_sin,
         {rnd('COS(2 * PI() * dayofyear(data) / 365.0)', 4)} AS dia_any_cos
  FROM {source}
  WINDOW w AS (PARTITION BY magnitud ORDER BY data),
         w3 AS (PARTITION BY magnitud ORDER BY data ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
         w7 AS (PARTITION BY magnitud ORDER BY data ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))"""


FEATURES = BASE + ",\n" + feat("feat", "base")

CALENDAR_FEATURES = BASE + """,
spans AS (SELECT magnitud, MIN(data) AS a, MAX(data) AS b FROM base GROUP BY magnitud),
grid AS (SELECT magnitud, CAST(UNNEST(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS data
         FROM spans),
aligned AS (SELECT g.magnitud, g.data, b.* EXCLUDE (magnitud, data)
            FROM grid g LEFT JOIN base b ON g.magnitud = b.magnitud AND g.data = b.data),
""" + feat("feat_all", "aligned") + """,
feat_cal AS (SELECT * FROM feat_all WHERE no2_mitja IS NOT NULL)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_HOURS = [f"h{k:02d}" for k in range(1, 25)]

LANDED = f"""hourly AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS d, CAST(hour(ts) + 1 AS INTEGER) AS h,
         {xsum('value')} AS s
  FROM events GROUP BY ALL),
cells AS (
  SELECT user_id, event_type, d, h,
         CASE WHEN (user_id + h) % 11 = 0 THEN 'n/a'
              WHEN (user_id + h) % 11 = 1 THEN ''
              ELSE CAST(s AS VARCHAR) END AS cell
  FROM hourly),
wide AS (
  SELECT user_id, event_type, d,
         {", ".join(f"MAX(cell) FILTER (WHERE h = {k}) AS h{k:02d}" for k in range(1, 25))}
  FROM cells GROUP BY user_id, event_type, d),
landed AS (
  SELECT lpad(CAST(user_id AS VARCHAR), 8, '0') AS codi_eoi,
         'Estacio ' || CAST(user_id AS VARCHAR) AS nom_estacio,
         strftime(d, '%Y-%m-%d') || 'T00:00:00.000' AS data,
         event_type AS magnitud, upper(event_type) AS contaminant,
         CASE WHEN user_id % 2 = 0 THEN 'ug/m3' ELSE 'µg/m3' END AS unitats,
         CASE WHEN user_id % 3 = 0 THEN 'traffic' ELSE 'background' END AS tipus_estacio,
         'urban' AS area_urbana, 'Barcelona' AS municipi, 'Barcelonès' AS nom_comarca,
         CASE WHEN user_id % 2 = 0 THEN CAST(user_id % 500 AS VARCHAR)
              ELSE CAST(user_id % 500 AS VARCHAR) || '.6' END AS altitud,
         CASE WHEN user_id % 17 = 0 THEN '39.5'
              WHEN user_id % 5 = 0 THEN CAST(4130000 + user_id AS VARCHAR)
              ELSE '41.' || lpad(CAST(user_id AS VARCHAR), 4, '0') END AS latitud,
         CASE WHEN user_id % 7 = 0 THEN CAST(21000000 + user_id * 10 AS VARCHAR)
              ELSE '2.' || lpad(CAST(user_id AS VARCHAR), 4, '0') END AS longitud,
         {", ".join(_HOURS)}
  FROM wide),
long_cells AS (
  SELECT * EXCLUDE (hcol, txt), CAST(substr(hcol, 2, 2) AS INTEGER) AS hora,
         TRY_CAST(txt AS DOUBLE) AS v
  FROM (UNPIVOT landed ON {", ".join(_HOURS)} INTO NAME hcol VALUE txt)),
silver AS (
  SELECT codi_eoi, nom_estacio, CAST(data AS DATE) AS data, magnitud, contaminant,
         replace(unitats, 'ug/m3', 'µg/m3') AS unitats, tipus_estacio, area_urbana, municipi,
         nom_comarca, CAST(altitud AS INTEGER) AS altitud,
         CASE WHEN CAST(latitud AS DOUBLE) > 100 THEN CAST(latitud AS DOUBLE) / 100000
              ELSE CAST(latitud AS DOUBLE) END AS latitud,
         CASE WHEN CAST(longitud AS DOUBLE) > 100 THEN CAST(longitud AS DOUBLE) / 10000000
              ELSE CAST(longitud AS DOUBLE) END AS longitud,
         hora, v AS valor
  FROM long_cells
  WHERE v >= 0 AND v < 1000 AND codi_eoi IS NOT NULL AND contaminant IS NOT NULL)"""


LANDED_STAR = """lm AS (
  SELECT codi_eoi, magnitud, """ + date_key("data") + """ AS id_temps, hora, valor FROM silver),
lp AS (SELECT magnitud, ANY_VALUE(contaminant) AS contaminant FROM silver GROUP BY magnitud),
le AS (SELECT codi_eoi, ANY_VALUE(nom_estacio) AS nom_estacio FROM silver GROUP BY codi_eoi),
j AS (
  SELECT f.magnitud, f.valor, t.data, t.dia_setmana_num, t.es_cap_setmana, t.mes,
         t."any" AS any_, x.temperatura, x.humitat, x.precipitacio, x.vent_velocitat, x.pressio
  FROM lm f JOIN lp c ON f.magnitud = c.magnitud
            JOIN le e ON f.codi_eoi = e.codi_eoi
            JOIN lcal t ON f.id_temps = t.id_temps
            JOIN ctx x ON f.id_temps = x.id_temps AND f.hora = x.hora)"""
