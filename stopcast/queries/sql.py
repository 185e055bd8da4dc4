"""DuckDB SQL fragments that rebuild the stand-in inputs of
``stopcast.sources.adapters`` for the oracle (same formulas)."""

MODEL_EVENTS = """
model_events AS (
  SELECT event_id,
         CAST(ts AS TIMESTAMP) AS event_timestamp,
         user_id AS user_pseudo_id,
         CAST(k AS BIGINT) AS gtfs_stop_id,
         CAST(k % 10 AS BIGINT) AS gtfs_route_id,
         CAST(event_type = 'purchase' AS BIGINT) AS target,
         CASE WHEN event_id % 53 = 0 THEN NULL ELSE value END AS dist_device_stop,
         CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 0.0::DOUBLE
              ELSE slat + ((event_id * 37) % 100 - 50) / 20000.0::DOUBLE END AS device_lat,
         CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 0.0::DOUBLE
              ELSE slon + ((event_id * 53) % 100 - 50) / 20000.0::DOUBLE END AS device_lon,
         slat AS stop_lat_event,
         slon AS stop_lon_event,
         CASE WHEN user_id IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY user_id) END AS user_frequency
  FROM (SELECT *, -23.60::DOUBLE + floor(k / 10) * 0.01::DOUBLE AS slat,
                  -46.70::DOUBLE + (k % 10) * 0.01::DOUBLE AS slon
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))
)"""

SCORES = """
scores AS (
  SELECT event_id AS id, CAST(event_type = 'purchase' AS INTEGER) AS label,
         floor((((event_id * 7919) % 1000) / 1000.0::DOUBLE * 0.6::DOUBLE
                + 0.4::DOUBLE * least(value / 100.0::DOUBLE, 1.0::DOUBLE)) * 100.0::DOUBLE) / 100.0::DOUBLE AS score
  FROM events
)"""


_K = "(SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"
_SLATLON = ("(SELECT *, -23.60::DOUBLE + floor(k / 10) * 0.01::DOUBLE AS slat, "
            "-46.70::DOUBLE + (k % 10) * 0.01::DOUBLE AS slon FROM " + _K + ")")

RAW_EVENTS = """
raw_events AS (
  SELECT event_id,
         CAST(ts AS TIMESTAMP) AS event_timestamp,
         CASE WHEN event_type = 'error' THEN 'app_error' ELSE 'bstop_open' END AS event_name,
         CAST(user_id AS VARCHAR) AS user_pseudo_id,
         CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'POINT(garbage)'
              ELSE 'POINT(' || printf('%.6f', dlon) || ' ' || printf('%.6f', dlat) || ')' END AS device_point,
         CASE WHEN event_id % 67 = 0 THEN NULL
              ELSE 'POINT (' || printf('%.6f', slon) || ' ' || printf('%.6f', slat) || ')' END AS ctm_stop_point,
         'android' AS platform,
         props AS ga_session_id
  FROM (SELECT *, slat + ((event_id * 37) % 100 - 50) / 20000.0::DOUBLE AS dlat,
                  slon + ((event_id * 53) % 100 - 50) / 20000.0::DOUBLE AS dlon
        FROM """ + _SLATLON + """)
)"""

STOPS = """
stops AS (
  SELECT CAST(k AS VARCHAR) AS stop_id, printf('%.6f', slat) AS stop_lat, printf('%.6f', slon) AS stop_lon
  FROM (SELECT DISTINCT k, -23.60::DOUBLE + floor(k / 10) * 0.01::DOUBLE AS slat,
                        -46.70::DOUBLE + (k % 10) * 0.01::DOUBLE AS slon FROM """ + _K + """ WHERE k IS NOT NULL)
)"""

STOP_TIMES = """
stop_times AS (
  SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS trip_id, CAST(l_partkey % 100 AS VARCHAR) AS stop_id FROM lineitem
)"""

FREQUENCIES = """
frequencies AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS trip_id, lpad(CAST(h AS VARCHAR), 2, '0') || ':00:00' AS start_time,
         CAST(300 + (s_suppkey * 7 + h * 13) % 3300 AS VARCHAR) AS headway_secs
  FROM (SELECT s_suppkey, unnest(range(0, 24)) AS h FROM supplier)
)"""

POINT_RE = r"POINT\s*\(\s*(-?\d+\.?\d*)\s+(-?\d+\.?\d*)\s*\)"


def point_lat(c: str) -> str:
    return f"CAST(nullif(regexp_extract({c}, '{POINT_RE}', 2), '') AS DOUBLE)"


def point_lon(c: str) -> str:
    return f"CAST(nullif(regexp_extract({c}, '{POINT_RE}', 1), '') AS DOUBLE)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def snap(expr: str) -> str:
    """SQL twin of ``stopcast.semantics.snap`` (multiples of 2^-24)."""
    return f"(floor(({expr}) * 16777216.0::DOUBLE + 0.5::DOUBLE) / 16777216.0::DOUBLE)"


def geodesic_sql(src: str, id_col: str, lat1: str, lon1: str, lat2: str, lon2: str, iters: int = 20) -> str:
    """DuckDB twin of ``stopcast.functions.geo._vincenty`` (same fixed number
    of passes, same operation order).  Returns a query with (id, dist)."""
    a, f = "6378137.0::DOUBLE", "(1 / 298.257223563::DOUBLE)"
    b = f"({a} * (1 - {f}))"
    base = f"""SELECT {id_col} AS gid, radians({lon2} - {lon1}) AS L,
        sin(atan((1 - {f}) * tan(radians({lat1})))) AS sU1, cos(atan((1 - {f}) * tan(radians({lat1})))) AS cU1,
        sin(atan((1 - {f}) * tan(radians({lat2})))) AS sU2, cos(atan((1 - {f}) * tan(radians({lat2})))) AS cU2
      FROM {src} WHERE {lat1} IS NOT NULL AND {lon1} IS NOT NULL AND {lat2} IS NOT NULL AND {lon2} IS NOT NULL"""
    aux = """SELECT *, CASE WHEN ss = 0 THEN 0.0 ELSE cU1 * cU2 * sl / ss END AS sa FROM (
          SELECT *, sqrt((cU2 * sl) * (cU2 * sl) + (cU1 * sU2 - sU1 * cU2 * cl) * (cU1 * sU2 - sU1 * cU2 * cl)) AS ss,
                 sU1 * sU2 + cU1 * cU2 * cl AS cs FROM (SELECT *, sin(lam) AS sl, cos(lam) AS cl FROM {t}))"""
    aux2 = """SELECT *, CASE WHEN c2a = 0 THEN 0.0 ELSE cs - 2 * sU1 * sU2 / c2a END AS c2m FROM (
          SELECT *, atan2(ss, cs) AS sg, 1 - sa * sa AS c2a FROM ({inner}))"""
    step = ("SELECT gid, L, sU1, cU1, sU2, cU2, L + (1 - C) * " + f + " * sa * (sg + C * ss * (c2m + C * cs * (-1 + 2 * c2m * c2m)))"
            " AS lam, i + 1 AS i FROM (SELECT *, " + f + " / 16 * c2a * (4 + " + f + " * (4 - 3 * c2a)) AS C FROM ("
            + aux2.format(inner=aux.format(t="v")) + ")) WHERE i < " + str(iters - 1))
    last = aux2.format(inner=aux.format(t=f"(SELECT * FROM v WHERE i = {iters - 1})"))
    dist = (f"SELECT gid, {b} * (1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))) * (sg - "
            f"(u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))) * ss * (c2m + (u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))) / 4 * "
            f"(cs * (-1 + 2 * c2m * c2m) - (u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))) / 6 * c2m * (-3 + 4 * ss * ss) * "
            f"(-3 + 4 * c2m * c2m)))) AS dist FROM (SELECT *, c2a * ({a} * {a} - {b} * {b}) / ({b} * {b}) AS u2 FROM ({last}))")
    return f"""(WITH RECURSIVE v AS (SELECT gid, L, sU1, cU1, sU2, cU2, L AS lam, 0 AS i FROM ({base})
      UNION ALL {step})
    {dist})"""
