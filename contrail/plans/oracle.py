"""DuckDB SQL oracles for the registered queries.

Each string runs on the driver tables registered as views and must return
the same rows (same column names) as the Spark query of the same name. The
SQL is written independently of the Spark plans: shared CTEs restate the
flight feed, and each oracle states its operator directly in SQL.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '1998-01-01 00:00:00'"


def _airport(alias: str, side: str, blank_lat: bool = False, iata: str | None = None) -> str:
    iata = iata or f"'AP' || CAST({alias}.n_nationkey AS VARCHAR)"
    lat = f"CAST(({alias}.n_nationkey * 7) % 120 - 60 AS VARCHAR)"
    if blank_lat:
        lat = f"CASE WHEN {alias}.n_nationkey = 13 THEN '' ELSE {lat} END"
    return f"""
  {alias}.n_name AS {side}_airport_country_name,
  'C' || CAST({alias}.n_nationkey AS VARCHAR) AS {side}_airport_country_code,
  {iata} AS {side}_airport_iata,
  'Airport ' || {alias}.n_name AS {side}_airport_name,
  {lat} AS {side}_airport_latitude,
  CAST(({alias}.n_nationkey * 37) % 360 - 180 AS VARCHAR) AS {side}_airport_longitude,"""


HUB = "CASE WHEN os.n_nationkey = 3 THEN 'HUB' ELSE 'AP' || CAST(os.n_nationkey AS VARCHAR) END"
DEST = "CASE WHEN c_custkey % 97 <> 0 THEN 'AP' || CAST(dn.n_nationkey AS VARCHAR) END"
FLIGHTS = f"""flights AS (
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
  CASE WHEN s_suppkey % 17 = 0 THEN 'N/A' WHEN s_suppkey % 19 = 0 THEN NULL WHEN s_suppkey % 23 = 0 THEN ''
       ELSE 'S' || CAST(s_suppkey AS VARCHAR) END AS airline_icao,
  s_name AS airline_name,
  'A' || CAST(s_suppkey % 36 AS VARCHAR) AS airline_iata,{_airport('os', 'origin', iata=HUB)}{_airport('dn', 'destination', True, DEST)}
  CASE WHEN p_partkey % 101 <> 0 THEN p_type || ' ' || p_name END AS aircraft_model,
  CAST((l_partkey * 7) % 120 - 60 AS VARCHAR) AS latitude,
  CAST((l_partkey * 37) % 360 - 180 AS VARCHAR) AS longitude,
  CASE WHEN l_linestatus = 'F' THEN '1' ELSE '0' END AS on_ground,
  CASE WHEN l_returnflag = 'R' THEN 'Landed 10:00' WHEN l_returnflag = 'A' THEN 'Estimated 11:00'
       WHEN l_linenumber = 7 THEN NULL ELSE 'Scheduled' END AS status_text,
  CASE WHEN l_orderkey % 59 <> 0 THEN CAST(l_quantity * 3600 AS BIGINT) END AS historical_flighttime,
  CASE WHEN l_orderkey % 53 <> 0 THEN l_shipdate END AS scheduled_time_arrival,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_shipdate + INTERVAL 2 HOUR END AS estimated_arrival,
  l_shipdate - INTERVAL 90 DAY - INTERVAL 12 HOUR AS extract_ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
JOIN nation os ON s_nationkey = os.n_nationkey JOIN nation dn ON c_nationkey = dn.n_nationkey)"""

def _silver(as_of: str = AS_OF) -> str:
    return f"""silver AS (
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY extract_ts DESC NULLS LAST,
    aircraft_model ASC NULLS LAST, airline_name ASC NULLS LAST, historical_flighttime ASC NULLS LAST,
    on_ground ASC NULLS LAST, destination_airport_iata ASC NULLS LAST, status_text ASC NULLS LAST) AS rn
  FROM flights WHERE extract_ts <= {as_of}) WHERE rn = 1)"""


SILVER = _silver()


def _current(as_of: str = AS_OF, name: str = "current_f", src: str = "silver") -> str:
    arr = "coalesce(estimated_arrival, scheduled_time_arrival)"
    return (f"{name} AS (SELECT *, TRUE AS is_current, CAST(NULL AS TIMESTAMP) AS end_time FROM {src} "
            f"WHERE {arr} IS NULL OR {arr} >= {as_of})")


def _active(name: str = "active_f", src: str = "current_f") -> str:
    return (f"{name} AS (SELECT * FROM {src} WHERE TRY_CAST(on_ground AS INTEGER) = 0 "
            f"AND NOT contains(status_text, 'Landed'))")


CURRENT = _current()
ACTIVE = _active()

NATION_ZONES = """nation_zones AS (
SELECT n_name AS country, CASE WHEN n_nationkey <> 9 THEN CASE WHEN n_nationkey % 5 = 0 THEN 'America/' ELSE '' END
  || array_to_string([upper(x[1:1]) || lower(x[2:]) FOR x IN string_split(r_name, ' ')], ' ') || '/' || n_name END AS zone
FROM nation JOIN region ON n_regionkey = r_regionkey)"""
# Every country has the continent of its region, known or by its zone; the one country without either has none.
ZONED = """continents AS (SELECT n_name AS country, r_name AS continent FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE n_nationkey <> 9)"""
CONTINENTS = """continents AS (
SELECT n_name AS country, r_name AS continent FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def epoch(ts: str) -> str:
    # Whole seconds, floored like the Spark side (DuckDB's cast would round).
    return f"CAST(floor(epoch({ts})) AS BIGINT)"


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))")
    hc = f"(CASE WHEN {h} > 1.0 THEN 1.0 ELSE {h} END)"
    return f"(2.0 * 6371.0 * atan2(sqrt({hc}), sqrt(1.0 - {hc})))"


ROUTE = hav("TRY_CAST(origin_airport_latitude AS DOUBLE)", "TRY_CAST(origin_airport_longitude AS DOUBLE)",
            "TRY_CAST(destination_airport_latitude AS DOUBLE)", "TRY_CAST(destination_airport_longitude AS DOUBLE)")


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


FA = w(FLIGHTS, SILVER, CURRENT, ACTIVE)
FC = w(FLIGHTS, SILVER, CURRENT)

# The detail feed: per-row values behind the nested time struct and the legs.
DETAIL = """detail AS (
SELECT *, CAST(split_part(id, '-', 2) AS INTEGER) AS ln,
  CAST(floor(epoch(scheduled_time_arrival)) AS BIGINT) AS arr_s,
  CAST(floor(epoch(estimated_arrival)) AS BIGINT) AS est_s,
  CAST(floor(epoch(extract_ts)) AS BIGINT) AS upd_s
FROM flights)"""

FLIGHT_COLS = ["id", "airline_icao", "airline_name", "airline_iata",
               "origin_airport_country_name", "origin_airport_country_code", "origin_airport_iata",
               "origin_airport_name", "origin_airport_latitude", "origin_airport_longitude",
               "destination_airport_country_name", "destination_airport_country_code", "destination_airport_iata",
               "destination_airport_name", "destination_airport_latitude", "destination_airport_longitude",
               "aircraft_model", "latitude", "longitude", "on_ground", "status_text"]

LIFTED_TEXT = {
    "scheduled_time_departure": "CAST(arr_s - historical_flighttime AS VARCHAR)",
    "real_time_departure": "CASE WHEN ln = 7 THEN '' WHEN ln = 6 THEN '99999999999999999' "
                           "ELSE CAST(arr_s - historical_flighttime AS VARCHAR) END",
    "scheduled_time_arrival": "CAST(arr_s AS VARCHAR)",
    "estimated_arrival": "CAST(est_s AS VARCHAR)",
    "historical_flighttime": "CAST(historical_flighttime AS VARCHAR)",
    "historical_delay": "CASE WHEN estimated_arrival IS NULL THEN '0' ELSE '7200' END",
    "time_updated": "CAST(upd_s AS VARCHAR)",
    "time_eta": "CAST(coalesce(est_s, arr_s) AS VARCHAR)",
}
DEP_TS = "scheduled_time_arrival - to_seconds(historical_flighttime)"
LIFTED_TS = {
    "estimated_arrival": "estimated_arrival",
    "time_updated": "extract_ts",
    "time_eta": "coalesce(estimated_arrival, scheduled_time_arrival)",
    "real_time_departure": f"CASE WHEN ln IN (6, 7) THEN NULL ELSE {DEP_TS} END",
    "scheduled_time_arrival": "scheduled_time_arrival",
    "scheduled_time_departure": DEP_TS,
    "time": "extract_ts",
}


def _sel(m: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in m.items())


def _null_ratio_sql() -> str:
    text_cols = [c for c in FLIGHT_COLS] + ["squawk", "time"]
    other_cols = ["time_details", "aircraft_history", "extract_ts"]
    parts = [f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL OR trim({c}) IN ('', 'N/A') "
             f"THEN 1.0 ELSE 0.0 END), 6) AS missing_ratio FROM raw" for c in text_cols]
    parts += [f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) "
              f"AS missing_ratio FROM raw" for c in other_cols]
    raw = (f"raw AS (SELECT {', '.join(FLIGHT_COLS)}, CASE WHEN ln = 7 THEN 'x' END AS squawk, "
           f"CAST(upd_s AS VARCHAR) AS time, 1 AS time_details, "
           f"CASE WHEN ln = 7 THEN NULL ELSE 1 END AS aircraft_history, extract_ts FROM detail)")
    return w(FLIGHTS, DETAIL, raw) + "\nUNION ALL\n".join(parts)


def _leg_leaf_sql(more: str = "") -> str:
    def side(name: str) -> dict[str, str]:
        def pick(attr: str) -> str:
            return f"CASE WHEN k % 2 = 1 THEN {_col(name, attr, True)} ELSE {_col(name, attr, False)} END"
        p = f"aircraft_airport_{name}"
        return {
            f"{p}_website": "'https://' || " + pick("iata") + " || '.example'",
            f"{p}_visible": "'true'",
            f"{p}_timezone_offsetHours": "CAST(k AS VARCHAR) || ':00'",
            f"{p}_timezone_isDst": "'false'",
            f"{p}_timezone_abbrName": "'Universal Time'",
            f"{p}_timezone_abbr": "'UTC'",
            f"{p}_position_country_codeLong": "'X' || " + pick("country_code"),
            f"{p}_position_country_id": "substr(" + pick("country_code") + ", 2)",
            f"{p}_position_altitude": "CAST(k * 100 AS VARCHAR)",
            f"{p}_code_iata": pick("iata"),
            f"{p}_code_icao": "'I' || " + pick("iata"),
            f"{p}_name": pick("name"),
            f"{p}_position_country_name": pick("country_name"),
            f"{p}_position_country_code": pick("country_code"),
            f"{p}_position_latitude": pick("latitude"),
            f"{p}_position_longitude": pick("longitude"),
            f"{p}_position_region_city": "'City ' || " + pick("iata"),
            f"{p}_timezone_name": "'UTC'",
            f"{p}_timezone_offset": "CAST(k * 3600 AS VARCHAR)",
        }

    leaves = {
        "aircraft_identification_number_default": "airline_iata || CAST(ln * 100 + k AS VARCHAR)",
        "aircraft_identification_id": "id || '#' || CAST(k AS VARCHAR)",
        "aircraft_time_real_departure": "CAST(arr_s - k * 86400 AS VARCHAR)",
        **side("destination"), **side("origin"),
    }
    return (w(FLIGHTS, DETAIL) + f"SELECT id AS current_id, {more}{_sel(leaves)} "
            "FROM detail, range(1, 4) AS t(k) WHERE ln <> 7 AND k <= ln % 4")


def _col(leg_side: str, attr: str, odd: bool) -> str:
    # Which flight airport feeds this leg side: odd legs swap origin and destination.
    flight_side = {("origin", True): "destination", ("origin", False): "origin",
                   ("destination", True): "origin", ("destination", False): "destination"}[(leg_side, odd)]
    return f"{flight_side}_airport_{attr}"


EVENTS_SPLIT = "TIMESTAMP '2024-01-15 00:00:00'"


def _scd_sql(nullsafe_variant: bool, only_current: bool = False) -> str:
    et = "NULLIF(event_type, 'error')" if nullsafe_variant else "event_type"
    ev = f"ev AS (SELECT event_id, ts, user_id, {et} AS event_type, value, props FROM events)"
    base = f"""base AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM ev WHERE ts < {EVENTS_SPLIT}) WHERE rn = 1)"""
    upd = f"""upd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM ev WHERE ts >= {EVENTS_SPLIT}) WHERE rn = 1)"""
    rep = """pairs AS (SELECT b.user_id AS b_key, u.user_id AS u_key, b.ts AS b_ts, u.ts AS u_ts,
  (b.user_id IS NOT NULL AND u.user_id IS NOT NULL AND u.ts > b.ts
   AND b.event_type IS DISTINCT FROM u.event_type) AS replace_it
  FROM base b FULL OUTER JOIN upd u ON b.user_id = u.user_id)"""
    body = f"""SELECT b.*, NOT p.replace_it AS is_current, b.ts AS effective_time,
  CASE WHEN p.replace_it THEN p.u_ts END AS end_time
FROM base b JOIN pairs p ON p.b_key = b.user_id
UNION ALL
SELECT u.*, TRUE AS is_current, u.ts AS effective_time, CAST(NULL AS TIMESTAMP) AS end_time
FROM upd u JOIN pairs p ON p.u_key = u.user_id WHERE p.replace_it OR p.b_key IS NULL"""
    sql = w(ev, base, upd, rep) + body
    return f"SELECT * FROM ({sql}) WHERE is_current" if only_current else sql


HISTORY = """hist AS (
SELECT event_id, ts, user_id, event_type, value, props,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current,
  ts AS effective_time,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_time
FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p_ts,
             lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p_type FROM events)
WHERE p_ts IS NULL OR p_type IS DISTINCT FROM event_type)"""


def _airline_mart(as_of: str) -> str:
    c = _current(as_of, "cur", "silver")
    a = _active("act", "cur")
    stamp = (f"strftime({as_of}, '%Y') AS extract_year, strftime({as_of}, '%Y_%m') AS extract_month, "
             f"strftime({as_of}, '%Y_%m_%d') AS extract_day, {epoch(as_of)} AS extract_time")
    return (w(FLIGHTS, _silver(as_of), c, a) + "SELECT airline_name, airline_iata, count(*) AS total_active_flights, "
            f"{stamp} FROM act GROUP BY airline_name, airline_iata")


STAMP_TS = ("strftime({t}, '%Y') AS extract_year, strftime({t}, '%Y_%m') AS extract_month, "
            "strftime({t}, '%Y_%m_%d') AS extract_day, CAST(floor(epoch({t})) AS BIGINT) AS extract_time")

TRAIL = hav("p_lat", "p_lng", "lat", "lng")

LONGEST_TIME = """SELECT id, airline_name, historical_flighttime AS flighttime_seconds,
  CASE WHEN historical_flighttime IS NOT NULL THEN printf('%02d:%02d:%02d', historical_flighttime // 3600,
    (historical_flighttime % 3600) // 60, historical_flighttime % 60) END AS flighttime_hms FROM active_f"""
LONGEST_DISTANCE = f"""SELECT id, airline_name, origin_airport_iata, destination_airport_iata,
  round({ROUTE}, 6) AS distance_km FROM active_f"""

# The cleaned feed: valid keys only, times parsed, as the cleaning job stores it.
KEYS_OK = " AND ".join(f"{k} IS NOT NULL AND {k} NOT IN ('', 'N/A')" for k in (
    "airline_icao", "destination_airport_iata", "origin_airport_iata"))
CLEAN = f"clean AS (SELECT * FROM flights WHERE {KEYS_OK})"

# SCD2 rules on a feed with NULL keys, NULL times, late and equal times: newest row per key, NULL times oldest.
DIRTY_EVENTS = """ev AS (SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN ts END AS ts,
  CASE WHEN user_id % 13 <> 0 THEN user_id END AS user_id, event_type, value, props, event_id % 3 = 0 AS late FROM events)"""


def _dirty_side(name: str, where: str) -> str:
    return f"""{name} AS (SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM ev WHERE {where}) WHERE rn = 1)"""


SCD_DIRTY = w(DIRTY_EVENTS, _dirty_side("base", "NOT late"), _dirty_side("upd", "late"),
              """pairs AS (SELECT b.event_id AS b_id, u.event_id AS u_id, u.ts AS u_ts,
  coalesce(b.event_id IS NOT NULL AND u.event_id IS NOT NULL AND u.ts IS NOT NULL AND (b.ts IS NULL OR u.ts > b.ts)
    AND b.event_type IS DISTINCT FROM u.event_type, FALSE) AS replace_it
  FROM base b FULL OUTER JOIN upd u ON b.user_id IS NOT DISTINCT FROM u.user_id)""") + """
SELECT b.*, NOT p.replace_it AS is_current, b.ts AS effective_time, CASE WHEN p.replace_it THEN p.u_ts END AS end_time
FROM base b JOIN pairs p ON p.b_id = b.event_id
UNION ALL
SELECT u.*, TRUE AS is_current, u.ts AS effective_time, CAST(NULL AS TIMESTAMP) AS end_time
FROM upd u JOIN pairs p ON p.u_id = u.event_id WHERE p.replace_it OR p.b_id IS NULL"""

# Two polls: the second has the flights new since the first, and some of the first again, landed or under another airline.
FIRST_POLL = "TIMESTAMP '1997-12-31 00:00:00'"
POLLS = """polls AS (
SELECT * FROM silver
UNION ALL BY NAME
SELECT * EXCLUDE (o) REPLACE (TIMESTAMP '1997-12-31 18:00:00' AS extract_ts,
  CASE WHEN o % 7 = 1 THEN 'Moved' ELSE airline_name END AS airline_name, CASE WHEN o % 7 = 1 THEN 'M1' ELSE airline_iata END AS airline_iata,
  CASE WHEN o % 5 = 0 THEN 'Landed 12:00' ELSE status_text END AS status_text)
FROM (SELECT *, CAST(split_part(id, '-', 1) AS BIGINT) AS o FROM silver) WHERE o % 5 = 0 OR o % 7 = 1
UNION ALL BY NAME
SELECT * EXCLUDE (rn)
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY extract_ts DESC NULLS LAST,
    aircraft_model ASC NULLS LAST, airline_name ASC NULLS LAST, historical_flighttime ASC NULLS LAST,
    on_ground ASC NULLS LAST, destination_airport_iata ASC NULLS LAST, status_text ASC NULLS LAST) AS rn FROM flights
  WHERE extract_ts > TIMESTAMP '1997-12-31 00:00:00' AND extract_ts <= TIMESTAMP '1998-01-01 00:00:00') WHERE rn = 1)"""
THIRD_POLL = """third AS (SELECT * FROM polls UNION ALL BY NAME
SELECT * REPLACE (TIMESTAMP '1998-01-01 18:00:00' AS extract_ts, 'Scheduled' AS status_text, 'GLIDER one' AS aircraft_model)
FROM silver WHERE CAST(split_part(id, '-', 1) AS BIGINT) % 11 = 0)"""


def _last_seen(src: str) -> str:
    return (f"last_seen AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY extract_ts DESC) AS rn "
            f"FROM {src}) WHERE rn = 1)")


LAST_SEEN = _last_seen("polls")


def _side(s: str, a: str) -> str:
    return f"TRY_CAST({s}_airport_{a} AS DOUBLE)"


MARTS_SQL = w(FLIGHTS, _silver(FIRST_POLL), POLLS, THIRD_POLL, _last_seen("third"),
              "act AS (SELECT * FROM last_seen WHERE TRY_CAST(on_ground AS INTEGER) = 0 AND NOT contains(status_text, 'Landed'))",
              f"""dist AS (SELECT origin_airport_country_name AS country, origin_airport_country_code AS code,
  CAST(round({hav(_side('origin', 'latitude'), _side('origin', 'longitude'), _side('destination', 'latitude'), _side('destination', 'longitude'))}, 6)
       AS DECIMAL(18, 6)) AS km FROM act)""") + """
SELECT 'current_flight_by_airline' AS mart, airline_name AS g1, airline_iata AS g2, CAST(NULL AS VARCHAR) AS g3, CAST(NULL AS VARCHAR) AS g4,
  count(*) AS flights, CAST(NULL AS DOUBLE) AS number FROM act GROUP BY ALL
UNION ALL
SELECT 'regional_flight', origin_airport_country_name, origin_airport_country_code, airline_name, airline_iata,
  count(*) FILTER (origin_airport_country_name = destination_airport_country_name OR origin_airport_country_code = destination_airport_country_code),
  NULL FROM act GROUP BY ALL
UNION ALL
SELECT 'avg_distance_by_country', country, code, NULL, NULL, NULL, round(CAST(sum(km) AS DOUBLE) / nullif(count(km), 0), 6) FROM dist GROUP BY country, code
UNION ALL
SELECT 'aircraft_company_flight', split_part(aircraft_model, ' ', 1), NULL, NULL, NULL, count(*), NULL FROM act GROUP BY ALL
UNION ALL
SELECT 'aircraft_model_by_country', origin_airport_country_name, aircraft_model, NULL, NULL, count(aircraft_model), NULL FROM last_seen GROUP BY ALL
UNION ALL
SELECT 'in_out_flight', code, max(name), NULL, NULL, CAST(sum(o) AS BIGINT), CAST(sum(1 - o) AS DOUBLE) FROM (
  SELECT origin_airport_iata AS code, origin_airport_name AS name, 1 AS o FROM last_seen
  UNION ALL SELECT destination_airport_iata, destination_airport_name, 0 FROM last_seen) GROUP BY code
"""

ORACLE: dict[str, str] = {
    # sources / sinks
    "scan_filter": "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem "
                   "WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AND l_returnflag = 'R'",
    "scan_schema": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
    "write_partitioned": "SELECT event_id, ts, user_id, event_type, value, props, "
                         + STAMP_TS.format(t="ts") + " FROM events",
    "mart_append": _airline_mart(AS_OF),
    "mart_empty_rerun": _airline_mart("TIMESTAMP '1997-12-31 00:00:00'"),
    "mart_latest_run": _airline_mart("TIMESTAMP '1998-01-02 00:00:00'"),
    "mart_top3": "SELECT * FROM (" + _airline_mart("TIMESTAMP '1998-01-02 00:00:00'") + ") ORDER BY "
                 "total_active_flights DESC, airline_name ASC NULLS LAST, airline_iata ASC NULLS LAST LIMIT 3",
    "ingest_json": "SELECT event_id, ts, user_id, event_type, value, props, "
                   + STAMP_TS.format(t=AS_OF) + " FROM events",
    "bronze_ingest": "SELECT event_id, ts, user_id, event_type, value, props, "
                     + STAMP_TS.format(t=AS_OF) + " FROM events",
    "stream_ingest": "SELECT event_id, ts, user_id, event_type, value, props, "
                     + STAMP_TS.format(t=AS_OF) + " FROM events",
    "ingest_airline": "SELECT 'A' || s_suppkey AS Code, 'S' || s_suppkey AS ICAO, s_name AS Name, " + STAMP_TS.format(t=AS_OF)
                      + " FROM supplier",
    "ingest_airport": "SELECT CAST(c_custkey % 3000 AS VARCHAR) AS altitude, CAST(c_nationkey AS VARCHAR) AS country, "
                      "'AP' || c_custkey AS iata, 'IAP' || c_custkey AS icao, CAST(c_custkey * 7 % 120 - 60 AS VARCHAR) AS latitude, "
                      "CAST(c_custkey * 37 % 360 - 180 AS VARCHAR) AS longitude, c_name AS name, " + STAMP_TS.format(t=AS_OF)
                      + " FROM customer",
    "ingest_flight": "SELECT 'T' || (l_partkey % 90) AS aircraft_code, 'A' || (l_suppkey % 36) AS airline_iata, "
                     "'S' || l_suppkey AS airline_icao, CAST(l_quantity * 100 AS INTEGER) AS altitude, "
                     "'S' || l_suppkey || '-' || l_linenumber AS callsign, 'AP' || (l_partkey % 25) AS destination_airport_iata, "
                     "CAST(l_partkey % 500 AS INTEGER) AS ground_speed, CAST(l_partkey % 360 AS INTEGER) AS heading, "
                     "CAST(l_partkey AS VARCHAR) AS icao_24bit, l_orderkey || '-' || l_linenumber AS id, "
                     "CAST(l_partkey * 7 % 120 - 60 AS DOUBLE) AS latitude, CAST(l_partkey * 37 % 360 - 180 AS DOUBLE) AS longitude, "
                     "CAST(l_orderkey AS VARCHAR) AS number, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS on_ground, "
                     "'AP' || (l_suppkey % 25) AS origin_airport_iata, 'R' || l_partkey AS registration, "
                     "CASE WHEN l_linenumber = 7 THEN 'x' END AS squawk, CAST(floor(epoch(l_shipdate)) AS INTEGER) AS time, "
                     "0 AS vertical_speed, " + STAMP_TS.format(t=AS_OF) + " FROM lineitem",
    "ingest_detail": "SELECT o_orderkey, o_custkey, o_orderstatus, l_orderkey, l_linenumber, l_quantity, " + STAMP_TS.format(t=AS_OF)
                     + " FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
    "ingest_detail_feed": w(FLIGHTS, DETAIL, NATION_ZONES) + """SELECT id, airline_icao, status_text,
  zone AS origin_airport_timezone_name, CASE WHEN ln = 7 THEN '' WHEN ln = 6 THEN '99999999999999999'
    ELSE CAST(arr_s - historical_flighttime AS VARCHAR) END AS real_departure,
  CAST(CASE WHEN ln <> 7 THEN ln % 4 END AS INTEGER) AS n_legs,
  CASE WHEN ln <> 7 AND ln % 4 > 0 THEN destination_airport_iata END AS first_leg_origin,
  CAST(CASE WHEN ln % 2 = 0 THEN 2 END AS INTEGER) AS n_fixes, CASE WHEN ln % 2 = 0 THEN CAST(upd_s AS VARCHAR) END AS last_fix_ts,
  """ + STAMP_TS.format(t=AS_OF) + " FROM detail LEFT JOIN nation_zones ON origin_airport_country_name = country",
    "ingest_detail_quarantine": "SELECT CASE l_linenumber WHEN 7 THEN 'time_details' WHEN 6 THEN 'trail' "
                                "WHEN 5 THEN 'aircraft_history,trail' ELSE 'malformed' END AS failed_fields, count(*) AS n_records "
                                "FROM lineitem WHERE l_linenumber >= 4 GROUP BY 1",
    "scan_by_id": "SELECT l_orderkey || '-' || l_linenumber AS id, 'S' || l_suppkey || '-' || l_linenumber AS callsign, "
                  "CAST(floor(epoch(l_shipdate)) AS INTEGER) AS time, CAST(l_partkey * 7 % 120 - 60 AS DOUBLE) AS latitude, "
                  "CAST(l_partkey * 37 % 360 - 180 AS DOUBLE) AS longitude, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS on_ground "
                  "FROM lineitem WHERE l_orderkey || '-' || l_linenumber IN ('1-1', '7-2', '30-3', '100-1', '500-4', '1123-7', "
                  "'1499-2', 'no such flight')",
    "compacted_runs": "SELECT event_id, ts, user_id, event_type, value, props, "
                      + STAMP_TS.format(t="(TIMESTAMP '1998-01-01 00:00:00' + to_hours(hour(ts)))") + " FROM events",
    "enrich_detail": "SELECT o_orderkey, o_custkey, o_orderstatus, l_orderkey, l_linenumber, l_quantity "
                     "FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
    "enrich_late": "SELECT o_orderkey, o_custkey, o_orderstatus, l_orderkey, l_linenumber, l_quantity "
                     "FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
    "enrich_pending": "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 1 THEN 2 ELSE 1 END AS polls_waited "
                      "FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    "enrich_detail_missing": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders "
                             "WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    "extract_stamp": w(FLIGHTS) + "SELECT id, extract_ts, " + STAMP_TS.format(t="extract_ts") + " FROM flights",
    # projections / filters / cleaning
    "clean_drop_null_keys": w(FLIGHTS) + "SELECT id, airline_icao, origin_airport_iata, destination_airport_iata "
                            "FROM flights WHERE airline_icao IS NOT NULL AND destination_airport_iata IS NOT NULL "
                            "AND origin_airport_iata IS NOT NULL",
    "clean_drop_sentinels": w(FLIGHTS) + "SELECT id, airline_icao, origin_airport_iata, destination_airport_iata "
                            "FROM flights WHERE (airline_icao IS NULL OR airline_icao NOT IN ('', 'N/A')) "
                            "AND (origin_airport_iata IS NULL OR origin_airport_iata NOT IN ('', 'N/A')) "
                            "AND (destination_airport_iata IS NULL OR destination_airport_iata NOT IN ('', 'N/A'))",
    "flatten_struct": w(FLIGHTS, DETAIL) + f"SELECT id, {_sel(LIFTED_TEXT)} FROM detail",
    "epoch_to_ts": w(FLIGHTS, DETAIL) + f"SELECT id, {_sel(LIFTED_TS)} FROM detail",
    "clean_flights": w(FLIGHTS, DETAIL) + f"SELECT {', '.join(FLIGHT_COLS)}, extract_ts, "
                     f"{_sel({k: v for k, v in LIFTED_TS.items()})}, "
                     "CAST(historical_flighttime AS VARCHAR) AS historical_flighttime, "
                     "CASE WHEN estimated_arrival IS NULL THEN '0' ELSE '7200' END AS historical_delay "
                     "FROM detail WHERE airline_icao IS NOT NULL AND destination_airport_iata IS NOT NULL "
                     "AND origin_airport_iata IS NOT NULL AND airline_icao NOT IN ('', 'N/A') "
                     "AND destination_airport_iata NOT IN ('', 'N/A') AND origin_airport_iata NOT IN ('', 'N/A')",
    "blank_to_null": w(FLIGHTS) + "SELECT " + ", ".join(
        f"CASE WHEN {c} IS NULL OR trim({c}) IN ('', 'N/A') THEN NULL ELSE {c} END AS {c}" for c in FLIGHT_COLS)
        + ", historical_flighttime, scheduled_time_arrival, estimated_arrival, extract_ts FROM flights",
    "null_ratio_profile": _null_ratio_sql(),
    "profile_from_runs": w(FLIGHTS) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL{more} THEN 1.0 ELSE 0.0 END), 6) AS missing_ratio FROM flights"
        for c, more in [(c, f" OR trim({c}) IN ('', 'N/A')") for c in FLIGHT_COLS]
        + [(c, "") for c in ("historical_flighttime", "scheduled_time_arrival", "estimated_arrival", "extract_ts")]),
    "prune_from_profiles": w(FLIGHTS) + "SELECT " + ", ".join(
        f"CASE WHEN {c} IS NULL OR trim({c}) IN ('', 'N/A') THEN NULL ELSE {c} END AS {c}" for c in FLIGHT_COLS)
        + ", historical_flighttime, scheduled_time_arrival, extract_ts FROM flights",
    "prune_sparse_columns": w(FLIGHTS, DETAIL) + "SELECT " + ", ".join(
        f"CASE WHEN {c} IS NULL OR trim({c}) IN ('', 'N/A') THEN NULL ELSE {c} END AS {c}" for c in FLIGHT_COLS)
        + ", CAST(upd_s AS VARCHAR) AS time, extract_ts, TRUE AS has_time_details, ln <> 7 AS has_aircraft_history "
        "FROM detail",
    "clean_to_silver": w(FLIGHTS, CLEAN, """versions AS (
SELECT id, airline_icao, origin_airport_iata, destination_airport_iata, status_text, on_ground, extract_ts AS time_updated,
  row_number() OVER (PARTITION BY id ORDER BY extract_ts DESC NULLS LAST, status_text DESC NULLS LAST,
    on_ground DESC NULLS LAST, airline_icao DESC NULLS LAST, origin_airport_iata DESC NULLS LAST,
    destination_airport_iata DESC NULLS LAST) AS rn FROM clean)""")
    + "SELECT * EXCLUDE (rn), TRUE AS is_current, time_updated AS effective_time, CAST(NULL AS TIMESTAMP) AS end_time "
    "FROM versions WHERE rn = 1",
    "current_flights": FC + "SELECT * FROM current_f",
    "active_flights": FA + "SELECT * FROM active_f",
    "dedup_latest": w(FLIGHTS, SILVER) + "SELECT * FROM silver",
    "regional_flag": FA + """SELECT id, CASE WHEN (origin_airport_country_name IS NOT NULL
  AND destination_airport_country_name IS NOT NULL
  AND origin_airport_country_name = destination_airport_country_name)
  OR (origin_airport_country_code IS NOT NULL AND destination_airport_country_code IS NOT NULL
  AND origin_airport_country_code = destination_airport_country_code) THEN 1 ELSE 0 END AS regional_flights_active
FROM active_f""",
    "route_distance": FA + f"SELECT id, round({ROUTE}, 6) AS distance_km FROM active_f",
    "route_distance_sql": FA + f"SELECT id, round({ROUTE}, 6) AS distance_km FROM active_f",
    "serving_current": w(FLIGHTS, SILVER) + f"""SELECT *,
  CASE WHEN coalesce(estimated_arrival, scheduled_time_arrival) < {AS_OF} THEN FALSE ELSE TRUE END AS is_current,
  CASE WHEN coalesce(estimated_arrival, scheduled_time_arrival) < {AS_OF} THEN {AS_OF} END AS end_time
FROM silver""",
    # nested
    "explode_history": w(FLIGHTS, DETAIL) + "SELECT id AS current_id, aircraft_model, CAST(k - 1 AS INTEGER) AS leg_pos, "
                       "id || '#' || CAST(k AS VARCHAR) AS leg_id FROM detail, range(1, 4) AS t(k) "
                       "WHERE ln <> 7 AND k <= ln % 4",
    "flatten_history": _leg_leaf_sql(),
    "history_mart": _leg_leaf_sql("aircraft_model, " + STAMP_TS.format(t=AS_OF) + ", "),
    # aggregates / indicators
    "airline_active_counts": FA + "SELECT airline_name, airline_iata, count(*) AS total_active_flights "
                             "FROM active_f GROUP BY airline_name, airline_iata",
    "top_airline": FA + "SELECT airline_name, airline_iata, count(*) AS total_active_flights FROM active_f "
                   "GROUP BY airline_name, airline_iata "
                   "ORDER BY total_active_flights DESC, airline_name ASC NULLS LAST, airline_iata ASC NULLS LAST "
                   "LIMIT 1",
    "regional_by_country_airline": FA + """SELECT origin_airport_country_name AS country,
  origin_airport_country_code AS country_code, airline_name, airline_iata,
  CAST(sum(CASE WHEN (origin_airport_country_name IS NOT NULL AND destination_airport_country_name IS NOT NULL
    AND origin_airport_country_name = destination_airport_country_name)
    OR (origin_airport_country_code IS NOT NULL AND destination_airport_country_code IS NOT NULL
    AND origin_airport_country_code = destination_airport_country_code) THEN 1 ELSE 0 END) AS BIGINT)
    AS total_regional_flights
FROM active_f GROUP BY 1, 2, 3, 4""",
    "avg_distance_by_country": FA + f"SELECT origin_airport_country_name AS country, "
                               f"origin_airport_country_code AS country_code, "
                               f"round(avg({ROUTE}), 6) AS average_flight_length_km FROM active_f GROUP BY 1, 2",
    "manufacturer_counts": FA + "SELECT split_part(aircraft_model, ' ', 1) AS aircraft_manufacturer, "
                           "count(*) AS total_active_flights FROM active_f GROUP BY 1",
    "top_manufacturer": FA + "SELECT split_part(aircraft_model, ' ', 1) AS aircraft_manufacturer, "
                        "count(*) AS total_active_flights FROM active_f GROUP BY 1 "
                        "ORDER BY total_active_flights DESC, aircraft_manufacturer ASC NULLS LAST LIMIT 1",
    "models_by_country": FC + """SELECT origin_airport_country_name AS country, aircraft_model,
  count(aircraft_model) AS total_aircraft_model FROM current_f GROUP BY 1, 2""",
    "airport_outbound": FC + "SELECT origin_airport_iata AS airport_iata, max(origin_airport_name) AS airport_name, "
                        "count(*) AS out_flight_count FROM current_f GROUP BY 1",
    "airport_inbound": FC + "SELECT destination_airport_iata AS airport_iata, "
                       "max(destination_airport_name) AS airport_name, count(*) AS in_flight_count "
                       "FROM current_f GROUP BY 1",
    "airport_in_out": FC + """SELECT coalesce(o.airport_iata, i.airport_iata) AS airport_iata,
  greatest(o.airport_name, i.airport_name) AS airport_name,
  coalesce(o.n, 0) AS out_flight_count, coalesce(i.n, 0) AS in_flight_count,
  abs(coalesce(o.n, 0) - coalesce(i.n, 0)) AS difference
FROM (SELECT origin_airport_iata AS airport_iata, max(origin_airport_name) AS airport_name, count(*) AS n
      FROM current_f GROUP BY 1) o
FULL OUTER JOIN (SELECT destination_airport_iata AS airport_iata, max(destination_airport_name) AS airport_name,
      count(*) AS n FROM current_f GROUP BY 1) i ON o.airport_iata = i.airport_iata""",
    "airport_max_imbalance": FC + """SELECT * FROM (
  SELECT coalesce(o.airport_iata, i.airport_iata) AS airport_iata,
    greatest(o.airport_name, i.airport_name) AS airport_name,
    coalesce(o.n, 0) AS out_flight_count, coalesce(i.n, 0) AS in_flight_count,
    abs(coalesce(o.n, 0) - coalesce(i.n, 0)) AS difference
  FROM (SELECT origin_airport_iata AS airport_iata, max(origin_airport_name) AS airport_name, count(*) AS n
        FROM current_f GROUP BY 1) o
  FULL OUTER JOIN (SELECT destination_airport_iata AS airport_iata, max(destination_airport_name) AS airport_name,
        count(*) AS n FROM current_f GROUP BY 1) i ON o.airport_iata = i.airport_iata)
ORDER BY difference DESC, airport_iata ASC NULLS LAST LIMIT 1""",
    "longest_by_time": FA + LONGEST_TIME,
    "top_longest_by_time": FA + LONGEST_TIME + " ORDER BY flighttime_seconds DESC NULLS LAST, id ASC LIMIT 10",
    "longest_by_distance": FA + LONGEST_DISTANCE,
    "top_longest_by_distance": FA + LONGEST_DISTANCE + " ORDER BY distance_km DESC NULLS LAST, id ASC LIMIT 10",
    "top_regional_airline_by_continent": w(FLIGHTS, SILVER, CURRENT, ACTIVE, CONTINENTS) + """SELECT continent,
  airline_name, airline_iata, total_regional_flights FROM (
  SELECT *, row_number() OVER (PARTITION BY continent ORDER BY total_regional_flights DESC,
    airline_name ASC NULLS LAST, airline_iata ASC NULLS LAST) AS rk FROM (
    SELECT c.continent, airline_name, airline_iata,
      CAST(sum(CASE WHEN (origin_airport_country_name IS NOT NULL AND destination_airport_country_name IS NOT NULL
        AND origin_airport_country_name = destination_airport_country_name)
        OR (origin_airport_country_code IS NOT NULL AND destination_airport_country_code IS NOT NULL
        AND origin_airport_country_code = destination_airport_country_code) THEN 1 ELSE 0 END) AS BIGINT)
        AS total_regional_flights
    FROM active_f a LEFT JOIN continents c ON a.origin_airport_country_name = c.country GROUP BY 1, 2, 3))
WHERE rk = 1""",
    "avg_distance_by_continent": w(FLIGHTS, SILVER, CURRENT, ACTIVE, CONTINENTS) + f"""SELECT c.continent,
  round(avg({ROUTE}), 6) AS average_flight_length_km
FROM active_f a LEFT JOIN continents c ON a.origin_airport_country_name = c.country GROUP BY 1""",
    "top3_models_by_airline_country": FC + """SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY airline_country_name ORDER BY total_aircraft_model DESC,
    aircraft_model ASC NULLS LAST) AS INTEGER) AS model_rank FROM (
    SELECT d.airline_country_name, aircraft_model, count(aircraft_model) AS total_aircraft_model
    FROM current_f f LEFT JOIN (SELECT s_name AS airline_name, min(n_name) AS airline_country_name
      FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey GROUP BY 1) d
    ON f.airline_name = d.airline_name GROUP BY 1, 2))
WHERE model_rank <= 3""",
    "flown_distance": FA + "SELECT id, round(" + hav(
        "TRY_CAST(origin_airport_latitude AS DOUBLE)", "TRY_CAST(origin_airport_longitude AS DOUBLE)",
        "TRY_CAST(latitude AS DOUBLE)", "TRY_CAST(longitude AS DOUBLE)") + ", 6) AS flown_km FROM active_f",
    "flown_time": w(FLIGHTS, CLEAN, SILVER.replace("FROM flights", "FROM clean"), CURRENT, ACTIVE)
                  + f"SELECT id, CASE WHEN CAST(split_part(id, '-', 2) AS INTEGER) NOT IN (6, 7) THEN {epoch('extract_ts')} "
                  f"- ({epoch('scheduled_time_arrival')} - historical_flighttime) END AS flown_seconds FROM active_f",
    "trail_distance": f"""SELECT user_id, count(*) AS n_points, round(coalesce(sum({TRAIL}), 0.0), 6) AS trail_km
FROM (SELECT user_id, lat, lng,
        lag(lat) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p_lat,
        lag(lng) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p_lng
      FROM (SELECT user_id, ts, event_id, CAST((event_id * 7) % 120 - 60 AS DOUBLE) AS lat,
                   CAST((event_id * 37) % 360 - 180 AS DOUBLE) AS lng FROM events))
GROUP BY user_id""",
    # SCD2
    "scd2_first_load": """SELECT * EXCLUDE (rn), TRUE AS is_current, ts AS effective_time,
  CAST(NULL AS TIMESTAMP) AS end_time FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM events) WHERE rn = 1""",
    "scd2_merge_dirty": SCD_DIRTY,
    "scd2_stored_dirty": SCD_DIRTY,
    "scd2_stored_current": _scd_sql(False, only_current=True),
    "scd2_merge": _scd_sql(False),
    "scd2_merge_nullsafe": _scd_sql(True),
    "scd2_stored_merge": _scd_sql(False),
    "scd2_current_view": _scd_sql(False, only_current=True),
    "scd2_history": w(HISTORY) + "SELECT * FROM hist",
    "scd2_as_of": w(HISTORY) + "SELECT * FROM hist WHERE effective_time <= TIMESTAMP '2024-01-15 12:00:00' "
                  "AND (end_time IS NULL OR end_time > TIMESTAMP '2024-01-15 12:00:00')",
    # streaming
    "stream_scd2_merge": _scd_sql(False),
    "stream_active_flights": w(FLIGHTS, _silver(FIRST_POLL), POLLS, LAST_SEEN) + """
SELECT airline_name, airline_iata, count(*) AS total_active_flights FROM last_seen
WHERE TRY_CAST(on_ground AS INTEGER) = 0 AND NOT contains(status_text, 'Landed')
  AND (coalesce(estimated_arrival, scheduled_time_arrival) IS NULL
       OR coalesce(estimated_arrival, scheduled_time_arrival) >= (SELECT max(extract_ts) FROM polls))
GROUP BY airline_name, airline_iata""",
    "marts_from_changes": MARTS_SQL,
    "scd2_splice": w(HISTORY) + "SELECT * FROM hist",
    "stream_active_counts": "SELECT date_trunc('day', ts) AS window_start, "
                            "date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n "
                            "FROM events GROUP BY 1, 2, 3",
}
ORACLE["detail_to_silver"] = ORACLE["clean_to_silver"]
for _name in ("top_regional_airline", "avg_distance"):
    ORACLE[f"{_name}_by_zone"] = ORACLE[f"{_name}_by_continent"].replace(CONTINENTS, ZONED)
ORACLE["latest_marts"] = " UNION ALL ".join(
    f"SELECT '{mart}' AS mart, '1998_01_01' AS extract_day, count(*) AS n_rows FROM ({ORACLE[query]}) HAVING count(*) > 0" for mart, query in (
        ("current_flight_by_airline", "airline_active_counts"), ("regional_flight", "regional_by_country_airline"),
        ("longest_flight_by_time", "longest_by_time"), ("longest_flight_by_distance", "longest_by_distance"),
        ("avg_distance_by_country", "avg_distance_by_country"), ("aircraft_company_flight", "manufacturer_counts"),
        ("aircraft_model_by_country", "models_by_country"), ("in_out_flight", "airport_in_out")))
