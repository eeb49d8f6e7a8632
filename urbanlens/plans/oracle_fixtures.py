"""DuckDB definitions of the fixture views, for the correctness oracle.

Each entry mirrors ``urbanlens.sources.fixtures`` term by term (same integer
arithmetic, same operation order for doubles). ``with_fixtures`` prepends the
views an oracle statement mentions as CTEs, since the oracle only sees the
driver's parquet tables.
"""

from __future__ import annotations

import re

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["trips"] = """
SELECT o_orderkey AS trip_id,
  o_orderdate + to_minutes((o_orderkey*37) % 1440) AS pickup_datetime,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + to_minutes((o_orderkey*37) % 1440 + 5 + o_orderkey % 55) END AS dropoff_datetime,
  CAST(-74.3 AS DOUBLE) + ((o_custkey*7919 + o_orderkey*31) % 6000) / 10000 AS pickup_longitude,
  CAST(40.45 AS DOUBLE) + ((o_orderkey*104729) % 5500) / 10000 AS pickup_latitude,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(-74.3 AS DOUBLE) + ((o_custkey*6151 + o_orderkey*31) % 6000) / 10000 END AS dropoff_longitude,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(40.45 AS DOUBLE) + ((o_orderkey*92821) % 5500) / 10000 END AS dropoff_latitude,
  CASE WHEN o_orderkey % 11 <> 0 THEN CAST(1 + (o_orderkey*7919) % 263 AS INTEGER) END AS pickup_taxizone_id,
  CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 5 <> 0 THEN CAST(1 + (o_custkey*104729 + o_orderkey*17) % 263 AS INTEGER) END AS dropoff_taxizone_id,
  CASE WHEN o_orderkey % 5 = 0 THEN 'uber' WHEN o_orderkey % 5 <= 2 THEN 'green' WHEN o_orderkey % 5 = 3 THEN 'yellow' END AS trip_type,
  o_totalprice / 1000 AS fare_amount,
  ((o_orderkey*13) % 250) / 10 AS trip_distance,
  CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 17 = 0 THEN '' ELSE CAST(1 + o_orderkey % 6 AS VARCHAR) END AS passenger_count
FROM orders"""

# Number of station ids and ids per lattice row, from the whole part table.
FIXTURE_SQL["lattice"] = """
SELECT CAST(max(p_partkey) + 1 AS BIGINT) AS n_ids, CAST(ceil(sqrt(max(p_partkey) + 1)) AS BIGINT) AS w FROM part"""

FIXTURE_SQL["bike_base"] = """
SELECT o_orderkey AS ride_id,
  CASE WHEN o_orderkey % 400 = 0 THEN n_ids - 7 + (o_orderkey // 400) % 7
       WHEN o_orderkey % 3 = 0 THEN o_custkey % (n_ids - 7) ELSE o_custkey % 64 END AS start_station_id,
  CASE WHEN o_orderkey % 401 = 0 THEN n_ids - 7 + (o_orderkey // 401) % 7
       WHEN o_orderkey % 3 = 1 THEN (o_orderkey*31) % (n_ids - 7) ELSE (o_orderkey*31) % 64 END AS end_station_id,
  o_orderdate + to_minutes((o_orderkey*53) % 1440) AS start_time,
  60 + (o_orderkey*17) % 3600 AS dur, o_orderkey AS k, w
FROM orders, lattice"""

_LAT = "CAST(40.52 AS DOUBLE) + ({i} % w) * (CAST(0.42 AS DOUBLE) / w)"
_LON = "CAST(-74.24 AS DOUBLE) + ({i} // w) * (CAST(0.48 AS DOUBLE) / w)"

FIXTURE_SQL["bike"] = f"""
SELECT ride_id, CAST(dur AS INTEGER) AS trip_duration, start_time,
  start_time + to_seconds(dur) AS stop_time,
  start_station_id,
  '"St ' || CAST(start_station_id AS VARCHAR) || '"' AS start_station_name,
  {_LAT.format(i="start_station_id")} + (k % 10) * CAST(0.00001 AS DOUBLE) AS start_station_latitude,
  {_LON.format(i="start_station_id")} + (k % 7) * CAST(0.00001 AS DOUBLE) AS start_station_longitude,
  end_station_id,
  '"St ' || CAST(end_station_id AS VARCHAR) || '"' AS end_station_name,
  {_LAT.format(i="end_station_id")} + (k % 10) * CAST(0.00001 AS DOUBLE) AS end_station_latitude,
  {_LON.format(i="end_station_id")} + (k % 7) * CAST(0.00001 AS DOUBLE) AS end_station_longitude,
  CASE WHEN k % 3 = 0 THEN 'Customer' ELSE 'Subscriber' END AS user_type
FROM bike_base"""

FIXTURE_SQL["stations"] = f"""
SELECT p_partkey AS id, 'St ' || CAST(p_partkey AS VARCHAR) AS stationName,
  {_LAT.format(i="p_partkey")} AS latitude, {_LON.format(i="p_partkey")} AS longitude
FROM part, lattice WHERE p_partkey % 4 <> 0"""

FIXTURE_SQL["turnstile"] = """
SELECT 'A' || CAST(user_id AS VARCHAR) AS ca, 'R' || CAST(user_id AS VARCHAR) AS unit, '00-00-01' AS scp,
  'ST' || CAST(user_id AS VARCHAR) AS station, 'NQR' AS linename, 'BMT' AS division,
  date_trunc('second', ts) AS endtime, 'REGULAR' AS description,
  CAST(sum(floor(value)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumul_entries,
  CAST(sum(floor(value / 2)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumul_exits,
  event_id, user_id
FROM events"""

FIXTURE_SQL["turnstile_bad"] = """
SELECT CASE WHEN event_id % 89 = 0 THEN head || 'BAD' || event_id WHEN event_id % 97 = 0 THEN head || '01-02-24,00:00:00,REGULAR,x' || event_id || ',5'
  WHEN event_id % 101 = 0 THEN head || '02-30-24,00:00:00,REGULAR,' || event_id || ',5'
  ELSE head || '01-02-24,00:00:00,REGULAR,1,2,01-02-24,25:00:00,REGULAR,' || event_id || ',5' END AS line,
  CASE WHEN event_id % 89 = 0 THEN 'unknown layout' ELSE 'bad value' END AS reason
FROM (SELECT event_id, 'A' || user_id || ',R' || user_id || ',00-00-09,' AS head FROM events
  WHERE event_id % 89 = 0 OR event_id % 97 = 0 OR event_id % 101 = 0 OR event_id % 103 = 0)"""

FIXTURE_SQL["zones"] = """
SELECT CAST(id + 1 AS INTEGER) AS LocationID, 'Zone ' || CAST(id + 1 AS VARCHAR) AS zone,
  ['EWR', 'Staten Island', 'Brooklyn', 'Manhattan', 'Queens'][CAST((id // 13) // 4 AS INTEGER) + 1] AS borough,
  id // 13 AS zi, id % 13 AS zj
FROM range(260) t(id)"""

# Node (i, j) of the zone lattice, same operation order as the Spark fixture.
_NX = "((CAST(-74.25 AS DOUBLE) + CAST(0.025 AS DOUBLE) * ({i})) + ((({i})*7 + ({j})*13) % 5 - 2) * CAST(0.002 AS DOUBLE))"
_NY = "((CAST(40.5 AS DOUBLE) + CAST(0.035 AS DOUBLE) * ({j})) + ((({i})*11 + ({j})*3) % 5 - 2) * CAST(0.003 AS DOUBLE))"
_CORNERS = ["zi, zj", "zi + 1, zj", "zi + 1, zj + 1", "zi, zj + 1", "zi, zj"]


def _corner(k: int, axis: str) -> str:
    i, j = [s.strip() for s in _CORNERS[k].split(",")]
    return (_NX if axis == "x" else _NY).format(i=i, j=j)


FIXTURE_SQL["zone_edges"] = "\nUNION ALL\n".join(
    f"SELECT LocationID, {k} AS k, {_corner(k, 'x')} AS x1, {_corner(k, 'y')} AS y1, "
    f"{_corner(k + 1, 'x')} AS x2, {_corner(k + 1, 'y')} AS y2 FROM zones"
    for k in range(4))

_BUMP = "(CASE WHEN {i} % 2 = 1 THEN CAST(0.0005 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)"


def _cut(axis: str, i: str) -> str:
    at = f"({axis}1 + ({axis}2 - {axis}1) * ({i}) / m + {_BUMP.format(i=f'({i})')})"
    return f"CASE WHEN {i} = m THEN {axis}2 ELSE {at} END"


FIXTURE_SQL["detail_edges"] = f"""
SELECT LocationID, k, {_cut('x', 'i')} AS x1, {_cut('y', 'i')} AS y1, {_cut('x', 'i + 1')} AS x2, {_cut('y', 'i + 1')} AS y2
FROM (SELECT *, unnest(range(0, m)) AS i FROM (SELECT *, CAST(pow(2, LocationID % 7) AS BIGINT) AS m FROM zone_edges))"""

FIXTURE_SQL["weather"] = """
SELECT strftime(d, '%Y%m%d') AS DATE,
  CASE WHEN n % 31 <> 0 THEN ((n*37) % 50) / 10 END AS PRCP,
  CAST(((n*11) % 20) / 2 AS DOUBLE) AS SNWD,
  CASE WHEN n % 29 <> 0 THEN ((n*7) % 9) / 4 END AS SNOW,
  CAST(40 + (n*13) % 50 AS DOUBLE) AS TMAX,
  CAST(25 + (n*17) % 40 AS DOUBLE) AS TMIN,
  ((n*19) % 60) / 5 AS AWND
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d,
        CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS n FROM orders)"""

FIXTURE_SQL["grid"] = """
SELECT CAST(event_id % 24 AS INTEGER) AS time,
  CAST(40.5 AS DOUBLE) + (cell // 10) * CAST(0.05 AS DOUBLE) AS lat,
  CAST(-74.25 AS DOUBLE) + (cell % 10) * CAST(0.05 AS DOUBLE) AS lon,
  ['T2M', 'PRECTOTCORR', 'SPEED'][CAST(event_id % 3 AS INTEGER) + 1] AS var,
  CASE WHEN event_id % 3 = 0 THEN CAST(268.0 AS DOUBLE) + value / 14 + cell / 100
       WHEN event_id % 3 = 1 THEN value / 100 + cell / 1000
       ELSE CAST(6.0 AS DOUBLE) + value / 25 + cell / 50 END AS value
FROM events, range(100) g(cell)"""

FIXTURE_SQL["html_links"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS page_id,
  '<li><a href="data/turnstile_' || strftime(d, '%y%m%d') || '.txt">' || strftime(d, '%A, %B %-d, %Y') || '</a></li>' AS html
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"""

FIXTURE_SQL["tracts"] = """
SELECT CAST(id + 1 AS INTEGER) AS LocationID, lpad(CAST(id + 1 AS VARCHAR), 4, '0') AS CTLabel,
  CAST((id // 7) // 2 + 1 AS VARCHAR) AS BoroCode, id // 7 AS zi, id % 7 AS zj
FROM range(70) t(id)"""

_TX = "((CAST(-74.25 AS DOUBLE) + CAST(0.05 AS DOUBLE) * ({i})) + ((({i})*5 + ({j})*3) % 5 - 2) * CAST(0.004 AS DOUBLE))"
_TY = "((CAST(40.5 AS DOUBLE) + CAST(0.07 AS DOUBLE) * ({j})) + ((({i})*3 + ({j})*7) % 5 - 2) * CAST(0.005 AS DOUBLE))"


def _tcorner(k: int, axis: str) -> str:
    i, j = [s.strip() for s in _CORNERS[k].split(",")]
    return (_TX if axis == "x" else _TY).format(i=i, j=j)


FIXTURE_SQL["tract_edges"] = "\nUNION ALL\n".join(
    f"SELECT LocationID, {k} AS k, {_tcorner(k, 'x')} AS x1, {_tcorner(k, 'y')} AS y1, "
    f"{_tcorner(k + 1, 'x')} AS x2, {_tcorner(k + 1, 'y')} AS y2 FROM tracts"
    for k in range(4))

# Dependencies between fixture views (emitted first).
_DEPS = {"bike": ["bike_base", "lattice"], "stations": ["lattice"], "zone_edges": ["zones"], "tract_edges": ["tracts"],
         "detail_edges": ["zones", "zone_edges"]}
_ORDER = ["trips", "lattice", "bike_base", "bike", "stations", "turnstile", "turnstile_bad", "zones", "zone_edges", "detail_edges", "tracts", "tract_edges",
          "weather", "grid", "html_links"]


def with_fixtures(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every fixture view it references."""
    body = sql.strip()
    wanted: set[str] = set()
    for name in FIXTURE_SQL:
        if name != "bike_base" and re.search(rf"\b{name}\b", body):
            wanted.add(name)
            wanted.update(_DEPS.get(name, []))
    if not wanted:
        return body
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in _ORDER if n in wanted)
    if head := re.match(r"(?is)^with\s+(recursive\s+)?", body):
        return f"WITH {(head.group(1) or '').strip()} {ctes},\n{body[head.end():]}"
    return f"WITH {ctes}\n{body}"
