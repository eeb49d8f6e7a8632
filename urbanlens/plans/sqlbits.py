"""Reusable DuckDB fragments for oracle statements."""

from __future__ import annotations


def pip_sql(points: str, key: str, lon: str, lat: str, edges: str = "zone_edges") -> str:
    """Subquery (key, zid): smallest zone whose polygon contains each point,
    by counting ray crossings over the zone edge table (odd = inside)."""
    return f"""(SELECT {key}, min(LocationID) AS zid FROM (
  SELECT p.{key} AS {key}, e.LocationID
  FROM {points} p JOIN {edges} e ON (e.y1 > p.{lat}) <> (e.y2 > p.{lat})
  WHERE p.{lon} < (e.x2 - e.x1) * (p.{lat} - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY p.{key}, e.LocationID HAVING count(*) % 2 = 1) GROUP BY {key})"""


def utc_from_local(ts: str, tz: str = "America/New_York") -> str:
    """Local wall time to UTC wall time, taking the first (daylight) offset in
    the autumn overlap as Spark's ``convert_timezone`` does."""
    u = f"timezone('UTC', timezone('{tz}', {ts}))"
    back = f"timezone('{tz}', timezone('UTC', {u} - INTERVAL 1 HOUR))"
    return f"(CASE WHEN {back} = {ts} THEN {u} - INTERVAL 1 HOUR ELSE {u} END)"


def floor_ts(ts: str, seconds: int) -> str:
    """Floor a TIMESTAMP to a multiple of ``seconds`` since the epoch."""
    return (f"make_timestamp(epoch_us({ts}) - (epoch_us({ts}) % {seconds * 1_000_000}))")


def bh_add_sql(t: str) -> str:
    """``t + BusinessHour(1)``, 09:00-17:00 Monday-Friday."""
    wd = f"((dayofweek({t}) + 6) % 7)"
    s = f"(epoch_us({t}) - epoch_us(date_trunc('day', {t}))) / 1000000.0"
    d0 = f"date_trunc('day', {t})"
    nb = f"({d0} + to_days(CASE {wd} WHEN 4 THEN 3 WHEN 5 THEN 2 ELSE 1 END))"
    return (f"(CASE WHEN {wd} < 5 AND {s} < 32400 THEN {d0} + INTERVAL 10 HOUR "
            f"WHEN {wd} < 5 AND {s} < 57600 THEN {t} + INTERVAL 1 HOUR "
            f"WHEN {wd} < 5 AND {s} < 61200 THEN {nb} + INTERVAL 9 HOUR + to_microseconds(CAST(({s} - 57600) * 1000000 AS BIGINT)) "
            f"ELSE {nb} + INTERVAL 10 HOUR END)")


def bh_sub_sql(t: str) -> str:
    """``t + BusinessHour(-1)``, 09:00-17:00 Monday-Friday."""
    wd = f"((dayofweek({t}) + 6) % 7)"
    s = f"(epoch_us({t}) - epoch_us(date_trunc('day', {t}))) / 1000000.0"
    d0 = f"date_trunc('day', {t})"
    pb = f"({d0} - to_days(CASE {wd} WHEN 0 THEN 3 WHEN 6 THEN 2 ELSE 1 END))"
    return (f"(CASE WHEN {wd} < 5 AND {s} > 61200 THEN {d0} + INTERVAL 16 HOUR "
            f"WHEN {wd} < 5 AND {s} > 36000 THEN {t} - INTERVAL 1 HOUR "
            f"WHEN {wd} < 5 AND {s} > 32400 THEN {pb} + INTERVAL 17 HOUR - to_microseconds(CAST((36000 - {s}) * 1000000 AS BIGINT)) "
            f"ELSE {pb} + INTERVAL 16 HOUR END)")


def hours_between(a: str, b: str) -> str:
    return f"((epoch_us({b}) - epoch_us({a})) / 3600000000.0)"


def pip_pairs_sql(points: str, key: str, lon: str, lat: str, mode: str, edges: str = "zone_edges") -> str:
    """Subquery (key, zid) of every (point, polygon) pair under ``within``
    (inside, boundary excluded) or ``intersects`` (inside or on boundary)."""
    inside = f"""(SELECT p.{key} AS {key}, e.LocationID AS zid FROM {points} p
  JOIN {edges} e ON (e.y1 > p.{lat}) <> (e.y2 > p.{lat})
  WHERE p.{lon} < (e.x2 - e.x1) * (p.{lat} - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY 1, 2 HAVING count(*) % 2 = 1)"""
    onb = f"""(SELECT DISTINCT p.{key} AS {key}, e.LocationID AS zid FROM {points} p JOIN {edges} e
  ON p.{lon} >= least(e.x1, e.x2) AND p.{lon} <= greatest(e.x1, e.x2)
 AND p.{lat} >= least(e.y1, e.y2) AND p.{lat} <= greatest(e.y1, e.y2)
  WHERE (e.x2 - e.x1) * (p.{lat} - e.y1) - (e.y2 - e.y1) * (p.{lon} - e.x1) = 0)"""
    if mode == "within":
        return f"(SELECT * FROM {inside} EXCEPT SELECT * FROM {onb})"
    return f"(SELECT * FROM {inside} UNION SELECT * FROM {onb})"
