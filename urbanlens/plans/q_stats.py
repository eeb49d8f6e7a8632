"""Section 2.10: statistics and ML over tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanlens.functions import geo as G
from urbanlens.functions import timeparts as T
from urbanlens.operators import clusters as CL
from urbanlens.operators import regression as RG
from urbanlens.operators import stats as ST
from urbanlens.plans.registry import query
from urbanlens.session import reliable_checkpoint
from urbanlens.sources import fixtures as fx

SEC = "2.10"

WEATHER_COLS = ["PRCP", "SNWD", "SNOW", "TMAX", "TMIN", "AWND"]


def _daily(spark, sf):
    """Bike trips per day left-joined to the weather of that day."""
    b = fx.bike(spark, sf)
    days = b.groupBy(T.trunc_day("start_time").alias("day")).agg(F.count("trip_duration").alias("N"))
    w = fx.weather(spark, sf).select(T.parse_date_compact("DATE").alias("d"), *WEATHER_COLS)
    w = w.select(F.col("d").cast("timestamp_ntz").alias("day"), *WEATHER_COLS)
    return days.join(w, "day", "left")


_DAILY_SQL = """m AS (SELECT c.day, c.N, w.PRCP, w.SNWD, w.SNOW, w.TMAX, w.TMIN, w.AWND
  FROM (SELECT date_trunc('day', start_time) AS day, count(trip_duration) AS N FROM bike GROUP BY 1) c
  LEFT JOIN weather w ON c.day = CAST(strptime(w.DATE, '%Y%m%d') AS TIMESTAMP))"""


@query("daily_weather_join", section=SEC, sql=f"WITH {_DAILY_SQL} SELECT * FROM m")
def daily_weather_join(spark, sf):
    return _daily(spark, sf)


@query("standardize_columns", section=SEC, sql=f"""
WITH {_DAILY_SQL}, s AS (SELECT avg(PRCP) AS mp, stddev_pop(PRCP) AS sp, avg(TMAX) AS mt, stddev_pop(TMAX) AS st,
  avg(SNOW) AS ms, stddev_pop(SNOW) AS ss FROM m)
SELECT day, N, round((PRCP - mp) / sp, 9) AS st_PRCP, round((TMAX - mt) / st, 9) AS st_TMAX,
  round((SNOW - ms) / ss, 9) AS st_SNOW FROM m, s""")
def standardize_columns(spark, sf):
    """``st(x)``: centre and divide by the population standard deviation."""
    m = ST.standardize(_daily(spark, sf), ["PRCP", "TMAX", "SNOW"], suffix="_st")
    return m.select("day", "N", F.round("PRCP_st", 9).alias("st_PRCP"), F.round("TMAX_st", 9).alias("st_TMAX"),
                    F.round("SNOW_st", 9).alias("st_SNOW"))


_FEATURES = ["PRCP", "SNWD", "SNOW", "TMAX", "TMIN"]


def _ols_sql() -> str:
    """Sums of products, Gauss-Jordan elimination over rows kept as lists, and Student's t as a finite series."""
    terms = ["1.0::DOUBLE", *[f"x{i}" for i in range(len(_FEATURES))]]
    k = len(terms)
    rows = ", ".join("[" + ", ".join([f"sum({a} * {b})" for b in terms] + [f"sum({a} * y)"]
                                     + ["1.0::DOUBLE" if i == j else "0.0::DOUBLE" for j in range(k)]) + "]" for i, a in enumerate(terms))
    xy = ", ".join(f"sum({a} * y)" for a in terms)
    return f"""
WITH RECURSIVE {_DAILY_SQL},
d AS (SELECT CAST(N AS DOUBLE) AS y, {', '.join(_FEATURES)} FROM m WHERE N IS NOT NULL AND {' AND '.join(f'{f} IS NOT NULL' for f in _FEATURES)}),
s AS (SELECT {', '.join(f'avg({f}) AS a{i}, stddev_pop({f}) AS s{i}' for i, f in enumerate(_FEATURES))} FROM d),
z AS (SELECT y, {', '.join(f'({f} - a{i}) / s{i} AS x{i}' for i, f in enumerate(_FEATURES))} FROM d, s),
g AS (SELECT [{rows}] AS a, [{xy}] AS xy, count(*) AS n, sum(y * y) AS yy, sum(y) AS sy FROM z),
e AS (SELECT 0 AS k, a FROM g UNION ALL SELECT k + 1, list_transform(a, lambda r, i: CASE WHEN i = k + 1
    THEN list_transform(r, lambda v, j: v / a[k + 1][k + 1])
    ELSE list_transform(r, lambda v, j: v - r[k + 1] * a[k + 1][j] / a[k + 1][k + 1]) END) FROM e WHERE k < {k}),
b AS (SELECT e.a, n, yy - list_sum(list_transform(range(1, {k + 1}), lambda i: e.a[i][{k + 1}] * xy[i])) AS rss, yy - sy * sy / n AS tss
  FROM e, g WHERE k = {k}),
t AS (SELECT i, a[i][{k + 1}] AS coef, sqrt(rss / (n - {k}) * a[i][{k + 1} + i]) AS err, 1 - rss / tss AS r2, n, n - {k} AS v
  FROM b, (SELECT unnest(range(1, {k + 1})) AS i)),
h AS (SELECT *, atan(abs(coef / err) / sqrt(v)) AS th FROM t),
w AS (SELECT i, sum(p) AS total FROM (SELECT i, exp(sum(2 * ln(cos(th)) + CASE WHEN v % 2 = 0 THEN ln((2 * j - 1) / (2 * j)) ELSE ln(2 * j / (2 * j + 1)) END)
    OVER (PARTITION BY i ORDER BY j)) AS p FROM (SELECT *, unnest(range(1, CASE WHEN v % 2 = 0 THEN v // 2 ELSE (v - 1) // 2 END)) AS j FROM h)) GROUP BY i)
SELECT ['Intercept', {', '.join(f"'{f}_st'" for f in _FEATURES)}][i] AS term, round(coef, 9) AS coef, round(err, 9) AS std_err,
  round(coef / err, 9) AS t_value, round(1 - CASE WHEN v % 2 = 0 THEN sin(th) * (1 + coalesce(total, 0))
    ELSE 2 / pi() * (th + sin(th) * cos(th) * (1 + coalesce(total, 0))) END, 9) AS p_value, round(r2, 9) AS r2, n
FROM h LEFT JOIN w USING (i)"""


@query("ols_weather", section=SEC, sql=_ols_sql())
def ols_weather(spark, sf):
    """Coefficient table of ``N ~ st(PRCP) + st(SNWD) + st(SNOW) + st(TMAX) + st(TMIN)``."""
    d = ST.standardize(_daily(spark, sf).dropna(subset=["N", *_FEATURES]), _FEATURES, suffix="_st")
    fitted = RG.ols(d, "N", [f"{f}_st" for f in _FEATURES])
    return fitted.select("term", *[F.round(c, 9).alias(c) for c in ("coef", "std_err", "t_value", "p_value", "r2")], "n")


CLUSTERS, CLUSTER_SEED, CLUSTER_ROUNDS = 45, 43, 20

_KMEANS_SQL = f"""
s AS (SELECT LocationID, sum(x1 * y2 - x2 * y1) AS a2, sum((x1 + x2) * (x1 * y2 - x2 * y1)) AS cx,
  sum((y1 + y2) * (x1 * y2 - x2 * y1)) AS cy FROM zone_edges GROUP BY LocationID),
pts AS (SELECT LocationID, CAST(floor((cx / (3.0 * a2) + 180.0) * 1000000.0::DOUBLE + 0.5) AS BIGINT) AS x,
  CAST(floor((cy / (3.0 * a2) + 90.0) * 1000000.0::DOUBLE + 0.5) AS BIGINT) AS y
  FROM s WHERE LocationID IN (SELECT pickup_taxizone_id FROM trips)),
c AS (SELECT 0 AS r, CAST(row_number() OVER (ORDER BY md5('{CLUSTER_SEED}:' || LocationID), LocationID) - 1 AS INT) AS label, x, y
    FROM (SELECT * FROM pts ORDER BY md5('{CLUSTER_SEED}:' || LocationID), LocationID LIMIT {CLUSTERS})
  UNION ALL SELECT c.r + 1, c.label, coalesce(n.x, c.x), coalesce(n.y, c.y) FROM c LEFT JOIN (
    SELECT label, CAST((2 * sum(x) + count(*)) // (2 * count(*)) AS BIGINT) AS x, CAST((2 * sum(y) + count(*)) // (2 * count(*)) AS BIGINT) AS y
    FROM (SELECT p.x, p.y, arg_min(label, CAST((p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y) AS HUGEINT) * 1024 + label) AS label
      FROM pts p, c GROUP BY p.LocationID, p.x, p.y) GROUP BY label) n ON c.label = n.label WHERE c.r < {CLUSTER_ROUNDS}),
f AS (SELECT label, x, y FROM c WHERE r = {CLUSTER_ROUNDS})"""


def _nearest_sql(points: str, key: str) -> str:
    return f"""SELECT {key}, arg_min(label, CAST((p.x - f.x) * (p.x - f.x) + (p.y - f.y) * (p.y - f.y) AS HUGEINT) * 1024 + label) AS label
FROM {points} p, f GROUP BY {key}"""


def zone_clusters(spark, sf, k: int = CLUSTERS, seed: int = CLUSTER_SEED, rounds: int = CLUSTER_ROUNDS):
    """The zones that the trips use as points (LocationID, x, y), and the centres of their clusters."""
    used = fx.trips(spark, sf).select(F.col("pickup_taxizone_id").alias("LocationID"))
    z = fx.zones(spark).join(used, "LocationID", "left_semi")
    cent = z.select("LocationID", G.polygon_centroid("rings").alias("c"))
    x, y = CL.whole_degrees(F.col("c.x"), F.col("c.y"))
    # Read once a round.
    points = reliable_checkpoint(cent.select("LocationID", x.alias("x"), y.alias("y")))
    return points, CL.fit(points, "LocationID", k, seed, rounds)


@query("kmeans_zones", section=SEC, sql=f"WITH RECURSIVE {_KMEANS_SQL} {_nearest_sql('pts', 'LocationID')}")
def kmeans_zones(spark, sf):
    """Each zone's cluster: k-means on the zone centroids."""
    points, centers = zone_clusters(spark, sf)
    return points.select("LocationID", CL.nearest(F.col("x"), F.col("y"), centers).alias("label"))


@query("kmeans_trips", section=SEC, sql=f"""
WITH RECURSIVE {_KMEANS_SQL},
u AS (SELECT trip_id, CAST(floor((pickup_longitude + 180.0) * 1000000.0::DOUBLE + 0.5) AS BIGINT) AS x,
  CAST(floor((pickup_latitude + 90.0) * 1000000.0::DOUBLE + 0.5) AS BIGINT) AS y FROM trips),
q AS ({_nearest_sql('u', 'trip_id')}), z AS ({_nearest_sql('pts', 'LocationID')})
SELECT t.trip_id, q.label AS pickup_point_cluster, a.label AS pickup_cluster_id, b.label AS dropoff_cluster_id
FROM trips t JOIN q ON t.trip_id = q.trip_id LEFT JOIN z a ON t.pickup_taxizone_id = a.LocationID LEFT JOIN z b ON t.dropoff_taxizone_id = b.LocationID""")
def kmeans_trips(spark, sf):
    """Every trip with the cluster nearest to its pickup point, and the clusters of its two zones."""
    points, centers = zone_clusters(spark, sf)
    # Bounded: one row per zone.
    labels = F.broadcast(points.select("LocationID", CL.nearest(F.col("x"), F.col("y"), centers).alias("label")))
    x, y = CL.whole_degrees(F.col("pickup_longitude"), F.col("pickup_latitude"))
    t = fx.trips(spark, sf).select("trip_id", "pickup_taxizone_id", "dropoff_taxizone_id", x.alias("x"), y.alias("y"))
    t = t.select("trip_id", "pickup_taxizone_id", "dropoff_taxizone_id", CL.nearest(F.col("x"), F.col("y"), centers).alias("pickup_point_cluster"))
    for end in ("pickup", "dropoff"):
        side = labels.select(F.col("LocationID").alias(f"{end}_taxizone_id"), F.col("label").alias(f"{end}_cluster_id"))
        t = t.join(side, f"{end}_taxizone_id", "left")
    return t.select("trip_id", "pickup_point_cluster", "pickup_cluster_id", "dropoff_cluster_id")


@query("sample_fraction", section=SEC, sql="""
SELECT start_time, start_station_id, end_station_id FROM bike
WHERE substr(md5('42:' || CAST(ride_id AS VARCHAR)), 1, 8) < '19999999'""")
def sample_fraction(spark, sf):
    """``sample(frac=0.1, random_state=42)`` by a hash of the ride id."""
    return ST.sample_by_key(fx.bike(spark, sf), "ride_id", 0.1, 42).select("start_time", "start_station_id", "end_station_id")
