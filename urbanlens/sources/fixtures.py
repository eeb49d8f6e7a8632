"""Domain views (trips, bike, stations, turnstile, ...) derived from the driver tables.

The arithmetic mirrors ``urbanlens.plans.oracle_fixtures`` term by term so the
DuckDB oracle sees the same rows. Integer ``%`` is only applied to
non-negative integers; decimal literals are doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.functions import timeparts as T
from urbanlens.sources.readers import TURNSTILE_HEADER
from urbanlens.sources.tables import read_table

# Fixed values of the fixture layout (FIXTURES.md part B).
ZONE_NX, ZONE_NY = 20, 13
ZONE_X0, ZONE_Y0 = -74.25, 40.5
ZONE_DX, ZONE_DY = 0.025, 0.035
BOROUGHS = ["EWR", "Staten Island", "Brooklyn", "Manhattan", "Queens"]


def _minutes(n, ts):
    return F.timestamp_add("MINUTE", n, ts)


def trips(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical taxi/ride-hail trips (all_trips schema subset)."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    uber = (k % 5) == 0
    pickup = _minutes((k * 37) % 1440, F.col("o_orderdate"))
    trip_type = (F.when(uber, "uber").when((k % 5) <= 2, "green")
                 .when((k % 5) == 3, "yellow"))
    return o.select(
        k.alias("trip_id"),
        pickup.alias("pickup_datetime"),
        F.when(~uber, _minutes((k * 37) % 1440 + 5 + k % 55, F.col("o_orderdate"))).alias("dropoff_datetime"),
        (F.lit(-74.3) + ((c * 7919 + k * 31) % 6000) / 10000).alias("pickup_longitude"),
        (F.lit(40.45) + ((k * 104729) % 5500) / 10000).alias("pickup_latitude"),
        F.when(~uber, F.lit(-74.3) + ((c * 6151 + k * 31) % 6000) / 10000).alias("dropoff_longitude"),
        F.when(~uber, F.lit(40.45) + ((k * 92821) % 5500) / 10000).alias("dropoff_latitude"),
        F.when((k % 11) != 0, (F.lit(1) + (k * 7919) % 263).cast("int")).alias("pickup_taxizone_id"),
        F.when(((k % 13) != 0) & ~uber, (F.lit(1) + (c * 104729 + k * 17) % 263).cast("int"))
        .alias("dropoff_taxizone_id"),
        trip_type.alias("trip_type"),
        (F.col("o_totalprice") / 1000).alias("fare_amount"),
        (((k * 13) % 250) / 10).alias("trip_distance"),
        F.when(uber | ((k % 17) == 0), F.lit("")).otherwise((F.lit(1) + k % 6).cast("string"))
        .alias("passenger_count"),
    )


# Corner and extent of the square lattice the stations stand on, in degrees.
STATION_LAT0, STATION_LON0 = 40.52, -74.24
STATION_DLAT, STATION_DLON = 0.42, 0.48


def _lattice(spark: SparkSession, sf: str):
    """(number of station ids, ids per lattice row), from the whole ``part`` table."""
    top = read_table(spark, sf, "part", ["p_partkey"]).agg((F.max("p_partkey") + 1).cast("bigint").alias("n"))
    return top.scalar(), top.select(F.ceil(F.sqrt("n")).cast("bigint")).scalar()


def _station_lat(i, w):
    return F.lit(STATION_LAT0) + (i % w) * (F.lit(STATION_DLAT) / w)


def _station_lon(i, w):
    return F.lit(STATION_LON0) + F.floor(i / w) * (F.lit(STATION_DLON) / w)


def bike(spark: SparkSession, sf: str) -> DataFrame:
    """Bike-share trips with raw quoted station names and jittered coordinates.

    Station ids run over all of ``part``: two trips in three use one of 64
    busy stations, the others any station, and the last seven ids are rare.
    """
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    n, w = _lattice(spark, sf)
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    sid = (F.when((k % 400) == 0, n - 7 + F.floor(k / 400) % 7)
           .when((k % 3) == 0, c % (n - 7)).otherwise(c % 64))
    eid = (F.when((k % 401) == 0, n - 7 + F.floor(k / 401) % 7)
           .when((k % 3) == 1, (k * 31) % (n - 7)).otherwise((k * 31) % 64))
    start = _minutes((k * 53) % 1440, F.col("o_orderdate"))
    dur = F.lit(60) + (k * 17) % 3600
    df = o.select(k.alias("ride_id"), sid.alias("start_station_id"), eid.alias("end_station_id"),
                  start.alias("start_time"), dur.alias("trip_duration"))
    s, e = F.col("start_station_id"), F.col("end_station_id")
    k = F.col("ride_id")
    return df.select(
        "ride_id",
        F.col("trip_duration").cast("int").alias("trip_duration"),
        "start_time",
        F.timestamp_add("SECOND", F.col("trip_duration"), F.col("start_time")).alias("stop_time"),
        "start_station_id",
        F.concat(F.lit('"St '), s.cast("string"), F.lit('"')).alias("start_station_name"),
        (_station_lat(s, w) + (k % 10) * F.lit(0.00001)).alias("start_station_latitude"),
        (_station_lon(s, w) + (k % 7) * F.lit(0.00001)).alias("start_station_longitude"),
        "end_station_id",
        F.concat(F.lit('"St '), e.cast("string"), F.lit('"')).alias("end_station_name"),
        (_station_lat(e, w) + (k % 10) * F.lit(0.00001)).alias("end_station_latitude"),
        (_station_lon(e, w) + (k % 7) * F.lit(0.00001)).alias("end_station_longitude"),
        F.when((k % 3) == 0, "Customer").otherwise("Subscriber").alias("user_type"),
    )


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """Current station list (authoritative feed), one per part key; ids divisible by 4 are gone."""
    p = read_table(spark, sf, "part", ["p_partkey"]).where((F.col("p_partkey") % 4) != 0)
    i, (_, w) = F.col("p_partkey"), _lattice(spark, sf)
    return p.select(
        i.alias("id"),
        F.concat(F.lit("St "), i.cast("string")).alias("stationName"),
        _station_lat(i, w).alias("latitude"),
        _station_lon(i, w).alias("longitude"),
    )


def turnstile_readings(spark: SparkSession, sf: str) -> DataFrame:
    """The turnstile readings without counters: one scan of the events, no shuffle."""
    e = read_table(spark, sf, "events", ["event_id", "ts", "user_id"])
    u = F.col("user_id").cast("string")
    return e.select(
        F.concat(F.lit("A"), u).alias("ca"), F.concat(F.lit("R"), u).alias("unit"), F.lit("00-00-01").alias("scp"),
        F.concat(F.lit("ST"), u).alias("station"), T.trunc_second("ts").alias("endtime"), "event_id")


def turnstile(spark: SparkSession, sf: str, with_rank: bool = False) -> DataFrame:
    """Subway turnstile readings with cumulative counters per turnstile.

    The counters are running sums per user in (ts, event_id) order, computed
    with ``running_sums`` (dense ids + fixed-size blocks), so a user holding
    a large share of the events is spread over many tasks. ``with_rank``
    adds ``rn``, the 0-based position of the reading within its turnstile.
    """
    from urbanlens.operators.windows import running_sums

    e = read_table(spark, sf, "events", ["event_id", "ts", "user_id", "value"])
    vals = {"cumul_entries": F.floor("value"), "cumul_exits": F.floor(F.col("value") / 2)}
    if with_rank:
        vals["rn"] = F.lit(1)
    r = running_sums(e, ["user_id"], ["ts", "event_id"], vals)
    u = F.col("user_id").cast("string")
    extra = [(F.col("rn") - 1).alias("rn")] if with_rank else []
    return r.select(
        F.concat(F.lit("A"), u).alias("ca"),
        F.concat(F.lit("R"), u).alias("unit"),
        F.lit("00-00-01").alias("scp"),
        F.concat(F.lit("ST"), u).alias("station"),
        F.lit("NQR").alias("linename"),
        F.lit("BMT").alias("division"),
        T.trunc_second("ts").alias("endtime"),
        F.lit("REGULAR").alias("description"),
        F.col("cumul_entries").cast("bigint").alias("cumul_entries"),
        F.col("cumul_exits").cast("bigint").alias("cumul_exits"),
        "event_id", "user_id", *extra,
    )


def turnstile_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Raw turnstile text (one ``value`` column) in the two historical layouts.

    Even users: 11-field lines. Odd users: ``ca,unit,scp`` then 5 fields per
    reading, three consecutive readings per line (grouped by ``rn div 3``).
    Plus a header, a blank line and ``turnstile_bad_lines``.
    """
    t = turnstile(spark, sf, with_rank=True)
    even = (F.col("user_id") % 2) == 0
    # One grouping pass for both layouts: an even user's group is one reading
    # (keyed by its event id), an odd user's group is three consecutive ones.
    grp = F.when(even, F.col("event_id")).otherwise(F.floor(F.col("rn") / 3))
    new_line = F.concat_ws(
        ",", "ca", "unit", "scp", "station", "linename", "division",
        T.format_ntz("endtime", "MM/dd/yyyy"), T.format_ntz("endtime", "HH:mm:ss"),
        "description", F.col("cumul_entries").cast("string"), F.col("cumul_exits").cast("string"))
    chunk = F.concat_ws(
        ",", T.format_ntz("endtime", "MM-dd-yy"), T.format_ntz("endtime", "HH:mm:ss"),
        "description", F.col("cumul_entries").cast("string"), F.col("cumul_exits").cast("string"))
    lines = (t.select("ca", "unit", "scp", "user_id", grp.alias("g"),
                      F.struct("rn", F.when(even, new_line).otherwise(chunk).alias("text")).alias("part"))
             .groupBy("ca", "unit", "scp", "user_id", "g")
             .agg(F.array_sort(F.collect_list("part")).alias("parts"))
             .select(F.when((F.col("user_id") % 2) == 0, F.col("parts")[0]["text"])
                     .otherwise(F.concat_ws(",", "ca", "unit", "scp",
                                            F.array_join(F.transform("parts", lambda p: p["text"]), ",")))
                     .alias("value")))
    junk = spark.createDataFrame([(TURNSTILE_HEADER,), ("",)], "value string")
    return lines.unionByName(junk).unionByName(turnstile_bad_lines(spark, sf))


def turnstile_bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that must be rejected, one in some 25 events: too few fields, a count
    that is no number, a date that does not exist, and a good reading beside a bad one."""
    e = read_table(spark, sf, "events", ["event_id", "user_id"])
    k, u, n = F.col("event_id"), F.col("user_id").cast("string"), F.col("event_id").cast("string")
    head = F.concat(F.lit("A"), u, F.lit(",R"), u, F.lit(",00-00-09,"))
    bad = (F.when(k % 89 == 0, F.concat(head, F.lit("BAD"), n))
           .when(k % 97 == 0, F.concat(head, F.lit("01-02-24,00:00:00,REGULAR,x"), n, F.lit(",5")))
           .when(k % 101 == 0, F.concat(head, F.lit("02-30-24,00:00:00,REGULAR,"), n, F.lit(",5")))
           .when(k % 103 == 0, F.concat(head, F.lit("01-02-24,00:00:00,REGULAR,1,2,01-02-24,25:00:00,REGULAR,"), n, F.lit(",5"))))
    return e.select(bad.alias("value")).where(F.col("value").isNotNull())


def _closed_quad(i, j, node):
    """Corners (i,j), (i+1,j), (i+1,j+1), (i,j+1), (i,j) as one small lambda
    (a literal array of five node expressions would be inlined many times)."""
    di = F.array(*[F.lit(v) for v in (0, 1, 1, 0, 0)])
    dj = F.array(*[F.lit(v) for v in (0, 0, 1, 1, 0)])
    return F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: node(i + di[k], j + dj[k]))


def zones(spark: SparkSession) -> DataFrame:
    """260 quadrilateral zones tiling the fixture area, rings closed.

    A polygon layer (the reference reads a shapefile); rows come from
    ``spark.range`` so nothing passes through the driver.
    """
    def node(i, j):
        x = (F.lit(ZONE_X0) + F.lit(ZONE_DX) * i) + (((i * 7 + j * 13) % 5) - 2) * F.lit(0.002)
        y = (F.lit(ZONE_Y0) + F.lit(ZONE_DY) * j) + (((i * 11 + j * 3) % 5) - 2) * F.lit(0.003)
        return F.named_struct(F.lit("x"), x, F.lit("y"), y)

    i = (F.col("id") / ZONE_NY).cast("bigint")
    j = F.col("id") % ZONE_NY
    ring = _closed_quad(i, j, node)
    boroughs = F.array(*[F.lit(b) for b in BOROUGHS])
    return spark.range(ZONE_NX * ZONE_NY).select(
        (F.col("id") + 1).cast("int").alias("LocationID"),
        F.concat(F.lit("Zone "), (F.col("id") + 1).cast("string")).alias("zone"),
        F.element_at(boroughs, (F.floor(i / 4) + 1).cast("int")).alias("borough"),
        F.array(ring).alias("rings"),
    )


#: How far every second corner of a detailed zone stands off its side, in degrees.
BUMP = 0.0005


def detailed_zones(spark: SparkSession) -> DataFrame:
    """The zones with every side cut into 1 to 64 parts (by zone id), every second corner set off: uneven detail."""
    parts = F.expr("shiftleft(1, LocationID % 7)")
    n = F.col("_parts")

    def side(ring, k):
        a, b = ring[k], ring[k + 1]
        bump = lambda i: F.when(i % 2 == 1, F.lit(BUMP)).otherwise(F.lit(0.0))
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
            (a["x"] + (b["x"] - a["x"]) * i / n + bump(i)).alias("x"), (a["y"] + (b["y"] - a["y"]) * i / n + bump(i)).alias("y")))

    def cut(ring):
        return F.concat(F.flatten(F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda k: side(ring, k))), F.array(ring[0]))

    z = zones(spark).select("LocationID", "rings", parts.alias("_parts"))
    return z.select("LocationID", F.transform("rings", cut).alias("rings"))


def zone_edges(spark: SparkSession) -> DataFrame:
    """(LocationID, k, x1, y1, x2, y2): one row per polygon edge."""
    from urbanlens.functions.geo import ring_edges

    z = zones(spark).select("LocationID", F.posexplode(ring_edges("rings")).alias("k", "e"))
    return z.select("LocationID", "k", "e.x1", "e.y1", "e.x2", "e.y2")


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Daily weather for every order date; a few nulls."""
    d = read_table(spark, sf, "orders", ["o_orderdate"]).select(F.to_date("o_orderdate").alias("d")).distinct()
    n = F.datediff(F.col("d"), F.lit("1995-01-01").cast("date"))
    return d.select(
        F.date_format("d", "yyyyMMdd").alias("DATE"),
        F.when(n % 31 != 0, ((n * 37) % 50) / 10).alias("PRCP"),
        (((n * 11) % 20) / 2).cast("double").alias("SNWD"),
        F.when(n % 29 != 0, ((n * 7) % 9) / 4).alias("SNOW"),
        (F.lit(40) + (n * 13) % 50).cast("double").alias("TMAX"),
        (F.lit(25) + (n * 17) % 40).cast("double").alias("TMIN"),
        (((n * 19) % 60) / 5).alias("AWND"),
    )


GRID_VARS = ["T2M", "PRECTOTCORR", "SPEED"]


def grid(spark: SparkSession, sf: str) -> DataFrame:
    """Long gridded weather table: (time, lat, lon, var, value), 100 cells per event."""
    e = read_table(spark, sf, "events", ["event_id", "value"])
    g = e.select("event_id", "value", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("cell"))
    var = F.element_at(F.array(*[F.lit(v) for v in GRID_VARS]), ((F.col("event_id") % 3) + 1).cast("int"))
    v = F.col("value")
    cell = F.col("cell")
    return g.select(
        (F.col("event_id") % 24).cast("int").alias("time"),
        (F.lit(40.5) + F.floor(cell / 10) * F.lit(0.05)).alias("lat"),
        (F.lit(-74.25) + (cell % 10) * F.lit(0.05)).alias("lon"),
        var.alias("var"),
        F.when(F.col("event_id") % 3 == 0, F.lit(268.0) + v / 14 + cell / 100)
        .when(F.col("event_id") % 3 == 1, v / 100 + cell / 1000)
        .otherwise(F.lit(6.0) + v / 25 + cell / 50).alias("value"),
    )


def html_links(spark: SparkSession, sf: str) -> DataFrame:
    """One anchor per order date, in the layout of the turnstile download page."""
    d = read_table(spark, sf, "orders", ["o_orderdate"]).select(F.to_date("o_orderdate").alias("d")).distinct()
    return d.select(
        F.date_format("d", "yyyyMMdd").cast("bigint").alias("page_id"),
        F.concat(F.lit('<li><a href="data/turnstile_'), F.date_format("d", "yyMMdd"), F.lit('.txt">'),
                 F.date_format("d", "EEEE, MMMM d, yyyy"), F.lit("</a></li>")).alias("html"),
    )


def url_catalog_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Download URL list, one per line, one per (kind, month) seen in orders."""
    d = (read_table(spark, sf, "orders", ["o_orderdate", "o_orderkey"])
         .select(T.format_ntz("o_orderdate", "yyyy-MM").alias("ym"),
                 F.element_at(F.array(F.lit("yellow"), F.lit("green"), F.lit("fhv"), F.lit("uber"), F.lit("citibike")),
                              ((F.col("o_orderkey") % 5) + 1).cast("int")).alias("kind"))
         .distinct())
    url = (F.when(F.col("kind") == "citibike",
                  F.concat(F.lit("https://example.org/tripdata/"), F.regexp_replace("ym", "-", ""),
                           F.lit("-citibike-tripdata.zip")))
           .when(F.col("kind") == "uber",
                 F.concat(F.lit("https://example.org/uber-tlc/uber-raw-data-"),
                          F.lower(F.date_format(F.to_date(F.concat(F.col("ym"), F.lit("-01"))), "MMM")),
                          F.substring("ym", 3, 2), F.lit(".csv")))
           .otherwise(F.concat(F.lit("https://example.org/trip+data/"), F.col("kind"), F.lit("_tripdata_"),
                               F.col("ym"), F.lit(".csv"))))
    return d.select(url.alias("value"))


def citibike(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical bike table: the raw feed with quotes stripped from station
    names, as the ingest step does."""
    from urbanlens.functions.strings import strip_quotes_all

    return strip_quotes_all(bike(spark, sf))


# Second polygon layer (census-tract stand-in): a coarser jittered lattice.
TRACT_NX, TRACT_NY = 10, 7
TRACT_DX, TRACT_DY = 0.05, 0.07


def tracts(spark: SparkSession) -> DataFrame:
    """70 quadrilateral tracts over the same area as ``zones`` (another tiling)."""
    def node(i, j):
        x = (F.lit(ZONE_X0) + F.lit(TRACT_DX) * i) + (((i * 5 + j * 3) % 5) - 2) * F.lit(0.004)
        y = (F.lit(ZONE_Y0) + F.lit(TRACT_DY) * j) + (((i * 3 + j * 7) % 5) - 2) * F.lit(0.005)
        return F.named_struct(F.lit("x"), x, F.lit("y"), y)

    i = (F.col("id") / TRACT_NY).cast("bigint")
    j = F.col("id") % TRACT_NY
    ring = _closed_quad(i, j, node)
    return spark.range(TRACT_NX * TRACT_NY).select(
        (F.col("id") + 1).cast("int").alias("LocationID"),
        F.format_string("%04d", F.col("id") + 1).alias("CTLabel"),
        (F.floor(i / 2) + 1).cast("string").alias("BoroCode"),
        F.array(ring).alias("rings"),
    )
