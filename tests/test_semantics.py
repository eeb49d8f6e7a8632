
from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from urbanlens.functions import geo as G
from urbanlens.functions import timeparts as T
from urbanlens.operators import aggregate as A
from urbanlens.operators import clean as C
from urbanlens.operators import spatial as SP
from urbanlens.operators import windows as W
from urbanlens.sources import readers as RD


def ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


# 1. ANSI: dirty text never throws; decimals go through double.
def test_try_cast_dirty_text(spark):
    df = spark.createDataFrame([("",), ("3",), (" 7 ",), ("1.0",), ("x",)], "pc string")
    out = [r.pc for r in C.cast_by_schema(df, {"pc": "int"}).collect()]
    assert out == [None, 3, 7, 1, None]


# 2. NaN is normalised to null.
def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,)], "x double")
    assert [r.x for r in C.nan_to_null(df).collect()] == [None, 1.5]


# 3. pandas groupby drops null keys and counts non-null cells; Spark keeps a null group.
def test_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "k int, v string")
    pd_like = {r.k: r.v for r in A.count_nonnull_by(df, ["k"]).collect()}
    assert pd_like == {1: 1}
    spark_like = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    assert spark_like == {1: 2, None: 1}


# 4. pandas != keeps nulls.
def test_not_equal_keeps_null(spark):
    df = spark.createDataFrame([("uber",), ("green",), (None,)], "t string")
    assert df.where(~F.col("t").eqNullSafe("uber")).count() == 2
    assert df.where(F.col("t") != "uber").count() == 1


# 5. Six-minute labels use a 24-hour clock.
def test_six_minute_label_24h(spark):
    assert one(spark, T.six_minute_label(ts("2015-01-01 17:42:10"))) == "2015-01-01 17:42:00"
    assert one(spark, T.six_minute_label(ts("2015-01-01 00:05:00"))) == "2015-01-01 00:00:00"
    assert one(spark, T.bin_minutes(ts("2015-01-01 17:47:59"), 6)) == dt.datetime(2015, 1, 1, 17, 42)


# 6. numpy weeks start on Thursday.
def test_week_starts_thursday(spark):
    assert one(spark, T.trunc_week_epoch(ts("2013-07-01 10:00:00"))) == dt.datetime(2013, 6, 27)
    assert one(spark, T.trunc_week_epoch(ts("2013-06-27 00:00:00"))) == dt.datetime(2013, 6, 27)


# 7. Business hours 09:00-17:00 Mon-Fri (pandas BusinessHour).
def test_business_hours(spark):
    cases = {
        # t: (t + BH(1), t + BH(-1))
        "2017-04-21 16:00:00": ("2017-04-24 09:00:00", "2017-04-21 15:00:00"),   # Fri 16:00
        "2017-04-21 17:00:00": ("2017-04-24 10:00:00", "2017-04-21 16:00:00"),   # Fri 17:00
        "2017-04-22 12:00:00": ("2017-04-24 10:00:00", "2017-04-21 16:00:00"),   # Sat noon
        "2017-04-24 09:30:00": ("2017-04-24 10:30:00", "2017-04-21 16:30:00"),   # Mon 09:30
        "2017-04-24 09:00:00": ("2017-04-24 10:00:00", "2017-04-21 16:00:00"),   # Mon 09:00
        "2017-04-24 08:00:00": ("2017-04-24 10:00:00", "2017-04-21 16:00:00"),   # before opening
        "2017-04-25 16:30:00": ("2017-04-26 09:30:00", "2017-04-25 15:30:00"),   # Tue 16:30
    }
    for t, (fwd, back) in cases.items():
        assert one(spark, T.add_business_hour(ts(t))) == dt.datetime.fromisoformat(fwd), t
        assert one(spark, T.subtract_business_hour(ts(t))) == dt.datetime.fromisoformat(back), t
    assert one(spark, T.business_hour_fwd(ts("2017-04-21 16:00:00"))) == 64.0
    assert one(spark, T.business_hour_back(ts("2017-04-24 09:30:00"))) == -65.0


def _square(spark, x0, y0, s, lid):
    ring = [(x0, y0), (x0 + s, y0), (x0 + s, y0 + s), (x0, y0 + s), (x0, y0)]
    return (lid, [[{"x": float(a), "y": float(b)} for a, b in ring]])


# 8. within excludes the boundary, intersects includes it, ray casting gives one zone on a tiling.
def test_zone_boundary_rules(spark):
    zones = spark.createDataFrame([_square(spark, 0.0, 0.0, 1.0, 1), _square(spark, 1.0, 0.0, 1.0, 2)],
                                  "LocationID int, rings array<array<struct<x:double,y:double>>>")
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.0, 0.5), (3, 1.0, 0.0), (4, 5.0, 5.0)], "pid int, x double, y double")
    within = {(r.pid, r.LocationID) for r in SP.spatial_join(pts, zones, "x", "y", "zid", "left", "within", 0.5)
              .select("pid", F.col("zid").alias("LocationID")).collect()}
    assert within == {(1, 1), (2, None), (3, None), (4, None)}
    inter = {(r.pid, r.zid) for r in SP.spatial_join(pts, zones, "x", "y", "zid", "inner", "intersects", 0.5).collect()}
    assert inter == {(1, 1), (2, 1), (2, 2), (3, 1), (3, 2)}
    ray = {r.pid: r.z for r in SP.lookup_zone(pts, zones, "x", "y", "z", 0.5).collect()}
    assert ray == {1: 1, 2: 2, 3: 2, 4: None}


# 9. Multi-matches keep the smallest id; 10. ids are LocationID values.
def test_first_match_is_min(spark):
    zones = spark.createDataFrame([_square(spark, 0.0, 0.0, 2.0, 7), _square(spark, 0.0, 0.0, 1.0, 3)],
                                  "LocationID int, rings array<array<struct<x:double,y:double>>>")
    pts = spark.createDataFrame([(1, 0.5, 0.5, None), (2, 1.5, 1.5, None), (3, 0.5, 0.5, 99), (4, None, None, None)],
                                "pid int, x double, y double, z int")
    out = {r.pid: r.z for r in SP.assign_zones(pts, zones, "x", "y", "z", 0.5).collect()}
    assert out == {1: 3, 2: 7, 3: 99, 4: None}


# 11. Turnstile text: both layouts, header/blank skipped, bad lines quarantined whole.
def test_turnstile_parse(spark):
    lines = [
        "C/A,UNIT,SCP,STATION,LINENAME,DIVISION,DATE,TIME,DESC,ENTRIES,EXITS",
        "",
        "A002,R051,02-00-00,59 ST,NQR456W,BMT,04/15/2017,00:00:00,REGULAR,0006140, 0002081 ",
        "A002,R051,02-00-00,04-17-10,00:00:00,REGULAR,002704717,000928793,04-17-10,04:00:00,REGULAR,002704723,000928795",
        "A002,R051,02-00-00,04-17-10,00:00:00,REGULAR,x,1",
        "A,B,C,D",
        '"A003",R052,01-00-00,"ST",L,IRT,02/30/2017,00:00:00,REGULAR,1,2',
    ]
    good, bad = RD.parse_turnstile(spark.createDataFrame([(v,) for v in lines], "value string"))
    rows = sorted(((r.ca, r.station, r.endtime, r.cumul_entries, r.cumul_exits) for r in good.collect()),
                  key=lambda t: t[2])
    assert rows == [
        ("A002", None, dt.datetime(2010, 4, 17, 0, 0), 2704717, 928793),
        ("A002", None, dt.datetime(2010, 4, 17, 4, 0), 2704723, 928795),
        ("A002", "59 ST", dt.datetime(2017, 4, 15), 6140, 2081),
    ]
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["bad value", "bad value", "unknown layout"]


# 12. Counter deltas are raw differences; negative values stay; first row dropped.
def test_counter_delta(spark):
    df = spark.createDataFrame(
        [("a", 1, 10), ("a", 2, 15), ("a", 3, 12), ("b", 1, 100), ("b", 2, 101)], "k string, t int, c bigint")
    out = sorted((r.k, r.t, r.c) for r in W.counter_delta(df, ["k"], ["t"], ["c"], bucket=F.col("t")).collect())
    assert out == [("a", 2, 5), ("a", 3, -3), ("b", 2, 1)]


# 13. Local time to UTC stays NTZ; spring gap and autumn overlap.
def test_local_to_utc(spark):
    assert one(spark, T.local_to_utc(ts("2015-03-08 02:30:00"))) == dt.datetime(2015, 3, 8, 7, 30)
    assert one(spark, T.local_to_utc(ts("2015-11-01 01:30:00"))) == dt.datetime(2015, 11, 1, 5, 30)
    assert one(spark, T.local_to_utc(ts("2015-07-01 12:00:00"))) == dt.datetime(2015, 7, 1, 16, 0)


# 17. Radius match is Euclidean in degrees and inclusive.
def test_radius_inclusive(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.00025)], "id int, lat double, lon double")
    b = spark.createDataFrame([(9, 0.0, 0.000225)], "sid int, la double, lo double")
    pairs = SP.radius_pairs(a, b, "lat", "lon", "la", "lo", 0.000225).select("id", "sid").collect()
    assert sorted((r.id, r.sid) for r in pairs) == [(1, 9), (2, 9)]


# 19. LCC inverse against a forward projection written from the same formulas.
def test_lcc_inverse_roundtrip(spark):
    e, n, big_f, rho0 = G._lcc_constants()

    def forward(lon, lat):
        phi = math.radians(lat)
        s = math.sin(phi)
        t = math.tan(math.pi / 4 - phi / 2) / ((1 - e * s) / (1 + e * s)) ** (e / 2)
        rho = G.LCC_A * big_f * t ** n
        th = n * math.radians(lon - G.LCC_LON0)
        return (rho * math.sin(th) / G.US_FOOT_M + G.LCC_FALSE_EASTING_FT,
                (rho0 - rho * math.cos(th)) / G.US_FOOT_M)

    pts = [(-74.25, 40.5), (-73.7, 40.91), (-73.98, 40.72)]
    rows = [forward(lo, la) for lo, la in pts]
    df = spark.createDataFrame(rows, "x double, y double").select(G.lcc_to_lonlat("x", "y").alias("p"))
    got = [(r.p.lon, r.p.lat) for r in df.collect()]
    for (lo, la), (glo, gla) in zip(pts, got):
        assert abs(lo - glo) < 1e-9 and abs(la - gla) < 1e-9
    origin = spark.range(1).select(G.lcc_to_lonlat(F.lit(984250.0), F.lit(0.0)).alias("p")).first().p
    assert abs(origin.lon + 74.0) < 1e-12 and abs(origin.lat - G.LCC_LAT0) < 1e-9


def test_parse_dates(spark):
    assert one(spark, T.parse_long_date(F.lit("Saturday, April 22, 2017"))) == dt.date(2017, 4, 22)
    assert one(spark, T.parse_date_compact(F.lit("20170422"))) == dt.date(2017, 4, 22)
    assert one(spark, T.parse_datetime_flexible(F.lit("13/45/2017 99:00:00"))) is None


# 13b. Results do not depend on the session time zone, even for wall times
# inside a DST gap of that zone.
def test_session_zone_independence(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = ts("2001-04-01 02:06:30.25")   # does not exist on New York clocks
        assert one(spark, T.epoch_micros(t)) == 986090790250000
        assert one(spark, T.bin_minutes(t, 6)) == dt.datetime(2001, 4, 1, 2, 6)
        assert one(spark, T.format_ntz(t, "yyyy-MM-dd HH:mm:ss")) == "2001-04-01 02:06:30"
        assert one(spark, T.six_minute_label(t)) == "2001-04-01 02:06:00"
        assert one(spark, T.weekday_name(t)) == "Sunday"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_format_ntz_patterns(spark):
    t = ts("2009-01-02 03:04:05.678")
    assert one(spark, T.format_ntz(t, "MM/dd/yyyy HH:mm:ss")) == "01/02/2009 03:04:05"
    assert one(spark, T.format_ntz(t, "MM-dd-yy")) == "01-02-09"
    assert one(spark, T.format_ntz(t, "yyyy-MM")) == "2009-01"
    assert one(spark, T.format_ntz(F.lit(None).cast("timestamp_ntz"), "yyyy")) is None
