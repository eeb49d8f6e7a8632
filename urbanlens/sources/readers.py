"""Readers for edge formats: positional CSV eras, ragged turnstile text,
nested station feeds, link manifests and URL catalogs.

CSV is read as text columns first and typed with ``try_cast``, so dirty
fields become null instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from urbanlens.functions import timeparts as T
from urbanlens.functions.strings import strip_quotes, strip_ws
from urbanlens.operators.clean import cast_by_schema

DEFAULT_NULL_TOKENS = ("NA", "\\N", "", "NaN", "nan", "NULL", "null", "N/A")


def read_csv_positional(spark: SparkSession, paths, columns: list[str], types: dict[str, str],
                        null_tokens=DEFAULT_NULL_TOKENS, drop=("junk1", "junk2"),
                        ts_formats=("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss")) -> DataFrame:
    """``read_csv(header=0, names=columns, dtype=types, na_values=...)``.

    The header line of each file is skipped and replaced by ``columns``
    (positional). Rows with fewer fields get nulls; extra trailing fields
    beyond ``columns`` are dropped; ``drop`` removes absorbing junk columns.
    """
    schema = Ty.StructType([Ty.StructField(c, Ty.StringType()) for c in columns])
    df = (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
          .option("mode", "PERMISSIVE").option("nullValue", null_tokens[0]).csv(paths))
    df = df.select(*[F.when(F.col(c).isin(*null_tokens), F.lit(None)).otherwise(F.col(c)).alias(c) for c in columns])
    ts_cols = [c for c, t in types.items() if t in ("timestamp", "timestamp_ntz")]
    df = df.select(*[T.parse_datetime_flexible(F.col(c), ts_formats).alias(c) if c in ts_cols else F.col(c)
                     for c in df.columns])
    df = cast_by_schema(df, {c: t for c, t in types.items() if c not in ts_cols})
    return df.drop(*[c for c in drop if c in df.columns])


def _nstruct(**fields) -> "F.Column":
    """Struct with explicit field names (aliases are dropped inside lambdas)."""
    args = []
    for k, v in fields.items():
        args += [F.lit(k), v]
    return F.named_struct(*args)


# The header line of the newer turnstile files, skipped when
# parsing, and the canonical reading columns.
TURNSTILE_HEADER = "C/A,UNIT,SCP,STATION,LINENAME,DIVISION,DATE,TIME,DESC,ENTRIES,EXITS"
TURNSTILE_COLUMNS = ["ca", "unit", "scp", "station", "linename", "division", "endtime", "description",
                     "cumul_entries", "cumul_exits"]


def parse_turnstile(lines: DataFrame, value: str = "value", carry: tuple = ()) -> tuple[DataFrame, DataFrame]:
    """Parse ragged turnstile text into readings; returns (rows, quarantine).

    * blank lines and the header are skipped;
    * 11 fields: one reading with station, line name and division;
    * 3 + 5k fields: k readings sharing the 3 ids, the other ids null;
    * any other width, or any reading with an unparseable time or count,
      sends the whole line to quarantine as (line, reason).
    """
    keep = [F.col(c) for c in carry]
    p, ok = _parsed_turnstile(lines, value, keep)
    # One generator instead of filter + explode: a filter on ``ok`` would be
    # pushed below the projection and evaluate the parse a second time.
    good = p.select(*keep, F.inline(F.when(ok, F.col("r")))).select(*TURNSTILE_COLUMNS, *carry)
    p = p.select(*keep, "line", "r", ok.alias("ok"))
    bad = p.where(F.col("r").isNull() | ~F.col("ok")).select(*keep, "line", _why_rejected().alias("reason"))
    return good, bad


def parse_turnstile_tagged(lines: DataFrame, value: str = "value") -> DataFrame:
    """``parse_turnstile`` as one frame, for a single pass over the lines: readings
    with a null ``line`` and ``reason``, rejected lines with null readings."""
    p, ok = _parsed_turnstile(lines, value, [])
    p = p.select("line", "r", F.coalesce(ok, F.lit(False)).alias("ok"))
    none = F.array(F.lit(None).cast(p.schema["r"].dataType.elementType))
    tagged = p.select(F.when(~F.col("ok"), F.col("line")).alias("line"), F.when(~F.col("ok"), _why_rejected()).alias("reason"),
                      F.explode(F.when(F.col("ok"), F.col("r")).otherwise(none)).alias("x"))
    return tagged.select("x.*", "line", "reason").select(*TURNSTILE_COLUMNS, "line", "reason")


def _why_rejected():
    return F.when(F.col("r").isNull(), F.lit("unknown layout")).otherwise(F.lit("bad value"))


def _parsed_turnstile(lines: DataFrame, value: str, keep: list):
    """Lines with the array of their readings (``r``, null for an unknown layout), and the test that all are whole.

    The work is staged in separate projections so that the split line and
    the split date of each reading are computed once (expressions inside
    array lambdas are not shared otherwise). No shuffle: a line is checked
    as a whole inside its own row before the readings are exploded.
    """
    a = lines.select(*keep, strip_ws(F.col(value)).alias("line"))
    a = a.where((F.col("line") != "") & (F.col("line") != TURNSTILE_HEADER))
    b = a.select(*keep, "line", F.split("line", ",", -1).alias("f"))
    f = F.col("f")
    n = F.size(f)
    null_s = F.lit(None).cast("string")
    new_fmt = F.array(_nstruct(ca=f[0], unit=f[1], scp=f[2], station=f[3], linename=f[4], division=f[5],
                               dt=F.concat_ws(" ", f[6], f[7]), description=f[8], entries=f[9], exits=f[10]))
    k = ((n - 3) / 5).cast("int")
    old_fmt = F.transform(F.sequence(F.lit(0), k - 1), lambda i: _nstruct(
        ca=f[0], unit=f[1], scp=f[2], station=null_s, linename=null_s, division=null_s,
        dt=F.concat_ws(" ", f[i * 5 + 3], f[i * 5 + 4]), description=f[i * 5 + 5],
        entries=f[i * 5 + 6], exits=f[i * 5 + 7]))
    raw = F.when(n == 11, new_fmt).when((n > 3) & (((n - 3) % 5) == 0), old_fmt)
    c = b.select(*keep, "line", raw.alias("raw"))
    # One split of each reading's date/time text, plus which layout it has.
    d = c.select(*keep, "line", F.transform("raw", lambda r: _nstruct(
        r=r, p=F.split(F.trim(r["dt"]), r"[-/:T ]+"),
        us=r["dt"].rlike(T._FORMAT_PATTERNS["MM/dd/yyyy HH:mm:ss"]),
        dash=r["dt"].rlike(T._FORMAT_PATTERNS["MM-dd-yy HH:mm:ss"]))).alias("raw"))

    def when_ts(x):
        p = x["p"]

        def part(i):
            return p[i].try_cast("int")
        us = F.try_make_timestamp_ntz(part(2), part(0), part(1), part(3), part(4), part(5))
        dash = F.try_make_timestamp_ntz(part(2) + F.lit(2000), part(0), part(1), part(3), part(4), part(5))
        return F.coalesce(F.when(x["us"], us), F.when(x["dash"], dash))

    typed = F.transform("raw", lambda x: _nstruct(
        ca=strip_quotes(x["r"]["ca"]), unit=strip_quotes(x["r"]["unit"]), scp=strip_quotes(x["r"]["scp"]),
        station=strip_quotes(x["r"]["station"]), linename=strip_quotes(x["r"]["linename"]),
        division=strip_quotes(x["r"]["division"]), endtime=when_ts(x),
        description=strip_quotes(x["r"]["description"]),
        cumul_entries=F.trim(x["r"]["entries"]).try_cast("bigint"),
        cumul_exits=F.trim(x["r"]["exits"]).try_cast("bigint")))
    p = d.select(*keep, "line", typed.alias("r"))
    ok = F.forall("r", lambda x: x["endtime"].isNotNull() & x["cumul_entries"].isNotNull()
                  & x["cumul_exits"].isNotNull())
    return p, ok


def read_station_feed(spark: SparkSession, path: str, keep=("id", "stationName", "latitude", "longitude"),
                      doc_fields=("executionTime",)) -> DataFrame:
    """Station feed documents: explode ``stationBeanList`` to rows, keep the
    listed fields (the other twelve are dropped) plus document-level fields."""
    docs = spark.read.json(path)
    s = docs.select(*doc_fields, F.explode("stationBeanList").alias("s")).select(*doc_fields, "s.*")
    return s.drop(*[c for c in s.columns if c not in keep and c not in doc_fields])


ANCHOR = r'<a\s+href="([^"]*)"[^>]*>([^<]*)</a>'


def extract_links(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """(key, href, text) for every anchor of every page."""
    a = pages.select(key, F.regexp_extract_all(F.col(html), F.lit(ANCHOR), 1).alias("h"),
                     F.regexp_extract_all(F.col(html), F.lit(ANCHOR), 2).alias("t"))
    return a.select(key, F.inline(F.arrays_zip(F.col("h").alias("href"), F.col("t").alias("text"))))


def link_manifest(pages: DataFrame, present: DataFrame, pattern: str = r"^.*day.*20..",
                  base_url: str = "http://example.org/developers/") -> DataFrame:
    """Dated download links not yet on disk.

    Link text must match ``pattern`` (anchored at the start, as ``re.match``);
    the date is parsed from ``Saturday, April 22, 2017`` text; the file name is
    the last path part of the link; files present plain or ``.gz`` (names in
    ``present.name``) are skipped by an anti join.
    """
    links = extract_links(pages).where(F.col("text").rlike(pattern))
    m = links.select(
        F.concat(F.lit(base_url), F.col("href")).alias("url"),
        F.element_at(F.split("href", "/"), -1).alias("file_name"),
        T.parse_long_date("text").alias("file_date"))
    have = present.select(F.regexp_replace("name", r"\.gz$", "").alias("file_name")).distinct()
    return m.join(have, "file_name", "left_anti")


MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def _two_digit_year(yy):
    """POSIX ``%y``: 69-99 are 1969-1999, 00-68 are 2000-2068."""
    return F.when(yy >= 69, yy + 1900).otherwise(yy + 2000)


def url_catalog(lines: DataFrame, value: str = "value") -> DataFrame:
    """(url, file_name, kind, year, month) from download URL lists."""
    u = F.trim(F.col(value))
    name = F.element_at(F.split(u, "/"), -1)
    taxi = r"^(yellow|green|fhv)_tripdata_(\d{4})-(\d{2})\.csv$"
    bike = r"^(\d{4})(\d{2})-citibike-tripdata\.zip$"
    uber = r"^uber-raw-data-([a-z]{3})(\d{2})\.csv$"
    months = F.array(*[F.lit(m) for m in MONTHS])
    df = lines.where(u != "").select(u.alias("url"), name.alias("file_name"))
    nm = F.col("file_name")
    kind = (F.when(nm.rlike(taxi), F.regexp_extract(nm, taxi, 1))
            .when(nm.rlike(bike), F.lit("citibike")).when(nm.rlike(uber), F.lit("uber")))
    year = (F.when(nm.rlike(taxi), F.regexp_extract(nm, taxi, 2))
            .when(nm.rlike(bike), F.regexp_extract(nm, bike, 1))
            .when(nm.rlike(uber), _two_digit_year(F.regexp_extract(nm, uber, 2).try_cast("int")))).try_cast("int")
    month = (F.when(nm.rlike(taxi), F.regexp_extract(nm, taxi, 3).try_cast("int"))
             .when(nm.rlike(bike), F.regexp_extract(nm, bike, 2).try_cast("int"))
             .when(nm.rlike(uber), F.array_position(months, F.regexp_extract(nm, uber, 1)).cast("int")))
    return df.select("url", "file_name", kind.alias("kind"), year.alias("year"), month.alias("month"))
