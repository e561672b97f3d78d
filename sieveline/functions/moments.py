"""Moments written in many ways -> one moment in UTC: readers of the written forms as column expressions, and the as-of
join of parsed local times to zone-offset intervals.

The parsing stays in the JVM. A written form gives either a fixed moment (zone or offset given, or a number since 1970) or
a local time. Local times are looked up in the offset intervals of their zone: two matching intervals mean the time occurs
twice, none means that it is skipped, one gives the offset directly.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Years for which zone offsets are listed: from before any zone left its mean local time, to the end of a cycle of 28 years in
#: which the rules of every zone go on unchanged.
FIRST_YEAR, LAST_YEAR = 1800, 2128
#: Zones of countries that write the month before the day in 03/04/2025 (United States and territories, fixed values).
MONTH_FIRST_COUNTRIES = ("US", "PR", "GU", "VI", "AS", "MP", "UM")
#: Month names by their first letters after accents are removed (fixed values).
MONTHS = {
    1: "jan(?:uary|uar|vier|v)?|janner|enero|ene",
    2: "feb(?:ruary|ruar|rero)?|fevrier|fevr?|feber",
    3: "mar(?:ch|s|z|zo)?|maerz|mrz",
    4: "apr(?:il)?|avril|avr|abril|abr",
    5: "may|mai|mayo",
    6: "june?|juni|juin|junio",
    7: "july?|juli|juillet|juil|julio",
    8: "aug(?:ust)?|aout|agosto|ago",
    9: "sept?(?:ember|embre)?|septiembre|setiembre",
    10: "oct(?:ober|obre)?|okt(?:ober)?|octubre",
    11: "nov(?:ember|embre)?|noviembre",
    12: "dec(?:ember|embre)?|dez(?:ember)?|diciembre|dic",
}
_MONTH = "(" + "|".join(MONTHS.values()) + ")\\.?"
#: Characters of full width and of other dashes, spaces and accents (fixed values), folded before reading.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　    −‐‑"
_THIN = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + "     ---"
_ACCENTS, _PLAIN = "éèêûùüôöàâäçíó", "eeeuuuooaaacio"

_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?"
_ZONE = r"(?:\s*(z|utc|gmt|[+-]\d{2}:?\d{2}|[+-]\d{2}|[a-z]{2,5}))?"
_AMPM = r"(?:\s*([ap])\.?\s?m\.?)?"
_PARTS = ("kind", "y", "mo", "d", "h", "mi", "s", "f", "half", "zone")

#: (pattern over the folded lower-case text, what each group is); tried in order, anchored at both ends.
_DAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)"
FORMS: list[tuple[str, str]] = [
    # PDF: D:YYYYMMDDHHmmSS with optional parts and zone
    (r"d:(\d{4})(\d{2})?(\d{2})?(\d{2})?(\d{2})?(\d{2})?\s*(z(?:00'?00'?)?|[+-]\d{2}'?(?:\d{2})?'?)?", "y mo d h mi s zone"),
    # ISO week date
    (r"(\d{4})-?w(\d{2})-?(\d)(?:[t ]" + _TIME + _ZONE + ")?", "y w wd h mi s f zone"),
    # year first: ISO, dots, slashes
    (r"(\d{4})[-./](\d{1,2})[-./](\d{1,2})(?:(?:t|\s+)" + _TIME + _AMPM + _ZONE + ")?", "y mo d h mi s f half zone"),
    # Chinese and Japanese
    (r"(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*[日号]?(?:\s*(上午|下午|凌晨|早上|中午|晚上|午前|午後)?\s*(\d{1,2})\s*(?:[时時点:])\s*(?:(\d{1,2})\s*分?)?(?::?(\d{1,2})\s*秒?)?" + _ZONE + ")?", "y mo d half h mi s zone"),
    # day and month by the zone's country
    (r"(\d{1,2})/(\d{1,2})/(\d{4})(?:,?\s+(?:at\s+)?" + _TIME + _AMPM + _ZONE + ")?", "a b y h mi s f half zone"),
    # day first
    (r"(\d{1,2})[.-](\d{1,2})[.-](\d{4})(?:,?\s+(?:um\s+)?(\d{1,2})[:.](\d{2})(?::(\d{2}))?(?:\s*uhr)?" + _ZONE + ")?", "d mo y h mi s zone"),
    # RFC 2822 and other texts with the day before the month's name
    (_DAY + r"?(\d{1,2})(?:\.|er|st|nd|rd|th)?\s+(?:de\s+)?" + _MONTH + r",?\s+(?:de\s+)?(\d{4})(?:,?\s*(?:a|at|um|t)?\s*(\d{1,2})\s*[:.h]\s*(\d{2})(?:[:.](\d{2}))?(?:\s*uhr)?" + _AMPM + _ZONE + ")?", "d name y h mi s half zone"),
    # month's name first
    (_DAY + "?" + _MONTH + r"\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})(?:,?\s+(?:at\s+)?" + _TIME + _AMPM + _ZONE + ")?", "name d y h mi s f half zone"),
    # ctime
    (_DAY + _MONTH + r"\s+(\d{1,2})\s+(\d{1,2}):(\d{2}):(\d{2})(?:\s+([a-z]{2,5}))?\s+(\d{4})", "name d h mi s zone y"),
    # digits that form a date
    (r"((?:19|20)\d{2})(\d{2})(\d{2})(?:t?(\d{2})(\d{2})(\d{2})?" + _ZONE + ")?", "y mo d h mi s zone"),
]


def folded(text: Column) -> Column:
    """Ordinary width and spaces, no accents in month names, lower case."""
    seen = F.regexp_replace(text, "[​-‍⁠﻿­]", "")
    return F.trim(F.regexp_replace(F.translate(F.lower(F.translate(seen, _WIDE, _THIN)), _ACCENTS, _PLAIN), r"\s+", " "))


def _rewritten(text: Column) -> Column:
    """``=kind|y|mo|d|h|mi|s|f|half|zone`` for a readable text: each form's pattern reorders its own groups; a text that an
    earlier form has taken starts with ``=`` and matches no later one."""
    out = folded(text)
    for pattern, groups in FORMS:
        at = {name: f"${i + 1}" for i, name in enumerate(groups.split())}
        kind = "w" if "w" in at else "ab" if "a" in at else "n" if "name" in at else "pdf" if pattern.startswith("d:") else "ymd"
        month, day = {"w": ("w", "wd"), "ab": ("a", "b"), "n": ("name", "d")}.get(kind, ("mo", "d"))
        parts = [kind] + [at.get(k, "") for k in ("y", month, day, "h", "mi", "s", "f", "half", "zone")]
        out = F.regexp_replace(out, f"^{pattern}$", "=" + "|".join(parts))
    return out


def with_parsed(df: DataFrame, text: str, month_first: Column) -> DataFrame:
    """Adds __p, a struct<epoch_us, local_us, offset_s, abbr>: all null where the text denotes no moment.

    epoch_us is set for numbers since 1970. local_us is the written time taken as if it were UTC; offset_s is the written
    offset, abbr a written zone abbreviation (lower case). Each step is a projection of its own, so that no pattern runs twice.
    """
    def num(name: str) -> Column:
        return F.col("__a")[_PARTS.index(name)].try_cast("int")

    def part(name: str) -> Column:
        return F.col("__a")[_PARTS.index(name)]

    df = df.withColumn("__r", _rewritten(F.col(text))).withColumn("__d", folded(F.col(text)))
    df = df.withColumn("__a", F.when(F.col("__r").startswith("="), F.split(F.regexp_replace("__r", "^=", ""), "\\|", -1)))
    kind, y = part("kind"), num("y")
    mo = F.when(kind == "n", reduce(lambda acc, kv: F.when(part("mo").rlike(f"^(?:{kv[1]})$"), kv[0]).otherwise(acc), MONTHS.items(), F.lit(None).cast("int")))
    mo = mo.when((kind == "ab") & ~month_first, num("d")).when((kind == "pdf") & (part("mo") == ""), 1).otherwise(num("mo"))
    d = F.when((kind == "ab") & ~month_first, num("mo")).when((kind == "pdf") & (part("d") == ""), 1).otherwise(num("d"))
    df = df.withColumn("__k", kind).withColumn("__y", y).withColumn("__mo", mo).withColumn("__dd", d)
    monday = lambda year: F.date_sub(F.make_date(year, F.lit(1), F.lit(4)), F.weekday(F.make_date(year, F.lit(1), F.lit(4))))
    wy = F.greatest(F.lit(1), F.least(F.lit(9998), F.col("__y")))
    week = F.date_add(monday(wy), (F.col("__mo") - 1) * 7 + F.col("__dd") - 1)
    date = F.when(F.col("__k") == "w", F.when((F.col("__mo") >= 1) & F.col("__dd").between(1, 7) & (week < monday(wy + 1)), week)).otherwise(F.try_to_date(F.format_string("%04d-%02d-%02d", "__y", "__mo", "__dd"), "yyyy-MM-dd"))
    h, half = F.coalesce(num("h"), F.lit(0)), part("half")
    hour = (
        F.when(half.isin("p", "下午", "晚上", "午後") & (h < 12), h + 12)
        .when(half.isin("a", "上午", "凌晨", "午前") & (h == 12), 0)
        .when((half == "中午") & (h < 3), h + 12)
        .otherwise(h)
    )
    df = df.withColumn("__date", date).withColumn("__h", hour).withColumn("__z", F.regexp_replace(part("zone"), "[':]", ""))
    mi, s = F.coalesce(num("mi"), F.lit(0)), F.coalesce(num("s"), F.lit(0))
    micros = F.coalesce(F.rpad(F.substring(part("f"), 1, 6), 6, "0").try_cast("int"), F.lit(0))
    hour, zone = F.col("__h"), F.col("__z")
    sane = (mi < 60) & (s < 61) & ((hour < 24) | ((hour == 24) & (mi == 0) & (s == 0))) & ~(half.isin("a", "p") & ((h < 1) | (h > 12)))
    local = F.unix_date("__date").cast("bigint") * F.lit(86_400_000_000) + (hour * 3600 + mi * 60 + s).cast("bigint") * 1_000_000 + micros
    signed = zone.rlike(r"^[+-]\d")
    offset = F.when(zone.isin("z", "z0000", "utc", "gmt", "z00"), 0).when(
        signed, F.when(zone.startswith("-"), -1).otherwise(1) * (F.substring(zone, 2, 2).try_cast("int") * 3600 + F.coalesce(F.substring(zone, 4, 2).try_cast("int"), F.lit(0)) * 60)
    )
    abbr = F.when(zone.rlike("^[a-z]{2,5}$") & ~zone.isin("utc", "gmt"), zone)
    # bare digits: up to 10 places seconds, up to 15 milliseconds, up to 18 microseconds, with decimals; digits in the shape of a
    # date that does not exist are no number
    bare = lambda i: F.regexp_extract("__d", r"^(-?)(\d{1,18})(?:\.(\d+))?$", i)
    size = F.length(bare(2))
    scale = F.when(size <= 10, 1_000_000).when(size <= 15, 1000).otherwise(1).cast("bigint")
    finer = F.coalesce(F.rpad(F.substring(F.concat(bare(3), F.lit("000000")), 1, 6), 6, "0").try_cast("bigint"), F.lit(0).cast("bigint"))
    dated = F.col("__r").startswith("=") & size.isin(8, 14)
    df = df.withColumn("__l", F.when(sane, local))
    whole = bare(2).try_cast("bigint") * scale + F.floor(finer * scale / F.lit(1_000_000)).cast("bigint")
    epoch = F.when(F.col("__l").isNull() & (size > 0) & ~dated, F.when(bare(1) == "-", -whole).otherwise(whole))
    p = F.struct(epoch.alias("epoch_us"), F.col("__l").alias("local_us"), offset.cast("int").alias("offset_s"), abbr.alias("abbr"))
    return df.withColumn("__p", p).drop("__r", "__d", "__a", "__k", "__y", "__mo", "__dd", "__date", "__h", "__z", "__l")


def zone_intervals(zones: DataFrame, column: str = "tz_name") -> DataFrame:
    """One row for each zone of ``zones``: tz_name, month_first and its offset intervals, split by calendar year.

    Rows: tz_name, year, month_first, spans array<struct<lo, hi, offset_s, abbr>> in local microseconds, ordered by UTC. A
    span is listed under every local year it touches (and the neighbours of its edges). The number of zones is bounded by the
    time-zone database (about 600), and so is the table: at most 600 x 329 rows of a few spans each, whatever the input.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [r for name in pdf[column] for r in _spans(name)]
            yield pd.DataFrame(rows, columns=["tz_name", "year", "month_first", "spans"])

    schema = "tz_name string, year int, month_first boolean, spans array<struct<lo: bigint, hi: bigint, offset_s: int, abbr: string>>"
    return zones.select(column).where(F.col(column).isNotNull()).distinct().mapInPandas(run, schema)


def month_first_zones() -> set[str]:
    """Zones of the countries that write the month first, from the time-zone database's own country table."""
    text = ""
    try:
        from importlib.resources import files

        text = (files("tzdata") / "zoneinfo" / "zone.tab").read_text(encoding="utf-8")
    except (ImportError, FileNotFoundError, OSError):
        import zoneinfo

        for root in zoneinfo.TZPATH:
            try:
                with open(f"{root}/zone.tab", encoding="utf-8") as f:
                    text = f.read()
                break
            except OSError:
                continue
    found = {x.split("\t")[2].strip() for x in text.splitlines() if x[:2] in MONTH_FIRST_COUNTRIES and x.count("\t") >= 2}
    return found | {"America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles"} | {z for z in _us_links()}


def _us_links() -> tuple[str, ...]:
    return ("US/Eastern", "US/Central", "US/Mountain", "US/Pacific", "US/Alaska", "US/Hawaii", "US/Arizona", "EST5EDT", "CST6CDT", "MST7MDT", "PST8PDT")


def transitions(name: str) -> list[tuple[int, int, int, str]]:
    """(UTC second from, UTC second to, offset, abbreviation) of a zone, without gaps, open at both ends."""
    from zoneinfo import ZoneInfo

    zone, utc = ZoneInfo(name), dt.timezone.utc

    def at(sec: int) -> tuple[int, str]:
        x = dt.datetime.fromtimestamp(sec, utc).astimezone(zone)
        return int(x.utcoffset().total_seconds()), x.tzname() or ""

    lo = int(dt.datetime(FIRST_YEAR - 1, 1, 1, tzinfo=utc).timestamp())
    end = int(dt.datetime(LAST_YEAR + 1, 1, 1, tzinfo=utc).timestamp())
    out, start, here, sec = [], -(10**12), at(lo), lo
    while sec < end:
        nxt = min(sec + 7 * 86400, end)
        there = at(nxt)
        if there != here:
            a, b = sec, nxt
            while b - a > 1:
                m = (a + b) // 2
                a, b = (m, b) if at(m) == here else (a, m)
            out.append((start, b, *here))
            start, here, sec = b, at(b), b
        else:
            sec = nxt
    out.append((start, 10**12, *here))
    return out


def _spans(name: str) -> list[tuple]:
    try:
        spans = transitions(name)
    except Exception:  # not a zone of the database: no intervals, so no moment
        return []
    first, us = name in month_first_zones(), 1_000_000
    rows = []
    for year in range(FIRST_YEAR, LAST_YEAR + 1):
        lo = int(dt.datetime(year, 1, 1, tzinfo=dt.timezone.utc).timestamp()) - 2 * 86400
        hi = int(dt.datetime(year + 1, 1, 1, tzinfo=dt.timezone.utc).timestamp()) + 2 * 86400
        rows.append((name, year, first, [{"lo": (a + o) * us, "hi": (b + o) * us, "offset_s": o, "abbr": n.lower()} for a, b, o, n in spans if b + o > lo and a + o < hi]))
    return rows


def _alike(year: int) -> int:
    """The listed year of the last cycle that has the days of ``year``: leap day and days of the week."""
    kind = lambda y: (dt.date(y, 1, 1).weekday(), dt.date(y, 12, 31).weekday())
    return next(y for y in range(LAST_YEAR - 27, LAST_YEAR + 1) if kind(y) == kind(year))


def _listed(local_us: Column) -> tuple[Column, Column]:
    """(listed year, that time in it): itself inside the list; earlier times stand under the first year, whose first interval is
    open; later ones move to the year of the last cycle with the same days, as rules go by month and day of the week."""
    year = F.year(F.timestamp_micros(local_us))
    alike = F.element_at(F.array(*[F.lit(_alike(2400 + k)) for k in range(400)]), F.pmod(year, F.lit(400)) + 1)
    day = lambda y: F.unix_date(F.make_date(y, F.lit(1), F.lit(1))).cast("bigint")
    moved = local_us - (day(year) - day(alike)) * F.lit(86_400_000_000)
    return F.when(year > LAST_YEAR, alike).otherwise(F.greatest(year, F.lit(FIRST_YEAR))), F.when(year > LAST_YEAR, moved).otherwise(local_us)


def to_utc(df: DataFrame, text: str, zone: str | None, out: str = "utc_us", zones: DataFrame | None = None) -> DataFrame:
    """Adds ``out``: microseconds since 1970 in UTC of each written moment, null where it denotes none.

    ``zone`` names the column with the zone of local times; None, as for file metadata, means UTC. Without usable zone a local
    time has no moment. A time that occurs twice is its first occurrence; a skipped one moves forward by the skipped hour.
    Null, empty and unreadable texts give null; repeated rows each get theirs; other columns stay as they are.
    """
    if zone is None:
        return to_utc(df.withColumn("__utc", F.lit("UTC")), text, "__utc", out, df.sparkSession.createDataFrame([("UTC",)], "__utc string")).drop("__utc")
    table = zone_intervals(df if zones is None else zones, zone)
    per_zone = F.broadcast(table.select(F.col("tz_name").alias("__tz"), F.col("year").alias("__y"), F.col("month_first").alias("__mf"), F.col("spans").alias("__spans")))
    first = F.col(zone).isin(*sorted(month_first_zones()))
    p = with_parsed(df, text, F.coalesce(first, F.lit(False)))
    year, at = _listed(F.col("__p.local_us"))
    p = p.withColumn("__year", year).withColumn("__at", at)
    j = p.join(per_zone, (F.col(zone) == F.col("__tz")) & (F.col("__year") == F.col("__y")), "left")
    x, us = F.col("__p"), F.lit(1_000_000).cast("bigint")
    t = x["local_us"]
    inside = F.filter("__spans", lambda s: (s["lo"] <= F.col("__at")) & (F.col("__at") < s["hi"]))
    before = F.filter("__spans", lambda s: s["hi"] <= F.col("__at"))
    named = F.filter("__spans", lambda s: s["abbr"] == x["abbr"])
    by_zone = F.when(F.size(inside) >= 1, t - inside[0]["offset_s"] * us).when(F.size(before) >= 1, t - F.element_at(before, -1)["offset_s"] * us)
    value = (
        F.when(x["epoch_us"].isNotNull(), x["epoch_us"])
        .when(x["offset_s"].isNotNull(), t - x["offset_s"] * us)
        .when(x["abbr"].isNotNull(), F.when(F.size(named) >= 1, t - named[0]["offset_s"] * us))
        .otherwise(by_zone)
    )
    return j.withColumn(out, value).drop("__p", "__year", "__at", "__tz", "__y", "__mf", "__spans")


def matches(df: DataFrame, text: str, zone: str) -> DataFrame:
    """How each local time meets its zone's intervals: adds ``n_intervals`` (2 ambiguous, 0 nonexistent, 1 direct)."""
    table = F.broadcast(zone_intervals(df, zone).select(F.col("tz_name").alias("__tz"), F.col("year").alias("__y"), F.col("spans").alias("__spans")))
    year, at = _listed(F.col("__p.local_us"))
    p = with_parsed(df, text, F.coalesce(F.col(zone).isin(*sorted(month_first_zones())), F.lit(False))).withColumn("__year", year).withColumn("__t", at).drop("__p")
    j = p.join(table, (F.col(zone) == F.col("__tz")) & (F.col("__year") == F.col("__y")), "left")
    return j.withColumn("n_intervals", F.size(F.filter("__spans", lambda s: (s["lo"] <= F.col("__t")) & (F.col("__t") < s["hi"])))).drop("__t", "__year", "__tz", "__y", "__spans")


#: (table, id column, [(written moment, its field name)], zone column)
METADATA_KEYS = ("CreationDate", "ModDate", "xmp:MetadataDate")


def found(spark: SparkSession, pdfs: DataFrame, records: DataFrame, configs: DataFrame) -> DataFrame:
    """(src, rec_id, field_name, utc_us): one row for each value of the three tables that denotes a real moment."""
    meta = F.array(*[F.struct(F.lit(k).alias("field_name"), F.element_at("metadata", k).alias("text")) for k in METADATA_KEYS])
    pairs = pdfs.select(F.col("pdf_id").alias("rec_id"), F.explode(meta).alias("m")).select("rec_id", "m.field_name", "m.text").where(F.col("text").isNotNull())
    local = records.select(F.lit("adapter_records").alias("src"), F.col("record_id").alias("rec_id"), F.lit("effective_from").alias("field_name"), F.col("effective_from").alias("text"), "tz_name").unionByName(
        configs.select(F.lit("project_configs").alias("src"), F.col("config_id").alias("rec_id"), F.lit("bid_deadline").alias("field_name"), F.col("bid_deadline").alias("text"), "tz_name")
    )
    utc = F.lit("UTC").alias("tz_name")
    every = pairs.select(F.lit("parsed_pdfs").alias("src"), "rec_id", "field_name", "text", utc).unionByName(local.where(F.col("text").isNotNull()))
    zones = local.select("tz_name").unionByName(spark.range(1).select(utc))
    # the test for null stays above the outer join, as it needs the joined spans; below it, the optimizer would copy the whole
    # parsing into the test
    return to_utc(every, "text", "tz_name", zones=zones).select("src", "rec_id", "field_name", "utc_us").where(F.col("utc_us").isNotNull())
