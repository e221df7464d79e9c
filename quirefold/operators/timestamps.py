"""Problem 4: texts that state an instant in many formats, precisions and zones, as one unambiguous instant.

Texts are parsed by built-in expressions into local time, offset and zone. A local time without offset is resolved by
an as-of join with the zone-offset intervals of the IANA database, exploded by (zone, local year), all years that can be
written included: two intervals that hold it mean an ambiguous time (the first instant counts), none a nonexistent one (it is read with the offset before
the gap), one gives the offset.

Defined results: null, empty, blank, placeholder and unparsable texts, impossible dates and unknown zones give a null
instant; a null or unknown worker counts as UTC with year-month-day order; repeated rows stay repeated; an empty table
gives an empty table; other columns are left alone, also those named like the helper columns.
"""

from __future__ import annotations

import calendar
import struct
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from importlib import resources
from pathlib import Path
from zoneinfo import TZPATH, ZoneInfo, available_timezones

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Local years with a bucket of their own in the interval table; all earlier ones share a bucket, so do all later ones.
FIRST_YEAR, LAST_YEAR = 1970, 2040
#: Last year of the table: no zone has written changes in the 28 years before it, only its rule, which depends on the
#: calendar of a year; these years hold all 14 calendars, so each later year is read as one of them.
CYCLE_END = 2128
#: Seconds from 1970 beyond all years that can be written.
FAR_S = 1_000_000_000_000

#: Month names read, by the first letters that tell them apart (English, German; lower case). Fixed values.
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "mär": 3, "apr": 4, "may": 5, "mai": 5, "jun": 6, "jul": 7,
    "aug": 8, "sep": 9, "oct": 10, "okt": 10, "nov": 11, "dec": 12, "dez": 12,
}

_ISO = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})[T ]+(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,6}))?)?\s*(Z|[+-]\d{2}:?\d{2}|\[[A-Za-z0-9_+/-]+\]|[A-Za-z][A-Za-z0-9_+/-]*)?$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})(Z)?$"
_PLAIN = r"^(\d{1,4})([/.])\s?(\d{1,2})[/.]\s?(\d{1,4})\.?,?\s+(오전|오후)?\s?(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s?([AaPp][Mm]))?$"
_ENGLISH = r"^([A-Za-z]{3,9})\.? (\d{1,2}), (\d{4}),? (\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s?([AaPp][Mm]))?$"
_GERMAN = r"^(\d{1,2})\. (\p{L}{3,9})\.? (\d{4}),? (\d{1,2}):(\d{2})(?::(\d{2}))?(?: Uhr)?$"
_KOREAN = r"^(\d{4})년 (\d{1,2})월 (\d{1,2})일(?: (오전|오후))? (\d{1,2})시(?: (\d{1,2})분)?(?: (\d{1,2})초)?$"
_MAIL = r"^(?:[A-Za-z]{3}, )?(\d{1,2}) ([A-Za-z]{3}) (\d{4}) (\d{1,2}):(\d{2})(?::(\d{2}))? ([+-]\d{4}|[A-Za-z]{1,5})$"


def _zone_file(name: str) -> bytes:
    """The compiled IANA data of a zone, from the system or from the tzdata package."""
    for folder in TZPATH:
        path = Path(folder, name)
        if path.is_file():
            return path.read_bytes()
    return resources.files("tzdata").joinpath("zoneinfo", *name.split("/")).read_bytes()


def _changes(data: bytes) -> tuple[list[int], bytes]:
    """The instants at which a zone's written offsets change, and the rule that holds after the last (RFC 8536)."""

    def counts(at: int) -> tuple[int, ...]:
        return struct.unpack_from(">6l", data, at + 20)

    utc, std, leap, times, types, chars = counts(0)
    at = 44 + times * 5 + types * 6 + chars + leap * 8 + std + utc  # the first block holds 32-bit instants and is skipped
    utc, std, leap, times, types, chars = counts(at)
    instants = list(struct.unpack_from(f">{times}q", data, at + 44))
    footer = data[at + 44 + times * 9 + types * 6 + chars + leap * 12 + std + utc :]
    return instants, footer.strip()


def _rule_changes(zone: ZoneInfo, begin: datetime, end: datetime) -> list[int]:
    """The instants from ``begin`` to ``end`` at which a zone's rule changes its offset; rules keep each offset for weeks."""
    state = lambda t: t.astimezone(zone).utcoffset()
    out, t, now = [], begin, state(begin)
    while t < end:
        step = min(t + timedelta(days=20), end)
        if state(step) != now:
            low, high = int(t.timestamp()), int(step.timestamp())
            while high - low > 1:
                middle = (low + high) // 2
                if state(datetime.fromtimestamp(middle, timezone.utc)) == now:
                    low = middle
                else:
                    high = middle
            out.append(high)
            step = datetime.fromtimestamp(high, timezone.utc)
            now = state(step)
        t = step
    return out


@lru_cache(maxsize=1)
def _interval_rows() -> list[tuple[str, int, list[tuple[int, int, int, str]]]]:
    """(zone, bucket, [(local start, local end, offset, abbreviation), ...]) in seconds, of every IANA zone.

    A bucket is a local year from FIRST_YEAR to LAST_YEAR; the one before holds all earlier years and the one after all
    later ones up to CYCLE_END.
    """
    at = lambda year: datetime(year, 1, 1, tzinfo=timezone.utc)
    end = at(CYCLE_END + 2)
    ruled: dict[tuple[bytes, int], list[int]] = {}  # zones with one rule change at the same instants
    out = []
    for name in sorted(available_timezones()):
        zone = ZoneInfo(name)
        instants, rule = _changes(_zone_file(name))
        if b"," in rule:
            begin = max(datetime.fromtimestamp(instants[-1], timezone.utc) if instants and instants[-1] > 0 else at(1970), at(1970))
            key = rule, begin.year
            if key not in ruled:
                ruled[key] = _rule_changes(zone, begin, end)
            instants = instants + [t for t in ruled[key] if not instants or t > instants[-1]]
        runs: list[list] = []
        for since, until in zip([-FAR_S, *instants], [*instants, FAR_S]):
            moment = datetime.fromtimestamp(max(since, -60_000_000_000), timezone.utc).astimezone(zone)
            state = int(moment.utcoffset().total_seconds()), moment.tzname()
            if until <= since:
                continue
            if runs and runs[-1][2:] == list(state):
                runs[-1][1] = until
            else:
                runs.append([since, until, *state])
        local = [(a + offset, b + offset, offset, short) for a, b, offset, short in runs]
        edges = [int(at(year).timestamp()) for year in range(FIRST_YEAR, LAST_YEAR + 2)]
        first = 0
        for bucket, (low, high) in enumerate(zip([-FAR_S, *edges], [*edges, FAR_S]), FIRST_YEAR - 1):
            while first < len(local) - 1 and local[first][1] <= low - 90_000:
                first += 1
            k, held = first, []
            while k < len(local) and local[k][0] < high + 90_000:
                held.append(local[k])
                k += 1
            out.append((name, bucket, held))
    return out


def zone_intervals(spark: SparkSession, zones: list[str] | None = None) -> DataFrame:
    """zone, zone_year, spans: the offset intervals that touch each bucket of local years; all IANA zones by default.

    Its size is bounded by the IANA database (about 600 zones) times the buckets, whatever the data.
    """
    rows = _interval_rows()
    if zones is not None:
        wanted = set(zones)
        rows = [r for r in rows if r[0] in wanted]
    schema = "zone string, zone_year int, spans array<struct<local_from:bigint,local_to:bigint,offset:int,short:string>>"
    return spark.createDataFrame(rows, schema)


def _folded_year(year: Column) -> Column:
    """``year`` up to CYCLE_END, a later one as that year of the last cycle which has its calendar (leap day and first weekday)."""
    kind = lambda leap, first: first + 7 * leap
    held = {kind(calendar.isleap(y), datetime(y, 1, 1).isoweekday() % 7): y for y in range(CYCLE_END - 27, CYCLE_END + 1)}
    leap = F.when((year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0)), 7).otherwise(0)
    weekday = F.dayofweek(F.make_date(year, F.lit(1), F.lit(1))) - 1
    return F.when(year > CYCLE_END, F.get(F.array(*[F.lit(held[k]) for k in range(14)]), weekday + leap)).otherwise(year)


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _month(name: Column) -> Column:
    at = F.element_at(F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv]), F.lower(F.substring(name, 1, 3)))
    return at


def _hour12(hour: Column, mark: Column) -> Column:
    """The hour of day from an hour with AM/PM (or 오전/오후); without a mark the hour as it stands."""
    after = F.lower(mark).isin("pm", "오후")
    before = F.lower(mark).isin("am", "오전")
    return F.when(after, hour % 12 + 12).when(before, hour % 12).otherwise(hour)


def parse_local(text: Column, order: Column) -> Column:
    """Struct of what the text states: epoch_us, or local_us with offset_s, zone or short (zone abbreviation).

    ``order`` is the worker's date order (YMD, DMY, MDY), used for dates with slashes whose year stands last.
    """
    t = F.trim(F.regexp_replace(text, r"[\s\x{3000}\x{00A0}]+", " "))
    zero = lambda c: F.coalesce(c, F.lit(0))
    none = F.lit(None)
    nil, blank = F.lit(0), F.lit("")

    def read(pattern: str, groups: int, build: Callable[[Callable[[int], Column], Callable[[int], Column]], Column]) -> Column:
        """``build`` over the groups of one match; the pattern runs once (the lambda binds its parts)."""
        parts = F.split(F.regexp_replace(t, pattern, "\x01".join(f"${i}" for i in range(1, groups + 1))), "\x01")
        return F.get(F.transform(F.array(parts), lambda p: build(lambda i: F.get(p, F.lit(i - 1)), lambda i: F.get(p, F.lit(i - 1)).try_cast("int"))), F.lit(0))

    def at(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column, micros: Column, tail: Column) -> Column:
        year = F.when(year < 100, year + 2000).otherwise(year)
        moment = F.try_make_timestamp(year, month, day, hour, minute, second.cast("decimal(16,6)"), F.lit("UTC"))
        return F.struct(
            none.cast("bigint").alias("epoch_us"),
            F.when((hour < 24) & (minute < 60) & (second < 60), F.unix_micros(moment) + micros).alias("local_us"),
            year.alias("year"),
            F.when(tail == "", none).otherwise(tail).alias("tail"),
        )

    order = F.coalesce(order, F.lit("YMD"))

    def plain(g: Callable[[int], Column], n: Callable[[int], Column]) -> Column:
        year_first = F.length(g(1)) == 4
        # dates with dots are day first; so is a date that ends in four digits by a worker who writes the year first
        by = F.when(g(2) == ".", "DMY").when((F.length(g(4)) == 4) & (order == "YMD"), "DMY").otherwise(order)
        mark = F.when(g(5) != "", g(5)).otherwise(g(9))
        return at(
            F.when(year_first | (by == "YMD"), n(1)).otherwise(n(4)),
            F.when(year_first | (by != "MDY"), n(3)).otherwise(n(1)),
            F.when(year_first | (by == "YMD"), n(4)).when(by == "MDY", n(3)).otherwise(n(1)),
            _hour12(n(6), mark), n(7), zero(n(8)), nil, blank,
        )

    iso = read(_ISO, 8, lambda g, n: at(n(1), n(2), n(3), n(4), n(5), zero(n(6)), zero(F.rpad(g(7), 6, "0").try_cast("int")), g(8)))
    compact = read(_COMPACT, 7, lambda g, n: at(n(1), n(2), n(3), n(4), n(5), n(6), nil, g(7)))
    plain = read(_PLAIN, 9, plain)
    english = read(_ENGLISH, 7, lambda g, n: at(n(3), _month(g(1)), n(2), _hour12(n(4), g(7)), n(5), zero(n(6)), nil, blank))
    german = read(_GERMAN, 6, lambda g, n: at(n(3), _month(g(2)), n(1), n(4), n(5), zero(n(6)), nil, blank))
    korean = read(_KOREAN, 7, lambda g, n: at(n(1), n(2), n(3), _hour12(n(5), g(4)), zero(n(6)), zero(n(7)), nil, blank))
    mail = read(_MAIL, 7, lambda g, n: at(n(3), _month(g(2)), n(1), n(4), n(5), zero(n(6)), nil, g(7)))
    scale = F.when(F.length(t) <= 10, 1_000_000).when(F.length(t) <= 13, 1000).otherwise(1)
    count = F.struct((t.try_cast("bigint") * scale).alias("epoch_us"), none.cast("bigint").alias("local_us"), none.cast("int").alias("year"), none.cast("string").alias("tail"))
    return (
        F.when(t.rlike(r"^\d{9,10}$|^\d{12,13}$|^\d{15,16}$"), count)
        .when(t.rlike(_ISO), iso)
        .when(t.rlike(_COMPACT), compact)
        .when(t.rlike(_PLAIN), plain)
        .when(t.rlike(_ENGLISH), english)
        .when(t.rlike(_GERMAN), german)
        .when(t.rlike(_KOREAN), korean)
        .when(t.rlike(_MAIL), mail)
    )


def with_instants(df: DataFrame, fields: dict[str, str], workers: DataFrame, worker: str = "worker") -> DataFrame:
    """``df`` with, for each text column of ``fields``, a column of the given name: microseconds since 1970 UTC or null.

    ``workers`` (worker, time_zone, date_order) is a fixed table of the writers; one row per worker is used.
    """
    spark = df.sparkSession
    from quirefold.session import bounded_broadcast

    names = df.columns
    w = workers.groupBy(F.col("worker").alias("_qf_w")).agg(F.min_by("time_zone", F.coalesce("time_zone", F.lit("~"))).alias("_qf_zone"), F.min("date_order").alias("_qf_order"))
    out = df.join(bounded_broadcast(w), F.col(worker) == F.col("_qf_w"), "left").drop("_qf_w") if worker in names else df.withColumns({"_qf_zone": F.lit(None).cast("string"), "_qf_order": F.lit(None).cast("string")})
    spans = F.broadcast(zone_intervals(spark))  # bounded by the IANA database
    for field, target in fields.items():
        out = out.withColumn("_qf_p", parse_local(F.col(field), F.col("_qf_order")))
        tail = F.regexp_replace(F.col("_qf_p.tail"), r"[\[\]]", "")
        numeric = tail.rlike(r"^[+-]\d{2}:?\d{2}$")
        digits = F.regexp_replace(tail, r"[+:-]", "")
        offset = (F.substring(digits, 1, 2).try_cast("int") * 3600 + F.substring(digits, 3, 2).try_cast("int") * 60) * F.when(tail.startswith("-"), -1).otherwise(1)
        fixed = F.when(tail.isin("Z", "UTC", "UT"), 0).when(numeric, offset)
        named = F.when(tail.contains("/"), tail)
        out = out.withColumns({
            "_qf_fixed": fixed,
            "_qf_short": F.when(fixed.isNull() & named.isNull(), tail),
            "_qf_z": F.coalesce(named, "_qf_zone", F.lit("UTC")),
            "_qf_fold": _folded_year(F.col("_qf_p.year")),
        })
        out = out.withColumn("_qf_year", F.least(F.greatest("_qf_fold", F.lit(FIRST_YEAR - 1)), F.lit(LAST_YEAR + 1)))
        out = out.join(spans, (F.col("zone") == F.col("_qf_z")) & (F.col("zone_year") == F.col("_qf_year")) & F.col("_qf_fixed").isNull(), "left") if not {"zone", "zone_year", "spans"} & set(names) else out.join(
            spans.toDF("_qf_a", "_qf_b", "spans_qf"), (F.col("_qf_a") == F.col("_qf_z")) & (F.col("_qf_b") == F.col("_qf_year")) & F.col("_qf_fixed").isNull(), "left"
        ).drop("_qf_a", "_qf_b")
        held = F.col("spans") if "spans_qf" not in out.columns else F.col("spans_qf")
        days = lambda year: F.unix_date(F.make_date(year, F.lit(1), F.lit(1))).cast("bigint")
        moved = F.when(F.col("_qf_fold") != F.col("_qf_p.year"), (days(F.col("_qf_p.year")) - days(F.col("_qf_fold"))) * 86_400_000_000).otherwise(0)
        written = F.col("_qf_p.local_us")
        local = written - moved
        covers = lambda s: (s.local_from * 1_000_000 <= local) & (local < s.local_to * 1_000_000)  # noqa: B023, E731
        short = F.col("_qf_short")
        inside = F.filter(held, covers)
        by_name = F.filter(held, lambda s: s.short == short)  # noqa: B023
        both = F.filter(inside, lambda s: s.short == short)  # noqa: B023
        before = F.filter(held, lambda s: s.local_to * 1_000_000 <= local)  # noqa: B023
        first = F.array_max(F.transform(inside, lambda s: s.offset))  # the larger offset is the earlier instant
        unnamed = F.coalesce(first, F.try_element_at(F.transform(before, lambda s: s.offset), F.lit(-1)), F.get(F.transform(held, lambda s: s.offset), F.lit(0)))
        abbreviated = F.coalesce(F.get(F.transform(both, lambda s: s.offset), F.lit(0)), F.get(F.transform(by_name, lambda s: s.offset), F.lit(0)), F.when(short == "GMT", 0))
        seconds = F.coalesce("_qf_fixed", F.when(short.isNull(), unnamed).otherwise(abbreviated))
        out = out.withColumn(target, F.coalesce(F.col("_qf_p.epoch_us"), written - seconds.cast("bigint") * 1_000_000))
        out = out.drop("_qf_p", "_qf_fixed", "_qf_short", "_qf_z", "_qf_year", "_qf_fold", *([] if "spans_qf" in out.columns else ["zone", "zone_year", "spans"]), "spans_qf")
    return out.drop("_qf_zone", "_qf_order")


#: The canonical form; values already written so are not cases.
CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"


def normalised(df: DataFrame, table_name: str, id_column: str, fields: list[str], workers: DataFrame) -> DataFrame:
    """table_name, row_id, field_name, utc_us of every value that states an instant in another form than the canonical one."""
    slim = df.select(F.col(id_column).alias("row_id"), *fields, "worker")
    parsed = with_instants(slim, {f: f"_us_{f}" for f in fields}, workers)
    parts = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text"), F.col(f"_us_{f}").alias("utc_us")) for f in fields])
    long = parsed.select("row_id", F.inline(parts))
    kept = long.filter(F.col("utc_us").isNotNull() & ~F.col("text").rlike(CANONICAL))
    return kept.select(F.lit(table_name).alias("table_name"), "row_id", "field_name", "utc_us")
