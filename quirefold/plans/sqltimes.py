"""The instants that texts state, in SQL: an independent reading of the formats, with DuckDB's own zone data."""

from __future__ import annotations

from quirefold.plans.sqltext import q

#: Format -> pattern and the group of each part. Fixed values.
_FORMATS = {
    "iso": (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})[T ]+(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,6}))?)?\s*(Z|[+-]\d{2}:?\d{2}|\[[A-Za-z0-9_+/-]+\]|[A-Za-z][A-Za-z0-9_+/-]*)?$", dict(y=1, m=2, d=3, h=4, i=5, s=6, f=7, z=8)),
    "compact": (r"^(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})(Z)?$", dict(y=1, m=2, d=3, h=4, i=5, s=6, z=7)),
    "plain": (r"^(\d{1,4})([/.])\s?(\d{1,2})[/.]\s?(\d{1,4})\.?,?\s+(오전|오후)?\s?(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s?([AaPp][Mm]))?$", dict(one=1, mark=2, two=3, three=4, half=5, h=6, i=7, s=8, ap=9)),
    "english": (r"^([A-Za-z]{3,9})\.? (\d{1,2}), (\d{4}),? (\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s?([AaPp][Mm]))?$", dict(mon=1, d=2, y=3, h=4, i=5, s=6, ap=7)),
    "german": (r"^(\d{1,2})\. (\p{L}{3,9})\.? (\d{4}),? (\d{1,2}):(\d{2})(?::(\d{2}))?(?: Uhr)?$", dict(d=1, mon=2, y=3, h=4, i=5, s=6)),
    "korean": (r"^(\d{4})년 (\d{1,2})월 (\d{1,2})일(?: (오전|오후))? (\d{1,2})시(?: (\d{1,2})분)?(?: (\d{1,2})초)?$", dict(y=1, m=2, d=3, half=4, h=5, i=6, s=7)),
    "mail": (r"^(?:[A-Za-z]{3}, )?(\d{1,2}) ([A-Za-z]{3}) (\d{4}) (\d{1,2}):(\d{2})(?::(\d{2}))? ([+-]\d{4}|[A-Za-z]{1,5})$", dict(d=1, mon=2, y=3, h=4, i=5, s=6, z=7)),
}
_MONTHS = "MAP {'jan': 1, 'feb': 2, 'mar': 3, 'mär': 3, 'apr': 4, 'may': 5, 'mai': 5, 'jun': 6, 'jul': 7, 'aug': 8, 'sep': 9, 'oct': 10, 'okt': 10, 'nov': 11, 'dec': 12, 'dez': 12}"
#: Zone abbreviations -> minutes east of UTC. Fixed values.
_SHORT = "MAP {'EST': -300, 'EDT': -240, 'CST': -360, 'CDT': -300, 'MST': -420, 'MDT': -360, 'PST': -480, 'PDT': -420, 'GMT': 0, 'BST': 60, 'WET': 0, 'WEST': 60, 'CET': 60, 'CEST': 120, 'EET': 120, 'EEST': 180, 'KST': 540, 'JST': 540, 'IST': 330, 'AEST': 600, 'AEDT': 660, 'ACST': 570, 'ACDT': 630, 'AWST': 480}"


def instants(source: str) -> str:
    """Steps from ``source`` (text, worker, ...), a SELECT, to ``moments`` with its columns and utc_us, the instant in microseconds or null."""

    def part(name: str) -> str:
        cases = " ".join(f"WHEN '{kind}' THEN regexp_extract(v, {q(pattern)}, {groups[name]})" for kind, (pattern, groups) in _FORMATS.items() if name in groups)
        return f"CASE kind {cases} ELSE '' END"

    kinds = " ".join(f"WHEN regexp_matches(v, {q(pattern)}) THEN '{kind}'" for kind, (pattern, _) in _FORMATS.items())
    parts = ", ".join(f"{part(n)} AS {n}_" for n in ("y", "m", "d", "h", "i", "s", "f", "z", "mon", "one", "mark", "two", "three", "half", "ap"))
    number = lambda c: f"TRY_CAST({c} AS INTEGER)"
    return rf"""writers AS (SELECT worker, min(time_zone) AS tz, min(date_order) AS ord FROM workers GROUP BY worker),
source AS ({source}),
cleaned AS (SELECT source.*, coalesce(writers.tz, 'UTC') AS own_zone, coalesce(writers.ord, 'YMD') AS ord, trim(regexp_replace(text, '[\s\x{{3000}}\x{{A0}}]+', ' ', 'g')) AS v FROM source LEFT JOIN writers ON writers.worker = source.worker),
kinds AS (SELECT *, CASE WHEN regexp_matches(v, '^([0-9]{{9,10}}|[0-9]{{12,13}}|[0-9]{{15,16}})$') THEN 'count' {kinds} END AS kind FROM cleaned),
cut AS (SELECT *, {parts} FROM kinds WHERE kind IS NOT NULL),
dated AS (SELECT *, CASE WHEN kind <> 'plain' THEN NULL WHEN length(one_) = 4 THEN 'YMD' WHEN mark_ = '.' OR (length(three_) = 4 AND ord = 'YMD') THEN 'DMY' ELSE ord END AS by_ FROM cut),
numbers AS (SELECT *, {number("CASE by_ WHEN 'YMD' THEN one_ WHEN 'DMY' THEN three_ WHEN 'MDY' THEN three_ ELSE y_ END")} AS year0,
  CASE WHEN mon_ <> '' THEN ({_MONTHS})[lower(left(mon_, 3))] ELSE {number("CASE by_ WHEN 'YMD' THEN two_ WHEN 'DMY' THEN two_ WHEN 'MDY' THEN one_ ELSE m_ END")} END AS month0,
  {number("CASE by_ WHEN 'YMD' THEN three_ WHEN 'DMY' THEN one_ WHEN 'MDY' THEN two_ ELSE d_ END")} AS day0,
  lower(CASE WHEN half_ <> '' THEN half_ ELSE ap_ END) AS noon, {number('h_')} AS hour0, coalesce({number('i_')}, 0) AS minute0, coalesce({number('s_')}, 0) AS second0, coalesce({number("rpad(f_, 6, '0')")}, 0) AS micro0, regexp_replace(z_, '[\[\]]', '', 'g') AS zone0 FROM dated),
clock AS (SELECT *, TRY(make_timestamp(CASE WHEN year0 < 100 THEN year0 + 2000 ELSE year0 END, month0, day0, CASE WHEN noon IN ('pm', '오후') THEN hour0 % 12 + 12 WHEN noon IN ('am', '오전') THEN hour0 % 12 ELSE hour0 END, minute0, second0)) AS local,
  CASE WHEN zone0 IN ('Z', 'UTC', 'UT') THEN 0 WHEN regexp_matches(zone0, '^[+-]') THEN (CASE WHEN zone0[1] = '-' THEN -1 ELSE 1 END) * (TRY_CAST(zone0[2:3] AS INTEGER) * 60 + TRY_CAST(right(zone0, 2) AS INTEGER)) WHEN zone0 <> '' AND NOT contains(zone0, '/') THEN ({_SHORT})[zone0] END AS minutes,
  CASE WHEN contains(zone0, '/') THEN zone0 WHEN zone0 = '' THEN own_zone END AS zone FROM numbers),
resolved AS (SELECT *, TRY(timezone(zone, local)) AS later FROM clock),
moments AS (SELECT *, CASE WHEN kind = 'count' THEN CAST(v AS BIGINT) * CASE WHEN length(v) <= 10 THEN 1000000 WHEN length(v) <= 13 THEN 1000 ELSE 1 END
  WHEN minutes IS NOT NULL THEN epoch_us(local) - minutes * 60000000::BIGINT + micro0
  WHEN timezone(zone, later - INTERVAL 1 HOUR) = local THEN epoch_us(later) - 3600000000 + micro0 ELSE epoch_us(later) + micro0 END AS utc_us FROM resolved)"""
