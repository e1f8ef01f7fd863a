"""Column expressions for dirty text. All of them are JVM-side and never raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions import fixed_values as fixed

# Characters with the Unicode space property, plus the four separators of ASCII.
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# A date, or a date with a time and any offset; the first group leaves the offset out.
_ISO_STAMP = (
    r"^(\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,6})?)?)?)"
    r"(?:(?<=:\d{2}|[.,]\d{1,6})(?:Z|[+-]\d{2}:?\d{2}(?::?\d{2})?))?$"
)
_LEFT_SCORE = r"^\s*([+-]?\d+)\s* - (?:(?! - ).)*$"
_BOTH_SCORES = r"^\s*[+-]?\d+\s* - \s*([+-]?\d+)\s*$"
_DAY_MONTH = r"^\w+-(\w+) (\d+)"


def strip_text(text: Column) -> Column:
    """Trim every Unicode space at both ends; plain ``trim`` would leave no-break spaces."""
    return F.btrim(text, F.lit(_SPACES))


def is_blank(text: Column) -> Column:
    """True for null, empty and all-space text."""
    return text.isNull() | (F.length(strip_text(text)) == 0)


def coerce_long(text: Column) -> Column:
    """Whole number from text, null when it is not one (``3.0`` counts as 3)."""
    trimmed = strip_text(text)
    return F.when(trimmed.rlike(r"^[+-]?\d+(\.0*)?$"), F.regexp_replace(trimmed, r"\.0*$", "").try_cast("bigint"))


def coerce_double(text: Column) -> Column:
    """Number from text, null when it is not one."""
    return strip_text(text).try_cast("double")


def score_parts(score: Column) -> tuple[Column, Column]:
    """Split ``a - b`` into two counts.

    Anything that is not exactly two parts gives two nulls. A bad left part
    voids the right one; a bad right part leaves the left one standing.
    """
    left = F.regexp_extract(score, _LEFT_SCORE, 1).try_cast("bigint")
    right = F.regexp_extract(score, _BOTH_SCORES, 1).try_cast("bigint")
    return left, right


def iso_wall_clock(text: Column) -> Column:
    """Zero-padded ISO date or stamp as written; an offset is dropped, not applied."""
    bare = F.regexp_extract(text, _ISO_STAMP, 1)
    return F.translate(bare, ",", ".").try_cast("timestamp_ntz")


def month_number(abbreviation: Column) -> Column:
    """1 to 12 for a three-letter month; anything else counts as January."""
    position = F.array_position(F.array(*[F.lit(m) for m in fixed.MONTHS]), abbreviation)
    return F.when(position > 0, position).otherwise(F.lit(1)).cast("int")


def game_date(text: Column, year: int) -> Column:
    """Date of a game: ISO text first, then ``Sat-Jun 1`` placed in ``year``."""
    month = month_number(F.regexp_extract(text, _DAY_MONTH, 1))
    day = F.regexp_extract(text, _DAY_MONTH, 2).try_cast("int")
    zero = F.lit(0)
    spoken = F.try_make_timestamp_ntz(F.lit(year), month, day, zero, zero, zero.cast("decimal(16,6)"))
    return F.coalesce(iso_wall_clock(text), F.when(text.rlike(_DAY_MONTH), spoken))


def utc_stamp(text: Column) -> Column:
    """Ingest stamp. The zone is dropped at storage, so the wall clock is kept."""
    return iso_wall_clock(text)


def web_address_ok(url: Column) -> Column:
    """Null is fine; otherwise http or https and not blank."""
    return url.isNull() | F.startswith(url, F.lit("http://")) | F.startswith(url, F.lit("https://"))


def grid_stamp(date_text: Column, time_text: Column) -> Column:
    """``3/7/2024`` and ``7:05 PM`` to a stamp; null when either is malformed."""
    d = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    t = r"^(?i)(\d{1,2}):(\d{1,2})\s+(AM|PM)$"
    hour12 = F.regexp_extract(time_text, t, 1).try_cast("int")
    afternoon = F.upper(F.regexp_extract(time_text, t, 3)) == "PM"
    hour = hour12 % 12 + F.when(afternoon, 12).otherwise(0)
    stamp = F.try_make_timestamp_ntz(
        F.regexp_extract(date_text, d, 3).try_cast("int"),
        F.regexp_extract(date_text, d, 1).try_cast("int"),
        F.regexp_extract(date_text, d, 2).try_cast("int"),
        hour,
        F.regexp_extract(time_text, t, 2).try_cast("int"),
        F.lit(0).cast("decimal(16,6)"),
    )
    return F.when(hour12.between(1, 12), stamp)


def split_description(description: Column, dash_too: bool = True) -> tuple[Column, Column]:
    """Two sides named in one line.

    `` vs `` wins, then `` - `` when ``dash_too``; an unsplit line keeps its
    text as the first side and gets a placeholder as the second.
    """
    versus = F.split(description, fixed.VERSUS)
    parts = versus
    if dash_too:
        parts = F.when(F.size(versus) == 1, F.split(description, fixed.DASH)).otherwise(versus)
    home = parts[0]
    away = F.when(F.size(parts) > 1, F.get(parts, F.lit(1))).otherwise(F.lit(fixed.UNKNOWN_SIDE))
    if dash_too:
        unsplit = (home == description) & F.contains(description, F.lit(" "))
        away = F.when(unsplit & F.contains(description, F.lit(fixed.PRACTICE)), F.lit(fixed.PRACTICE)).otherwise(away)
    return home, away


def duration_text(seconds: Column) -> Column:
    """Elapsed seconds as ``Xm Ys``."""
    whole = F.floor(seconds)
    return F.concat(F.floor(whole / 60).cast("string"), F.lit("m "), (whole % 60).cast("string"), F.lit("s"))


def clip(text: Column, limit: int) -> Column:
    """First ``limit`` characters, with dots when something was cut."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def partition_path(date: Column) -> Column:
    """``year=2025/month=02/day=15`` for a date."""
    return F.date_format(date, "'year='yyyy'/month='MM'/day='dd")


def page_address(date: Column, base_url: str, facility_id: str) -> Column:
    """Address of the printable schedule page of one day."""
    title = F.concat(F.lit("Games on "), F.date_format(date, "EEEE, MMMM dd, yyyy"))
    pairs = [
        ("type", F.lit("schedule")),
        ("title", title),
        ("team_id", F.lit("0")),
        ("league_id", F.lit("0")),
        ("facility_id", F.lit(facility_id)),
        ("day", F.date_format(date, "M/d/yyyy")),
        ("framed", F.lit("1")),
    ]
    query = F.concat_ws("&", *[F.concat(F.lit(f"{key}="), F.url_encode(value)) for key, value in pairs])
    return F.concat(F.lit(f"{base_url}?"), query)


def seconds_between(start: Column, stop: Column) -> Column:
    """Elapsed seconds between two zone-free stamps, fraction kept."""
    return F.timestamp_diff("MICROSECOND", start, stop) / F.lit(1000000)
