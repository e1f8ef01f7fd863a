"""Date ranges as tables: spines, batches, gaps and coverage.

A range row grows to one row per day, batch or month. Growth is bounded by the
length of the range and happens row by row, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import fixed_values as fixed
from touchline.functions import text
from touchline.operators.ledger import date_set, skip_done


def _days(n: Column | str) -> Column:
    """``n`` days as an interval."""
    return F.make_dt_interval(F.col(n) if isinstance(n, str) else n)


def date_spine(ranges: DataFrame, start: str = "start_date", end: str = "end_date", name: str = "date") -> DataFrame:
    """One row per day of every range, both ends included; reversed ranges give none."""
    valid = ranges.where(F.col(start) <= F.col(end))
    return valid.withColumn(name, F.explode(F.sequence(start, end, F.expr("interval 1 day"))))


def month_spine(ranges: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row per calendar month that the range touches."""
    first = F.trunc(start, "month")
    valid = ranges.where(F.col(start) <= F.col(end))
    return valid.withColumn("month_start", F.explode(F.sequence(first, F.col(end), F.expr("interval 1 month"))))


def date_batches(
    ranges: DataFrame, size: Column | int = fixed.DEFAULT_BATCH_DAYS, start: str = "start_date", end: str = "end_date"
) -> DataFrame:
    """Contiguous batches of ``size`` days, the last one clipped to the range."""
    size = F.lit(size) if isinstance(size, int) else size
    valid = ranges.where(F.col(start) <= F.col(end))
    batches = valid.select("*", size.cast("int").alias("_size")).withColumn(
        "batch_start", F.explode(F.sequence(F.col(start), F.col(end), _days("_size")))
    )
    batch_end = F.least(F.date_add("batch_start", F.col("_size") - 1), F.col(end))
    return (
        batches.withColumn("batch_end", batch_end)
        .withColumn("days", (F.datediff("batch_end", "batch_start") + 1).cast("bigint"))
        .drop("_size")
    )


def range_chunks(
    ranges: DataFrame, limit: Column | int = fixed.DEFAULT_CHUNK_DAYS, start: str = "start_date", end: str = "end_date"
) -> DataFrame:
    """A range that fits stays whole; a longer one is split. ``split_required`` says which."""
    limit = F.lit(limit) if isinstance(limit, int) else limit
    total = (F.datediff(end, start) + 1).alias("total_days")
    return date_batches(ranges.select("*", total), limit, start, end).withColumn(
        "split_required", F.col("total_days") > limit
    )


def range_requests(requests: DataFrame) -> DataFrame:
    """Check and normalise requested ranges given as text; the first failed check is the error."""
    parse = lambda c: F.when(F.col(c).rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(c, "yyyy-M-d"))
    start, end = parse("start_date"), parse("end_date")
    missing = F.coalesce(F.col("start_date"), F.lit("")) == ""
    missing = missing | (F.coalesce(F.col("end_date"), F.lit("")) == "")
    size = F.coalesce("batch_size", F.lit(fixed.DEFAULT_BATCH_DAYS))
    error = (
        F.when(missing, "missing date")
        .when(start.isNull() | end.isNull(), "invalid date format")
        .when(start > end, "start after end")
    )
    others = [c for c in requests.columns if c not in ("start_date", "end_date", "batch_size", "force")]
    return requests.select(
        *others,
        start.alias("start_date"),
        end.alias("end_date"),
        F.greatest(F.lit(fixed.MIN_BATCH_DAYS), F.least(F.lit(fixed.MAX_BATCH_DAYS), size))
        .cast("bigint")
        .alias("batch_size"),
        F.coalesce("force", F.lit(False)).alias("force"),
        error.alias("error"),
    )


def trailing_days(df: DataFrame, date: str, today: str, back: int = fixed.TRAILING_DAYS) -> DataFrame:
    """Rows of ``today`` and the ``back`` days before it, whole days.

    Written as a half-open range on the stored column, so it reaches the scan.
    """
    day = F.lit(today).cast("date")
    low = F.date_sub(day, back).cast("timestamp_ntz")
    high = F.date_add(day, 1).cast("timestamp_ntz")
    return df.where((F.col(date) >= low) & (F.col(date) < high))


def period_end(mode: Column, start: Column) -> Column:
    """Last day of a day, week or month period; weeks run seven days, months to their last day."""
    return F.when(mode == "day", start).when(mode == "week", F.date_add(start, 6)).otherwise(F.last_day(start))


def month_days(requests: DataFrame, month: str = "month_start", wanted: str = "target_days") -> DataFrame:
    """Days of a month: the wanted ones that exist, or all when none are given."""
    first = F.trunc(month, "month")
    day = F.dayofmonth("date")
    spine = requests.withColumn("date", F.explode(F.sequence(first, F.last_day(first), F.expr("interval 1 day"))))
    return spine.where(F.col(wanted).isNull() | F.array_contains(F.col(wanted), day))


def missing_dates(ranges: DataFrame, data: DataFrame, date: str = "date") -> DataFrame:
    """Days of the ranges without data."""
    return date_spine(ranges, name=date).join(date_set(data, date), date, "left_anti")


def _coverage(checked: DataFrame, keys: list[str]) -> DataFrame:
    missing = F.when(~F.col("_present"), F.col("date"))
    return checked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_days"),
        F.count_if("_present").alias("processed_days"),
        F.count(missing).alias("missing_count"),
        F.bool_and("_present").alias("success"),
        F.array_sort(F.collect_list(missing)).alias("missing_days"),
    )


def coverage_summary(ranges: DataFrame, data: DataFrame, keys: list[str]) -> DataFrame:
    """Days present and missing per range, with the missing days listed.

    A range key must name one range, so its list is never longer than the range.
    """
    present = date_set(data).withColumnRenamed("date", "_has")
    checked = date_spine(ranges).join(present, F.col("date") == F.col("_has"), "left")
    return _coverage(checked.withColumn("_present", F.col("_has").isNotNull()), keys)


def verify_results(ranges: DataFrame, results: DataFrame, data: DataFrame, keys: list[str]) -> DataFrame:
    """Coverage from recorded day results; ranges without any fall back to the data.

    ``results`` holds ``results map<date, boolean>`` per batch of a range. A
    day counts once, as present if any batch that names it succeeded, so a
    retried batch adds nothing.
    """
    days = results.select(*keys, F.explode("results").alias("date", "_day"))
    days = days.groupBy(*keys, "date").agg(F.coalesce(F.bool_or("_day"), F.lit(False)).alias("_present"))
    recorded = _coverage(days, keys).drop("total_days")
    length = ranges.select(*keys, (F.datediff("end_date", "start_date") + 1).cast("bigint").alias("total_days"))
    unrecorded = ranges.join(recorded.select(*keys), keys, "left_anti")
    return length.join(recorded, keys).unionByName(coverage_summary(unrecorded, data, keys))


def frontier(
    ranges: DataFrame,
    ledger: DataFrame,
    base_url: str,
    facility_id: str,
    stage: str | None = None,
    force: bool = False,
) -> DataFrame:
    """Days still to be fetched and the address of each page."""
    todo = skip_done(date_spine(ranges).select("date").distinct(), ledger, stage, force)
    return todo.withColumn("url", text.page_address(F.col("date"), base_url, facility_id))


#: Most days of a calendar table that may be broadcast (about 11,000 years).
BROADCAST_DAYS = 4_000_000


def gap_ranges(ranges: DataFrame, data: DataFrame, key: str, date: str = "date") -> DataFrame:
    """Runs of days without data inside each range: ``key``, ``gap_start``, ``gap_end``, ``days``.

    Gaps and islands: the distinct days with data, framed by the day before the
    first range and the day after the last, are put in order once, and
    ``lead`` gives the gaps between them (the days are bounded by the calendar,
    not by the rows). A range meets exactly the gaps from the first that ends
    on or after its start to the last that starts on or before its end; a table
    with one row per calendar day names both, so each range is joined to the
    gaps it overlaps and never expanded into days. The expansion of the result
    equals :func:`missing_dates`. Ranges with a null bound or start after end give nothing.
    """
    spark = ranges.sparkSession
    bounds = ranges.agg(F.min("start_date").alias("lo"), F.max("end_date").alias("hi")).first()
    if bounds["lo"] is None:
        return spark.createDataFrame([], f"{key} {ranges.schema[key].simpleString().split(':')[-1]}, gap_start date, gap_end date, days bigint")
    lo, hi = bounds["lo"], bounds["hi"]
    frame = F.lit(lo).cast("date"), F.lit(hi).cast("date")
    seen = date_set(data, date).where(F.col(date).between(*frame)).select(F.col(date).alias("day"))
    edges = spark.createDataFrame([(None,)], "x int").select(F.explode(F.array(F.date_sub(frame[0], 1), F.date_add(frame[1], 1))).alias("day"))
    ordered = Window.orderBy("day")
    gaps = seen.unionByName(edges).select(F.date_add("day", 1).alias("g_start"), F.date_sub(F.lead("day").over(ordered), 1).alias("g_end"))
    gaps = gaps.where(F.col("g_start") <= F.col("g_end")).withColumn("k", F.row_number().over(Window.orderBy("g_start")))
    gap_days = gaps.select("k", F.explode(F.sequence("g_start", "g_end")).alias("day"))
    calendar = spark.createDataFrame([(None,)], "x int").select(F.explode(F.sequence(*frame)).alias("day"))
    calendar = calendar.join(gap_days, "day", "left")
    after, before = Window.orderBy("day").rowsBetween(0, Window.unboundedFollowing), Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    calendar = calendar.select("day", F.first("k", True).over(after).alias("first_gap"), F.last("k", True).over(before).alias("last_gap"))
    small = (hi - lo).days + 1 <= BROADCAST_DAYS
    sized = (lambda df: F.broadcast(df)) if small else (lambda df: df)
    firsts = sized(calendar.select(F.col("day").alias("s_day"), "first_gap"))
    lasts = sized(calendar.select(F.col("day").alias("e_day"), "last_gap"))
    spans = ranges.join(firsts, F.col("start_date") == F.col("s_day")).join(lasts, F.col("end_date") == F.col("e_day"))
    spans = spans.where(F.col("first_gap") <= F.col("last_gap")).select(key, "start_date", "end_date", F.explode(F.sequence("first_gap", "last_gap")).alias("k"))
    met = spans.join(sized(gaps), "k")
    start, end = F.greatest("start_date", "g_start"), F.least("end_date", "g_end")
    out = met.select(key, start.alias("gap_start"), end.alias("gap_end"))
    return out.where(F.col("gap_start") <= F.col("gap_end")).withColumn("days", (F.datediff("gap_end", "gap_start") + 1).cast("bigint"))
