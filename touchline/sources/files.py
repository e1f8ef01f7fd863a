"""Scans and file selection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.sources.scratch import staged

NOT_AN_OBJECT, EMPTY_FILE = "not an object", "empty file"


def scan_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Parquet scan with a fixed schema. Only a missing path reads as an empty table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_partitioned_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON Lines under ``key=value`` folders; filters on the keys prune folders."""
    return spark.read.schema(schema).json(path)


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(path, content)`` with one row per ``.json`` or ``.jsonl`` file, meta files left out."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    chosen = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    return chosen.where(is_data_file(F.col("path")))


def json_texts(spark: SparkSession, paths: str | list[str], keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """``(path, text, reason)``: one row per JSON object in files of lines or of one document.

    A file whose first filled line is a whole object holds lines and is read
    in splits, whatever its size. Any other file is read whole: the elements
    of an array, or one object. If that cannot be parsed, its lines are looked
    at one by one. What is not an object gives a row with a ``reason`` and the
    text found; so does a file of blank lines (Spark shows no file of no bytes at
    all). Nothing is decided by size.

    Files are read as lines, in splits unless they are compressed; a file read
    whole is joined back from its lines in order (line ends become ``\\n``).
    What kind each file is, one short row a file, is found first and staged,
    so that Spark knows its size: lines meet it by broadcast while it is small
    and only lines of files read whole are shuffled. Only Spark's own file
    listing is held by the driver; if ``paths`` is a list of files, their kinds
    are as well, and files of the other kind are not opened again.
    """
    chosen = (keep or is_data_file)(F.col("path"))
    read = spark.read.option("recursiveFileLookup", True)
    named = F.col("_metadata.file_path").alias("path")
    block = F.col("_metadata.file_block_start").alias("block")
    values = read.text(paths)

    def lines(some: Column) -> DataFrame:
        # The filter comes before the row number, so that Spark skips the files it leaves out.
        rows = values.select(named, block, F.col("value").alias("text")).where(some)
        return rows.select("path", "block", F.monotonically_increasing_id().alias("row"), "text")

    filled = F.trim("text") != ""
    # Numbers only, no text, so the aggregate needs no sort: is the first filled line the first one that is an object?
    object_row = F.when(_is_object(F.col("text")), F.col("row"))
    first = lines(chosen).where(filled).groupBy("path", "block").agg(F.min("row").alias("any"), F.min(object_row).alias("object"))
    first = first.groupBy("path").agg(F.min_by(~F.col("any").eqNullSafe(F.col("object")), "block").alias("whole"))
    first = staged(first, "file-kinds")
    listed = read.format("binaryFile").load(paths).select(named).where(chosen)
    empty = listed.join(first, "path", "left_anti").select("path", F.lit("").alias("text"), F.lit(EMPTY_FILE).alias("reason"))

    if isinstance(paths, list):  # the caller holds the files, so their kinds fit beside them
        kinds = first.collect()
        of_kind = lambda whole: lines(F.col("path").isin([row["path"] for row in kinds if row["whole"] == whole]))
    else:
        of_kind = lambda whole: lines(chosen).join(first.where(F.col("whole") == whole).select("path"), "path", "left_semi")
    of_lines, own = _line_rows(of_kind(False).where(filled)), of_kind(True)
    # A document file is put back together from its lines, in order.
    ordered = F.array_sort(F.collect_list(F.struct("block", "row", "text")))
    whole = own.groupBy("path").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("text"))
    body, parsed = F.trim("text"), F.try_parse_json("text").isNotNull()
    listing = F.when(parsed & body.startswith("["), F.from_json("text", "array<string>"))
    single = F.when(parsed & ~body.startswith("["), F.array(F.col("text")))
    found = F.coalesce(listing, single, F.filter(F.split("text", r"\r\n|\r|\n"), lambda x: F.trim(x) != ""))
    return of_lines.unionByName(_line_rows(whole.select("path", F.explode(found).alias("text")))).unionByName(empty)


def _line_rows(rows: DataFrame) -> DataFrame:
    fine = F.coalesce(_is_object(F.col("text")), F.lit(False))
    return rows.select("path", "text", F.when(~fine, F.lit(NOT_AN_OBJECT)).alias("reason"))


def json_records(spark: SparkSession, path: str, ddl: str, keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """The objects of :func:`json_texts` with the columns of ``ddl``."""
    texts = json_texts(spark, path, keep).where(F.col("reason").isNull())
    return texts.select(F.from_json("text", ddl).alias("record")).select("record.*")


def json_rejects(spark: SparkSession, path: str, keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """``(path, text, reason)`` of whatever :func:`json_records` cannot use."""
    return json_texts(spark, path, keep).where(F.col("reason").isNotNull())


def _is_object(line: Column) -> Column:
    return F.try_parse_json(line).isNotNull() & F.ltrim(line).startswith("{")


def is_data_file(path: Column) -> Column:
    """Keeps ``.json`` and ``.jsonl``, drops anything ending in ``meta.json``."""
    data = F.endswith(path, F.lit(".json")) | F.endswith(path, F.lit(".jsonl"))
    return data & ~F.endswith(path, F.lit("meta.json"))


def data_files(listing: DataFrame, path: str = "key") -> DataFrame:
    """The data files of a listing."""
    return listing.where(is_data_file(F.col(path)))


def changed_since(
    listing: DataFrame,
    marker: DataFrame,
    run_ts: str,
    only_recent: bool = True,
    modified: str = "last_modified",
    default_days: int = 2,
    by: str = "prefix",
) -> DataFrame:
    """Files modified strictly after the marker of their own prefix.

    ``marker`` has at most one row per value of ``by`` with a ``marker``
    stamp. A prefix without one goes back ``default_days`` days.
    """
    if not only_recent:
        return listing
    fallback = F.lit(run_ts).cast("timestamp_ntz") - F.make_dt_interval(F.lit(default_days))
    since = marker.select(F.col(by).alias("_by"), F.col("marker").alias("_since"))
    joined = listing.join(since, listing[by].eqNullSafe(F.col("_by")), "left")
    return joined.where(F.col(modified) > F.coalesce("_since", fallback)).drop("_by", "_since")


def advance_markers(run_log: DataFrame, *keys: str) -> DataFrame:
    """Marker per key: the finish of the newest successful run."""
    good = F.when(F.col("status") == "SUCCESS", F.col("finished_at"))
    return run_log.groupBy(*keys).agg(F.max(good).alias("marker"))


def path_date(path: Column) -> Column:
    """Date at the start of the first path part that begins with a real one."""
    parts = F.filter(F.split(path, "/"), lambda p: (F.length(p) >= 10) & F.contains(p, F.lit("-")))
    dates = F.transform(
        parts, lambda p: F.when(F.substring(p, 1, 10).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.substring(p, 1, 10).try_cast("date"))
    )
    return F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0))


def in_path_dates(listing: DataFrame, start: str | None, end: str | None, path: str = "key") -> DataFrame:
    """Files dated inside the range, both ends included; undated files stay."""
    if not start and not end:
        return listing
    dated = path_date(F.col(path))
    inside = F.lit(True)
    if start:
        inside = inside & (dated >= F.lit(start).cast("date"))
    if end:
        inside = inside & (dated <= F.lit(end).cast("date"))
    return listing.where(dated.isNull() | inside)


def html_day_files(
    listing: DataFrame, start: str | None = None, end: str | None = None, limit: int | None = None, path: str = "key"
) -> DataFrame:
    """Pages named ``yyyy-MM-dd.html`` inside the range, oldest first; others are dropped."""
    date = F.regexp_extract(F.element_at(F.split(F.col(path), "/"), -1), r"^(\d{4}-\d{2}-\d{2})\.html", 1)
    dated = listing.where(F.endswith(F.col(path), F.lit(".html"))).withColumn("file_date", date)
    dated = dated.where(F.col("file_date") != "")
    if start:
        dated = dated.where(F.col("file_date") >= start)
    if end:
        dated = dated.where(F.col("file_date") <= end)
    ordered = dated.orderBy("file_date", path)
    return ordered if limit is None else ordered.limit(limit)


def html_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(path, html)`` with one row per stored page."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.html")
    return files.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("html")
    )


def sample_files(files: DataFrame, n: int, seed: int, path: str = "key") -> DataFrame:
    """Exactly ``min(n, all)`` files; zero keeps all.

    Paths are ordered by a salted hash, so the draw repeats after a lost task
    and runs as a distributed top-n.
    """
    if n <= 0:
        return files
    return files.orderBy(F.md5(F.concat(F.col(path), F.lit(f"#{seed}"))), path).limit(n)


def file_counts(listing: DataFrame, *keys: str) -> DataFrame:
    """Number of files per key."""
    return listing.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"))
