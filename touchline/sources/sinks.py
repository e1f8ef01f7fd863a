"""Sinks: canonical tables, day folders, versioned snapshots, run log."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import text
from touchline.operators.merge import GAME_KEY, upsert_latest
from touchline.schema import CANONICAL, RUN_LOG
from touchline.sources.files import scan_table
from touchline.sources.scratch import shuffles_go

ROWS_PER_FILE = 5_000_000
ROWS_PER_LOT, MOST_LOTS = 4_000_000, 16
_MONTH_LOG = "_months"


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_parquet(df: DataFrame, path: str, schema: T.StructType = CANONICAL, mode: str = "errorifexists") -> None:
    """Parquet with a fixed schema, so a score can never turn into a double."""
    as_schema(df, schema).write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header; quotes are doubled, the way other readers expect it."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def by_day_folders(df: DataFrame, date: str, parts: tuple[str, ...] = ("year", "month", "day")) -> DataFrame:
    """Folder columns, with rows brought together per folder.

    The rebalance hint splits a folder that holds too much and joins small
    ones, so one busy day does not become one long task.
    """
    columns = {p: F.extract(F.lit(p), F.col(date)).cast("int") for p in parts}
    return df.withColumns(columns).hint("rebalance", *parts)


def write_day_json(
    df: DataFrame,
    path: str,
    date: str,
    parts: tuple[str, ...] = ("year", "month", "day"),
    mode: str = "errorifexists",
) -> None:
    """JSON Lines under date folders."""
    by_day_folders(df, date, parts).write.mode(mode).partitionBy(*parts).option(
        "maxRecordsPerFile", ROWS_PER_FILE
    ).json(path)


def dry_run(df: DataFrame, date: str) -> DataFrame:
    """Target folder and row count of a day write, without writing."""
    return df.groupBy(text.partition_path(F.col(date)).alias("target")).agg(F.count(F.lit(1)).alias("games"))


def day_metadata(games: DataFrame, days: DataFrame, run_ts: str) -> DataFrame:
    """Games per expected day, zero included, stamped with the run."""
    counts = games.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, "date", "left").select(
        "date",
        F.coalesce("n", F.lit(0)).alias("games_count"),
        F.lit(run_ts).cast("timestamp_ntz").alias("scraped_timestamp"),
    )


def publish_snapshot(df: DataFrame, path: str, version: str) -> None:
    """Write ``version=<version>`` and then append it to the pointer log.

    Readers follow the log, so they see the old version until the new one is
    complete. The version before the latest is the backup.
    """
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    entry = df.sparkSession.range(1).select(
        F.lit(version).alias("version"), F.current_timestamp().cast("timestamp_ntz").alias("published_at")
    )
    entry.coalesce(1).write.mode("append").parquet(f"{path}/_pointer")


def snapshot_versions(spark: SparkSession, path: str) -> list[str]:
    """Published versions, newest first; at most the latest and its backup."""
    log = scan_table(spark, f"{path}/_pointer", "version string, published_at timestamp_ntz")
    newest = log.groupBy("version").agg(F.max("published_at").alias("at")).orderBy(F.desc("at"), F.desc("version"))
    return [row["version"] for row in newest.limit(2).collect()]


def read_snapshot(spark: SparkSession, path: str, back: int = 0) -> DataFrame:
    """The latest snapshot, or the backup with ``back=1``."""
    versions = snapshot_versions(spark, path)
    if len(versions) <= back:
        raise ValueError(f"no snapshot {back} back under {path}")
    return spark.read.parquet(f"{path}/version={versions[back]}")


def consolidate(spark: SparkSession, path: str, skip_corrupt: bool = False) -> DataFrame:
    """All Parquet files below ``path`` as one table, columns matched by name."""
    reader = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True)
    return reader.option("ignoreCorruptFiles", skip_corrupt).parquet(path)


def append_run_log(runs: DataFrame, path: str) -> None:
    """Append run results."""
    write_parquet(runs, path, RUN_LOG, mode="append")


def month_versions(spark: SparkSession, path: str) -> dict[str, str]:
    """The published version of every month: one entry per calendar month."""
    log = scan_table(spark, f"{path}/{_MONTH_LOG}", "month string, version string, number bigint")
    newest = log.groupBy("month").agg(F.max_by("version", F.struct("number", "version")).alias("version"))
    return {row["month"]: row["version"] for row in newest.collect()}


def write_months(
    incoming: DataFrame,
    path: str,
    keys: list[str] | None = None,
    version: str = "timestamp",
    schema: T.StructType = CANONICAL,
    date: str = "date",
) -> tuple[str, list[str]]:
    """Write new copies of the months that ``incoming`` touches, and say under which name; nobody reads them yet.

    Months are merged lot by lot, so the shuffle files on disk at once are
    those of one lot and not of the whole table.
    """
    spark, name = incoming.sparkSession, uuid.uuid4().hex
    month = F.date_format(date, "yyyy-MM").alias("month")
    fresh = as_schema(incoming, schema).select("*", F.coalesce(month, F.lit("none")).alias("month"))
    touched = _month_sizes(fresh)
    old = _month_sizes(_stored_months(spark, path, schema, list(touched))) if touched else {}
    lots = month_lots({m: n + old.get(m, 0) for m, n in touched.items()})
    for months in lots:
        stored = _stored_months(spark, path, schema, months)
        lot = fresh.where(F.col("month").isin(months)) if len(lots) > 1 else fresh
        merged = upsert_latest(stored, lot, [*(keys or GAME_KEY), "month"], version)
        rows = merged.hint("rebalance", "month").withColumn("copy", F.lit(name))
        files = rows.write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).option("compression", "zstd")
        with shuffles_go(spark):
            files.partitionBy("copy", "month").parquet(f"{path}/data")
    return name, list(touched)


def _month_sizes(rows: DataFrame) -> dict[str, int]:
    return {row["month"]: row["n"] for row in rows.groupBy("month").agg(F.count(F.lit(1)).alias("n")).collect()}


def month_lots(sizes: dict[str, int]) -> list[list[str]]:
    """Months in order, in lots of some million rows; of a large table a share each, since every lot reads the input again."""
    most = max(ROWS_PER_LOT, sum(sizes.values()) // MOST_LOTS)
    lots: list[list[str]] = []
    rows = 0
    for month, size in sorted(sizes.items()):
        if not lots or rows + size > most:
            lots.append([])
            rows = 0
        lots[-1].append(month)
        rows += size
    return lots


def publish_months(spark: SparkSession, path: str, name: str, months: list[str]) -> None:
    """Make the copies written under ``name`` the ones that are read, in one append to the log."""
    if months:
        log = scan_table(spark, f"{path}/{_MONTH_LOG}", "month string, version string, number bigint")
        number = (log.agg(F.max("number")).first()[0] or 0) + 1
        rows = spark.createDataFrame([(m, name, number) for m in months], "month string, version string, number bigint")
        rows.coalesce(1).write.mode("append").parquet(f"{path}/{_MONTH_LOG}")


def merge_months(
    incoming: DataFrame,
    path: str,
    keys: list[str] | None = None,
    version: str = "timestamp",
    schema: T.StructType = CANONICAL,
    date: str = "date",
) -> None:
    """Upsert into a table kept in month folders, rewriting touched months only.

    New copies of the touched months are written beside the old ones and then
    published together, so a run that dies leaves the table as it was, and
    the copies before stay as a backup. The touched months are a short list
    (one entry per calendar month of the input), which prunes the scan of the
    stored table. Applying the same input twice changes nothing. The input is
    read once to count its rows and once a lot of months, so stage or persist
    it when it is costly to compute. One writer at a time.
    """
    publish_months(incoming.sparkSession, path, *write_months(incoming, path, keys, version, schema, date))


def _stored_months(spark: SparkSession, path: str, schema: T.StructType, months: list[str] | None = None) -> DataFrame:
    text_field = lambda n: T.StructField(n, T.StringType())
    stored = scan_table(spark, f"{path}/data", T.StructType([*schema.fields, text_field("copy"), text_field("month")]))
    wanted = {m: v for m, v in month_versions(spark, path).items() if months is None or m in months}
    folders = [f"{v}/{m}" for m, v in wanted.items()]
    # Both columns are folders, so only the wanted ones are listed.
    return stored.where(F.concat_ws("/", "copy", "month").isin(folders)).drop("copy")


def read_months(spark: SparkSession, path: str, schema: T.StructType = CANONICAL) -> DataFrame:
    """The merged table; ``month`` stays available for pruning."""
    return _stored_months(spark, path, schema)


RUN_FILES = "run_id string, kind string, file string"


def write_observed(
    df: DataFrame, path: str, valid: Column, amount: str, stamp: str, run_id: str
) -> tuple[DataFrame, DataFrame]:
    """Write valid and rejected rows in one pass, below ``kind=valid`` and ``kind=rejected``.

    Returns (log, files). The log row (run_id, valid_rows, rejected_rows,
    new_rows = sum of floor(``amount``) over valid rows, finished_at = latest
    ``stamp``, files) takes its counts from metrics that the write itself
    observed, so nothing is scanned twice. ``files`` has one row per written
    Parquet file (run_id, kind, file), from a listing that reads no contents.
    A null ``valid`` counts as rejected; an empty input gives zero counts.
    """
    spark = df.sparkSession
    kind = F.when(F.coalesce(valid, F.lit(False)), F.lit("valid")).otherwise(F.lit("rejected"))
    good = F.col("kind") == "valid"
    watch = Observation(f"run-{uuid.uuid4().hex}")
    flagged = df.withColumn("kind", kind).observe(
        watch,
        F.count_if(good).alias("valid_rows"),
        F.count_if(~good).alias("rejected_rows"),
        F.sum(F.when(good, F.floor(amount))).cast("bigint").alias("new_rows"),
        F.max(stamp).alias("finished_at"),
    )
    flagged.write.partitionBy("kind").parquet(path)
    seen = watch.get
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    files = listing.select(
        F.lit(run_id).alias("run_id"), F.regexp_extract("path", r"/kind=([^/]+)/", 1).alias("kind"), F.col("path").alias("file")
    )
    log = spark.createDataFrame(
        [(run_id, seen.get("valid_rows", 0), seen.get("rejected_rows", 0), seen.get("new_rows"), seen.get("finished_at"))],
        f"run_id string, valid_rows bigint, rejected_rows bigint, new_rows bigint, finished_at {df.schema[stamp].simpleString().split(':')[-1]}",
    )
    return log.withColumn("files", F.lit(files.count()).cast("bigint")), files
