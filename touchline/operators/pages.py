"""Stored schedule pages to rows.

One ``mapInArrow`` pass reads many pages at once as arrays of tokens (``page_batch``); pages that are not well nested, and the
day-event layout, are read token by token (``page_scan``). It emits the
cells of the table rows (no element tree is built); choosing columns from the cells is left to Spark expressions. Pages are
independent of each other, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import fixed_values as fixed
from touchline.functions import page_batch, page_scan, text

_CELL = pa.struct([("label", pa.string()), ("text", pa.string())])
_CELLS = T.ArrayType(
    T.StructType([T.StructField("label", T.StringType()), T.StructField("text", T.StringType())])
)
_PAGES_AT_A_TIME = 256


def table_rows(pages: DataFrame, layout: str, html: str = "html") -> DataFrame:
    """Table rows of every page, next to the page's other columns.

    Adds ``row_no``, ``marked`` (labelled cells, or found through a header) and
    ``cells``. Pages without the table give no rows.
    """
    keys = [c for c in pages.columns if c != html]
    schema = T.StructType(
        [pages.schema[c] for c in keys]
        + [
            T.StructField("row_no", T.LongType()),
            T.StructField("marked", T.BooleanType()),
            T.StructField("cells", _CELLS),
        ]
    )

    names = [*keys, "row_no", "marked", "cells"]

    def made(part: pa.RecordBatch, origin, numbers, marks, ends, labels, texts) -> pa.RecordBatch:
        cells = pa.StructArray.from_arrays([labels, texts], fields=list(_CELL))
        taken = [part.column(k).take(pa.array(origin, pa.int64())) for k in keys]
        found = [pa.array(numbers, pa.int64()), pa.array(marks, pa.bool_()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cells)]
        return pa.RecordBatch.from_arrays([*taken, *found], names=names)

    def scanned(part: pa.RecordBatch, chosen: list[int]) -> pa.RecordBatch:
        rows_of, texts_of = page_scan.LAYOUTS[layout], part.column(html)
        origin, numbers, marks, ends, labels, texts = [], [], [], [0], [], []
        for index in chosen:
            for number, mark, found in rows_of(texts_of[index].as_py() or ""):
                origin.append(index)
                numbers.append(number)
                marks.append(mark)
                labels += [label for label, _ in found]
                texts += [content for _, content in found]
                ends.append(len(texts))
        return made(part, origin, numbers, marks, ends, pa.array(labels, pa.string()), pa.array(texts, pa.string()))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, count in page_batch.parts(batch.column(html)):
                part = batch.slice(start, count)
                chosen = list(range(count))
                if layout in page_batch.LAYOUTS:
                    *found, chosen = page_batch.rows(part.column(html), layout)
                    yield made(part, *found)
                for first in range(0, len(chosen), _PAGES_AT_A_TIME):
                    yield scanned(part, [int(i) for i in chosen[first : first + _PAGES_AT_A_TIME]])

    return pages.select(*keys, html).mapInArrow(extract, schema)


def _cell(index: int) -> Column:
    """Text of a cell by position; empty when the row is shorter."""
    return F.coalesce(F.get(F.col("cells"), F.lit(index))["text"], F.lit(""))


def _last(condition) -> Column:
    """Text of the last cell that meets a condition; empty when none does."""
    return F.coalesce(F.try_element_at(F.filter("cells", condition), F.lit(-1))["text"], F.lit(""))


def _labelled(label: str) -> Column:
    return _last(lambda c: c["label"] == label)


def _score_cell() -> Column:
    def is_score(c):
        digits = F.trim(F.replace(c["text"], F.lit(fixed.DASH), F.lit("")))
        return (c["label"] == "") & F.contains(c["text"], F.lit(fixed.DASH)) & digits.rlike(r"^\d+$")

    return _last(is_score)


def schedule_games(rows: DataFrame, day_prefixes: list[str] | None = None) -> DataFrame:
    """Games from the rows of the ``schedule`` layout; rows under five cells are skipped.

    Labelled rows are read by label, others by position: with a dated third
    cell the score or opponent follows it, without one the sides stand side by
    side. ``day_prefixes`` names the days that mark a dated row.
    """
    prefixes = day_prefixes or fixed.DATED_CELL_PREFIXES
    third = _cell(2)
    dated = F.lit(False)
    for prefix in prefixes:
        dated = dated | F.contains(third, F.lit(prefix))
    scored = F.contains(_cell(3), F.lit(fixed.DASH)) & _cell(3).rlike(r"\d")

    def pick(labelled: Column, in_dated: Column, in_plain: Column) -> Column:
        return F.when(F.col("marked"), labelled).when(dated, in_dated).otherwise(in_plain)

    empty = F.lit("")
    league, home, away, status, venue, officials = (_labelled(label) for label in fixed.CELL_LABELS)
    keys = [c for c in rows.columns if c not in ("marked", "cells")]
    return rows.where(F.size("cells") >= 5).select(
        *keys,
        pick(league, _cell(0), _cell(0)).alias("league_name"),
        pick(home, _cell(1), _cell(1)).alias("home_team"),
        pick(away, F.when(scored, empty).otherwise(_cell(3)), _cell(2)).alias("away_team"),
        pick(_score_cell(), F.when(scored, _cell(3)).otherwise(empty), empty).alias("score"),
        pick(status, _cell(4), _cell(3)).alias("game_time"),
        pick(venue, _cell(5), _cell(4)).alias("field"),
        pick(officials, _cell(6), _cell(5)).alias("officials"),
        F.when(F.col("marked"), "modern").otherwise("legacy").alias("table_format"),
    )


def canonical_games(games: DataFrame, date: str, fetched: str) -> DataFrame:
    """Rows of :func:`schedule_games` as loose games, ready for :func:`touchline.operators.ingest.clean_games`.

    ``date`` and ``fetched`` name text columns: the day of the page and the
    stamp of its download.
    """
    home, away = text.score_parts(F.col("score"))
    nothing = F.lit(None).cast("string")
    game = F.struct(
        F.col(date).alias("date"),
        "home_team",
        "away_team",
        home.alias("home_score"),
        away.alias("away_score"),
        F.lit(False).alias("bad_score"),
        F.col("league_name").alias("league"),
        F.col("game_time").alias("time"),
        nothing.alias("url"),
        nothing.alias("type"),
        nothing.alias("status"),
        nothing.alias("headers"),
        F.col(fetched).alias("timestamp"),
    )
    return games.select(F.lit("flat").alias("shape"), game.alias("game"))


def event_games(rows: DataFrame) -> DataFrame:
    """Games from the rows of the ``events`` layout: start, end, description, field."""
    home, away = text.split_description(_cell(2))
    plain_home, plain_away = text.split_description(_cell(2), dash_too=False)
    keys = [c for c in rows.columns if c not in ("marked", "cells")]
    return rows.where(F.size("cells") >= 4).select(
        *keys,
        _cell(0).alias("start_time"),
        _cell(1).alias("end_time"),
        _cell(2).alias("description"),
        _cell(3).alias("field"),
        F.when(F.col("marked"), home).otherwise(plain_home).alias("home_team"),
        F.when(F.col("marked"), away).otherwise(plain_away).alias("away_team"),
    )


def grid_games(rows: DataFrame, league: Column | None = None) -> DataFrame:
    """Games from the rows of the ``grid`` layout.

    Six cells with the league last, or five when ``league`` is known from
    elsewhere, such as the file name. Rows without a readable date and time
    are skipped.
    """
    width = 6 if league is None else 5
    keys = [c for c in rows.columns if c not in ("marked", "cells")]
    stamp = text.grid_stamp(_cell(0), _cell(1))
    return (
        # A one-row inline, so that the filter does not make the stamp be read twice.
        rows.where(F.size("cells") >= width)
        .select(*keys, "cells", F.inline(F.array(F.struct(stamp.alias("_at")))))
        .where(F.col("_at").isNotNull())
        .select(
            *keys,
            F.date_format("_at", "yyyy-MM-dd").alias("date"),
            F.date_format("_at", "hh:mm a").alias("time"),
            _cell(2).alias("home_team"),
            _cell(3).alias("away_team"),
            _cell(4).alias("field"),
            (_cell(5) if league is None else league).alias("league_name"),
        )
    )


def league_of_file(path: str = "path") -> Column:
    """League named by ``league_schedule_<league>.html``."""
    return F.regexp_extract(path, r"league_schedule_([^/]*)\.html$", 1)
