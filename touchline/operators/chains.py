"""Event chains of job runs: each event names the one before it; exits and failures belong to the state they came from.

A state is entered by an ``entered`` event. An ``exited`` or ``failed`` event
belongs to the entry reached by following previous-event links through other
exits and failures; a link to anything else (another kind of event, a missing
one, none) leaves it without a state, as does a cycle. The links are followed
by pointer jumping: every round, each open event either takes the answer of
the event it points at or jumps to that event's pointer, so a chain of length
L is resolved in about log2(L) rounds of one equi-join on (run, event id),
whatever the size of a run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import text
from touchline.sources.scratch import staged

#: Events per window when previous ids are taken in order: a hot run is cut into windows of this many ids.
ID_BUCKET = 1 << 16


def previous_in_run(log: DataFrame, run: str, order: str, bucket: int = ID_BUCKET) -> DataFrame:
    """``log`` with ``previous``: the ``order`` value of the row before in the same run (null for the first).

    Windows cover one run and ``bucket`` consecutive values of ``order``, so no
    task sorts a whole run; the first row of a window takes the last value of
    the nearest earlier window of its run from a table with one row per window.
    """
    window_of = F.floor(F.col(order) / bucket)
    inside = Window.partitionBy(run, "__window").orderBy(order)
    local = log.withColumn("__window", window_of).withColumn("previous", F.lag(order).over(inside))
    ends = local.groupBy(F.col(run).alias("__run"), "__window").agg(F.max(order).alias("__last"))
    ends = ends.select("__run", F.col("__window").alias("__w"), F.lag("__last").over(Window.partitionBy("__run").orderBy("__window")).alias("__before"))
    joined = local.join(ends, F.col(run).eqNullSafe(F.col("__run")) & (F.col("__window") == F.col("__w")), "left")
    return joined.select(*log.columns, F.coalesce("previous", "__before").alias("previous"))


def owners(log: DataFrame, entered: str, exited: str, failed: str) -> DataFrame:
    """Per event of the three kinds: (run_id, id, owner), owner being the id of its entry (null: none).

    ``log`` has run_id, id, previous and type. Pointer jumping as described
    above; what is still open after ceil(log2(events)) + 1 rounds lies on or
    behind a cycle and gets no owner.
    """
    kind = F.col("type")
    chain = log.where(kind.isin(entered, exited, failed))
    start = F.col("type") == entered
    state = chain.select(
        "run_id", "id",
        F.when(~start, F.col("previous")).alias("ptr"),
        F.when(start, F.col("id")).alias("owner"),
        (start | F.col("previous").isNull()).alias("done"),
    )
    state = staged(state, "chain-round")
    limit = math.ceil(math.log2(max(2, state.count()))) + 1
    for _ in range(limit):
        open_ = state.where(~F.col("done"))
        if open_.isEmpty():
            return state.select("run_id", "id", "owner")
        target = state.select(
            F.col("run_id").alias("__run"), F.col("id").alias("__id"), F.col("ptr").alias("__ptr"),
            F.col("owner").alias("__owner"), F.col("done").alias("__done"),
        )
        stepped = open_.join(target, F.col("run_id").eqNullSafe(F.col("__run")) & (F.col("ptr") == F.col("__id")), "left")
        # A missing target ends the walk without an owner.
        stepped = stepped.select(
            "run_id", "id",
            F.when(~F.col("__done"), F.col("__ptr")).alias("ptr"),
            F.when(F.col("__done"), F.col("__owner")).alias("owner"),
            F.coalesce(F.col("__done"), F.lit(True)).alias("done"),
        )
        state = staged(state.where(F.col("done")).unionByName(stepped), "chain-round")
    return state.select("run_id", "id", F.when(F.col("done"), F.col("owner")).alias("owner"))


def state_chain(log: DataFrame, entered: str, exited: str, failed: str) -> DataFrame:
    """One row per entry of a state, with the exits and failures charged to it.

    ``log`` has run_id, id, previous, type, state, timestamp, error and cause.
    Of the events charged to an entry, the last exit (by id) gives exited_at
    and the last failure failed_at, error and cause. Status: COMPLETED with an
    exit, else FAILED with a failure, else UNKNOWN; duration from entry to exit
    or failure (``N/A`` without). ``events`` counts the charged events. Every
    entry is kept, also one that re-enters a state.
    """
    resolved = owners(log, entered, exited, failed)
    resolved = resolved.where(F.col("owner").isNotNull()).select(F.col("run_id").alias("__r"), F.col("id").alias("__i"), "owner")
    charged = log.join(resolved, F.col("run_id").eqNullSafe(F.col("__r")) & (F.col("id") == F.col("__i"))).where(F.col("type") != entered)
    pick = lambda kind, *cols: F.max(F.when(F.col("type") == kind, F.struct("id", *cols)))
    marks = charged.groupBy(F.col("run_id").alias("__run"), "owner").agg(
        pick(exited, "timestamp").alias("x"), pick(failed, "timestamp", "error", "cause").alias("f"), F.count(F.lit(1)).alias("events")
    )
    entries = log.where(F.col("type") == entered)
    rows = entries.join(marks, F.col("run_id").eqNullSafe(F.col("__run")) & (F.col("id") == F.col("owner")), "left")
    end: Column = F.coalesce(F.col("x.timestamp"), F.col("f.timestamp"))
    return rows.select(
        "run_id", "state", F.col("id").alias("entered_id"), F.col("timestamp").alias("entered_at"),
        F.col("x.timestamp").alias("exited_at"), F.col("f.timestamp").alias("failed_at"),
        F.when(F.col("x").isNotNull(), "COMPLETED").when(F.col("f").isNotNull(), "FAILED").otherwise("UNKNOWN").alias("status"),
        F.coalesce(text.duration_text(text.seconds_between(F.col("timestamp"), end)), F.lit("N/A")).alias("duration"),
        F.col("f.error").alias("error"), F.col("f.cause").alias("cause"), F.coalesce("events", F.lit(0)).alias("events"),
    )
