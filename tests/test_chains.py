from datetime import datetime, timedelta

from touchline.operators import chains

AT = datetime(2024, 1, 1)
SCHEMA = "run_id string, state string, id bigint, previous bigint, timestamp timestamp_ntz, type string, error string, cause string"


def event(run, state, id_, previous, second, kind, error=None):
    return (run, state, id_, previous, AT + timedelta(seconds=second), kind, error, error and f"cause {error}")


def test_failure_is_charged_to_the_state_it_came_from(spark):
    log = spark.createDataFrame(
        [
            event("r", "A", 1, None, 0, "in"), event("r", "B", 2, None, 5, "in"),
            event("r", None, 3, 1, 10, "bad", "E1"), event("r", None, 4, 3, 70, "out"),  # A: failed, then left
            event("r", None, 5, 2, 65, "bad", "E2"),  # B: failed
            event("r", None, 6, 99, 1, "out"), event("r", None, 7, None, 1, "bad"),  # missing target, no link
            event("r", None, 8, 9, 1, "out"), event("r", None, 9, 8, 1, "bad"),  # a cycle
            event("r", "C", 10, None, 0, "in"), event("q", None, 11, 10, 0, "out"),  # other run
            event(None, "D", 12, None, 0, "in"), event(None, None, 13, 12, 3, "bad", "E3"),  # null run
            event("r", "A", 14, None, 100, "in"),  # re-entry: its own row
        ],
        SCHEMA,
    )
    rows = {r.entered_id: r for r in chains.state_chain(log, "in", "out", "bad").collect()}
    got = {k: (r.state, r.status, r.duration, r.error, r.events) for k, r in rows.items()}
    assert got == {
        1: ("A", "COMPLETED", "1m 10s", "E1", 2), 2: ("B", "FAILED", "1m 0s", "E2", 1), 10: ("C", "UNKNOWN", "N/A", None, 0),
        12: ("D", "FAILED", "0m 3s", "E3", 1), 14: ("A", "UNKNOWN", "N/A", None, 0),
    }
    owners = {r.id: r.owner for r in chains.owners(log, "in", "out", "bad").collect()}
    assert owners[8] is None and owners[9] is None and owners[6] is None and owners[11] is None and owners[4] == 1


def test_hot_run_long_chain_over_small_windows(spark):
    n = 3000
    rows = [("hot", "S", 0, None, AT, "in", None, None)] + [("hot", None, i, None, AT + timedelta(seconds=i), "bad" if i % 2 else "out", f"E{i}", "c") for i in range(1, n)]
    log = spark.createDataFrame(rows, SCHEMA).drop("previous")
    linked = chains.previous_in_run(log, "run_id", "id", bucket=64)
    assert {(r.id, r.previous) for r in linked.collect()} == {(i, i - 1 if i else None) for i in range(n)}
    (row,) = chains.state_chain(linked, "in", "out", "bad").collect()
    assert (row.events, row.status, row.error) == (n - 1, "COMPLETED", f"E{n - 1}")


def test_empty_log(spark):
    log = spark.createDataFrame([], SCHEMA)
    assert chains.state_chain(log, "in", "out", "bad").count() == 0
