import pytest
from pyspark.sql import functions as F

from marketlens.operators import cursor
from tests.helpers import one, utc

T0, T1, T2 = (utc(f"2026-05-01T10:0{i}:00") for i in range(3))
FEED_SCHEMA = "account_id bigint, api_type string, ts timestamp, key string"
CURSOR_SCHEMA = "account_id bigint, api_type string, cursor_timestamp timestamp, cursor_key string"


def _feed(spark, rows):
    return spark.createDataFrame([(1, "orders", t, k) for t, k in rows], FEED_SCHEMA)


def _cursor(spark, at, key):
    return spark.createDataFrame([(1, "orders", at, key)], CURSOR_SCHEMA)


def _run(spark, rows, at, key):
    start, feed = _cursor(spark, at, key), _feed(spark, rows)
    kept = cursor.rows_after_cursor(feed, start, "ts", "key")
    after = one(cursor.advance_cursor(start, kept, "ts", "key"))
    return sorted(r.key for r in kept.collect()), after


def _at(row):
    return row.cursor_timestamp.astimezone().timestamp()


def test_rows_after_cursor(spark):
    kept, after = _run(spark, [(T0, "a"), (T0, "b"), (T1, "c")], T0, "a")
    assert kept == ["b", "c"]
    assert (_at(after), after.cursor_key, after.rows_kept) == (T1.timestamp(), "c", 2)


def test_second_page_goes_on(spark):
    rows = [(T0, "a"), (T0, "b"), (T1, "c"), (T2, "d")]
    kept, after = _run(spark, rows, T0, "a")
    assert kept == ["b", "c", "d"] and after.cursor_key == "d"


def test_cursor_without_a_key_keeps_its_own_time(spark):
    kept, after = _run(spark, [(T0, "a"), (T0, "b")], T0, None)
    assert kept == ["a", "b"] and after.cursor_key == "b"


def test_no_cursor_keeps_everything(spark):
    kept, after = _run(spark, [(T1, "b"), (T0, "z")], None, None)
    assert kept == ["b", "z"] and (_at(after), after.cursor_key) == (T1.timestamp(), "b")


def test_rows_are_compared_with_the_starting_cursor_only(spark):
    # An out-of-order page: the later row first, repeats kept.
    kept, _ = _run(spark, [(T2, "x"), (T1, "y"), (T1, "y")], T0, "a")
    assert kept == ["x", "y", "y"]


def test_nothing_new_leaves_the_cursor(spark):
    kept, after = _run(spark, [(T0, "a")], T1, "k")
    assert kept == [] and (_at(after), after.cursor_key, after.moved) == (T1.timestamp(), "k", False)


@pytest.mark.parametrize("limit, stuck", [(1, True), (2, False)])
def test_full_batch_without_progress_fails(spark, limit, stuck):
    start, feed = _cursor(spark, T0, "a"), _feed(spark, [(T0, "a")])
    kept = cursor.rows_after_cursor(feed, start, "ts", "key")
    limits = spark.createDataFrame([(1, "orders", limit)], "account_id bigint, api_type string, batch_limit int")
    report = cursor.progress_report(feed, cursor.advance_cursor(start, kept, "ts", "key"), limits)
    assert one(report).status == "noop"
    if stuck:
        with pytest.raises(RuntimeError, match="cursor did not advance"):
            cursor.require_progress(report)
    else:
        cursor.require_progress(report)


def test_initial_cursor(spark):
    configs = spark.createDataFrame(
        [(1, "orders", 30), (2, "orders", 7), (3, "orders", 1)],
        "account_id bigint, api_type string, lookback_days int",
    )
    state = spark.createDataFrame([(1, "orders", T0, "k"), (3, "orders", None, "k")], CURSOR_SCHEMA)
    now = F.lit("2026-06-10 12:00:00").cast("timestamp")
    found = cursor.initial_cursor(configs, state, now).selectExpr(
        "account_id", "cast(cursor_timestamp as string) t", "cursor_key"
    )
    assert [tuple(r) for r in found.orderBy("account_id").collect()] == [
        (1, "2026-05-01 10:00:00", "k"),
        (2, "2026-06-03 12:00:00", None),
        (3, "2026-06-09 12:00:00", None),
    ]


LINES = "account_id bigint, rrd_id bigint, date_from timestamp"
NOW = "2026-05-05 10:00:00"


def _settlement(spark, lines, key):
    cursors = spark.createDataFrame([(1, utc("2026-05-03T00:00:00"), key)],
                                    "account_id bigint, cursor_timestamp timestamp, cursor_key string")
    now = F.lit(NOW).cast("timestamp")
    rows = spark.createDataFrame([(1, n, utc(t)) for n, t in lines], LINES)
    backlog = cursor.settlement_backlog(rows, cursors, now)
    return cursors, backlog, cursor.settlement_next_cursor(cursors, backlog, now), now


def test_settlement_window(spark):
    cursors, backlog, after, now = _settlement(
        spark,
        [(1, "2026-05-02T20:59:59"), (2, "2026-05-02T21:00:00"), (3, "2026-05-05T20:59:59"), (4, "2026-05-05T21:00:00")],
        None,
    )
    first, last = cursor.settlement_window(F.col("cursor_timestamp"), now)
    window = cursors.select(first.cast("string"), last.cast("string")).first()
    assert tuple(window) == ("2026-05-02 21:00:00", "2026-05-05 20:59:59")
    assert sorted(r.rrd_id for r in backlog.collect()) == [2, 3]
    row = after.selectExpr("cast(cursor_timestamp as string) t", "cursor_key", "rows_written", "status").first()
    assert tuple(row) == ("2026-05-04 21:00:00", None, 2, "success")
    assert one(cursor.checkpoint(backlog)).cursor_key == "3"


def test_settlement_resumes_behind_its_checkpoint(spark):
    _, backlog, _, _ = _settlement(spark, [(n, "2026-05-04T00:00:00") for n in (122, 123, 124)], "123")
    assert [r.rrd_id for r in backlog.collect()] == [124]


def test_settlement_without_lines_is_a_noop_that_still_moves(spark):
    _, _, after, _ = _settlement(spark, [], "")
    row = one(after)
    assert (row.status, row.rows_written, row.cursor_key) == ("noop", 0, None)
    assert row.cursor_timestamp is not None
