"""Boundaries and ends of the incremental readers: every row once, no tie split, loops that stop."""

from datetime import datetime, timedelta

import pytest
from weirflow.sources import incremental as inc

BASE = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def df(spark):
    # Ties of 7, a gap of two days, one row without cursor, rows after the cap.
    rows = [(i, BASE + timedelta(hours=i // 7 + (48 if i > 60 else 0))) for i in range(120)] + [(999, None)]
    return spark.createDataFrame(rows, "id int, ts timestamp_ntz").cache()


def drain(step, limit=60):
    seen, offset = [], {}
    for _ in range(limit):
        rows, end = step(offset)
        if end == offset:
            return seen, offset
        seen += [r["id"] for r in rows.collect()]
        offset = end
    raise AssertionError("the loop does not end")


def test_bounds(df):
    at = BASE + timedelta(hours=3)
    ids = lambda d: sorted(r["id"] for r in d.collect())
    assert ids(inc.cursor_scan(df, "ts", at, at + timedelta(hours=1))) == list(range(28, 35))
    assert 999 in ids(inc.cursor_scan(df, "ts", None, at)) and 999 not in ids(inc.cursor_scan(df, "ts", at))
    assert 999 in ids(inc.keep_undated(df, "ts", at)) and len(ids(inc.keep_undated(df, "ts", at))) == 120 - 21 + 1


@pytest.mark.parametrize("n", [5, 7, 40])
def test_keyset_drains_once(df, n):
    seen, end = drain(lambda o: inc.keyset_scan(df, "ts", "id", o, n, BASE + timedelta(hours=60)))
    assert sorted(seen) == [i for i in range(120) if i // 7 + (48 if i > 60 else 0) <= 60]


def test_keyset_refuses(df, spark):
    with pytest.raises(ValueError):
        inc.keyset_scan(df, "ts", None)
    bad = spark.createDataFrame([(None, BASE)], "id int, ts timestamp_ntz")
    with pytest.raises(ValueError):
        inc.keyset_scan(bad, "ts", "id")


def test_admit_keeps_ties(df):
    dated = df.filter("ts is not null")
    seen, end = [], None
    for _ in range(40):
        rows, offset = inc.admit_batch(dated, "ts", 10, end)
        got = [r["id"] for r in rows.collect()]
        if not got:
            break
        assert len(got) % 7 == 0 or 119 in got or 60 in got or 62 in got
        seen += got
        end = offset["cursor"]
    assert sorted(seen) == list(range(120))


@pytest.mark.parametrize("cap", [None, 8])
def test_windows_drain_once(df, cap):
    seen, end = drain(lambda o: inc.window_scan(df, "ts", o, 5 * 3600, BASE + timedelta(hours=70), cap), 200)
    assert sorted(seen) == list(range(120)) and inc._moment(end["cursor"]) == BASE + timedelta(hours=70)


def test_multi_window(df):
    cap = BASE + timedelta(hours=70)
    rows, end = inc.multi_window_scan(df, "ts", {"cursor": str(BASE - timedelta(hours=1))}, 3600, cap, 20)
    assert rows.count() == 21 and inc._moment(end["cursor"]) == BASE + timedelta(hours=2)
    rows, end = inc.multi_window_scan(df, "ts", {"cursor": str(BASE + timedelta(hours=10))}, 3600, BASE + timedelta(hours=40), 20)
    assert rows.count() == 0 and end == {"cursor": str(BASE + timedelta(hours=10))}
    seen, _ = drain(lambda o: inc.multi_window_scan(df, "ts", o, 3600, cap, 20) if o.get("cursor") != str(cap) else (df.limit(0), o))
    assert sorted(seen) == list(range(120))


def test_next_offset(df):
    top = lambda **k: inc.next_offset(df, "ts", **k).head()["cursor"]
    last = BASE + timedelta(hours=17 + 48 - 1 + 0)
    assert top() == BASE + timedelta(hours=119 // 7 + 48) and top(init_cap=last) == min(last, top())
    assert top(current="2030-01-01 00:00:00") == datetime(2030, 1, 1)
    empty = df.limit(0)
    assert inc.next_offset(empty, "ts", current=BASE).head()["cursor"] == BASE
    assert not inc.caught_up(df, "ts", top()) and inc.caught_up(df, "ts", "2031-01-01")


def test_two_part_offset(df):
    cap = BASE + timedelta(hours=30)
    dated = df.filter("ts is not null")
    seen, end = drain(lambda o: inc.two_part_offset(dated, "ts", o, 25, cap))
    assert sorted(seen) == list(range(120)) and end == {"start_time": str(cap)}


def test_limit_plus_one(df):
    rows, end, cut = inc.limit_plus_one(df, "ts", "id", 10, None, BASE + timedelta(hours=5))
    assert rows.count() == 10 and cut and end == {"cursor": "2024-01-01 01:00:00"}
    rows, end, cut = inc.limit_plus_one(df, "ts", "id", 500, None, BASE + timedelta(hours=5))
    assert rows.count() == 120 and not cut and end == {"cursor": "2024-01-01 05:00:00"}
    rows, end, cut = inc.limit_plus_one(df.limit(0), "ts", "id", 5, None, BASE)
    assert rows.count() == 0 and end == {"cursor": "2024-01-01 00:00:00"}


def test_hours_and_days(df):
    rows, end = inc.hourly_window_scan(df, "ts", {}, 4, 2, BASE + timedelta(hours=4, minutes=30))
    assert rows.count() == 21 and end == {"hour": str(BASE + timedelta(hours=3))}
    again, same = inc.hourly_window_scan(df, "ts", end, 4, 2, BASE + timedelta(hours=4, minutes=30))
    assert again.count() == 0 and same == end
    rows, end = inc.day_window_scan(df, "ts", {"day": "2024-01-03"}, 1, 2, "2024-01-09")
    assert end == {"day": "2024-01-04"} and rows.count() == df.filter("ts < timestamp_ntz'2024-01-04'").count()
    assert inc.day_window_scan(df, "ts", {"day": "2024-01-10"}, 1, 0, "2024-01-09")[1] == {"day": "2024-01-10"}


def test_slices(spark, df):
    assert inc.plan_time_partitions(spark, BASE, BASE).count() == 0
    one = inc.plan_time_partitions(spark, None, BASE).collect()
    assert len(one) == 1 and one[0]["lower"] is None
    parts = inc.plan_time_partitions(spark, BASE, BASE + timedelta(days=2, hours=5), 1).orderBy("lower").collect()
    assert [p["upper"] for p in parts[:-1]] == [p["lower"] for p in parts[1:]] and parts[-1]["upper"] == BASE + timedelta(days=2, hours=5)


def test_filter_ignored(df):
    with pytest.raises(ValueError):
        inc.assert_newer(df, "ts", "2040-01-01")
    inc.assert_newer(df, "ts", BASE)
    inc.assert_newer(df.filter("ts is null"), "ts", BASE)


def test_default_range():
    now = datetime(2024, 1, 10)
    assert inc.default_time_range(now) == (now - timedelta(minutes=60), now)
    assert inc.default_time_range(now, {"cursor": "2024-01-09 00:00:00"}, max_window_minutes=60) == (datetime(2024, 1, 9), datetime(2024, 1, 9, 1))
    assert inc.default_time_range(now, None, "2025-01-01", "2026-01-01") == (now, now)


def test_lookback():
    assert inc.lookback("2024-01-10 00:00:00", seconds=300) == "2024-01-09 23:55:00" and inc.lookback(None, days=1) is None


def test_bins_cover_weights(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else 1.0) for i in range(100)], "i int, w double")
    got = inc.balance_bins(df, "w", "i", 4).groupBy("bin").count().orderBy("bin").collect()
    assert [r["count"] for r in got] == [25] * 4
    assert inc.balance_bins(df.filter("i < 2"), "w", "i", 8).select("bin").distinct().count() == 2


def test_pushdown(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = inc.cursor_scan(ev, "ts", "2024-01-08", "2024-01-09").select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan
    assert "value" not in plan.split("ReadSchema")[1]
