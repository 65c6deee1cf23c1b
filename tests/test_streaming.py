from datetime import datetime, timedelta

from weftline.streaming import events


def test_closed_windows_equal_the_batch_counts(spark, tmp_path):
    begin = datetime(2025, 1, 1)
    rows = [(i, begin + timedelta(hours=i * 5), i % 3, "ab"[i % 2], float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double")
    df.coalesce(1).write.parquet(str(tmp_path / "in" / "events.parquet"))
    events.run_once(events.windowed(_stream(spark, tmp_path)), str(tmp_path / "out"), str(tmp_path / "state"))
    got = {(r.start, r.event_type): (r.n, r.total) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    newest = max(r[1] for r in rows)
    want = {}
    for _, ts, _, kind, value in rows:
        day = ts.replace(hour=0)
        if day + timedelta(days=3) <= newest:
            n, total = want.get((day, kind), (0, 0.0))
            want[day, kind] = (n + 1, total + value)
    assert got == want


def _stream(spark, tmp_path):
    folder = str(tmp_path / "in" / "events.parquet")
    return events.read(spark, folder, "*.parquet")


def test_sessions_and_first_seen(spark, tmp_path):
    begin = datetime(2025, 1, 1)
    rows = [(1, begin, 7, "a", 1.0), (1, begin + timedelta(minutes=1), 7, "a", 1.0), (2, begin + timedelta(minutes=20), 7, "a", 1.0), (3, begin + timedelta(hours=3), 7, "a", 1.0), (4, begin + timedelta(days=9), 8, "b", 1.0)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double").coalesce(1).write.parquet(str(tmp_path / "in" / "events.parquet"))
    stream = _stream(spark, tmp_path)
    events.run_once(events.sessions(stream), str(tmp_path / "s"), str(tmp_path / "sc"))
    assert sorted((r.user_id, r.n) for r in spark.read.parquet(str(tmp_path / "s")).collect()) == [(7, 1), (7, 3)]
    events.run_once(events.first_seen(stream, "event_id").select("event_id"), str(tmp_path / "f"), str(tmp_path / "fc"))
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "f")).collect()) == [1, 2, 3, 4]
