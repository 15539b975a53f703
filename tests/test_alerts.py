"""Alerts with state: batch against a plain loop, stream against batch over several files."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ticket_topics.operators import monitor
from ticket_topics.streaming import alerts, ingest

START = datetime(2024, 1, 1)
RATES = "topic int, window_end timestamp, rate double"
THRESHOLD, QUIET = 0.006, 300


def plain(rows, quiet):
    """The changes of one topic from its windows over the threshold."""
    out, held = [], None
    for end, rate in sorted(rows):
        if held and (end - held[1]).total_seconds() > quiet:
            out.append(("cleared", held[1] + timedelta(seconds=quiet), held[0], held[2], held[3]))
            held = None
        if held is None:
            held = [end, end, rate, 1]
            out.append(("raised", end, end, rate, 1))
        else:
            held = [held[0], end, max(held[2], rate), held[3] + 1]
    if held:
        out.append(("cleared", held[1] + timedelta(seconds=quiet), held[0], held[2], held[3]))
    return out


def rows_of(df):
    return sorted((r.topic, r.state, r["at"], r.since, r.peak, r.n_windows) for r in df.collect())


def test_changes_are_those_of_a_plain_loop(spark):
    rng = random.Random(8)
    rows = []
    for topic in (0, 1, None):
        minutes = sorted(rng.sample(range(600), 120))
        rows += [(topic, START + timedelta(minutes=m), rng.choice([0.1, 0.3, 0.4, 0.5])) for m in minutes]
    df = spark.createDataFrame(rows, RATES)
    want = []
    for topic in (0, 1, None):
        hot = [(e, r) for t, e, r in rows if t == topic and r > 0.3]
        want += [(topic, *c) for c in plain(hot, 300)]
    got = [(r.topic, r.state, r["at"], r.since, r.peak, r.n_windows) for r in monitor.alert_changes(df, 0.3, 300).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_changes_at_the_bounds(spark):
    def at(*minutes):
        rows = [(0, START + timedelta(minutes=m), 0.4) for m in minutes]
        return monitor.alert_changes(spark.createDataFrame(rows, RATES), 0.3, 300)

    # a window that ends when the alert would be cleared goes on with it
    assert [c[1] for c in rows_of(at(0, 5))] == ["cleared", "raised"]
    assert len(rows_of(at(0, 6))) == 4
    open_one = monitor.alert_changes(
        spark.createDataFrame([(0, START, 0.4)], RATES), 0.3, 300, START + timedelta(minutes=4)
    )
    assert [c[1] for c in rows_of(open_one)] == ["raised"]
    assert rows_of(monitor.alert_changes(spark.createDataFrame([], RATES), 0.3, 300)) == []
    equal = spark.createDataFrame([(0, START, 0.3)], RATES)
    assert rows_of(monitor.alert_changes(equal, 0.3, 300)) == []


def test_stream_gives_the_changes_of_the_batch(spark, tmp_path):
    """Three arrivals by separate runs: the alert of a topic that falls silent after the
    first is cleared by a timer, one that goes on over an arrival is raised once."""
    rng = random.Random(4)
    schema = "ts timestamp, topic int"

    def arrival(name, begin, end, topics):
        rows = [(START + timedelta(seconds=rng.randrange(begin * 60, end * 60)), t) for t in topics]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        return rows

    def run():
        stream = ingest.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, "parquet")
        changes = alerts.stream_alerts(stream, threshold=THRESHOLD, quiet_seconds=QUIET)
        ingest.run_available(changes, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        return rows_of(spark.read.schema(changes.schema).parquet(str(tmp_path / "out")))

    seen = arrival("a", 0, 60, [0] * 40 + [1] * 40)
    first = run()
    assert first and all(c[0] in (0, 1) for c in first)
    seen += arrival("b", 60, 120, [1] * 40 + [2] * 10)
    run()
    seen += arrival("c", 120, 400, [1] * 60 + [2] * 60)
    last = run()
    assert set(first) <= set(last)  # what was said stands
    until = max(t for t, _ in seen) - timedelta(minutes=10)
    rates = monitor.topic_rates(spark.createDataFrame(seen, schema))
    want = monitor.alert_changes(rates.where(F.col("window_end") <= F.lit(until)), THRESHOLD, QUIET, until)
    assert last == rows_of(want)
    assert any(c[0] == 0 and c[1] == "cleared" for c in last)
