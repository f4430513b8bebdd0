import datetime as dt

from tidewatch.operators.cooccur import attach_notes, cluster_count, co_occurrences
from tidewatch.options import CoOccurrenceOptions


def frame(spark):
    d = lambda day: dt.datetime(2024, 1, day, 6, 30)
    rows = [("A", d(1)), ("B", d(1)), ("A", d(2)), ("A", d(5)), ("C", d(5)),
            ("B", d(10)), ("C", d(12))]
    return spark.createDataFrame(rows, "metric string, timestamp timestamp_ntz")


def as_map(rows, with_date=True):
    if with_date:
        return {(r.metric, r.date.day): r.others for r in rows}
    return {r.metric: r.others for r in rows}


def test_same_date(spark):
    got = as_map(co_occurrences(frame(spark), CoOccurrenceOptions(0, "window")).collect())
    assert got == {("A", 1): ["B"], ("B", 1): ["A"], ("A", 2): [], ("A", 5): ["C"],
                   ("C", 5): ["A"], ("B", 10): [], ("C", 12): []}


def test_plus_minus_n_days(spark):
    got = as_map(co_occurrences(frame(spark), CoOccurrenceOptions(2, "window")).collect())
    assert got[("B", 10)] == ["C"] and got[("C", 12)] == ["B"]
    assert got[("A", 2)] == ["B"]           # B on day 1 is within 2 days
    assert got[("A", 5)] == ["C"]


def test_strict_last_date_wins(spark):
    for n in (0, 3):
        got = as_map(co_occurrences(frame(spark), CoOccurrenceOptions(n, "strict")).collect(),
                     with_date=False)
        assert got == {"A": ["C"], "B": ["A"], "C": ["A"]}


def test_notes_and_cluster_count(spark):
    df = frame(spark).withColumnRenamed("timestamp", "event_ts")
    out = attach_notes(df, CoOccurrenceOptions(0, "window")).collect()
    notes = {(r.metric, r.event_ts.day): r.correlation_note for r in out}
    assert notes[("A", 1)] == ("Note: this anomaly coincided with unusual movement in B on the "
                               "same date. This may indicate a related cause, or may be "
                               "coincidental - not confirmed causation.")
    assert notes[("A", 2)] == ""
    assert cluster_count(frame(spark)).collect()[0].clusters == 2
