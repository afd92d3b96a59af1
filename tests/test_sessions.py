"""Session and trace rules on hand-made tables."""

from __future__ import annotations

from opsfold.operators.sessions import (
    nest_flow,
    session_events,
    trace_flow_steps,
    trace_flows,
    user_session_steps,
    user_sessions,
)
from tests.helpers import log, logs_df, t


def _indices(df):
    return [r["session_index"] for r in df.orderBy("event_pos").collect()]


def test_boundary_exactly_timeout_continues(spark):
    df = logs_df(spark, [log(t(0, 0)), log(t(0, 30)), log(t(1, 0, 1))])
    assert _indices(session_events(df)) == [1, 1, 2]


def test_sub_second_gap_uses_whole_seconds(spark):
    df = logs_df(spark, [log(t(0, 0, 0, 100_000)), log(t(0, 30, 0, 900_000))])
    assert _indices(session_events(df)) == [1, 1]


def test_ties_and_null_timestamps(spark):
    df = logs_df(spark, [log(None), log(None), log(t(0, 0)), log(t(0, 0)), log(t(0, 30)),
                         log(t(1, 0, 1))])
    assert _indices(session_events(df)) == [1, 2, 3, 3, 3, 4]


def test_session_id_text(spark):
    df = logs_df(spark, [log(t(0, 0), user="u"), log(t(5, 0), user="u")])
    ids = sorted(r["session_id"] for r in user_sessions(df).collect())
    assert ids == ["u-00000001", "u-00000002"]


def test_null_keys_left_out(spark):
    df = logs_df(spark, [log(t(0, 0), user=None, trace=None), log(t(0, 1), user="a", trace="x")])
    assert trace_flows(df).count() == 1
    assert user_sessions(df).count() == 1
    assert session_events(df).count() == 1


def test_session_summary_values(spark):
    df = logs_df(spark, [log(t(0, 0), status=500, latency=1.0),
                         log(t(0, 10), status=200, latency=3.0),
                         log(t(0, 20), status=None, latency=None)])
    r = user_sessions(df).first()
    assert r["event_count"] == 3
    assert r["avg_latency_ms"] == 2.0
    assert r["p95_latency_ms"] == 3.0
    assert abs(r["error_rate"] - 1 / 3) < 1e-12
    assert r["session_start"] == t(0, 0) and r["session_end"] == t(0, 20)


def test_hot_user_split_equals_unsplit(spark):
    rows = [log(t(0, i * 7 % 50 + (i // 9) * 45), user="hot", latency=float(i)) for i in range(300)]
    rows += [log(t(0, i), user=f"c{i % 4}") for i in range(40)]
    df = logs_df(spark, rows)
    cols = ["user_id", "timestamp", "latency_ms", "event_pos", "session_index", "session_id",
            "prev_ts"]

    def canon(x):
        return sorted(tuple(str(v) for v in r) for r in x.select(*cols).collect())

    assert canon(session_events(df, target_rows=11)) == canon(session_events(df))
    a = sorted(tuple(r) for r in user_sessions(df, target_rows=11).collect())
    b = sorted(tuple(r) for r in user_sessions(df).collect())
    assert a == b


def test_hot_user_steps_equal_unsplit(spark):
    rows = [log(t(0, i * 7 % 50 + (i // 9) * 45), user="hot", latency=float(i)) for i in range(300)]
    rows += [log(t(0, i), user=f"c{i % 4}") for i in range(40)]
    df = logs_df(spark, rows)

    def canon(x):
        return sorted(tuple(str(v) for v in r) for r in x.collect())

    for target in (5, 11, 37):
        assert canon(user_session_steps(df, target_rows=target)) == canon(user_session_steps(df))
    starts = session_events(df, with_start=True)
    assert starts.where("session_start_pos > event_pos").count() == 0


def test_steps_and_nested_flow(spark):
    df = logs_df(spark, [log(t(0, 2), trace="x", endpoint="/b"),
                         log(t(0, 1), trace="x", endpoint="/a"),
                         log(t(0, 1), trace="x", endpoint="/0"),
                         log(t(3, 0), trace="y")])
    steps = {(r["trace_id"], r["step"]): r["endpoint"] for r in trace_flow_steps(df).collect()}
    assert steps == {("x", 1): "/0", ("x", 2): "/a", ("x", 3): "/b", ("y", 1): "/e"}
    nested = {r["trace_id"]: [e["endpoint"] for e in r["request_flow"]]
              for r in trace_flows(df, include_flow=True).collect()}
    assert nested == {"x": ["/0", "/a", "/b"], "y": ["/e"]}
    flows = nest_flow(df, ["trace_id"], ["timestamp", "endpoint"]).count()
    assert flows == 2


def test_session_steps_restart_per_session(spark):
    df = logs_df(spark, [log(t(0, 0)), log(t(0, 10)), log(t(2, 0)), log(t(2, 5))])
    got = sorted((r["session_id"], r["step"]) for r in user_session_steps(df).collect())
    assert got == [("u-00000001", 1), ("u-00000001", 2), ("u-00000002", 1), ("u-00000002", 2)]


def test_user_sessions_with_flow(spark):
    df = logs_df(spark, [log(t(0, 5), endpoint="/b"), log(t(0, 1), endpoint="/a")])
    r = user_sessions(df, include_flow=True).first()
    assert [e["endpoint"] for e in r["request_flow"]] == ["/a", "/b"]
