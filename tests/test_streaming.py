"""Incremental aggregates over several micro-batches equal the batch models."""

from __future__ import annotations

import datetime as dt

from casekit.operators.staging import stg_case_events, stg_interactions
from casekit.operators.timings import first_response_min, interaction_stats
from casekit.plans.pipeline import scratch_path
from casekit.sources import bindings
from casekit.streaming import incremental

SF = "/root/testdata/sf0.01"


def _split(spark, name, parts):
    """Copy a test table into ``parts`` files so the stream sees several batches."""
    folder = scratch_path(spark, f"split-{name}")
    bindings.read_table(spark, SF, name).repartition(parts).write.parquet(f"{folder}/{name}.parquet")
    return folder


def _rows(df, key="case_id"):
    return sorted(tuple(r) for r in df.orderBy(key).collect())


def test_first_response_over_many_batches(spark):
    src = _split(spark, "events", 4)
    table = scratch_path(spark, "t-first-response")
    events = stg_case_events(bindings.case_events_from(bindings.read_stream(spark, src, "events", 1)))
    q = incremental.run_partials(events, incremental._partial_first_response, table)
    q.awaitTermination()
    assert sorted(incremental._numbered(spark, f"{table}/batches")) == [0, 1, 2, 3]
    got = incremental.first_response_current(spark, table)
    exp = first_response_min(stg_case_events(bindings.case_events(spark, SF)))
    assert _rows(got) == _rows(exp)
    assert incremental.compact(spark, table, incremental._merge_first_response) == 3
    assert not incremental._numbered(spark, f"{table}/batches")
    assert _rows(incremental.first_response_current(spark, table)) == _rows(exp)


def test_interaction_stats_over_many_batches(spark):
    src = _split(spark, "lineitem", 3)
    table = scratch_path(spark, "t-interactions")
    inter = stg_interactions(bindings.interactions_from(bindings.read_stream(spark, src, "lineitem", 1)))
    q = incremental.run_partials(inter, incremental._partial_interactions, table)
    q.awaitTermination()
    got = {r.case_id: r for r in incremental.interaction_stats_current(spark, table).collect()}
    exp = {r.case_id: r for r in interaction_stats(stg_interactions(bindings.interactions(spark, SF))).collect()}
    assert got.keys() == exp.keys()
    for k, e in exp.items():
        g = got[k]
        assert (g.interaction_count, g.last_interaction_at) == (e.interaction_count, e.last_interaction_at)
        assert abs(g.avg_duration_minutes - e.avg_duration_minutes) < 1e-9


def test_replayed_batch_is_idempotent(spark):
    """Re-running a finished stream on the same checkpoint adds nothing."""
    table = scratch_path(spark, "t-replay")
    events = lambda: stg_case_events(bindings.case_events_from(bindings.read_stream(spark, SF, "events")))
    incremental.run_partials(events(), incremental._partial_first_response, table).awaitTermination()
    first = _rows(incremental.first_response_current(spark, table))
    incremental.run_partials(events(), incremental._partial_first_response, table).awaitTermination()
    assert _rows(incremental.first_response_current(spark, table)) == first
    assert isinstance(first[0][1], dt.datetime)


def test_new_files_are_processed_incrementally(spark):
    """A file landing after the first run is the only input of the second run."""
    events = bindings.read_table(spark, SF, "events")
    src = scratch_path(spark, "landing")
    first_half = events.filter("event_id % 2 = 0")
    second_half = events.filter("event_id % 2 = 1")
    first_half.coalesce(1).write.parquet(f"{src}/events.parquet")
    table = scratch_path(spark, "t-incremental")

    def run():
        stream = stg_case_events(bindings.case_events_from(bindings.read_stream(spark, src, "events")))
        incremental.run_partials(stream, incremental._partial_first_response, table).awaitTermination()

    run()
    assert sorted(incremental._numbered(spark, f"{table}/batches")) == [0]
    after_first = _rows(incremental.first_response_current(spark, table))
    assert after_first == _rows(first_response_min(stg_case_events(bindings.case_events_from(first_half))))

    second_half.coalesce(1).write.mode("append").parquet(f"{src}/events.parquet")
    run()
    assert sorted(incremental._numbered(spark, f"{table}/batches")) == [0, 1]
    exp = first_response_min(stg_case_events(bindings.case_events(spark, SF)))
    assert _rows(incremental.first_response_current(spark, table)) == _rows(exp)


def test_second_call_reads_only_new_files(spark):
    """The registered stream keeps its table; compaction between calls changes nothing."""
    events = bindings.read_table(spark, SF, "events")
    src = scratch_path(spark, "calls")
    events.filter("event_id % 3 = 0").coalesce(1).write.parquet(f"{src}/events.parquet")
    incremental.stream_first_response(spark, src)
    table = incremental._table(spark, src, "first-response")
    assert sorted(incremental._numbered(spark, f"{table}/batches")) == [0]
    incremental.stream_first_response(spark, src)
    assert sorted(incremental._numbered(spark, f"{table}/batches")) == [0]  # nothing new
    incremental.compact(spark, table, incremental._merge_first_response)
    events.filter("event_id % 3 <> 0").coalesce(1).write.mode("append").parquet(f"{src}/events.parquet")
    got = incremental.stream_first_response(spark, src)
    assert sorted(incremental._numbered(spark, f"{table}/batches")) == [1]
    assert _rows(got) == _rows(first_response_min(stg_case_events(bindings.case_events(spark, SF))))
