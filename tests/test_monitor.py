"""Request metrics in batch and as a stream."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from melodex.session import new_folder
from melodex.sources.schemas import REQUEST_SCHEMA
from melodex.streaming import monitor

START = dt.datetime(2024, 1, 1, 12, 0, tzinfo=dt.timezone.utc)


def _request(seconds, model="hybrid", status="success", latency=0.2, n=10):
    return (START + dt.timedelta(seconds=seconds), model, status, latency, n)


def _requests(spark, rows):
    return spark.createDataFrame(rows, REQUEST_SCHEMA)


def test_rate_counts_each_request_in_ten_windows(spark):
    rows = monitor.request_rate(_requests(spark, [_request(0), _request(29.9), _request(30)])).collect()
    counts = {(r.window_start - START.replace(tzinfo=None)).total_seconds(): r.n_requests for r in rows}
    assert counts[0] == 3 and counts[-270] == 2 and counts[30] == 1 and len(counts) == 11
    assert all(r.per_second == r.n_requests / 300 for r in rows)


def test_quantiles_interpolate_inside_the_bucket(spark):
    rows = [_request(i, latency=0.2) for i in range(4)] + [_request(5, latency=30.0)]
    window = monitor.latency_quantiles(_requests(spark, rows)).filter(F.col("n_requests") == 5).first()
    assert window.p50 == pytest.approx(0.1 + 0.15 * 2.5 / 4)
    assert window.p99 == 10.0  # beyond the last bound


def test_in_flight(spark):
    day = 86_400
    rows = [_request(0, latency=45.0), _request(10, latency=5.0), _request(day, latency=1.0)]
    steps = {r.step_end: r.in_flight for r in monitor.in_flight(_requests(spark, rows)).collect()}
    assert [n for _, n in sorted(steps.items())] == [1, 0, 0]
    assert monitor.net_flight(_requests(spark, rows)).first().in_flight == 0


def test_gauge_returns_to_zero_and_latency_counts_successes(spark):
    rows = [_request(0, latency=None, status="error"), _request(5, latency=40.0, status="error"), _request(9, latency=0.2)]
    requests = _requests(spark, rows)
    steps = [r.in_flight for r in monitor.in_flight(requests).orderBy("step_end").collect()]
    assert steps == [1, 0] and monitor.net_flight(requests).first().in_flight == 0
    running = requests.union(_requests(spark, [_request(12, latency=None, status=None)]))
    assert monitor.net_flight(running).first().in_flight == 1
    assert [r.in_flight for r in monitor.in_flight(running).orderBy("step_end").collect()] == [2, 1]
    assert {r.n_requests for r in monitor.latency_quantiles(requests).collect()} == {1}


def test_open_windows_complete_what_a_stream_wrote(spark):
    requests = _requests(spark, [_request(s) for s in (0, 100, 400, 1300, 1310)])
    whole = monitor.request_rate(requests)
    closed = whole.filter(F.col("window_end") <= F.lit(START + dt.timedelta(seconds=710)))
    rest = monitor.open_windows(requests, monitor.request_rate, closed)
    assert sorted(closed.union(rest).collect()) == sorted(whole.collect())
    assert monitor.open_windows(requests, monitor.request_rate, whole.limit(0)).count() == whole.count()


def test_errors_and_served(spark):
    requests = _requests(spark, [_request(0), _request(1, status="error", n=None), _request(2, model="content_based", n=5)])
    errors = {r.model_type: r.error_ratio for r in monitor.error_ratio(requests).collect()}
    assert errors == {"hybrid": 0.5, "content_based": 0.0}
    served = {r.model_type: r.n_served for r in monitor.recommendations_served(requests).collect()}
    assert served == {"hybrid": 10, "content_based": 5}


def test_stream_drops_late_requests_and_holds_open_windows(spark):
    """Files in order: out of order within the lateness counts, beyond it does not. Spark compares late rows
    with the watermark of the batch before, hence the third file."""
    source = new_folder(spark, "source")
    files = [[_request(0), _request(300)], [_request(1200), _request(900)], [_request(1300)], [_request(0), _request(3000)]]
    for rows in files:
        _requests(spark, rows).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    out = new_folder(spark, "windows")
    metric = monitor.request_rate(monitor.with_lateness(stream))
    monitor.write_windows(metric, out, new_folder(spark, "progress")).awaitTermination(120)
    found = {(r.window_start, r.n_requests) for r in spark.read.parquet(out).collect()}
    on_time = _requests(spark, [_request(0), _request(300), _request(1200), _request(900), _request(1300), _request(3000)])
    closed = F.col("window_end") <= F.lit(START + dt.timedelta(seconds=3000 - 600))
    expected = {(r.window_start, r.n_requests) for r in monitor.request_rate(on_time).filter(closed).collect()}
    assert found == expected


def test_live_gauge_as_a_stream(spark):
    source = new_folder(spark, "source")
    _requests(spark, [_request(0), _request(1)]).write.parquet(source)
    stream = spark.readStream.schema(REQUEST_SCHEMA).parquet(source)
    query = (
        monitor.net_flight(stream).writeStream.format("memory").queryName("live_gauge").outputMode("complete")
        .option("checkpointLocation", new_folder(spark, "progress")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    assert spark.table("live_gauge").first().in_flight == 0


def test_live_gauge_survives_a_restart_and_a_batch_that_runs_twice(spark, tmp_path):
    source, out, progress = (f"{tmp_path}/{name}" for name in ("requests", "flight", "progress"))
    early = _requests(spark, [_request(s, latency=45.0) for s in (0, 20, 400)])
    late = _requests(spark, [_request(500, latency=1.0), _request(10, latency=40.0), _request(510, latency=None, status=None)])

    def run():
        stream = spark.readStream.schema(REQUEST_SCHEMA).parquet(source)
        monitor.write_flight(stream, out, progress).awaitTermination()
        return sorted(map(tuple, monitor.stored_in_flight(spark, out).collect()))

    early.coalesce(1).write.parquet(source)
    assert run() == sorted(map(tuple, monitor.in_flight(early).collect()))
    late.coalesce(1).write.mode("append").parquet(source)
    whole = sorted(map(tuple, monitor.in_flight(early.union(late)).collect()))
    assert run() == whole and whole[-1][1] == 1
    # as if the query had died after it wrote its last batch and before it noted that
    for name in ("1", ".1.crc"):
        (tmp_path / "progress" / "commits" / name).unlink(missing_ok=True)
    assert run() == whole


def test_merged_sketches_keep_to_their_rank_error(spark):
    """5,000 requests in a window, sketched by model and in two stored parts."""
    rows = [_request(i % 290, ("hybrid", "content_based")[i % 3 == 0], latency=((i * 7919) % 5000) / 1000) for i in range(5000)]
    parts = [monitor.latency_sketches(_requests(spark, part), ["model_type"]) for part in (rows[:1500], rows[1500:])]
    merged = monitor.sketched_quantiles(parts[0].union(parts[1]))
    window = merged.filter(F.col("window_start") == F.lit(START)).first()
    assert window.n_requests == 5000
    for q, value in zip(monitor.QUANTILES, (window.p50, window.p95, window.p99)):
        assert abs(value / 5 - q) <= 2 * monitor.sketch_error()  # latencies are the ranks in thousandths
    by_model = monitor.sketched_quantiles(parts[0].union(parts[1]), keys=["model_type"])
    at_start = by_model.filter(F.col("window_start") == F.lit(START))
    assert {row.model_type: row.n_requests for row in at_start.collect()} == {"hybrid": 3333, "content_based": 1667}
    sizes = parts[1].select(F.max(F.length("sketch"))).first()[0]
    assert sizes < 8 * 3500 / 4  # of bounded size


def test_sketches_of_a_stream(spark):
    source, out = new_folder(spark, "source"), new_folder(spark, "windows")
    rows = [_request(s, latency=s / 1000, status="error" if s == 7 else "success") for s in range(600)] + [_request(5000)]
    _requests(spark, rows).write.parquet(source)
    stream = spark.readStream.schema(REQUEST_SCHEMA).parquet(source)
    metric = monitor.latency_sketches(monitor.with_lateness(stream))
    monitor.write_windows(metric, out, new_folder(spark, "progress")).awaitTermination(120)
    found = monitor.sketched_quantiles(spark.read.parquet(out)).filter(F.col("window_start") == F.lit(START)).first()
    assert found.n_requests == 299 and abs(found.p50 * 1000 / 299 - 0.5) <= 2 * monitor.sketch_error() + 0.01
