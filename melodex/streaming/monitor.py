"""Request metrics over a request log. Each function takes a static table or a stream alike.

Requests are (ts, model_type, status, latency in seconds, n_recs). On a stream, call ``with_lateness`` first
and write with the append or update mode; a window is final once the watermark has passed its end.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# The range and step of the dashboard's queries, the quantiles it shows, and the upper bounds
# in seconds of the latency histogram (the last bucket is open).
RANGE, STEP, RANGE_SECONDS = "5 minutes", "30 seconds", 300
QUANTILES = (0.50, 0.95, 0.99)
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)

# size of a quantile sketch
SKETCH_SIZE = 200

LATENESS = "10 minutes"
SUCCESS = "success"


def with_lateness(requests: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return requests.withWatermark("ts", lateness)


def _windowed(requests: DataFrame, keys: Sequence[str], aggregates: dict[str, Column]) -> DataFrame:
    """Sums per sliding window. Requests are first summed per step, and a window adds the sums of its steps:
    a request enters one group rather than one for each of the windows it lies in."""
    steps = requests.groupBy(F.window("ts", STEP), *keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    ranges = steps.groupBy(F.window(F.window_time("window"), RANGE, STEP).alias("range"), *keys).agg(
        *[F.sum(n).alias(n) for n in aggregates]
    )
    return ranges.select(
        F.col("range.start").alias("window_start"), F.col("range.end").alias("window_end"), *keys, *aggregates
    )


def request_rate(requests: DataFrame) -> DataFrame:
    """Requests per second by model and status."""
    counted = _windowed(requests, ["model_type", "status"], {"n_requests": F.count("*")})
    return counted.withColumn("per_second", F.col("n_requests") / F.lit(float(RANGE_SECONDS)))


def latency_histogram(requests: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Successful requests per latency bucket, cumulative: ``le_0`` ... and all of them as ``n_requests``."""
    timed = requests.filter(F.col("latency").isNotNull() & (F.col("status") == SUCCESS))
    buckets = {f"le_{i}": F.count_if(F.col("latency") <= bound) for i, bound in enumerate(LATENCY_BOUNDS)}
    return _windowed(timed, list(keys), {**buckets, "n_requests": F.count("*")})


def _histogram_quantile(q: float) -> Column:
    """Linear inside the first bucket that reaches the rank; the highest bound beyond the last."""
    rank = F.lit(q) * F.col("n_requests")
    value = F.lit(LATENCY_BOUNDS[-1])
    for i in reversed(range(len(LATENCY_BOUNDS))):
        low = LATENCY_BOUNDS[i - 1] if i else 0.0
        below = F.col(f"le_{i - 1}") if i else F.lit(0)
        inside = F.col(f"le_{i}") - below
        width = LATENCY_BOUNDS[i] - low
        position = F.lit(low) + F.lit(width) * F.try_divide(rank - below, inside)
        value = F.when(F.col(f"le_{i}") >= rank, position).otherwise(value)
    return value


def latency_quantiles(
    requests: DataFrame, quantiles: Sequence[float] = QUANTILES, keys: Sequence[str] = ()
) -> DataFrame:
    """Latency quantiles from the bucket counts: a state of fixed size per window, however many requests."""
    histogram = latency_histogram(requests, keys)
    values = [_histogram_quantile(q).alias(f"p{round(q * 100)}") for q in quantiles]
    return histogram.select("window_start", "window_end", *keys, "n_requests", *values)


def latency_sketches(requests: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Successful requests and a quantile sketch of their latencies per window and key: ``n_requests``, ``sketch``.

    Unlike the histogram it needs no bounds known before. A sketch is of bounded size, and sketches of steps,
    keys or stored parts merge into those of the whole.
    """
    timed = requests.filter(F.col("latency").isNotNull() & (F.col("status") == SUCCESS))
    steps = timed.groupBy(F.window("ts", STEP), *keys).agg(
        F.count("*").alias("n_requests"), F.kll_sketch_agg_double("latency", F.lit(SKETCH_SIZE)).alias("sketch")
    )
    ranges = steps.groupBy(F.window(F.window_time("window"), RANGE, STEP).alias("range"), *keys)
    return _merged(ranges).select(
        F.col("range.start").alias("window_start"), F.col("range.end").alias("window_end"), *keys, "n_requests", "sketch"
    )


def _merged(groups: GroupedData) -> DataFrame:
    return groups.agg(
        F.sum("n_requests").alias("n_requests"),
        F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"),
    )


def sketched_quantiles(
    sketches: DataFrame, quantiles: Sequence[float] = QUANTILES, keys: Sequence[str] = ()
) -> DataFrame:
    """Latency quantiles of stored sketches, merged over all columns but the window and ``keys``."""
    windows = ["window_start", "window_end", *keys]
    values = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(f"p{round(q * 100)}") for q in quantiles]
    return _merged(sketches.groupBy(*windows)).select(*windows, "n_requests", *values)


def sketch_error(size: int = SKETCH_SIZE) -> float:
    """How far from the quantile asked for the rank of an estimate lies in 99 of 100 cases, as a share of all
    requests: the published fit for this sketch."""
    return 2.296 / size**0.9723


def recommendations_served(requests: DataFrame) -> DataFrame:
    """Recommendations returned, by model."""
    return _windowed(requests, ["model_type"], {"n_served": F.sum(F.coalesce("n_recs", F.lit(0)))})


def error_ratio(requests: DataFrame) -> DataFrame:
    counts = _windowed(
        requests, ["model_type"], {"n_errors": F.count_if(F.col("status") == "error"), "n_requests": F.count("*")}
    )
    return counts.withColumn("error_ratio", F.col("n_errors") / F.col("n_requests").cast("double"))


def flight_events(requests: DataFrame) -> DataFrame:
    """+1 when a request starts, -1 when it ends, both to the microsecond.

    A request with a status has ended: without a latency, it ends when it starts. One without a status is
    still running and has no end.
    """
    started = F.unix_micros("ts")
    lasted = F.coalesce(F.round(F.col("latency") * 1_000_000).cast("long"), F.lit(0).cast("long"))
    marks = F.array(
        F.struct(F.timestamp_micros(started).alias("at"), F.lit(1).alias("delta")),
        F.struct(F.timestamp_micros(started + lasted).alias("at"), F.lit(-1).alias("delta")),
    )
    ended = F.col("status").isNotNull()
    known = requests.filter(F.col("ts").isNotNull())
    return known.select(F.inline(F.when(ended, marks).otherwise(F.slice(marks, 1, 1))))


def flight_steps(requests: DataFrame, step: str = STEP) -> DataFrame:
    """Starts less ends, per step that saw one."""
    return flight_events(requests).groupBy(F.window("at", step)).agg(F.sum("delta").alias("delta"))


def in_flight(requests: DataFrame, step: str = STEP) -> DataFrame:
    """Requests in flight at the end of each step that saw a start or an end."""
    return _gauge(flight_steps(requests, step))


def _gauge(steps: DataFrame) -> DataFrame:
    """The running total of steps.

    It is taken per day and shifted by the totals of the days before, so no task sees more
    than a day of steps; the days themselves are few (one row each).
    """
    steps = steps.select(
        F.col("window.end").alias("step_end"), F.to_date("window.start").alias("day"), "delta"
    )
    days = steps.groupBy("day").agg(F.sum("delta").alias("day_delta"))
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.broadcast(
        days.select("day", F.coalesce(F.sum("day_delta").over(earlier), F.lit(0)).alias("carried"))
    )
    so_far = Window.partitionBy("day").orderBy("step_end").rowsBetween(Window.unboundedPreceding, 0)
    return steps.join(carried, "day").select(
        "step_end", (F.col("carried") + F.sum("delta").over(so_far)).alias("in_flight")
    )


def net_flight(requests: DataFrame) -> DataFrame:
    """Requests in flight now; on a stream written in the update or complete mode, the live gauge."""
    return flight_events(requests).agg(F.sum("delta").alias("in_flight"))


def write_flight(requests: DataFrame, path: str, checkpoint: str, step: str = STEP) -> StreamingQuery:
    """Start a query that keeps the gauge's steps up to date and stops when the source is read through.

    Each batch stores the sums of its own steps in a folder of its number. A batch that runs again after a failure
    has the same requests and replaces its folder, so nothing counts twice. The query holds no state and
    has no watermark: a late request corrects the steps it belongs to.
    """

    def store(batch: DataFrame, number: int) -> None:
        flight_steps(batch, step).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        requests.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_in_flight(spark: SparkSession, path: str) -> DataFrame:
    """The gauge from what ``write_flight`` has stored so far; also while it runs."""
    stored = spark.read.schema("window struct<start: timestamp, end: timestamp>, delta long").parquet(path)
    return _gauge(stored.groupBy("window").agg(F.sum("delta").alias("delta")))


def open_windows(
    requests: DataFrame, metric: Callable[[DataFrame], DataFrame], closed: DataFrame
) -> DataFrame:
    """The windows a finished stream has not written yet, from the stored requests of its last minutes.

    A stream writes all windows up to its watermark; those that end later are computed from the table it
    has read through.
    """
    last = closed.agg(F.max("window_end")).first()[0]
    if last is None:
        return metric(requests)
    end = F.lit(last)
    recent = requests.filter(F.col("ts") >= end - F.expr(f"INTERVAL {RANGE}"))
    return metric(recent).filter(F.col("window_end") > end)


def write_windows(metrics: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start a query that appends closed windows to parquet and stops when the source is read through."""
    return (
        metrics.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
