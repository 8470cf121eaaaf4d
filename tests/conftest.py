from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def harbour(spark):
    """Four tracks of two artists; the features are plane vectors, and three listeners overlap."""
    tracks = spark.createDataFrame(
        [
            (11, "harbour lights", "tide", "p11"),
            (14, "night ferry", "tide", "p14"),
            (17, "salt road", "marsh", "p17"),
            (23, "low water", "marsh", "p23"),
        ],
        "track_id long, name string, artist string, spotify_preview_url string",
    )
    features = spark.createDataFrame(
        [(11, [2.0, 0.0], ["tide"]), (14, [1.5, 0.5], ["tide"]), (17, [0.0, 1.0], ["marsh"]), (23, [-1.0, 0.5], [None])],
        "track_id long, dense array<double>, cats array<string>",
    )
    plays = [("ana", 11, 4), ("ana", 14, 2), ("bo", 14, 3), ("bo", 17, 1), ("cy", 17, 5), ("cy", 11, 1), ("di", 23, 2)]
    return tracks, features, listening(spark, plays)


def listening(spark, plays):
    rows = [(track, user, float(n)) for user, track, n in plays]
    return spark.createDataFrame(rows, "track_id long, user_id string, playcount double")
