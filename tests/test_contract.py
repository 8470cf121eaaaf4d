"""Every registered query against its oracle SQL on the smallest tables."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as contract  # noqa: E402
import check_oracle  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

# a query of each kind; tools/check_oracle.py runs all of them
SAMPLE = (
    "a1_csv_catalogue a8_load_artifacts b5_clean_data b8_seed_lookup b8_seed_lookup_by_name b10_route c5_sampled_users c8_tracks_without_history "
    "d2_matrix d4_dictionary_encode d12_null_ratio_top2 d16_matrix_stats e3_split_test g3_tfidf_weights g8_transform g8_transform_missing "
    "g10_feature_names h1_embedding_cosine h2_content h4_collab_filled h7_hybrid i5_collab j2_fuzzy_matches "
    "k1_request_rate k2_latency_quantiles_stream k3_in_flight k3_in_flight_stream j2_fuzzy_levenshtein d3_merged_sketches d15_duplicate_stats "
    "c1_bucketed h2_content_by_name k2_merged_sketches"
).split()
NAMES = sorted(contract.queries()) if os.environ.get("ALL_QUERIES") else SAMPLE


def test_names_agree():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, name):
    result = check_oracle.compare(spark, FOLDER, name)
    assert result.startswith("ok" if name in contract.oracle_sql() else "rows-only"), result


def test_entry(spark):
    assert contract.entry(spark).count() > 0
