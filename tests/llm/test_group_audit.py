"""What the audit of the vector groups must notice, and links between groups with full lists."""

from __future__ import annotations

import numpy as np
import pytest

from melodex.llm import embed_dedup
from melodex.llm.embed_dedup import audit_links, cuttings, embedding_groups

SCHEMA = "vec_id long, embedding array<float>"


def test_audit_is_not_decided_by_a_dense_group(spark):
    draw = np.random.default_rng(3)
    dense = np.eye(40)[0] + 0.001 * draw.standard_normal((300, 40))
    pairs = np.repeat(np.eye(40)[1:21], 2, axis=0)
    units = np.concatenate([dense, pairs])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    rows = [(i, 0 if i < 300 else i, [float(x) for x in unit]) for i, unit in enumerate(units)]
    recall, missed = audit_links(spark.createDataFrame(rows, "node long, component long, unit array<double>"), 0.9)
    assert recall == pytest.approx(300 / 340)
    assert {(r.a, r.b) for r in missed.collect()} == {(i, i + 1) for i in range(300, 340, 2)}


def touching():
    draw = np.random.default_rng(6)
    centres = np.zeros((2, 12))
    centres[:, 0], centres[1, 1] = (1, 0.92), (1 - 0.92**2) ** 0.5
    return np.concatenate([c + 0.002 * draw.standard_normal((60, 12)) for c in centres]).astype(np.float32)


def frame(spark, matrix):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], SCHEMA)


def test_groups_with_full_lists_are_joined(spark, monkeypatch):
    nothing = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(embed_dedup, "audit_links", lambda *args: (1.0, nothing))  # as if it had seen none
    rows = embedding_groups(frame(spark, touching())).collect()
    assert {(r.component_id, r.n_links) for r in rows} == {(0, 119)}


def test_groups_fail_loudly(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "RECALL", 2.0)
    monkeypatch.setattr(embed_dedup, "ATTEMPTS", 1)
    with pytest.raises(RuntimeError, match="audited links"):
        embedding_groups(frame(spark, touching()))


def test_cuttings_grow_with_their_bits():
    alike = 1 - np.arccos(0.9) / np.pi
    for bits in (1, 8, 18):
        assert 1 - (1 - alike**bits) ** cuttings(bits, 0.9) >= 0.99
