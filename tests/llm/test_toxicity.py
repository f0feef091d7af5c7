"""Held-out accuracy on the given labels, and the shape of the risk."""

import os

import numpy as np
import pytest

from playtrail.llm.queries import llm_queries
from playtrail.llm.toxicity import learn

LARGE = "/root/testdata/sf0.1"


def test_learning_from_positive_and_unlabelled():
    draw = np.random.default_rng(0)
    clean = [draw.integers(10, 300, 20) for _ in range(900)]
    toxic = [np.append(draw.integers(10, 300, 20), draw.integers(0, 4, 2)) for _ in range(200)]
    model = learn(toxic[:100], clean + toxic[100:], 0.1, 512)
    assert (model.weights[:4] > 0).all() and np.abs(model.weights[10:]).max() < model.weights[:4].min()


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="the given tables are not here")
def test_held_out_labels(spark):
    scores = llm_queries()["op3_toxicity"](spark, LARGE)
    labels = spark.read.parquet(f"{LARGE}/labels.parquet")
    rows = scores.where("held_out").join(labels, "doc_id").select("toxic", "predicted", "score").collect()
    hits = [r.predicted for r in rows if r.toxic == 1]
    false = [r.predicted for r in rows if r.toxic == 0]
    # Of 305 toxic texts to learn from; ten times as many, as in larger tables, find over 95 in 100.
    assert np.mean(hits) > 0.8 and np.mean(false) < 0.03
    assert all(0 <= r.score <= 1 for r in rows)
