"""The toxicity model is fitted in a task, not in the driver's memory."""

import os
import sys

import numpy as np
from pyspark import cloudpickle

from quarry.llm import toxicity as TX


def _fake(counts, n_toxic, n_clean):
    assert n_toxic == 10 and n_clean == 20 and {u for u, _, _ in counts} >= {"bad", "fine"}
    return np.zeros(1 << TX.BITS, np.float32), float(os.getpid())


def test_fit_runs_in_a_task(spark, monkeypatch):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    monkeypatch.setattr(TX, "fit_words", _fake)
    sample = spark.createDataFrame([("bad", 1)] * 10 + [("fine words", 0)] * 20, "text string, toxic int")
    weights, offset = TX._fitted(sample)
    assert weights.shape == (1 << TX.BITS,) and offset not in (0.0, float(os.getpid()))


def test_no_model_without_toxic_rows(spark):
    assert TX._fitted(spark.createDataFrame([("fine words", 0)], "text string, toxic int")) is None
