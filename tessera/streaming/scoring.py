"""Applying the fitted scorers to a stream.

The reference is batch-only; what carries over to Structured Streaming is
the *stateless* part: target standardisation, thresholded prediction and
model scoring are per-row column expressions / transformers, so they run
unchanged on a streaming DataFrame (``readStream`` -> ``score_stream`` ->
``writeStream``).  Aggregated metrics stay batch operators.
"""
from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.ml import evaluate as E
from tessera.ml.train import p_pass
from tessera.ml.trees import FEATURES


def score_stream(stream: DataFrame, model, feats: list[str], threshold: float) -> DataFrame:
    """Probability and thresholded label for each incoming row: of its ``features`` vector, else of the columns ``feats``."""
    if FEATURES not in stream.columns:
        stream = VectorAssembler(inputCols=feats, outputCol=FEATURES, handleInvalid="keep").transform(stream)
    return p_pass(model.transform(stream)).withColumn("prediction", E.threshold_label(F.col("p_pass"), threshold)) \
        .drop(FEATURES, "rawPrediction", "probability")
