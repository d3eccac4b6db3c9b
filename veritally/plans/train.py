"""The training run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.operators.confusion import core_metrics
from veritally.operators.splits import VALIDATION
from veritally.plans.model import (
    DEFAULT_FEATURES,
    DEFAULT_REG_PARAMS,
    ModelScorer,
    Training,
    save_model,
    train_classifier,
)
from veritally.plans.prepare import prepare_rows, split_corpus
from veritally.sinks.reports import write_json


def run_training(
    corpus: DataFrame,
    model_dir: str,
    metrics_dir: str,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxicity",
    normalize: bool = True,
    reg_params: Sequence[float] = DEFAULT_REG_PARAMS,
    n_features: int = DEFAULT_FEATURES,
    **split_options,
) -> Training:
    """Prepare, fit, keep the best candidate, save it and its validation metrics."""
    prepared = prepare_rows(split_corpus(corpus, key, **split_options), text, label, normalize)
    training = train_classifier(prepared, text, reg_params, n_features)
    save_model(training.model, model_dir)
    validation = prepared.where(F.col("split") == VALIDATION)
    metrics = core_metrics(ModelScorer(training.model, text)(validation))
    write_json(metrics, f"{metrics_dir.rstrip('/')}/train_metrics.json")
    return training
