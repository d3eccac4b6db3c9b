"""Training, saving, loading and applying a classifier with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.functions.ratios import ratio_or_zero
from veritally.functions.scores import argmax_label
from veritally.functions.text import TOKEN
from veritally.operators.confusion import confusion_counts, f1_or_zero
from veritally.operators.splits import TRAIN, VALIDATION
from veritally.session import store_table
from veritally.sources.schema import require_columns

DEFAULT_FEATURES = 1 << 18
DEFAULT_REG_PARAMS = (0.001, 0.01, 0.1)


@dataclass(frozen=True)
class Training:
    """A fitted pipeline and the validation F1 of every candidate."""

    model: PipelineModel
    candidates: list[tuple[float, float]]
    best: float

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(reg, f1, reg == self.best) for reg, f1 in self.candidates]
        return spark.createDataFrame(rows, "reg_param double, val_f1 double, selected boolean")


def _term_counts(text: str, n_features: int) -> PipelineModel:
    """Tokens and their hashed counts; nothing in it depends on the data."""
    return PipelineModel(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=TOKEN, gaps=False),
            HashingTF(inputCol="_tokens", outputCol="_counts", numFeatures=n_features),
        ]
    )


def _validation_f1(
    models: Sequence[LogisticRegressionModel], validation: DataFrame
) -> list[float]:
    """F1 of each candidate's argmax label, all candidates in one pass."""
    scored = validation
    for i, m in enumerate(models):
        m = m.copy().setRawPredictionCol(f"raw_{i}").setProbabilityCol(f"p_{i}")
        scored = m.setPredictionCol(f"y_{i}").transform(scored)
        scored = scored.withColumn(f"hit_{i}", argmax_label(vector_to_array(f"raw_{i}")))
    counts = [
        F.struct(*confusion_counts(F.col("labels"), F.col(f"hit_{i}"))).alias(f"c{i}")
        for i in range(len(models))
    ]

    def f1(i: int) -> Column:
        tp, fp, fn = (F.col(f"c{i}.{c}") for c in ("tp", "fp", "fn"))
        return f1_or_zero(ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, tp + fn))

    row = scored.agg(*counts).select(*[f1(i).alias(f"f{i}") for i in range(len(models))]).first()
    return list(row)


def train_classifier(
    prepared: DataFrame,
    text: str = "text",
    reg_params: Sequence[float] = DEFAULT_REG_PARAMS,
    n_features: int = DEFAULT_FEATURES,
    max_iter: int = 20,
    parallelism: int = 1,
) -> Training:
    """Fit on the train split, keep the candidate with the best validation F1.

    Candidates differ in regularisation; the first of equals wins. Rows are not
    weighted by class. Texts are read and tokenised once: their term counts are
    written to the shared folder, whence a lost executor costs none of that work.
    ``parallelism`` candidates are fitted at a time, each over its own copy of the
    train vectors, so by default one.
    """
    require_columns(prepared, [text, "labels", "split"])
    if not reg_params:
        raise ValueError("no candidate given")
    rows = prepared.select(text, "labels", "split").where(F.col("split").isin(TRAIN, VALIDATION))
    counter = _term_counts(text, n_features)
    counts = store_table(
        counter.transform(rows).select("split", "labels", "_counts"), "term_counts"
    )
    in_train = F.col("split") == TRAIN
    learner = LogisticRegression(
        labelCol="labels", featuresCol="features", family="binomial", maxIter=max_iter
    )
    grid = [{learner.regParam: r} for r in reg_params]
    weights = IDF(inputCol="_counts", outputCol="features").fit(counts.where(in_train))
    vectors = weights.transform(counts).drop("_counts")
    with ThreadPool(min(parallelism, len(grid))) as pool:
        fitted = learner.fitMultiple(vectors.where(in_train), grid)
        fit_next = inheritable_thread_target(counts.sparkSession)(lambda _: next(fitted))
        models = [m for _, m in sorted(pool.map(fit_next, grid), key=lambda pair: pair[0])]
    scores = _validation_f1(models, vectors.where(~in_train))
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    model = PipelineModel(stages=[*counter.stages, weights, models[best]])
    return Training(model, list(zip(map(float, reg_params), scores)), float(reg_params[best]))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """Load a saved pipeline once; it then travels with the plan."""
    try:
        spark.read.text(f"{path.rstrip('/')}/metadata")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no model at {path}; train one first") from error
        raise
    return PipelineModel.load(path)


class ModelScorer:
    """Adds ``logits`` and ``toxic_prob`` with a fitted pipeline.

    Spark's raw prediction of two classes is ``[-m, m]`` with ``sigmoid(m)`` as probability.
    Half of it is published, so that the softmax of ``logits`` is ``toxic_prob``.
    """

    def __init__(self, model: PipelineModel, text: str = "text"):
        self.model, self.text = model, text

    def __call__(self, df: DataFrame) -> DataFrame:
        made = ("_tokens", "_counts", "features", "rawPrediction", "probability", "prediction")
        clash = sorted(set(made) & set(df.columns))
        if clash:
            raise ValueError(f"columns {clash} would be overwritten by the model")
        return (
            self.model.transform(df)
            .withColumn("logits", F.transform(vector_to_array("rawPrediction"), lambda m: m / 2))
            .withColumn("toxic_prob", vector_to_array("probability")[1])
            .drop(*made)
        )
