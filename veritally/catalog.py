"""Every operator as a query over the given tables.

A query takes a session and the folder of the tables and returns a DataFrame.
Where an operator judges scores, the scores come from a hash of the document id
(:func:`~veritally.functions.scores.fixture_probability`), so that SQL can
recompute them; queries named after a model use a trained one.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from veritally.functions.hashing import hash32
from veritally.functions.scores import class_name, fixture_probability, toxic_probability
from veritally.functions.text import normalize_text
from veritally.operators import align, confusion, curves, encode, mistakes, predict, probes, profile
from veritally.operators import prepare as prep
from veritally.operators import selection, slices, splits
from veritally.operators.batch_map import map_batches
from veritally.operators.user_metrics import evaluate_metrics
from veritally.plans.evaluate import run_evaluation
from veritally.plans.model import ModelScorer, Training, load_model, save_model, train_classifier
from veritally.plans.prepare import prepare_rows, split_corpus
from veritally.plans.scoring import PythonScorer, score_texts
from veritally.session import scratch_path
from veritally.sinks.reports import slices_document, write_csv, write_json
from veritally.sources import csv
from veritally.sources.corpus import load_labelled, read_splits, read_table
from veritally.sources.probes import load_probes
from veritally.streaming.scoring import read_requests, score_stream, start_scoring

Query = Callable[[SparkSession, str], DataFrame]

THRESHOLD = 0.5
ENCODED_LENGTH = 128
VOCABULARY = 5000
LARGE_VOCABULARY = 400_000
CURVE_POINTS = 200
#: Bytes of the documents table to one CSV file, several ranges of it.
CSV_FILE_BYTES = 256 << 20


# Inputs -------------------------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def user_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turns.where(F.col("role") == "user").select("conv_id", "turn", "text")


def corpus(spark: SparkSession, sf_dir: str, *columns: str | Column) -> DataFrame:
    """Labelled documents with the given columns, which are taken before the join."""
    texts = documents(spark, sf_dir).select("doc_id", *columns)
    return load_labelled(texts, labels(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str, *columns: str | Column) -> DataFrame:
    return corpus(spark, sf_dir, *columns).withColumnRenamed("toxicity", "labels")


def scored(spark: SparkSession, sf_dir: str, *columns: str | Column) -> DataFrame:
    """Labelled documents with the fixture score."""
    return fixture_scorer(labelled(spark, sf_dir, *columns))


def fixture_scorer(df: DataFrame) -> DataFrame:
    return df.withColumn("toxic_prob", fixture_probability(F.col("doc_id"), F.col("labels")))


def with_logits(df: DataFrame) -> DataFrame:
    return df.withColumn("logits", F.array(1 - F.col("toxic_prob"), F.col("toxic_prob")))


def split_labelled(spark: SparkSession, sf_dir: str, *columns: str | Column) -> DataFrame:
    return splits.assign_splits(labelled(spark, sf_dir, *columns))


def scored_probes(spark: SparkSession, sf_dir: str, *columns: str | Column) -> DataFrame:
    """Documents in the role of probes: the language is the category."""
    rows = scored(spark, sf_dir, F.col("lang").alias("category"), *columns)
    return probes.probe_results(rows.withColumnRenamed("labels", "expected_label"), THRESHOLD)


# Sources ------------------------------------------------------------------------


def q_load_labelled(spark, sf_dir):
    return corpus(spark, sf_dir, "text", "lang", "source")


def q_corpus_csv_round_trip(spark, sf_dir):
    """The labelled corpus written as CSV, its columns reordered, and read back by name."""
    path = scratch_path(spark, "corpus_csv")
    write_csv(corpus(spark, sf_dir, "text", "source").select("toxicity", "source", "text", "doc_id"), path)
    return read_table(spark, path, "csv", "doc_id long, text string, toxicity int")


def q_corpus_csv_ranges(spark, sf_dir):
    """Large files with line ends inside their fields, read in byte ranges.

    One file up to ``CSV_FILE_BYTES`` of documents, then one for each as many: a file is written by one task.
    """
    path = scratch_path(spark, "corpus_csv_ranges")
    stored = spark.read.format("binaryFile").load(f"{sf_dir}/documents.parquet").agg(F.sum("length")).first()[0]
    files = max(1, math.ceil((stored or 0) / CSV_FILE_BYTES))
    write_csv(corpus(spark, sf_dir, "text", "source").coalesce(files), path)
    wanted = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                         StructField("source", StringType()), StructField("toxicity", IntegerType())])
    return csv.read_by_name(spark, path, wanted, "corpus", whole_file_bytes=0)


def q_corpus_json_round_trip(spark, sf_dir):
    path = scratch_path(spark, "corpus_json")
    corpus(spark, sf_dir, "text").write.json(path)
    return read_table(spark, path, "json", "doc_id long, text string, toxicity int")


def q_supplied_splits(spark, sf_dir):
    """A corpus that comes in three tables keeps its splits."""
    root = scratch_path(spark, "supplied")
    names = F.element_at(F.array(*[F.lit(n) for n in ("train", "validation", "test")]), F.col("part") + 1)
    parts = corpus(spark, sf_dir, "text").withColumn("part", (F.col("doc_id") % 3).cast("int"))
    parts.withColumn("name", names).drop("part").write.partitionBy("name").parquet(root)
    came = read_splits(spark, {n: f"{root}/name={n}" for n in ("train", "validation", "test")})
    return split_corpus(came).select("doc_id", "split")


def q_probe_load(spark, sf_dir):
    rows = corpus(spark, sf_dir, "text", "lang", "source").select(
        "text",
        F.col("toxicity").alias("expected_label"),
        F.col("lang").alias("category"),
        F.col("source").alias("notes"),
    )
    path = scratch_path(spark, "probes")
    write_csv(rows, path)
    return load_probes(spark, path)


# Preparation --------------------------------------------------------------------


def q_normalize_text(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.select("doc_id", normalize_text(F.col("text")).alias("text"))


def _with_missing_labels(spark, sf_dir, *columns) -> DataFrame:
    """All documents; most of them have no label."""
    given = labels(spark, sf_dir).select("doc_id", F.col("toxic").alias("toxicity"))
    return documents(spark, sf_dir).select("doc_id", *columns).join(given, "doc_id", "left")


def q_clean_rows(spark, sf_dir):
    return prep.clean_rows(_with_missing_labels(spark, sf_dir, "text"))


def q_clean_drop_counts(spark, sf_dir):
    # Whether a text is blank is decided before the join, which then moves no text.
    rows = _with_missing_labels(
        spark, sf_dir, F.when(prep.has_content(F.col("text")), "x").alias("text")
    )
    return prep.clean_drop_counts(splits.assign_splits(rows))


def q_map_labels(spark, sf_dir):
    return prep.map_labels(corpus(spark, sf_dir))


def q_validate_inputs(spark, sf_dir):
    return prep.validate_inputs(user_turns(spark, sf_dir)).select("conv_id", "turn", "error_code")


def q_text_lengths(spark, sf_dir):
    docs = profile.with_text_lengths(documents(spark, sf_dir))
    return docs.select("doc_id", "char_len", "word_len")


# Splits and samples -------------------------------------------------------------


def q_train_val_test_split(spark, sf_dir):
    return split_labelled(spark, sf_dir)


def q_split_existing_test(spark, sf_dir):
    """English documents as the train split that came, all others as the test split."""
    came = F.when(F.col("lang") == "en", splits.TRAIN).otherwise(splits.TEST).alias("split")
    rows = labelled(spark, sf_dir, came)
    return splits.assign_splits(rows, present=(splits.TRAIN, splits.TEST))


def q_split_sizes(spark, sf_dir):
    return splits.split_sizes(split_labelled(spark, sf_dir))


def q_subsample(spark, sf_dir):
    return splits.subsample(split_labelled(spark, sf_dir, "text"), max_train=200, max_eval=25)


def q_sample_per_label(spark, sf_dir):
    texts = documents(spark, sf_dir).select("doc_id", "text")
    return splits.sample_per_label(labelled(spark, sf_dir), texts=texts)


# Scores and metrics -------------------------------------------------------------


def q_argmax_label(spark, sf_dir):
    rows = predict.score_logits(with_logits(scored(spark, sf_dir)))
    return rows.select("doc_id", "argmax_label")


def q_softmax_scores(spark, sf_dir):
    rows = predict.score_logits(with_logits(scored(spark, sf_dir)))
    # exp may differ in its last digit between engines.
    return rows.select("doc_id", F.round("toxic_prob", 6).alias("toxic_prob"))


def q_predict(spark, sf_dir):
    rows = predict.predict(scored(spark, sf_dir), THRESHOLD)
    return rows.select("doc_id", *predict.RECORD)


def q_label_errors(spark, sf_dir):
    return predict.label_errors(scored(spark, sf_dir), THRESHOLD)


def q_confusion_matrix(spark, sf_dir):
    return confusion.confusion_matrix(scored(spark, sf_dir), THRESHOLD)


def q_metrics_at_threshold(spark, sf_dir):
    return confusion.metrics_at_threshold(scored(spark, sf_dir), THRESHOLD)


def q_threshold_sweep(spark, sf_dir):
    return confusion.threshold_sweep(scored(spark, sf_dir))


def q_operating_points(spark, sf_dir):
    return confusion.operating_points(scored(spark, sf_dir))


def q_core_metrics(spark, sf_dir):
    return confusion.core_metrics(with_logits(scored(spark, sf_dir)))


def q_roc_auc(spark, sf_dir):
    return curves.roc_auc(scored(spark, sf_dir))


def q_average_precision(spark, sf_dir):
    return curves.average_precision(curves.running_counts(scored(spark, sf_dir)))


def q_roc_curve(spark, sf_dir):
    return curves.roc_curve(curves.running_counts(scored(spark, sf_dir)))


def q_roc_curve_corners(spark, sf_dir):
    return curves.roc_curve(curves.running_counts(scored(spark, sf_dir)), drop_collinear=True)


def q_pr_curve(spark, sf_dir):
    return curves.pr_curve(curves.running_counts(scored(spark, sf_dir)))


def q_pr_curve_bounded(spark, sf_dir):
    return curves.pr_curve(curves.thinned(curves.running_counts(scored(spark, sf_dir)), CURVE_POINTS))


def q_roc_curve_bounded(spark, sf_dir):
    return curves.roc_curve(curves.thinned(curves.running_counts(scored(spark, sf_dir)), CURVE_POINTS))


def _score_table(spark, sf_dir) -> DataFrame:
    """Fixture scores of labelled documents as a table of its own, with all that can be wrong.

    Every tenth document has no score, every 25th has two, and unlabelled documents have one too.
    """
    given = scored(spark, sf_dir).select("doc_id", "toxic_prob").where(F.col("doc_id") % 10 != 3)
    again = given.where(F.col("doc_id") % 25 == 1)
    others = documents(spark, sf_dir).select("doc_id", F.lit(0.5).alias("toxic_prob"))
    known = labels(spark, sf_dir).select("doc_id")
    return given.unionByName(again).unionByName(others.join(known, "doc_id", "left_anti"))


def _alignment(spark, sf_dir) -> align.Alignment:
    rows = labelled(spark, sf_dir, "lang")
    return align.align_scores(rows, _score_table(spark, sf_dir), allowed=("missing", "orphan", "double"))


def q_align_rows(spark, sf_dir):
    return _alignment(spark, sf_dir).rows


def q_align_problems(spark, sf_dir):
    return _alignment(spark, sf_dir).problems


def q_misclassified_topk(spark, sf_dir):
    return mistakes.top_mistakes(scored(spark, sf_dir), documents(spark, sf_dir))


def q_error_slices(spark, sf_dir):
    return slices.error_slices(scored(spark, sf_dir, *slices.text_facts(F.col("text"))))


# Probes -------------------------------------------------------------------------


def q_probe_score(spark, sf_dir):
    return scored_probes(spark, sf_dir)


def q_probe_summary(spark, sf_dir):
    return probes.probe_summary(scored_probes(spark, sf_dir))


def q_worst_category(spark, sf_dir):
    return probes.worst_category(probes.probe_summary(scored_probes(spark, sf_dir)))


def q_probe_error_examples(spark, sf_dir):
    return probes.probe_error_examples(scored_probes(spark, sf_dir), documents(spark, sf_dir))


# Profile ------------------------------------------------------------------------


def q_label_distribution(spark, sf_dir):
    return profile.label_distribution(split_labelled(spark, sf_dir))


def q_label_counts(spark, sf_dir):
    return profile.label_counts(split_labelled(spark, sf_dir))


def q_class_imbalance(spark, sf_dir):
    return profile.class_imbalance(split_labelled(spark, sf_dir))


def _lengths(spark, sf_dir) -> DataFrame:
    t = F.col("text")
    return labelled(
        spark, sf_dir, profile.char_length(t).alias("char_len"), profile.word_length(t).alias("word_len")
    )


def q_length_stats(spark, sf_dir):
    return profile.length_stats(_lengths(spark, sf_dir))


def q_length_histogram(spark, sf_dir):
    return profile.histogram(_lengths(spark, sf_dir), profile.MEASURES, bins=50, label="labels")


def _with_length_score(spark, sf_dir) -> DataFrame:
    """The fixture score, and a second fraction: words a character."""
    words = profile.word_length(F.col("text")) / F.greatest(F.length("text"), F.lit(1))
    return scored(spark, sf_dir, words.alias("words_per_char"))


def q_score_stats(spark, sf_dir):
    return selection.describe_fractions(_with_length_score(spark, sf_dir), ["toxic_prob", "words_per_char"])


def q_score_quantiles(spark, sf_dir):
    """Of a score with a third of all rows on one value."""
    tied = F.when(F.col("doc_id") % 3 == 0, 0.3).otherwise(F.col("toxic_prob"))
    rows = scored(spark, sf_dir).withColumn("toxic_prob", tied)
    found = selection.quantiles(rows, ["toxic_prob"], (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0))
    return found.withColumn("quantile", F.round("quantile", 9))


def q_score_histogram(spark, sf_dir):
    return selection.fractional_histogram(scored(spark, sf_dir), ["toxic_prob"], 20)


def q_token_counts(spark, sf_dir):
    return encode.with_token_counts(documents(spark, sf_dir)).select("doc_id", "n_tokens")


def q_token_histogram(spark, sf_dir):
    return profile.histogram(q_token_counts(spark, sf_dir), ["n_tokens"], bins=60)


def q_token_coverage(spark, sf_dir):
    return profile.token_coverage(q_token_counts(spark, sf_dir))


# Encoding -----------------------------------------------------------------------


def q_build_vocab(spark, sf_dir):
    return encode.build_vocabulary(prep.normalize_column(corpus(spark, sf_dir, "text")), VOCABULARY)


def q_encode_fixed_length(spark, sf_dir):
    rows = prepare_rows(corpus(spark, sf_dir, "text"))
    vocabulary = encode.build_vocabulary(rows, VOCABULARY)
    encoded = encode.encode_fixed_length(rows, vocabulary, ENCODED_LENGTH)
    # As text, since engines differ in how they hand out arrays.
    return encoded.select(
        "doc_id",
        "labels",
        F.array_join("input_ids", " ").alias("input_ids"),
        F.array_join("attention_mask", " ").alias("attention_mask"),
    )


def q_encode_large_vocabulary(spark, sf_dir):
    """All tokens of the documents and a number for every fifth of a line item: too many for a plan."""
    rows = prepare_rows(corpus(spark, sf_dir, "text"))
    every = prep.normalize_column(documents(spark, sf_dir).select("doc_id", "text"))
    words = encode.build_vocabulary(every, LARGE_VOCABULARY).select("token", "id")
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    number = F.col("l_orderkey") * 40 + F.col("l_linenumber") * 5 + F.col("fifth")
    numbers = items.select("l_orderkey", "l_linenumber", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("fifth"))
    numbers = numbers.select(number.cast("string").alias("token"), (number + LARGE_VOCABULARY + 4).cast("int").alias("id"))
    # The small tables hold fewer tokens than a plan does; here they are joined at every size.
    encoded = encode.encode_fixed_length(rows, words.unionByName(numbers), ENCODED_LENGTH, largest_constant=0)
    return encoded.select(
        "doc_id",
        "labels",
        F.array_join("input_ids", " ").alias("input_ids"),
        F.array_join("attention_mask", " ").alias("attention_mask"),
    )


# A caller's own functions -------------------------------------------------------


def _text_facts(batch):
    """What a caller may want to know of texts: a count, a ratio, and a text made of another."""
    texts = batch.column("text").to_pylist()
    digits = [None if t is None else sum(c in "0123456789" for c in t) for t in texts]
    return {
        "n_digits": digits,
        "digit_ratio": [None if not t else d / len(t) for t, d in zip(texts, digits)],
        "initials": [None if t is None else "".join(w[0] for w in t.split(" ")[:10] if w) for t in texts],
    }


def q_batch_map(spark, sf_dir):
    return map_batches(
        documents(spark, sf_dir).select("doc_id", "lang", "text"),
        _text_facts,
        "n_digits long, digit_ratio double, initials string",
        inputs=["text"],
        keep=["doc_id", "lang"],
    )


class LogLoss:
    """The mean negative log of the probability of the true class, by softmax, and the rows."""

    names = ("mean", "rows")

    def init(self):
        return 0.0, 0

    def update(self, state, logits, labels):
        top = logits.max(axis=1)
        total = top + np.log(np.exp(logits - top[:, None]).sum(axis=1))
        return state[0] + float((total - logits[np.arange(len(labels)), labels]).sum()), state[1] + len(labels)

    def merge(self, left, right):
        return left[0] + right[0], left[1] + right[1]

    def finish(self, state):
        return {"mean": state[0] / state[1] if state[1] else None, "rows": float(state[1])}


class Calibration:
    """The largest gap between stated and true share of toxic rows, over tenths of the probability."""

    names = ("largest_gap",)

    def init(self):
        return np.zeros((10, 3))

    def update(self, state, logits, labels):
        p = 1 / (1 + np.exp(logits[:, 0] - logits[:, 1]))
        tenth = np.minimum((p * 10).astype(int), 9)
        found = state.copy()
        for i, values in enumerate((np.ones(len(p)), p, labels)):
            found[:, i] += np.bincount(tenth, values, 10)
        return found

    def merge(self, left, right):
        return left + right

    def finish(self, state):
        filled = state[state[:, 0] > 0]
        gaps = np.abs(filled[:, 1] - filled[:, 2]) / filled[:, 0]
        return {"largest_gap": float(gaps.max()) if len(gaps) else None}


def q_user_metrics(spark, sf_dir):
    rows = with_logits(scored(spark, sf_dir))
    found = evaluate_metrics(rows, {"log_loss": LogLoss(), "calibration": Calibration()})
    # exp and the order of the sums may differ in the last digits between engines.
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


# Models -------------------------------------------------------------------------

_trained: dict[tuple[str, str], tuple[Training, str]] = {}


def _training(spark: SparkSession, sf_dir: str) -> tuple[Training, str]:
    """Train once per session and folder; the model is saved in the shared folder."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _trained:
        rows = prepare_rows(split_corpus(corpus(spark, sf_dir, "text")))
        training = train_classifier(rows)
        path = scratch_path(spark, "model")
        save_model(training.model, path)
        _trained[at] = training, path
    return _trained[at]


def _scorer(spark: SparkSession, sf_dir: str) -> ModelScorer:
    return ModelScorer(load_model(spark, _training(spark, sf_dir)[1]))


def q_train_classifier(spark, sf_dir):
    return _training(spark, sf_dir)[0].table(spark)


def _solvable_training(spark: SparkSession, sf_dir: str) -> tuple[Training, DataFrame]:
    """A fit whose solution is known: one word per text, the language, and no regularisation.

    The probability of a word is then the share of toxic rows that have it. Labels are drawn by a
    hash, 80 % toxic for English and 25 % for others, so that no share is 0 or 1.
    """
    toxic = hash32(F.col("doc_id"), "coin") % 100 < F.when(F.col("lang") == "en", 80).otherwise(25)
    rows = split_labelled(spark, sf_dir, "lang").select(
        "doc_id", "split", F.col("lang").alias("text"), toxic.cast("int").alias("labels")
    )
    return train_classifier(rows, reg_params=(0.0,), n_features=4096, max_iter=200), rows


def q_train_solvable(spark, sf_dir):
    """What was learned for each language against what it must be."""
    training, rows = _solvable_training(spark, sf_dir)
    found = ModelScorer(training.model)(rows.where(F.col("split") == splits.TRAIN))
    counts = found.groupBy(F.col("text").alias("lang")).agg(
        F.count(F.lit(1)).alias("n_train"),
        F.count_if(F.col("labels") == 1).alias("n_toxic"),
        F.min("toxic_prob").alias("low"),
        F.max("toxic_prob").alias("high"),
    )
    share = F.col("n_toxic") / F.col("n_train")
    learned = (F.col("low") == F.col("high")) & (F.abs(F.col("low") - share) < 0.002)
    return counts.select("lang", "n_train", "n_toxic", learned.alias("share_learned"))


def q_sink_train_metrics_solvable(spark, sf_dir):
    """The metrics of that fit on the validation split, written and read back."""
    training, rows = _solvable_training(spark, sf_dir)
    validation = ModelScorer(training.model)(rows.where(F.col("split") == splits.VALIDATION))
    path = scratch_path(spark, "train_metrics")
    # Equal shares differ in the last digits of the fit, which would break ties of the AUC.
    write_json(confusion.core_metrics(validation.withColumn("toxic_prob", F.round("toxic_prob", 4))), path)
    schema = "accuracy double, precision double, recall double, f1 double, roc_auc double"
    return spark.read.schema(schema).json(path)


def q_model_score(spark, sf_dir):
    rows = score_texts(documents(spark, sf_dir).select("doc_id", "text"), _scorer(spark, sf_dir))
    return rows.select("doc_id", "error_code", *predict.RECORD)


def _vowel_scorer() -> PythonScorer:
    """The share of vowels: a stand-in for any Python model, with a result SQL can check."""

    def load():
        def share(text: str) -> float:
            return sum(map(text.count, "aeiou")) / len(text) if text else 0.0

        return lambda texts: texts.map(share)

    return PythonScorer(load)


def q_model_score_facts(spark, sf_dir):
    """What must hold of every scored document, whatever the model has learned."""
    scored_rows = _scorer(spark, sf_dir)(documents(spark, sf_dir).select("doc_id", "text"))
    softmax_gap = F.abs(toxic_probability(F.col("logits")) - F.col("toxic_prob"))
    facts = q_model_score(spark, sf_dir)
    p, label = F.col("toxic_prob"), F.col("label_id")
    judged = facts.select(
        "doc_id",
        "error_code",
        "threshold",
        ((p >= 0) & (p <= 1)).alias("in_range"),
        (label == (p >= F.col("threshold")).cast("int")).alias("label_follows"),
        (F.abs(F.col("confidence") - F.when(label == 1, p).otherwise(1 - p)) < 1e-12).alias(
            "confidence_follows"
        ),
        (F.col("label") == class_name(label)).alias("name_follows"),
    )
    fits = scored_rows.select("doc_id", (softmax_gap < 1e-9).alias("softmax_fits"))
    return judged.join(fits, "doc_id")


def q_train_classifier_facts(spark, sf_dir):
    """The candidates tried, and that the first with the best F1 was taken."""
    candidates = _training(spark, sf_dir)[0].table(spark)
    place = F.struct("val_f1", (-F.col("reg_param")).alias("minus"))
    best = candidates.agg(F.max(place).alias("best"), F.count_if("selected").alias("n_selected"))
    is_best = F.col("reg_param") == -F.col("best.minus")
    return candidates.crossJoin(F.broadcast(best)).select(
        "reg_param",
        "n_selected",
        F.col("val_f1").between(0, 1).alias("f1_in_range"),
        (F.col("selected") == is_best).alias("first_best_taken"),
    )


def q_evaluate_facts(spark, sf_dir):
    """Per threshold the class counts that the trained model's sweep must add up to."""
    sweep = q_evaluate(spark, sf_dir)
    before = Window.orderBy("threshold")
    falls = F.coalesce(F.col("recall") <= F.lag("recall").over(before), F.lit(True))
    return sweep.select(
        "threshold",
        (F.col("tp") + F.col("fn")).alias("n_pos"),
        (F.col("fp") + F.col("tn")).alias("n_neg"),
        falls.alias("recall_falls"),
    )


def q_reload_scores(spark, sf_dir):
    """The saved model scores as the fitted one does."""
    rows = documents(spark, sf_dir).select("doc_id", "text")
    fitted = ModelScorer(_training(spark, sf_dir)[0].model)(rows)
    reloaded = _scorer(spark, sf_dir)(rows).select("doc_id", F.col("toxic_prob").alias("again"))
    same = F.col("toxic_prob").eqNullSafe(F.col("again"))
    return fitted.join(reloaded, "doc_id").select("doc_id", same.alias("same_score"))


def q_udf_score(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = score_texts(docs, _vowel_scorer(), threshold=0.35)
    return rows.select("doc_id", "error_code", *predict.RECORD)


def _evaluate(spark: SparkSession, sf_dir: str, scorer) -> DataFrame:
    """The whole run on the test split; returns the threshold table it wrote."""
    run = run_evaluation(
        corpus(spark, sf_dir, "text"),
        scorer,
        scratch_path(spark, "evaluation"),
        texts=documents(spark, sf_dir),
    )
    return _read_sweep(spark, run.reports["threshold_metrics_test.csv"])


def q_evaluate(spark, sf_dir):
    return _evaluate(spark, sf_dir, _scorer(spark, sf_dir))


def q_evaluate_test_split(spark, sf_dir):
    return _evaluate(spark, sf_dir, fixture_scorer)


# Streaming ----------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, scorer) -> DataFrame:
    path = f"{sf_dir}/conversations.parquet"
    schema = spark.read.parquet(path).schema
    # As a pattern: a plain path must be a folder for a stream, and here it is a file.
    requests = read_requests(spark, f"{path}*", schema).where(F.col("role") == "user").drop("role")
    result = score_stream(requests, scorer)
    out, checkpoint = scratch_path(spark, "responses"), scratch_path(spark, "offsets")
    start_scoring(result, out, checkpoint).awaitTermination()
    return spark.read.schema(result.schema).parquet(out).drop("text")


def _request_scorer(df: DataFrame) -> DataFrame:
    key = F.concat_ws(":", "conv_id", "turn")
    return df.withColumn("toxic_prob", (hash32(key, "score") % 10001) / F.lit(10000.0))


def q_stream_score(spark, sf_dir):
    return _stream(spark, sf_dir, _request_scorer)


def q_stream_model_score(spark, sf_dir):
    return _stream(spark, sf_dir, _scorer(spark, sf_dir))


# Sinks: each writes a report and reads it back ------------------------------------

_SWEEP_SCHEMA = (
    "threshold double, precision double, recall double, f1 double, accuracy double, "
    "tp bigint, fp bigint, tn bigint, fn bigint"
)
_METRICS_SCHEMA = (
    "accuracy double, precision double, recall double, f1 double, roc_auc double, "
    "confusion_matrix struct<tp bigint, fp bigint, tn bigint, fn bigint>, threshold_used double"
)


def _read_sweep(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SWEEP_SCHEMA).options(**csv.READ).csv(path)


def q_sink_eval_metrics(spark, sf_dir):
    path = scratch_path(spark, "eval_metrics")
    write_json(confusion.evaluation_metrics(with_logits(scored(spark, sf_dir)), THRESHOLD), path)
    rows = spark.read.schema(_METRICS_SCHEMA).json(path)
    return rows.select("*", "confusion_matrix.*").drop("confusion_matrix")


def q_eval_metrics_at_0_3(spark, sf_dir):
    """Log-odds as logits and a threshold that isn't one half."""
    p = F.col("toxic_prob")
    # Certain rows get large logits: their odds have no logarithm.
    odds = F.when(p <= 0, -40.0).when(p >= 1, 40.0).otherwise(F.log(F.try_divide(p, 1 - p)))
    rows = scored(spark, sf_dir).withColumn("logits", F.array(F.lit(0.0), odds))
    found = confusion.evaluation_metrics(rows, 0.3)
    return found.select("confusion_matrix.*", "threshold_used")


def q_sink_train_metrics(spark, sf_dir):
    path = scratch_path(spark, "train_metrics")
    rows = prepare_rows(split_labelled(spark, sf_dir, "text"), label="labels")
    validation = rows.where(F.col("split") == splits.VALIDATION)
    write_json(confusion.core_metrics(_scorer(spark, sf_dir)(validation)), path)
    schema = "accuracy double, precision double, recall double, f1 double, roc_auc double"
    return spark.read.schema(schema).json(path)


def q_sink_threshold_csv(spark, sf_dir):
    path = scratch_path(spark, "threshold_metrics")
    write_csv(confusion.threshold_sweep(scored(spark, sf_dir)), path)
    return _read_sweep(spark, path)


def q_sink_threshold_summary(spark, sf_dir):
    path = scratch_path(spark, "threshold_summary")
    rows = confusion.operating_point_row(confusion.sweep_by_position(scored(spark, sf_dir)))
    write_json(rows, path)
    stored = spark.read.schema(rows.schema).json(path)
    return confusion.point_rows(stored)


def q_sink_misclassified_csv(spark, sf_dir):
    path = scratch_path(spark, "misclassified")
    rows = q_misclassified_topk(spark, sf_dir)
    write_csv(rows, path)
    return spark.read.schema(rows.schema).options(**csv.READ).csv(path)


def q_sink_error_slices(spark, sf_dir):
    path = scratch_path(spark, "error_slices")
    rows = slices_document(q_error_slices(spark, sf_dir))
    write_json(rows, path)
    stored = spark.read.schema(rows.schema).json(path)
    named = [
        F.struct(
            F.lit(s).alias("slice"),
            F.col(f"{s}.n").alias("n"),
            F.col(f"{s}.n_correct").alias("n_correct"),
            F.col(f"{s}.accuracy").alias("accuracy"),
        )
        for s in slices.SLICES
    ]
    return stored.select(F.inline(F.array(*named)))


def q_sink_probe_results(spark, sf_dir):
    path = scratch_path(spark, "probe_results")
    rows = scored_probes(spark, sf_dir, "text")
    write_csv(rows, path)
    return spark.read.schema(rows.schema).options(**csv.READ).csv(path)


def q_sink_probe_summary(spark, sf_dir):
    path = scratch_path(spark, "probe_summary")
    rows = q_probe_summary(spark, sf_dir)
    write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): query
    for name, query in list(globals().items())
    if name.startswith("q_")
}
