"""From a raw labelled corpus to rows a model can learn from or be judged on."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame

from veritally.operators.prepare import clean_rows, map_labels, normalize_column
from veritally.operators.splits import assign_splits, subsample


def split_corpus(
    corpus: DataFrame,
    key: str = "doc_id",
    val_ratio: float = 0.1,
    test_ratio: float = 0.1,
    max_train: int | None = None,
    max_eval: int | None = None,
    seed: int = 42,
    present: Collection[str] | None = None,
) -> DataFrame:
    """Assign splits, then cut each to its limit."""
    split = assign_splits(corpus, key, val_ratio, test_ratio, seed, present)
    return subsample(split, max_train, max_eval, key, seed)


def prepare_rows(
    split: DataFrame, text: str = "text", label: str = "toxicity", normalize: bool = True
) -> DataFrame:
    """Clean, normalise and map labels. One map-only stage over the corpus."""
    rows = clean_rows(split, text, label)
    if normalize:
        rows = normalize_column(rows, text)
    return map_labels(rows, label)
