"""Scoring texts: validate, normalise, score, decide. For batches and streams alike."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.functions.scores import DEFAULT_THRESHOLD, check_threshold
from veritally.functions.text import normalize_text
from veritally.operators.predict import RECORD, predict
from veritally.operators.prepare import error_code
from veritally.sources.schema import require_columns

# Adds a toxic_prob column, given a frame with the text column.
Scorer = Callable[[DataFrame], DataFrame]


class PythonScorer:
    """Any Python model that gives a toxic probability for a batch of texts.

    ``load`` runs once per Python worker and task, not per batch, and returns a
    function from a series of texts to a series of probabilities. Texts travel
    in Arrow batches.
    """

    def __init__(
        self, load: Callable[[], Callable[[pd.Series], pd.Series]], text: str = "text"
    ):
        self.load, self.text = load, text

    def __call__(self, df: DataFrame) -> DataFrame:
        load = self.load

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for batch in batches:
                yield model(batch)

        # Called nondeterministic so that a filter on the score does not run the
        # model a second time below the projection. Filter other columns first.
        once = score.asNondeterministic()
        return df.withColumn("toxic_prob", once(F.col(self.text)))


def score_texts(
    df: DataFrame,
    scorer: Scorer,
    threshold: float = DEFAULT_THRESHOLD,
    normalize: bool = True,
    text: str = "text",
    max_chars: int | None = None,
) -> DataFrame:
    """Add ``error_code`` and the prediction record to every row.

    A text that cannot be scored gets an error code and a null record; the rows
    around it are scored as usual. The scorer sees the normalised text, and an
    empty one for such rows; the text in the result is the one that came in.
    ``max_chars`` adds a length limit, as online requests have one.
    """
    require_columns(df, [text])
    threshold = check_threshold(threshold)
    code = error_code(F.col(text), max_chars)
    checked = df.withColumn("_raw", F.col(text)).withColumn("error_code", code)
    clean = normalize_text(F.col("_raw")) if normalize else F.col("_raw")
    given = F.coalesce(F.when(F.col("error_code").isNull(), clean), F.lit(""))
    scored = predict(scorer(checked.withColumn(text, given)), threshold)
    ok = F.col("error_code").isNull()
    record = {c: F.when(ok, F.col(c)) for c in (*RECORD, "logits") if c in scored.columns}
    return scored.withColumns({text: F.col("_raw"), **record}).drop("_raw")
