"""Row cleaning, label mapping and request validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from veritally.functions.text import has_content, normalize_text
from veritally.sources.schema import require_columns

MAX_REQUEST_CHARS = 4096


def is_usable(text: str, label: str) -> Column:
    """Text present and not blank, label present. Never null."""
    return F.coalesce(has_content(F.col(text)), F.lit(False)) & F.col(label).isNotNull()


def clean_rows(df: DataFrame, text: str = "text", label: str = "toxicity") -> DataFrame:
    require_columns(df, [text, label])
    return df.where(is_usable(text, label))


def clean_drop_counts(
    df: DataFrame, text: str = "text", label: str = "toxicity", split: str = "split"
) -> DataFrame:
    """Rows before and after cleaning, per split."""
    require_columns(df, [text, label, split])
    # Reduced to a flag first, so that only (split, flag) reaches the aggregate.
    return (
        df.select(split, is_usable(text, label).alias("usable"))
        .groupBy(split)
        .agg(
            F.count(F.lit(1)).alias("n_before"),
            F.count_if("usable").alias("n_after"),
            F.count_if(~F.col("usable")).alias("n_dropped"),
        )
    )


def normalize_column(df: DataFrame, text: str = "text") -> DataFrame:
    require_columns(df, [text])
    return df.withColumn(text, normalize_text(F.col(text)))


def _binary(df: DataFrame, label: str) -> Column:
    """0 or 1 where the raw label is in its domain, else null."""
    value, kind = F.col(label), df.schema[label].dataType
    if isinstance(kind, StringType):
        return F.when(value == "0", 0).when(value == "1", 1)
    if isinstance(kind, BooleanType):
        return value.cast("int")
    if isinstance(kind, NumericType):
        return F.when(value.isin(0, 1), value.cast("int"))
    raise ValueError(f"label column '{label}' has type {kind.simpleString()}")


def map_labels(df: DataFrame, label: str = "toxicity") -> DataFrame:
    """Raw labels to an INT column ``labels``; any other value fails the job."""
    require_columns(df, [label])
    message = F.concat(
        F.lit(f"unexpected value in label column '{label}': "),
        F.coalesce(F.col(label).cast("string"), F.lit("null")),
    )
    mapped = F.coalesce(_binary(df, label), F.raise_error(message).cast("int"))
    out = df.withColumn("labels", mapped)
    return out if label == "labels" else out.drop(label)


def split_by_label_validity(
    df: DataFrame, label: str = "toxicity"
) -> tuple[DataFrame, DataFrame]:
    """The lenient form: mapped rows, and the rejected rows as they came."""
    require_columns(df, [label])
    valid = _binary(df, label)
    good = df.where(valid.isNotNull()).withColumn("labels", valid)
    return (good if label == "labels" else good.drop(label)), df.where(valid.isNull())


def error_code(text: Column, max_chars: int | None = MAX_REQUEST_CHARS) -> Column:
    """Why a text cannot be scored: EMPTY or TOO_LONG; null when it can.

    ``None`` for ``max_chars`` lifts the length limit.
    """
    code = F.when(text.isNull(), "EMPTY")
    if max_chars is not None:
        code = code.when(F.length(text) > max_chars, "TOO_LONG")
    return code.when(~has_content(text), "EMPTY")


def validate_inputs(
    df: DataFrame, text: str = "text", max_chars: int | None = MAX_REQUEST_CHARS
) -> DataFrame:
    """Add ``error_code``. One bad text must not fail the others."""
    require_columns(df, [text])
    return df.withColumn("error_code", error_code(F.col(text), max_chars))
