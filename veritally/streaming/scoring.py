"""Streaming scoring over a folder of arriving files.

Each text is validated, normalised, scored and decided on its own. There is no
state, so no watermark is needed and nothing grows with the length of the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from veritally.functions.scores import DEFAULT_THRESHOLD
from veritally.operators.prepare import MAX_REQUEST_CHARS
from veritally.plans.scoring import Scorer, score_texts

RESPONSE = ("label", "label_id", "confidence", "toxic_prob")


def read_requests(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Requests as a stream; a stream needs its schema given."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def score_stream(
    requests: DataFrame,
    scorer: Scorer,
    threshold: float = DEFAULT_THRESHOLD,
    normalize: bool = True,
    text: str = "text",
    max_chars: int = MAX_REQUEST_CHARS,
) -> DataFrame:
    """The request's columns, its error code and the response fields.

    The scorer is made before the stream starts and travels with its plan.
    """
    scored = score_texts(requests, scorer, threshold, normalize, text, max_chars)
    return scored.select(*requests.columns, "error_code", *RESPONSE)


def start_scoring(
    scored: DataFrame, out_path: str, checkpoint_path: str, continuous: bool = False
) -> StreamingQuery:
    """Append scored requests to a Parquet table, each exactly once.

    By default what has arrived is worked off and the query ends; otherwise it
    waits for more.
    """
    writer = (
        scored.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint_path)
    )
    if not continuous:
        writer = writer.trigger(availableNow=True)
    return writer.start(out_path)


def start_scoring_with_rejects(
    scored: DataFrame,
    out_path: str,
    reject_path: str,
    checkpoint_path: str,
    continuous: bool = False,
) -> StreamingQuery:
    """As above, with requests that have an error code in a table of their own.

    A batch has a folder in both tables, named by its run and its number. The run is the query's
    id, which Spark keeps in the checkpoint: a query that goes on from its checkpoint is the same
    run, and one with a new checkpoint is another and touches nothing that is there. When both
    folders are written, the batch is entered in a ledger beside the responses. A batch that is
    tried again after a failure overwrites its own folders, so no request appears twice
    in a run; readers go by the ledger (:func:`read_committed`).
    """
    spark = scored.sparkSession

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        run = run_of_checkpoint(spark, checkpoint_path)
        ok = F.col("error_code").isNull()
        batch.persist()  # both tables take from it, and it is scored once
        try:
            kept, rejected = batch.where(ok).drop("error_code"), batch.where(~ok).drop(*RESPONSE)
            kept.write.mode("overwrite").parquet(f"{out_path}/run={run}/batch={batch_id}")
            rejected.write.mode("overwrite").parquet(f"{reject_path}/run={run}/batch={batch_id}")
        finally:
            batch.unpersist()
        entry = spark.createDataFrame([(run, batch_id)], LEDGER_ROW)
        entry.coalesce(1).write.mode("overwrite").json(f"{_ledger(out_path)}/{run}-{batch_id}")

    writer = scored.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint_path
    )
    if not continuous:
        writer = writer.trigger(availableNow=True)
    return writer.start()


LEDGER_ROW = "run string, batch long"


def _ledger(out_path: str) -> str:
    return f"{out_path.rstrip('/')}-ledger"


def run_of_checkpoint(spark: SparkSession, checkpoint_path: str) -> str:
    """The id of the query that a checkpoint belongs to."""
    return spark.read.schema("id string").json(f"{checkpoint_path.rstrip('/')}/metadata").first()["id"]


def committed_batches(spark: SparkSession, out_path: str) -> DataFrame:
    """run and batch of all batches of which both tables are complete."""
    try:
        return spark.read.schema(LEDGER_ROW).json(f"{_ledger(out_path)}/*").distinct()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LEDGER_ROW)
        raise


def read_committed(
    spark: SparkSession,
    out_path: str,
    schema: StructType | str,
    table_path: str | None = None,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of the committed batches of all runs, with ``run`` and ``batch``.

    ``table_path`` names the table to read (default: the responses), ``out_path`` the one with the
    ledger. A run with a new checkpoint takes all input anew, so requests may be in several
    runs. With ``keys`` one row of each request stays: that of the run with the most
    committed batches, of equals that with the larger id. Null keys are equal to each other.
    """
    batches = committed_batches(spark, out_path)
    ended = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    try:
        rows = spark.read.schema(f"{ended}, {LEDGER_ROW}").parquet(table_path or out_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{ended}, {LEDGER_ROW}")
    whole = rows.join(batches, ["run", "batch"]).select(*rows.columns)
    if keys is None:
        return whole
    weights = batches.groupBy("run").agg(F.count(F.lit(1)).alias("_batches"))
    ranked = whole.join(weights, "run")
    order = F.struct("_batches", "run", "batch", F.struct(*rows.columns).alias("row"))
    return ranked.groupBy(*keys).agg(F.max(order).alias("_last")).select("_last.row.*")
