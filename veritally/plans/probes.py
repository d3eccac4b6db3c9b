"""The probe run: score a probe file and report on it per category."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veritally.functions.scores import DEFAULT_THRESHOLD
from veritally.operators.probes import probe_results, probe_summary
from veritally.plans.scoring import Scorer, score_texts
from veritally.sinks.reports import write_csv, write_json
from veritally.sources import csv
from veritally.sources.probes import load_probes


def score_probes(
    probes: DataFrame, scorer: Scorer, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Score every probe; a null or blank one keeps an error code and no verdict."""
    scored = score_texts(probes, scorer, threshold)
    kept = [*probes.columns, "error_code"]
    return probe_results(scored.select(*kept, "toxic_prob"), threshold)


def run_probes(
    spark: SparkSession,
    probe_path: str,
    scorer: Scorer,
    out_dir: str,
    threshold: float = DEFAULT_THRESHOLD,
) -> tuple[str, str]:
    """Write ``probe_results.csv`` and ``probe_summary.json``; return their paths.

    The summary holds one JSON line for all probes and one per category, so it
    needs no task that sees every category.
    """
    results_path = f"{out_dir.rstrip('/')}/probe_results.csv"
    summary_path = f"{out_dir.rstrip('/')}/probe_summary.json"
    results = score_probes(load_probes(spark, probe_path), scorer, threshold)
    write_csv(results, results_path)
    # Read back rather than scored again.
    stored = spark.read.schema(results.schema).options(**csv.READ).csv(results_path)
    write_json(probe_summary(stored), summary_path)
    return results_path, summary_path
