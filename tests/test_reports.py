"""Report sets that are published as one, and streams that start again."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from veritally.plans import evaluate as plan
from veritally.plans.evaluate import run_evaluation
from veritally.sinks.reports import ReportSet, current_reports, write_json
from veritally.streaming.scoring import (
    committed_batches,
    read_committed,
    read_requests,
    run_of_checkpoint,
    score_stream,
    start_scoring_with_rejects,
)


def corpus(spark, shift):
    return spark.range(200).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("x"), ((F.col("id") + shift) % 17 + 1).cast("int")).alias("text"),
        (F.col("id") % 3 == 0).cast("int").alias("toxicity"),
    )


def scorer(df):
    return df.withColumn("toxic_prob", F.least(F.length("text") / 20.0, F.lit(0.99)))


def contents(spark, reports):
    return {n: sorted(r["value"] for r in rows(spark.read.text(p))) for n, p in reports.items()}


@pytest.mark.parametrize("broken", ["write_csv", "write_json", "top_mistakes", "average_precision"])
def test_a_run_that_fails_leaves_the_set_before(spark, tmp_path, monkeypatch, broken):
    out = str(tmp_path / "reports")
    assert current_reports(spark, out) == {}
    first = run_evaluation(corpus(spark, 0), scorer, out)
    before = contents(spark, first.reports)
    calls, real = [], getattr(plan, broken)

    def fails_later(*args, **options):
        calls.append(args)
        if len(calls) > 1 or broken in ("top_mistakes", "average_precision"):
            raise OSError("disk full")
        return real(*args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(plan, broken, fails_later)
        with pytest.raises(OSError):
            run_evaluation(corpus(spark, 5), scorer, out)
    assert current_reports(spark, out) == first.reports
    assert contents(spark, current_reports(spark, out)) == before
    second = run_evaluation(corpus(spark, 5), scorer, out)
    assert current_reports(spark, out) == second.reports
    after = contents(spark, second.reports)
    assert after != before and set(after) == set(before)
    assert contents(spark, first.reports) == before


def test_a_set_is_seen_when_it_is_published(spark, tmp_path):
    reports = ReportSet(spark, str(tmp_path), ["a.json", "b.json"])
    write_json(spark.range(1), reports.paths["a.json"])
    assert current_reports(spark, str(tmp_path)) == {}
    write_json(spark.range(2), reports.paths["b.json"])
    assert reports.publish() == current_reports(spark, f"{tmp_path}/") == reports.paths
    with pytest.raises(ValueError):
        ReportSet(spark, str(tmp_path), ["a", "a"])


def test_curves_are_thinned_beyond_their_bound(spark, tmp_path):
    wide = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("x").alias("text"), (F.xxhash64("id") % 5 == 0).cast("int").alias("toxicity")
    )

    def spread(df):
        return df.withColumn("toxic_prob", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1000003)) / 1000003.0)

    run = run_evaluation(wide, spread, str(tmp_path), test_ratio=0.8, max_points=250)
    distinct = run.scored.select("toxic_prob").distinct().count()
    curve = spark.read.csv(run.reports["pr_curve_test.csv"], header=True)
    assert distinct > 2000 and 100 < curve.count() <= 251
    whole = run_evaluation(wide, spread, str(tmp_path), test_ratio=0.8)
    assert spark.read.csv(whole.reports["pr_curve_test.csv"], header=True).count() == distinct + 1


REQUESTS = "id int, text string"


def arrive(spark, folder, data):
    spark.createDataFrame(data, REQUESTS).coalesce(1).write.mode("append").parquet(folder)


def test_a_new_checkpoint_loses_nothing(spark, tmp_path):
    source, out, bad = (str(tmp_path / n) for n in ("in", "out", "bad"))

    def run(checkpoint):
        stream = score_stream(read_requests(spark, source, REQUESTS, files_per_batch=1), scorer)
        start_scoring_with_rejects(stream, out, bad, str(tmp_path / checkpoint)).awaitTermination()
        return run_of_checkpoint(spark, str(tmp_path / checkpoint)), stream.drop("error_code")

    arrive(spark, source, [(0, "one"), (1, None)])
    arrive(spark, source, [(2, "three")])
    first, stream = run("a")
    arrive(spark, source, [(3, "four"), (4, " ")])
    assert run("a")[0] == first  # goes on from its checkpoint: the same run
    schema = stream.schema
    got = rows(read_committed(spark, out, schema))
    assert sorted(r["id"] for r in got) == [0, 2, 3] and {r["run"] for r in got} == {first}
    # Another checkpoint takes all input again, beside what is there.
    second, _ = run("b")
    assert second != first
    twice = rows(read_committed(spark, out, schema))
    assert sorted(r["id"] for r in twice) == [0, 0, 2, 2, 3, 3]
    once = rows(read_committed(spark, out, schema, keys=["id"]))
    assert sorted(r["id"] for r in once) == [0, 2, 3] and len({r["run"] for r in once}) == 1
    rejects = rows(read_committed(spark, out, f"{REQUESTS}, error_code string", bad, keys=["id"]))
    assert sorted((r["id"], r["error_code"]) for r in rejects) == [(1, "EMPTY"), (4, "EMPTY")]
    assert committed_batches(spark, out).count() == 6


def test_batches_that_are_not_in_the_ledger_are_not_read(spark, tmp_path):
    source, out, bad = (str(tmp_path / n) for n in ("in", "out", "bad"))
    assert committed_batches(spark, out).count() == 0
    assert read_committed(spark, out, REQUESTS).count() == 0
    arrive(spark, source, [(0, "one")])
    stream = score_stream(read_requests(spark, source, REQUESTS), scorer)
    start_scoring_with_rejects(stream, out, bad, str(tmp_path / "a")).awaitTermination()
    # What a failed batch leaves behind: rows in one table, and no entry.
    spark.createDataFrame([(9, "half")], REQUESTS).write.parquet(f"{out}/run=x/batch=7")
    assert [r["id"] for r in rows(read_committed(spark, out, REQUESTS))] == [0]
