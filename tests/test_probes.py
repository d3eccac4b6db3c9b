from __future__ import annotations

import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from veritally.operators import probes as P
from veritally.plans.probes import run_probes, score_probes
from veritally.sinks.reports import write_csv
from veritally.sources.probes import PROBE_COLUMNS as P_COLUMNS
from veritally.sources.probes import load_probes

HEADER = "text,expected_label,category,notes\n"


def write(tmp_path, body, name="probes.csv"):
    path = tmp_path / name
    path.write_text(body, encoding="utf-8")
    return str(path)


def test_load(spark, tmp_path):
    body = HEADER + (
        '"You fool, ""really""",1,insult,"two, commas"\n'
        '"line one\nline two",0,calm,\n'
        "NA,0,,none\n"
    )
    df = load_probes(spark, write(tmp_path, body))
    assert [f.simpleString() for f in df.schema] == [
        "text:string", "expected_label:int", "category:string", "notes:string"]
    assert [(r.text, r.expected_label, r.category) for r in df.collect()] == [
        ('You fool, "really"', 1, "insult"), ("line one\nline two", 0, "calm"), ("NA", 0, None)]


def test_load_finds_columns_by_name(spark, tmp_path):
    body = "notes,category,extra,expected_label,text\nn,c,e,1,hello\n"
    row = load_probes(spark, write(tmp_path, body)).first()
    assert (row.text, row.expected_label, row.extra) == ("hello", 1, "e")


def test_missing_file_and_column(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_probes(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError, match=r"category.*notes"):
        load_probes(spark, write(tmp_path, "text,expected_label\na,1\n"))


def test_label_that_is_no_integer_fails(spark, tmp_path):
    with pytest.raises(Exception, match="maybe|MALFORMED"):
        load_probes(spark, write(tmp_path, HEADER + "a,maybe,c,n\n")).collect()


def results(spark, data):
    """From (category, expected, probability)."""
    df = spark.createDataFrame(
        [(i, f"t{i}", c, y, p) for i, (c, y, p) in enumerate(data)],
        "doc_id int, text string, category string, expected_label int, toxic_prob double",
    )
    return P.probe_results(df)


def summary(spark, data):
    return {(r["scope"], r["category"]): r for r in rows(P.probe_summary(results(spark, data)))}


def test_results_columns(spark):
    got = results(spark, [("a", 1, 0.8), ("a", 1, 0.2)]).orderBy("doc_id").collect()
    assert [(r.predicted_label, r.toxic_probability, r.confidence, r.is_correct) for r in got] == [
        (1, 0.8, 0.8, True), (0, 0.2, 0.8, False)]


def test_summary_overall_and_per_category(spark):
    got = summary(spark, [
        ("toxic_only", 1, 0.9), ("toxic_only", 1, 0.1), ("clean_only", 0, 0.1),
        ("mixed", 1, 0.9), ("mixed", 0, 0.8), ("mixed", 0, 0.1), (None, 0, 0.1),
    ])
    assert set(got) == {("overall", None), ("category", "toxic_only"), ("category", "clean_only"),
                        ("category", "mixed")}
    overall = got["overall", None]
    assert (overall["n"], overall["n_correct"], overall["accuracy"]) == (7, 5, 0.7143)
    assert (overall["precision"], overall["recall"], overall["f1"]) == (0.6667, 0.6667, 0.6667)
    toxic = got["category", "toxic_only"]
    assert (toxic["precision"], toxic["recall"], toxic["f1"]) == (1.0, 0.5, 0.6667)
    assert toxic["needs_attention"] is True
    # No toxic probe and no toxic verdict: neither metric has a denominator.
    clean = got["category", "clean_only"]
    assert (clean["accuracy"], clean["precision"], clean["recall"], clean["f1"]) == (1.0, None, None, None)
    assert clean["needs_attention"] is False


def test_f1_is_null_when_precision_or_recall_is_zero(spark):
    got = summary(spark, [("c", 1, 0.1), ("c", 0, 0.9)])["category", "c"]
    assert (got["precision"], got["recall"], got["f1"]) == (0.0, 0.0, None)


def test_summary_of_nothing(spark):
    got = summary(spark, [])
    assert list(got) == [("overall", None)]
    only = got["overall", None]
    assert only["n"] == 0 and only["n_correct"] is None and only["accuracy"] is None


def test_worst_category_ties_by_name(spark):
    data = [("b", 1, 0.1), ("a", 1, 0.1), ("c", 1, 0.9)]
    got = rows(P.worst_category(P.probe_summary(results(spark, data))))
    assert got == [{"category": "a", "accuracy": 0.0}]
    assert rows(P.worst_category(P.probe_summary(results(spark, [])))) == []


def test_error_examples(spark):
    data = [("c", 0, 0.5 + i / 100) for i in range(8)] + [("c", 1, i / 100) for i in range(8)]
    got = P.probe_error_examples(results(spark, data), n=5).collect()
    assert sorted(r.toxic_probability for r in got if r.error_type == "FP") == pytest.approx(
        [0.53, 0.54, 0.55, 0.56, 0.57])
    assert sorted(r.toxic_probability for r in got if r.error_type == "FN") == [0, 0.01, 0.02, 0.03, 0.04]


def exclaims(df):
    return df.withColumn("toxic_prob", F.when(F.col("text").contains("!"), 0.9).otherwise(0.2))


def test_run_writes_results_and_summary(spark, tmp_path):
    body = HEADER + 'Stop!,1,loud,"a ""quote"""\nhello,0,calm,\n" ",0,calm,blank\nmean,1,calm,\n'
    results_path, summary_path = run_probes(
        spark, write(tmp_path, body), exclaims, str(tmp_path / "out"))
    stored = spark.read.options(header=True, escape='"').csv(results_path).collect()
    assert {r.text: r.predicted_label for r in stored} == {
        "Stop!": "1", "hello": "0", " ": None, "mean": "0"}
    lines = [json.loads(line) for f in Path(summary_path).glob("part-*")
             for line in f.read_text().splitlines()]
    overall = next(r for r in lines if r["scope"] == "overall")
    # The blank probe has no verdict and is not counted.
    assert (overall["n"], overall["n_correct"]) == (3, 2)
    calm = next(r for r in lines if r["category"] == "calm")
    assert calm["precision"] is None and "precision" in calm


def test_blank_probe_does_not_fail_the_others(spark):
    df = spark.createDataFrame([("", 1), (None, 0), ("hey!", 1)], "text string, expected_label int")
    got = score_probes(df, exclaims).collect()
    assert [r.error_code for r in got] == ["EMPTY", "EMPTY", None]
    assert [r.is_correct for r in got] == [None, None, True]


def test_csv_keeps_texts_as_they_are(spark, tmp_path):
    texts = ["  padded  ", 'say "hi", twice', "line\nbreak", "back\\slash\\", '"', "tab\t", "é日本", ","]
    df = spark.createDataFrame([(t, 1, "c", "n") for t in texts], list(P_COLUMNS))
    write_csv(df.withColumn("expected_label", F.col("expected_label").cast("int")), str(tmp_path / "t"))
    assert sorted(r.text for r in load_probes(spark, str(tmp_path / "t")).collect()) == sorted(texts)
