from __future__ import annotations

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from veritally.operators import prepare as P
from veritally.plans.prepare import prepare_rows
from veritally.sources.corpus import load_labelled, read_splits, read_table


def labelled(spark, data):
    return spark.createDataFrame(data, "doc_id int, text string, toxicity int")


def test_clean_rows_drops_null_and_blank(spark):
    df = labelled(spark, [
        (0, None, 1), (1, "", 0), (2, " \t\n", 0), (3, "　\x85\x1c", 1), (4, "fine", None),
        (5, "ok", 0), (6, " x ", 1),
    ])
    assert sorted(r.doc_id for r in P.clean_rows(df).collect()) == [5, 6]


def test_clean_rows_keeps_texts_with_their_labels(spark):
    # A dropped first row must not shift the others.
    df = labelled(spark, [(0, None, 1), (1, "good", 0), (2, "bad", 1)])
    assert {(r.text, r.toxicity) for r in P.clean_rows(df).collect()} == {("good", 0), ("bad", 1)}


@pytest.mark.parametrize("column", ["text", "toxicity"])
def test_missing_column_is_named(spark, column):
    df = labelled(spark, [(0, "a", 0)]).withColumnRenamed(column, "other")
    with pytest.raises(ValueError, match=column):
        P.clean_rows(df)


def test_clean_drop_counts(spark):
    df = labelled(spark, [(0, "a", 0), (1, "", 0), (2, "b", None), (3, "c", 1)]).withColumn(
        "split", F.when(F.col("doc_id") < 3, "train").otherwise("test")
    )
    got = {r["split"]: (r["n_before"], r["n_after"], r["n_dropped"])
           for r in rows(P.clean_drop_counts(df))}
    assert got == {"train": (3, 1, 2), "test": (1, 1, 0)}


@pytest.mark.parametrize(
    "kind, values, expected",
    [
        ("int", [0, 1], [0, 1]),
        ("bigint", [0, 1], [0, 1]),
        ("string", ["0", "1"], [0, 1]),
        ("boolean", [False, True], [0, 1]),
        ("double", [0.0, 1.0], [0, 1]),
    ],
)
def test_label_domain(spark, kind, values, expected):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, toxicity {kind}")
    out = P.map_labels(df)
    assert out.columns == ["i", "labels"]
    assert [r.labels for r in out.orderBy("i").collect()] == expected
    assert dict(out.dtypes)["labels"] == "int"


def test_label_column_named_labels_is_kept(spark):
    df = spark.createDataFrame([(1,)], "labels int")
    assert P.map_labels(df, "labels").columns == ["labels"]


@pytest.mark.parametrize("kind, bad", [("int", 99), ("string", "yes"), ("double", 0.5), ("string", " 1"), ("int", None)])
def test_unknown_label_fails(spark, kind, bad):
    df = spark.createDataFrame([(bad,)], f"toxicity {kind}")
    with pytest.raises(PySparkException, match="unexpected value"):
        P.map_labels(df).collect()


def test_label_of_other_type_is_refused(spark):
    df = spark.createDataFrame([([1],)], "toxicity array<int>")
    with pytest.raises(ValueError, match="array"):
        P.map_labels(df)


def test_lenient_labels(spark):
    df = spark.createDataFrame([(0, "1"), (1, "x"), (2, None)], "i int, toxicity string")
    good, bad = P.split_by_label_validity(df)
    assert rows(good) == [{"i": 0, "labels": 1}]
    assert sorted(r.i for r in bad.collect()) == [1, 2]


def test_error_codes(spark):
    texts = [None, "", "  ", "ok", "x" * 4096, "x" * 4097, " " * 5000, "\U0001f600" * 4096]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r.error_code for r in P.validate_inputs(df).orderBy("i").collect()]
    assert got == ["EMPTY", "EMPTY", "EMPTY", None, None, "TOO_LONG", "TOO_LONG", None]


def test_prepare_rows(spark):
    df = labelled(spark, [(0, " a  b ", 1), (1, " ", 0)])
    assert rows(prepare_rows(df)) == [{"doc_id": 0, "text": "a b", "labels": 1}]
    assert rows(prepare_rows(df, normalize=False))[0]["text"] == " a  b "


def test_load_labelled_joins_and_checks(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id int, text string")
    labels = spark.createDataFrame([(2, 1), (3, 0)], "doc_id int, toxic int")
    assert rows(load_labelled(docs, labels)) == [{"doc_id": 2, "text": "b", "toxicity": 1}]
    with pytest.raises(ValueError, match="toxic"):
        load_labelled(docs, docs)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_read_splits_from_each_format(spark, tmp_path, fmt):
    schema = "text string, toxicity int"
    for name, label in (("train", 0), ("test", 1)):
        df = spark.createDataFrame([(f'say "{name}",\nplease', label)], schema)
        writer = df.write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True).option("escape", '"')
        writer.save(str(tmp_path / name))
    paths = {n: str(tmp_path / n) for n in ("train", "test")}
    got = rows(read_splits(spark, paths, fmt, schema if fmt in ("json", "csv") else None))
    assert sorted((r["split"], r["text"], r["toxicity"]) for r in got) == [
        ("test", 'say "test",\nplease', 1), ("train", 'say "train",\nplease', 0)]


def test_text_formats_need_a_schema(spark):
    with pytest.raises(ValueError, match="schema"):
        read_table(spark, "/nowhere", "json")


def corpus_file(tmp_path, body, name):
    folder = tmp_path / "corpus"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(body, encoding="utf-8")
    return str(folder)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = corpus_file(tmp_path, "toxicity,extra,text\n1,x,a\n0,y,b\n", "a.csv")
    got = rows(read_table(spark, path, "csv", "text string, toxicity int"))
    assert got == [{"text": "a", "toxicity": 1}, {"text": "b", "toxicity": 0}]


@pytest.mark.parametrize(
    "fmt, body", [("csv", "text,other\na,1\n"), ("json", '{"text": "a", "other": 1}\n')]
)
def test_a_missing_column_is_refused(spark, tmp_path, fmt, body):
    path = corpus_file(tmp_path, body, f"a.{fmt}")
    with pytest.raises(ValueError, match="lacks columns"):
        read_table(spark, path, fmt, "text string, toxicity int")


@pytest.mark.parametrize(
    "fmt, body", [("csv", "text,toxicity\na,yes\n"), ("json", '{"text": "a", "toxicity": "yes"}\n')]
)
def test_a_malformed_label_fails_the_read(spark, tmp_path, fmt, body):
    path = corpus_file(tmp_path, body, f"a.{fmt}")
    with pytest.raises(Exception, match="(?i)malformed|cannot parse|MALFORMED"):
        read_table(spark, path, fmt, "text string, toxicity int").collect()


def test_files_with_another_header_are_refused(spark, tmp_path):
    corpus_file(tmp_path, "text,toxicity\na,1\n", "a.csv")
    path = corpus_file(tmp_path, "toxicity,text\n1,b\n", "b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_table(spark, path, "csv", "text string, toxicity int").collect()
