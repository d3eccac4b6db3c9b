"""CSV files read in byte ranges against the same files read whole."""

from __future__ import annotations

import csv as python_csv
import random
from pathlib import Path

import pytest
from compare import connect, difference
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from veritally import catalog
from veritally.oracle import ORACLES
from veritally.sinks.reports import write_csv
from veritally.sources import csv, csv_ranges
from veritally.sources.csv import read_by_name

SF_DIR = "/root/testdata/sf0.001"
WANTED = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("n", IntegerType())])


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few dozen bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "61", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def records(seed=1, n=60):
    pick = random.Random(seed)
    parts = ["word", "\n", "\n\n", '"', '""', ",", " ", "é", '"\n"', "x" * 90, '",\n"']
    out = []
    for i in range(n):
        text = "".join(pick.choice(parts) for _ in range(pick.randrange(8)))
        out.append((i, "a" + text + "z" if i % 7 else None, pick.choice([None, 1, -5])))
    return out + [(n, "line\n" * 80, 1), (n + 1, '"' * 300, 2), (n + 2, "last", 3)]


def write(path, data, header=("doc_id", "text", "n"), end="\n"):
    with open(path, "w", newline="") as f:
        writer = python_csv.writer(f, lineterminator=end)
        writer.writerow(header)
        writer.writerows([["" if v is None else v for v in r] for r in data])


def both(spark, path, **options):
    whole = sorted(map(str, read_by_name(spark, path, WANTED, "file", **options).collect()))
    ranged = sorted(map(str, read_by_name(spark, path, WANTED, "file", whole_file_bytes=0).collect()))
    return whole, ranged


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_one_large_file_equals_the_one_task_read(small_ranges, tmp_path, seed):
    data = records(seed)
    write(tmp_path / "a.csv", data)
    whole, ranged = both(small_ranges, str(tmp_path / "a.csv"))
    assert ranged == whole and len(ranged) == len(data)
    got = {r["doc_id"]: (r["text"], r["n"]) for r in rows(read_by_name(small_ranges, str(tmp_path), WANTED, "f", 0))}
    assert got == {i: (t, n) for i, t, n in data}


def test_many_tasks_read_one_file(small_ranges, tmp_path):
    write(tmp_path / "a.csv", records())
    found = csv_ranges.read_records(small_ranges, str(tmp_path / "a.csv"))
    starts = {r["start"] for r in rows(found.select("start").distinct())}
    assert len(starts) > 10
    assert small_ranges.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 10


def test_several_files_and_line_ends(small_ranges, tmp_path):
    data = records(5)
    for k, end in enumerate(["\n", "\r\n", "\n"]):
        write(tmp_path / f"{k}.csv", [(i + 1000 * k, t, n) for i, t, n in data], end=end)
    with open(tmp_path / "3.csv", "w", newline="") as f:
        f.write('doc_id,text,n\r\n\r\n9001,"a\r\nb",1\r\n\r\n9002,c,2')  # no end at the last line
    whole, ranged = both(small_ranges, str(tmp_path))
    assert ranged == whole and len(ranged) == 3 * len(data) + 2


def test_what_this_library_writes(small_ranges, tmp_path):
    df = small_ranges.createDataFrame(records(8), WANTED)
    write_csv(df.select("n", "text", F.lit(" x ").alias("more"), "doc_id").repartition(2), str(tmp_path / "t"))
    whole, ranged = both(small_ranges, str(tmp_path / "t"))
    assert ranged == whole and len(ranged) == df.count()


def test_header_only_and_empty(small_ranges, tmp_path):
    write(tmp_path / "a.csv", [])
    assert both(small_ranges, str(tmp_path / "a.csv")) == ([], [])


@pytest.mark.parametrize("line", ["1,x", "1,x,y", "1,x,2,3", '1,"never closed,2\n2,b,3'])
def test_malformed_records_fail_the_read(small_ranges, tmp_path, line):
    (tmp_path / "a.csv").write_text(f"doc_id,text,n\n0,fine,1\n{line}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_by_name(small_ranges, str(tmp_path), WANTED, "file", whole_file_bytes=0).collect()


def test_headers_are_compared(small_ranges, tmp_path):
    write(tmp_path / "a.csv", [(1, "a", 1)])
    write(tmp_path / "b.csv", [(1, "a", 1)], header=("text", "doc_id", "n"))
    with pytest.raises(ValueError, match="headers"):
        read_by_name(small_ranges, str(tmp_path), WANTED, "file", whole_file_bytes=0)
    write(tmp_path / "b.csv", [(1, "a", 1)], header=("doc_id", "text", "m"))
    with pytest.raises(ValueError, match="lacks"):
        read_by_name(small_ranges, str(tmp_path / "b.csv"), WANTED, "file", whole_file_bytes=0)
    with pytest.raises(FileNotFoundError):
        read_by_name(small_ranges, str(tmp_path / "c.csv"), WANTED, "file")


def test_the_limit_on_ranges(small_ranges, tmp_path, monkeypatch):
    write(tmp_path / "a.csv", records())
    monkeypatch.setattr(csv_ranges, "MOST_RANGES", 3)
    with pytest.raises(ValueError, match="maxPartitionBytes"):
        csv_ranges.read_records(small_ranges, str(tmp_path / "a.csv"))


def test_default_reads_small_files_whole(spark, tmp_path):
    write(tmp_path / "a.csv", records())
    assert csv.WHOLE_FILE_BYTES > (tmp_path / "a.csv").stat().st_size
    plan = read_by_name(spark, str(tmp_path), WANTED, "file")._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")
def test_a_large_corpus_is_written_by_many_tasks(spark, monkeypatch, tmp_path):
    parts = tmp_path / "documents.parquet"
    spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(4).write.parquet(str(parts))
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    stored = sum(f.stat().st_size for f in parts.glob("*.parquet"))
    monkeypatch.setattr(catalog, "CSV_FILE_BYTES", stored // 4 + 1, raising=False)
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: str(tmp_path / name))
    found = catalog.q_corpus_csv_ranges(spark, str(tmp_path))
    assert len(list((tmp_path / "corpus_csv_ranges").glob("part-*"))) == 4
    assert difference(found, connect(SF_DIR), ORACLES["corpus_csv_ranges"]) is None
