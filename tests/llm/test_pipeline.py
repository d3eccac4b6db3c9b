"""The pipeline against its stages done by hand, and the queries of this package."""

from __future__ import annotations

import hashlib
import math
import random
import struct
from pathlib import Path

import pytest
from compare import connect, difference
from pyspark.sql import functions as F
from test_dedup import lines_by_hand, near_classes_by_hand
from test_operators import spell, targets_by_hand

import __spark_entry__ as driver
import corpus_pipeline
from veritally.llm import language, mixing, queries

SF_DIR = "/root/testdata/sf0.001"

given_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    pick = random.Random(11)
    rows = []
    for i in range(90):
        letters = "abcdefgh" if i % 2 else "stuvwxyz"
        text = "\n".join(spell(f"{i}-{j}", letters, pick.randrange(4, 12)) for j in range(6))
        rows.append([i, text, "aa" if i % 2 else "zz", f"s{i % 5}"])
    for i in range(90, 100):  # near copies in one line, so that line dedup leaves them
        base = spell(i % 3, "abcdefgh", 80).split()
        base[i % 7] = f"x{'abcdefghij'[i % 10]}"
        rows.append([i, " ".join(base), "aa", None])
    rows += [[100, rows[0][1], "zz", "s1"], [101, None, "aa", "s1"], [102, "", "aa", "s1"], [103, "12 !", "aa", "s1"]]
    rows += [[104, "intro\n" + rows[4][1], "zz", "s2"], [105, rows[5][1] + "\nfoe", "aa", None]]
    folder = tmp_path_factory.mktemp("raw")
    df = spark.createDataFrame(
        [(*r, None if r[1] is None else len(r[1])) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    df.repartition(3).write.parquet(str(folder / "documents.parquet"))
    return str(folder), rows


def size_class(n):
    return n.bit_length() * 8 + n * 8 // 2 ** (n.bit_length() - 1) - 8 if n else 0


def mixed_by_hand(rows):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    target, out, u = targets_by_hand(sizes), [], mixing.offset(mixing.SEED)
    for s in sizes:
        mine = sorted(
            (size_class(len(t.split())), hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest(), i, t)
            for i, t, source in rows if source == s
        )
        c = target[s] / sizes[s]
        for rank, (_, _, i, t) in enumerate(mine, 1):
            out += [(i, t)] * (math.floor(u + c * rank) - math.floor(u + c * (rank - 1)))
    return out


def test_pipeline_equals_its_stages_by_hand(spark, raw):
    folder, rows = raw
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(queries.tokenizer_path())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    told = {r.doc_id: r for r in language.identify(docs, language.train_on(docs)).collect()}
    known = [r for r in rows if told[r[0]].lang_pred != "und" and told[r[0]].score >= corpus_pipeline.LEAST_SCORE]
    assert {r[0] for r in rows} - {r[0] for r in known} == {101, 102, 103}
    lines = lines_by_hand([(r[0], r[1]) for r in known], 2)
    left = {r[0]: (lines[r[0]][2], r[3]) for r in known if lines[r[0]][1] == 0 or lines[r[0]][2].split()}
    assert 100 not in left and left[104][0] == "intro"
    classes = near_classes_by_hand([(i, t) for i, (t, _) in left.items()])
    single = [(i, *left[i]) for i in left if classes[i] == i]
    assert len(single) < len(left)
    expected = []
    for i, text in mixed_by_hand(single):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        expected.append((i, len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got) == sorted(expected)


def test_stages_keep_the_columns_and_take_no_rows(spark, raw):
    docs = spark.read.parquet(f"{raw[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, raw[0]).dtypes == docs.dtypes
        assert stage(spark, docs, raw[0]).count() == 0


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(pairs):
    return [(i, t, "aa", "s", None if t is None else len(t)) for i, t in pairs]


def test_lines_of_texts_that_share_an_id(spark):
    a = [f"alpha {k} of the first" for k in range(3)]
    own = [f"own {k} of the second" for k in range(3)]
    third = [f"third {k} for itself" for k in range(3)]
    long_line = " ".join(f"l{k}" for k in range(60))
    pairs = [(1, "\n".join(a)), (5, "\n".join([own[0], a[0], a[1], *own[1:]])), (5, "\n".join(third))]
    pairs += [(None, f"{third[0]}\n{long_line}"), (None, f"none\n{a[1]}\n{a[2]}"), (9, f"x\n{long_line}\ny"), (9, None)]
    docs = spark.createDataFrame(rows_of(pairs), DOCUMENTS).withColumn("_row", F.lit(3))
    for parts in (1, 4):
        kept = corpus_pipeline.drop_repeated_lines(spark, docs.repartition(parts), "")
        assert kept.dtypes == docs.dtypes
        got = [(r.doc_id, r.text) for r in kept.collect()]
        assert (1, "\n".join(a)) in got  # the smallest id is the first place
        assert (5, "\n".join(own)) in got and (5, "\n".join(third)) in got  # nothing of the third text goes
        assert (None, "none") in got or any(t.startswith("none") and i is None for i, t in got)
        whole = [t for _, t in got if t and long_line in t]
        assert len(whole) == 1  # a long line stays once, wherever its text has its place
        assert (9, None) in got and len(got) == 7


def test_run_with_shared_and_without_ids(spark, tmp_path):
    """Nothing that is clean gets lost, whatever the ids."""
    texts = [spell(f"run-{i}", "abcdefgh" if i % 2 else "stuvwxyz", 40) for i in range(60)]
    pairs = [(i, t) for i, t in enumerate(texts[:40])] + [(None, t) for t in texts[40:50]] + [(7, t) for t in texts[50:]]
    data = [(i, t, "aa" if texts.index(t) % 2 else "zz", "s", len(t)) for i, t in pairs]
    spark.createDataFrame(data, DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.store_table(stage(spark, docs, str(tmp_path)), name)
    assert sorted(r.text for r in docs.collect()) == sorted(texts)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 60


def test_near_duplicates_keep_one_of_each_class_without_or_with_shared_ids(spark):
    texts = [spell(f"null-{i}", "abcdefgh", 80) for i in range(9)]
    near = [f"{t} {' '.join(t.split()[-3:])}" for t in texts]
    rows = [(None, t) for t in texts[:5]] + [(None, texts[0]), (None, near[1])]  # five classes without ids
    rows += [(7, near[2]), (8, texts[3]), (9, near[3]), (None, near[3])]  # ids go before nulls
    rows += [(20, texts[5]), (20, texts[6]), (3, near[6]), (20, texts[5]), (20, texts[7])]  # one id, three texts
    rows += [(30, texts[8]), (30, texts[8])]
    df = spark.createDataFrame([(*r, "aa", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for parts in (1, 5):
        kept = corpus_pipeline.drop_near_duplicates(spark, df.repartition(parts), "")
        assert kept.dtypes == df.dtypes
        got = [(r.doc_id, r.text) for r in kept.collect()]
        nulls = {t for i, t in got if i is None}
        assert len(nulls) == 3 and {texts[0], texts[4]} < nulls and nulls & {texts[1], near[1]}
        told = [(7, near[2]), (8, texts[3]), (20, texts[5]), (3, near[6]), (20, texts[7]), (30, texts[8])]
        assert sorted(x for x in got if x[0] is not None) == sorted(told)


@given_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    found = driver.queries()[name](spark, SF_DIR)
    assert difference(found, connect(SF_DIR), driver.oracle_sql()[name]) is None


@given_tables
def test_all_are_registered():
    names = set(driver.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names


@given_tables
def test_language_is_right_on_held_out_documents(spark):
    found = queries.op1_byte_network(spark, SF_DIR).where("held_out")
    known = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    right = found.join(known, "doc_id").where("lang = lang_pred").count()
    assert right >= 0.95 * found.count()
