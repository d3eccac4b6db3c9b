"""A training corpus from raw documents: identify, dedup, mix and encode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.llm import bpe, language, lines, mixing, neardup, queries
from veritally.session import store_table

#: A text is rejected if it has no language, or if the network is hardly surer than by chance.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; texts without letters go, and those nobody can tell."""
    queries.let_workers_import(spark)
    found = language.identify(docs, language.train_on(docs), keep=True)
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return found.where(known).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that were there before; those of which no word is left go.

    Before means by doc_id. An id that several texts share names none of them, and null names
    nothing; such texts stand in the order of a hash. Rows with one id and one text are one place.
    """
    rows, name = _with_names(docs)
    kept = lines.remove_repeated_lines(rows, key=name, keep=tuple(docs.columns))
    some = kept.where((F.col("n_removed") == 0) | F.col("kept_text").rlike(mixing.WORD))
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    same = F.col("n_removed") == 0
    return some.select(
        *[
            F.when(same, F.col(f"_row.{c}")).otherwise(changed[c]).alias(c)
            if c in changed
            else F.col(f"_row.{c}")
            for c in docs.columns
        ]
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: that with the smallest doc_id, one without only if all are.

    Null ids are told apart by a hash of the text. An id that several texts share names none of
    them; each of these texts is classed by itself. Rows with one id and one text are one document.
    """
    queries.let_workers_import(spark)
    rows, name = _with_names(docs)
    classes = store_table(neardup.near_duplicate_classes(rows, key=name).select(name, "class_id"), "classes")
    ids = rows.select(name, "doc_id").distinct()
    order = F.struct(F.col("doc_id").isNull(), "doc_id", name)
    members = classes.distinct().join(ids.hint("merge"), name)
    first = members.groupBy("class_id").agg(F.min(order)[name].alias(name))
    kept = rows.join(first.select(name).hint("merge"), name)
    repeated = store_table(classes.groupBy(name).count().where("count > 1").select(name), "repeated")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    # Texts are only brought together where a whole row repeats.
    alone = kept.join(repeated.hint("merge"), name, "left_anti").select(*docs.columns)
    one = F.min(F.struct(*[F.struct(F.col(c).isNull(), c) for c in docs.columns]))
    several = kept.join(repeated.hint("merge"), name, "left_semi").groupBy(name).agg(one.alias("_one"))
    parts = [F.col(f"_one.col{i + 1}.{c}").alias(c) for i, c in enumerate(docs.columns)]
    return alone.unionByName(several.select(*parts))


def _with_names(docs: DataFrame) -> tuple[DataFrame, str]:
    """Documents with a column that names one text each, and its name: the doc_id, or a hash.

    Hashes are from 2^62 on, so that texts without an id of their own come after the others.
    Documents are only joined with the ids of several texts if there are any.
    """
    name = "_row"
    while name in docs.columns:
        name = f"_{name}"
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    texts = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(text).alias("low"), F.max(text).alias("high"))
    shared = store_table(texts.where("low <> high").select(F.col("doc_id").alias("_shared")), "shared_ids")
    own = F.col("doc_id").cast("long")
    no_id = _late(text)
    if shared.isEmpty():
        return docs.withColumn(name, F.coalesce(own, no_id)), name
    named = docs.join(shared.hint("merge"), F.col("doc_id") == F.col("_shared"), "left")
    # Texts of a shared id get a hash of both, since other rows may have the text under their own id.
    of_two = F.when(F.col("_shared").isNotNull(), _late(F.xxhash64(F.lit("shared"), "doc_id", "text")))
    return store_table(named.withColumn(name, F.coalesce(of_two, own, no_id)).drop("_shared"), "named_rows"), name


def _late(hashed: Column) -> Column:
    half = 1 << 62
    return hashed.bitwiseAND(F.lit(half - 1)).bitwiseOR(F.lit(half))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    queries.let_workers_import(spark)
    encoded = bpe.encode_documents(docs, queries.tokenizer_path(), decode=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", identify_language),
    ("lines", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix),
    ("encode", encode),
]

#: Stages with a trained network, hashed sketches and a tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
