"""The operators of this package as queries over the given tables, and their SQL."""

from __future__ import annotations

import importlib
import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.llm import (
    audit,
    bpe,
    collocations,
    exact,
    language,
    licenses,
    lines,
    mixing,
    neardup,
    neighbours,
    substring,
    suffixes,
    warc,
)


def let_workers_import(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it, too."""
    root, found = str(Path(__file__).parents[2]), spark.sparkContext.environment
    paths = [p for p in found.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        found["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The public vocabulary file of the BPE queries; its package is part of the environment."""
    return importlib.import_module("public_tokenizers").path("word_bpe_49k.json")


def op1_byte_network(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.train_on(docs))
    return found.select("doc_id", language.is_held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op2_substring_dedup(spark, sf_dir):
    kept = substring.remove_repeated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_winnow_lines(spark, sf_dir):
    kept = lines.remove_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "_row.doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op4_exact_dedup(spark, sf_dir):
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_warc_archive(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return warc.read_archive(spark, warc.write_archive(pages))


def op6_license_paragraphs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return licenses.scan_licenses(docs, licenses.train_licenses(docs))


def op7_vantage_trees(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(rows, F.col("vec_id") % 20 == 0)


def op8_probminhash(spark, sf_dir):
    return neardup.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op9_bpe_words(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, tokenizer_path(), decode=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_mix_sources(spark, sf_dir):
    return mixing.mix_counts(table(spark, sf_dir, "documents")).drop("copies")


def op11_suffix_arrays(spark, sf_dir):
    kept = suffixes.remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_filter_audit(spark, sf_dir):
    return audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_network": op1_byte_network,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_winnow_lines": op3_winnow_lines,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_warc_archive": op5_warc_archive,
    "op6_license_paragraphs": op6_license_paragraphs,
    "op7_vantage_trees": op7_vantage_trees,
    "op8_probminhash": op8_probminhash,
    "op9_bpe_words": op9_bpe_words,
    "op10_mix_sources": op10_mix_sources,
    "op11_suffix_arrays": op11_suffix_arrays,
    "op12_filter_audit": op12_filter_audit,
    "op13_collocations": op13_collocations,
}

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(sha1(coalesce(html, '')),"
    f" {5 * (i // 4) + 1}, 5))::BIGINT >> {15 - 5 * (i % 4)}) & 31)::INTEGER, 1)"
    for i in range(32)
)

ORACLES: dict[str, str] = {
    "op2_substring_dedup": """
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents),
        placed AS (
            SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM split),
        windows AS (
            SELECT doc_id, pos, list(word) OVER next AS words, count(*) OVER next AS n
            FROM placed
            WINDOW next AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
        hashed AS (
            SELECT doc_id, pos, md5(array_to_string(words, ' ')) AS h FROM windows WHERE n = 35),
        repeated AS (SELECT h FROM hashed GROUP BY h HAVING count(*) > 1),
        starts AS (SELECT doc_id, pos, TRUE AS hit FROM hashed SEMI JOIN repeated USING (h)),
        judged AS (
            SELECT placed.doc_id, placed.pos, word,
                   coalesce(bool_or(hit) OVER (PARTITION BY placed.doc_id ORDER BY placed.pos
                       ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), FALSE) AS removed
            FROM placed LEFT JOIN starts ON starts.doc_id = placed.doc_id AND starts.pos = placed.pos)
        SELECT documents.doc_id, count(word) AS n_words,
               count(*) FILTER (removed) AS n_removed,
               sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT removed), ''))
                   AS kept_sha256
        FROM documents LEFT JOIN judged ON judged.doc_id = documents.doc_id
        GROUP BY documents.doc_id""",
    "op3_winnow_lines": """
        WITH split AS (
            SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text <> ''),
        placed AS (
            SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM split),
        solid AS (
            SELECT *, lead(line) OVER next AS after, lead(i) OVER next AS after_i
            FROM placed WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
            WINDOW next AS (PARTITION BY doc_id ORDER BY i)),
        judged AS (
            SELECT doc_id, i, after_i,
                   row_number() OVER (PARTITION BY line, after ORDER BY doc_id, i) > 1 AS later
            FROM solid WHERE after IS NOT NULL),
        single AS (
            SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1 AS later
            FROM solid WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= 50),
        gone AS (
            SELECT doc_id, i FROM judged WHERE later
            UNION SELECT doc_id, after_i FROM judged WHERE later
            UNION SELECT doc_id, i FROM single WHERE later)
        SELECT documents.doc_id, count(placed.i) AS n_lines, count(gone.i) AS n_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY placed.i)
                               FILTER (gone.i IS NULL), '')) AS kept_sha256
        FROM documents LEFT JOIN placed ON placed.doc_id = documents.doc_id
        LEFT JOIN gone ON gone.doc_id = placed.doc_id AND gone.i = placed.i
        GROUP BY documents.doc_id""",
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op5_warc_archive": f"""
        WITH sized AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   {_BASE32} AS payload_digest,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS winner
            FROM pages)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> winner THEN winner END AS refers_to
        FROM sized""",
    "op10_mix_sources": f"""
        WITH sized AS (
            SELECT doc_id, source, md5('{mixing.SEED}:' || doc_id) AS draw,
                   len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
            FROM documents),
        classed AS (
            SELECT *, CASE WHEN size > 0 THEN length(bin(size)) * 8 - 8
                      + size * 8 // (1::BIGINT << (length(bin(size)) - 1)::BIGINT) ELSE 0 END AS class
            FROM sized),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][
                       1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
            FROM classed GROUP BY source),
        levels AS (
            SELECT *, 2.0::DOUBLE * source_size AS cap,
                   (1.5::DOUBLE * sum(source_size) OVER ()
                    - coalesce(sum(2.0::DOUBLE * source_size) OVER (
                        ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
                   / sum(weight) OVER (
                        ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM sources),
        targets AS (
            SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target
            FROM levels),
        ranked AS (
            SELECT doc_id, size, source_size, target,
                   CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS expected,
                   row_number() OVER (
                       PARTITION BY classed.source ORDER BY class, draw, doc_id) AS rank
            FROM classed JOIN targets ON classed.source IS NOT DISTINCT FROM targets.source)
        SELECT doc_id, size, source_size, target,
               ((floor({mixing.offset(mixing.SEED)!r}::DOUBLE + expected * rank)
                 - floor({mixing.offset(mixing.SEED)!r}::DOUBLE + expected * (rank - 1))) * size
               )::BIGINT AS taken
        FROM ranked""",
    "op11_suffix_arrays": """
        WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        based AS (SELECT doc_id, h, unnest(range(0, len(h) // 2, 512)) AS base FROM bytes),
        chunks AS (SELECT doc_id, base, substr(h, 2 * base + 1, 2 * (512 + 199)) AS h FROM based),
        placed AS (
            SELECT doc_id, base, h, unnest(range(1, least(512, len(h) // 2) + 1)) AS p FROM chunks),
        windows AS (
            SELECT doc_id, base + p AS pos, md5(substr(h, 2 * p - 1, 400)) AS w
            FROM placed WHERE p + 199 <= len(h) // 2),
        repeated AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
        starts AS (SELECT doc_id, pos FROM windows SEMI JOIN repeated USING (w)),
        judged AS (
            SELECT placed.doc_id, base + p AS pos, substr(h, 2 * p - 1, 2) AS byte,
                   coalesce(bool_or(starts.pos IS NOT NULL) OVER (
                       PARTITION BY placed.doc_id ORDER BY base + p
                       ROWS BETWEEN 199 PRECEDING AND CURRENT ROW), FALSE) AS removed
            FROM placed LEFT JOIN starts ON starts.doc_id = placed.doc_id AND starts.pos = base + p),
        runs AS (
            SELECT *, removed AND NOT coalesce(lag(removed) OVER (
                PARTITION BY doc_id ORDER BY pos), FALSE) AS begins
            FROM judged)
        SELECT documents.doc_id, count(pos) AS n_bytes, count(*) FILTER (removed) AS n_removed,
               count(*) FILTER (begins) AS n_spans,
               sha256(unhex(coalesce(string_agg(byte, '' ORDER BY pos) FILTER (NOT removed), '')))
                   AS kept_sha256
        FROM documents LEFT JOIN runs ON runs.doc_id = documents.doc_id
        GROUP BY documents.doc_id""",
    "op12_filter_audit": """
        WITH texts AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws
            FROM documents),
        failed AS (
            SELECT doc_id, part,
                   CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t)
                          THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
            FROM texts),
        judged AS (
            SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
            FROM labels GROUP BY doc_id),
        counted AS (
            SELECT part, mask, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic,
                   count(*) AS n
            FROM failed LEFT JOIN judged ON judged.doc_id = failed.doc_id GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
        orders AS (
            SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
        steps AS (
            SELECT filter_order, step::INTEGER AS step,
                   (1 << (ascii(substr(filter_order, step, 1)) - 65)) AS bit,
                   list_sum([1 << (ascii(x) - 65) FOR x IN
                             string_split(substr(filter_order, 1, step - 1), '') IF x <> '']) AS before
            FROM orders, range(1, 6) AS r(step)),
        masked AS (SELECT filter_order, step, bit::BIGINT AS bit, coalesce(before, 0)::BIGINT AS before FROM steps),
        summed AS (
            SELECT part, filter_order, step, any_value(bit) AS bit,
                   sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
                   sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
                   sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
                   sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
                   sum(CASE WHEN good AND mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT
                       AS good_lost,
                   sum(CASE WHEN toxic AND mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT
                       AS toxic_lost
            FROM counted, masked GROUP BY part, filter_order, step)
        SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
        FROM summed""",
    "op13_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents),
        split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
        placed AS (
            SELECT lang, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
            FROM split, range(1, 5) AS r(size)),
        phrases AS (
            SELECT lang, array_to_string(ws[i : i + size - 1], ' ') AS phrase, any_value(size) AS size,
                   count(*) AS f
            FROM placed GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE size = 1 GROUP BY lang),
        frequent AS (SELECT *, string_split(phrase, ' ') AS ws FROM phrases WHERE f >= 30),
        cuts AS (
            SELECT lang, phrase, f AS a, unnest(range(1, size)) AS k, ws FROM frequent WHERE size > 1),
        scored AS (
            SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r,
                   2000000::HUGEINT * a // (x.f::HUGEINT + y.f) AS score
            FROM cuts
            JOIN frequent x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.ws[1 : k], ' ')
            JOIN frequent y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.ws[k + 1 :], ' ')),
        weakest AS (
            SELECT * FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        lengths AS (
            SELECT *, unnest(range(2, size)) AS m FROM frequent WHERE size > 2),
        inside AS (
            SELECT lang, f, ws, m, unnest(range(1, size - m + 2)) AS i FROM lengths),
        longest AS (
            SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(f) AS longer
            FROM inside GROUP BY ALL),
        ranked AS (
            SELECT weakest.lang, weakest.phrase, a, l, r, score, row_number() OVER (
                PARTITION BY weakest.lang ORDER BY score DESC, a DESC, weakest.phrase) AS rank
            FROM weakest LEFT JOIN longest
            ON longest.lang = weakest.lang AND longest.phrase = weakest.phrase
            WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
        FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
