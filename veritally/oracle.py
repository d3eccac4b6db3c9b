"""The same queries as SQL for DuckDB, written straight from their definitions.

Where the Spark side takes a shortcut that scales (one pass, prefix sums, late
fetching), the SQL takes the direct way, so the two check each other.
"""

from __future__ import annotations


def _hash32(key: str, salt: object) -> str:
    return f"('0x' || substr(md5({key} || ':{salt}'), 1, 8))::BIGINT"


_LABELLED = f"""
labelled AS (
  SELECT d.doc_id, d.text, d.lang, d.source, l.toxic AS labels
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
),
scored AS (
  SELECT *, ((CASE WHEN labels = 1 THEN 2500 ELSE 0 END) + {_hash32("doc_id", "score")} % 7501)
            / 10000.0::DOUBLE AS toxic_prob
  FROM labelled
)"""

_SPLIT = f"""{_LABELLED},
hashed AS (SELECT *, {_hash32("doc_id", 42)} / 4294967296.0::DOUBLE AS u FROM scored),
split_rows AS (
  SELECT *, CASE WHEN u < 0.1 THEN 'test' WHEN u < 0.2 THEN 'validation' ELSE 'train' END AS split
  FROM hashed
)"""

_NORMAL = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
_TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]')"


def _ratio(part: str, whole: str, undefined: str = "NULL") -> str:
    return f"CASE WHEN {whole} = 0 THEN {undefined} ELSE ({part})::DOUBLE / ({whole})::DOUBLE END"


def _sweep(source: str, grid: str = "0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9") -> str:
    """CTEs that end in ``sweep``: nine independent counts over ``source``."""
    values = ", ".join(f"({i}, {t}::DOUBLE)" for i, t in enumerate(grid.split(",")))
    return f"""
grid(pos, threshold) AS (VALUES {values}),
counts AS (
  SELECT g.pos, g.threshold,
    count(*) FILTER (WHERE labels = 1 AND toxic_prob >= g.threshold) AS tp,
    count(*) FILTER (WHERE labels = 0 AND toxic_prob >= g.threshold) AS fp,
    count(*) FILTER (WHERE labels = 0 AND toxic_prob < g.threshold) AS tn,
    count(*) FILTER (WHERE labels = 1 AND toxic_prob < g.threshold) AS fn
  FROM grid g LEFT JOIN {source} ON TRUE GROUP BY 1, 2
),
ratios AS (
  SELECT *, {_ratio("tp", "tp + fp", "0.0")} AS p, {_ratio("tp", "tp + fn", "0.0")} AS r,
    {_ratio("tp + tn", "tp + fp + tn + fn", "0.0")} AS a
  FROM counts
),
sweep AS (
  SELECT pos, threshold, round(p, 4) AS precision, round(r, 4) AS recall,
    round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 4) AS f1,
    round(a, 4) AS accuracy, tp, fp, tn, fn
  FROM ratios
)"""


_METRICS = "threshold, precision, recall, f1, accuracy, tp, fp, tn, fn"

_POINTS = f"""
points AS (
  SELECT 'best_f1' AS operating_point, 0 AS ord,
    (SELECT pos FROM sweep ORDER BY f1 DESC, pos LIMIT 1) AS pos
  UNION ALL SELECT 'high_recall_threshold', 1,
    (SELECT pos FROM sweep WHERE recall >= 0.85 ORDER BY pos LIMIT 1)
  UNION ALL SELECT 'high_precision_threshold', 2,
    (SELECT pos FROM sweep WHERE precision >= 0.90 ORDER BY pos DESC LIMIT 1)
)
SELECT operating_point, {_METRICS} FROM points LEFT JOIN sweep USING (pos)"""

# Running counts per distinct score, from a sum over all higher scores.
_RUNNING = f"""{_LABELLED},
grouped AS (
  SELECT toxic_prob AS score, count(*) FILTER (WHERE labels = 1) AS pos,
    count(*) FILTER (WHERE labels = 0) AS neg
  FROM scored GROUP BY 1
),
running AS (
  SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
    sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all,
    lead(pos) OVER (ORDER BY score DESC) AS next_pos,
    lead(neg) OVER (ORDER BY score DESC) AS next_neg,
    row_number() OVER (ORDER BY score DESC) AS rn
  FROM grouped
  WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""

# The last point of each cell; the number of cells follows from 200 points.
_CELLS = f"""{_RUNNING},
bits AS (SELECT *, length(bin(p_all::BIGINT)) + length(bin(n_all::BIGINT)) AS bits FROM running),
steps AS (SELECT *, greatest(98 // bits, 1)::BIGINT AS g FROM bits),
cells AS (
  SELECT *, (197 - g * bits) // 2 AS k, length(bin(tp::BIGINT)) AS tp_bits, length(bin(fp::BIGINT)) AS fp_bits
  FROM steps
),
kept AS (
  SELECT * FROM cells QUALIFY row_number() OVER (
    PARTITION BY (rn = 1), tp * k // greatest(p_all, 1), fp * k // greatest(n_all, 1),
      CASE WHEN tp > 0 THEN tp_bits * g + tp * g // (1::HUGEINT << (tp_bits - 1)::HUGEINT) - g ELSE 0 END,
      CASE WHEN fp > 0 THEN fp_bits * g + fp * g // (1::HUGEINT << (fp_bits - 1)::HUGEINT) - g ELSE 0 END
    ORDER BY tp + fp DESC) = 1
)"""

_SCORE_TABLE = f"""{_LABELLED},
given AS (SELECT doc_id, toxic_prob FROM scored WHERE doc_id % 10 <> 3),
score_table AS (
  SELECT * FROM given UNION ALL SELECT * FROM given WHERE doc_id % 25 = 1
  UNION ALL SELECT doc_id, 0.5::DOUBLE FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
),
keys AS (
  SELECT doc_id, count(r) AS n_rows, count(s) AS n_scores FROM (
    SELECT doc_id, 1 AS r, NULL::INT AS s FROM labelled UNION ALL SELECT doc_id, NULL, 1 FROM score_table)
  GROUP BY 1
),
named AS (
  SELECT doc_id, CASE WHEN n_rows > 1 OR n_scores > 1 THEN 'double' WHEN n_scores = 0 THEN 'missing'
    WHEN n_rows = 0 THEN 'orphan' ELSE 'aligned' END AS status, n_rows, n_scores FROM keys
)"""

_SOLVABLE = f"""{_SPLIT},
drawn AS (
  SELECT doc_id, split, lang,
    ({_hash32("doc_id", "coin")} % 100 < CASE WHEN lang = 'en' THEN 80 ELSE 25 END)::INT AS y FROM split_rows
),
shares AS (
  SELECT lang, count(*) AS n_train, count(*) FILTER (WHERE y = 1) AS n_toxic FROM drawn
  WHERE split = 'train' GROUP BY 1
),
judged AS (
  SELECT y, n_toxic::DOUBLE / n_train::DOUBLE AS p,
    round(n_toxic::DOUBLE / n_train::DOUBLE, 4) AS score FROM drawn JOIN shares USING (lang) WHERE split = 'validation'
)"""

_AUC = """
auc AS (
  SELECT sum(CASE WHEN p.toxic_prob > n.toxic_prob THEN 2
                  WHEN p.toxic_prob = n.toxic_prob THEN 1 ELSE 0 END)::DOUBLE
         / (2 * count(*))::DOUBLE AS roc_auc
  FROM scored p JOIN scored n ON p.labels = 1 AND n.labels = 0
)"""

_MISTAKES = """
wrong AS (
  SELECT doc_id, text, labels AS true_label, (toxic_prob >= 0.5)::INT AS predicted_label, toxic_prob,
    CASE WHEN toxic_prob >= 0.5 THEN 'FP' ELSE 'FN' END AS error_type
  FROM scored WHERE labels <> (toxic_prob >= 0.5)::INT
),
mistakes AS (
  SELECT * FROM (SELECT * FROM wrong WHERE error_type = 'FP' ORDER BY toxic_prob DESC, doc_id LIMIT 50)
  UNION ALL
  SELECT * FROM (SELECT * FROM wrong WHERE error_type = 'FN' ORDER BY toxic_prob, doc_id LIMIT 50)
)"""

_SLICES = r"""
sliced AS (
  SELECT labels = (toxic_prob >= 0.5)::INT AS ok, unnest([
    CASE WHEN length(text) < 50 THEN 'short_text_lt50chars'
         WHEN length(text) < 200 THEN 'medium_text_50_200chars' ELSE 'long_text_gt200chars' END,
    CASE WHEN contains(text, '!') OR contains(text, '?') THEN 'contains_exclamation_or_question'
         ELSE 'no_exclamation_or_question' END,
    CASE WHEN strlen(text) > length(text) THEN 'contains_non_ascii' ELSE 'ascii_only' END
  ]) AS slice FROM scored
),
names(slice) AS (VALUES ('short_text_lt50chars'), ('medium_text_50_200chars'), ('long_text_gt200chars'),
  ('contains_exclamation_or_question'), ('no_exclamation_or_question'), ('contains_non_ascii'),
  ('ascii_only'))
SELECT slice, count(ok) AS n, count(*) FILTER (WHERE ok) AS n_correct,
  round(CASE WHEN count(ok) = 0 THEN NULL
        ELSE (count(*) FILTER (WHERE ok))::DOUBLE / count(ok)::DOUBLE END, 4) AS accuracy
FROM names LEFT JOIN sliced USING (slice) GROUP BY 1"""

_PROBES = f"""{_LABELLED},
probes AS (
  SELECT doc_id, text, lang AS category, labels AS expected_label, toxic_prob AS toxic_probability,
    (toxic_prob >= 0.5)::INT AS predicted_label,
    CASE WHEN toxic_prob >= 0.5 THEN toxic_prob ELSE 1 - toxic_prob END AS confidence,
    labels = (toxic_prob >= 0.5)::INT AS is_correct
  FROM scored
)"""

_PROBE_SUMMARY = f"""{_PROBES},
probe_counts AS (
  SELECT CASE WHEN grouping(category) = 1 THEN 'overall' ELSE 'category' END AS scope, category,
    count(*) AS n, count(*) FILTER (WHERE is_correct) AS n_correct,
    count(*) FILTER (WHERE expected_label = 1 AND predicted_label = 1) AS tp,
    count(*) FILTER (WHERE expected_label = 0 AND predicted_label = 1) AS fp,
    count(*) FILTER (WHERE expected_label = 1 AND predicted_label = 0) AS fn
  FROM probes GROUP BY GROUPING SETS ((), (category))
),
probe_ratios AS (
  SELECT *, {_ratio("tp", "tp + fp")} AS p, {_ratio("tp", "tp + fn")} AS r FROM probe_counts
),
summary AS (
  SELECT scope, category, n, n_correct, round(n_correct::DOUBLE / n::DOUBLE, 4) AS accuracy,
    round(p, 4) AS precision, round(r, 4) AS recall,
    round(CASE WHEN p > 0 AND r > 0 THEN 2 * p * r / (p + r) END, 4) AS f1,
    round(n_correct::DOUBLE / n::DOUBLE, 4) < 0.75 AS needs_attention
  FROM probe_ratios
)"""

_WORDS = r"len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''))"
_LONG = f"""{_LABELLED},
lengths AS (
  SELECT labels, 'char_len' AS measure, length(text)::BIGINT AS v FROM labelled
  UNION ALL SELECT labels, 'word_len', {_WORDS}::BIGINT FROM labelled
)"""


def _histogram(source: str, group: str, bins: int) -> str:
    """CTEs and SELECT over ``source`` with columns ``group`` and ``v``."""
    slot = f"least((({bins} * (v - lo)) / (hi - lo))::DOUBLE, {bins - 1})"
    return f"""
ends AS (SELECT {group}, min(v)::DOUBLE AS lo, max(v)::DOUBLE AS hi FROM {source} GROUP BY {group}),
ranges AS (
  SELECT {group}, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
    CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM ends
),
placed AS (
  SELECT {group}, floor({slot})::BIGINT + 1 AS bin, count(*) AS n
  FROM {source} JOIN ranges USING ({group}) GROUP BY ALL
),
frame AS (SELECT {group}, lo, (hi - lo) / {bins} AS w, unnest(range(1, {bins + 1})) AS bin FROM ranges)
SELECT {group}, bin::BIGINT AS bin, round(lo + (bin - 1) * w, 6) AS bin_start,
  round(lo + bin * w, 6) AS bin_end, coalesce(n, 0)::BIGINT AS n
FROM frame LEFT JOIN placed USING ({group}, bin)"""


_DOC_TOKENS = f"""
doc_tokens AS (
  SELECT doc_id, (len({_TOKENS.format("text")}) + 2)::BIGINT AS n_tokens FROM documents
)"""

_VOCABULARY = f"""{_LABELLED},
clean AS (
  SELECT doc_id, labels, {_TOKENS.format(_NORMAL.format("text"))} AS toks FROM labelled
),
vocabulary AS (
  SELECT token, n, (row_number() OVER (ORDER BY n DESC, token) + 3)::INT AS id
  FROM (SELECT token, count(*) AS n FROM (SELECT unnest(toks) AS token FROM clean)
        GROUP BY 1 ORDER BY n DESC, token LIMIT 5000)
)"""

_LOOKED_UP = """
positions AS (
  SELECT doc_id, unnest(toks[1:126]) AS token, generate_subscripts(toks[1:126], 1) AS pos FROM clean
),
looked AS (
  SELECT p.doc_id, list(coalesce(v.id, 1) ORDER BY p.pos) AS ids
  FROM positions p LEFT JOIN vocabulary v ON p.token = v.token GROUP BY 1
),
framed AS (
  SELECT c.doc_id, c.labels, coalesce(l.ids, []) AS ids FROM clean c LEFT JOIN looked l USING (doc_id)
)
SELECT doc_id, labels,
  array_to_string([2] || ids || [3] || [0 FOR i IN range(126 - len(ids))], ' ') AS input_ids,
  array_to_string([1 FOR i IN range(len(ids) + 2)] || [0 FOR i IN range(126 - len(ids))], ' ')
    AS attention_mask
FROM framed"""

_ENCODED = f"WITH {_VOCABULARY}, {_LOOKED_UP}"

_ENCODED_BY_ALL = f"""WITH {_LABELLED},
clean AS (
  SELECT doc_id, labels, {_TOKENS.format(_NORMAL.format("text"))} AS toks FROM labelled
),
words AS (
  SELECT token, count(*) AS n
  FROM (SELECT unnest({_TOKENS.format(_NORMAL.format("text"))}) AS token FROM documents) GROUP BY 1
),
ranked AS (
  SELECT token, row_number() OVER (ORDER BY n DESC, token) + 3 AS id FROM words
),
numbers AS (
  SELECT l_orderkey * 40 + l_linenumber * 5 + unnest(range(0, 5)) AS number FROM lineitem
),
vocabulary AS (
  SELECT token, min(id)::INT AS id FROM (
    SELECT token, id FROM ranked WHERE id <= 400003
    UNION ALL SELECT number::VARCHAR, number + 400004 FROM numbers)
  GROUP BY 1
), {_LOOKED_UP}"""


def _record(prob: str, threshold: float) -> str:
    hit = f"{prob} >= {threshold}::DOUBLE"
    return f"""CASE WHEN {hit} THEN 'toxic' ELSE 'non-toxic' END AS label,
  ({hit})::INT AS label_id,
  CASE WHEN {hit} THEN {prob} ELSE 1 - {prob} END AS confidence,
  {prob} AS toxic_prob"""


_USER_TURNS = "requests AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user')"
_ERROR = r"""CASE WHEN text IS NULL THEN 'EMPTY' WHEN length(text) > 4096 THEN 'TOO_LONG'
       WHEN regexp_matches(text, '^\s*$') THEN 'EMPTY' END"""

_EMPTY = r"(CASE WHEN text IS NULL OR regexp_matches(text, '^\s*$') THEN 'EMPTY' END)"

_CORE = f"""{_LABELLED}, {_AUC.strip()},
top AS (
  SELECT count(*) FILTER (WHERE labels = 1 AND toxic_prob > 1 - toxic_prob) AS tp,
    count(*) FILTER (WHERE labels = 0 AND toxic_prob > 1 - toxic_prob) AS fp,
    count(*) FILTER (WHERE labels = 0 AND NOT toxic_prob > 1 - toxic_prob) AS tn,
    count(*) FILTER (WHERE labels = 1 AND NOT toxic_prob > 1 - toxic_prob) AS fn
  FROM scored
),
core AS (
  SELECT {_ratio("tp + tn", "tp + fp + tn + fn")} AS accuracy,
    {_ratio("tp", "tp + fp", "0.0")} AS precision, {_ratio("tp", "tp + fn", "0.0")} AS recall,
    {_ratio("2 * tp", "2 * tp + fp + fn", "0.0")} AS f1, (SELECT roc_auc FROM auc) AS roc_auc
  FROM top
)"""

_CONFUSION = """
SELECT count(*) FILTER (WHERE labels = 1 AND toxic_prob >= 0.5) AS tp,
  count(*) FILTER (WHERE labels = 0 AND toxic_prob >= 0.5) AS fp,
  count(*) FILTER (WHERE labels = 0 AND toxic_prob < 0.5) AS tn,
  count(*) FILTER (WHERE labels = 1 AND toxic_prob < 0.5) AS fn
FROM scored"""

_ROC_SELECT = """
SELECT score AS threshold, fp::DOUBLE / n_all::DOUBLE AS fpr, tp::DOUBLE / p_all::DOUBLE AS tpr
FROM running {}
UNION ALL SELECT NULL, 0.0, 0.0"""

_TEST_SPLIT = f"WITH {_SPLIT}, held_out AS (SELECT * FROM split_rows WHERE split = 'test'), "

ORACLES: dict[str, str] = {
    "load_labelled": f"""WITH {_LABELLED}
SELECT doc_id, text, lang, source, labels AS toxicity FROM labelled""",
    "probe_load": f"""WITH {_LABELLED}
SELECT text, labels AS expected_label, lang AS category, source AS notes FROM labelled""",
    "normalize_text": f"SELECT doc_id, {_NORMAL.format('text')} AS text FROM documents",
    "clean_rows": r"""SELECT d.doc_id, d.text, l.toxic AS toxicity
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.text IS NOT NULL AND NOT regexp_matches(d.text, '^\s*$') AND l.toxic IS NOT NULL""",
    "clean_drop_counts": rf"""WITH hashed AS (
  SELECT {_hash32("d.doc_id", 42)} / 4294967296.0::DOUBLE AS u,
    NOT regexp_matches(d.text, '^\s*$') AND l.toxic IS NOT NULL AS usable
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT CASE WHEN u < 0.1 THEN 'test' WHEN u < 0.2 THEN 'validation' ELSE 'train' END AS split,
  count(*) AS n_before, count(*) FILTER (WHERE usable) AS n_after,
  count(*) FILTER (WHERE NOT usable) AS n_dropped
FROM hashed GROUP BY 1""",
    "map_labels": f"WITH {_LABELLED} SELECT doc_id, labels FROM labelled",
    "validate_inputs": f"WITH {_USER_TURNS} SELECT conv_id, turn, {_ERROR} AS error_code FROM requests",
    "text_lengths": f"""SELECT doc_id, length(text)::BIGINT AS char_len, {_WORDS}::BIGINT AS word_len
FROM documents""",
    "train_val_test_split": f"WITH {_SPLIT} SELECT doc_id, labels, split FROM split_rows",
    "split_existing_test": f"""WITH {_SPLIT}
SELECT doc_id, labels,
  CASE WHEN lang <> 'en' THEN 'test' WHEN u < 0.1 THEN 'validation' ELSE 'train' END AS split
FROM split_rows""",
    "split_sizes": f"WITH {_SPLIT} SELECT split, count(*) AS n FROM split_rows GROUP BY 1",
    "subsample": f"""WITH {_SPLIT}
SELECT doc_id, text, labels, split FROM split_rows
QUALIFY row_number() OVER (PARTITION BY split ORDER BY md5(doc_id || ':42:sample'), doc_id)
  <= CASE WHEN split = 'train' THEN 200 ELSE 25 END""",
    "sample_per_label": f"""WITH {_LABELLED},
ranked AS (SELECT doc_id, text, labels,
  row_number() OVER (PARTITION BY labels ORDER BY md5(doc_id || ':0'), doc_id)::INT AS pick FROM labelled)
SELECT * FROM ranked WHERE pick <= 5""",
    "argmax_label": f"""WITH {_LABELLED}
SELECT doc_id, (toxic_prob > 1 - toxic_prob)::INT AS argmax_label FROM scored""",
    "softmax_scores": f"""WITH {_LABELLED}
SELECT doc_id, round(exp(toxic_prob) / (exp(1 - toxic_prob) + exp(toxic_prob)), 6) AS toxic_prob
FROM scored""",
    "predict": f"""WITH {_LABELLED}
SELECT doc_id, {_record("toxic_prob", 0.5)}, 0.5::DOUBLE AS threshold FROM scored""",
    "label_errors": f"""WITH {_LABELLED}
SELECT doc_id, labels, toxic_prob, (toxic_prob >= 0.5)::INT AS predicted_label,
  labels = (toxic_prob >= 0.5)::INT AS is_correct,
  CASE WHEN labels = (toxic_prob >= 0.5)::INT THEN NULL
       WHEN toxic_prob >= 0.5 THEN 'FP' ELSE 'FN' END AS error_type
FROM scored""",
    "confusion_matrix": f"WITH {_LABELLED} {_CONFUSION}",
    "metrics_at_threshold": f"WITH {_LABELLED}, {_sweep('scored', '0.5')} SELECT {_METRICS} FROM sweep",
    "threshold_sweep": f"WITH {_LABELLED}, {_sweep('scored')} SELECT {_METRICS} FROM sweep",
    "operating_points": f"WITH {_LABELLED}, {_sweep('scored')}, {_POINTS}",
    "core_metrics": f"WITH {_CORE} SELECT * FROM core",
    "roc_auc": f"""WITH {_LABELLED}, {_AUC}
SELECT count(*) FILTER (WHERE labels = 1) AS n_pos, count(*) FILTER (WHERE labels = 0) AS n_neg,
  (SELECT roc_auc FROM auc) AS roc_auc FROM scored""",
    "average_precision": f"""WITH {_RUNNING},
steps AS (SELECT tp::DOUBLE / p_all::DOUBLE AS r, tp::DOUBLE / (tp + fp)::DOUBLE AS p,
  lag(tp::DOUBLE / p_all::DOUBLE, 1, 0.0) OVER (ORDER BY rn) AS r_before FROM running)
SELECT round(sum((r - r_before) * p), 6) AS average_precision FROM steps""",
    "roc_curve": f"WITH {_RUNNING} {_ROC_SELECT.format('')}",
    "roc_curve_corners": f"""WITH {_RUNNING} {_ROC_SELECT.format(
        "WHERE rn = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg")}""",
    "pr_curve": f"""WITH {_RUNNING}
SELECT score AS threshold, tp::DOUBLE / (tp + fp)::DOUBLE AS precision,
  tp::DOUBLE / p_all::DOUBLE AS recall FROM running
UNION ALL SELECT NULL, 1.0, 0.0""",
    "misclassified_topk": f"WITH {_LABELLED}, {_MISTAKES} SELECT * FROM mistakes",
    "error_slices": f"WITH {_LABELLED}, {_SLICES}",
    "probe_score": f"""WITH {_PROBES}
SELECT doc_id, category, expected_label, toxic_probability, predicted_label, confidence, is_correct
FROM probes""",
    "probe_summary": f"WITH {_PROBE_SUMMARY} SELECT * FROM summary",
    "worst_category": f"""WITH {_PROBE_SUMMARY}
SELECT category, accuracy FROM summary WHERE scope = 'category' ORDER BY accuracy, category LIMIT 1""",
    "probe_error_examples": f"""WITH {_PROBES},
wrong AS (SELECT doc_id, text, expected_label, toxic_probability,
  CASE WHEN expected_label = 0 THEN 'FP' ELSE 'FN' END AS error_type FROM probes WHERE NOT is_correct)
SELECT * FROM (SELECT * FROM wrong WHERE error_type = 'FP'
               ORDER BY toxic_probability DESC, doc_id LIMIT 5)
UNION ALL
SELECT * FROM (SELECT * FROM wrong WHERE error_type = 'FN'
               ORDER BY toxic_probability, doc_id LIMIT 5)""",
    "label_distribution": f"""WITH {_SPLIT}
SELECT split, count(*) FILTER (WHERE labels = 1) AS n_toxic, count(*) AS n_total,
  round(100 * ((count(*) FILTER (WHERE labels = 1))::DOUBLE / count(*)::DOUBLE), 1) AS pct_toxic
FROM split_rows GROUP BY 1""",
    "label_counts": f"WITH {_SPLIT} SELECT split, labels, count(*) AS n FROM split_rows GROUP BY 1, 2",
    "class_imbalance": f"""WITH {_SPLIT},
pct AS (SELECT split, 100 * ((count(*) FILTER (WHERE labels = 1))::DOUBLE / count(*)::DOUBLE) AS pct
        FROM split_rows GROUP BY 1)
SELECT split, round(pct, 4) AS pct_toxic,
  round(CASE WHEN pct = 0 THEN NULL ELSE 100.0::DOUBLE / pct - 1 END, 4) AS imbalance_ratio FROM pct""",
    "length_stats": f"""WITH {_LONG}
SELECT labels, measure, count(*) AS count, round(avg(v), 1) AS mean, round(stddev_samp(v), 1) AS std,
  min(v) AS min, round(quantile_cont(v, 0.25), 1) AS q25, round(quantile_cont(v, 0.5), 1) AS q50,
  round(quantile_cont(v, 0.75), 1) AS q75, max(v) AS max
FROM lengths GROUP BY 1, 2""",
    "length_histogram": f"WITH {_LONG}, {_histogram('lengths', 'labels, measure', 50)}",
    "token_counts": f"WITH {_DOC_TOKENS} SELECT * FROM doc_tokens",
    "token_histogram": f"""WITH {_DOC_TOKENS},
counted AS (SELECT 'n_tokens' AS measure, n_tokens AS v FROM doc_tokens),
{_histogram('counted', 'measure', 60)}""",
    "token_coverage": f"""WITH {_DOC_TOKENS}
SELECT count(*) FILTER (WHERE n_tokens <= 128) AS n_within, count(*) AS n_texts,
  100 * ((count(*) FILTER (WHERE n_tokens <= 128))::DOUBLE / count(*)::DOUBLE) AS pct_within
FROM doc_tokens""",
    "build_vocab": f"WITH {_VOCABULARY} SELECT token, n, id FROM vocabulary",
    "encode_fixed_length": _ENCODED,
    "encode_large_vocabulary": _ENCODED_BY_ALL,
    "corpus_csv_ranges": f"""WITH {_LABELLED}
SELECT doc_id, text, source, labels AS toxicity FROM labelled""",
    "pr_curve_bounded": f"""WITH {_CELLS}
SELECT score AS threshold, tp::DOUBLE / (tp + fp)::DOUBLE AS precision, {_ratio("tp", "p_all")} AS recall
FROM kept UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE""",
    "roc_curve_bounded": f"""WITH {_CELLS}
SELECT score AS threshold, {_ratio("fp", "n_all")} AS fpr, {_ratio("tp", "p_all")} AS tpr FROM kept
UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE""",
    "align_rows": f"""WITH {_SCORE_TABLE}
SELECT doc_id, lang, labels, toxic_prob FROM named JOIN labelled USING (doc_id) JOIN score_table USING (doc_id)
WHERE status = 'aligned'""",
    "align_problems": f"WITH {_SCORE_TABLE} SELECT * FROM named WHERE status <> 'aligned'",
    "score_stats": f"""WITH {_LABELLED},
fractions AS (
  SELECT labels, 'toxic_prob' AS measure, toxic_prob AS v FROM scored
  UNION ALL SELECT labels, 'words_per_char', {_WORDS}::DOUBLE / greatest(length(text), 1)::DOUBLE FROM labelled)
SELECT labels, measure, count(*) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std,
  round(min(v), 6) AS min, round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
  round(quantile_cont(v, 0.75), 6) AS q75, round(max(v), 6) AS max
FROM fractions GROUP BY 1, 2""",
    "score_quantiles": f"""WITH {_LABELLED},
tied AS (SELECT labels, CASE WHEN doc_id % 3 = 0 THEN 0.3::DOUBLE ELSE toxic_prob END AS v FROM scored),
found AS (
  SELECT labels, count(*) AS n, quantile_cont(v, [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]) AS q FROM tied GROUP BY 1)
SELECT labels, 'toxic_prob' AS measure, n, unnest([0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0])::DOUBLE AS p,
  round(unnest(q), 9) AS quantile FROM found""",
    "score_histogram": f"""WITH {_LABELLED},
ends AS (SELECT labels, min(toxic_prob) AS lo, max(toxic_prob) AS hi, count(*) AS total FROM scored GROUP BY 1),
placed AS (
  SELECT labels, least(floor((toxic_prob - lo) / (hi - lo) * 20)::BIGINT + 1, 20) AS bin, count(*) AS n
  FROM scored JOIN ends USING (labels) GROUP BY 1, 2),
frame AS (SELECT labels, lo, (hi - lo) / 20 AS w, total, unnest(range(1, 21)) AS bin FROM ends)
SELECT labels, 'toxic_prob' AS measure, bin::BIGINT AS bin, round(lo + (bin - 1) * w, 6) AS bin_start,
  round(lo + bin * w, 6) AS bin_end, coalesce(n, 0)::BIGINT AS n,
  round(100 * (coalesce(n, 0)::DOUBLE / total::DOUBLE), 4) AS pct
FROM frame LEFT JOIN placed USING (labels, bin)""",
    "train_solvable": f"WITH {_SOLVABLE} SELECT lang, n_train, n_toxic, TRUE AS share_learned FROM shares",
    "sink_train_metrics_solvable": f"""WITH {_SOLVABLE},
counts AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE y = 1 AND p > 0.5) AS tp,
    count(*) FILTER (WHERE y = 0 AND p > 0.5) AS fp, count(*) FILTER (WHERE y = 1 AND p <= 0.5) AS fn,
    count(*) FILTER (WHERE y = 0 AND p <= 0.5) AS tn FROM judged),
pairs AS (
  SELECT sum(CASE WHEN a.score > b.score THEN 2 WHEN a.score = b.score THEN 1 ELSE 0 END)::DOUBLE
    / (2 * count(*))::DOUBLE AS roc_auc FROM judged a JOIN judged b ON a.y = 1 AND b.y = 0)
SELECT {_ratio("tp + tn", "n")} AS accuracy, {_ratio("tp", "tp + fp", "0.0")} AS precision,
  {_ratio("tp", "tp + fn", "0.0")} AS recall, {_ratio("2 * tp", "2 * tp + fp + fn", "0.0")} AS f1, roc_auc
FROM counts, pairs""",
    "batch_map": """SELECT doc_id, lang, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits,
  CASE WHEN text <> '' THEN length(regexp_replace(text, '[^0-9]', '', 'g'))::DOUBLE / length(text)::DOUBLE
    END AS digit_ratio,
  array_to_string([w[1] FOR w IN string_split(text, ' ')[1:10] IF w <> ''], '') AS initials FROM documents""",
    "user_metrics": f"""WITH {_LABELLED},
stated AS (
  SELECT labels, 1.0::DOUBLE / (1 + exp((1 - toxic_prob) - toxic_prob)) AS p FROM scored),
tenths AS (
  SELECT least(floor(p * 10)::INT, 9) AS tenth, abs(sum(p) - sum(labels)) / count(*)::DOUBLE AS gap
  FROM stated GROUP BY 1)
SELECT round(avg(-ln(CASE WHEN labels = 1 THEN p ELSE 1 - p END)), 6) AS log_loss_mean,
  count(*)::DOUBLE AS log_loss_rows, round((SELECT max(gap) FROM tenths), 6) AS calibration_largest_gap
FROM stated""",
    "udf_score": f"""WITH clean AS (SELECT doc_id, {_NORMAL.format("text")} AS t FROM documents),
shares AS (SELECT doc_id,
  length(regexp_replace(t, '[^aeiou]', '', 'g'))::DOUBLE / length(t)::DOUBLE AS p FROM clean)
SELECT doc_id, NULL::VARCHAR AS error_code, {_record("p", 0.35)}, 0.35::DOUBLE AS threshold FROM shares""",
    "evaluate_test_split": f"{_TEST_SPLIT} {_sweep('held_out')} SELECT {_METRICS} FROM sweep",
    "stream_score": f"""WITH {_USER_TURNS},
checked AS (SELECT conv_id, turn, {_ERROR} AS error_code,
  ({_hash32("conv_id || ':' || turn", "score")} % 10001) / 10000.0::DOUBLE AS p FROM requests),
answered AS (SELECT conv_id, turn, error_code, {_record("p", 0.5)} FROM checked)
SELECT conv_id, turn, error_code,
  CASE WHEN error_code IS NULL THEN label END AS label,
  CASE WHEN error_code IS NULL THEN label_id END AS label_id,
  CASE WHEN error_code IS NULL THEN confidence END AS confidence,
  CASE WHEN error_code IS NULL THEN toxic_prob END AS toxic_prob
FROM answered""",
    "model_score_facts": f"""SELECT doc_id, {_EMPTY} AS error_code, 0.5::DOUBLE AS threshold,
  CASE WHEN {_EMPTY} IS NULL THEN TRUE END AS in_range,
  CASE WHEN {_EMPTY} IS NULL THEN TRUE END AS label_follows,
  CASE WHEN {_EMPTY} IS NULL THEN TRUE END AS confidence_follows,
  CASE WHEN {_EMPTY} IS NULL THEN TRUE END AS name_follows, TRUE AS softmax_fits FROM documents""",
    "train_classifier_facts": """SELECT unnest([0.001::DOUBLE, 0.01::DOUBLE, 0.1::DOUBLE]) AS reg_param,
  1::BIGINT AS n_selected, TRUE AS f1_in_range, TRUE AS first_best_taken""",
    "evaluate_facts": f"""{_TEST_SPLIT}
classes AS (SELECT count(*) FILTER (WHERE labels = 1) AS n_pos,
  count(*) FILTER (WHERE labels = 0) AS n_neg FROM held_out)
SELECT g / 10.0::DOUBLE AS threshold, n_pos, n_neg, TRUE AS recall_falls
FROM classes, range(1, 10) AS grid(g)""",
    "reload_scores": "SELECT doc_id, TRUE AS same_score FROM documents",
    "eval_metrics_at_0_3": f"""WITH {_LABELLED}
SELECT count(*) FILTER (WHERE labels = 1 AND toxic_prob >= 0.3) AS tp,
  count(*) FILTER (WHERE labels = 0 AND toxic_prob >= 0.3) AS fp,
  count(*) FILTER (WHERE labels = 0 AND toxic_prob < 0.3) AS tn,
  count(*) FILTER (WHERE labels = 1 AND toxic_prob < 0.3) AS fn, 0.3::DOUBLE AS threshold_used
FROM scored""",
    "corpus_csv_round_trip": f"""WITH {_LABELLED}
SELECT doc_id, text, labels AS toxicity FROM labelled""",
    "corpus_json_round_trip": f"""WITH {_LABELLED}
SELECT doc_id, text, labels AS toxicity FROM labelled""",
    "supplied_splits": f"""WITH {_LABELLED}
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'test' END AS split
FROM labelled""",
    "sink_eval_metrics": f"""WITH {_CORE}, matrix AS ({_CONFUSION})
SELECT accuracy, precision, recall, f1, roc_auc, 0.5::DOUBLE AS threshold_used, tp, fp, tn, fn
FROM core JOIN matrix ON TRUE""",
    "sink_threshold_csv": f"WITH {_LABELLED}, {_sweep('scored')} SELECT {_METRICS} FROM sweep",
    "sink_threshold_summary": f"WITH {_LABELLED}, {_sweep('scored')}, {_POINTS}",
    "sink_misclassified_csv": f"WITH {_LABELLED}, {_MISTAKES} SELECT * FROM mistakes",
    "sink_error_slices": f"WITH {_LABELLED}, {_SLICES}",
    "sink_probe_results": f"WITH {_PROBES} SELECT * FROM probes",
    "sink_probe_summary": f"WITH {_PROBE_SUMMARY} SELECT * FROM summary",
}
