"""The SQL that DuckDB runs for each query with a value check."""

from __future__ import annotations

_LINES = """
lines AS (
  SELECT doc_id, unnest(range(0, len(parts))) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))"""

_GROUPS = f"""{_LINES},
line_group AS (
  SELECT doc_id, line_no // 10 AS group_id, string_agg(line, chr(10) ORDER BY line_no) AS text
  FROM lines GROUP BY doc_id, line_no // 10)"""

_WORDS = f"""{_GROUPS},
words AS (
  SELECT doc_id, group_id, list_filter(string_split(text, ' '), lambda x: x <> '') AS tokens FROM line_group)"""


def _window_rows(size: int = 20, stride: int = 3) -> str:
    reach = max(size + 1, stride)
    return f"""{_WORDS},
counted AS (
  SELECT doc_id, group_id, tokens, len(tokens) AS n,
    CASE WHEN len(tokens) = 0 THEN 0
         ELSE 1 + greatest(0, CAST(ceil((len(tokens) - {reach}) / {stride}.0) AS BIGINT)) END AS n_windows
  FROM words),
numbered AS (SELECT doc_id, group_id, tokens, n, unnest(range(0, n_windows)) AS window_no FROM counted),
wins AS (
  SELECT doc_id, group_id, window_no,
    tokens[window_no * {stride} + 1 : least(window_no * {stride} + {size}, n - 1)] AS input,
    tokens[least(window_no * {stride} + {size} + 1, n)] AS target
  FROM numbered)"""


_VOCAB = """
ranked AS (
  SELECT token, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, token) - 1 AS token_index
  FROM (SELECT unnest(tokens) AS token FROM words) GROUP BY token),
vocab AS (
  SELECT token, token_index, embedding AS vector FROM ranked JOIN embeddings ON vec_id = token_index)"""

_MICRO = "CAST(floor(CAST({x} AS DOUBLE) * 1000000 + 0.5) AS BIGINT)"


def _digest(vector: str) -> str:
    x = _MICRO.format(x="x")
    return f"""CAST(len({vector}) AS INTEGER) AS n_features,
  CAST(list_sum(list_transform({vector}, lambda x: {x})) AS BIGINT) AS micro_sum,
  CAST(list_sum(list_transform({vector}, lambda x, i: {x} * i)) AS BIGINT) AS micro_weighted"""


#: Padded input positions (0-based) with the vector of their token, where there is one.
_INPUT_ROWS = """
placed AS (
  SELECT doc_id, group_id, window_no, unnest(range(0, len(input))) AS p, unnest(input) AS token FROM wins)"""


def _token_digests(dim: int = 64) -> str:
    """Per word: the sum of its micro values and their sum weighted by place."""
    x = _MICRO.format(x="x")
    return f"""
digests AS (
  SELECT token, token_index,
    CAST(list_sum(list_transform(vector, lambda x: {x})) AS BIGINT) AS s,
    CAST(list_sum(list_transform(vector, lambda x, i: {x} * i)) AS BIGINT) AS w
  FROM vocab)"""


def _position_cells(size: int, dim: int, mode: str) -> str:
    """The positional vector as rows (p, d, pos): place d of window position p."""
    j = f"(p * {dim} + d)"
    if mode == "standard":
        angle = f"p / pow(10000.0, (d - d % 2) / {dim}.0)"
        value = f"CASE WHEN d % 2 = 0 THEN sin({angle}) ELSE cos({angle}) END"
    else:
        q = f"least({size - 1}, {j})"
        e = f"({j} - {q})"
        angle = f"{q} / pow(10000.0, 2 * ({e} - {e} % 2) / {dim}.0)"
        value = f"CASE WHEN {e} >= {dim} THEN 0.0 WHEN {e} % 2 = 0 THEN sin({angle}) ELSE cos({angle}) END"
    return f"""
positions AS (
  SELECT p, d, CAST({value} AS FLOAT) AS pos
  FROM (SELECT unnest(range(0, {size})) AS p), (SELECT unnest(range(0, {dim})) AS d))"""


def _positional(size: int, stride: int, mode: str, extra: str = "", dim: int = 64) -> str:
    """Feature digests: sums per (word, position) first, as equal pairs give equal sums."""
    micro = _MICRO.format(x="v + pos")
    return f"""WITH {_window_rows(size, stride)},{_VOCAB},{_position_cells(size, dim, mode)},
cells AS (
  SELECT token_index, unnest(range(0, {dim})) AS d, unnest(vector) AS v FROM vocab
  UNION ALL SELECT -1, unnest(range(0, {dim})), CAST(0 AS FLOAT)),
digests AS (
  SELECT token_index, p, sum({micro}) AS s, sum({micro} * (p * {dim} + d + 1)) AS w
  FROM cells JOIN positions USING (d) GROUP BY token_index, p),
placed AS (
  SELECT doc_id, group_id, window_no, target, unnest(range(0, {size})) AS p,
    unnest(list_resize(input, {size}, NULL)) AS token
  FROM wins),
found AS (
  SELECT doc_id, group_id, window_no, target, p, coalesce(token_index, -1) AS token_index
  FROM placed LEFT JOIN vocab USING (token)),
summed AS (
  SELECT doc_id, group_id, window_no, target, CAST(sum(s) AS BIGINT) AS micro_sum, CAST(sum(w) AS BIGINT) AS micro_weighted
  FROM found JOIN digests USING (token_index, p) GROUP BY ALL)
SELECT doc_id, group_id, window_no, {extra}CAST({size * dim} AS INTEGER) AS n_features, micro_sum, micro_weighted
FROM summed LEFT JOIN vocab ON token = target"""


_TRAIN = """('0x' || substr(md5(concat_ws('-', doc_id, group_id, window_no)), 1, 8))::UBIGINT % 100 < 80"""

#: Labelled windows of the training set; a worker sees 100 samples in a round, and workers keep an epoch within 256 rounds.
_PLACED = f"""WITH {_window_rows()},{_VOCAB},
labelled AS (
  SELECT {_TRAIN} AS fitted, md5(concat_ws('-', 345, doc_id, group_id, window_no)) AS place, token_index AS label
  FROM wins JOIN vocab ON token = target),
sizes AS (
  SELECT *, (n_samples + 100 * n_workers - 1) // (100 * n_workers) AS n_rounds
  FROM (
    SELECT *, greatest(32, (n_samples + 25599) // 25600) AS n_workers
    FROM (
      SELECT CAST(count(*) FILTER (fitted) AS BIGINT) AS n_samples, CAST(count(*) FILTER (NOT fitted) AS BIGINT) AS n_test
      FROM labelled))),
epochs AS (SELECT CAST(unnest(range(0, 20)) AS INTEGER) AS epoch)"""

_QUERY_WORDS = """
query_text AS (
  SELECT 'item-' || item_id AS query_id, text FROM benchmark
  UNION ALL SELECT 'turn-' || conv_id || '-' || turn, text FROM conversations),
query_words AS (
  SELECT query_id, list_filter(string_split(text, ' '), lambda x: x <> '')[1:20] AS tokens FROM query_text)"""

#: Score of each word for each class, which are all words of the vocabulary.
_PAIRS = """
pairs AS (
  SELECT v.token, c.token_index AS class,
    list_dot_product(CAST(v.vector AS DOUBLE[]), CAST(c.vector AS DOUBLE[])) AS dot
  FROM vocab v, vocab c)"""

_QUERY_SCORES = f"""WITH {_WORDS},{_VOCAB},{_QUERY_WORDS},{_PAIRS},
sums AS (
  SELECT query_id, class, sum(dot) AS s
  FROM (SELECT query_id, unnest(tokens) AS token FROM query_words) JOIN pairs USING (token) GROUP BY query_id, class),
scores AS (
  SELECT query_id, class, round(coalesce(s, 0.0), 6) AS score
  FROM (SELECT query_id, class FROM query_words, (SELECT token_index AS class FROM vocab)) LEFT JOIN sums USING (query_id, class)),
best AS (
  SELECT query_id, class AS prediction FROM scores
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, class) = 1)"""

_EVALUATED = f"""WITH {_window_rows()},{_VOCAB},{_PAIRS},
test AS (
  SELECT doc_id, group_id, window_no, input, token_index AS label
  FROM wins JOIN vocab ON token = target WHERE NOT ({_TRAIN})),
sums AS (
  SELECT doc_id, group_id, window_no, class, sum(dot) AS s
  FROM (SELECT doc_id, group_id, window_no, unnest(input) AS token FROM test) JOIN pairs USING (token)
  GROUP BY ALL),
scores AS (
  SELECT t.doc_id, t.group_id, t.window_no, label, t.class, round(coalesce(s, 0.0), 6) AS score
  FROM (SELECT doc_id, group_id, window_no, label, vocab.token_index AS class FROM test, vocab) t
  LEFT JOIN sums USING (doc_id, group_id, window_no, class)),
evaluated AS (
  SELECT label, class AS prediction FROM scores
  QUALIFY row_number() OVER (PARTITION BY doc_id, group_id, window_no ORDER BY score DESC, class) = 1)"""


#: The network given by a formula: vectors with positions, a hidden layer of 4, softmax over all words.
_PREDICTED = f"""WITH {_WORDS},{_VOCAB},{_position_cells(20, 64, "standard")},{_QUERY_WORDS},
cells AS (
  SELECT token_index, unnest(range(0, 64)) AS d, unnest(vector) AS v FROM vocab
  UNION ALL SELECT -1, unnest(range(0, 64)), CAST(0 AS FLOAT)),
units AS (SELECT unnest(range(0, 4)) AS h),
parts AS (
  SELECT token_index, p, h, sum(CAST(v + pos AS DOUBLE) * (((p * 64 + d) * 7 + h * 13) % 11 - 5) / 100.0) AS s
  FROM cells JOIN positions USING (d), units GROUP BY token_index, p, h),
placed AS (
  SELECT query_id, unnest(range(0, 20)) AS p, unnest(list_resize(tokens, 20, NULL)) AS token FROM query_words),
hidden AS (
  SELECT query_id, h, greatest(sum(s) + h / 10.0, 0.0) AS a
  FROM (SELECT query_id, p, coalesce(token_index, -1) AS token_index FROM placed LEFT JOIN vocab USING (token))
  JOIN parts USING (token_index, p) GROUP BY query_id, h),
logits AS (
  SELECT query_id, token_index AS class, sum(a * sin((h + 1.0) * (token_index + 1.0))) AS z
  FROM hidden, vocab GROUP BY query_id, token_index),
shifted AS (SELECT query_id, class, exp(z - max(z) OVER (PARTITION BY query_id)) AS e FROM logits),
chosen AS (
  SELECT query_id, class AS prediction FROM (
    SELECT query_id, class, e / sum(e) OVER (PARTITION BY query_id) AS share FROM shifted)
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY share DESC, class) = 1)"""


#: The same network on the test windows with a label: shares of all classes, and what the loss makes of them.
_GRADIENT = f"""WITH {_window_rows()},{_VOCAB},{_position_cells(20, 64, "standard")},
test AS (
  SELECT row_number() OVER () AS id, input, token_index AS label FROM wins JOIN vocab ON token = target WHERE NOT ({_TRAIN})),
cells AS (
  SELECT token_index, unnest(range(0, 64)) AS d, unnest(vector) AS v FROM vocab
  UNION ALL SELECT -1, unnest(range(0, 64)), CAST(0 AS FLOAT)),
units AS (SELECT unnest(range(0, 4)) AS h),
parts AS (
  SELECT token_index, p, h, sum(CAST(v + pos AS DOUBLE) * (((p * 64 + d) * 7 + h * 13) % 11 - 5) / 100.0) AS s
  FROM cells JOIN positions USING (d), units GROUP BY token_index, p, h),
placed AS (SELECT id, unnest(range(0, 20)) AS p, unnest(list_resize(input, 20, NULL)) AS token FROM test),
hidden AS (
  SELECT id, h, greatest(sum(s) + h / 10.0, 0.0) AS a
  FROM (SELECT id, p, coalesce(token_index, -1) AS token_index FROM placed LEFT JOIN vocab USING (token))
  JOIN parts USING (token_index, p) GROUP BY id, h),
logits AS (
  SELECT id, token_index AS class, sum(a * sin((h + 1.0) * (token_index + 1.0))) AS z FROM hidden, vocab GROUP BY id, token_index),
tops AS (SELECT id, max(z) AS top FROM logits GROUP BY id),
sums AS (SELECT id, top, sum(exp(z - top)) AS total FROM logits JOIN tops USING (id) GROUP BY id, top),
errors AS (
  SELECT id, class, exp(z - top) / total AS share, exp(z - top) / total - CASE WHEN class = label THEN 1 ELSE 0 END AS error, label
  FROM logits JOIN sums USING (id) JOIN test USING (id)),
size AS (SELECT count(*) AS n FROM test),
classes AS (SELECT count(*) AS v FROM vocab),
back AS (
  SELECT id, h, sum(error * sin((h + 1.0) * (class + 1.0))) AS e FROM errors, units GROUP BY id, h)"""


def _class_counts(pairs: str) -> str:
    return f"""
classes AS (SELECT label AS class FROM {pairs} UNION SELECT prediction FROM {pairs})
SELECT class,
  CAST(count(*) FILTER (label = class AND prediction = class) AS BIGINT) AS tp,
  CAST(count(*) FILTER (label <> class AND prediction = class) AS BIGINT) AS fp,
  CAST(count(*) FILTER (label = class AND prediction <> class) AS BIGINT) AS fn,
  CAST(count(*) FILTER (label <> class AND prediction <> class) AS BIGINT) AS tn
FROM classes, {pairs} GROUP BY class"""


_FILE_LINES = f"""WITH {_LINES},
file_lines AS (SELECT row_number() OVER (ORDER BY doc_id, line_no) - 1 AS line_no, line FROM lines)"""

ORACLE = {
    "corpus_lines": f"WITH {_LINES} SELECT doc_id, line_no, line FROM lines",
    "text_file_lines": f"{_FILE_LINES} SELECT line_no, line FROM file_lines",
    "text_file_groups": f"""{_FILE_LINES}
SELECT line_no // 10 AS group_id, string_agg(line, chr(10) ORDER BY line_no) AS text
FROM file_lines GROUP BY line_no // 10""",
    "line_groups": f"WITH {_GROUPS} SELECT doc_id, group_id, text FROM line_group",
    "word_tokens": f"""WITH {_WORDS}
SELECT doc_id, group_id, CAST(unnest(range(0, len(tokens))) AS INTEGER) AS pos, unnest(tokens) AS token FROM words""",
    "token_strings": f"""WITH {_WORDS}
SELECT doc_id, group_id, array_to_string(tokens, ' ') AS token_string, CAST(len(tokens) AS INTEGER) AS n_tokens FROM words""",
    "bpe_piece_bytes": f"""WITH {_GROUPS}
SELECT doc_id, group_id, CAST(strlen(replace(text, ' ', '')) AS BIGINT) AS n_bytes FROM line_group""",
    "bpe_roundtrip": f"""WITH {_GROUPS}
SELECT doc_id, group_id, replace(text, ' ', '') AS text FROM line_group""",
    "bpe_windows_text": f"""WITH {_GROUPS}
SELECT doc_id, group_id, replace(text, ' ', '') AS text FROM line_group WHERE replace(text, ' ', '') <> ''""",
    "sliding_windows": f"""WITH {_window_rows()}
SELECT doc_id, group_id, window_no, CAST(len(input) AS INTEGER) AS n_input, array_to_string(input, ' ') AS input, target
FROM wins""",
    "padded_windows": f"""WITH {_window_rows()}
SELECT doc_id, group_id, window_no, CAST(20 AS INTEGER) AS n_input,
  array_to_string(list_resize(input, 20, '<pad>'), ' ') AS input, target
FROM wins""",
    "window_counts": f"""WITH {_window_rows()}
SELECT doc_id, group_id, CAST(len(tokens) AS BIGINT) AS n_tokens, coalesce(n_windows, 0) AS n_windows
FROM words LEFT JOIN (SELECT doc_id, group_id, count(*) AS n_windows FROM wins GROUP BY ALL) USING (doc_id, group_id)""",
    "window_total": f"WITH {_window_rows()} SELECT count(*) AS n_windows FROM wins",
    "vocab_index": f"WITH {_WORDS},{_VOCAB} SELECT token, n, token_index FROM ranked",
    "vocab_dedup": f"""
SELECT label, vec_id, {_digest("embedding")} FROM embeddings
QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id DESC) = 1""",
    "embeddings_csv_roundtrip": f"""WITH {_WORDS},{_VOCAB}
SELECT token, token_index, {_digest("vector")} FROM vocab""",
    "embedding_lookup": f"""WITH {_WORDS},{_VOCAB},{_token_digests()}
SELECT doc_id, group_id, CAST(pos AS INTEGER) AS pos, coalesce(token_index, -1) AS token_index,
  CAST(64 AS INTEGER) AS n_features, coalesce(s, 0) AS micro_sum, coalesce(w, 0) AS micro_weighted
FROM (SELECT doc_id, group_id, unnest(range(0, len(tokens))) AS pos, unnest(tokens) AS token FROM words)
LEFT JOIN digests USING (token)""",
    "target_index": f"""WITH {_window_rows()},{_VOCAB},{_INPUT_ROWS},
found AS (
  SELECT doc_id, group_id, window_no, list(coalesce(token_index, -1) ORDER BY p) AS idx
  FROM placed LEFT JOIN vocab USING (token) GROUP BY ALL)
SELECT doc_id, group_id, window_no,
  array_to_string(list_resize(coalesce(idx, []), 20, -1), ' ') AS input_index, coalesce(token_index, -1) AS target_index
FROM wins LEFT JOIN found USING (doc_id, group_id, window_no) LEFT JOIN vocab ON token = target""",
    "embedded_features": f"""WITH {_window_rows()},{_VOCAB},{_token_digests()},{_INPUT_ROWS},
sums AS (
  SELECT doc_id, group_id, window_no, sum(s) AS s, sum(w + 64 * p * s) AS w
  FROM placed JOIN digests USING (token) GROUP BY ALL)
SELECT doc_id, group_id, window_no, CAST(1280 AS INTEGER) AS n_features,
  CAST(coalesce(s, 0) AS BIGINT) AS micro_sum, CAST(coalesce(w, 0) AS BIGINT) AS micro_weighted
FROM wins LEFT JOIN sums USING (doc_id, group_id, window_no)""",
    "positional_reference": _positional(20, 3, "reference"),
    "positional_standard": _positional(20, 3, "standard"),
    "positional_features": _positional(20, 3, "standard"),
    "one_hot_labels": f"""WITH {_window_rows()},{_VOCAB}
SELECT doc_id, group_id, window_no,
  CAST((SELECT count(*) FROM vocab) AS INTEGER) AS n_classes, CAST(token_index IS NOT NULL AS INTEGER) AS n_ones,
  CAST(coalesce(token_index + 1, 0) AS BIGINT) AS place
FROM wins LEFT JOIN vocab ON token = target""",
    "training_samples": _positional(
        20, 3, "standard",
        "coalesce(token_index, -1) AS target_index, ",
    ),
    "dataset_summary": f"""WITH {_WORDS},{_VOCAB},summary AS ({_positional(20, 3, "standard")})
SELECT doc_id, group_id, window_no, CAST((SELECT count(*) FROM vocab) AS INTEGER) AS n_classes, n_features, micro_sum, micro_weighted,
  (SELECT count(*) FROM summary) AS n_samples
FROM summary ORDER BY doc_id, group_id, window_no LIMIT 1""",
    "split_hash": f"""WITH {_window_rows()}
SELECT doc_id, group_id, window_no, CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS split FROM wins""",
    "split_random_sides": f"""WITH {_window_rows()}
SELECT doc_id, group_id, window_no, CAST(1 AS BIGINT) AS n_sides FROM wins""",
    "query_windows": f"""WITH {_QUERY_WORDS}
SELECT query_id, array_to_string(list_resize(tokens, 20, '<pad>'), ' ') AS input FROM query_words""",
    "score_linear": f"{_QUERY_SCORES} SELECT query_id, CAST(class AS INTEGER) AS class, score FROM scores",
    "argmax_scores": f"{_QUERY_SCORES} SELECT query_id, prediction FROM best",
    "decode_predictions": f"""{_QUERY_SCORES}
SELECT query_id, prediction, coalesce(token, 'NULL') AS token
FROM best LEFT JOIN vocab ON token_index = prediction""",
    "eval_accuracy": f"""{_EVALUATED}
SELECT count(*) AS n, CAST(count(*) FILTER (label = prediction) AS BIGINT) AS n_correct,
  count(*) FILTER (label = prediction) / CAST(count(*) AS DOUBLE) AS accuracy,
  (SELECT count(*) FROM wins LEFT JOIN vocab ON token = target WHERE token IS NULL AND NOT ({_TRAIN})) AS n_without_label
FROM evaluated""",
    "eval_confusion": f"{_EVALUATED} SELECT label, prediction, count(*) AS n FROM evaluated GROUP BY ALL",
    "eval_class_counts": f"{_EVALUATED},{_class_counts('evaluated')}",
    "eval_labels": f"""WITH given AS (SELECT quality AS label, toxic AS prediction FROM labels),{_class_counts('given')}""",
    "param_average": """
SELECT label AS layer, 'weight' AS kind, CAST(0 AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
  round(sum(CAST(value AS DOUBLE) * n) / sum(n), 6) AS value
FROM (SELECT label, vec_id % 7 + 1 AS n, unnest(range(0, 64)) AS j, unnest(embedding) AS value FROM embeddings)
GROUP BY label, j""",
    "train_param_avg": f"""{_PLACED}
SELECT epoch, CAST(0.01 AS DOUBLE) AS learning_rate, CAST(n_rounds AS INTEGER) AS n_rounds, n_samples, n_test,
  (SELECT count(*) FROM wins) - n_samples - n_test AS n_without_label
FROM epochs, sizes""",
    "training_metrics": f"""{_PLACED},
placed AS (
  SELECT CAST(('0x' || substr(place, 1, 8))::UBIGINT % n_rounds AS INTEGER) AS round,
    CAST(('0x' || substr(place, 9, 8))::UBIGINT % n_workers AS INTEGER) AS worker
  FROM labelled, sizes WHERE fitted),
seen AS (SELECT round, worker, count(*) AS k FROM placed GROUP BY ALL),
batches AS (SELECT round, worker, k, unnest(range(0, (k + 9) // 10)) AS iteration FROM seen)
SELECT epoch, round, worker, CAST(iteration AS INTEGER) AS iteration, least(10, k - 10 * iteration) AS n, TRUE AS is_sound
FROM batches, epochs""",
    "training_confusion": f"""{_PLACED}
SELECT epoch, label, count(*) AS n FROM labelled, epochs WHERE NOT fitted GROUP BY ALL""",
    "model_params": f"""WITH {_WORDS},{_VOCAB},
shapes AS (
  SELECT * FROM (VALUES (0, 'weight', 1280, 20), (0, 'bias', 1, 20)) s(layer, base, height, width)
  UNION ALL SELECT 1, 'weight', 20, count(*) FROM vocab
  UNION ALL SELECT 1, 'bias', 1, count(*) FROM vocab),
arrays AS (
  SELECT layer, base || moment AS kind, height, width FROM shapes, (SELECT unnest(['', '.m', '.v']) AS moment)
  UNION ALL SELECT 0, 'step', 1, 1)
SELECT CAST(layer AS INTEGER) AS layer, kind, CAST(height * width AS BIGINT) AS n,
  CAST(height - 1 AS INTEGER) AS max_i, CAST(width - 1 AS INTEGER) AS max_j FROM arrays""",
    "predict_next_token": f"""{_PREDICTED}
SELECT query_id, prediction, coalesce(token, 'NULL') AS token FROM chosen LEFT JOIN vocab ON token_index = prediction""",
    "formula_gradient": f"""{_GRADIENT}
SELECT name, CAST(cell AS BIGINT) AS cell, round(value, 8) AS value FROM (
  SELECT 'loss' AS name, 0 AS cell, avg(-ln(share)) AS value FROM errors WHERE class = label
  UNION ALL SELECT 'b1', class, sum(error) / any_value(n) FROM errors, size GROUP BY class
  UNION ALL SELECT 'w1', h * any_value(v) + class, sum(a * error) / any_value(n)
    FROM errors JOIN hidden USING (id), size, classes GROUP BY h, class
  UNION ALL SELECT 'b0', h, sum(CASE WHEN a > 0 THEN e ELSE 0 END) / any_value(n) FROM back JOIN hidden USING (id, h), size GROUP BY h)""",
}
