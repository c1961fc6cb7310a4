"""The registered queries of this subpackage: each applies its operator to a whole table and returns the full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasheaf.llm import alignment, chat, decontam, kneser_ney, lines, packing, pii, repetition, secrets, simhash, tokens, toxicity, trie
from terrasheaf.runtime import ship


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.lm_scores(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_rules(table(spark, sf_dir, "documents"))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), with_ids=False)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_shared_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignment.align_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return rows.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")


QUERIES = [
    *(op1_personal_data, op2_lm_scores, op3_quality_rules, op4_pack, op5_decontaminate, op6_toxicity, op7_simhash_groups, op8_chat_format),
    *(op9_token_counts, op10_secrets, op11_prefix_trie, op12_shared_lines, op13_align_tokenizers),
]

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: SQL for what DuckDB can express; suffix arrays, tokenizers, trained models, fingerprints, transducers and look-arounds are not among it.
ORACLES: dict[str, str] = {
    "op5_decontaminate": f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
    FROM items, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS u(i) WHERE len(w) > 0),
placed AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
    FROM docs, (SELECT DISTINCT n FROM windows), unnest(generate_series(1, len(w) - n + 1)) AS u(i) WHERE len(w) >= n),
hits AS (SELECT p.doc_id, p.i, p.n, x.item_id FROM placed p JOIN windows x ON p.n = x.n AND p.t = x.t),
counts AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM hits), unnest(generate_series(0, n - 1)) AS u(k) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN counts c ON d.doc_id = c.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id""",
    # CRC-32 a bit at a time, for want of a function; a leaf counts for its smallest member, a node's saving for its own
    "op11_prefix_trie": """
WITH own AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - (conv_id % 100 + 100) % 100 AS base, count(*) AS n_own, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
    flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 6 AS h FROM own GROUP BY conv_id),
lent AS (SELECT c.conv_id, c.h, least(c.h, coalesce(b.n_own, 0)) AS k FROM convs c LEFT JOIN convs b ON c.base = b.conv_id),
turns AS (SELECT l.conv_id, o.pos AS d, role, text FROM lent l JOIN own o ON o.conv_id = l.conv_id - (l.conv_id % 100 + 100) % 100 AND o.pos <= l.k
    UNION ALL SELECT l.conv_id, o.pos - l.h + l.k, role, text FROM lent l JOIN own o ON o.conv_id = l.conv_id AND o.pos > l.h),
chains AS (SELECT conv_id, d, length(text) AS chars, max(d) OVER (PARTITION BY conv_id) AS l,
    md5(string_agg(md5(concat(length(role), ':', role, text)), '') OVER (PARTITION BY conv_id ORDER BY d)) AS node,
    md5(coalesce(string_agg(md5(concat(length(role), ':', role, text)), '') OVER (PARTITION BY conv_id ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')) AS up FROM turns),
nodes AS (SELECT d, node, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = l) AS ends FROM chains GROUP BY d, node),
kids AS (SELECT up, d - 1 AS d, count(*) AS n FROM nodes GROUP BY 1, 2),
known AS (SELECT a.*, coalesce(k.n, 0) AS n_children, CASE WHEN a.d > 1 THEN p.conv_id END AS parent FROM nodes a LEFT JOIN kids k ON a.node = k.up AND a.d = k.d LEFT JOIN nodes p ON a.up = p.node AND a.d - 1 = p.d),
worth AS (SELECT c.conv_id, c.d, c.node, CAST(a.conv_id = c.conv_id AND a.n_children = 0 AS BIGINT) AS leaf, CASE WHEN a.conv_id = c.conv_id THEN (a.n_convs - 1) * a.chars ELSE 0 END AS saved FROM chains c JOIN known a ON c.d = a.d AND c.node = a.node),
below AS (SELECT d, node, sum(leaf) OVER w AS leaves, sum(saved) OVER w AS saved FROM worth WINDOW w AS (PARTITION BY conv_id ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
sums AS (SELECT d, node, CAST(sum(leaves) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM below GROUP BY 1, 2),
root AS (SELECT min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE conv_id NOT IN (SELECT conv_id FROM turns)) AS ends FROM convs)
SELECT conv_id, CAST(0 AS BIGINT) AS depth, CAST(NULL AS BIGINT) AS parent_conv_id, n_convs, (SELECT count(*) FROM nodes WHERE d = 1) AS n_children,
    greatest((SELECT CAST(sum(n_leaves) AS BIGINT) FROM sums WHERE d = 1), 1) AS n_leaves, coalesce((SELECT CAST(sum(saved_tokens) AS BIGINT) FROM sums WHERE d = 1), 0) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256 FROM root
UNION ALL SELECT a.conv_id, a.d, coalesce(a.parent, (SELECT conv_id FROM root)), n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ends, '')) FROM known a JOIN sums s ON a.d = s.d AND a.node = s.node""",
    "op12_shared_lines": """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
each AS (SELECT r, i, parts[i] AS line, translate(trim(parts[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM docs, unnest(generate_series(1, len(parts))) AS u(i)),
shared AS (SELECT key FROM each WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM each WHERE key NOT IN (SELECT key FROM shared) GROUP BY r)
SELECT d.doc_id, CAST(len(parts) AS BIGINT) AS n_lines, len(parts) - coalesce(k.n, 0) AS n_dropped, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.r = k.r""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
