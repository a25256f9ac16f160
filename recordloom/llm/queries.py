"""One query per corpus operator over the whole ``documents`` table, with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordloom.llm import (
    exact_dedup,
    fuzzy_lines,
    language_id,
    license_scan,
    near_dup,
    packing,
    prefix_trie,
    quality_rules,
    secret_scan,
    sentencepiece_codec,
    sharding,
    substring_dedup,
    vector_codes,
)
from recordloom.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.fit(docs.filter(~language_id.held_out()), "lang", "doc_id", "text")
    ids = language_id.predict(docs, model)
    return ids.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query("op2_line_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.line_decisions(documents(spark, sf_dir))


@query("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(documents(spark, sf_dir), with_text=False)


OP8_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), g AS (
  SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY body
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256
FROM n JOIN g USING (body)
"""


@query("op7_license_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licences(documents(spark, sf_dir))


@query("op8_exact_dedup", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Content of a public tokenizer file; it travels with the tasks, executors need no copy of it."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_file())


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(words) >= 5
    THEN list_distinct([array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)])
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id, doc_id AS reached FROM documents
  UNION SELECT e.b, r.reached FROM r JOIN e ON e.a = r.doc_id WHERE r.reached < e.b
)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(reached) AS component_id, r.doc_id = min(reached) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""


@query("op5_minhash_near_dup", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir))


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(documents(spark, sf_dir), with_text=False)


OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM w
), r AS (
  SELECT doc_id, start, row_number() OVER (PARTITION BY words[start:start + 19] ORDER BY doc_id, start) AS nth FROM s
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS place FROM r WHERE nth > 1
), gaps AS (
  SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN places IS NULL THEN words
    ELSE [words[i] FOR i IN range(1, len(words) + 1) IF NOT list_contains(places, i)] END, ' ')) AS kept_sha256
FROM w LEFT JOIN gaps USING (doc_id)
"""


@query("op6_substring_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir), with_text=False)


def sentencepiece_file(name: str = "piece_bpe_32k.model") -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(documents(spark, sf_dir), sentencepiece_file(), with_ids=False)


OP13_SQL = r"""
WITH RECURSIVE t AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) AS c FROM range(256) r(i)
  )
), d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body FROM documents
), b AS (
  SELECT row, doc_id, strlen(body) + 1 AS size, list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes
  FROM d
), c AS MATERIALIZED (
  SELECT row, doc_id, size::BIGINT AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda h, x: xor(h >> 8, t.crc[(xor(h, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT::UHUGEINT AS state
  FROM b, t
), j AS (
  SELECT row, state, 0::BIGINT AS last, 0::BIGINT AS nxt FROM c
  UNION ALL
  SELECT row, moved, nxt, floor((nxt + 1) * (2147483648.0::DOUBLE / ((moved // 8589934592)::DOUBLE + 1)))::BIGINT
  FROM (SELECT row, nxt, (state * 2862933555777941757::UHUGEINT + 1) % 18446744073709551616::UHUGEINT AS moved FROM j WHERE nxt < 9)
), s AS (
  SELECT row, max(last) FILTER (last < 8)::INT AS shard, max(last)::INT AS grown_shard FROM j GROUP BY row
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM c JOIN s USING (row)
"""


@query("op13_jump_sharding", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def _lloyd_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """Lloyd rounds one after another over (row, part, place, x) and (part, entry, place, x)."""
    assign = """a{k} AS MATERIALIZED (
  SELECT row, part, min(d * 16 + entry) % 16 AS entry, min(d * 16 + entry) // 16 AS d FROM (
    SELECT row, part, entry, sum((p.x - c.x) * (p.x - c.x)) AS d FROM p JOIN c{k} c USING (part, place) GROUP BY ALL
  ) GROUP BY row, part
)"""
    update = """c{next} AS MATERIALIZED (
  SELECT part, entry, place, coalesce((s - ((s % n) + n) % n) // n, x) AS x FROM c{k} LEFT JOIN (
    SELECT part, entry, place, sum(x) AS s, count(*) AS n FROM p JOIN a{k} USING (row, part) GROUP BY ALL
  ) USING (part, entry, place)
)"""
    steps = [assign.format(k=k) + ",\n" + update.format(k=k, next=k + 1) for k in range(rounds)]
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT row, (i - 1) * 8 // len(v) AS part, (i - 1) % (len(v) // 8) AS place, v[i] AS x
  FROM (SELECT row, v, unnest(range(1, len(v) + 1)) AS i FROM k)
), c0 AS MATERIALIZED (
  SELECT part, row - 1 AS entry, place, x FROM p WHERE row <= 16
), {", ".join(steps)}, {assign.format(k=rounds)}, e AS (
  SELECT row, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY row
), t AS (
  SELECT label, sum(error)::BIGINT AS label_error FROM e JOIN k USING (row) GROUP BY label
)
SELECT vec_id, code, error, label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) FROM c{rounds}) AS codebooks_sha256
FROM e JOIN k USING (row) JOIN t ON t.label IS NOT DISTINCT FROM k.label
"""


@query("op12_vector_codes", _lloyd_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP11_SQL = r"""
WITH t AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) AS c FROM range(256) r(i)
  )
), o AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) AS n, digest, words FROM (
    SELECT conv_id, turn, coalesce(role, '') AS role, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL
  )
), h AS MATERIALIZED (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda h, x: xor(h >> 8, t.crc[(xor(h, x) & 255) + 1])), 4294967295)::BIGINT % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM o), t
), r AS (
  SELECT h.conv_id, false AS own, n, digest, words FROM h JOIN o ON o.conv_id = base AND n <= h
  UNION ALL SELECT conv_id, true, n, digest, words FROM h JOIN o USING (conv_id) WHERE n > h
), p AS MATERIALIZED (
  SELECT conv_id, coalesce(path, []) AS path, coalesce(words, []) AS words FROM h LEFT JOIN (
    SELECT conv_id, list(digest ORDER BY own, n) AS path, list(words ORDER BY own, n) AS words FROM r GROUP BY conv_id
  ) USING (conv_id)
), m AS (
  SELECT conv_id, path, words, unnest(range(len(path) + 1)) AS depth FROM p
), n AS MATERIALIZED (
  SELECT array_to_string(path[1:depth], '') AS key, depth, any_value(path[1:depth]) AS path, any_value(coalesce(words[depth], 0)) AS words, min(conv_id) AS conv_id,
    count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256
  FROM m GROUP BY array_to_string(path[1:depth], ''), depth
), c AS MATERIALIZED (
  SELECT array_to_string(path[1:depth - 1], '') AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1
), s AS (
  SELECT array_to_string(path[1:up], '') AS key, sum((n_convs - 1) * words)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT path, n_convs, words, coalesce(n_children, 0) AS n_children, unnest(range(depth + 1)) AS up FROM n LEFT JOIN c USING (key))
  GROUP BY 1
)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n JOIN s USING (key) LEFT JOIN c USING (key) LEFT JOIN n u ON n.depth > 0 AND u.key = array_to_string(n.path[1:n.depth - 1], '')
"""


@query("op11_prefix_trie", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
