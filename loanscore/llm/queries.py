"""Registered queries of the training-data operators and their SQL.

Each query applies one operator to its whole table and derives the columns
that are returned; the operators' modules say how they work.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscore.llm import (
    bin_packing,
    byte_bpe,
    chat_parts,
    host_quality,
    html_density,
    importance_resampling,
    order_minhash,
    quality_classifier,
    suffix_decontam,
    token_counts,
    url_equivalence,
    warc_transactions,
    whitening,
)
from loanscore.llm.common import table
from loanscore.session import delete_on_exit, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"

# The rules of the URL query.
URL_RULES = [
    url_equivalence.Rule("allow", "org/"),
    url_equivalence.Rule("block", "example.org/es/"),
    url_equivalence.Rule("block", "example.org/en/1"),
    url_equivalence.Rule("allow", "com/fr/"),
    url_equivalence.Rule("block", "com/de/"),
]

# Fixed value: the conversation that is added to the table.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = order_minhash.near_duplicates(docs, carry=["doc_id"])
    return found.select("doc_id", "class_id", "class_size", "n_links", "kept")


def op2_url_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = url_equivalence.judge_urls(pages.select("page_id", "url"), url_equivalence.link_edges(pages), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_suffix_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_decontam.search_documents(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    # Only the id is carried along: the text is read for its counts and not written again.
    judged = host_quality.judge_documents(docs, carry=["doc_id"])
    return judged.select("doc_id", *host_quality.COUNTS, "base_failed", "kept")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN
    coded = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern)
    decoded = byte_bpe.decode(coded.select("doc_id", "n_tokens", "ids"), path, pattern)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_density.extract(pages).select("page_id", "url", "text", "n_chars")


def op7_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    chats = chat_parts.format_chats(turns.withColumn("parts", chat_parts.typed(chat_parts.text_part(F.col("text")))))
    back = chats.select(
        "conv_id",
        chat_parts.read_turns(F.col("formatted")).alias("turns"),
        chat_parts.loss_text(F.col("segments")).alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op8_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sharded = bin_packing.shard_documents(docs, shards=16, carry=["doc_id"])
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, public_tokenizers.path(WORD_VOCABULARY))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op10_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    captures = pages.select(F.col("page_id").alias("capture_id"), "url", F.col("html").alias("payload"))
    path = delete_on_exit(spark, scratch_path(spark, "archives"))
    warc_transactions.write_archives(captures, path)
    payload, block = warc_transactions.payload_of(F.col("block")), F.col("block")
    found = warc_transactions.assemble(
        warc_transactions.read_records(spark, path),
        main=[
            F.octet_length(payload).cast("long").alias("bytes"),
            warc_transactions.sha1_base32(payload).alias("digest"),
            F.replace("payload_digest", F.lit("sha1:"), F.lit("")).alias("noted_digest"),
            F.col("refers_to").cast("long").alias("refers_to"),
        ],
        request=[F.col("target_uri")],
        metadata=[
            warc_transactions.field_of(block, "captureId").alias("capture_id"),
            warc_transactions.field_of(block, "payloadBytes").cast("long").alias("payload_bytes"),
        ],
    )
    revisit, noted = F.col("main.warc_type") == "revisit", F.element_at("metadata", 1)
    return found.select(
        F.nullif(noted["capture_id"], F.lit("")).cast("long").alias("page_id"),
        F.when(revisit, noted["payload_bytes"]).otherwise(F.col("main.bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("main.noted_digest")).otherwise(F.col("main.digest")).alias("payload_digest"),
        F.col("main.warc_type").alias("record_type"),
        F.col("main.refers_to").alias("refers_to"),
    )


def op11_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors, carry=["vec_id"])


def op12_segment_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    drawn = importance_resampling.resample(docs.select("doc_id", "text"), target.select("text"), carry=["doc_id"])
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.classify(docs, model, carry=["doc_id"])


def registry() -> dict[str, Query]:
    return {
        "op1_order_minhash": op1_order_minhash,
        "op2_url_equivalence": op2_url_equivalence,
        "op3_suffix_decontam": op3_suffix_decontam,
        "op4_host_quality": op4_host_quality,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_html_density": op6_html_density,
        "op7_chat_parts": op7_chat_parts,
        "op8_bin_packing": op8_bin_packing,
        "op9_token_counts": op9_token_counts,
        "op10_warc_transactions": op10_warc_transactions,
        "op11_qdwh_whitening": op11_qdwh_whitening,
        "op12_segment_resampling": op12_segment_resampling,
        "op13_subword_quality": op13_subword_quality,
    }


OP2_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(rule, rhost, rpath, action) AS (
  VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
         ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')
), judged AS (
  SELECT p.page_id, p.host, p.path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.action, length(r.rule)) AS action
  FROM (SELECT row_number() OVER () AS n, * FROM parts) p
  LEFT JOIN rules r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)
  GROUP BY p.n, p.page_id, p.host, p.path
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(action, 'allow') AS verdict FROM judged
"""

OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[i:i + 9], ' ') AS win
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM windows), places AS (
  SELECT n, i, size, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM (SELECT n, size, words, unnest(range(1, len(words) - size + 2)) AS i FROM d, sizes WHERE len(words) >= size)
), hits AS (SELECT p.n, p.i, p.size, w.item_id FROM places p JOIN windows w ON w.size = p.size AND w.win = p.win),
covered AS (
  SELECT n, count(DISTINCT i + k) AS c FROM (SELECT n, i, unnest(range(0, size)) AS k FROM hits) GROUP BY n
), items AS (
  SELECT n, count(*) AS c, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT n, item_id::VARCHAR AS id FROM hits) GROUP BY n
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(covered.c, 0)::BIGINT AS n_hit, coalesce(items.c, 0)::BIGINT AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(covered.c, 0) > 0 AS contaminated
FROM d LEFT JOIN covered ON covered.n = d.n LEFT JOIN items ON items.n = d.n
"""

OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
), wins AS (
  SELECT n, i, array_to_string(words[i:i + 4], ' ') AS win
  FROM (SELECT n, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)
), twice AS (
  SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY n, win) AS c FROM wins) WHERE c > 1
), hit AS (
  SELECT n, count(DISTINCT i + k) AS hits FROM twice, range(5) AS t(k) GROUP BY n
), lines AS (
  SELECT n, count(*) - count(DISTINCT line) AS dups
  FROM (SELECT n, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY n
), counts AS (
  SELECT w.n, w.doc_id, w.source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(lines.dups, 0)::BIGINT AS n_dup_lines, coalesce(hit.hits, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN hit ON hit.n = w.n LEFT JOIN lines ON lines.n = w.n
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
), hosts AS (
  SELECT source, count(*) AS c, count(*) FILTER (WHERE base_failed) AS f FROM judged GROUP BY source
), prior AS (
  SELECT avg(f / c) AS m, var_pop(f / c) AS v FROM hosts
), rates AS (
  SELECT source, CASE WHEN v > 0 AND v < m * (1 - m)
                      THEN (f + m * (m * (1 - m) / v - 1)) / (c + (m * (1 - m) / v - 1)) ELSE m END AS rate
  FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rate <= 0.5 AS kept
FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source
"""

OP7_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(16 + length(role) + length(text) + length(regexp_replace(role || text, '[^\\<>]', '', 'g')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


OP10_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, upper(sha1(coalesce(html, ''))) AS hex FROM pages
), first AS (
  SELECT html, min(page_id) AS id FROM p GROUP BY html
), digits AS (
  SELECT p.*, list_transform(range(0, 32), lambda k: ((list_reduce(list_prepend(0, list_transform(range(0, 5),
           lambda j: (strpos('0123456789ABCDEF', substr(hex, ((k // 4) * 5 + j + 1)::INT, 1)) - 1)::BIGINT)),
           lambda a, x: a * 16 + x)) // (32 ** (3 - k % 4))::BIGINT) % 32) AS q FROM p
)
SELECT d.page_id, strlen(d.html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(q, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v + 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN d.page_id = f.id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN d.page_id = f.id THEN NULL ELSE f.id END AS refers_to
FROM digits d JOIN first f ON f.html = d.html
"""

# CRC-32 is computed once for each distinct word, from a table made by its rule.
OP12_SQL = r"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(b, range(8)),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS tab FROM range(256) AS t(b)
), d AS (
  SELECT row_number() OVER () AS n, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), dw AS (SELECT n, unnest(words) AS word FROM d),
bw AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), coded AS (
  SELECT word, hex(word) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)
), bytes AS (
  SELECT word, list_transform(range(1, length(h), 2), lambda i: (strpos('0123456789ABCDEF', substr(h, i::INT, 1)) - 1) * 16
                                                               + strpos('0123456789ABCDEF', substr(h, i::INT + 1, 1)) - 1) AS bs FROM coded
), buckets AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, bs), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS b
  FROM bytes, crc
), corpus AS (SELECT b, count(*) AS s FROM dw JOIN buckets USING (word) GROUP BY b),
target AS (SELECT b, count(*) AS t FROM bw JOIN buckets USING (word) GROUP BY b),
totals AS (SELECT (SELECT count(*) FROM dw) AS ss, (SELECT count(*) FROM bw) AS tt),
gains AS (
  SELECT b, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (ss + 10000)) / ((coalesce(s, 0) + 1)::DOUBLE * (tt + 10000))))::BIGINT AS gain
  FROM corpus FULL JOIN target USING (b), totals
), weights AS (
  SELECT n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM dw JOIN buckets USING (word) JOIN gains USING (b) GROUP BY n
), scored AS (
  SELECT d.n, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                    / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weights ON weights.n = d.n
), drawn AS (
  SELECT n, row_number() OVER (ORDER BY score DESC, doc_id, n) AS place, count(*) OVER () AS among FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= among * 10 // 100 THEN place END AS rank
FROM scored LEFT JOIN drawn ON drawn.n = scored.n
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_equivalence": OP2_SQL,
        "op3_suffix_decontam": OP3_SQL,
        "op4_host_quality": OP4_SQL,
        "op7_chat_parts": OP7_SQL,
        "op10_warc_transactions": OP10_SQL,
        "op12_segment_resampling": OP12_SQL,
    }
