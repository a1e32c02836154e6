"""The operators over the driver's tables, one query each, and their SQL where it can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorgrid.llm import (
    blob_ledger, bpe, chat_tree, decontamination, filter_audit, jaccard_join, langid, line_dedup, phrases, quality, sharding,
    suffix_dedup, warc,
)
from sensorgrid.llm.common import table


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary; SENSORGRID_TOKENIZERS names another folder."""
    folder = os.environ.get("SENSORGRID_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op2_rare_shingle_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok"
    )


def op4_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blob_ledger.secret_spans(table(spark, sf_dir, "documents"))


def op5_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def op7_sampled_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op8_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_group_count_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op11_prefix_tree_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, k, role, CONTROL_TEXT) for k, role in enumerate(("user", "assistant"))], told.schema)
    return chat_tree.format_conversations(told.unionByName(more), vocabulary_path())


def op12_hat_trie_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_posting_list_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: A text that holds what templates mark turns with.
CONTROL_TEXT = "\\### Assistant: </turn> ok"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fuzzy_line_dedup": op1_fuzzy_line_dedup,
    "op2_rare_shingle_decontamination": op2_rare_shingle_decontamination,
    "op3_warc": op3_warc,
    "op4_blob_ledger_secrets": op4_blob_ledger_secrets,
    "op5_adaptive_quality": op5_adaptive_quality,
    "op6_bpe": op6_bpe,
    "op7_sampled_suffix_dedup": op7_sampled_suffix_dedup,
    "op8_kd_tree_shards": op8_kd_tree_shards,
    "op9_language_mixture": op9_language_mixture,
    "op10_group_count_jaccard_join": op10_group_count_jaccard_join,
    "op11_prefix_tree_chat": op11_prefix_tree_chat,
    "op12_hat_trie_phrases": op12_hat_trie_phrases,
    "op13_posting_list_audit": op13_posting_list_audit,
}

ORACLES: dict[str, str] = {
    "op3_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p
        ), r AS (
            SELECT payload_digest, max(page_id) AS response_id
            FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN response_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN response_id <> page_id THEN response_id END AS refers_to,
               TRUE AS digest_ok
        FROM d LEFT JOIN r USING (payload_digest)
    """,
    "op11_prefix_tree_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
        ), s AS (
            SELECT *, length(role || text)
                + length(regexp_replace(role || text, '[^\\<>]', '', 'g')) + length('<turn >' || '</turn>' || chr(10)) AS size
            FROM t
        ), c AS (
            SELECT conv_id, count(*) AS n_turns, sum(size)::BIGINT AS formatted_chars,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS told,
                   coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss
            FROM s GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
        FROM c
    """,
    "op12_hat_trie_phrases": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), w AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
        ), total AS (
            SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang
        ), f AS (
            SELECT lang, words[i:i + k - 1] AS path, k, count(*) AS a
            FROM (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w), (SELECT unnest(range(1, 6)) AS k)
            WHERE i + k - 1 <= len(words)
            GROUP BY ALL HAVING count(*) >= 100
        ), inside AS (
            SELECT lang, path[1:k - 1] AS path, a FROM f WHERE k > 2 UNION SELECT lang, path[2:k], a FROM f WHERE k > 2
        ), cut AS (
            SELECT lang, path, a, k, unnest(range(1, k)) AS c
            FROM f ANTI JOIN inside USING (lang, path, a) WHERE k > 1
        ), scored AS (
            SELECT cut.lang, cut.path, cut.a, c, x.a AS l, y.a AS r, n::BIGINT AS n,
                   ((1000::HUGEINT * cut.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
            FROM cut JOIN f AS x ON x.lang = cut.lang AND x.path = cut.path[1:c]
            JOIN f AS y ON y.lang = cut.lang AND y.path = cut.path[c + 1:cut.k] JOIN total ON total.lang = cut.lang
        ), best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, path ORDER BY score, c) = 1
        ), ranked AS (
            SELECT lang, array_to_string(path, ' ') AS phrase, a, l, r, n, score,
                   row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(path, ' ')) AS rank
            FROM best
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
    """,
    "op13_posting_list_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), flags AS (
            SELECT doc_id, part,
                   (len(words) < 50)::INT + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
                   + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::INT
                   + 8 * regexp_matches(text, '[#$%&*|]')::INT
                   + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE)::INT AS fails
            FROM d
        ), l AS (
            SELECT doc_id, max(quality = 1)::INT AS good, max(toxic = 1)::INT AS toxic FROM labels GROUP BY doc_id
        ), rows AS (
            SELECT part, fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM flags LEFT JOIN l USING (doc_id)
        ), u AS (
            SELECT part, s, count(*) AS total, count(*) FILTER (fails & s <> 0) AS size,
                   coalesce(sum(good) FILTER (fails & s <> 0), 0)::BIGINT AS good, coalesce(sum(toxic) FILTER (fails & s <> 0), 0)::BIGINT AS toxic
            FROM rows, (SELECT unnest(range(0, 32))::INT AS s) GROUP BY part, s
        ), k AS (
            SELECT unnest(range(0, 5))::INT AS k
        ), o AS (
            SELECT [a.k, b.k, c.k, d.k, e.k] AS ks FROM k a, k b, k c, k d, k e
            WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5
        ), steps AS (
            SELECT array_to_string([substr('ABCDE', k + 1, 1) FOR k IN ks], '') AS filter_order, step, 1 << ks[step] AS bit,
                   coalesce(list_sum([1 << k FOR k IN ks[1:step - 1]]), 0)::INT AS before
            FROM o, (SELECT unnest(range(1, 6))::INT AS step)
        ), told AS (
            SELECT y.part, filter_order, step, bit, y.total - y.size AS kept, y.size - x.size AS removed, own.size - (y.size - x.size) AS redundant,
                   every.size - others.size AS unique_fails, y.good - x.good AS good_lost, y.toxic - x.toxic AS toxic_lost
            FROM steps JOIN u AS x ON x.s = before JOIN u AS y ON y.s = before | bit AND y.part = x.part
            JOIN u AS own ON own.s = bit AND own.part = x.part
            JOIN u AS every ON every.s = 31 AND every.part = x.part
            JOIN u AS others ON others.s = 31 - bit AND others.part = x.part
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
        FROM told
    """,
}
