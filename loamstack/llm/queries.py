"""The registered queries of this subpackage: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstack.llm import align, byte_bpe, chat, exact_dedup, langid, line_rules, minhash, packing, secrets, spelling, suffix_dedup, token_store, topk


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def new_index(spark: SparkSession) -> exact_dedup.DigestIndex:
    return exact_dedup.DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = secrets.scan(docs, secrets.MarkovRatio.fit(secrets.default_samples(docs)))
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = secrets.joined(F.filter("spans", lambda s: s["kind"] < 3))
    return found.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), of(3).alias("n_random"),
                        F.sha2(base, 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = langid.LanguageModel.fit(docs.filter(langid.remainder(F.col("doc_id")) != 2))
    held_out = F.coalesce(langid.remainder(F.col("doc_id")) == 2, F.lit(False))
    return model.predict(docs).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    kinds = "conv_id long, turn long, role string, text string"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], kinds)
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    done = chat.format_conversations(rows.unionByName(more))
    turn = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    loss = F.array_join("loss_texts", "")
    back = chat.read_back(done)
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(F.transform("turns", turn), ""), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeats(_documents(spark, sf_dir))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    done = byte_bpe.encode(_documents(spark, sf_dir), path, public_tokenizers.PATTERN, decoded=True)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, index = _documents(spark, sf_dir), new_index(spark)
    # Two batches in ascending order of doc_id, so that the second meets an index; texts of both are judged by the whole.
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    upper = F.coalesce(F.col("doc_id") > ((low or 0) + (high or 0)) // 2, F.lit(True))
    rows = index.record(docs.filter(~upper), 1).unionByName(index.record(docs.filter(upper), 2))
    return index.decide(rows).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.search(vectors.filter(F.col("vec_id") % 100 == 0), vectors, 10, 1024)


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), ids=False)


def op10_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored(_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = align.align(_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups").isNull(), F.lit("")).otherwise(F.sha2("groups", 256))
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(_documents(spark, sf_dir))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(_documents(spark, sf_dir), change=spelling.dropped_letter))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_secret_scans, op2_language_id, op3_chat_formatting, op4_suffix_array_dedup, op5_byte_bpe, op6_exact_dedup, op7_exact_topk_search,
              op8_minhash_near_dedup, op9_best_fit_packing, op10_token_id_output, op11_cross_tokenizer_alignment, op12_quality_rules, op13_spelling_variants)
}

ORACLE_SQL: dict[str, str] = {
    "op3_chat_formatting": r"""
        WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        escaped AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS NOT DISTINCT FROM role AS same,
            length(regexp_replace(regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(/?s>)', '\\l\1', 'g'),
                '<(<?/?(SYS|ROLE|TURN)>>)', '\\l\1', 'g'), '\[(/?INST\])', '\\b\1', 'g')) AS n FROM rows)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(n + CASE WHEN same THEN 8 WHEN role = 'system' THEN 15 WHEN role = 'user' THEN 18 ELSE 6 END)::BIGINT AS formatted_chars
        FROM escaped GROUP BY conv_id""",
    "op6_exact_dedup": r"""
        WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ \t-\r]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op7_exact_topk_search": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op12_quality_rules": r"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, list_filter(string_split_regex(text, '[ \t-\r]+'), lambda x: x <> '') AS w FROM d),
        windows AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) >= 8),
        repeated AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 7], ' ')) AS n FROM windows),
        covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM repeated WHERE n > 1) GROUP BY doc_id),
        lines AS (SELECT doc_id, host, text, unnest(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]'))) AS line FROM d),
        normal AS (SELECT *, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '[ \t-\r]+', ' ', 'g')) AS norm FROM lines),
        hosts AS (SELECT host, count(DISTINCT text) AS n_host FROM d GROUP BY host),
        frequent AS (SELECT host, norm FROM normal JOIN hosts USING (host) GROUP BY host, norm, n_host HAVING count(DISTINCT text) > 20 AND count(DISTINCT text) > 0.001 * n_host),
        removed AS (SELECT doc_id, sum(len(list_filter(string_split_regex(line, '[ \t-\r]+'), lambda x: x <> ''))) AS n FROM normal SEMI JOIN frequent USING (host, norm) GROUP BY doc_id),
        duplicated AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
        m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n, 0)::BIGINT AS n_removed_words
            FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN duplicated USING (doc_id) LEFT JOIN removed USING (doc_id))
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
            NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_removed_words <= 0.5 * n_words AS kept FROM m""",
}
