"""The registered queries of the numbered operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import alignment, chat, fingerprints, html, jaccard, mixing, packing, pieces, quality, quantize, repeats, sharding, toxicity
from llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.quality(docs, table(spark, sf_dir, "labels").where("quality = 1"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    made = chat.read_back(chat.format_chats(turns))
    joined = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescape(s["text"], chat.INST)), "")
    return made.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"), F.sha2(trained, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n_bytes", repeats.removed(F.col("spans")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sharding.stratified_shards(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return plan.select(
        "doc_id", "size", "source_size", F.round("target", 4).alias("target"), (F.col("size") * F.col("copies")).alias("taken"),
        F.round(F.try_element_at("positions", F.lit(1)), 6).alias("position"),
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantize.coded(table(spark, sf_dir, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_quality_rules": op2_quality_rules,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_html_extraction": op4_html_extraction,
    "op5_toxicity": op5_toxicity,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_packing": op8_packing,
    "op9_sharding": op9_sharding,
    "op10_mixing": op10_mixing,
    "op11_alignment": op11_alignment,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_vector_codes": op13_vector_codes,
}


def _vector_codes_sql(rounds: int) -> str:
    """Codebooks c0, c1, ... and assignments a0, a1, ... of each round; vec_id is a key of the table."""
    away = "list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.c[i]) * (p.x[i] - c.c[i])))"
    steps = [r"""
        WITH k AS (
            SELECT vec_id, label, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0
        ), p AS (
            SELECT vec_id, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS x FROM k, (SELECT unnest(range(16)) AS part) g
        ), c0 AS (
            SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 64)
        )"""]
    for r in range(rounds + 1):
        steps.append(f"""
        a{r} AS (
            SELECT vec_id, part, any_value(x) AS x, min(64 * far + entry) % 64 AS entry, min(64 * far + entry) // 64 AS far
            FROM (SELECT p.vec_id, p.part, p.x, c.entry, CAST({away} AS BIGINT) AS far FROM p JOIN c{r} c ON p.part = c.part) d GROUP BY vec_id, part
        )""")
        if r < rounds:
            steps.append(f"""
        c{r + 1} AS (
            SELECT o.part, o.entry, coalesce(n.c, o.c) AS c FROM c{r} o LEFT JOIN (
                SELECT part, entry, list((s - ((s % m) + m) % m) // m ORDER BY d) AS c
                FROM (SELECT part, entry, d, CAST(sum(x[d]) AS BIGINT) AS s, count(*) AS m FROM (SELECT part, entry, x, unnest(range(1, len(x) + 1)) AS d FROM a{r}) u GROUP BY part, entry, d) t GROUP BY part, entry
            ) n ON n.part = o.part AND n.entry = o.entry
        )""")
    return ",".join(steps) + f"""
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            (SELECT sha256(string_agg(CAST(e AS VARCHAR), ',' ORDER BY part, entry, d)) FROM (SELECT part, entry, unnest(c) AS e, unnest(range(len(c))) AS d FROM c{rounds}) f) AS codebooks_sha256
        FROM (SELECT vec_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id) z JOIN k USING (vec_id)"""


ORACLE_SQL = {
    "op3_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0) x
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), links AS (
            SELECT a, b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id) p
            JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
        ), reach AS (
            SELECT doc_id AS node, doc_id AS r FROM documents UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.r = links.a
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d
        LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT node, min(r) AS component_id FROM reach GROUP BY node) c ON c.node = d.doc_id""",
    "op6_chat_formatting": r"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), sized AS (
            SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '[', ''), '<', ''))
                + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10
                  ELSE 16 + length(role) + length(role) - length(replace(replace(replace(role, '\', ''), '[', ''), '<', '')) END AS n
            FROM said
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(n) AS BIGINT) AS formatted_chars,
            coalesce(regexp_full_match(string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, ''
                ORDER BY turn NULLS FIRST, role, text), 's?(ua)+'), false) AS valid
        FROM sized GROUP BY conv_id""",
    "op10_mixing": r"""
        WITH rows AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, md5(concat_ws(':', '10', coalesce(CAST(doc_id AS VARCHAR), ''))) AS k FROM documents
        ), sources AS (
            SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM rows GROUP BY source
        ), weighed AS (
            SELECT *, CAST(CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w,
                CASE place % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE -0.5::DOUBLE END AS slope, CAST(2 * source_size AS DOUBLE) AS cap FROM sources
        ), levels AS (
            SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (ORDER BY cap / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed
        ), targets AS (
            SELECT source, source_size, slope, least(cap, max(level) OVER () * w) AS target FROM levels
        ), placed AS (
            SELECT r.doc_id, r.size, t.source_size, t.target, t.slope,
                sum(r.size) OVER (PARTITION BY r.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - r.size / 2.0::DOUBLE AS middle
            FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, round(target, 4) AS target,
            CAST(size * ((middle < target)::INT + (source_size + middle < target)::INT) AS BIGINT) AS taken,
            CASE WHEN middle < target THEN round(2 * (middle / target) / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * (middle / target))), 6) END AS position
        FROM placed""",
    "op13_vector_codes": _vector_codes_sql(rounds=2),
}
