"""One driver query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverair.llm import (
    chat,
    decontamination,
    language_id,
    merkle,
    quality_crf,
    quality_rules,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filter,
    whitening,
)
from silverair.llm.fitting import fold
from silverair.session import configure

# Names of the tokenizer files in the installed package.
PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under the name of its function."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(configure(spark), folder)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(folds: int, left: int) -> Column:
    return (fold("doc_id", folds) == left).alias("held_out")


def scored(score: Column, threshold: float) -> list[Column]:
    return [score.alias("score"), (score >= threshold).cast("int").alias("predicted")]


@query
def op1_quality_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    field = quality_crf.fit_field(docs, labels.where(fold("doc_id", 5) != 0))
    lines = quality_crf.line_quality(docs, field)
    good = F.size(F.filter("line_good", lambda p: p >= 0.5)).alias("n_good_lines")
    return lines.select("doc_id", held_out(5, 0), *scored(F.col("score"), 0.3), good)


@query
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality_rules.fit_rules(docs, labels.where(fold("doc_id", 5) != 0))
    return quality_rules.apply_rules(docs, model)


@query
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.components(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    coded = sentencepiece_codec.encode_decode(table(spark, folder, "documents"), public_tokenizers.path(PIECES))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_id.fit_languages(docs.where(fold("doc_id", 3) != 1))
    found = language_id.identify(docs, model)
    return found.select("doc_id", held_out(3, 1), "lang_pred", "score")


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit_toxicity(docs, labels.where(fold("doc_id", 5) != 0))
    found = toxicity.toxicity(docs, model)
    return found.select("doc_id", held_out(5, 0), *scored(F.col("score"), 0.5), "n_windows", "n_toxic_windows")


def conversation_log(turns: DataFrame) -> DataFrame:
    """Turns as a log with one ``message`` event each; turns with one number go by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = turns.withColumn("seq", F.row_number().over(order).cast("long"))
    return numbered.select("conv_id", "seq", F.col("seq").alias("message_id"), F.lit("message").alias("kind"), "role", "text")


CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query
def op2_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    fixed = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.explode(
            F.array(
                F.struct(F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role")),
                F.struct(F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role")),
            )
        ).alias("at"),
    )
    fixed = fixed.select("conv_id", "at.turn", "at.role", F.lit(CONTROL_TEXT).alias("text"))
    messages = chat.reconstruct(conversation_log(turns.unionByName(fixed)))
    return chat.digests(chat.render(messages))


SQL["op2_chat"] = r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL
        SELECT -1, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS fixed(turn, role)
    ), parts AS (
        SELECT *, replace(role, '\', '\\') || replace(text, '\', '\\') AS doubled FROM turns
    ), marked AS (
        SELECT *, length('<|im_start|><|im_sep|><|im_end|>') + length(doubled) + length(regexp_extract_all(doubled,
            '</?s>|\[/?INST\]|<</?SYS>>|<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|<\|endoftext\|>')) AS chars
        FROM parts
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
        sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
        sum(chars)::BIGINT AS formatted_chars
    FROM marked GROUP BY conv_id
"""

RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)
# Pages on hosts with one of these labels make up the list of blocked URLs.
BLOCKED_LABELS = ("casino-win", "free-bets", "ads-track", "spam-farm", "cheap-pills", "adult-x")


def blocked_pages(pages: DataFrame) -> DataFrame:
    """Canonical URLs (``key``) of pages whose host has a blocked label."""
    url = F.col("url")
    split = pages.select(url_filter.host_of(url).alias("host"), url_filter.path_of(url).alias("path"))
    label = F.arrays_overlap(F.split("host", r"\."), F.array(*map(F.lit, BLOCKED_LABELS)))
    return split.where(label).select(url_filter.canonical(F.col("host"), F.col("path")).alias("key"))


@query
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return url_filter.judge(pages, blocked_pages(pages), RULES)


SQL["op8_url_filter"] = r"""
    WITH split AS (
        SELECT page_id,
            coalesce(translate(regexp_extract(url, '^(.*?)://([^/?#]*)', 2, 's'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
            coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
        FROM pages
    ), keyed AS (
        SELECT *, regexp_replace(host, '^(www|m|blog)\.', '') || regexp_replace(path, '(\.html|/)$', '') AS key FROM split
    ), ruled AS (
        SELECT *, CASE
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
        FROM keyed
    ), listed AS (
        SELECT DISTINCT key FROM keyed
        WHERE list_has_any(string_split(host, '.'),
            ['casino-win', 'free-bets', 'ads-track', 'spam-farm', 'cheap-pills', 'adult-x'])
    )
    SELECT page_id, host, path, rule, CASE
        WHEN rule IN ('example.com/de/', 'net/') THEN 'block'
        WHEN rule IS NOT NULL THEN 'allow'
        WHEN host <> '' AND key IN (SELECT key FROM listed) THEN 'block'
        ELSE 'allow' END AS verdict
    FROM ruled
"""


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup.cut_repeats(table(spark, folder, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


@query
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampers = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(tampers, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    tampered = merkle.leaf_digest([text if c == "text" else F.col(c) for c in LEAF_COLUMNS]).alias("tampered")
    manifest = merkle.build(table(spark, folder, "documents"), LEAF_COLUMNS, carry=[tampered])
    root = F.lit(manifest.root).cast("string")
    proofs = merkle.prove(spark, manifest).withColumn("folded_root", merkle.fold("tampered"))
    return proofs.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        root.alias("root"),
        merkle.proof_digest().alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


SQL["op13_merkle_manifest"] = r"""
    WITH RECURSIVE bits AS (
        SELECT i, 0 AS step, i::BIGINT AS c FROM range(256) AS t(i)
        UNION ALL
        SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE step < 8
    ), crc AS (
        SELECT list(c ORDER BY i) AS steps FROM bits WHERE step = 8
    ), fields AS (
        SELECT doc_id, source, text,
            CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1])), 4294967295) % 2 = 0
                THEN replace(text, chr(10), '') ELSE text END AS tampered_text,
            coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-')
                || coalesce(octet_length(encode(source)) || ':' || source, '-')
                || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
                || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head
        FROM documents, crc
    ), hashed AS (
        SELECT doc_id, source,
            sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
            sha256(head || coalesce(octet_length(encode(tampered_text)) || ':' || tampered_text, '-')) AS tampered
        FROM fields
    ), leaves AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) AS tree
        FROM hashed
    ), nodes AS (
        SELECT tree, 0 AS level, pos, n, leaf AS node FROM leaves
        UNION ALL
        SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos))
        FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 3, n
    ), subroots AS (
        SELECT tree, node AS subroot, level AS height FROM nodes WHERE n = 1
    ), upper AS (
        SELECT 0 AS level, tree - 1 AS pos, (SELECT count(*) FROM subroots) AS n, subroot AS node FROM subroots
        UNION ALL
        SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(node, '' ORDER BY pos))
        FROM upper WHERE n > 1 GROUP BY level, pos // 3, n
    ), top AS (
        SELECT node AS root FROM upper WHERE n = 1
    ), runs AS (
        SELECT tree, level, a.pos, string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos) AS before,
            string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos) AS behind
        FROM nodes AS a JOIN nodes AS b USING (tree, level)
        WHERE a.n > 1 AND a.pos // 3 = b.pos // 3 GROUP BY tree, level, a.pos
    ), upper_runs AS (
        SELECT level, a.pos, string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos) AS before,
            string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos) AS behind
        FROM upper AS a JOIN upper AS b USING (level)
        WHERE a.n > 1 AND a.pos // 3 = b.pos // 3 GROUP BY level, a.pos
    ), steps AS (
        SELECT tree, level, pos, coalesce(before, '') AS before, coalesce(behind, '') AS behind FROM runs
    ), folding AS (
        SELECT tree AS t, pos AS p, 0 AS step, tampered AS node, '' AS proof FROM leaves
        UNION ALL
        SELECT t, p, step + 1,
            sha256(coalesce(s.before, u.before, '') || f.node || coalesce(s.behind, u.behind, '')),
            proof || coalesce(s.before, u.before, '') || coalesce(s.behind, u.behind, '')
        FROM folding AS f JOIN subroots AS r ON r.tree = f.t
            LEFT JOIN steps AS s ON s.tree = f.t AND s.level = f.step AND s.pos = f.p // (3 ** f.step)::BIGINT
            LEFT JOIN upper_runs AS u ON u.level = f.step - r.height AND u.pos = (f.t - 1) // (3 ** greatest(f.step - r.height, 0))::BIGINT
        WHERE f.step < r.height + (SELECT max(level) FROM upper)
    ), ends AS (
        SELECT t, p, node, proof FROM folding AS f JOIN subroots AS r ON r.tree = f.t
        WHERE f.step = r.height + (SELECT max(level) FROM upper)
    )
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
    FROM leaves JOIN subroots USING (tree) JOIN ends ON t = tree AND p = pos CROSS JOIN top
"""


@query
def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path(BYTES))


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))
