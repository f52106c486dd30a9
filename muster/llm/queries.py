"""The registered opN_ queries: each applies its operator to the whole given table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm import contained, divergence, hmm, lines, near, oracles, packing, periodic, preference, rules, secret_scan, sharding, warc_zip, weak
from muster.llm.common import documents, vocabulary
from muster.llm.registry import QUERIES, SQL, query  # noqa: F401
from muster.sources.tables import read_table, shared_folder


@query("op7_near_duplicates", oracles.NEAR_DUPLICATES)
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.near_duplicates(documents(spark, sf_dir), width=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op6_decontaminate", oracles.DECONTAMINATE)
def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contained.decontaminated(documents(spark, sf_dir), read_table(spark, "benchmark", sf_dir))
    return rows.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op8_pack")
def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken"))


@query("op2_rule_ledger", oracles.RULE_LEDGER)
def rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.ledger(documents(spark, sf_dir))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes(rules.BASE)).alias("base_failed"), rules.passes(rules.POLICIES[rules.CURRENT]).alias("kept"), "failed",
    )


@query("op10_line_dedup", oracles.LINE_DEDUP)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_repeats(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "text")


@query("op4_weak_labels")
def weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak.scored(documents(spark, sf_dir), read_table(spark, "labels", sf_dir)).drop("key")


@query("op9_hidden_markov")
def hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.scored(documents(spark, sf_dir))


@query("op5_hypergeometric_shards")
def hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shuffled(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op3_secret_scan")
def scan_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scanned(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == secret_scan.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return rows.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
        secret_scan.listed(F.concat("base", "added")).alias("spans"),
    )


@query("op11_periodic_runs", oracles.periodic_runs())
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic.periodic_runs(periodic.with_repeats(documents(spark, sf_dir))).withColumn("best", periodic.longest(F.col("runs")))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic.listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_source_divergence", oracles.SOURCE_DIVERGENCE)
def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(documents(spark, sf_dir))


@query("op13_zip_archives", oracles.ZIP_ARCHIVES)
def zip_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, "pages", sf_dir)
    records = warc_zip.with_revisits(pages.select(F.col("page_id").cast("long").alias("id"), F.col("url").alias("uri"), F.col("html").cast("string").alias("payload")))
    found = warc_zip.read(warc_zip.written(records, shared_folder(spark, "archives")))
    return found.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


_TURN = "'<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)"


def _mask_sql(turns: str) -> str:
    before = f"len(prompt) + coalesce(list_sum(list_transform({turns}[:i - 1], lambda t: len({_TURN}))), 0)"
    span = f"CASE WHEN u.role = 'assistant' THEN CAST(CAST({before} + 4 + len(u.role) + 1 AS BIGINT) AS VARCHAR) || ':' || CAST(CAST({before} + len({_TURN.replace('t.', 'u.')}) AS BIGINT) AS VARCHAR) END"
    return f"array_to_string(list_filter(list_transform({turns}, lambda u, i: {span}), lambda x: x IS NOT NULL), ',')"


@query("op1_preference_pairs", f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), ending AS (
  SELECT DISTINCT ON (conv_id) conv_id, turn AS last, text AS words FROM said WHERE role = 'assistant' ORDER BY conv_id, turn DESC NULLS LAST, text DESC
), turns AS (
  SELECT 2 * conv_id AS conv_id, turn, role, text FROM said
  UNION ALL SELECT 2 * s.conv_id + 1, s.turn, s.role, CASE WHEN s.role = 'assistant' AND s.turn IS NOT DISTINCT FROM e.last THEN o.words ELSE s.text END
  FROM said s JOIN ending e ON e.conv_id = s.conv_id JOIN ending o ON o.conv_id = xor(s.conv_id, 1)
), convs AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn, role, text) AS turns,
         coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS said
  FROM turns GROUP BY conv_id
), seated AS (
  SELECT *, turns[1] AS opening, row_number() OVER (PARTITION BY turns[1] ORDER BY conv_id) - 1 AS seat FROM convs
), pairs AS (
  SELECT a.conv_id AS ia, b.conv_id AS ib, a.turns AS ta, b.turns AS tb, coalesce(b.said > a.said, FALSE) AS second
  FROM seated a LEFT JOIN seated b ON a.opening = b.opening AND b.seat = a.seat + 1 WHERE a.seat % 2 = 0
), sides AS (
  SELECT CASE WHEN second THEN ib ELSE ia END AS chosen_id, CASE WHEN second THEN ia ELSE ib END AS rejected_id,
         CASE WHEN second THEN tb ELSE ta END AS c, CASE WHEN second THEN ta ELSE tb END AS r FROM pairs
), cut AS (
  SELECT *, CASE WHEN r IS NULL
    THEN coalesce(list_max(list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant')) - 1, len(c))
    ELSE coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1), lambda i: c[i] <> r[i])) - 1, least(len(c), len(r))) END AS n
  FROM sides
), parts AS (
  SELECT chosen_id, rejected_id, n, array_to_string(list_transform(c[:n], lambda t: {_TURN}), '') AS prompt, c[n + 1:] AS c, r[n + 1:] AS r FROM cut
)
SELECT chosen_id // 2 AS conv_id, chosen_id, rejected_id, CAST(n AS INTEGER) AS n_prompt_turns, prompt, array_to_string(list_transform(c, lambda t: {_TURN}), '') AS chosen,
       array_to_string(list_transform(r, lambda t: {_TURN}), '') AS rejected, {_mask_sql('c')} AS chosen_mask, {_mask_sql('r')} AS rejected_mask FROM parts
""")
def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation against itself with another's last answer; ids are doubled to name both."""
    rows = preference.formatted(preference.with_other_endings(read_table(spark, "conversations", sf_dir)))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(c)
    return rows.select(F.expr("chosen_id div 2").alias("conv_id"), "chosen_id", "rejected_id", "n_prompt_turns", "prompt", "chosen", "rejected", spans("chosen_mask"), spans("rejected_mask"))
