"""Registered queries of the subpackage: each runs one operator, with its production parameters,
over its whole table and derives the contract's columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm import chat, chunk_dedup, common, conversation_repair, decontam, html_text, line_dedup, packing, quality, secret_scan, simhash, spelling, token_rollup, warc
from trendlake.llm.oracle import SQL
from trendlake.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(common.table(spark, sf_dir, "pages"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = line_dedup.decisions(docs).alias("r")
    rows = docs.select("doc_id", common.text_hash().alias(common.TEXT_HASH), F.size(F.split(common.whole_text(), "\n")).cast("long").alias("n_lines"))
    return rows.alias("d").join(found, common.same_row("d", "r"), "left").select(
        "d.doc_id", "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_edited", F.lit(0).cast("long")).alias("n_edited"),
        F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed_lines"),
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_scan(common.table(spark, sf_dir, "documents"))
    named = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")
    counts = [F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k, *_ in secret_scan.KINDS]
    return found.select("doc_id", *counts, F.sha2(named, 256).alias("base_sha256"), named.alias("spans"), "n_live", "n_example", "n_unclear")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.find_hits(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as mails that quote each other, unquoted and linked again."""
    linked = chat.link_conversations(chat.quoted_replies(common.table(spark, sf_dir, "conversations")))
    return linked.select(
        "conv_id", "turn", "role", F.sha2("text", 256).alias("text_sha256"), "parent_turn", "root_turn", "depth", "n_quoted", "n_linked",
    )


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunk_dedup.repeated_spans(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "stop", "bytes", "first_doc_id")


def tokenizer_path() -> str:
    """The public 50k byte-level tokenizer of the installed vocabulary package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenizers() -> dict[str, str]:
    """Two versions of a byte-level tokenizer: the one above, and one made for many languages."""
    import public_tokenizers

    return {"byte_bpe_50k": tokenizer_path(), "byte_bpe_multi_50k": public_tokenizers.path("byte_bpe_multi_50k.tiktoken")}


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.table(spark, sf_dir, "documents"), tokenizer_path())


def op10_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches made from the documents, the second of them committed twice."""
    root = scratch_dir(spark, "rollup")
    batches = token_rollup.document_feed(common.table(spark, sf_dir, "documents"), tokenizers())
    for number in (1, 2, 2, 3):
        token_rollup.commit(spark, root, number, batches[number - 1])
    return token_rollup.totals(spark, root)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of every conversation, after some of its rows were damaged."""
    rows = common.table(spark, sf_dir, "conversations")
    return conversation_repair.audited(rows, conversation_repair.damaged(rows))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(common.table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the corpus's words, some of which lost a letter."""
    return spelling.variant_groups(spelling.words(common.table(spark, sf_dir, "documents"), spoil=True))


def queries() -> dict[str, Query]:
    return {
        "op1_warc_chains": op1_warc_chains,
        "op2_line_dedup": op2_line_dedup,
        "op3_secret_scan": op3_secret_scan,
        "op4_decontamination": op4_decontamination,
        "op5_quality_rules": op5_quality_rules,
        "op6_quotation_linking": op6_quotation_linking,
        "op7_simhash_near_dedup": op7_simhash_near_dedup,
        "op8_chunk_dedup": op8_chunk_dedup,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_token_rollup": op10_token_rollup,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_html_text": op12_html_text,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
