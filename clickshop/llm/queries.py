"""The registered queries of this package: each contract's columns, from an operator's output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickshop.llm import bpe, collocations, decontaminate, html_text, licenses, periodic_runs, quality, reply_trees, secrets, simhash, substrings, token_files, urls
from clickshop.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]

# The path rules of the URL query, and the hosts whose pages are listed.
URL_RULES = (
    urls.PathRule("allow", "org", "/"),
    urls.PathRule("block", "example.org", "/es/"),
    urls.PathRule("block", "example.org", "/en/1"),
    urls.PathRule("allow", "com", "/fr/"),
    urls.PathRule("block", "com", "/de/"),
)
LISTED_HOSTS = r"(^|\.)(spam-farm|free-bets|adult-x|casino-win|cheap-pills|ads-track)\."


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *[f"quality.{n}" for n in [*names, "base_failed", "kept"]])


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    documents = read(spark, sf_dir, "documents")
    path = token_files.token_files(documents, tokenizer, public_tokenizers.PATTERN)
    found = token_files.read_ids(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(documents, read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", role, text)
    messages = given.union(added).select(
        F.col("conv_id").alias("tree"),
        F.row_number().over(order).alias("node"),
        (F.row_number().over(order) - 1).alias("parent"),
        "role",
        "text",
        F.length(text).alias("score"),
    )
    found = reply_trees.format_trees(messages)
    parts = reply_trees.turns_of(F.col("formatted"))
    lines = F.transform(
        F.transform(parts, reply_trees.read_turn),
        lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")),
    )
    loss = F.array_join(reply_trees.loss_texts(F.col("formatted"), F.col("loss_mask")), "")
    return found.select(
        F.col("tree").cast("bigint").alias("conv_id"),
        F.size(parts).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def bpe_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(documents, ranks, public_tokenizers.PATTERN)
    both = bpe.decode(encoded, ranks)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        matches = F.filter("base_spans", lambda s: s["kind"] == kind)
        return F.size(matches).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in secrets.KINDS],
        F.sha2(secrets.digest(F.col("base_spans")), 256).alias("base_sha256"),
        secrets.digest(F.col("spans")).alias("spans"),
    )


def extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).withColumn("n_chars", F.length("text").cast("bigint"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    host, _ = urls.host_and_path(F.col("url"))
    listed = pages.select("url").filter(host.rlike(LISTED_HOSTS))
    return urls.filter_urls(pages, listed, URL_RULES).drop("url")


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents").select("text", "lang"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("notices", lambda n: n["base"])
    starts = F.transform(base, lambda n: n["first_word"])
    base_labels = F.array_sort(F.array_distinct(F.transform(base, lambda n: n["label"])))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    text = periodic_runs.repeated_tail(F.col("text"), F.col("doc_id"))
    found = periodic_runs.periodic_runs(documents.withColumn("text", text))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    milli = F.expr("(1000 * best.length) div best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        milli.alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_token_files": token_output,
        "op2_decontamination": benchmark_hits,
        "op3_quality_rules": quality_rules,
        "op4_suffix_dedup": suffix_dedup,
        "op5_chat_format": chat_format,
        "op6_bpe": bpe_ids,
        "op7_simhash_groups": simhash_groups,
        "op8_secret_scan": secret_scan,
        "op9_html_text": extract_html,
        "op10_url_filter": url_filter,
        "op11_collocations": phrase_collocations,
        "op12_license_scan": license_scan,
        "op13_periodic_runs": period_runs,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    from clickshop.llm import oracle

    return oracle.statements()
