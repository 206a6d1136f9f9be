"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame, each
over its whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.llm import alignment, byte_bpe, decontaminate, interactions, jaccard, language, licenses, mixing, quality, secret_scan, substrings, toxicity, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_url_filters(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return urls.judge_urls(pages, urls.UrlModel(urls.rule_labels(pages)))


def op2_source_mix(spark, sf_dir):
    p = mixing.mix_plan(_documents(spark, sf_dir))
    return p.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_quality_rules(spark, sf_dir):
    return quality.judge(_documents(spark, sf_dir), lang="lang")


def op4_license_scan(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    found = licenses.scan(docs, licenses.fit(docs))
    return found.select("doc_id", F.explode("found").alias("f")).select(
        "doc_id", F.col("f.line").alias("line"), F.col("f.family").alias("family"), F.col("f.probability").alias("probability"), F.col("f.agreement").alias("agreement")
    )


def op5_ngram_jaccard(spark, sf_dir):
    return jaccard.join_components(_documents(spark, sf_dir))


def op6_substring_dedup(spark, sf_dir):
    found = substrings.repeated_spans(_documents(spark, sf_dir))
    return found.withColumn("has_repeats", F.col("n_removed") > 0)


def op7_language_id(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    model = language.fit(docs.where(rest != 2).select("text", "lang"))
    out = language.identify(docs, model)
    return out.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_benchmark_leaks(spark, sf_dir):
    return decontaminate.find_leaks(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op10_secret_scan(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    found = secret_scan.scan(docs, secret_scan.fit(docs))
    base = F.filter("spans", lambda x: x["kind"] != "net")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["a"].cast("string"), x["b"].cast("string"))), ",")
    return found.select("doc_id", *[count(k) for k in ("assign", "access", "hex")], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op11_filter_interactions(spark, sf_dir):
    return interactions.audit(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op12_byte_bpe(spark, sf_dir):
    vocabulary = byte_bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    out = byte_bpe.decode(byte_bpe.encode(docs, vocabulary), vocabulary)
    ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op13_tokenizer_alignment(spark, sf_dir):
    pair = alignment.Pair.load(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.align_documents(_documents(spark, sf_dir), pair)


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_filters, op2_source_mix, op3_quality_rules, op4_license_scan, op5_ngram_jaccard, op6_substring_dedup,
        op7_language_id, op8_benchmark_leaks, op9_toxicity, op10_secret_scan, op11_filter_interactions, op12_byte_bpe, op13_tokenizer_alignment, pipeline,
    )
}
