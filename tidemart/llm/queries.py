"""Registered queries of this package, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.llm import (
    byte_bpe,
    collocations,
    decontaminate,
    jaccard_join,
    lang_id,
    lexical_search,
    license_scan,
    packing,
    quality_pu,
    quality_rules,
    sharding,
    toxicity,
    url_filter,
)
from tidemart.llm.common import remainder, table


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: the rules that op3 judges by
URL_RULES = [
    url_filter.UrlRule("net", "/", False),
    url_filter.UrlRule("example.net", "/en/", True),
    url_filter.UrlRule("example.com", "/de/", False),
    url_filter.UrlRule("org", "/fr/", True),
]


def op1_extendible_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), packing.PackParams(word_tokenizer()))


def op3_url_filters(spark, sf_dir):
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op4_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "mean_ratio")


def op5_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model, _ = quality_pu.fit(docs, table(spark, sf_dir, "labels"))
    return quality_pu.score(docs, model).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_benchmark_decontamination(spark, sf_dir):
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = lang_id.identify(docs, lang_id.fit(docs))
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op11_phrase_collocations(spark, sf_dir):
    return collocations.phrases(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark, sf_dir):
    return lexical_search.search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_byte_bpe(spark, sf_dir):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), byte_bpe.BpeParams(ranks, public_tokenizers.PATTERN))


QUERIES = {f.__name__: f for f in (
    op1_extendible_sharding, op2_best_fit_packing, op3_url_filters, op4_toxicity, op5_license_scan,
    op6_quality_rules, op7_ngram_jaccard_join, op8_quality_classifier, op9_benchmark_decontamination, op10_language_id,
    op11_phrase_collocations, op12_lexical_search, op13_byte_bpe,
)}
