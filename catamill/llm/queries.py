"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from catamill.llm import byte_bpe, codes_oracle, html_wrapper, language_id, ngram_join, packing, pitman_yor, quality_classifier, quality_rules, telephony, toxicity, url_filter, url_oracle, vector_codes, whitening
from catamill.llm.common import fold
from catamill.session import table

#: The list rules of op7.
URL_RULES = (
    url_filter.Rule("block", "com", "/en/"),
    url_filter.Rule("allow", "example.com", "/en/7"),
    url_filter.Rule("allow", "net", "/de/"),
    url_filter.Rule("block", "example.net", "/de/8"),
    url_filter.Rule("block", "org", "/es/"),
)


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), *columns)


def op1_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's bytes as mu-law samples in a WAV file, read back and resampled to 16 kHz PCM."""
    docs = _documents(spark, sf_dir, "text")
    docs = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), telephony.padded(F.col("text")).alias("payload"))
    stored = telephony.store(docs)
    stored = stored.select("doc_id", "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "media")
    back, n = telephony.expand(stored), F.octet_length("payload")
    return back.select(
        "doc_id", "n_bytes", n.cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.substring(F.col("payload"), n - 63, F.lit(64))).alias("tail_crc32"),
        "media_bytes", "media_sha256", "feature", F.octet_length("pcm").cast("long").alias("pcm_bytes"), F.crc32("pcm").alias("pcm_crc32"),
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    path = vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = byte_bpe.encode(_documents(spark, sf_dir, "text"), path, public_tokenizers.PATTERN)
    back = byte_bpe.decode(ids, path, public_tokenizers.PATTERN, keep=("n_tokens",))
    return back.select("doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 3) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.where(~held_out))
    return language_id.predict(docs, model).withColumn("held_out", held_out)


def op4_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract_pages(table(spark, sf_dir, "pages"))


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "text").withColumn("learn", fold(F.col("doc_id"), 7) != 2)
    out = pitman_yor.score_documents(docs)
    return out.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_documents(spark, sf_dir, "text"), n=4, percent=85)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the label of the document whose text it holds: bad where quality is 0."""
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 0).alias("bad"))
    out = url_filter.judge_urls(pages, url_filter.outcomes_of(pages, _documents(spark, sf_dir, "text"), labels), URL_RULES)
    return out.withColumns({c: F.round(c, 6) for c in ("bad_rate", "bad_low")})


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "text", "lang", "source")
    out = quality_rules.apply_rules(docs, slim=True)
    return out.select("doc_id", *[f"qr.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed", "symbol_rate", "dup_line_rate", "repeat_rate", "mean_word")])


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 0
    docs = _documents(spark, sf_dir, "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality_classifier.train(docs, labels.where(~held_out))
    scored = quality_classifier.score(docs, model).drop("text")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_packing(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir, "text"), vocabulary or public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.train(_documents(spark, sf_dir, "text", "lang"), labels.where(~held_out))
    scored = toxicity.score(_documents(spark, sf_dir, "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_telephony, op2_byte_bpe, op3_language_id, op4_html_wrapper, op5_pitman_yor, op6_ngram_join, op7_url_filter, op8_quality_rules, op9_quality_classifier, op10_packing, op11_vector_codes, op12_toxicity, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op7_url_filter": url_oracle.sql(URL_RULES), "op11_vector_codes": codes_oracle.sql()}
