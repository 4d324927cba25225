"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latticeguard.llm import (
    bpecodec,
    chatrepair,
    decontaminate,
    filteraudit,
    hostquality,
    langid,
    linededup,
    packing,
    pii,
    simhash,
    tokencount,
    urlfilter,
    vectorcode,
)
from latticeguard.llm.common import documents, materialize, read_table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir).select("doc_id", "text"))

    def count(place: int, kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["k"] == place)).cast("long").alias(f"n_{kind}")

    counts = [count(i, kind) for i, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.spelt(F.col("base")), 256).alias("base_sha256"),
                        pii.spelt(F.col("spans")).alias("spans"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = documents(spark, sf_dir).select("doc_id", held_out.alias("held_out"), "text", "lang")
    model = langid.fit(docs.where("NOT held_out"))
    return langid.predict(docs.drop("lang"), model).drop("text")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    listed = materialize(urlfilter.listed_hosts(pages), "listed-hosts")
    return urlfilter.verdicts(pages, urlfilter.RULES, listed).drop("url")


def op5_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostquality.judge(documents(spark, sf_dir))


def op6_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chatrepair.repair_conversations(read_table(spark, sf_dir, "conversations"))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id", "source", "text", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    cut = linededup.drop_boilerplate(docs, dropped="n_dropped")
    return cut.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("n_chars"),
                      F.sha2("text", 256).alias("text_sha256"))


def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books, coded = vectorcode.compress(vectors)
    with_errors = vectorcode.label_errors(coded)
    digest = F.sha2(F.lit(vectorcode.spelt(books)), 256)
    return with_errors.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpecodec.encode(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    n_tokens = F.floor(F.length("ids") / 4).alias("n_tokens")
    return bpecodec.decode(coded).select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"),
                                         F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_language": op2_language,
    "op3_decontaminate": op3_decontaminate,
    "op4_url_filter": op4_url_filter,
    "op5_host_quality": op5_host_quality,
    "op6_chat_repair": op6_chat_repair,
    "op7_pack": op7_pack,
    "op8_simhash": op8_simhash,
    "op9_line_dedup": op9_line_dedup,
    "op10_token_count": op10_token_count,
    "op11_vector_codes": op11_vector_codes,
    "op12_filter_audit": op12_filter_audit,
    "op13_bpe": op13_bpe,
}
