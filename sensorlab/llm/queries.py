"""Registered queries of the operators for training-data pipelines, and their DuckDB SQL.

Each query applies its operator with production parameters to its whole table.  Where SQL
cannot state the result, ``tests/llm`` compares the query with brute force.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlab.llm import (bpe, conversation_repair, exact_dedup, jaccard_join, langid, license_scan, line_dedup, mixing,
                           packing, spelling, toxicity, vector_join, warc)

VOCABULARY = "word_bpe_49k.json"
UPPER, LOWER = exact_dedup.UPPER, exact_dedup.LOWER


def read(spark, sf_dir: str, table: str):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(read(spark, sf_dir, "documents"))


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op3_bpe(spark, sf_dir):
    coded = bpe.encode(read(spark, sf_dir, "documents"), vocabulary_path(), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_toxicity(spark, sf_dir):
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_warc(spark, sf_dir):
    done = warc.round_trip(read(spark, sf_dir, "pages"))
    return done.select("metadata.page_id", "response.payload_bytes", "response.payload_digest",
                       F.col("response.type").alias("record_type"), "metadata.refers_to")


def op7_langid(spark, sf_dir):
    return langid.identify(read(spark, sf_dir, "documents"))


def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def op9_vector_join(spark, sf_dir):
    return vector_join.vector_join(read(spark, sf_dir, "embeddings"))


def op10_license_scan(spark, sf_dir):
    return license_scan.license_scan(read(spark, sf_dir, "documents")).select("doc_id", "licenses", "n_findings")


def op11_packing(spark, sf_dir):
    return packing.pack(packing.pieces(read(spark, sf_dir, "documents"), vocabulary_path()))


def op12_conversation_repair(spark, sf_dir):
    return conversation_repair.repair(conversation_repair.damaged(read(spark, sf_dir, "conversations")))


def op13_spelling(spark, sf_dir):
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_exact_dedup, op3_bpe, op4_mixing, op5_toxicity, op6_warc, op7_langid, op8_jaccard_join,
    op9_vector_join, op10_license_scan, op11_packing, op12_conversation_repair, op13_spelling, pipeline)}

ORACLE = {
    "op2_exact_dedup": f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS x FROM documents WHERE doc_id IS NOT NULL)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(x) AS text_sha256
FROM t WINDOW w AS (PARTITION BY x)""",
    "op4_mixing": mixing.oracle(),
    "op6_warc": warc.oracle(),
    "op13_spelling": spelling.oracle(),
}
