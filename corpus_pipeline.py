"""A training-corpus pipeline of five stages over the operators of ``sensorlab.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read back as the next stage's documents.  All but the last return the columns of
``documents``.  Null or empty texts are rejected by the first stage; rows with a null id
are dropped by it, as later stages decide by id.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlab.llm import bpe, exact_dedup, jaccard_join, langid, mixing
from sensorlab.llm.queries import vocabulary_path
from sensorlab.llm.storage import written

c = F.col


def _fresh(docs, name):
    """``name`` with underscores in front until it clashes with no column of ``docs``."""
    taken = {k.lower() for k in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def _keep(docs, ids):
    """The documents whose id is in ``ids``."""
    key = _fresh(docs, "_kept")
    return docs.join(ids.select(c("doc_id").alias(key)), c("doc_id") == c(key), "left_semi")


def identify_language(spark, docs, sf_dir):
    """Language ID (7): documents without text or without a letter go, and each one that stays
    is labelled with its predicted language (``und`` if there is no row to learn from).  The filters learn from the rows with a
    language that the operator's query may learn from."""
    docs = docs.where("doc_id is not null")
    filters = langid.train(docs.where(~langid.is_held_out("doc_id", 3, 1)))
    # the prediction runs beside the other columns, so no row is moved
    names = [f"column_{i}" for i in range(len(docs.columns))]
    id_col, text_col = (names[docs.columns.index(k)] for k in ("doc_id", "text"))
    found = langid.predict(docs.toDF(*names), filters, id_col, text_col, keep=names)
    # the prediction tells texts without a letter only if something else is never called so
    named = bool(filters.langs) and langid.UNKNOWN not in filters.langs
    return found.where(c("lang_pred") != langid.UNKNOWN if named else langid.has_letter(c(text_col))).select(
        *[(c("lang_pred") if k == "lang" else c(n)).alias(k) for n, k in zip(names, docs.columns)])


def drop_copies(spark, docs, sf_dir):
    """Exact dedup (2): of equal texts the document with the largest id stays."""
    return _keep(docs, exact_dedup.exact_dedup(docs).where("kept"))


def drop_near_copies(spark, docs, sf_dir):
    """N-gram Jaccard join (8): of each group of linked documents the smallest id stays."""
    return _keep(docs, jaccard_join.jaccard_components(docs).where("doc_id = component_id"))


def mix_sources(spark, docs, sf_dir):
    """Mixing (4): a document comes as often as the mix reads from it (0, 1 or 2 times)."""
    _, pieces, _ = mixing.mixed_pieces(docs)
    key, copies = _fresh(docs, "_id"), _fresh(docs, "_copies")
    times = pieces.groupBy(c("doc_id").alias(key)).agg(F.collect_set("epoch").alias(copies))
    rows = docs.join(written(times, "times"), c("doc_id") == c(key))
    return rows.select(*docs.columns, F.explode(copies).alias(_fresh(docs, "_copy"))).select(*docs.columns)


def tokenize(spark, docs, sf_dir):
    """BPE (3): doc_id, lang, source, n_tokens and the ids as little-endian 32-bit integers."""
    coded = bpe.encode(docs, vocabulary_path(), keep=["lang", "source"])
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [("language_id", identify_language), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("mix_sources", mix_sources), ("bpe", tokenize)]

# Language filters and BPE have no SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
