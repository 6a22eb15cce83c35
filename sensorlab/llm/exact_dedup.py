"""Exact dedup by content-defined chunk recipes (operator 2).

A text (UTF-8, A-Z folded) is cut where a rolling hash of its last 16 bytes has its low
bits zero, between ``MIN_CHUNK`` and ``MAX_CHUNK`` bytes.  Every chunk is moved once, to the
group of its 128-bit hash, where equal hashes are verified to hold equal bytes; chunks that
share a hash but differ get different identifiers.  A document is then its *recipe*, the
ordered list of verified chunk identifiers, and documents are equal when their recipes
are: long texts are compared without being moved again.

Of equal documents the one with the largest id stays.  Null text counts as empty (the
recipe of no chunk), so all empty texts are one group.  Rows with a null id are dropped;
rows that repeat an id are kept as they are and count as members of their group.  Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlab.llm import textbytes as tb
from sensorlab.llm.storage import written
from sensorlab.session import ship_package

c = F.col

MIN_CHUNK, MAX_CHUNK = 512, 16_384
MASK = (1 << 10) - 1          # about 1 KB beyond the minimum
WINDOW_DOUBLINGS = 4          # 2**4 = 16 bytes
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def cut_points(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text, its length last; none for an empty text."""
    n = len(data)
    if n <= MIN_CHUNK:
        return np.array([n] if n else [], dtype=np.int64)
    rolling = (tb.BYTE_VALUE[data] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    for step in range(WINDOW_DOUBLINGS):
        back = 1 << step
        rolling[back:] = rolling[back:] + (rolling[:-back] << np.uint32(back))
    marks = np.flatnonzero((rolling >> np.uint32(16)) & np.uint32(MASK) == 0) + 1
    ends, start, at = [], 0, 0
    while n - start > MIN_CHUNK:
        at = int(np.searchsorted(marks, start + MIN_CHUNK))
        end = int(marks[at]) if at < len(marks) else n
        end = min(end, start + MAX_CHUNK, n)
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return np.array(ends, dtype=np.int64)


def _chunks(hash_bits: int, with_bytes: bool):
    """Chunk rows (hash, chunk), or one recipe row per document (doc_id, recipe,
    text_sha256); a recipe is the concatenation of its identifiers, all of one length."""
    import hashlib

    size = hash_bits // 8

    def name(raw: bytes) -> bytes:
        return hashlib.blake2b(raw, digest_size=size).digest()

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            data, offsets = tb.utf8(texts)
            for i, j in tb.blocks(offsets, 1 << 20):
                names, chunks, recipes, sums = [], [], [], []
                for r in range(i, j):
                    part = data[offsets[r]:offsets[r + 1]]
                    raw, start, recipe = part.tobytes(), 0, []
                    for end in cut_points(part).tolist():
                        chunk = raw[start:end]
                        recipe.append(name(chunk))
                        if with_bytes:
                            chunks.append(chunk)
                        start = end
                    names.extend(recipe)
                    recipes.append(b"".join(recipe))
                    if not with_bytes:
                        sums.append(hashlib.sha256(raw).hexdigest())
                if with_bytes:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.binary()), pa.array(chunks, pa.binary())], names=["hash", "chunk"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(i, j - i).cast(pa.int64()), pa.array(recipes, pa.binary()),
                         pa.array(sums, pa.string())], names=["doc_id", "recipe", "text_sha256"])
    return run


def _chunk_rows(hash_bits: int):
    """(doc_id, text_sha256, place, hash, chunk) rows, for the few hashes that need their bytes."""
    import hashlib

    schema = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary())

    def run(batches):
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw, start, rows = text.encode(), 0, []
                sha = hashlib.sha256(raw).hexdigest()
                for k, end in enumerate(cut_points(np.frombuffer(raw, np.uint8)).tolist()):
                    name = hashlib.blake2b(raw[start:end], digest_size=hash_bits // 8).digest()
                    rows.append((doc, sha, k, name, raw[start:end]))
                    start = end
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema)],
                                                     names=["doc_id", "text_sha256", "place", "hash", "chunk"])
    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_bits: int = 128) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256."""
    ship_package(docs.sparkSession)
    folded = F.translate(F.coalesce(c(text_col), F.lit("")), UPPER, LOWER)
    texts = docs.select(c(id_col).cast("long").alias("doc_id"), folded.alias("text")).where(c("doc_id").isNotNull())

    # a chunk moves to its hash once per task that holds it (partial min and max)
    chunk = texts.mapInArrow(tb.released(_chunks(hash_bits, True)), "hash binary, chunk binary")
    clash = written(chunk.groupBy("hash").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi"))
                    .where("lo <> hi").select("hash"), "clash")
    recipe = texts.mapInArrow(tb.released(_chunks(hash_bits, False)), "doc_id long, recipe binary, text_sha256 string")
    if clash.limit(1).count():
        # number the differing chunks of a hash, and add the numbers to the recipes
        rows = texts.mapInArrow(_chunk_rows(hash_bits), "doc_id long, text_sha256 string, place long, "
                                                        "hash binary, chunk binary")
        rows = rows.join(clash, "hash", "left_semi")
        variant = (rows.select("hash", "chunk").distinct()
                   .withColumn("variant", F.row_number().over(Window.partitionBy("hash").orderBy("chunk"))))
        numbers = (rows.join(variant, ["hash", "chunk"]).groupBy("doc_id", "text_sha256")
                   .agg(F.sort_array(F.collect_set(F.struct("place", "variant"))).alias("numbers")))
        recipe = (recipe.join(numbers, ["doc_id", "text_sha256"], "left")
                  .withColumn("recipe", F.concat("recipe", F.encode(
                      F.coalesce(F.to_json("numbers"), F.lit("")), "utf-8"))))
    recipe = written(recipe.select("doc_id", "recipe", "text_sha256"), "recipes")
    groups = written(recipe.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("size"))
                     .where("size > 1").select(c("recipe").alias("_recipe"), "keep_id", "size"), "groups")
    # a hot recipe is one sort-merge join key; adaptive execution splits its document side
    return (recipe.join(groups, c("recipe") == c("_recipe"), "left")
            .select("doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"),
                    F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
                    (c("doc_id") == F.coalesce("keep_id", "doc_id")).alias("kept"), "text_sha256"))
