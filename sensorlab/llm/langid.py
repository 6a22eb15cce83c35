"""Language identification by language-bitmask n-gram filters (operator 7).

Training counts character 3- and 4-grams per language over every labelled row.  An n-gram
belongs to the languages in which its relative frequency is at least ``NEAR_BEST`` of its
best one.  All languages share one Bloom filter of ``HASHES`` hashes whose
slots hold a bit per language (bit-sliced: one look-up tests all languages): the AND of an
n-gram's slots is the set of languages that contain it.  There are so many slots (a power of
two) that the language with most n-grams sets at most half of them, 2**``SLOT_BITS`` at least.
They are built with ``bit_or`` in Spark and reach the driver if their masks fit into
``MASK_BYTES``.  Beyond that the n-grams stay a table, and texts meet it in a Spark join: the
same counts without false positives.

A text's n-grams are looked up and counted per language; a language's hit rate is
corrected for its filter's false positives, (hits / n - f) / (1 - f) with f = fill ** HASHES,
and the highest rate decides (ties: first language by name).  ``score`` is its share of all
corrected rates.

Null texts and texts without a letter are ``und`` with score 0; so is every text if there
is no labelled row.  Rows are kept one to one; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlab.llm import textbytes as tb
from sensorlab.llm.storage import written
from sensorlab.session import ship_package

c = F.col
U64 = np.uint64

SLOT_BITS = 20               # least size of the filter
MASK_BYTES = 32 << 20        # largest filter that is sent around
HASHES = 4
ORDERS = (3, 4)
NEAR_BEST = 0.5
LEAST_COUNT = 3
LANGS_PER_WORD = 63          # one signed long holds the bits of so many languages
BLOCK_BYTES = 1 << 18         # text taken at once: its n-gram arrays are some hundred times as large
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for every other code point."""
    if not _LETTERS:
        table = np.zeros(0x110000, dtype=np.uint32)
        for x in range(0x110000):
            ch = chr(x)
            if ch.isalpha():
                low = ch.lower()
                table[x] = ord(low) if len(low) == 1 else x
        _LETTERS.append(table)
    return _LETTERS[0]


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of all n-grams whose inner signs are letters; a sign that is no
    letter counts as a border."""
    raw = "\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass")
    points = np.r_[np.uint32(0), _letters()[np.frombuffer(raw, dtype=np.uint32)]]
    ends = np.cumsum([len(t) + 1 for t in texts])
    value = tb.mix(points.astype(U64) + U64(0x51ED270B))
    rows, hashes = [], []
    for n in ORDERS:
        size = len(points) - n + 1
        if size <= 0:
            continue
        inner = np.ones(size, dtype=bool)
        for j in range(1, n - 1):
            inner &= points[j:j + size] > 0
        at = np.flatnonzero(inner)
        total = np.full(len(at), n, dtype=U64)
        for j in range(n):
            total = total * U64(0x9E3779B97F4A7C15) + value[at + j]
        rows.append(np.searchsorted(ends, at + 1, side="right"))
        hashes.append(tb.mix(total))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    return np.concatenate(rows), np.concatenate(hashes)


def _counting(batches):
    """(hash, lang, n) rows: n-gram counts of a task, flushed when they grow large."""
    held: dict[str, list] = {}

    def flush(lang):
        h, n = (np.concatenate(x) for x in zip(*held[lang]))
        u, back = np.unique(h, return_inverse=True)
        total = np.bincount(back, weights=n).astype(np.int64)
        held[lang] = [(u, total)]
        return u, total

    def rows(lang):
        u, n = flush(lang)
        held[lang] = []
        return pa.RecordBatch.from_arrays(
            [pa.array(u.view(np.int64)), pa.array([lang] * len(u), pa.string()), pa.array(n)],
            names=["hash", "lang", "n"])

    for batch in batches:
        text, lang = batch.column(0), batch.column(1).to_pylist()
        _, offsets = tb.utf8(text)
        for i, j in tb.blocks(offsets, BLOCK_BYTES):
            by: dict[str, list] = {}
            for t, name in zip(text.slice(i, j - i).to_pylist(), lang[i:j]):
                by.setdefault(name, []).append(t or "")
            for name, texts in by.items():
                _, h = ngrams(texts)
                if not len(h):
                    continue
                u, n = np.unique(h, return_counts=True)
                held.setdefault(name, []).append((u, n))
                if sum(len(x) for x, _ in held[name]) > 1_000_000 and len(flush(name)[0]) > 500_000:
                    yield rows(name)
    for name in list(held):
        if held[name]:
            yield rows(name)


def slot_bits(n: int) -> int:
    """Bits of a slot number with which n n-grams of a language set at most half of the slots."""
    return max(SLOT_BITS, int(np.ceil(np.log2(max(1, n) * HASHES / np.log(2)))))


class Filters:
    """The learned filters: languages, slot masks [slots, words] and false-positive rates; or
    the table (hash, k) of n-grams and numbers of languages instead of the masks."""

    def __init__(self, langs: list[str], masks: np.ndarray | None, table: DataFrame | None = None):
        self.langs, self.masks, self.table = langs, masks, table
        if masks is not None:
            bits = [(masks[:, k // LANGS_PER_WORD] >> (k % LANGS_PER_WORD)) & 1 for k in range(len(langs))]
            self.false = np.array([float(b.mean()) ** HASHES for b in bits])

    def rates(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(corrected hit rate per text and language, n-grams per text)."""
        row, h = ngrams(texts)
        n = np.bincount(row, minlength=len(texts))
        slots = len(self.masks)
        low = (h & U64(slots - 1)).astype(np.int64)
        step = (((h >> U64(slots.bit_length() - 1)) & U64(slots - 1)) | U64(1)).astype(np.int64)
        found = self.masks[low]
        for k in range(1, HASHES):
            found &= self.masks[(low + k * step) & (slots - 1)]
        out = np.zeros((len(texts), len(self.langs)))
        for k in range(len(self.langs)):
            hit = (found[:, k // LANGS_PER_WORD] >> (k % LANGS_PER_WORD)) & 1
            hits = np.bincount(row, weights=hit, minlength=len(texts))
            out[:, k] = (hits / np.maximum(n, 1) - self.false[k]) / max(1e-9, 1 - self.false[k])
        return out, n


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Filters from every row of ``labelled`` with a text and a language."""
    spark = labelled.sparkSession
    ship_package(spark)
    rows = labelled.select(c(text_col).alias("text"), c(lang_col).alias("lang")).where("text is not null and lang is not null")
    counts = written(rows.mapInArrow(tb.released(_counting), "hash long, lang string, n long")
                     .groupBy("hash", "lang").agg(F.sum("n").alias("n")), "ngrams")
    totals = written(counts.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    # the languages: the distinct values of a label column
    langs = sorted(r["lang"] for r in totals.select("lang").toLocalIterator())
    words = max(1, -(-len(langs) // LANGS_PER_WORD))
    bits = SLOT_BITS
    if langs:
        number = F.array_position(F.array(*[F.lit(x) for x in langs]), c("lang")) - 1
        share = counts.join(totals, "lang").select("hash", "n", number.alias("k"), (c("n") / c("total")).alias("rate"))
        best = share.groupBy("hash").agg(F.max("rate").alias("best"), F.sum("n").alias("all"),
                                         F.collect_list(F.struct("k", "rate")).alias("each"))
        kept = written(best.where(c("all") >= LEAST_COUNT).select(
            "hash", F.explode(F.filter("each", lambda x: x["rate"] >= NEAR_BEST * c("best"))).alias("x"))
            .select("hash", c("x.k").cast("int").alias("k")), "kept")
        bits = slot_bits(kept.groupBy("k").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0)
        if (words * 8) << bits > MASK_BYTES:
            return Filters(langs, None, kept)
    slots = 1 << bits
    masks = np.zeros((slots, words), dtype=np.int64)
    if langs:
        low = c("hash").bitwiseAND(slots - 1)
        step = F.shiftrightunsigned("hash", bits).bitwiseAND(slots - 1).bitwiseOR(1)
        places = F.array(*[(low + j * step).bitwiseAND(slots - 1) for j in range(HASHES)])
        bit = F.expr(f"shiftleft(1L, k % {LANGS_PER_WORD})")
        got = (kept.select(F.explode(places).alias("slot"), F.floor(c("k") / LANGS_PER_WORD).alias("word"), bit.alias("bit"))
               .groupBy("slot", "word").agg(F.bit_or("bit").alias("mask")).toPandas())     # at most MASK_BYTES / 8 rows
        masks[got["slot"].to_numpy(np.int64), got["word"].to_numpy(np.int64)] = got["mask"].to_numpy(np.int64)
    return Filters(langs, masks)


def _listing(batches):
    """(row, hash, n): the n-grams of each text and how often they come."""
    for batch in batches:
        number = batch.column(0).to_numpy()
        _, offsets = tb.utf8(batch.column(1))
        for i, j in tb.blocks(offsets, BLOCK_BYTES):
            row, h = ngrams([t or "" for t in batch.column(1).slice(i, j - i).to_pylist()])
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            begin = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number[i:j][row[begin]]), pa.array(h[begin].view(np.int64)),
                 pa.array(np.diff(np.r_[begin, len(h)]).astype(np.int64))], names=["row", "hash", "n"])


def _predict_by_join(rows: DataFrame, filters: Filters, names: list[str]) -> DataFrame:
    """``predict`` with the n-grams of ``filters.table``; names are the output's columns."""
    columns = [f"column_{i}" for i in range(len(rows.columns))]
    numbered = written(rows.toDF(*columns).withColumn("row", F.monotonically_increasing_id()), "numbered")
    grams = written(numbered.select("row", columns[1]).mapInArrow(tb.released(_listing), "row long, hash long, n long"), "grams")
    hits = grams.join(filters.table, "hash").groupBy("row", "k").agg(F.sum("n").alias("hits"))
    # most hits; of equal ones the first language
    best = hits.groupBy("row").agg(F.max(F.struct("hits", (-c("k")).alias("k"))).alias("best"), F.sum("hits").alias("all"))
    found = (grams.select("row").distinct().join(best, "row", "left")
             .select(c("row").alias("_row"), (2 - F.coalesce("best.k", F.lit(0))).alias("number"),
                     F.coalesce(c("best.hits") / c("all"), F.lit(0.0)).alias("score")))
    lang = F.element_at(F.array(*[F.lit(x) for x in (UNKNOWN, *filters.langs)]), F.coalesce("number", F.lit(1)))
    kept = columns[2:] or columns[:1]
    return numbered.join(found, c("row") == c("_row"), "left").select(
        *[c(x).alias(k) for x, k in zip(kept, names)], lang.alias("lang_pred"), F.coalesce("score", F.lit(0.0)).alias("score"))


def predict(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text",
            keep: list[str] | None = None) -> DataFrame:
    """doc_id, lang_pred, score: one row per document; with ``keep`` these columns of the
    documents instead of doc_id."""
    spark = docs.sparkSession
    ship_package(spark)
    names = keep or ["doc_id"]
    rows = docs.select(c(id_col).alias("_id"), c(text_col).alias("_text"), *[c(k) for k in keep or []])
    if filters.table is not None:
        return _predict_by_join(rows, filters, names)
    shared = spark.sparkContext.broadcast(filters)  # at most MASK_BYTES

    def run(batches):
        f = shared.value
        for batch in batches:
            texts = batch.column(1)
            _, offsets = tb.utf8(texts)
            for i, j in tb.blocks(offsets, BLOCK_BYTES):
                part = [t or "" for t in texts.slice(i, j - i).to_pylist()]
                if f.langs:
                    rate, n = f.rates(part)
                    best = rate.argmax(axis=1)
                    rate = np.maximum(rate, 0)
                    top = rate[np.arange(len(part)), best]
                    score = np.where(n > 0, top / np.maximum(rate.sum(axis=1), 1e-12), 0.0)
                    lang = [f.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist())]
                else:
                    lang, score = [UNKNOWN] * len(part), np.zeros(len(part))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(i, j - i) for k in out), pa.array(lang, pa.string()),
                     pa.array(np.clip(score, 0, 1))], names=[*names, "lang_pred", "score"])

    out = list(range(2, 2 + len(keep))) if keep else [0]
    kinds = [docs.schema[k].dataType.simpleString() for k in keep or [id_col]]
    return rows.mapInArrow(tb.released(run), ", ".join(f"`{k}` {t}" for k, t in zip(names, kinds)) + ", lang_pred string, score double")


def has_letter(text):
    """Column: the text holds a letter, as ``ngrams`` sees letters."""
    return F.udf(_has_letter, "boolean")(text)


def _has_letter(text):
    return any(map(str.isalpha, text or ""))


def is_held_out(id_col: str, parts: int, part: int):
    """crc32 of the id's text modulo ``parts`` is ``part``; a null id is not held out."""
    return F.coalesce(F.crc32(c(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: filters from the rows that are not held out,
    applied to every row."""
    filters = train(docs.where(~is_held_out("doc_id", 3, 1)))
    return predict(docs, filters).select("doc_id", is_held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")
