"""Toxicity by a linear-chain conditional random field over tokens (operator 5).

1. Over every labelled training row, Spark counts in how many toxic and clean documents a
   word and its first 4, 5, 6 and 7 letters occur (hashed into 2**TABLE_BITS slots
   each, a fixed bound on what reaches the driver).  A slot's log-odds are shrunk towards 0.
2. Tokens of toxic training documents whose log-odds are high are labelled toxic, all other
   tokens clean.  A two-state CRF with the binned log-odds as features is fitted to a
   sample of whole training documents (documented bounds of a classifier's fit: at most
   ``SAMPLE_DOCS`` documents and ``SAMPLE_BYTES`` bytes of each label, in hash order; the first of each label always) by its
   exact likelihood gradient.  For the fit a text is cut into sequences of ``SEQUENCE`` tokens.
3. Every text is scored whole: forward-backward gives each token's marginal of being toxic;
   a document has the largest marginal, the sum of marginals (log) and their share.
4. A logistic regression (Spark ML) over those three, fitted to all labelled training
   documents, gives the score.

Labels, language, source and id are never inputs of a score.  Null and empty texts have no
tokens and get the score of three zeros.  Without training rows of both labels every score
is 0 and predicted 0.  Documents are kept one to one; extra columns
are ignored.  Rows that repeat an id are scored each, and all learned from if one of them is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlab.llm import textbytes as tb
from sensorlab.llm.langid import is_held_out
from sensorlab.llm.storage import checked, written
from sensorlab.session import ship_package

c = F.col
U64 = np.uint64

TABLE_BITS = 18
PREFIXES = (None, 4, 5, 6, 7)  # the whole word and its first letters
KINDS = len(PREFIXES)
EDGES = np.array([-1.0, -0.3, 0.3, 1.0, 1.7, 2.4])   # bins of log-odds
BINS = len(EDGES) + 1
LEAST_PRIOR = 8.0              # documents of prior in a slot's rate, at least; grows with the
PRIOR_SHARE = 0.01             # toxic documents, as groups of near copies do
TOXIC_ODDS = 1.5               # log-odds from which a token of a toxic document is labelled
SAMPLE_DOCS, SAMPLE_BYTES, SEQUENCE = 1000, 2 << 20, 400
PACKED = 1 << 13               # slots in a packed row of counts
STEPS, RATE, PENALTY = 80, 0.2, 1e-4
SIGNALS = ["top", "mass", "share"]

IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True


# ------------------------------------------------------------------ tokens
def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end, slots[KINDS]) of the words of the rows; runs of letters (bytes beyond
    ASCII count as letters), A-Z folded."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros((KINDS, 0), np.int64)
    inside = IS_WORD[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    sums = tb.prefix_sums(data, tb.FOLDED_VALUE)
    signs = np.flatnonzero((data & 0xC0) != 0x80)          # first byte of every character
    number = np.searchsorted(signs, start)
    slots = np.empty((KINDS, len(start)), np.int64)
    for kind, letters in enumerate(PREFIXES):
        stop = end
        if letters:
            at = number + letters
            stop = np.where(at < len(signs), np.minimum(end, signs[np.minimum(at, len(signs) - 1)]), end)
        h = tb.mix(tb.substring_hash(sums, start, stop) + U64(kind + 1))
        slots[kind] = (h >> U64(64 - TABLE_BITS)).astype(np.int64)
    return row, start, end, slots


def _counting(batches):
    """(slot, toxic, clean) rows: documents of a task that hold the slot, by label."""
    total = np.zeros((2, KINDS << TABLE_BITS), dtype=np.int64)
    for batch in batches:
        data, offsets = tb.utf8(batch.column(0))
        label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for i, j in tb.blocks(offsets):
            row, _, _, slots = tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            for kind in range(KINDS):
                key = np.unique((row << TABLE_BITS) + slots[kind])
                doc, slot = key >> TABLE_BITS, (key & ((1 << TABLE_BITS) - 1)) + (kind << TABLE_BITS)
                np.add.at(total, (label[i:j][doc], slot), 1)
    used = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[1][used]), pa.array(total[0][used])],
                                     names=["slot", "toxic", "clean"])


# ------------------------------------------------------------------ the field
class Field:
    """Emission weights per (kind, bin), a bias, and transitions [from, to]; state 1 is toxic."""

    def __init__(self, odds: np.ndarray):
        self.bins = np.digitize(odds, EDGES).astype(np.int8)       # [KINDS << TABLE_BITS]
        self.odds = odds
        self.weights = np.zeros(KINDS * BINS + 1)
        self.move = np.zeros((2, 2))

    def features(self, slots: np.ndarray) -> np.ndarray:
        """Feature numbers [KINDS, tokens]."""
        return np.stack([self.bins[slots[k] + (k << TABLE_BITS)] + k * BINS for k in range(KINDS)]).astype(np.int64)

    def emission(self, features: np.ndarray) -> np.ndarray:
        return self.weights[features].sum(axis=0) + self.weights[-1]


def forward_backward(emission: np.ndarray, sizes: np.ndarray, move: np.ndarray):
    """(marginal, forward, backward) for sequences laid end to end.  Forward and backward are
    log ratios of the toxic to the clean state; all sequences advance together, longest
    first, so that a step works on the sequences that are still running."""
    n = len(sizes)
    order = np.argsort(-sizes, kind="stable")
    long = sizes[order]
    first = (np.cumsum(sizes) - sizes)[order]
    steps = int(long[0]) if n else 0
    alive = np.searchsorted(-long, -np.arange(steps), side="left")   # sequences longer than t
    forward, backward = np.zeros(len(emission)), np.zeros(len(emission))
    (oo, ot), (to, tt) = move
    a = np.zeros(0)
    for t in range(steps):
        k = alive[t]
        at = first[:k] + t
        if t:
            a = np.logaddexp(ot, a[:k] + tt) - np.logaddexp(oo, a[:k] + to)
            a = a + emission[at]
        else:
            a = emission[at].copy()
        forward[at] = a
    b = np.zeros(n)
    for t in range(steps - 2, -1, -1):
        k = alive[t + 1]
        at = first[:k] + t
        x = emission[at + 1] + b[:k]
        b[:k] = np.logaddexp(to, tt + x) - np.logaddexp(oo, ot + x)
        backward[at] = b[:k]
    return 1.0 / (1.0 + np.exp(-np.clip(forward + backward, -60, 60))), forward, backward


def fit(field: Field, features: np.ndarray, label: np.ndarray, sizes: np.ndarray) -> Field:
    """Maximise the regularised log-likelihood by adaptive gradient steps (Adam)."""
    n = max(1, features.shape[1])
    inner = np.ones(len(label), dtype=bool)
    inner[(np.cumsum(sizes) - 1)[sizes > 0]] = False            # tokens with a successor
    now = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[now], label[now + 1]), 1)
    m = v = np.zeros(len(field.weights) + 4)
    theta = np.r_[field.weights, field.move.ravel()]
    for step in range(1, STEPS + 1):
        field.weights, field.move = theta[:-4], theta[-4:].reshape(2, 2)
        emission = field.emission(features)
        p, forward, backward = forward_backward(emission, sizes, field.move)
        miss = label - p
        grad = np.zeros(len(theta))
        for k in range(KINDS):
            grad[:-4] += np.bincount(features[k], weights=miss, minlength=len(theta) - 4)
        grad[-5] = miss.sum()
        x, f = emission[now + 1] + backward[now + 1], forward[now]
        logs = np.stack([np.full(len(now), field.move[0, 0]), field.move[0, 1] + x, field.move[1, 0] + f,
                         field.move[1, 1] + f + x])
        logs = np.exp(logs - logs.max(axis=0))
        grad[-4:] = seen.ravel() - (logs / logs.sum(axis=0)).sum(axis=1)
        grad = grad / n - PENALTY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    field.weights, field.move = theta[:-4], theta[-4:].reshape(2, 2)
    return field


# ------------------------------------------------------------------ Spark
def train(labelled: DataFrame) -> Field | None:
    """The field from rows (doc_id, text, toxic) that may be learned from."""
    spark = labelled.sparkSession
    ship_package(spark)
    rows = labelled.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), c("toxic").cast("int").alias("toxic"))
    rows = rows.where(c("toxic").isin(0, 1))
    docs = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(docs) < 2:
        return None
    got = (rows.select("text", "toxic").mapInArrow(_counting, "slot long, toxic long, clean long")
           .groupBy("slot").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
           .repartition(F.floor(c("slot") / PACKED)).mapInArrow(_packing, "part long, counts binary")
           .collect())             # KINDS * 2**TABLE_BITS / PACKED rows of packed counts
    counts = np.zeros((2, KINDS << TABLE_BITS))
    for r in got:
        counts[:, r["part"] * PACKED:(r["part"] + 1) * PACKED] += np.frombuffer(r["counts"], np.int64).reshape(2, -1)
    prior = docs[1] / (docs[0] + docs[1])
    weight = max(LEAST_PRIOR, PRIOR_SHARE * docs[1])
    rate = (counts[1] + weight * prior) / (counts.sum(axis=0) + weight)
    rate = np.clip(rate, 1e-6, 1 - 1e-6)
    field = Field(np.log(rate / (1 - rate)) - np.log(prior / (1 - prior)))

    # as many toxic documents as clean ones, so that the sample holds enough toxic tokens
    before = Window.partitionBy("toxic").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    pick = rows.withColumn("h", F.xxhash64("doc_id", F.lit(7)))
    part = [pick.where(c("toxic") == y).orderBy("h", "doc_id").limit(SAMPLE_DOCS) for y in (0, 1)]
    sample = (part[0].union(part[1])
              .withColumn("size", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)) + F.octet_length("text"))
              .where((c("size") <= SAMPLE_BYTES) | (c("size") == F.octet_length("text")))
              .select("text", "toxic").collect())
    features, label, sizes = [], [], []
    for r in sample:
        data = np.frombuffer(r["text"].encode(), np.uint8)
        _, _, _, slots = tokens(data, np.array([0, len(data)]))
        odds = np.maximum.reduce([field.odds[slots[k] + (k << TABLE_BITS)] for k in range(KINDS)])
        features.append(field.features(slots).astype(np.int8))
        label.append(((odds >= TOXIC_ODDS) & (r["toxic"] == 1)).astype(np.int8))
        sizes += [min(SEQUENCE, slots.shape[1] - at) for at in range(0, slots.shape[1], SEQUENCE)]
    return fit(field, np.concatenate(features, axis=1), np.concatenate(label), np.array(sizes, np.int64))


def _packing(batches):
    """(part, counts) rows: the toxic and clean counts of a range of slots as two arrays of longs."""
    held = {}
    for batch in batches:
        slot, toxic, clean = (batch.column(k).to_numpy() for k in range(3))
        for part in np.unique(slot // PACKED):
            mine = slot // PACKED == part
            counts = held.setdefault(int(part), np.zeros((2, PACKED), np.int64))
            np.add.at(counts, (1, slot[mine] % PACKED), toxic[mine])
            np.add.at(counts, (0, slot[mine] % PACKED), clean[mine])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(
            [x.tobytes() for x in held.values()], pa.binary())], names=["part", "counts"])


def _marking(shared, spans: bool):
    def run(batches):
        field = shared.value
        for batch in batches:
            data, offsets = tb.utf8(batch.column(1))
            for i, j in tb.blocks(offsets, 8 << 20):
                parts = []
                for k, m in tb.blocks(offsets[i:j + 1] - offsets[i]):     # tokens by the megabyte
                    lo, hi = offsets[i + k], offsets[i + m]
                    row, start, end, slots = tokens(data[lo:hi], offsets[i + k:i + m + 1] - lo)
                    local = start - (offsets[i + k + row] - lo)
                    parts.append((row + k, local, local + end - start, field.emission(field.features(slots))))
                row, start, end, emission = (np.concatenate(x) for x in zip(*parts))
                sizes = np.bincount(row, minlength=j - i)
                p, _, _ = forward_backward(emission, sizes, field.move)
                top = np.zeros(j - i)
                np.maximum.at(top, row, p)
                mass = np.bincount(row, weights=p, minlength=j - i)
                columns = [batch.column(0).slice(i, j - i), pa.array(top), pa.array(np.log1p(mass)),
                           pa.array(mass / np.maximum(sizes, 1))]
                names = ["doc_id", *SIGNALS]
                if spans:
                    marked = np.flatnonzero(p >= 0.5)
                    found = [[] for _ in range(j - i)]
                    for r, s, e in zip(row[marked].tolist(), start[marked].tolist(), end[marked].tolist()):
                        found[r].append({"start": s, "end": e})
                    columns.append(pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def mark(docs: DataFrame, field: Field, spans: bool = True) -> DataFrame:
    """doc_id, the document's signals, and the toxic spans as byte offsets of the UTF-8 text."""
    ship_package(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, top double, mass double, share double"
    schema += ", spans array<struct<start:long,end:long>>" if spans else ""
    return docs.select("doc_id", "text").mapInArrow(_marking(docs.sparkSession.sparkContext.broadcast(field), spans), schema)


def toxicity(docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0, spans: bool = True) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted and the toxic spans."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    learn = docs.where(~is_held_out("doc_id", parts, held_out)).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # copies would make the rare words of one toxic text look toxic: equal texts count once.  They are
    # told by hash, so that of the corpus only training texts move, if any
    known = written(known, "known")
    kept = written(learn.select("doc_id", F.sha2("text", 256).alias("sha")).join(checked(known), "doc_id")
                   .groupBy("sha", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "toxic"), "kept")
    labelled = written(learn.join(checked(kept), "doc_id").select("doc_id", "text", "toxic"), "labelled")
    field = train(labelled)
    if field is None:
        return docs.select("doc_id", is_held_out("doc_id", parts, held_out).alias("held_out"),
                           F.lit(0.0).alias("score"), F.lit(0).alias("predicted"),
                           F.array().cast("array<struct<start:long,end:long>>").alias("spans"))
    signals = written(mark(docs, field, spans), "signals")
    assembler = VectorAssembler(inputCols=SIGNALS, outputCol="features")
    rows = signals.where(~is_held_out("doc_id", parts, held_out)).join(
        known.select("doc_id", c("toxic").cast("double").alias("label")), "doc_id")
    model = LogisticRegression(maxIter=50, regParam=1e-4).fit(assembler.transform(rows).select("features", "label"))
    scored = model.transform(assembler.transform(signals)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", is_held_out("doc_id", parts, held_out).alias("held_out"), "score",
                         (c("score") >= 0.5).cast("int").alias("predicted"), *(["spans"] if spans else []))
