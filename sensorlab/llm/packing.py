"""Best-fit packing by a configuration linear program (operator 11).

Documents become token pieces of at most ``CAPACITY`` tokens (only longer documents are cut), and
pieces are packed into as few sequences of that size as possible.

Method.  A configuration is a set of piece lengths that fits a sequence.  The linear program
asks for the least number of sequences, split over configurations, that covers the histogram of
lengths.  It is solved by multiplicative weights: a length's price is its size times
exp(-``RATE`` * the share of its pieces that is covered), so lengths that lag become dear.  A
dynamic program over the capacity (the knapsack of the prices) gives the dearest configuration
for each remaining space at once; each round takes, for every length, least covered first, the
dearest configuration that holds it, by a step of ``STEP`` of what is left of its scarcest length.
Nothing is covered twice, so rounding down is feasible; fractions are rounded up while their
pieces last, largest fraction first.  What is left is packed best-fit, longest first, into
the tightest gap, in bulk by length.

The driver sees the histogram only: at most ``CAPACITY`` numbers at any size of the corpus, so
the program costs a constant time.  Sequences are handed out as runs (length, ranks, sequences);
there are at most ROUNDS * CAPACITY configurations of at most 90 different lengths each and a
bounded number of best-fit runs, so their table is bounded too and is broadcast.  A piece finds its run by its
rank among the pieces of its length; ranks are counted in hash buckets of about
``BUCKET_ROWS`` rows, so a length that a third of all pieces share is spread over many tasks.

Token ids are those of the ``tokenizers`` library, which encodes each new stretch without white
space once per worker (words never reach over white space); words of Latin letters go to its
model directly.

Null and empty texts are the closing token alone.  Rows that repeat an id are packed each for
themselves.  Null ids are kept.  An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlab.llm import textbytes as tb
from sensorlab.llm.bpe import byte_symbols
from sensorlab.llm.storage import checked, written
from sensorlab.session import ship_package

c = F.col

CAPACITY = 4096
CLOSING = 1
ROUNDS = 64
STEP = 0.3
RATE = 2.0
BUCKET_ROWS = 5_000
CACHE = 600_000
LONG_STRETCH = 256
# Letters of ASCII and Latin-1 with closing punctuation: two words of the vocabulary's pattern, whatever
# the library's Unicode tables
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
# str.split() also parts at these four signs, which are no white space for the library
SEPARATORS = re.compile("[\x1c-\x1f]")
SPACE = re.compile(r"[^\S\x1c-\x1f]+")


# ------------------------------------------------------------------ pieces
class Encoder:
    """The library's ids of whole texts, with a bounded cache of stretches without white space."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.symbols = {i: s for i, s in enumerate(byte_symbols())}
        self.known: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        """Ids of lower-case Latin letters: normalised and parted already, so the library's model is asked."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.symbols)
        return np.array([t.id for t in self.library.model.tokenize(word)], "<u4").tobytes()

    def _learn(self, stretches: list[str], other: dict):
        """Ids of new stretches; those that are too long to keep go to ``other``."""
        known, rest = self.known, []
        for p in stretches:
            if len(p) > LONG_STRETCH or not (m := PLAIN.fullmatch(p)) or (m[2] and m[2] not in known):
                rest.append(p)
                if len(p) <= LONG_STRETCH and m and m[2]:
                    rest.append(m[2])
                continue
            word = m[1].lower()
            if (ids := known.get(word)) is None:
                ids = known[word] = self._word(word)
            known[p] = ids + known[m[2]] if m[2] else ids
        for i in range(0, len(rest), 4096):
            some = rest[i:i + 4096]
            for p, e in zip(some, self.library.encode_batch(some, add_special_tokens=False)):
                (known if len(p) <= LONG_STRETCH else other)[p] = np.array(e.ids, "<u4").tobytes()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        parts = [[p for p in SPACE.split(t) if p] if SEPARATORS.search(t) else t.split() for t in texts]
        known, long = self.known, {}
        new = {p for ps in parts for p in ps if p not in known}
        if len(known) + 2 * len(new) > CACHE:
            known.clear()
            new = {p for ps in parts for p in ps}
        self._learn(list(new), long)
        if long:
            return [b"".join([known[p] if p in known else long[p] for p in ps]) for ps in parts]
        return [b"".join(map(known.__getitem__, ps)) for ps in parts]


_LOADED: dict[int, Encoder] = {}


def _encoder(spec) -> Encoder:
    key = hash(spec.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(spec.value)
    return _LOADED[key]


def _cutting(spec, capacity: int, with_ids: bool):
    close = np.array([CLOSING], "<u4").tobytes()

    def run(batches):
        encoder = _encoder(spec)
        for batch in batches:
            texts = batch.column(1)
            _, offsets = tb.utf8(texts)
            for i, j in tb.blocks(offsets):
                rows = []
                for k, ids in enumerate(encoder.ids([t or "" for t in texts.slice(i, j - i).to_pylist()])):
                    ids += close
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        rows.append((i + k, piece, at // 4, len(part) // 4, zlib.crc32(part), part))
                row, piece, start, length, crc, part = zip(*rows)
                columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(part, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, the ids of each piece."""
    ship_package(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as f:          # a fixed file of about 2 MB
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return (docs.select(c(id_col).alias("doc_id"), c(text_col).alias("_text"))
            .mapInArrow(_cutting(spec, capacity, with_ids), schema))


# ------------------------------------------------------------------ linear program
def knapsack(lengths: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Greatest price of each space 0..capacity, and the length taken first in it (0: leave one
    token empty).  ``lengths`` descend, so the longest of equally dear choices is taken."""
    best = np.zeros(capacity + 1)
    first = np.zeros(capacity + 1, np.int64)
    begin = np.searchsorted(-lengths, -np.arange(capacity + 1))      # lengths[begin[s]:] fit space s
    for space in range(1, capacity + 1):
        best[space] = best[space - 1]
        fit = begin[space]
        if fit < len(lengths):
            value = best[space - lengths[fit:]] + price[fit:]
            k = int(value.argmax())
            if value[k] > best[space]:
                best[space], first[space] = value[k], lengths[fit + k]
    return best, first


def filled(first: np.ndarray, space: int, pattern: dict[int, int]) -> dict[int, int]:
    """Add the dearest filling of ``space`` to a pattern (length -> copies)."""
    while space > 0:
        length = int(first[space])
        if length:
            pattern[length] = pattern.get(length, 0) + 1
        space -= length or 1
    return pattern


def fractional(count: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> dict[tuple, float]:
    """Sequences of each configuration ((length, copies), ...), by multiplicative weights."""
    lengths = np.array(sorted(count, reverse=True), np.int64)
    total = np.array([count[int(x)] for x in lengths], float)
    place = {int(x): i for i, x in enumerate(lengths)}
    left = total.copy()
    chosen: dict[tuple, float] = {}
    for _ in range(rounds):
        open_ = np.flatnonzero(left > 1e-3 * total)
        if not len(open_):
            break
        covered = 1 - left[open_] / total[open_]
        price = lengths[open_] / capacity * np.exp(-RATE * covered)
        _, first = knapsack(lengths[open_], price, capacity)
        for i in open_[np.argsort(covered, kind="stable")].tolist():
            length = int(lengths[i])
            pattern = filled(first, capacity - length, {length: 1})
            at = [place[x] for x in pattern]
            # a configuration that leaves space, needs more copies than there are pieces or a length that is
            # used up waits for other prices: small pieces fill gaps better at the end
            if sum(x * a for x, a in pattern.items()) < capacity or any(
                    a > total[k] or left[k] <= 1e-3 * total[k] for k, a in zip(at, pattern.values())):
                continue
            step = STEP * min(left[k] / a for k, a in zip(at, pattern.values()))
            for k, a in zip(at, pattern.values()):
                left[k] -= a * step
            key = tuple(sorted(pattern.items(), reverse=True))
            chosen[key] = chosen.get(key, 0.0) + step
    return chosen


class Plan:
    """Runs of sequences: the i-th piece of a run lies in sequence start + i % bins, at
    offset + (i // bins) * length."""

    def __init__(self, count: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, dict(count)
        self.used = dict.fromkeys(count, 0)
        self.sequences = 0
        self.gaps: dict[int, list[tuple[int, int]]] = {}     # space -> runs of sequences (start, bins)
        self.open = np.zeros(capacity + 1, bool)
        self.runs: list[tuple[int, int, int, int, int]] = []

    def place(self, length: int, start: int, bins: int, offset: int, copies: int = 1):
        self.runs.append((length, self.used[length], start, bins, offset))
        self.used[length] += copies * bins
        self.left[length] -= copies * bins

    def add_gap(self, space: int, start: int, bins: int):
        if space:
            self.gaps.setdefault(space, []).append((start, bins))
            self.open[space] = True

    def configuration(self, pattern, bins: int):
        start, offset = self.sequences, 0
        self.sequences += bins
        for length, copies in pattern:
            self.place(length, start, bins, offset, copies)
            offset += length * copies
        self.add_gap(self.capacity - offset, start, bins)

    def best_fit(self, length: int):
        while self.left[length]:
            fits = self.open[length:].argmax()
            if not self.open[length + fits]:
                copies = self.capacity // length
                bins = max(1, self.left[length] // copies)
                self.configuration([(length, min(copies, self.left[length]))], bins)
                continue
            space = int(length + fits)
            start, bins = self.gaps[space].pop()
            self.open[space] = bool(self.gaps[space])
            take = min(bins, self.left[length])
            if take < bins:
                self.add_gap(space, start + take, bins - take)
            self.place(length, start, take, self.capacity - space)
            self.add_gap(space - length, start, take)


def plan(count: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Sequences for a histogram of lengths: the linear program, rounded, then best fit."""
    out = Plan(count, capacity)
    chosen = fractional(count, capacity)
    for pattern, bins in chosen.items():
        if bins >= 1:
            out.configuration(pattern, int(bins))
    rest = sorted(chosen.items(), key=lambda x: (-(x[1] % 1), x[0]))       # fractions up while their pieces last
    for pattern, bins in rest:
        if bins % 1 and all(out.left[n] >= a for n, a in pattern):
            out.configuration(pattern, 1)
    for length in sorted(count, reverse=True):
        out.best_fit(length)
    return out


# ------------------------------------------------------------------ Spark
def _ranked(table: DataFrame) -> DataFrame:
    """``table`` (with a unique ``row``) and ``rank``: its place, from 0, among the rows of its length."""
    most = table.groupBy("length").count().agg(F.max("count")).first()[0] or 0
    buckets = 1 + most // BUCKET_ROWS
    table = table.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    size = table.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begin = written(size.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin")), "ranks")
    place = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1
    return table.withColumn("place", place).join(checked(begin), ["length", "bucket"]).withColumn(
        "rank", c("begin") + c("place")).drop("place", "begin", "bucket")


def _seating(shared):
    def run(batches):
        length_, first_, start_, bins_, offset_ = shared.value
        begin = np.searchsorted(length_, np.arange(length_[-1] + 2))
        for batch in batches:
            length, rank = (batch.column(x).to_numpy() for x in ("length", "rank"))
            at = np.empty(len(length), np.int64)
            for x in np.unique(length):
                mine = length == x
                lo, hi = begin[x], begin[x + 1]
                at[mine] = lo + np.searchsorted(first_[lo:hi], rank[mine], side="right") - 1
            i = rank - first_[at]
            columns = [batch.column(x) for x in range(batch.num_columns - 1)]
            columns += [pa.array(start_[at] + i % bins_[at]), pa.array(offset_[at] + i // bins_[at] * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "sequence_id", "offset"])
    return run


def pack(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``table`` (with a ``length`` of 1 to ``capacity``) with sequence_id and offset; no
    other column may be called row, rank, place, begin or bucket."""
    spark = table.sparkSession
    ship_package(spark)
    table = written(table.withColumn("row", F.monotonically_increasing_id()), "pieces")
    count = {r["length"]: r["count"] for r in table.groupBy("length").count().collect()}    # at most ``capacity`` rows
    names = [x for x in table.columns if x != "row"]
    schema = ", ".join(f"`{x}` {table.schema[x].dataType.simpleString()}" for x in names)
    if not count:
        return table.select(*names, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    runs = np.array(sorted(plan(count, capacity).runs), np.int64).T
    shared = spark.sparkContext.broadcast([np.ascontiguousarray(x) for x in runs])
    return _ranked(table).select(*names, "rank").mapInArrow(
        _seating(shared), f"{schema}, sequence_id long, offset long")
