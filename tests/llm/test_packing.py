"""Operator 11: pieces equal the library's, sequences are gapless and few, the parts equal brute force."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlab.llm import packing, queries
from tests.llm import helpers as h

NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.vocabulary_path())


def brute_pieces(rows, library, capacity):
    out = Counter()
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4")
            out[(doc, piece, at, len(part), zlib.crc32(part.tobytes()))] += 1
    return out


def check_sequences(got, capacity):
    seats = defaultdict(list)
    for r in got:
        seats[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in seats.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    return len(seats)


def test_whole_table(spark, library):
    got = queries.op11_packing(spark, h.SF)
    assert got.columns == NAMES
    got = got.collect()
    rows = [tuple(r) for r in h.documents(spark).select("doc_id", "text").collect()]
    assert Counter(tuple(r)[:5] for r in got) == brute_pieces(rows, library, 4096)
    used = check_sequences(got, 4096)
    least = -(-sum(r["length"] for r in got) // 4096)
    assert least <= used <= least * 1.02 + 1


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_odd_tables(spark, library, capacity):
    docs = h.odd_documents(spark)
    for name in ("length", "piece", "row", "rank", "bucket", "start"):
        docs = docs.withColumn(name, F.lit("x"))
    extra = docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit("a\x1cb\x85c <|endoftext|>x"))
    docs = docs.union(extra)
    for table in (docs, h.repeat(docs)):
        got = packing.pack(packing.pieces(table, queries.vocabulary_path(), capacity), capacity).collect()
        rows = [(r["doc_id"], r["text"]) for r in table.collect()]
        assert Counter(tuple(r)[:5] for r in got) == brute_pieces(rows, library, capacity)
        check_sequences(got, capacity)
    none = packing.pack(packing.pieces(h.empty_documents(spark), queries.vocabulary_path()))
    assert none.columns == NAMES and none.collect() == []


def test_ranks_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 10)
    table = spark.range(500).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 16 + 1).alias("length"), "id")
    got = packing.pack(table, 16).collect()
    assert sorted(r["id"] for r in got) == list(range(500))
    planned = packing.plan(Counter(r["length"] for r in got), 16).sequences
    assert check_sequences(got, 16) == planned <= sum(r["length"] for r in got) / 16 * 1.05


def least_sequences(items, capacity):
    """Exact least number of sequences by depth-first search."""
    items = sorted(items, reverse=True)
    best = len(items)

    def walk(i, spaces):
        nonlocal best
        if len(spaces) >= best:
            return
        if i == len(items):
            best = len(spaces)
            return
        for k in {s: k for k, s in enumerate(spaces) if s >= items[i]}.values():
            walk(i + 1, [*spaces[:k], spaces[k] - items[i], *spaces[k + 1:]])
        walk(i + 1, [*spaces, capacity - items[i]])

    walk(0, [])
    return best


def test_plan_is_close_to_the_least(spark):
    rng = random.Random(1)
    worse = 0
    for _ in range(150):
        items = [rng.randint(1, 20) for _ in range(rng.randint(1, 11))]
        out = packing.plan(Counter(items), 20)
        placed = [x for n, _, _, bins, _ in out.runs for x in [n] * bins]
        assert set(out.left.values()) == {0} and len(placed) <= len(items)
        worse += out.sequences - least_sequences(items, 20)
        assert out.sequences <= least_sequences(items, 20) + 1
    assert worse <= 6


def test_knapsack_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = np.sort(rng.choice(np.arange(1, 13), 4, replace=False))[::-1]
        price = rng.random(4)
        best, first = packing.knapsack(lengths, price, 24)
        every = [sum(p * k for p, k in zip(price, ks)) for ks in itertools.product(*[range(24 // n + 1) for n in lengths])
                 if sum(n * k for n, k in zip(lengths, ks)) <= 24]
        assert best[24] == pytest.approx(max(every))
        pattern = packing.filled(first, 24, {})
        assert sum(n * k for n, k in pattern.items()) <= 24
        assert sum(price[list(lengths).index(n)] * k for n, k in pattern.items()) == pytest.approx(best[24])


def test_linear_program_covers_nothing_twice_and_most_of_a_large_histogram():
    rng = np.random.default_rng(4)
    count = {int(n): int(k) for n, k in enumerate(rng.integers(1_000, 100_000, 300), start=20)}
    chosen = packing.fractional(count, 1024)
    used = Counter()
    for pattern, bins in chosen.items():
        assert sum(n * a for n, a in pattern) == 1024
        for n, a in pattern:
            used[n] += a * bins
    assert all(used[n] <= k * (1 + 1e-9) for n, k in count.items())
    least = sum(n * k for n, k in count.items()) / 1024
    assert sum(chosen.values()) > 0.5 * least
    assert packing.plan(count, 1024).sequences <= least * 1.001 + 1
