"""Operator 13 against brute force over odd tables and a vocabulary of planted variants."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sensorlab.llm import spelling
from tests.llm import helpers as h

NAMES = ["word", "form", "root", "n", "n_near", "form_n"]


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(h.FOLD)
            x = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if x % 199 == 0:
                run = run[:x % len(run)] + run[x % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and h.edit_distance(w, v) == 1] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def variants(spark):
    """Words of a small alphabet whose counts differ by powers of five, in several documents."""
    rng = random.Random(3)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 8))) for _ in range(60)] + ["Straße", "straÞe"]
    base += [base[0] + "x", base[0][1:] + "zz", base[1][:3] + "÷" + base[1][3:]]
    rows = []
    for doc in range(40):
        words = [w for w in base for _ in range(rng.choice([0, 0, 1, 1, 5, 30]) if rng.random() < 0.4 else 0)]
        rng.shuffle(words)
        rows.append((doc if doc else None, rng.choice([" ", ", ", "\n"]).join(words)))
    rows += [(90, "queueing " * 300 + "queuing " * 50 + "quuing " * 6 + "quuing? quueing " * 2)]   # a chain of forms
    rows += [(77, None), (78, ""), (79, "12 ..."), (80, "A" * 3000 + " " + "b" * 3000), (80, base[2].upper())]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("symbols", [1, 2, 8])
def test_equals_brute_force(spark, symbols):
    docs = variants(spark)
    got = h.rows(spelling.spelling_variants(docs, symbols=symbols), *NAMES)
    want = brute([tuple(r) for r in docs.collect()])
    assert got == want and any(r[1] for r in want) and any(r[2] not in (r[0], r[1]) for r in want)


def test_odd_tables(spark):
    docs = h.odd_documents(spark)
    for name in ("word", "n", "run", "id", "reduced", "code"):
        docs = docs.withColumn(name, F.lit(1))
    for table in (docs, h.repeat(docs), docs.union(docs).union(docs)):
        got = h.rows(spelling.spelling_variants(table), *NAMES)
        assert got == brute([(r["doc_id"], r["text"]) for r in table.collect()])
    assert spelling.spelling_variants(h.empty_documents(spark)).collect() == []


def test_one_edit_of_a_word_is_in_the_neighbourhood_of_its_reduced_word(spark):
    rng = random.Random(9)
    table = str.maketrans(spelling.LETTERS, spelling.reduced_alphabet())
    rows = []
    for _ in range(200):
        w = "".join(rng.choice(spelling.LETTERS) for _ in range(rng.randint(1, 12)))
        i, x = rng.randrange(len(w)), rng.choice(spelling.LETTERS)
        for v in (w[:i] + w[i + 1:], w[:i] + x + w[i + 1:], w[:i] + x + w[i:], w + x):
            rows.append((w.translate(table), v.translate(table)))
    df = spark.createDataFrame(rows, "reduced string, other string")
    missed = df.where(~F.array_contains(F.expr(spelling.neighbourhood("reduced")), F.col("other")))
    assert missed.count() == 0


def test_no_side_of_a_join_is_broadcast(spark, monkeypatch):
    """A small file may stand for neighbourhoods and words that do not fit the driver."""
    plans, write = [], spelling.written

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(spelling, "written", seen)
    words = write(spark.createDataFrame([("queueing", 9), ("queuing", 60), ("letters", 7)], "word string, n long"), "few")
    plans.append(spelling.near_words(words)._jdf.queryExecution().executedPlan().toString())
    plans.append(spelling.spelling_variants(variants(spark))._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 4 and not any("Broadcast" in p for p in plans)
