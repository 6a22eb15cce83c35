"""Brute-force versions and odd tables for the tests of the llm operators."""

import hashlib
import random
import re

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, n int, a int"


def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, copies, clashing extra columns."""
    rng = random.Random(5)
    prose = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300))
    near = prose.split(" ")
    near[150] = "changed"
    rows = [
        (1, prose, "en", "s1"), (2, prose.upper().replace("É", "é"), "en", "s1"), (3, " ".join(near), "de", None),
        (4, None, None, None), (5, "", "en", "s2"), (6, " \n\t", "en", "s2"), (7, "one two three", "fr", "s2"),
        (8, "One TWO three", "fr", "s3"), (9, prose * 60, "en", "s1"), (10, "a" * 20_000, "en", "s4"),
        (11, "12 34 ... !!", "en", "s1"), (12, "Zeile eins ist hier lang genug\nZeile eins ist hier lang genuk\n\nx", "de", "s1"),
        (13, "emoji 😀 and <|endoftext|> here", None, "s1"), (14, "x", "en", "s1"),
    ]
    rows = [(*r, None if r[0] == 4 else len(r[1]), "clash", r[0], None) for r in rows]
    return spark.createDataFrame(rows, DOCS)


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def rows(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def shingle_set(text, k=5):
    w = WORD.findall((text or "").translate(FOLD))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return set(zip(*(w[j:] for j in range(k))))


def classes(n, pairs):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def edit_distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repeat(df):
    return df.union(df.where(F.col("doc_id") % 2 == 0))
