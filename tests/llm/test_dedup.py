"""Line dedup, exact dedup, n-gram Jaccard join, vector join against brute force."""

import random

import numpy as np
import pytest

from sensorlab.llm import exact_dedup, graph, jaccard_join, line_dedup, vector_join
from tests.llm import helpers as h


# ------------------------------------------------------------------ exact dedup
def brute_exact(docs):
    out, groups = set(), {}
    rows = docs.collect()
    for r in rows:
        groups.setdefault((r.text or "").translate(h.FOLD), []).append(r.doc_id)
    for text, ids in groups.items():
        for i in ids:
            out.add((i, max(ids), len(ids), i == max(ids), h.sha(text)))
    return out


@pytest.mark.parametrize("bits", [128, 8])   # 8 bits: chunks share hashes and must be told apart
@pytest.mark.parametrize("table", [h.documents, h.odd_documents, h.empty_documents])
def test_exact_dedup(spark, table, bits):
    docs = table(spark)
    got = exact_dedup.exact_dedup(docs, hash_bits=bits)
    assert h.rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(docs)


def test_chunks_survive_an_insertion():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 123, 60_000).astype(np.uint8)
    ends = exact_dedup.cut_points(data)
    assert ends[-1] == len(data) and (np.diff(np.r_[0, ends]) <= exact_dedup.MAX_CHUNK).all()
    other = np.r_[data[:1000], np.frombuffer(b"inserted", np.uint8), data[1000:]]
    assert len(set((exact_dedup.cut_points(other) - 8).tolist()) & set(ends.tolist())) > len(ends) // 2


# ------------------------------------------------------------------ n-gram Jaccard join
def brute_jaccard(docs, k=5, percent=75):
    rows = sorted(((r.doc_id, h.shingle_set(r.text, k)) for r in docs.collect()), key=lambda x: x[0])
    sets = [s for _, s in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    near = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    pairs = [(a, b) for a, b in near if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    label = h.classes(len(sets), pairs)
    return {(rows[i][0], len(sets[i]), rows[label[i]][0]) for i in range(len(sets))}


@pytest.mark.parametrize("block", [1024, 3])       # 3: signatures of many blocks
@pytest.mark.parametrize("table", [lambda s: h.documents(s, "/root/testdata/sf0.01"), h.odd_documents, h.empty_documents])
def test_jaccard_components(spark, table, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    docs = table(spark)
    got = jaccard_join.jaccard_components(docs)
    assert h.rows(got, "doc_id", "n_shingles", "component_id") == brute_jaccard(docs)


def test_jaccard_chains_passages_and_short_sets(spark):
    """Chains whose ends do not link, a passage in most texts, and tiny sets."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(40)]
    rows, i = [], 0
    for size in (3, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 60, 120, 300):
        text = [word() for _ in range(size)]
        for _ in range(14):
            rows.append((i, " ".join(text)))
            i += 1
            for _ in range(rng.randint(0, 2)):
                text = list(text)
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.4:
                text = text + [word()]
    for n in range(120):
        rows.append((i, " ".join(passage + [word() for _ in range(rng.randint(0, 25))])))
        i += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.jaccard_components(docs)
    assert h.rows(got, "doc_id", "n_shingles", "component_id") == brute_jaccard(docs)


def test_jaccard_signatures_meet_for_every_linked_pair():
    """Pigeonhole with documents that have too few elements (few segments by chance)."""
    rng = np.random.default_rng(1)
    for _ in range(400):
        n = int(rng.integers(1, 40))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        keep = a[rng.random(len(a)) > 0.1]
        b = np.unique(np.r_[keep, rng.integers(0, 1 << 62, int(rng.integers(0, 4))).astype(np.uint64)])
        if not len(b) or 100 * len(np.intersect1d(a, b)) < 75 * len(np.union1d(a, b)):
            continue
        doc, sig, _ = jaccard_join.signatures(np.array([len(a), len(b)]), np.r_[a, b], a[:5], 75)
        assert set(sig[doc == 0].tolist()) & set(sig[doc == 1].tolist())


def test_sketches_never_differ_more_than_their_sets():
    rng = np.random.default_rng(7)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 62, int(rng.integers(1, 3000))).astype(np.uint64))
        b = np.unique(np.r_[a[rng.random(len(a)) > 0.1], rng.integers(0, 1 << 62, int(rng.integers(0, 200))).astype(np.uint64)])
        n = np.array([len(a), len(b)])
        sketch = jaccard_join.sketches(n, np.repeat([0, 1], n), np.r_[a, b])
        linked = 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
        assert not linked or len(jaccard_join.plausible(sketch, n, 75)[0]) == 1


def test_one_deletion_neighbourhoods(monkeypatch):
    """With far too few segments every document signs with its neighbourhoods."""
    monkeypatch.setattr(jaccard_join, "segments", lambda band: np.full(len(band), 9))
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 62, 40).astype(np.uint64))
        b = np.unique(np.r_[a[4:], rng.integers(0, 1 << 62, 4).astype(np.uint64)])
        if 100 * len(np.intersect1d(a, b)) < 75 * len(np.union1d(a, b)):
            continue
        doc, sig, deleted = jaccard_join.signatures(np.array([len(a), len(b)]), np.r_[a, b], a[:0], 75)
        assert deleted.any() and set(sig[doc == 0].tolist()) & set(sig[doc == 1].tolist())


# ------------------------------------------------------------------ line dedup
def brute_lines(docs, tau=2, least=24):
    occurrences = sorted((r.doc_id, k, line_dedup.normal(x)) for r in docs.select("doc_id", "text").distinct().collect()
                         for k, x in enumerate((r.text or "").split("\n")) if line_dedup.normal(x))
    lines = sorted({x for _, _, x in occurrences})
    place = {x: i for i, x in enumerate(lines)}
    pairs = [(i, j) for i, a in enumerate(lines) for j in range(i) if (b := lines[j]) is not None
             and len(a) >= least and len(b) >= least and abs(len(a) - len(b)) <= tau
             and sum((memoryview(a.encode()) != memoryview(b.encode()),)) and h.edit_distance(a, b) <= tau]
    label = h.classes(len(lines), pairs)
    degree = [0] * len(lines)
    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
    seen, classes, out = set(), set(), {r.doc_id: [0, 0, 0, 0, 0, []] for r in docs.select("doc_id").collect()}
    for doc, k, x in occurrences:
        o, i = out[doc], place[x]
        o[0] += 1
        o[4] += degree[i]
        if x in seen:
            o[1] += 1
        elif label[i] in classes:
            o[2] += 1
        else:
            o[3] += 1
        if x in seen or label[i] in classes:
            o[5].append(k)
        seen.add(x)
        classes.add(label[i])
    return {(d, *o[:5], tuple(o[5])) for d, o in out.items()}


def line_rows(got):
    return {(r.doc_id, r.n_lines, r.n_exact, r.n_near, r.n_kept, r.n_links, tuple(r.dropped)) for r in got.collect()}


def lines_table(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(20, 60))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 5)):
            x = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                x[rng.randrange(len(x))] = rng.choice("xyz")
            if rng.random() < 0.3:
                x.insert(rng.randrange(len(x)), "q")
            lines.append("".join(x))
        rows.append((i, "\n".join(lines)))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("table", [lines_table, h.odd_documents, h.empty_documents])
@pytest.mark.parametrize("hot", [100_000, 2])      # 2: nearly every shared segment is refined
def test_line_dedup(spark, table, hot, monkeypatch):
    docs = table(spark)
    real = line_dedup.line_links
    monkeypatch.setattr(line_dedup, "line_links", lambda d, c, t: real(d, c, t, hot_pairs=hot))
    assert line_rows(line_dedup.line_dedup(docs)) == brute_lines(docs)


def test_dropped_lines_are_cut_out(spark):
    docs = lines_table(spark)
    flags = line_dedup.line_dedup(docs)
    cut = {r.doc_id: set(r.dropped) for r in flags.collect()}
    was = {r.doc_id: r.text.split("\n") for r in docs.collect()}
    for r in line_dedup.without_dropped(docs, flags).collect():
        assert r.text == "\n".join(x for k, x in enumerate(was[r.doc_id]) if k not in cut[r.doc_id])


def test_banded_edit_distance():
    rng = random.Random(2)
    for _ in range(5000):
        a = [rng.choice("abc") for _ in range(rng.randint(0, 9))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            if b and rng.random() < 0.5:
                b.pop(rng.randrange(len(b)))
            else:
                b.insert(rng.randint(0, len(b)), rng.choice("abc"))
        a, b = "".join(a), "".join(b)
        for tau in (1, 2, 3):
            assert line_dedup.within(a, b, tau) == (h.edit_distance(a, b) <= tau)


# ------------------------------------------------------------------ vector join
def brute_vectors(rows, threshold=0.95):
    good = [(i, np.array(v, float)) for i, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    pairs = [(a, b) for a in range(len(good)) for b in range(a) if len(good[a][1]) == len(good[b][1]) and
             good[a][1] @ good[b][1] / np.sqrt((good[a][1] @ good[a][1]) * (good[b][1] @ good[b][1])) >= threshold]
    order = sorted(range(len(good)), key=lambda x: good[x][0])
    at = {x: k for k, x in enumerate(order)}
    label = h.classes(len(good), [(at[a], at[b]) for a, b in pairs])
    links = [0] * len(good)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    out = {i: (i, 0, i, True) for i, _ in rows}
    for x, (i, _) in enumerate(good):
        comp = good[order[label[at[x]]]][0]
        out[i] = (i, links[x], comp, comp == i)
    return set(out.values())


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("block", [2048, 7])       # 7: many cells and blocks
def test_vector_join(spark, kind, block):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(120):
        v = rng.normal(size=8)
        rows.append((3 * i, v.tolist()))
        if i % 5 == 0:
            for k in range(4):
                rows.append((1000 + 10 * i + k, (2.0 ** k * (v + 0.12 * k * rng.normal(size=8))).tolist()))
        if i % 9 == 0:
            rows.append((5000 + i, v.tolist()))
    rows += [(9001, None), (9002, [0.0] * 8), (9003, [1.0, None] * 4), (9004, [float("nan")] * 8),
             (9005, [float("inf")] + [0.0] * 7), (9006, []), (9007, [1.0, 2.0]), (9008, [2.0, 4.0]), (9009, [-1.0, -2.0])]
    if kind == "float":
        rows = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 AS v", "2 AS cell")
    got = vector_join.vector_join(df, block=block)
    assert h.rows(got, "vec_id", "n_links", "component_id", "kept") == brute_vectors(rows)


def test_vector_join_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_join.vector_join(df).collect() == []


# ------------------------------------------------------------------ components
def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(60, 99)] + [(7, 7), (None, 3), (41, 5)]
    edges += [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    nodes = sorted({x for e in edges if None not in e and e[0] != e[1] for x in e})
    at = {x: k for k, x in enumerate(nodes)}
    label = h.classes(len(nodes), [(at[a], at[b]) for a, b in edges if a is not None and a != b])
    got = graph.components(spark.createDataFrame(edges, "x long, y long"), "x", "y")
    assert h.rows(got, "node", "component") == {(x, nodes[label[at[x]]]) for x in nodes}


def test_jaccard_group_whose_smallest_member_is_gone(spark, monkeypatch):
    """Near copies of one text: the smallest id shares only a passage, so all others are still apart
    when blocks are compared.  The edges that leave the blocks grow with the group, not with its square."""
    rng = random.Random(17)
    words = [f"w{i}" for i in range(120)]
    copies = []
    for i in range(150):
        w = list(words)
        w[rng.randrange(120)] = f"x{i}"
        copies.append((i + 1, " ".join(w)))
    docs = spark.createDataFrame([(0, " ".join(words[:60] + [f"y{i}" for i in range(90)])), *copies], "doc_id long, text string")
    sizes = []
    linked = jaccard_join._linked
    monkeypatch.setattr(jaccard_join, "_linked", lambda pairs, *a: (sizes.append(pairs.count()), linked(pairs, *a))[1])
    for block in (1024, 16):
        sizes.clear()
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        got = jaccard_join.jaccard_components(docs)
        assert h.rows(got, "doc_id", "n_shingles", "component_id") == brute_jaccard(docs)
        assert sum(sizes) < 150 * 150 / 4


def test_jaccard_failed_edges_are_compared_again(spark, monkeypatch):
    """Sketches that allow every pair: forests fail on the texts and the rest is still found."""
    rng = random.Random(23)
    docs = []
    for g in range(4):
        base = [f"g{g}w{i}" for i in range(40)]
        for i in range(12):
            w = list(base)
            w[rng.randrange(40)] = "z"
            docs.append((100 * i + g, " ".join(["shared"] * 3 + [f"s{j}" for j in range(12)] + w)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(jaccard_join, "max_difference", lambda a, b, percent: a + b)
    monkeypatch.setattr(jaccard_join, "FEW", 1)
    got = jaccard_join.jaccard_components(docs)
    assert h.rows(got, "doc_id", "n_shingles", "component_id") == brute_jaccard(docs)


def test_jaccard_blocks_grow_with_the_members_apart(spark, monkeypatch):
    """A group of linked copies and a few texts that share its passage only: the copies go to no block
    of their own, so the rows of the blocks do not grow with the square of the copies."""
    rng = random.Random(29)
    docs, passage = [], [f"p{i}" for i in range(60)]
    for i in range(240):
        w = passage + [f"w{j}" for j in range(60)]
        w[60 + rng.randrange(60)] = f"x{i}"
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, " ".join(passage + [f"y{i}z{j}" for j in range(14)])) for i in range(6)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    seen, apart = [], jaccard_join._apart

    def spied(rows, *a):
        out = apart(rows, *a)
        seen.append((rows.count(), out.count(), out.groupBy("sig", "i", "j").count().agg({"count": "max"}).first()[0] or 0))
        return out
    monkeypatch.setattr(jaccard_join, "_apart", spied)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    got = jaccard_join.jaccard_components(docs)
    assert h.rows(got, "doc_id", "n_shingles", "component_id") == brute_jaccard(docs)
    members, rows, largest = seen[0]
    assert 0 < rows < 2 * members and largest <= 4 * 16


def test_forests_join_what_all_pairs_join():
    rng = np.random.default_rng(6)
    for _ in range(30):
        k = int(rng.integers(2, 30))
        sketch = [rng.integers(0, 256, 16, dtype=np.uint8).tobytes() if rng.random() < 0.4 else bytes(16) for _ in range(k)]
        n, comp = np.full(k, 40), rng.integers(0, k, k)
        i, j = jaccard_join.plausible(sketch, n, 75, comp)
        want = h.classes(k, [*zip(i.tolist(), j.tolist()), *((a, int(np.flatnonzero(comp == comp[a])[0])) for a in range(k))])
        for count in (1, 2, 40):
            edges, kept_back = jaccard_join.forests(sketch, n, comp, 75, count)
            got = h.classes(k, [*edges, *((a, int(np.flatnonzero(comp == comp[a])[0])) for a in range(k))])
            assert got == want and len(edges) <= count * (k - 1) and set(edges) <= set(zip(i.tolist(), j.tolist()))
            assert kept_back == (len(edges) < len(i))


def test_vector_join_of_repeated_ids(spark):
    """Rows that share an id are vectors of their own: they link, and count, each for itself."""
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.01]), (2, [0.0, 1.0]), (3, [0.0, 1.0]), (3, [1.0, 0.02]), (4, [-1.0, 0.0]), (4, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in vector_join.vector_join(df).collect())
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 1, 2, True), (3, 1, 2, False), (3, 2, 1, False),
                   (4, 0, 4, True), (4, 0, 4, True)]
