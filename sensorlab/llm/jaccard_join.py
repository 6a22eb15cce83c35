"""Exact n-gram Jaccard join by universe partition (operator 8).

Two documents link when the Jaccard similarity of their sets of distinct k-word shingles
(words ``[^\\x20\\x09-\\x0D]+``, A-Z folded) reaches ``percent`` / 100.

Method.  Sizes fall into bands [2^j, 2^(j+1)).  For a band the universe of shingles is
hashed into m_j segments; a document's *elements* are its non-empty (segment, subset of
its shingles in it).  Sets of a and b shingles that link differ in at most H =
(a + b)(1 - t) / (1 + t) shingles, each of which spoils one segment, so by the pigeonhole
principle the first H + 1 elements of both, in any common order, share one.  The order is
the cost-based allocation: subsets with more rare shingles first, so segments that hold
only frequent shingles (a passage that many documents share) are used last.  A document
signs for its own band and, if a set of the band below can reach the threshold with it,
for that band too.  A document with no more than H elements (possible for tiny sets only)
also signs with every segment and its one-deletion neighbourhood under a separate name:
two such documents agree up to one deletion in some segment, as 2 m_j > H.

Verification is exact, on the texts.  Equal sets are one representative.  Members of a
signature are first compared with its smallest member only.  Members that are still in
different components after that are compared pairwise inside a task, in blocks of
``BLOCK`` members, by their parity sketches: bit b of a sketch is the parity of the shingles
hashed to b, so two sketches never differ in more bits than their sets differ in shingles.
The members of a signature's largest component need no comparison among themselves: they are
cut into blocks, and only the members outside it, usually few, travel to each of them.
Of the pairs whose sketches allow the threshold only forests over the components leave the
task, and the texts of those are compared.  If all of a block's edges hold, the pairs it kept
back join nothing new; where one fails, the members of pairs kept back, and no others, are
compared again without the failed pairs, with twice as many forests, until no block keeps a
pair of different components back.
So a group of copies costs edges in proportion to its members, and nothing is capped.

Nulls, empty texts: no shingles, no links, a component of their own.  Rows with a null id
are dropped; rows that repeat an id must repeat its text.  Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlab.llm import textbytes as tb
from sensorlab.llm.graph import components
from sensorlab.llm.storage import checked, written
from sensorlab.session import ship_package

c = F.col
U64 = np.uint64
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SHINGLE_WORDS = 5
PERCENT = 75
# A shingle is frequent when the blocks of texts that repeat it hold over this share of all
# documents; frequent shingles only change the order of elements, never the result.
FREQUENT_SHARE = 0.002
FREQUENT_IN_BLOCK = 3
LEAST_SKETCH = 1024      # bits of the smallest parity sketch; larger sets have 2 to 4 bits a shingle
FEW = 8                  # members up to which all pairs of a block are compared
BLOCK = 1024             # members of a signature in one block of pairwise comparisons


def segments(band: np.ndarray) -> np.ndarray:
    """Segments of a size band: more than H + 1 non-empty ones are expected."""
    top = 2.0 ** (band + 1)
    return np.where(top <= 64, 4 * top, np.ceil(0.42 * top) + 8).astype(np.int64)


def max_difference(a, b, percent: int):
    """Most shingles in which linked sets of a and b shingles can differ."""
    return (a + b) - 2 * (-(-(percent * (a + b)) // (100 + percent)))


def max_partner(a, percent: int):
    return (100 * a) // percent


# ------------------------------------------------------------------ parity sketches
def sketches(n: np.ndarray, row: np.ndarray, h: np.ndarray) -> list[bytes]:
    """Parity sketch of each document: a power of two of bits, at least twice its shingles."""
    bits = np.maximum(LEAST_SKETCH, 1 << (np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64) + 1))
    first = np.cumsum(bits) - bits
    at = first[row] + ((h >> U64(17)) & (bits[row] - 1).astype(U64)).astype(np.int64)
    odd = (np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8)
    packed = np.packbits(odd, bitorder="little").tobytes()
    return [packed[a // 8:(a + b) // 8] for a, b in zip(first.tolist(), bits.tolist())]


def _folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch with ``size`` bytes: halves fold onto each other by exclusive or."""
    x = np.frombuffer(sketch, "<u8")
    while 8 * len(x) > size:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def plausible(sketch: list[bytes], n: np.ndarray, percent: int, comp=None):
    """Pairs (i, j), i < j, whose sizes and sketches allow the threshold; with ``comp`` only pairs
    of different components."""
    size = min(map(len, sketch))
    x = np.stack([_folded(b, size) for b in sketch])
    first, second = [], []
    for i in range(len(n) - 1):
        low, high = np.minimum(n[i], n[i + 1:]), np.maximum(n[i], n[i + 1:])
        j = np.flatnonzero((100 * low >= percent * high) & (True if comp is None else comp[i + 1:] != comp[i])) + i + 1
        if len(j):
            differ = np.bitwise_count(x[j] ^ x[i]).sum(axis=1, dtype=np.int64)
            j = j[differ <= max_difference(n[i], n[j], percent)]
            first.append(np.full(len(j), i))
            second.append(j)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(first or none), np.concatenate(second or none)


def _star_filter(percent: int):
    def run(batches):
        for batch in batches:
            na, nb, sa, sb = (batch.column(k).to_pylist() for k in range(2, 6))
            keep = [len(plausible([x, y], np.array([p, q]), percent)[0]) for p, q, x, y in zip(na, nb, sa, sb)]
            keep = pa.array(keep, pa.int64()).cast(pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], names=["a", "b"])
    return run


def _few(doc, n, comp, sketch, percent):
    """All pairs of a handful of documents that sizes and sketches allow, without arrays."""
    for i in range(len(doc)):
        for j in range(i + 1, len(doc)):
            if comp[i] == comp[j] or 100 * min(n[i], n[j]) < percent * max(n[i], n[j]):
                continue
            x, y = sketch[i], sketch[j]
            if len(x) == len(y):
                differ = (int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_count()
            else:
                size = min(len(x), len(y))
                differ = int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())
            if differ <= max_difference(n[i], n[j], percent):
                yield i, j


def forests(sketch: list[bytes], n: np.ndarray, comp: np.ndarray, percent: int, count: int, failed=None,
            apart=None, back=None):
    """Edges (i, j) of ``count`` edge-disjoint forests over the components, of the pairs that sizes and
    sketches allow, and whether a pair was kept back.  ``failed[i]`` are members that i is known not to
    link with, ``apart[i]`` those that another block compares it with; ``back`` is set for the members
    of pairs kept back."""
    size = min(map(len, sketch))
    x = np.stack([_folded(b, size) for b in sketch])
    trees = [np.unique(comp, return_inverse=True)[1] for _ in range(count)]
    edges, kept_back = [], False
    for i in range(len(n) - 1):
        low, high = np.minimum(n[i], n[i + 1:]), np.maximum(n[i], n[i + 1:])
        j = np.flatnonzero((100 * low >= percent * high) & (comp[i + 1:] != comp[i])) + i + 1
        if apart is not None:
            j = j[~apart[i, j]]
        if failed and failed[i]:
            j = j[~np.isin(j, failed[i])]
        if not len(j):
            continue
        differ = np.bitwise_count(x[j] ^ x[i]).sum(axis=1, dtype=np.int64)
        j = j[differ <= max_difference(n[i], n[j], percent)]
        for tree in trees:
            if not len(j):
                break
            roots, first = np.unique(tree[j], return_index=True)
            first = first[roots != tree[i]]
            if len(first):
                edges += [(i, int(k)) for k in j[first]]
                tree[np.isin(tree, roots)] = tree[i]
                j = np.delete(j, first)
        kept_back |= len(j) > 0
        if back is not None and len(j):
            back[i] = back[j] = True
    return edges, kept_back


def _comparing(percent: int, count: int):
    """Of each (sig, i, j) run of sorted rows the forest edges (sig, a, b), and (sig, a, null) for the members
    of pairs kept back.  Pairs inside i or j are compared in one block only, that with i = 0."""
    names = ("doc_id", "n", "comp", "sketch", "failed", "mine")

    def edges(key, doc, n, comp, sketch, failed, mine):
        if comp.count(comp[0]) == len(comp):
            return []
        if len(doc) <= FEW:
            return [(key[0], *sorted((doc[i], doc[j]))) for i, j in _few(doc, n, comp, sketch, percent)]
        place = {d: k for k, d in enumerate(doc)}
        failed = [[place[d] for d in f or () if d in place] for f in failed]
        side, apart, back = np.array(mine), None, np.zeros(len(doc), bool)
        if key[1]:
            apart = side[:, None] == side
        got, _ = forests(sketch, np.array(n, dtype=np.int64), np.array(comp), percent, count, failed, apart, back)
        return ([(key[0], *sorted((doc[i], doc[j]))) for i, j in got]
                + [(key[0], doc[i], None) for i in np.flatnonzero(back)])

    def batch_of(found):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["sig", "a", "b"])

    def run(batches):
        last, held = None, ([],) * len(names)       # the run that may go on in the next batch
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in ("sig", "i", "j")])
            lists = [batch.column(k).to_pylist() for k in names]
            cut = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), keys.shape[1]]
            found = []
            for lo, hi in zip(cut, cut[1:]):
                if lo == hi:
                    continue
                key, part = keys[:, lo].tolist(), [x[lo:hi] for x in lists]
                if key == last:
                    held = tuple(x + y for x, y in zip(held, part))
                else:
                    if last is not None:
                        found.extend(edges(last, *held))
                    last, held = key, tuple(part)
            if found:
                yield batch_of(found)
        found = edges(last, *held) if last is not None else []
        if found:
            yield batch_of(found)
    return run


# ------------------------------------------------------------------ pass 1: sets
def _sets(k: int):
    def run(batches):
        for batch in batches:
            data, offsets = tb.utf8(batch.column(1))
            ids = batch.column(0)
            for i, j in tb.blocks(offsets):
                part, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                row, h = tb.shingles(part, off, k)
                n = np.bincount(row, minlength=j - i)
                one, two = np.zeros(j - i, U64), np.zeros(j - i, U64)
                if len(row):
                    begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                    one[row[begin]] = np.add.reduceat(tb.mix(h), begin)
                    two[row[begin]] = np.add.reduceat(tb.mix(h ^ U64(0x5851F42D4C957F2D)), begin)
                sketch = sketches(n, row, h)
                common, times = np.unique(h, return_counts=True)
                common, times = common[times >= FREQUENT_IN_BLOCK], times[times >= FREQUENT_IN_BLOCK]
                a, b = j - i, len(common)
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([ids.slice(i, a).cast(pa.int64()), pa.nulls(b, pa.int64())]),
                    pa.array(np.r_[n, times].astype(np.int64)),
                    pa.array(np.r_[one, common].view(np.int64)),
                    pa.array(np.r_[two, np.zeros(b, U64)].view(np.int64)),
                    pa.array([*sketch, *[None] * b], pa.binary())],
                    names=["doc_id", "n", "one", "two", "sketch"])
    return run


# ------------------------------------------------------------------ pass 2: signatures
def _elements(tok, seg, m, own, frequent, salt):
    """Elements of the virtual documents: (owner, hash, rare shingles, shingles)."""
    base = np.cumsum(m) - m
    place = base[own] + seg
    order = np.argsort(place, kind="stable")
    place, tok, own = place[order], tok[order], own[order]
    begin = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    total = np.add.reduceat(tb.mix(tok ^ U64(0x2545F4914F6CDD1D)), begin)
    size = np.diff(np.r_[begin, len(place)])
    rare = np.add.reduceat((~frequent[order]).astype(np.int64), begin)
    owner = own[begin]
    which = (place[begin] - base[owner]).astype(U64)
    name = tb.mix(total + tb.mix(which * U64(0xD6E8FEB86659FD93) + salt[owner]))
    return owner, name, rare, size, begin, order


def signatures(n, tok, frequent_tokens, percent):
    """(document, signature, by deletion) of documents with ``n`` shingles each, listed by
    document in ``tok``."""
    band = np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)
    band += (1 << (band + 1)) <= n
    band -= (1 << band) > n
    floor_below = (1 << band) - 1                       # largest size of the band below
    probes = (band > 0) & (max_partner(floor_below, percent) >= n)
    doc = np.r_[np.arange(len(n)), np.flatnonzero(probes)]
    in_band = np.r_[band, band[probes] - 1]
    size = n[doc]
    other = np.r_[max_partner(n, percent), floor_below[probes]]
    bound = max_difference(size, other, percent)
    # both parities of the pair's size have to be covered
    bound = np.maximum(bound, max_difference(size, np.maximum(other - 1, 0), percent))
    m = segments(in_band)
    first = np.cumsum(n) - n
    reach = np.repeat(first[doc] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    vdoc, vtok = np.repeat(np.arange(len(doc)), size), tok[reach]
    seg = ((tb.mix(vtok * U64(0x9FB21C651E98DF25)) >> U64(11)) % m[vdoc].astype(U64)).astype(np.int64)
    common = np.isin(vtok, frequent_tokens) if len(frequent_tokens) else np.zeros(len(vtok), bool)
    salt = tb.mix(in_band.astype(U64) + U64(77))
    owner, name, rare, count, begin, order = _elements(vtok, seg, m, vdoc, common, salt)
    by = np.lexsort((name, -count, -rare, owner))
    owner, name = owner[by], name[by]
    have = np.bincount(owner, minlength=len(doc))
    position = np.arange(len(owner)) - np.repeat(np.cumsum(have) - have, have)
    take = position <= bound[owner]
    out = [(doc[owner[take]], name[take], np.zeros(take.sum(), bool))]
    # documents with too few elements: every segment and its one-deletion neighbourhood
    for v in np.flatnonzero(have <= bound):
        mine = vdoc == v
        s, t = seg[mine], tb.mix(vtok[mine] ^ U64(0x2545F4914F6CDD1D))
        sums = np.zeros(m[v], U64)
        np.add.at(sums, s, t)
        where = np.r_[np.arange(m[v]), s]
        subset = np.r_[sums, sums[s] - t]
        names = tb.mix(subset + tb.mix(where.astype(U64) * U64(0xD6E8FEB86659FD93) + salt[v] + U64(1)))
        names = np.unique(names)
        out.append((np.full(len(names), doc[v]), names, np.ones(len(names), bool)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _signing(k: int, percent: int, frequent):
    def run(batches):
        hot = frequent.value
        for batch in batches:
            data, offsets = tb.utf8(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in tb.blocks(offsets, 1 << 18):
                row, h = tb.shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], k)
                n = np.bincount(row, minlength=j - i)
                has = np.flatnonzero(n)
                if not len(has):
                    continue
                doc, sig, _ = signatures(n[has], h, hot, percent)
                yield pa.RecordBatch.from_arrays([
                    pa.array(sig.view(np.int64)), pa.array(ids[i:j][has[doc]].astype(np.int64))],
                    names=["sig", "doc_id"])
    return run


# ------------------------------------------------------------------ verification
def shingle_set(text: str, k: int) -> set:
    w = WORD.findall(text.translate(FOLD))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return set(zip(*(w[j:] for j in range(k))))


def _verify(k: int, percent: int):
    def run(batches):
        last_id, last_set = None, None
        for batch in batches:
            a, b, ta, tx = (batch.column(x).to_pylist() for x in range(4))
            keep = []
            for i in range(len(a)):
                if a[i] != last_id:
                    last_id, last_set = a[i], shingle_set(ta[i], k)
                other = shingle_set(tx[i], k)
                both = len(last_set & other)
                keep.append(100 * both >= percent * (len(last_set) + len(other) - both))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()).filter(pa.array(keep, pa.bool_())) for x in (a, b)], names=["a", "b"])
    return run


def linked(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts link.  A pair moves its two texts once."""
    left = pairs.join(texts.select(c("doc_id").alias("a"), c("text").alias("ta")), "a")
    both = left.join(texts.select(c("doc_id").alias("b"), c("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(_verify(k, percent), "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       k: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, representative (smallest id with the same
    set; null without shingles), component_id (smallest id reachable by links)."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(c(id_col).cast("long").alias("doc_id"),
                        F.coalesce(c(text_col), F.lit("")).alias("text")).where(c("doc_id").isNotNull())
    first = written(texts.mapInArrow(tb.released(_sets(k)), "doc_id long, n long, one long, two long, sketch binary"), "sets")
    sets = first.where(c("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    total = first.where(c("doc_id").isNotNull()).count()
    # at most (shingles of all documents) / (share * documents): a bound on the average
    # length, not on the number of documents
    hot = [r[0] for r in first.where(c("doc_id").isNull()).groupBy("one").agg(F.sum("n").alias("n"))
           .where(c("n") >= max(FREQUENT_IN_BLOCK, FREQUENT_SHARE * total)).select("one").toLocalIterator()]
    frequent = spark.sparkContext.broadcast(np.sort(np.array(hot, dtype=np.int64).view(U64)))

    groups = (sets.where("n > 0").groupBy("n", "one", "two")
              .agg(F.min("doc_id").alias("representative"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1"))
    groups = written(groups, "groups")
    member = written(
        sets.alias("s").join(groups.alias("g"), [c(f"s.{x}") == c(f"g.{x}") for x in ("n", "one", "two")], "left")
        .select("s.doc_id", "s.n", "s.sketch", F.when(c("s.n") > 0, F.coalesce("g.representative", "s.doc_id"))
                .alias("representative")), "members")
    copies = written(member.where("n = 0 or representative <> doc_id").select("doc_id"), "copies")
    unique = texts.dropDuplicates(["doc_id"]) if _repeats(first, total) else texts
    signers = unique.join(checked(copies), "doc_id", "left_anti")
    signed = signers.mapInArrow(tb.released(_signing(k, percent, frequent)), "sig long, doc_id long")

    by_sig = Window.partitionBy("sig").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)
    # a signature of one document goes no further; its first member travels with the others
    shared = written(signed.withColumn("star", F.first("doc_id").over(by_sig)).where("star <> doc_id"), "shared")
    sketch = member.where("n > 0").select("doc_id", "n", "sketch")
    star = shared.select(c("star").alias("a"), c("doc_id").alias("b")).distinct()
    star = (star.join(sketch.toDF("a", "na", "sa"), "a").join(sketch.toDF("b", "nb", "sb"), "b")
            .select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_star_filter(percent), "a long, b long"))
    star = written(star, "star")
    links = written(_linked(star, unique, k, percent), "links")
    part = components(links, "a", "b")

    # what the first comparison left apart
    rows = written(shared.select("sig", "doc_id").union(shared.select("sig", "star").distinct()), "rows")
    failed, count = None, 1
    while True:
        edges = written(_apart(rows, part, sketch, failed).mapInArrow(
            tb.released(_comparing(percent, count)), "sig long, a long, b long"), "edges")
        rest = written(edges.where("b is not null").select("a", "b").distinct(), "rest")
        # pairs with the smallest member of a signature were compared before
        more = written(_linked(written(rest.join(star, ["a", "b"], "left_anti"), "fresh"), unique, k, percent), "links")
        links = links.union(more)
        part = components(links, "a", "b")
        lost = rest.join(more, ["a", "b"], "left_anti")
        failed = lost if failed is None else failed.union(lost)
        rows, count = written(edges.where("b is null").select("sig", c("a").alias("doc_id")).distinct(), "rows"), 2 * count
        if rows.limit(1).count() == 0:
            break
    comp = part.select(c("node").alias("_n"), "component")
    return (member.join(comp, c("representative") == c("_n"), "left")
            .select("doc_id", c("n").alias("n_shingles"), "representative",
                    F.coalesce("component", "representative", "doc_id").alias("component_id")))


def _apart(rows: DataFrame, part: DataFrame, sketch: DataFrame, failed: DataFrame) -> DataFrame:
    """Members of the signatures that still hold several components, sorted by pairs of groups, with
    the members that each is known not to link with.  A signature's largest component is cut into groups
    of about ``BLOCK`` members that come first, the other members into groups behind them; a pair of
    groups (i, j), i < j, is a block unless both are of the largest component."""
    comp = part.select(c("node").alias("_n"), "component")
    rows = written(rows.join(comp, c("doc_id") == c("_n"), "left")
                   .select("sig", "doc_id", F.coalesce("component", "doc_id").alias("comp")), "apart")
    split = (rows.groupBy("sig", "comp").agg(F.count(F.lit(1)).alias("k"))
             .groupBy("sig").agg(F.max(F.struct("k", "comp")).alias("top"), F.sum("k").alias("k"))
             .where(c("k") > c("top.k"))
             .select("sig", c("top.comp").alias("top"), F.ceil(c("top.k") / BLOCK).cast("long").alias("first"),
                     F.ceil((c("k") - c("top.k")) / BLOCK).cast("long").alias("others")))
    rows = rows.join(written(split, "split"), "sig").join(sketch, "doc_id")
    if failed is None:
        rows = rows.withColumn("failed", F.lit(None).cast("array<long>"))
    else:                                          # edges of earlier forests only
        known = failed.groupBy(c("a").alias("doc_id")).agg(F.collect_list("b").alias("failed"))
        rows = rows.join(known, "doc_id", "left")
    number = F.xxhash64("doc_id")
    in_top = c("comp") == c("top")
    last = c("first") + c("others") - 1
    rows = (rows.withColumn("mine", F.when(in_top, F.pmod(number, c("first"))).otherwise(c("first") + F.pmod(number, c("others"))))
            .withColumn("other", F.explode(F.array_remove(
                F.sequence(F.when(in_top, c("first")).otherwise(F.lit(0).cast("long")), last), c("mine"))))
            .select("sig", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                    "doc_id", "n", "comp", "sketch", "failed", "mine"))
    return rows.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j", "doc_id")


def _repeats(first: DataFrame, total: int) -> bool:
    return first.where(c("doc_id").isNotNull()).select("doc_id").distinct().count() < total


def _linked(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """``linked`` with the texts reduced to the documents of a pair first."""
    needed = written(pairs.select(c("a").alias("doc_id")).union(pairs.select("b")).distinct(), "needed")
    few = texts.join(checked(needed), "doc_id", "left_semi")
    return linked(pairs, written(few, "texts"), k, percent)
