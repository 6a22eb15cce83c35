"""Near-duplicate lines by a segment-partition edit join (operator 1).

Lines are compared lower-cased with white space collapsed.  Lines of at least ``MIN_LENGTH``
characters link when their edit distance is at most ``TAU``; shorter lines only equal
theirs.  A line of length l is split into TAU + 1 even segments; a line within distance TAU
of it contains one of them unchanged, at a start that the multi-match-aware windows bound.
Every line files its segments under (length, number, hash) and probes, for the lengths l to
l - TAU, the substrings in those windows.  Where both sides meet, the pair is verified with a
banded bit-parallel edit distance on the texts.

Lines carry a 64-bit parity sketch of their pairs of neighbouring characters; an edit
changes at most two of them on either side, so lines within TAU edits differ in at most
4 * TAU bits, and only such pairs leave the join.  A segment that very many different lines
share is not joined pairwise: around an unchanged segment the rest of two lines is within
TAU again, so those lines are segmented once more without the shared part, and meet under
(segment, segment of the rest).

Linked lines form classes (connected components).  Of all lines of a class the first one,
by doc_id and line number, is kept.  Null and empty texts have no lines; blank lines are not
counted and always kept.  Rows with a null id are dropped; rows that repeat an id count as
one document and must repeat its text.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlab.llm import textbytes as tb
from sensorlab.llm.graph import components
from sensorlab.llm.storage import checked, written
from sensorlab.session import ship_package

c = F.col
U64 = np.uint64

TAU = 2
MIN_LENGTH = 24
HOT_PAIRS = 100_000      # file x probe entries of a segment beyond which it is refined
INDEX, PROBE = 1, 2


def normal(line: str) -> str:
    return " ".join(line.lower().split())


# ------------------------------------------------------------------ edit distance
def within(a: str, b: str, tau: int = TAU) -> bool:
    """Edit distance of a and b is at most tau: a bit-parallel automaton over the 2 tau + 1
    diagonals around the main one; bit w of a state stands for the prefix of ``a`` that is
    w - tau longer than the prefix of ``b`` read so far."""
    if abs(len(a) - len(b)) > tau:
        return False
    lo, top = 0, min(len(a), len(b))
    while lo < top and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < top - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo:len(a) - hi], b[lo:len(b) - hi]
    m, n = len(a), len(b)
    if not m or not n:
        return max(m, n) <= tau
    full = (1 << (2 * tau + 1)) - 1
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << (i + tau + 1)
    # prefix lengths 0 .. m that exist, shifted like ``places``
    exists = ((1 << (m + 1)) - 1) << tau
    state = [0] * (tau + 1)
    for e in range(tau + 1):
        state[e] = (exists & full) & ((1 << (tau + 1 + e)) - 1) & ~((1 << tau) - 1)
    for j, ch in enumerate(b, 1):
        valid = (exists >> j) & full
        same = (places.get(ch, 0) >> j) & valid
        old, below = state[0], 0
        state[0] = old & same
        below = state[0]
        before = old
        for e in range(1, tau + 1):
            old = state[e]
            state[e] = ((old & same) | before | (before >> 1) | (below << 1)) & valid
            before, below = old, state[e]
        if not state[tau]:
            return False
    return bool(state[tau] >> (m - n + tau) & 1) if abs(m - n) <= tau else False


# ------------------------------------------------------------------ segments
def _windows(tau: int):
    """(shorter by, segment, shift) of every substring to probe."""
    for delta in range(tau + 1):
        for i in range(tau + 1):
            low = max(-i, delta - (tau - i))
            high = min(i, delta + (tau - i))
            for shift in range(low, high + 1):
                yield delta, i, shift


def _segment(length: np.ndarray, i: int, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of segment i of lines of the given lengths; the last ones are longer."""
    parts = tau + 1
    short, longer = length // parts, length % parts
    extra = np.maximum(0, i - (parts - longer))
    start = i * short + extra
    return start, start + short + (i >= parts - longer)


def entries(lines: list[str], tau: int = TAU, least: int = MIN_LENGTH):
    """(line number, signature, side, start, end) of all lines: side has INDEX and PROBE bits."""
    text = "\n".join([*lines, ""])
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.array([len(x) for x in lines], dtype=np.int64)
    first = np.cumsum(length + 1) - (length + 1)
    values = tb.mix(points.astype(U64) + U64(0x1F123BB5))
    sums = np.zeros(len(points) + 1, U64)
    np.cumsum(values * tb._powers("up", len(points)), out=sums[1:])
    out = []
    for delta, i, shift in _windows(tau):
        filed = length - delta
        start, end = _segment(np.maximum(filed, 0), i, tau)
        a, b = start + shift, end + shift
        ok = np.flatnonzero((length >= least) & (filed >= least) & (a >= 0) & (b <= length) & (b > a))
        if not len(ok):
            continue
        h = tb.substring_hash(sums, first[ok] + a[ok], first[ok] + b[ok])
        sig = tb.mix(h + filed[ok].astype(U64) * U64(0xC2B2AE3D27D4EB4F) + U64(i * 2 + 1))
        side = PROBE | INDEX if delta == 0 and shift == 0 else PROBE
        out.append((ok, sig, np.full(len(ok), side, np.int8), a[ok], b[ok]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, U64, np.int8, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out))


def line_ids(lines: list[str]) -> np.ndarray:
    raw = [x.encode("utf-8", "surrogatepass") for x in lines]
    ends = np.cumsum([len(x) for x in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    start = np.r_[0, ends[:-1]].astype(np.int64) if len(raw) else ends
    return tb.substring_hash(tb.prefix_sums(data), start, ends).view(np.int64)


def _lines(texts: list[str]) -> tuple[list[int], list[int], list[str]]:
    """Row, line number and normalised line of the lines that are not blank."""
    rows, numbers, lines = [], [], []
    for r, text in enumerate(texts):
        for k, line in enumerate((text or "").split("\n")):
            line = normal(line)
            if line:
                rows.append(r)
                numbers.append(k)
                lines.append(line)
    return rows, numbers, lines


def _occurrences(batches):
    for batch in batches:
        _, offsets = tb.utf8(batch.column(1))
        for i, j in tb.blocks(offsets):
            rows, numbers, lines = _lines(batch.column(1).slice(i, j - i).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                 pa.array(line_ids(lines))], names=["doc_id", "line_no", "line"])


def _filing(tau: int):
    """(sig, line, side) rows, for each line of a task once in a while."""
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            _, offsets = tb.utf8(batch.column(1))
            for i, j in tb.blocks(offsets):
                _, _, lines = _lines(batch.column(1).slice(i, j - i).to_pylist())
                ids = line_ids(lines).tolist()
                fresh = []
                for k, x in enumerate(ids):
                    if x not in seen:
                        seen.add(x)
                        fresh.append(k)
                if len(seen) > 500_000:
                    seen.clear()      # a line that comes again is filed again; that is harmless
                at, sig, side, _, _ = entries([lines[k] for k in fresh], tau)
                own = np.array([ids[k] for k in fresh], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig.view(np.int64)), pa.array(own[at]), pa.array(side)], names=["sig", "line", "side"])
    return run


def _meeting(batches):
    """Of rows sorted by sig: those of signatures where two different lines meet."""
    keep = None       # rows of the last, unfinished signature

    def chosen(sig, line, side, done):
        begin = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        low, high = np.minimum.reduceat(line, begin), np.maximum.reduceat(line, begin)
        both = np.bitwise_or.reduceat(side, begin)
        good = (low != high) & (both == (INDEX | PROBE))
        size = np.diff(np.r_[begin, len(sig)])
        return np.repeat(good, size), begin

    def rows(sig, line, side):
        return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(line), pa.array(side)], names=["sig", "line", "side"])

    for batch in batches:
        sig, line, side = (batch.column(k).to_numpy() for k in range(3))
        if keep is not None:
            sig, line, side = (np.concatenate(x) for x in zip(keep, (sig, line, side)))
        if not len(sig):
            continue
        good, begin = chosen(sig, line, side, False)
        last = begin[-1]
        if good[:last].any():
            sel = np.flatnonzero(good[:last])
            yield rows(sig[sel], line[sel], side[sel])
        tail = np.unique(np.stack([line[last:], side[last:].astype(np.int64)], axis=1), axis=0)
        if len(tail) > 200_000 and good[-1]:
            # a very large signature: hand its rows on, keep one of each side
            yield rows(np.full(len(tail), sig[last]), tail[:, 0], tail[:, 1].astype(np.int8))
            tail = np.concatenate([tail[:1], tail[-1:], tail[tail[:, 1] == (INDEX | PROBE)][:2]])
        keep = (np.full(len(tail), sig[last]), tail[:, 0], tail[:, 1].astype(np.int8))
    if keep is not None and len(keep[0]):
        good, _ = chosen(*keep, True)
        if good.any():
            yield rows(*keep)


def sketches(lines: list[str]) -> np.ndarray:
    """Parity sketch of the character pairs of each line, its two ends included."""
    text = "\n" + "\n".join([*lines, ""])
    points = tb.mix(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64) + U64(0x3C6EF372))
    bits = U64(1) << (tb.mix(points[:-1] * U64(0x9E3779B97F4A7C15) + points[1:]) >> U64(58))
    length = np.array([len(x) + 1 for x in lines], dtype=np.int64)
    return np.bitwise_xor.reduceat(bits, np.cumsum(length) - length) if len(lines) else np.zeros(0, U64)


def _sketching(batches):
    for batch in batches:
        _, offsets = tb.utf8(batch.column(1))
        for i, j in tb.blocks(offsets):
            part = batch.slice(i, j - i)
            sketch = sketches(part.column(1).to_pylist()).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sketch)],
                                             names=["line", "content", "sketch"])


def _wanted_lines(batches):
    for batch in batches:
        _, offsets = tb.utf8(batch.column(0))
        for i, j in tb.blocks(offsets):
            _, _, lines = _lines(batch.column(0).slice(i, j - i).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(line_ids(lines)), pa.array(lines, pa.string())],
                                             names=["line", "content"])


def _refining(tau: int):
    """Second signatures of lines that share a hot one: those of the rest of the line."""
    def run(batches):
        for batch in batches:
            for sig, line, content in zip(*(batch.column(k).to_pylist() for k in range(3))):
                _, sigs, side, a, b = entries([content], tau)
                hit = np.flatnonzero(sigs.view(np.int64) == sig)
                rests = [content[:a[k]] + "\0" + content[b[k]:] for k in hit.tolist()]
                at, more, sides, _, _ = entries(rests, tau, least=tau + 1)
                # a rest files only if its segment was filed, and probes only if it probed
                sides = sides & side[hit][at]
                more = tb.mix(more ^ U64(sig & (2**64 - 1)))
                ok = sides > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(more[ok].view(np.int64)), pa.array(np.full(ok.sum(), line)), pa.array(sides[ok])],
                    names=["sig", "line", "side"])
    return run


def _verify(tau: int):
    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(k) for k in range(4))
            keep = pa.array([within(p, q, tau) for p, q in zip(x.to_pylist(), y.to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])
    return run


def _pairs(rows: DataFrame, content: DataFrame, tau: int) -> DataFrame:
    rows = rows.join(content.select("line", "sketch"), "line")
    x, y = rows.alias("x"), rows.alias("y")
    close = F.bit_count(c("x.sketch").bitwiseXOR(c("y.sketch"))) <= 4 * tau
    files = c("x.side").bitwiseAND(INDEX) > 0
    probes = c("y.side").bitwiseAND(PROBE) > 0
    return (x.join(y, (c("x.sig") == c("y.sig")) & (c("x.line") != c("y.line")) & files & probes & close)
            .select(F.least("x.line", "y.line").alias("a"), F.greatest("x.line", "y.line").alias("b")).distinct())


def line_links(docs: DataFrame, text_col: str = "text", tau: int = TAU, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(a, b): line identifiers of different lines within edit distance tau, each pair once."""
    ship_package(docs.sparkSession)
    texts = docs.select(c(text_col).alias("text")).where("text is not null")
    filed = texts.select(F.lit(0).alias("x"), "text").mapInArrow(_filing(tau), "sig long, line long, side byte")
    met = written(filed.repartition("sig").sortWithinPartitions("sig")
                  .mapInArrow(_meeting, "sig long, line long, side byte"), "met").dropDuplicates()
    met = written(met, "met")
    counts = met.groupBy("sig").agg(F.sum(F.when(c("side").bitwiseAND(INDEX) > 0, 1).otherwise(0)).alias("f"),
                                    F.count(F.lit(1)).alias("p"))
    hot = written(counts.where(c("f") * c("p") > hot_pairs).select("sig"), "hot")
    wanted = written(met.select("line").distinct(), "wanted")
    content = (texts.mapInArrow(_wanted_lines, "line long, content string")
               .join(checked(wanted), "line", "left_semi").dropDuplicates(["line"]))
    content = written(content.mapInArrow(_sketching, "line long, content string, sketch long"), "content")
    pairs = _pairs(met.join(hot, "sig", "left_anti"), content, tau)
    if hot.limit(1).count():
        again = (met.join(hot, "sig", "left_semi").join(content, "line").select("sig", "line", "content")
                 .dropDuplicates(["sig", "line"])
                 .mapInArrow(_refining(tau), "sig long, line long, side byte").dropDuplicates())
        pairs = pairs.union(_pairs(written(again, "again"), content, tau)).distinct()
    pairs = written(pairs, "pairs")
    both = (pairs.join(content.select(c("line").alias("a"), c("content").alias("x")), "a")
            .join(content.select(c("line").alias("b"), c("content").alias("y")), "b").select("a", "b", "x", "y"))
    return written(both.mapInArrow(_verify(tau), "a long, b long"), "links")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = TAU) -> DataFrame:
    """One row per document: doc_id, n_lines, n_exact (lines that equal an earlier line of the
    corpus), n_near (other lines whose class has an earlier line), n_kept, n_links (links of
    its lines to other different lines), dropped (numbers of its dropped lines)."""
    ship_package(docs.sparkSession)
    rows = docs.select(c(id_col).cast("long").alias("doc_id"), c(text_col).alias("text")).where("doc_id is not null")
    lines = written(rows.mapInArrow(_occurrences, "doc_id long, line_no int, line long"), "lines")
    links = line_links(docs, text_col, tau)
    part = components(links, "a", "b").select(c("node").alias("_line"), "component")
    degree = links.select(c("a").alias("l")).union(links.select("b")).groupBy("l").agg(F.count(F.lit(1)).alias("links"))
    linked = written(part.join(degree, c("_line") == c("l")).select("_line", "component", "links"), "classes")
    place = F.struct("doc_id", "line_no")
    per_line = written(lines.groupBy("line").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
                       .join(linked, c("line") == c("_line"), "left")
                       .where("n > 1 or component is not null")
                       .select("line", "first", F.coalesce("component", "line").alias("cls"),
                               F.coalesce("links", F.lit(0)).alias("links")), "repeated")
    of_class = per_line.groupBy(c("cls").alias("_cls")).agg(F.min("first").alias("leader"))
    table = written(per_line.join(of_class, c("cls") == c("_cls"))
                    .select(c("line").alias("_line"), "first", "leader", "links"), "leaders")
    # a hot line is one sort-merge join key; adaptive execution splits its occurrences
    flags = lines.distinct() if lines.count() != lines.select("doc_id", "line_no").distinct().count() else lines
    flags = flags.join(table, c("line") == c("_line"), "left")
    exact = c("first").isNotNull() & (c("first") != place)
    near = c("first").isNotNull() & (c("first") == place) & (c("leader") != place)
    per_doc = flags.groupBy(c("doc_id").alias("_doc")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(exact).alias("n_exact"), F.count_if(near).alias("n_near"),
        F.sum(F.coalesce("links", F.lit(0))).alias("n_links"),
        F.sort_array(F.collect_list(F.when(exact | near, c("line_no")))).alias("dropped"))
    zero = lambda name: F.coalesce(c(name), F.lit(0)).cast("long").alias(name)
    return (rows.select("doc_id").distinct().join(per_doc, c("doc_id") == c("_doc"), "left")
            .select("doc_id", zero("n_lines"), zero("n_exact"), zero("n_near"),
                    (F.coalesce(c("n_lines") - c("n_exact") - c("n_near"), F.lit(0))).cast("long").alias("n_kept"),
                    zero("n_links"), F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped")))


def without_dropped(docs: DataFrame, flags: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the dropped lines of ``flags`` (from ``line_dedup``) cut out of the text."""
    cut = flags.where(F.size("dropped") > 0).select(c("doc_id").alias("_doc"), "dropped")
    kept = F.array_join(F.filter(F.split(c(text_col), "\n"), lambda line, i: ~F.array_contains("dropped", i)), "\n")
    return (docs.join(cut, c(id_col) == c("_doc"), "left")
            .withColumn(text_col, F.when(c("dropped").isNull(), c(text_col)).otherwise(kept)).drop("_doc", "dropped"))
