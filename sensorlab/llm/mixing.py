"""Mixing sources to target weights by a low-discrepancy schedule (operator 4, native).

A document's size is its number of words.  Sources take a repeating list of weights in
code-point order (null last) and share ``percent`` % of all words; a source's target stops
at ``epochs`` times its size and the excess is shared again by weight (water filling, one
pass over the sources ordered by cap / weight).

The schedule has ``slots`` slots per source on average.  Slot i is the van der Corput point
of i (its bits reversed), mapped through the cumulative targets to a source; the k-th slot
of a source takes the k-th block of equally many words from the source's documents, which
are put in the order of the md5 of their id and read again from the start when all are
taken.  The point set is balanced over every prefix, so any stretch of the mixed stream
is close to the target weights.

A block grows with the corpus, so a source with a target of fewer than ``FINE`` blocks would
be far from it.  Such a source has blocks of its own, about ``FINE`` of them, evenly spaced
over the slots; the last one is cut where the target ends.  ``oracle`` states the schedule of
the other sources only (and of all if a block is one word).

Only DataFrame functions run.  Running totals over a source (a third of all rows may be
one source) are taken in two levels: within hash ranges, whose number grows with the
document count, and over the totals of the ranges.

Null text has size 0; documents of size 0 are never taken.  A source without words has
target 0.  An empty table gives no rows.  Rows with a null id take part; rows that repeat
an id are separate documents.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlab.llm.storage import written

c = F.col

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
PERCENT = 150
EPOCHS = 2
SLOTS = 4096          # slots per source on average; a block is this share of a mean target
FINE = 1024           # blocks of a target below which a source has blocks of its own size
ROWS_PER_RANGE = 512   # documents or slots in one range of a running total


def word_count(text) -> F.Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT,
                   epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target, n): one row per source from (source, source_size, n).

    The table has one row per source; its windows run over those rows only."""
    by_name = Window.orderBy(c("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place + 1).cast("int"))
    t = sizes.withColumn("weight", weight).withColumn("cap", c("source_size") * epochs)
    by_ratio = Window.orderBy((c("cap") / c("weight")).asc(), c("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * percent / 100.0
    # the level per weight if the sources before this one are at their caps
    t = t.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                     / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    # the first source whose cap is not below its share fixes the level of all after it; the
    # level rises up to that source and falls after it
    reached = F.max(F.when(c("cap") >= c("level") * c("weight"), c("level"))).over(everything)
    return t.select("source", "source_size", "n",
                    F.least(c("cap").cast("double"), F.coalesce(reached * c("weight"), c("cap").cast("double"))).alias("target"))


def _van_der_corput(i, bits: int):
    """Bit-reversed i as a long of ``bits`` bits."""
    return F.conv(F.reverse(F.lpad(F.bin(i), bits, "0")), 2, 10).cast("long")


def _running(df: DataFrame, group: str, part: str, order: list, value, out: str) -> DataFrame:
    """Exclusive running total of ``value`` within ``group`` ordered by (part, order)."""
    inner = Window.partitionBy(group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(c(group).alias("_g"), c(part).alias("_p")).agg(F.sum(value).alias("_total"))
    outer = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_g", "_p", F.coalesce(F.sum("_total").over(outer), F.lit(0)).alias("_offset"))
    return (df.withColumn("_inner", F.coalesce(F.sum(value).over(inner), F.lit(0)))
            .join(offsets, (c(group) == c("_g")) & (c(part) == c("_p")))
            .withColumn(out, (c("_inner") + c("_offset")).cast("long")).drop("_inner", "_g", "_p", "_offset"))


def schedule(spark, sources: DataFrame, total: int, n_sources: int, n_slots: int) -> DataFrame:
    """(slot, source_no, k): the k-th slot of each source, k from 0.

    ``sources`` holds (source_no, low, high), the cumulative target range of each source.
    Points and ranges meet in ``n_sources`` equal cells of [0, total), so a point is
    compared with the few sources of its cell."""
    if total <= 0:
        return spark.createDataFrame([], "slot long, source_no int, k long")
    bits = max(1, (n_slots - 1).bit_length())
    cell = lambda x: F.least(F.floor(x * n_sources / float(total)), F.lit(n_sources - 1))
    slots = spark.range(n_slots).select(
        c("id").alias("slot"), (_van_der_corput(c("id"), bits) / float(1 << bits) * float(total)).alias("at"))
    spans = sources.where("high > low").withColumn("cell", F.explode(F.sequence(cell(c("low")), cell(c("high")))))
    placed = (slots.withColumn("cell", cell(c("at"))).join(spans, "cell")
              .where((c("at") >= c("low")) & (c("at") < c("high")))
              .select("slot", "source_no", F.floor(c("slot") / ROWS_PER_RANGE).alias("part")))
    return _running(placed, "source_no", "part", [c("slot")], F.lit(1), "k").select("slot", "source_no", "k")


def fine_schedule(sources: DataFrame, n_slots: int) -> DataFrame:
    """(slot, source_no, k) of the sources with own blocks of ``unit`` words: evenly spaced over
    the slots, each source from another start (multiples of the golden ratio)."""
    n = F.ceil(c("stop") / c("unit"))
    start = c("source_no") * 0.6180339887498949
    at = (c("k") + start - F.floor(start)) * n_slots / c("n")
    return (sources.where("stop > 0").withColumn("n", n)
            .withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), c("n") - 1)))
            .select(F.floor(at).cast("long").alias("slot"), "source_no", "k"))


def mixed_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS,
                 slots: int = SLOTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, pieces, sources).

    ``pieces`` (slot, source_no, start, doc_id, size, epoch, from_word, to_word) in slot
    order are the mixed stream: words [from_word, to_word) of the document.  (source_no,
    start) names a document of at least one word."""
    spark = docs.sparkSession
    sized = written(docs.select(c(id_col).alias("doc_id"), c(source_col).cast("string").alias("source"),
                                word_count(c(text_col)).alias("size")), "sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    by_name = Window.orderBy(c("source").asc_nulls_last())
    share = F.floor("target").cast("long")
    high = F.sum(share).over(by_name.rowsBetween(Window.unboundedPreceding, 0))
    sources = written(source_targets(per_source, weights, percent, epochs).select(
        (F.row_number().over(by_name) - 1).alias("source_no"), "source", "source_size", "n", "target",
        (high - share).alias("low"), high.alias("high")), "sources")
    total, n_sources, n = sources.agg(F.max("high"), F.count(F.lit(1)), F.sum("n")).first()
    total, n = int(total or 0), int(n or 0)
    block = max(1, total // (max(1, n_sources) * slots))
    n_slots = -(-total // block)
    # sources of few blocks: their own unit, and the word at which their target ends
    fine = (F.lit(block) > 1) & (c("high") - c("low") < FINE * block)
    unit = F.when(fine, F.greatest(F.lit(1), F.floor((c("high") - c("low")) / FINE))).otherwise(F.lit(block))
    sources = sources.withColumn("unit", unit.cast("long")).withColumn("stop", F.when(fine, c("high") - c("low")))
    coarse = schedule(spark, sources.where("stop is null").select("source_no", "low", "high"), total, n_sources, n_slots)
    plan = written(coarse.unionByName(fine_schedule(sources, n_slots)), "plan")

    # the shuffled stream of each source: documents in md5 order, as ranges of words
    digest = F.md5(F.coalesce(c("doc_id").cast("string"), F.lit("")).cast("binary"))
    ranges = max(1, -(-n // ROWS_PER_RANGE))
    part = F.floor(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * ranges / float(1 << 32))
    keys = sources.select(c("source").alias("_source"), "source_no", "source_size", "unit", "stop")
    keyed = (sized.join(keys, c("source").eqNullSafe(c("_source"))).drop("_source", "source")
             .withColumn("digest", digest).withColumn("part", part))
    placed = written(_running(keyed, "source_no", "part", [c("digest"), c("size")], c("size"), "start")
                     .select("doc_id", "size", "source_no", "source_size", "start", "unit", "stop"), "placed")

    # the same documents once per epoch, cut at the block borders of the repeated stream
    spans = placed.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    begin = (c("start") + c("epoch") * c("source_size")).cast("long")
    end = F.least(c("begin") + c("size"), F.coalesce("stop", c("begin") + c("size")))
    spans = spans.withColumn("begin", begin).withColumn("end", end).where("end > begin")
    cut = spans.withColumn("k", F.explode(F.sequence(F.floor(c("begin") / c("unit")), F.floor((c("end") - 1) / c("unit")))))
    pieces = cut.join(plan, ["source_no", "k"]).select(
        "slot", "source_no", "start", "doc_id", "size", "epoch",
        (F.greatest(c("begin"), c("k") * c("unit")) - c("begin")).alias("from_word"),
        (F.least(c("end"), (c("k") + 1) * c("unit")) - c("begin")).alias("to_word"))
    return placed, pieces, sources


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken (words the mix
    takes, repeats counted), first_slot (null if it is not taken) and source_no, start."""
    placed, pieces, sources = mixed_pieces(docs, **options)
    used = pieces.groupBy(c("source_no").alias("_no"), c("start").alias("_start")).agg(
        F.sum(c("to_word") - c("from_word")).alias("taken"), F.min("slot").alias("first_slot"))
    return (placed.drop("source_size", "unit", "stop")
            .join(used, (c("size") > 0) & (c("source_no") == c("_no")) & (c("start") == c("_start")), "left")
            .join(sources.select(c("source_no").alias("_s"), "source", "source_size", "target"),
                  c("source_no") == c("_s"))
            .select("doc_id", "size", "source", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", "source_no", "start"))


def oracle(documents: str = "documents") -> str:
    """DuckDB SQL for ``mix`` with the default parameters."""
    weights = ", ".join(map(str, WEIGHTS))
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM {documents}),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n FROM sized GROUP BY source),
named AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no FROM per),
weighed AS (SELECT *, [{weights}][CAST(source_no % {len(WEIGHTS)} AS INTEGER) + 1] AS weight,
                   source_size * {EPOCHS} AS cap FROM named),
levels AS (SELECT *, ((sum(source_size) OVER ()) * {PERCENT} / CAST(100.0 AS DOUBLE)
                      - coalesce(sum(cap) OVER w, 0))
                     / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER w, 0)) AS level
           FROM weighed WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT *, least(CAST(cap AS DOUBLE), coalesce((max(CASE WHEN cap >= level * weight THEN level END) OVER ())
                            * weight, CAST(cap AS DOUBLE))) AS target FROM levels),
src AS (SELECT *, CAST(floor(target) AS BIGINT) AS share,
               CAST(sum(CAST(floor(target) AS BIGINT)) OVER (ORDER BY source_no) AS BIGINT) AS high FROM targets),
dims AS (SELECT max(high) AS total, greatest(1, max(high) // (greatest(1, count(*)) * {SLOTS})) AS block FROM src),
slots AS (SELECT unnest(range(CAST((total + block - 1) // block AS BIGINT))) AS slot FROM dims),
bits AS (SELECT greatest(1, CASE WHEN count(*) <= 1 THEN 1 ELSE length(bin(count(*) - 1)) END) AS b FROM slots),
points AS (SELECT slot, (SELECT CAST(total AS DOUBLE) FROM dims) *
                  (list_sum([((slot >> j) & 1) * (CAST(1 AS BIGINT) << (b - 1 - j)) for j in range(b)])
                   / CAST(CAST(1 AS BIGINT) << b AS DOUBLE)) AS at
           FROM slots, bits),
plan AS (SELECT s.source_no, row_number() OVER (PARTITION BY s.source_no ORDER BY p.slot) - 1 AS k
         FROM points p JOIN src s ON p.at >= s.high - s.share AND p.at < s.high),
taken_blocks AS (SELECT source_no, count(*) AS blocks FROM plan GROUP BY source_no),
placed AS (SELECT d.doc_id, d.size, s.source_no, s.source_size, s.target,
                  coalesce(sum(d.size) OVER (PARTITION BY s.source_no ORDER BY d.digest, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
           FROM sized d JOIN src s ON d.source IS NOT DISTINCT FROM s.source)
SELECT p.doc_id, p.size, p.source_size, p.target,
       CAST(greatest(0, least(p.size, coalesce(t.blocks, 0) * dims.block - p.start))
          + greatest(0, least(p.size, coalesce(t.blocks, 0) * dims.block - p.start - p.source_size)) AS BIGINT) AS taken
FROM placed p CROSS JOIN dims LEFT JOIN taken_blocks t ON p.source_no = t.source_no"""
