"""Conversation structure repair by iterative-deepening A* (operator 12).

A conversation is its rows by turn (nulls first; rows of one turn by role and then by the
SHA-256 of the text, an order of our own where the turn does not tell).  Each row has at most one
fault: blank, duplicate of an earlier (role, text) of the conversation, or truncated.  The
edits Keep (0), Rerole (1), Delete (2, the only one for blank or duplicate rows) and Insert (5) have to lead
to the role initials ``(s?(ua)+)?``; a truncated row that is not deleted costs 5 more.

Method.  Rows become one symbol each (role class and fault).  The search is a depth-first walk
in the ASCII order of the edit initials (D, I, K, R) under an increasing bound.  The
transposition table holds, for each (row, state) that failed, the least cost beyond which it may
succeed; it prunes the walk and gives the next bound.  The first path accepted at a bound is
the ASCII-least of the cheapest ones, as every edit from a state leads to one state only.

Long conversations.  The symbols are sorted by range partitioning on (conversation, turn), so a
conversation that holds much of the table is spread over many tasks.  Each task cuts
conversations into blocks of ``BLOCK`` rows and searches each block; a block that may not be the
whole conversation is searched from every state to every state, with one table for each end state.
A conversation's blocks (1 / ``BLOCK`` of its rows) are then combined from the last to the first.
Texts move once, to be rewritten; that stage streams sorted rows and holds only the
audit of one conversation (a value of the result).  The digest of a conversation's whole
text is sequential by its definition, so one task reads the rows of one conversation.

Nulls in role or text count as one space; null ids are one conversation; null turns come first and do not
count for gaps.  A role is told by its first character; an empty role fits nowhere.  Repeated rows are
duplicates.  An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlab.llm.storage import written
from sensorlab.session import ship_package

c = F.col

SPACE = " \t\n\x0b\x0c\r"
BLOCK = 64
KNOWN = 100_000                     # searched conversations that a worker remembers
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
CLASSES = "sua"                     # the fourth class is any other initial
NONE, BLANK, DUPLICATE, CUT_OFF = range(4)
SYMBOLS = "0123456789abcdef"        # class * 4 + fault
# States: nothing yet, after s, after u, after a; what may follow each.
FOLLOW = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
WANTED = ("user", "user", "assistant", "user")
ACCEPTING = (0, 3)
ANY_END = 4                         # the end of a conversation: any accepting state


# ------------------------------------------------------------------ search
class Search:
    """Cheapest audits of one run of symbols; one transposition table per end."""

    def __init__(self, code: str):
        self.rows = [divmod(int(x, 16), 4) for x in code]
        need = [0]
        for kind, fault in reversed(self.rows):
            need.append(need[-1] + (DELETE if fault else int(kind == 3)))
        self.need = need[::-1]
        self.failed: dict[int, dict] = {}

    def edits(self, i: int, state: int):
        """(initial, next row, next state, cost) in ASCII order."""
        follow = FOLLOW[state]
        new = 3 if state == 2 else 2
        if i == len(self.rows):
            return (("I", i, new, INSERT),)
        kind, fault = self.rows[i]
        out = [("D", i + 1, state, DELETE), ("I", i, new, INSERT)]
        if fault in (NONE, CUT_OFF):
            more = TRUNCATED if fault else 0
            if kind in follow:
                out.append(("K", i + 1, follow[kind], more))
            out.append(("R", i + 1, new, REROLE + more))
        return out

    def reachable(self, state: int, end: int) -> bool:
        if end == ANY_END or end > 1:
            return True
        if end == 0 or state > 0:
            return state == end
        return any(kind == 0 and fault in (NONE, CUT_OFF) for kind, fault in self.rows)

    def cheapest(self, state: int, end: int) -> tuple[int, str] | None:
        if not self.reachable(state, end):
            return None
        failed, need, n = self.failed.setdefault(end, {}), self.need, len(self.rows)
        ends = ACCEPTING if end == ANY_END else (end,)
        audit: list[str] = []

        def walk(i, state, left):
            """0 if a path of cost ``left`` at most is found, else a cost that every path has."""
            low = failed.get((i, state), need[i])
            if low > left:
                return low
            if i == n and state in ends:
                return 0
            least = 1 << 60
            for initial, j, then, cost in self.edits(i, state):
                if cost <= left:
                    rest = walk(j, then, left - cost)
                    if rest <= left - cost:
                        audit.append(initial)
                        return 0
                else:
                    rest = failed.get((j, then), need[j])
                least = min(least, cost + rest)
            failed[i, state] = least
            return least

        bound = need[0]
        while (low := walk(0, state, bound)) > bound:
            bound = low
        return bound, "".join(reversed(audit))


def joined_less(a, b) -> bool:
    """Whether chain ``a`` of (text, next) is less than chain ``b``; the texts are compared as if joined."""
    x, y = "", ""
    while True:
        while not x and a is not None:
            x, a = a
        while not y and b is not None:
            y, b = b
        k = min(len(x), len(y))
        if not k:
            return not x and bool(y)
        if x[:k] != y[:k]:
            return x[:k] < y[:k]
        x, y = x[k:], y[k:]


def _better(new, old) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and joined_less(new[1], old[1]))


# ------------------------------------------------------------------ rows
def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies (0: dropped, 2: repeated) of the contract's damage."""
    key = F.concat(*[F.coalesce(c(x).cast("string"), F.lit(" ")) if x != ":" else F.lit(":") for x in ("conv_id", ":", "turn")])
    hit = F.crc32(key) % 20
    text = F.coalesce(c("text"), F.lit(" "))
    return conversations.select(
        "conv_id", "turn", F.when(hit == 4, F.lit("user")).otherwise(F.coalesce(c("role"), F.lit(" "))).alias("role"),
        F.when(hit == 1, F.lit("")).when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"))


def plain(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` as they are, for :func:`repair`."""
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


def _digested(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _symbols(rows: DataFrame) -> DataFrame:
    """One narrow row per distinct (conversation, turn, role, text): its copies, role class and
    faults.  Dropped rows stay with 0 copies, so that every conversation is there."""
    end = F.rtrim(c("text"), F.lit(SPACE))
    first = F.substring("role", 1, 1)
    kind = F.lit(3)
    for k, initial in enumerate(CLASSES):
        kind = F.when(first == initial, k).otherwise(kind)
    rows = (_digested(rows.select("*", kind.alias("kind"), (end == "").alias("blank"),
                                  (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut_off")))
            .groupBy("conv_id", "turn", "role", "digest", "kind", "blank", "cut_off")
            .agg(F.sum("copies").cast("long").alias("copies")))
    rows = written(rows, "turns")
    # the earliest turn of each text; a text repeated in a third of the rows is aggregated before it moves
    early = (rows.where("copies > 0").groupBy(c("conv_id").alias("_conv"), c("role").alias("_role"), c("digest").alias("_digest"))
             .agg(F.min(F.struct("turn")).alias("_first")))
    same = c("conv_id").eqNullSafe(c("_conv")) & (c("role") == c("_role")) & (c("digest") == c("_digest"))
    return rows.join(early, same, "left").select(
        "conv_id", "turn", "role", "digest", "kind", "blank", "cut_off", "copies",
        F.coalesce(c("turn").eqNullSafe(c("_first.turn")), F.lit(True)).alias("first"))


# ------------------------------------------------------------------ blocks
PATH = pa.struct([("state", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
BLOCKS = "part int, no long, code string, low long, high long, turns long, paths array<struct<state:int,end:int,cost:long,audit:string>>"


def _paths(code: str, begins: bool, ends: bool, known: dict):
    if begins and ends and code in known:
        return known[code]
    search = Search(code)
    out = []
    for state in ((0,) if begins else range(4)):
        for end in ((ANY_END,) if ends else range(5)):
            if (got := search.cheapest(state, end)) is not None:
                out.append({"state": state, "end": end, "cost": got[0], "audit": got[1]})
    if begins and ends:
        if len(known) >= KNOWN:
            known.clear()
        known[code] = out
    return out


def _blocks(batches):
    """Cut the sorted symbols of a partition into searched blocks.  The first conversation of a
    partition may have begun before it, the last one may go on."""
    from pyspark import TaskContext

    part, known, number = TaskContext.get().partitionId(), {}, 0
    names = ("conv_id", "turn", "kind", "blank", "cut_off", "copies", "first")
    last, code, turns, begins, started = None, [], [], False, False
    done: list[tuple] = []
    kind = None

    def close(ends):
        nonlocal code, turns, number, begins
        seen = [t for i, t in enumerate(turns) if t is not None and (i == 0 or t != turns[i - 1])]
        text = "".join(code)
        done.append((last, part, number, text, seen[0] if seen else None, seen[-1] if seen else None, len(seen),
                     _paths(text, begins, ends, known)))
        code, turns, number, begins = [], [], number + 1, False

    def flush():
        nonlocal done
        columns = list(zip(*done))
        types = (kind, pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(PATH))
        batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)],
                                           names=["conv_id", "part", "no", "code", "low", "high", "turns", "paths"])
        done = []
        return batch

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for conv, turn, cls, blank, cut_off, copies, first in zip(*(batch.column(x).to_pylist() for x in names)):
            if not started or conv != last:
                if started:
                    close(True)
                begins, last = started, conv     # the first one of the partition may have begun before it
                started = True
            fault = BLANK if blank else (CUT_OFF if cut_off else NONE) if first else DUPLICATE
            for k in range(copies):
                if len(code) == BLOCK:
                    close(False)
                code.append(SYMBOLS[4 * cls + (fault if k == 0 or blank else DUPLICATE)])
                turns.append(turn)
            if len(done) >= 4096:
                yield flush()
    if started:
        close(False)
        yield flush()


FOLDED = "audit string, blank long, duplicate long, truncated long, illegal long, gaps long, cost long"


def _fold(batches):
    """Combine the blocks of each conversation from the last to the first."""
    last, rest, started, kind = None, None, False, None
    counts: list[int] = []
    later_low = top = later_kind = None
    done: list[tuple] = []

    def close():
        cost, chain = rest[0]
        audit = []
        while chain is not None:
            audit.append(chain[0])
            chain = chain[1]
        blank, duplicate, truncated, illegal, turns = counts
        gaps = 0 if top is None else top - later_low + 1 - turns
        done.append((last, "".join(audit), blank, duplicate, truncated, illegal, gaps, cost))

    def flush():
        nonlocal done
        types = (kind, pa.string(), *[pa.int64()] * 6)
        names = ["conv_id", "audit", "blank", "duplicate", "truncated", "illegal", "gaps", "cost"]
        batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), types)], names=names)
        done = []
        return batch

    legal = {(0, 1), (1, 2), (2, 1)}
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        names = ("conv_id", "code", "low", "high", "turns", "paths")
        for conv, code, low, high, turns, paths in zip(*(batch.column(x).to_pylist() for x in names)):
            if not started or conv != last:
                if started:
                    close()
                last, started, rest, counts = conv, True, None, [0] * 5
                later_low = top = later_kind = None
            classes = [int(x, 16) // 4 for x in code]
            faults = [int(x, 16) % 4 for x in code]
            for k in range(3):
                counts[k] += faults.count(k + 1)
            counts[3] += sum(pair not in legal for pair in zip(classes, classes[1:]))
            if classes:
                counts[3] += later_kind is not None and (classes[-1], later_kind) not in legal
                later_kind = classes[0]
            if low is not None:
                counts[4] += turns - (high == later_low)
                later_low = low
                top = high if top is None else top
            found: dict[int, tuple] = {}
            for p in paths:
                if rest is None:
                    new = (p["cost"], (p["audit"], None)) if p["end"] == ANY_END else None
                else:
                    after = rest.get(p["end"])
                    new = after and (p["cost"] + after[0], (p["audit"], after[1]))
                if new and _better(new, found.get(p["state"])):
                    found[p["state"]] = new
            rest = found
            if len(done) >= 4096:
                yield flush()
    if started:
        close()
        yield flush()


# ------------------------------------------------------------------ rewriting
REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


class _Editor:
    """Applies an audit to the rows of a conversation, in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def inserted(self):
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            role = WANTED[self.state]
            self.state = 3 if self.state == 2 else 2
            yield role, "", "I"

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = FOLLOW[self.state][CLASSES.index(role[0])]
            yield role, text, edit
        elif edit == "R":
            role = WANTED[self.state]
            self.state = 3 if self.state == 2 else 2
            yield role, text, edit


def _rewritten(batches):
    """(report row, iterator of repaired (role, text, edit)) per conversation; rows are streamed."""
    def lines():
        for batch in batches:
            yield from zip(*(batch.column(x).to_pylist() for x in ("conv_id", "role", "text", "copies", *REPORT)))

    stream = lines()
    line = next(stream, None)
    while line is not None:
        conv, report = line[0], line[4:]            # a conversation's report comes before its rows

        def repaired():
            nonlocal line
            editor = _Editor(report[-1])
            line = next(stream, None)
            while line is not None and line[0] == conv and line[3] is not None:
                for _ in range(line[3]):
                    yield from editor.row(line[1], line[2])
                line = next(stream, None)
            yield from editor.inserted()

        yield (conv, *report), repaired()


def _batched(rows, types, names, limit=4096, weight=None):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1 if weight is None else 1 + weight(row) // 1024
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), types)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), types)], names=names)


def _digesting(kind):
    def run(batches):
        def rows():
            for report, repaired in _rewritten(batches):
                sha, first = hashlib.sha256(), True
                for role, text, _ in repaired:
                    sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
                yield (*report, sha.hexdigest())
        yield from _batched(rows(), (kind, *[pa.int64()] * 6, pa.string(), pa.string()),
                            ["conv_id", *REPORT, "repaired_sha256"])
    return run


def _writing(kind):
    def run(batches):
        def rows():
            for report, repaired in _rewritten(batches):
                for position, (role, text, edit) in enumerate(repaired):
                    yield report[0], position, role, text, edit
        yield from _batched(rows(), (kind, pa.int64(), pa.string(), pa.string(), pa.string()),
                            ["conv_id", "position", "role", "text", "edit"], weight=lambda r: len(r[3]))
    return run


def _arrow_type(df: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["conv_id"].dataType)


def reports(rows: DataFrame) -> DataFrame:
    """conv_id, audit and the counts of each conversation of (conv_id, turn, role, text, copies)."""
    ship_package(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    symbols = written(_symbols(rows), "symbols")       # range bounds are sampled from the written table
    order = ["conv_id", "turn", "role", "digest"]
    blocks = (symbols.repartitionByRange(*order).sortWithinPartitions(*order)
              .select("conv_id", "turn", "kind", "blank", "cut_off", "copies", "first")
              .mapInArrow(_blocks, f"conv_id {kind}, {BLOCKS}"))
    return (blocks.repartition("conv_id").sortWithinPartitions("conv_id", c("part").desc(), c("no").desc())
            .mapInArrow(_fold, f"conv_id {kind}, {FOLDED}"))


def _edited(rows: DataFrame) -> DataFrame:
    report = written(reports(rows), "reports")
    none = {x: F.lit(None).cast(report.schema[x].dataType).alias(x) for x in REPORT}
    lines = _digested(rows.where("copies > 0")).select("conv_id", "turn", "role", "text", "digest",
                                                       c("copies").cast("int").alias("copies"), *none.values())
    heads = report.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                          F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("digest"),
                          F.lit(None).cast("int").alias("copies"), *REPORT)
    # nulls come first: the report, whose copies are null, is before the rows of its conversation
    return (heads.unionByName(lines).withColumn("is_row", c("copies").isNotNull()).repartition("conv_id")
            .sortWithinPartitions("conv_id", "is_row", "turn", "role", "digest")
            .select("conv_id", "role", "text", "copies", *REPORT))


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    the SHA-256 of the repaired ``role:text`` lines."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{x} long" for x in REPORT[:-1])
    return _edited(rows).mapInArrow(_digesting(_arrow_type(rows)),
                                    f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position, role, text, and the edit that made the row."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _edited(rows).mapInArrow(_writing(_arrow_type(rows)),
                                    f"conv_id {kind}, position long, role string, text string, edit string")
