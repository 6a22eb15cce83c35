"""BPE encoding and decoding by a contiguous rank array (operator 3).

Reads a public ``tokenizers`` JSON file (word BPE: NFC, lower case, words of letters,
single digits or other signs, byte-level symbols, an end-of-word suffix).  Letters are those
of the installed Unicode tables; code points newer than the library's may part differently.  The path is a
parameter; the executors read the vocabulary from a broadcast variable.

A short word keeps its part boundaries and the ranks of adjacent parts in two lists.  The
merge loop scans the ranks for the minimum (the leftmost one of equals), deletes that
boundary and refreshes the two neighbouring ranks.  Words of over ``LONG_WORD`` symbols do
the same merges from a heap, as rescanning would be quadratic.  Encoded words are kept in
a bounded cache of the Python worker; no row is shuffled.

Null text counts as empty: no tokens, decoded to the empty string.  The strings of special
tokens in a text become these tokens, as in the library.  Rows are kept one to one, also
with null or repeated ids; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlab.llm import textbytes as tb
from sensorlab.session import ship_package

c = F.col

LONG_WORD = 256
CACHE_WORDS = 400_000
NEVER = 1 << 60
# str.split() also parts at these four signs, which are not white space in the pattern.
INFORMATION_SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character of each byte in byte-level vocabularies."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in set(kept)]
    table = {b: chr(b) for b in kept}
    table.update({b: chr(256 + i) for i, b in enumerate(moved)})
    return [table[b] for b in range(256)]


class WordBPE:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids = model["vocab"]
        pairs = (tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()], default=-1) + 1
        self.tokens = [""] * size
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.pattern = regex.compile(data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.symbols = byte_symbols()
        self.parts_at = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, bytes] = {}      # words and stretches without white space; a word is both

    # ---------------------------------------------------------------- one word
    def _pack(self, parts: list[str]) -> bytes:
        return b"".join(self.ids[p].to_bytes(4, "little") for p in parts)

    def merge(self, word: str) -> list[str]:
        symbols = [self.symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        if len(symbols) > LONG_WORD:
            return self._merge_long(symbols)
        text = "".join(symbols)
        bounds = list(range(len(text) + 1))

        def part(i: int) -> str:
            piece = text[bounds[i]:bounds[i + 1]]
            return piece + self.suffix if i == len(bounds) - 2 else piece

        def rank(i: int) -> int:
            return self.ranks.get((part(i), part(i + 1)), NEVER)

        near = [rank(i) for i in range(len(bounds) - 2)]
        while near:
            least = min(near)
            if least == NEVER:
                break
            i = near.index(least)
            del bounds[i + 1]
            del near[i]
            if i < len(near):
                near[i] = rank(i)
            if i:
                near[i - 1] = rank(i - 1)
        return [part(i) for i in range(len(bounds) - 1)]

    def _merge_long(self, symbols: list[str]) -> list[str]:
        parts = symbols[:-1] + [symbols[-1] + self.suffix]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1)
                if (r := self.ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j >= n or parts[i] != left or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else n
                if y < n and (r := self.ranks.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p]

    # ---------------------------------------------------------------- texts
    def _remember(self, piece: str, ids: bytes) -> bytes:
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        if len(piece) <= LONG_WORD:
            self.known[piece] = ids
        return ids

    def _word(self, word: str) -> bytes:
        got = self.known.get(word)
        return self._remember(word, self._pack(self.merge(word))) if got is None else got

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a stretch without white space; words never reach over white space."""
        words = self.pattern.findall(chunk)
        if len(words) == 1 and words[0] == chunk:
            return self._word(chunk)
        return self._remember(chunk, b"".join(map(self._word, words)))

    def _plain(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if INFORMATION_SEPARATORS.search(text):
            parts = regex.split(r"\s+", text)
        else:
            parts = text.split()
        known = self.known.get
        out = list(map(known, parts))
        if None in out:
            out = [self._chunk(p) if o is None else o for o, p in zip(out, parts)]
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.parts_at is None or not self.parts_at.search(text):
            return self._plain(text)
        return b"".join(self.special[p].to_bytes(4, "little") if p in self.special else self._plain(p)
                        for p in self.parts_at.split(text))

    def decode(self, ids) -> str:
        """The tokens joined by a space, special ones included (the file names no decoder)."""
        return " ".join(map(self.tokens.__getitem__, ids))


_LOADED: dict[int, WordBPE] = {}


def _coder(spec) -> WordBPE:
    """The coder of a broadcast vocabulary, kept for the life of the Python worker."""
    key = hash(spec.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBPE(spec.value)
    return _LOADED[key]


def _coding(spec, decoded: bool, keep: list[str]):
    def run(batches):
        import numpy as np

        coder = _coder(spec)
        for batch in batches:
            texts = batch.column(1)
            _, offsets = tb.utf8(texts)
            for i, j in tb.blocks(offsets):
                ids = [coder.encode(t or "") for t in texts.slice(i, j - i).to_pylist()]
                columns = [batch.column(0).slice(i, j - i), pa.array([len(x) // 4 for x in ids], pa.int64()),
                           pa.array(ids, pa.binary())]
                columns[1:1] = [batch.column(2 + k).slice(i, j - i) for k in range(len(keep))]
                names = ["doc_id", *keep, "n_tokens", "ids"]
                if decoded:
                    columns.append(pa.array([coder.decode(np.frombuffer(x, "<u4").tolist()) for x in ids],
                                            pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def _vocabulary(spark, path: str):
    """The vocabulary file of the driver as a broadcast variable (a fixed file of about 2 MB)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False, keep: list[str] | None = None) -> DataFrame:
    """doc_id, the columns to ``keep``, n_tokens, ids (binary: little-endian unsigned 32-bit
    integers) and, if asked for, decoded (the text that the ids decode to), one row per document."""
    ship_package(docs.sparkSession)
    spec = _vocabulary(docs.sparkSession, vocabulary)
    keep = keep or []
    kind = docs.schema[id_col].dataType.simpleString()
    kept = "".join(f"`{k}` {docs.schema[k].dataType.simpleString()}, " for k in keep)
    schema = f"doc_id {kind}, {kept}n_tokens long, ids binary" + (", decoded string" if decoded else "")
    return (docs.select(c(id_col).alias("doc_id"), c(text_col).alias("_text"), *keep)
            .mapInArrow(tb.released(_coding(spec, decoded, keep)), schema))


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and decoded for rows (doc_id, ids)."""
    ship_package(encoded.sparkSession)
    spec = _vocabulary(encoded.sparkSession, vocabulary)

    def run(batches):
        import numpy as np

        coder = _coder(spec)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([coder.decode(np.frombuffer(x or b"", "<u4").tolist())
                                            for x in batch.column(1).to_pylist()], pa.string())],
                names=["doc_id", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, decoded string")
