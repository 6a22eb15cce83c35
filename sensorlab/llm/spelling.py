"""Spelling variant grouping by a reduced alphabet (operator 13).

Words are the runs of Latin letters of whole texts, A-Z folded, that occur often enough;
two words are near if exactly one code point is inserted, deleted or replaced between them.

Method.  Every letter is hashed to one of ``SYMBOLS`` symbols, which turns a word into a
reduced word.  One edit of a word is at most one edit of its reduced word, so the reduced
words of all near words lie in the full one-edit neighbourhood of the reduced word: itself,
every deletion, every replacement and every insertion of a symbol.  The neighbourhoods are
generated and joined with the reduced vocabulary; a pair is verified on the original words
inside the join, so only true pairs leave it.  The neighbourhood is full, so each word meets
all its near words from its own side and no pair has to be turned round.

A neighbourhood has about (2 L + 1) * SYMBOLS reduced words of a word of L letters, whatever the size
of the vocabulary, and a reduced word of L letters is shared by about 1 / SYMBOLS ** L of
the words of its length.  Everything is built-in expressions, partial aggregates and joins.

Nulls and empty texts have no words.  A null id hashes like the empty string.  Repeated rows
are counted as often as they occur.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlab.llm.exact_dedup import LOWER, UPPER
from sensorlab.llm.storage import written

c = F.col

RUN = "[A-Za-zÀ-ÿ]+"
DAMAGE = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_RATIO = 5
SYMBOLS = 8
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))


def reduced_alphabet(symbols: int = SYMBOLS) -> str:
    """The symbol of each of ``LETTERS``: a multiplicative hash of the code point."""
    return "".join(str((ord(x) * 0x9E3779B1 >> 16) % symbols) for x in LETTERS)


# ------------------------------------------------------------------ words
def damaged_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` for each run of each text, with one letter deleted where the run's hash says so."""
    runs = docs.select(F.coalesce(c(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(c(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run")).where(F.length("run") >= LEAST_LETTERS)
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (c("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(c("run"), at + 2, F.length("run")))
    return runs.select(F.when(c("h") % DAMAGE == 0, cut).otherwise(c("run")).alias("word"))


def vocabulary(words: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return (words.where(F.length("word") >= least_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(c("n") >= least_count))


# ------------------------------------------------------------------ neighbours
def neighbourhood(reduced: str, symbols: int = SYMBOLS) -> str:
    """SQL for the distinct reduced words within one edit of the column ``reduced``."""
    signs = "array(" + ", ".join(f"'{s}'" for s in range(symbols)) + ")"
    keep, after = f"substring({reduced}, 1, i - 1)", f"substring({reduced}, i + 1)"
    places = f"sequence(1, length({reduced}))"
    return f"""array_distinct(concat(array({reduced}),
        transform({places}, i -> concat({keep}, {after})),
        flatten(transform({places}, i -> transform({signs}, s -> concat({keep}, s, {after})))),
        flatten(transform(sequence(1, length({reduced}) + 1),
                          i -> transform({signs}, s -> concat({keep}, s, substring({reduced}, i)))))))"""


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, near, near_n) for every ordered pair of near words of a vocabulary (word, n)."""
    reduced = words.select("word", "n", F.translate("word", LETTERS, reduced_alphabet(symbols)).alias("reduced"))
    around = (reduced.select("word", F.explode(F.expr(neighbourhood("reduced", symbols))).alias("code"))
              .select("word", F.xxhash64("code").alias("code")))
    known = reduced.select(F.xxhash64("reduced").alias("code"), c("word").alias("near"), c("n").alias("near_n"))
    # Spark sizes the exploded neighbourhoods like the words they come from and would broadcast them: sort and merge
    # equal hashes only propose a pair; the distance is taken on the words themselves
    return (around.hint("merge").join(known, (around["code"] == known["code"]) & (F.levenshtein("word", "near", 1) == 1))
            .select("word", "near", "near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) by pointer doubling over (word, form); counts grow along forms, so a chain
    is logarithmic in the largest count and has no cycle."""
    found = forms.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        up = found.select(c("word").alias("_at"), c("root").alias("_next"))
        found = written(found.hint("merge").join(up, c("root") == c("_at"))
                        .select("word", c("_next").alias("root"), (c("_next") != c("root")).alias("moved")), "roots")
        if found.where("moved").limit(1).count() == 0:
            return found.select("word", "root")
        found = found.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      symbols: int = SYMBOLS, ratio: int = FORM_RATIO) -> DataFrame:
    """One row per word: word, n, n_near (its near words), form (its most frequent near word if
    that is ``ratio`` times as frequent, the smallest of equals; else null), form_n and root."""
    words = written(vocabulary(damaged_words(docs, id_col, text_col)), "words")
    best = near_words(words, symbols).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-c("near_n")).alias("less"), "near")).alias("best"))
    frequent = -c("best.less") >= ratio * c("n")
    forms = written(words.hint("merge").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, c("best.near")).alias("form"), F.when(frequent, -c("best.less")).alias("form_n")), "forms")
    return forms.hint("merge").join(roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")


# ------------------------------------------------------------------ DuckDB
def crc32_sql(text: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of the UTF-8 bytes of ``text``."""
    table = []
    for bit in range(8):
        x = 1 << bit
        for _ in range(8):
            x = (x >> 1) ^ (0xEDB88320 if x & 1 else 0)
        table.append(x)
    raw = f"hex(encode({text}))"
    data = f"list_transform(range(0, length({raw}) // 2), lambda k: ('0x' || substr({raw}, 2 * k + 1, 2))::BIGINT)"
    step = "0"
    for bit, value in enumerate(table):
        step = f"xor({step}, {value} * ((xor(x, y) >> {bit}) & 1))"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {data}), "
            f"lambda x, y: xor(x >> 8, {step})), 4294967295)")


def oracle() -> str:
    return f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
         unnest(regexp_extract_all(coalesce(text, ''), '{RUN}')) AS run FROM documents),
folded AS (SELECT id, translate(run, '{UPPER}', '{LOWER}') AS run, count(*) AS times FROM runs GROUP BY ALL),
hashed AS (SELECT run, times, {crc32_sql("id || ':' || run")} AS h FROM folded WHERE length(run) >= {LEAST_LETTERS}),
results AS (
  SELECT CASE WHEN h % {DAMAGE} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
              ELSE run END AS word, times FROM hashed),
vocabulary AS (SELECT word, sum(times)::BIGINT AS n FROM results WHERE length(word) >= {LEAST_LETTERS}
               GROUP BY word HAVING sum(times) >= {LEAST_COUNT}),
cuts AS (SELECT word, n, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS cut
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
near AS (
  SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN vocabulary b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN vocabulary b ON a.cut = b.word),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
                  row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS place FROM near),
forms AS (
  SELECT v.word, v.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= {FORM_RATIO} * v.n THEN r.near END AS form,
         CASE WHEN r.n >= {FORM_RATIO} * v.n THEN r.n END AS form_n
  FROM vocabulary v LEFT JOIN ranked r ON v.word = r.word AND r.place = 1),
chain AS (SELECT word, word AS at FROM forms
          UNION ALL SELECT chain.word, f.form FROM chain JOIN forms f ON chain.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, chain.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain ON f.word = chain.word JOIN forms l ON l.word = chain.at WHERE l.form IS NULL"""
