"""Operator 13: spelling variants by reduced-alphabet generation.

Words are counted over all texts (partial counts per batch of texts, then a
sum by word). The letters of each word are hashed to a few symbols, which gives
its reduced word. Two words that differ by one edit have reduced words that
are equal or differ by one edit, so the full one-edit neighbourhood of every
reduced word is generated (its own string, all deletions, replacements and
insertions over the symbols, as 64-bit hashes) and joined with the reduced
words of the vocabulary. A neighbourhood holds both directions of a pair; a
key is sent to the join only from the word whose (length, key) is the greater,
so that each pair of words meets once. Candidates are verified on the original
strings inside the join, so neither shared symbols nor equal hashes ever make
a link, and no candidate list is formed.

A word's form is its nearest more frequent spelling; chains of forms are
followed by pointer doubling (counts grow tenfold a step, so there are few).

Defined cases: NULL and empty texts have no words; a NULL id is written as
nothing before the colon; repeated rows count again; a text is read whole; an
empty vocabulary gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import map_batches, staged, texts_of
from marketlake.llm.shingles import mix

SYMBOLS = 7            # letters are hashed to code point mod SYMBOLS
LEAST_LETTERS = 7
LEAST_COUNT = 2
FACTOR = 10            # a form is at least this many times as frequent
ERASE_ONE_IN = 31      # runs whose checksum this divides lose a letter
LETTERS = "A-Za-zÀ-ÿ"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


# ------------------------------------------------------------------- words

def word_of(run: str, seed: int) -> str:
    """The word that a lower-cased run stands for; ``seed`` is the checksum of
    what comes before the run."""
    h = zlib.crc32(run.encode(), seed)
    if h % ERASE_ONE_IN:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def vocabulary(docs: DataFrame, id_col: str, text_col: str, letters: int, count: int
               ) -> DataFrame:
    """(word, n): words of at least ``letters`` letters found ``count`` times."""
    def make():
        # a shorter run gives no word: erasing only shortens
        runs = re.compile(f"[{LETTERS}]{{{letters},}}").findall

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            total = Counter()
            for key, text in zip(batch.column(id_col).to_pylist(), texts_of(batch, text_col)):
                seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                for found, n in Counter(runs(text)).items():
                    word = word_of(found.translate(FOLD), seed)
                    if len(word) >= letters:
                        total[word] += n
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                names=["word", "n"])
        return run

    parts = map_batches(docs.select(id_col, text_col), make, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= count)


# ---------------------------------------------------------- reduced alphabet

def powers(n: int) -> np.ndarray:
    return np.array([pow(_BASE, k, 1 << 64) for k in range(n)], np.uint64)


def key_of(raw: np.ndarray, length: int) -> np.ndarray:
    return mix(raw + np.uint64(_BASE * (length + 1) & _MASK))


def reduced(words: list[str], symbols: int) -> np.ndarray:
    """Symbols (1 to ``symbols``) of words of one length, a row each."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return (codes.reshape(len(words), -1) % symbols + 1).astype(np.uint64)


def neighbourhood(sym: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the reduced words' own strings (a column), and of all strings
    one edit away: same length (replacements) or shorter (deletions); longer
    ones (insertions) come third."""
    m, length = sym.shape
    up = powers(length + 2)
    back = np.uint64(pow(_BASE, -1, 1 << 64))
    with np.errstate(over="ignore"):
        ahead = np.zeros((m, length + 1), np.uint64)       # sums of the first i symbols
        np.cumsum(sym * up[:length], axis=1, out=ahead[:, 1:])
        whole = ahead[:, -1:]
        rest = whole - ahead                               # sums from symbol i on
        every = np.arange(1, symbols + 1, dtype=np.uint64)
        swap = (whole[:, :, None] + (every[None, None] - sym[:, :, None]) * up[None, :length, None])
        shorter = ahead[:, :-1] + rest[:, 1:] * back
        longer = (ahead[:, :, None] + every[None, None] * up[None, :length + 1, None]
                  + (rest * up[1])[:, :, None])
    return (key_of(whole, length),
            np.concatenate([key_of(swap.reshape(m, -1), length), key_of(shorter, length - 1)], 1),
            key_of(longer.reshape(m, -1), length + 1))


def sent_keys(sym: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own, row, key): own keys, and the neighbours' keys sent to the join:
    distinct, from the greater word of a pair by (length, key) only, so all
    shorter strings, equally long ones of smaller key and no longer ones."""
    own, near, _ = neighbourhood(sym, symbols)
    swaps = sym.shape[1] * symbols
    keep = np.ones(near.shape, bool)
    keep[:, :swaps] = near[:, :swaps] < own
    order = np.argsort(near, axis=1)
    near, keep = np.take_along_axis(near, order, 1), np.take_along_axis(keep, order, 1)
    keep[:, 1:] &= near[:, 1:] != near[:, :-1]
    row, col = np.nonzero(keep)
    return own[:, 0], row, near[row, col]


def _grouped(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return out


def keyed_words(words: DataFrame, symbols: int, neighbours: bool) -> DataFrame:
    """(key, own, word, n): every word under its own reduced key or, with
    ``neighbours``, under its own and all sent keys of its neighbourhood."""
    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            every = batch.column("word").to_pylist()
            at, key, mine = [], [], []
            for places in _grouped(every).values():
                sym = reduced([every[i] for i in places], symbols)
                places = np.array(places)
                own, row, near = sent_keys(sym, symbols)
                at.append(places)
                key.append(own)
                mine.append(np.ones(len(places), bool))
                if neighbours:
                    at.append(places[row])
                    key.append(near)
                    mine.append(np.zeros(len(row), bool))
            take = pa.array(np.concatenate(at))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(key).view(np.int64)), pa.array(np.concatenate(mine)),
                 batch.column("word").take(take), batch.column("n").take(take)],
                names=["key", "own", "word", "n"])
        return run

    return map_batches(words.select("word", "n"), make,
                       "key bigint, own boolean, word string, n bigint")


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word1, n1, word2, n2): each pair of words one edit apart, once."""
    sent = keyed_words(words, symbols, True).toDF("key", "own", "word1", "n1")
    held = keyed_words(words, symbols, False).select("key", F.col("word").alias("word2"),
                                                     F.col("n").alias("n2"))
    # words of the same reduced word meet from both sides
    once = ~F.col("own") | (F.col("word1") < F.col("word2"))
    one_edit = F.levenshtein("word1", "word2", 1) == 1
    return (sent.join(held.hint("merge"), (sent.key == held.key) & once & one_edit)
            .select("word1", "n1", "word2", "n2"))


# ------------------------------------------------------------------- forms

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the end of their chain."""
    known = staged(forms.filter(F.col("form").isNotNull()).select(
        "word", F.col("form").alias("root")), "forms")
    while True:
        onward = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(known.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        known = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return known


def spelling_variants(docs: DataFrame, letters: int = LEAST_LETTERS, count: int = LEAST_COUNT,
                      factor: int = FACTOR, symbols: int = SYMBOLS, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of the vocabulary."""
    words = staged(vocabulary(docs, id_col, text_col, letters, count), "words")
    pairs = near_pairs(words, symbols)
    ends = pairs.select(F.explode(F.array(
        F.struct(F.col("word1").alias("word"), F.col("word2").alias("other"),
                 F.col("n2").alias("m")),
        F.struct(F.col("word2").alias("word"), F.col("word1").alias("other"),
                 F.col("n1").alias("m")))).alias("e")).select("e.*")
    best = ends.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best"))
    found = F.col("best").isNotNull() & (-F.col("best.less") >= factor * F.col("n"))
    forms = staged(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(found, F.col("best.other")).alias("form"),
        F.when(found, -F.col("best.less")).alias("form_n")), "words-with-forms")
    return forms.join(roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# crc32 by its polynomial, over the UTF-8 bytes of code points below U+0800 (ids and runs)
ORACLE = r"""
WITH RECURSIVE bits AS (
  SELECT CAST(range AS UINTEGER) b, CAST(range AS UINTEGER) c, 0 k FROM range(256)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UINTEGER))
                           ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY b) t FROM bits WHERE k = 8),
run AS (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') r,
               count(*) n
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) r
              FROM documents WHERE text IS NOT NULL)
        WHERE length(r) >= 7 GROUP BY 1, 2),
hashed AS (SELECT r, n, xor(list_reduce(flatten(list_transform(
               string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r, ''),
               lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS UINTEGER)]
                         ELSE [CAST(192 + (unicode(x) >> 6) AS UINTEGER),
                               CAST(128 + (unicode(x) & 63) AS UINTEGER)] END)),
               lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)]), CAST(4294967295 AS UINTEGER)),
               CAST(4294967295 AS UINTEGER)) h FROM run, tab),
vocab AS (SELECT word, CAST(sum(n) AS BIGINT) n
          FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, CAST(h % length(r) AS BIGINT))
                            || substr(r, CAST(h % length(r) AS BIGINT) + 2) ELSE r END word, n
                FROM hashed)
          WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, substr(word, 1, i - 1) a, substr(word, i + 1) z
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) i FROM vocab)),
near AS (SELECT x.word, y.word other, y.n m FROM cut x JOIN cut y
                ON x.a = y.a AND x.z = y.z AND x.word <> y.word
         UNION SELECT x.word, y.word, y.n FROM cut x JOIN vocab y ON x.a || x.z = y.word
         UNION SELECT y.word, x.word, x.n FROM cut x JOIN vocab y ON x.a || x.z = y.word),
best AS (SELECT word, count(*) n_near, max(m) m,
                arg_min(other, (-m, other)) other FROM near GROUP BY word),
form AS (SELECT v.word, v.n, coalesce(n_near, 0) n_near,
                CASE WHEN m >= 10 * v.n THEN other END form, CASE WHEN m >= 10 * v.n THEN m END form_n
         FROM vocab v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS here, n FROM form
          UNION ALL SELECT c.word, f.form, f.form_n FROM chain c JOIN form f ON f.word = c.here
          WHERE f.form IS NOT NULL)
SELECT form.word, form, root, form.n, n_near, form_n
FROM form JOIN (SELECT word, arg_max(here, n) root FROM chain GROUP BY word) USING (word)
"""
