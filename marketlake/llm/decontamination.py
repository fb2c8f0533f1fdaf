"""Operator 6: benchmark decontamination with a positional inverted index.

DataFrame operations only. Items are cut into windows of ``window`` words
(shorter items are one window). One pass over the corpus stores the postings
(term, document, position) of every benchmark term; the lengths of the lists
order the terms of each window. The list of a window's rarest term is
intersected with that of its second rarest, and what is left with the lists of
all its terms, each by (document, term, stretch of positions). Of the places
that hold every term within ``window`` - 1 words of the rarest one (proximity
matches), those with each term at its own offset are exact phrases.

The terms and windows of at most ``BLOCK`` windows are broadcast at a time; a
larger benchmark is searched in blocks, each over the whole corpus. All joins
of posting lists have a document and a position in their key, so no frequent
word and no frequent passage is one task.

Defined cases: words are runs of characters outside \\x00-/ : -` {-\\x7F after
A-Z are folded. NULL text has no words; items with NULL id or text, or without
words, are ignored; repeated items count once per id, repeated documents
give a row each; of equally rare terms of a window the one that stands first
counts as rarest; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import sized, staged

NOT_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = 200_000      # windows searched at a time: what is broadcast is bounded by it
END = "\x00"         # stands after the last word, as term NO_TERM; no word holds it
NO_TERM = -1


def words_of(text: Column) -> Column:
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(folded, F.lit(NOT_WORD), F.lit(0))


def item_windows(items: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """(phrase, items): distinct windows with the sorted item ids (as text)."""
    words = items.select(F.col(item_col).cast("string").alias("item"),
                         words_of(F.col(text_col)).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return (words.filter(F.col("item").isNotNull() & (F.size("words") > 0))
            .select("item", "words", F.explode(starts).alias("s"))
            .select("item", F.slice("words", F.col("s"), window).alias("phrase"))
            .groupBy("phrase").agg(F.array_sort(F.collect_set("item")).alias("items")))


def vocabulary_of(windows: DataFrame) -> DataFrame:
    """(term, tid): the distinct words of the windows, numbered."""
    return staged(windows.select(F.explode("phrase").alias("term")).distinct()
                  .withColumn("tid", F.monotonically_increasing_id()), "vocabulary")


def build_index(docs: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored postings (doc, doc_id, tid, pos) of all terms of the vocabulary.
    Each row of ``docs`` also has a posting of NO_TERM at its word count, the
    only one that carries its id."""
    end = docs.sparkSession.range(1).select(F.lit(END).alias("term"),
                                            F.lit(NO_TERM).cast("bigint").alias("tid"))
    rows = docs.select(F.monotonically_increasing_id().alias("doc"), F.col(id_col).alias("doc_id"),
                       words_of(F.col(text_col)).alias("words"))
    return staged(
        rows.select("doc", "doc_id",
                    F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("pos", "term"))
        .join(F.broadcast(vocabulary.unionByName(end)), "term")
        .select("doc", F.when(F.col("tid") == NO_TERM, F.col("doc_id")).alias("doc_id"),
                "tid", "pos"), "postings")


def ordered_terms(windows: DataFrame, vocabulary: DataFrame, index: DataFrame) -> DataFrame:
    """(wid, items, size, terms): the distinct terms of each window, the
    shortest posting list first (ties: first in the window), with their offsets
    from the first of them; windows with a term that the corpus lacks are
    dropped. One row per window; the lengths have one row per term."""
    lengths = index.filter(F.col("tid") != NO_TERM).groupBy("tid").agg(
        F.count(F.lit(1)).alias("n"))
    known = staged(vocabulary.join(lengths, "tid", "left").select(
        "term", "tid", F.coalesce("n", F.lit(0)).alias("n")), "lengths")
    terms = (windows.select("wid", F.posexplode("phrase").alias("offset", "term"))
             .join(F.broadcast(known), "term").groupBy("wid", "tid")
             .agg(F.min("n").alias("n"), F.min("offset").alias("first"),
                  F.collect_list("offset").alias("offsets"))
             .groupBy("wid").agg(F.array_sort(F.collect_list(
                 F.struct("n", "first", "tid", "offsets"))).alias("terms"))
             .filter(F.col("terms")[0]["n"] > 0))
    shifted = F.transform("terms", lambda t: F.struct(
        t["tid"].alias("tid"), F.transform(
            t["offsets"], lambda o: o - F.col("terms")[0]["first"]).alias("shifts")))
    return staged(windows.join(terms, "wid").select(
        "wid", "items", F.size("phrase").alias("size"),
        F.col("terms")[0]["first"].alias("offset"), shifted.alias("terms")), "ordered")


def stretches(places: DataFrame, window: int) -> DataFrame:
    """``places`` once for each stretch of 2 * window positions that holds
    positions within window - 1 of ``at`` (one or two)."""
    wide = 2 * window
    low = (F.greatest(F.col("at") - (window - 1), F.lit(0)) / wide).cast("int")
    high = ((F.col("at") + (window - 1)) / wide).cast("int")
    return places.withColumn("stretch", F.explode(F.sequence(low, high)))


def intersections(index: DataFrame, ordered: DataFrame, window: int) -> DataFrame:
    """Stored (doc, wid, at, start, size, exact): every posting ``at`` of a
    window's rarest term with all terms of the window within window - 1 words
    of it; ``exact`` where each stands at its own offset."""
    lists = index.filter(F.col("tid") != NO_TERM).select(
        "doc", "tid", "pos", (F.col("pos") / (2 * window)).cast("int").alias("stretch"))
    near = F.abs(F.col("pos") - F.col("at")) < window

    rarest = ordered.select("wid", F.col("terms")[0]["tid"].alias("tid"),
                            F.try_element_at("terms", F.lit(2))["tid"].alias("second"))
    places = lists.join(F.broadcast(rarest), "tid").select(
        "doc", "wid", F.col("pos").alias("at"), "second")
    seconds = lists.join(F.broadcast(rarest.select(F.col("second").alias("tid")).distinct()),
                         "tid", "left_semi")
    two = (stretches(places.filter(F.col("second").isNotNull()), window)
           .withColumnRenamed("second", "tid").join(
               seconds.withColumnsRenamed({"doc": "doc2", "tid": "tid2", "stretch": "stretch2"}),
               (F.col("doc") == F.col("doc2")) & (F.col("tid") == F.col("tid2"))
               & (F.col("stretch") == F.col("stretch2")) & near, "left_semi")
           .select("doc", "wid", "at").distinct())
    left = staged(two.unionByName(places.filter(F.col("second").isNull())
                                  .select("doc", "wid", "at")), "two-terms")

    wanted = F.broadcast(ordered.select("wid", F.explode("terms").alias("t"))
                         .select("wid", "t.tid", "t.shifts"))
    kept = staged(left.select("doc").distinct(), "documents-left")
    some = lists.join(sized(kept), "doc", "left_semi")
    evidence = (stretches(left.join(wanted, "wid"), window)
                .join(some, ["doc", "tid", "stretch"]).filter(near)
                .groupBy("doc", "wid", "at", "tid")
                .agg(F.sum(F.array_contains("shifts", F.col("pos") - F.col("at")).cast("int"))
                     .alias("placed"))
                .groupBy("doc", "wid", "at")
                .agg(F.count(F.lit(1)).alias("n"), F.sum("placed").alias("placed")))
    return staged(evidence.join(F.broadcast(ordered.select(
        "wid", "size", "offset", F.size("terms").alias("n_terms"))), "wid")
        .filter(F.col("n") == F.col("n_terms"))
        .select("doc", "wid", "at", (F.col("at") - F.col("offset")).alias("start"), "size",
                (F.col("placed") == F.col("size")).alias("exact")), "matches")


def matches(docs: DataFrame, items: DataFrame, window: int, id_col: str, text_col: str,
            item_col: str, item_text_col: str) -> tuple[DataFrame, DataFrame]:
    """The stored matches of all windows (``intersections`` with the window's
    items) and the stored index of the last block."""
    windows = staged(item_windows(items, window, item_col, item_text_col)
                     .withColumn("wid", F.monotonically_increasing_id()), "windows")
    blocks = max(1, -(-windows.count() // BLOCK))
    found, index = [], None
    for k in range(blocks):
        part = windows.filter(F.pmod("wid", F.lit(blocks)) == k) if blocks > 1 else windows
        vocabulary = vocabulary_of(part)
        index = build_index(docs, vocabulary, id_col, text_col)
        ordered = ordered_terms(part, vocabulary, index)
        found.append(intersections(index, ordered, window)
                     .join(F.broadcast(ordered.select("wid", "items")), "wid"))
    return reduce(DataFrame.unionByName, found), index


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near)
    per row; n_near counts the items with a proximity match."""
    found, index = matches(docs, items, window, id_col, text_col, item_col, item_text_col)
    hits = found.filter("exact")
    covered = (hits.select("doc", F.explode(F.sequence(
        F.col("start"), F.col("start") + F.col("size") - 1)).alias("pos"))
        .groupBy("doc", "pos").agg(F.lit(1).alias("one"))
        .groupBy("doc").agg(F.count(F.lit(1)).alias("n_hit")))
    told = (found.select("doc", F.explode("items").alias("item"), "exact")
            .groupBy("doc", "item").agg(F.max("exact").alias("exact"))
            .groupBy("doc").agg(
                F.array_sort(F.collect_list(F.when(F.col("exact"), F.col("item")))).alias("found"),
                F.count(F.lit(1)).alias("near")))
    rows = index.filter(F.col("tid") == NO_TERM).select(
        "doc", "doc_id", F.col("pos").cast("bigint").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return (rows.join(covered, "doc", "left").join(told, "doc", "left")
            .select("doc_id", "n_words", n_hit.alias("n_hit"),
                    F.coalesce(F.size("found"), F.lit(0)).cast("bigint").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("found", ","), F.lit("")), 256)
                    .alias("items_sha256"), (n_hit > 0).alias("contaminated"),
                    F.coalesce("near", F.lit(0)).cast("bigint").alias("n_near")))


ORACLE = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                    '{NOT_WORD}') w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) item, regexp_extract_all(
                translate(text, '{UPPER}', '{LOWER}'), '{NOT_WORD}') w
         FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
phrase AS (SELECT DISTINCT item, array_to_string(w[s:s + 9], ' ') p, least(len(w), 10) n
           FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) s
                 FROM item WHERE len(w) > 0)),
gram AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') p
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) s
               FROM doc, (SELECT DISTINCT n FROM phrase) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item, s, gram.n FROM gram JOIN phrase USING (p, n)),
spot AS (SELECT doc_id, count(DISTINCT pos) n_hit
         FROM (SELECT doc_id, unnest(range(s, s + n)) pos FROM hit) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) n_items, string_agg(item, ',' ORDER BY item) listed
        FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id),
word AS (SELECT doc_id, w, i, w[i] t FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) i
                                           FROM doc)),
total AS (SELECT t, count(*) c FROM word GROUP BY t),
cut AS (SELECT DISTINCT item, w[s:s + 9] l, array_to_string(w[s:s + 9], ' ') p
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) s
              FROM item WHERE len(w) > 0)),
rare AS (SELECT p, arg_min(t, (coalesce(c, 0), o)) t
         FROM (SELECT p, l[o] t, o FROM (SELECT p, l, unnest(range(1, len(l) + 1)) o
                                         FROM (SELECT DISTINCT p, l FROM cut)))
         LEFT JOIN total USING (t) GROUP BY p),
close AS (SELECT doc_id, count(DISTINCT item) n_near
          FROM word JOIN rare USING (t) JOIN cut USING (p)
          WHERE list_has_all(w[greatest(i - 9, 1):i + 9], l) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) n_words, coalesce(n_hit, 0) n_hit,
       coalesce(n_items, 0) n_items, sha256(coalesce(listed, '')) items_sha256,
       coalesce(n_hit, 0) > 0 contaminated, coalesce(n_near, 0) n_near
FROM doc LEFT JOIN spot USING (doc_id) LEFT JOIN ids USING (doc_id)
     LEFT JOIN close USING (doc_id)
"""
