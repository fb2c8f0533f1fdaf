"""Operators of the corpus subpackage against brute force on small tables,
with NULLs, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from marketlake.llm import (common, components, decontamination, jaccard_join, language_id,
                            nn_descent, packing, quality_fm, secret_scan, suffix_dedup,
                            token_counts, toxicity)

SMOKE = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, " \
       "set_id string, runs string, word string"
ODD = [None, "", " ", "\n\t ", "12 34 !!", "word", "É ß é ¼ 日本 ﬁ ﬀ\x00", "a  b▁ c",
       "<|endoftext|> x </s>", "x" * 3000, "ab " * 1500]


def rows_of(texts, ids=None):
    return [(i, t, "en" if n % 2 else None, "s", None if t is None else len(t), "x", "y", "z", "w")
            for n, (i, t) in enumerate(zip(ids or range(len(texts)), texts))]


@pytest.fixture(scope="module")
def corpus(spark):
    """Odd texts, repeated rows, a NULL id, near copies and shared passages."""
    common.tune(spark)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    base = [" ".join(word() for _ in range(120)) for _ in range(12)]
    near = []
    for t in base[:6]:
        for k in range(4):
            w = t.split(" ")
            w[5 + 9 * k] = word()
            near.append(" ".join(w))
    passage = " ".join(word() for _ in range(90))
    shared = [f"{word()} {passage} {word()}" for _ in range(4)]
    texts = ODD + base + near + shared + [base[0], base[0].upper()]
    rows = rows_of(texts)
    return rows + [rows[12], (None, base[1], None, None, None, "x", "y", "z", "w")]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def same(got, want):
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


def test_token_counts_equal_the_library(docs, corpus, empty):
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    want = [(r[0], len((r[1] or "").encode()), n := len(lib.encode(r[1] or "")), n > 100)
            for r in corpus]
    same(token_counts.token_counts(docs, path, max_tokens=100).collect(), want)
    assert token_counts.token_counts(empty, path).count() == 0


def test_packing_is_a_whole_cover_of_the_ids(docs, corpus, empty):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = packing.pack(docs, path, window=256).collect()
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for i, t, *_ in {r[0]: r for r in corpus}.values():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        copies = sum(r[0] == i for r in corpus)
        assert sum(p.length for p in pieces[i]) == copies * len(ids)
        for p in pieces[i]:
            part = np.array(ids[p.start:p.start + p.length], "<u4").tobytes()
            assert (zlib.crc32(part), p.doc_tokens) == (p.ids_crc32, len(ids))
    for s in sequences.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == list(np.cumsum([0] + [r.length for r in s[:-1]]))
        assert sum(r.length for r in s) <= 256
    assert packing.pack(empty, path).count() == 0


def test_plan_uses_the_histogram_exactly():
    rng = np.random.default_rng(1)
    hist = np.zeros(513, np.int64)
    hist[rng.integers(1, 512, 200)] = rng.integers(1, 900, 200)
    used = np.zeros_like(hist)
    for combo, times in packing.plan(hist, 512):
        assert sum(combo) <= 512
        for k in combo:
            used[k] += times
    assert (used == hist).all()
    assert packing.plan(np.zeros(513, np.int64), 512) == []


def test_secret_scan_equals_a_full_scan(spark, empty):
    key = "Ab1" * 12
    texts = ODD + [f"API_KEY = '{key}' and pass word", "Token:abcdef token:abcde", "AKIA" + "Z9" * 9,
                   "akia" + "Z9" * 9, "f" * 24 + " " + "0" * 23, f"ſecret={key} secret=\n{key}",
                   f"é password : {key} ghp_{'a' * 36} xoxb-123456789012",
                   "-----BEGIN RSA PRIVATE KEY-----"]
    df = spark.createDataFrame(rows_of(texts), DOCS)
    want = []
    for i, t in enumerate(texts):
        spans = sorted((m.start(), k, m.end()) for k, r in enumerate(secret_scan.RULES)
                       for m in r.compiled().finditer(t or "")
                       if m.end(r.group) - m.start(r.group) >= r.least)
        text = [(k, f"{secret_scan.RULES[k].kind}:{s}:{e}") for s, k, e in spans]
        sha = hashlib.sha256(",".join(x for k, x in text if k < 3).encode()).hexdigest()
        want.append((i, *(sum(k == n for k, _ in text) for n in range(3)), sha,
                     ",".join(x for _, x in text)))
    same(secret_scan.scan_secrets(df).collect(), want)
    assert secret_scan.scan_secrets(empty).count() == 0
    red = secret_scan.redact_secrets(df)
    assert red.columns == df.columns and red.count() == len(texts)
    # only the text in which no rule matches (other letters, a line feed) keeps its key
    left = red.filter(F.contains("text", F.lit(key))).collect()
    assert [r.text[0] for r in left] == ["ſ"]


def test_trigram_queries():
    assert secret_scan.trigram_query("[0-9a-f]+") is None
    assert secret_scan.query_grams(secret_scan.trigram_query("AKIA[A-Z0-9]+")) == {"aki", "kia"}
    assert secret_scan.trigram_query("abc|[0-9]+") is None


def brute_repeats(texts, length):
    datas = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in datas for i in range(len(d) - length + 1))
    out = []
    for d in datas:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_equal_brute_force(docs, corpus, empty):
    for length in (40, 400):
        want = [(r[0], *x) for r, x in zip(corpus, brute_repeats([r[1] for r in corpus], length))]
        same(suffix_dedup.remove_repeats(docs, length).collect(), want)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def brute_classes(corpus):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = [shingles(r[1]) for r in corpus]
    label = list(range(len(sets)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and label[j] > label[i] \
                        and 100 * len(a & b) >= 80 * len(a | b):
                    label[j] = label[i]
                    changed = True
    least = {}
    for r, c in zip(corpus, label):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    return [(r[0], len(s), least.get(c) if s else r[0])
            for r, s, c in zip(corpus, sets, label)]


def test_jaccard_join_equals_brute_force(docs, corpus, empty, monkeypatch):
    want = brute_classes(corpus)
    same(jaccard_join.near_duplicates(docs).collect(), want)
    # every list long, tiny blocks: the block path gives the same classes
    monkeypatch.setattr(jaccard_join, "SHORT", 1)
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    same(jaccard_join.near_duplicates(docs).collect(), want)
    assert jaccard_join.near_duplicates(empty).count() == 0
    heads = Counter((r[0] if r[2] is None else r[2]) for r in want if r[1])
    assert jaccard_join.keep_one_row_each(docs).count() == len(heads) + sum(not r[1] for r in want)


def brute_hits(text, items):
    fold = lambda t: re.findall(decontamination.NOT_WORD,
                                "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t or ""))
    words, hit, found = fold(text), set(), set()
    for item, t in items:
        w = fold(t)
        for s in range(max(1, len(w) - 9)) if w and item is not None else []:
            win = w[s:s + 10]
            for at in range(len(words) - len(win) + 1):
                if words[at:at + len(win)] == win:
                    hit |= set(range(at, at + len(win)))
                    found.add(str(item))
    listed = ",".join(sorted(found))
    return (len(words), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(),
            bool(hit))


def brute_near(texts, items):
    """Items with a window whose words all stand within 9 words of an
    occurrence of its rarest word, for each text."""
    fold = lambda t: re.findall(decontamination.NOT_WORD, (t or "").lower())
    docs = [fold(t) for t in texts]
    total = Counter(w for d in docs for w in d)
    near = [set() for _ in docs]
    for item, t in items:
        w = fold(t)
        for s in range(max(1, len(w) - 9)) if w and item is not None else []:
            win = w[s:s + 10]
            rare = min(range(len(win)), key=lambda o: (total[win[o]], o))
            for found, d in zip(near, docs):
                for at, x in enumerate(d):
                    if x == win[rare] and set(win) <= set(d[max(0, at - 9):at + 10]):
                        found.add(item)
    return [len(x) for x in near]


def test_decontamination_equals_brute_force(spark, docs, corpus, empty, monkeypatch):
    texts = [r[1] for r in corpus]
    items = [(1, " ".join(texts[11].split(" ")[3:20])), (10, texts[12].upper()[:200]), (2, "word"),
             (2, "word"), (3, ""), (4, None), (None, texts[13]), (5, "not in the corpus at all"),
             (6, " ".join(reversed(texts[14].split(" ")[20:30]))), (7, "x ab ab"), (8, "ab ab"),
             (9, " ".join(texts[15].split(" ")[50:57:2])), (11, "c a")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    near = brute_near(texts, items)
    want = [(r[0], *brute_hits(r[1], items), n) for r, n in zip(corpus, near)]
    assert any(w[-1] > w[3] for w in want)                # near, but no phrase
    same(decontamination.contamination(docs, bench).collect(), want)
    monkeypatch.setattr(decontamination, "BLOCK", 7)      # several blocks of windows
    same(decontamination.contamination(docs, bench).collect(), want)
    assert decontamination.contamination(empty, bench).count() == 0
    none = decontamination.contamination(docs, bench.limit(0)).collect()
    assert len(none) == len(corpus) and not any(r.contaminated for r in none)


def test_workers_keep_the_tables_of_one_operator(docs):
    ids = packing.word_ids(public_tokenizers.path("word_bpe_49k.json"))
    ids.encode("some words, some more words")
    assert len(ids.cache) and packing.word_ids.cache_info().currsize == 1
    common.release_others(packing.__name__)             # the next task of the same operator
    assert packing.word_ids.cache_info().currsize == 1
    common.release_others(secret_scan.__name__)         # a task of another one
    assert packing.word_ids.cache_info().currsize == 0


def test_secret_postings_by_pieces(monkeypatch):
    texts = [b"x" * n + b"token=" + b"y" * n for n in range(0, 40, 3)] + [b"", b"to", b"tok"]
    index = secret_scan.BlockIndex(["ken", "tok", "n=y"])
    want = {g: [i for i, t in enumerate(texts) if g.encode() in t] for g in index.grams}
    for piece in (1, 2, 7, 1 << 20):
        monkeypatch.setattr(secret_scan, "PIECE", piece)
        assert {g: p.tolist() for g, p in index.postings(texts).items()} == want


def test_nn_descent_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 16))
    crowd = base[0] + rng.normal(size=(40, 16)) * 0.05       # a saturated group
    x = np.concatenate([base, base[:10] + 0.01, base[:5], crowd]).astype(np.float32)
    rows = [(i, v.tolist(), 0 if i < 100 else 1) for i, v in enumerate(x)]
    rows += [(200, None, 0), (201, [0.0] * 16, 0), (202, [float("nan")] * 16, 0),
             (203, rows[0][1], None), (204, [None] * 16, 0), (205, [1.0, 2.0], 0),
             (206, [2.0, 4.0], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    monkeypatch.setattr(nn_descent, "BLOCK", 8)
    got = {r.vec_id: r for r in nn_descent.near_duplicates(df, k=4).collect()
           if r.vec_id is not None}
    unit = {}
    for i, v, lab in rows:
        a = np.array([np.nan if c is None else c for c in v], float) if v else np.zeros(1)
        if i is not None and lab is not None and np.isfinite(a).all() and a.any():
            unit[i] = (lab, a / np.linalg.norm(a))
    links = {i: {j for j, (m, b) in unit.items() if j != i and m == lab and len(a) == len(b)
                 and a @ b >= 0.98} for i, (lab, a) in unit.items()}
    for i in got:
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (
            len(links.get(i, ())), min(seen), min(seen) == i)
    assert len(got) == len(rows) - 1
    assert nn_descent.near_duplicates(df.limit(0)).count() == 0


def link_counts(rows):
    """Links of each row (id, vector, label) of finite vectors of one size."""
    x = np.array([v for _, v, _ in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([m for *_, m in rows])
    link = (x @ x.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(link, False)
    return {r[0]: int(n) for r, n in zip(rows, link.sum(1))}


VECTORS = "vec_id bigint, embedding array<float>, label int"


@pytest.mark.parametrize("enough", (5, 1000))
def test_nn_descent_finishes_what_the_lists_miss(spark, monkeypatch, enough):
    # one table and no round: most pairs never meet, and a few slices tell it
    common.tune(spark)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(3000, 16))
    x = np.concatenate([base, base[:60] + rng.normal(size=(60, 16)) * 0.03])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    monkeypatch.setattr(nn_descent, "SLICE", 700, raising=False)
    monkeypatch.setattr(nn_descent, "ENOUGH", enough, raising=False)
    got = nn_descent.near_duplicates(spark.createDataFrame(rows, VECTORS), tables=1, rounds=0,
                                     attempts=1).collect()
    want = link_counts(rows)
    assert sum(n > 0 for n in want.values()) > 100
    assert {r.vec_id: r.n_links for r in got} == want


def test_nn_descent_is_exact_whatever_the_audit_sees(spark, monkeypatch):
    # an audit of a few slices is content with the lists; links that they miss count all the same
    common.tune(spark)
    rng = np.random.default_rng(12)
    base = rng.normal(size=(1500, 16))
    x = np.concatenate([base, base[:300] + rng.normal(size=(300, 16)) * 0.03,
                        base[0] + rng.normal(size=(20, 16)) * 0.03])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    monkeypatch.setattr(nn_descent, "SLICE", 200)
    monkeypatch.setattr(nn_descent, "ENOUGH", 5, raising=False)
    monkeypatch.setattr(nn_descent, "CELL", 400, raising=False)
    monkeypatch.setattr(nn_descent, "STEP", 50, raising=False)
    got = nn_descent.near_duplicates(spark.createDataFrame(rows, VECTORS), tables=1, rounds=0,
                                     recall=0.05, attempts=2).collect()
    assert {r.vec_id: r.n_links for r in got} == link_counts(rows)


def test_nn_descent_compares_all_pairs_of_small_labels(spark, monkeypatch):
    # a label of 200 beside one of 3,000: its lists are whole without an audit
    common.tune(spark)
    rng = np.random.default_rng(9)
    base = rng.normal(size=(100, 16))
    x = np.concatenate([base, base + rng.normal(size=(100, 16)) * 0.09, rng.normal(size=(3000, 16))])
    rows = [(i, v.tolist(), int(i >= 200)) for i, v in enumerate(x)]
    monkeypatch.setattr(nn_descent, "audit", lambda *_: (True, None))
    got = nn_descent.near_duplicates(spark.createDataFrame(rows, VECTORS), tables=1, rounds=0,
                                     attempts=1).filter("vec_id < 200").collect()
    want = link_counts(rows[:200])
    assert sum(n > 0 for n in want.values()) > 100
    assert {r.vec_id: r.n_links for r in got} == want


def test_nn_descent_first_lists_are_not_empty(spark):
    # 12 bits for one part and 2 for another: each node has k neighbours to walk from
    common.tune(spark)
    x = np.random.default_rng(10).normal(size=(700, 16))
    rows = [(i, v.tolist(), int(i < 300)) for i, v in enumerate(x)]
    nodes = nn_descent.nodes_of(nn_descent.valid(spark.createDataFrame(rows, VECTORS))).withColumn(
        "bits", F.when(F.col("part.label") == 1, 12).otherwise(2))
    first = nn_descent.first_lists(nodes, 8, 6, 12, 11).withColumn("new", F.lit(True))
    sizes = nn_descent.trimmed(first, 8).groupBy("u").count().collect()
    assert len(sizes) == 700 and all(r["count"] == 8 for r in sizes)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501), (501, 501)],
                                  "a bigint, b bigint")
    got = dict(map(tuple, components.components(edges).collect()))
    assert got == {**{i: 0 for i in range(101)}, 500: 500, 501: 500}
    assert components.components(edges.limit(0)).count() == 0


def test_classifiers_on_held_out_rows(spark, docs, corpus, empty):
    common.tune(spark)
    given = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    known = {r.doc_id: r for r in labels.collect()}
    quality = [r for r in quality_fm.quality_scores(given, labels).collect()
               if r.held_out and r.doc_id in known]
    assert np.mean([r.predicted == known[r.doc_id].quality for r in quality]) > 0.97
    toxic = [r for r in toxicity.toxicity_scores(given, labels).collect()
             if r.held_out and r.doc_id in known]
    assert np.mean([r.predicted == known[r.doc_id].toxic for r in toxic]) > 0.93
    for fn in (quality_fm.quality_scores, toxicity.toxicity_scores):
        odd = fn(docs, labels.limit(0)).collect()
        assert len(odd) == len(corpus) and all(0 <= r.score <= 1 for r in odd)
        assert fn(empty, labels).count() == 0


def test_language_on_held_out_rows(spark, docs, corpus, empty):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in given.select("doc_id", "lang").collect()}
    told = language_id.identify_languages(given).collect()
    assert len(told) == given.count()
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in told if r.held_out]) > 0.95
    odd = {r.doc_id: r for r in language_id.identify_languages(docs).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in range(5))
    assert language_id.identify_languages(empty).count() == 0


def test_pipeline_keeps_columns_and_clean_documents(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.staged(stage(spark, docs, SMOKE), name)
        assert out.columns == docs.columns
        assert 0.8 * docs.count() <= out.count() <= docs.count()
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE)
    assert packed.select("doc_id").distinct().count() == docs.count()


def kept_rows(docs):
    return Counter((r.doc_id, r.text) for r in docs.collect())


def test_pipeline_stages_drop_rows_not_ids(spark, corpus):
    """NULL ids, repeated rows and one id on two texts."""
    import corpus_pipeline
    items = spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()
    long = next(r.text for r in items if len((r.text or "").split()) > 12)
    held = f"before {long} after"
    extra = rows_of([held, held, held, corpus[13][1], ODD[5]], [None, 900, 901, 900, None])
    rows = corpus + extra
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    hit = {r[1]: brute_hits(r[1], [(i.item_id, i.text) for i in items])[-1] for r in rows}
    assert hit[held] and not hit[corpus[13][1]]
    out = corpus_pipeline.decontaminate(spark, docs, SMOKE)
    assert out.columns == docs.columns
    assert kept_rows(out) == Counter(r[:2] for r in rows if not hit[r[1]])

    # brute force with row numbers as ids, in the order the stage prefers
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    told = brute_classes([(n, *r[1:]) for n, r in enumerate(order)])
    out = corpus_pipeline.near_duplicates(spark, docs, SMOKE)
    want = [(r, c[2]) for r, c in zip(order, told)]
    assert out.columns == docs.columns
    # a class keeps one row, of its smallest id
    assert Counter(r.doc_id for r in out.collect()) == Counter(
        r[0] for n, (r, c) in enumerate(want) if c == n)
    texts = {c: {r[1] for r, d in want if d == c} for _, c in want}
    assert Counter(min(c for c in texts if r.text in texts[c]) if r.text and r.text.split() else -1
                   for r in out.collect()) == Counter(
        c if r[1] and r[1].split() else -1 for n, (r, c) in enumerate(want) if c == n)


def test_language_and_redaction_stages_keep_exact_rows(spark):
    import corpus_pipeline
    given = spark.read.parquet(f"{SMOKE}/documents.parquet")
    docs = given.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(
        [(-1, "12 34 !!", "en"), (-2, "", "en"), (None, "\u2014 99", None)],
        "doc_id bigint, text string, lang string").select(
            F.col("doc_id").cast(given.schema["doc_id"].dataType).alias("doc_id"), "text", "lang"))
    docs = common.staged(docs, "language-test")
    told = {r.doc_id: r for r in language_id.identify_languages(docs).collect()}
    out = corpus_pipeline.language(spark, docs, SMOKE)
    assert out.columns == docs.columns
    assert kept_rows(out) == Counter(
        (r.doc_id, r.text) for r in docs.collect() if any(x.isalpha() for x in r.text)
        and told[r.doc_id].score >= corpus_pipeline.MIN_LANGUAGE_SCORE)

    key = "ghp_" + "a" * 36
    rows = [(1, f"see {key} end", 9), (2, "no secret", 9), (None, f"{key}", 9), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    got = corpus_pipeline.redact_secrets(spark, docs, SMOKE)
    assert got.columns == docs.columns
    same(got.collect(), [(i, t and t.replace(key, "[secret]"),
                          len(t.replace(key, "[secret]")) if t and key in t else c)
                         for i, t, c in rows])


def test_longest_word_of_a_very_long_text():
    few, many = (quality_fm.statistics("abcdefghij " + "a " * n, None) for n in (999_998, 999_999))
    assert few[10] == many[10] == 10 / 50


def test_parity_maps_never_differ_more_than_the_sets():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n, m, both = rng.integers(1, 400, 3)
        pool = rng.integers(0, 1 << 63, n + m + both, dtype=np.uint64)
        a, b = np.unique(pool[:n + both]), np.unique(pool[n:])
        apart = len(np.setxor1d(a, b))
        assert jaccard_join.differences(jaccard_join.parity(a), jaccard_join.parity(b)) <= apart
        assert jaccard_join.differences(jaccard_join.parity(a), jaccard_join.parity(a)) == 0


def test_pipeline_passes_columns_named_like_helpers(spark):
    import corpus_pipeline
    names = ["_uid", "__uid", "_language", "_certain", "text_key", "doc", "Set_ID", "_id", "_class",
             "tid", "runs", "row"]
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} "), F.col("doc_id")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.staged(stage(spark, docs, SMOKE), name)
        assert out.columns == docs.columns and out.count() > 0.8 * docs.count()
        for c in names:
            assert out.filter(F.col(c) != F.concat(F.lit(f"{c} "), F.col("doc_id"))).isEmpty()
        docs = out
    assert corpus_pipeline.pack(spark, docs, SMOKE).select("doc_id").distinct().count() \
        == docs.count()


def test_free_names_and_measured_broadcasts(spark):
    docs = spark.createDataFrame([(1, "x" * 1000)] * 10, "_UID long, __uid string")
    assert common.free_name(docs, "_uid") == "___uid"
    is_broadcast = lambda t: "ResolvedHint" in t._jdf.queryExecution().analyzed().toString()
    assert is_broadcast(common.sized(docs, 10 * 1016))
    assert not is_broadcast(common.sized(docs, 10 * 1016 - 1))     # width counts, not rows
    assert is_broadcast(common.sized(docs.select("_UID"), 80))
    assert is_broadcast(common.sized(docs.limit(0), 0))


def test_centres_are_sent_once_a_group_not_once_a_partner(spark):
    post = spark.createDataFrame([(s, i, 100, 0, 3) for s in (1, 2) for i in range(1000)],
                                 "shingle long, set_id long, n int, pos int, band int")
    pairs = jaccard_join.star_pairs(post, 80)
    rows = pairs.collect()
    assert len(rows) == 999 and len({r.a for r in rows}) == 1
    groups = jaccard_join.pair_groups(pairs)
    most = groups.groupBy("set_id").count().agg(F.max("count")).first()[0]
    assert most <= -(-999 // jaccard_join.BLOCK)


def test_repeated_rows_without_id_stay_bounded(spark, monkeypatch):
    common.tune(spark)
    rng = random.Random(5)
    text = " ".join(f"{rng.random():.6f}" for _ in range(90))
    rows = [(None, text)] * 300 + [(1, "a " + text), (2, text[:300])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen = []
    joined = suffix_dedup.joined_runs

    def watched(lists):
        seen.append(lists.agg(F.max(F.size("runs"))).first()[0])
        return joined(lists)

    monkeypatch.setattr(suffix_dedup, "joined_runs", watched)
    got = suffix_dedup.remove_repeats(docs).collect()
    same(got, [(r[0], *x) for r, x in zip(rows, brute_repeats([t for _, t in rows], 400))])
    assert seen[0] < 300
    near = jaccard_join.near_duplicates(docs).collect()
    same(near, brute_classes(rows))
