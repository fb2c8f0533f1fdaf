"""Token alignment, exact top-k search and spelling variants against brute
force, with NULLs, empty and long texts, ties, repeated rows, empty tables and
clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from marketlake.llm import common, exact_topk, spelling_variants, token_alignment

BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
DOCS = "doc_id bigint, text string, word string, pair string, block string, n int"
ODD = [None, "", " ", "\n\t ", "12 34 !!", "word", "É ß é ¼ 日本 ﬁ ﬀ", "a  b▁ c", "a\x00b  \r\n",
       "<|endoftext|> x </s>", "x" * 3000, "ab " * 1500, "日本語の文章" * 40, "    tab\t\t  ", "1234567890" * 9,
       "naïve façade ÷×", "🙂🙃 emoji"]


@pytest.fixture(scope="module")
def session(spark):
    return common.tune(spark)


def frame(spark, texts, ids=None):
    rows = [(i, t, "w", "p", "b", 1) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


# ---------------------------------------------------------------- alignment

def brute_alignment(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, sha) by plain loops."""
    pair = token_alignment.tokenizer_pair(public_tokenizers.path(BYTES),
                                          public_tokenizers.path(PIECES))
    import tiktoken  # the same vocabulary as ranks: other decoder, other library
    import base64
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(
        public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                            special_tokens={})
    linked, shown = [], []
    for t in texts:
        data = (" " + (t or "")).encode()
        a = enc.encode_ordinary(" " + t) if t else []
        b = pair.b.encode(t) if t else []
        pieces = [bytes([int(p[3:5], 16)]) if pair.b.is_byte(i) else p.replace("▁", " ").encode()
                  for i, p in zip(b, map(pair.b.id_to_piece, b))]
        if not t or b"".join(pieces) != data or enc.decode_bytes(a) != data:
            linked.append([])
            shown.append((0, 0, 0, ""))
            continue
        ea = np.cumsum([len(enc.decode_single_token_bytes(i)) for i in a]).tolist()
        eb = np.cumsum([len(p) for p in pieces]).tolist()
        cuts = sorted(set(ea) & set(eb))
        groups, links, lo = [], [], 0
        for hi in cuts:
            ga = [i for i, e in zip(a, ea) if lo < e <= hi]
            gb = [i for i, e in zip(b, eb) if lo < e <= hi]
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            links += [(x, y) for x in ga for y in gb]
            lo = hi
        linked.append(links)
        shown.append((len(a), len(b), len(groups),
                      hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(p for links in linked for p in set(links))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    return [(*s[:3], len(x), sum(count[p] == top[p[0]] for p in x), sum(count[p] for p in x), s[3])
            for s, x in zip(shown, linked)]


def align(df):
    return token_alignment.align_tokens(df, public_tokenizers.path(BYTES),
                                        public_tokenizers.path(PIECES))


def test_alignment_equals_plain_loops(session):
    rng = random.Random(5)
    symbols = "aeiou bcd  \n\t.,'é日1234567890-_()▁ÀÿŁ🙂"
    texts = ODD + ["".join(rng.choice(symbols) for _ in range(rng.randint(1, 300)))
                   for _ in range(60)] + ["the quick brown fox isn't here"] * 3
    docs = frame(session, texts, [None, 5, *range(2, len(texts))])
    want = Counter((i, *w) for i, w in zip([None, 5, *range(2, len(texts))],
                                           brute_alignment(texts)))
    assert Counter(map(tuple, align(docs).collect())) == want
    assert sum(w[3] > w[1] for w in brute_alignment(texts)) > 10      # groups of several tokens


def test_alignment_with_small_blocks_and_products(monkeypatch):
    texts = [t for t in ODD if t] + ["some words, and more of them"] * 2
    pair = token_alignment.tokenizer_pair(public_tokenizers.path(BYTES),
                                          public_tokenizers.path(PIECES))
    import pyarrow as pa
    whole = token_alignment.block_row(pair, 1, pa.array(range(len(texts))), texts)
    monkeypatch.setattr(token_alignment, "PRODUCTS", 3)
    assert token_alignment.block_row(pair, 1, pa.array(range(len(texts))), texts).equals(whole)


def test_row_products_equal_dense_products():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.integers(0, 3, (7, 9)), rng.integers(0, 3, (9, 6))
        ca, cb = (token_alignment.CSR.of(*np.repeat(np.argwhere(m), m[m > 0], 0).T, len(m))
                  for m in (a, b))
        out = np.zeros((7, 6), int)
        for lo, part in token_alignment.row_products(ca, cb):
            for r in range(part.rows):
                s = slice(part.start[r], part.start[r + 1])
                out[lo + r, part.col[s]] = part.val[s]
        assert (out == a @ b).all()


def test_alignment_of_an_empty_table(session):
    assert align(frame(session, []).limit(0)).count() == 0
    assert [tuple(r)[1:] for r in align(frame(session, [None, ""])).collect()] \
        == [(0, 0, 0, 0, 0, 0, "")] * 2


# -------------------------------------------------------------------- search

VECS = "vec_id bigint, embedding array<float>, row string, slice string, score double"


def brute_top(rows, k, every):
    used = [(n, i, [math.floor(256 * float(np.float32(x))) for x in v])
            for n, (i, v) in enumerate(rows)
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v in used:
        if i is None or i % every:
            continue
        top = (1 << 63) - 1
        scored = sorted((-max(-top, min(top, sum(x * y for x, y in zip(v, w)))), j is None, j or 0, m)
                        for m, j, w in used if m != n)
        out += [(i, r + 1, None if s[1] else s[2], -s[0]) for r, s in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("side", [5, 64, 8192])
def test_top_k_equals_brute_force(session, side):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 8]) for i in range(120)]
    rows += [(200, None), (210, []), (None, [1.0] * 6), (220, [None, 1.0]), (230, [float("nan")] * 6),
             (240, [float("inf")]), (250, [0.0] * 6), (260, [0.5, 0.25]), rows[30], rows[30],
             (-10, rows[3][1]), (270, [2.0 ** 80, 1.0]), (None, rows[30][1])]
    df = session.createDataFrame([(i, v, "r", "s", 0.5) for i, v in rows], VECS).repartition(3)
    got = exact_topk.exact_top_k(df, every=10, side=side).collect()
    want = brute_top(rows, 5, 10)
    assert Counter(map(tuple, got)) == Counter(want)


def test_top_k_of_small_and_empty_tables(session):
    one = session.createDataFrame([(0, [1.0], "r", "s", 0.5)], VECS)
    assert exact_topk.exact_top_k(one).count() == 0
    assert exact_topk.exact_top_k(one.limit(0)).count() == 0
    two = one.union(session.createDataFrame([(1, [-0.001], "r", "s", 0.5)], VECS))
    assert [tuple(r) for r in exact_topk.exact_top_k(two).collect()] == [(0, 1, 1, -256)]


# ------------------------------------------------------------------- variants

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute_variants(rows):
    import re
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            n[low[:h % len(low)] + low[h % len(low) + 1:] if h % 31 == 0 else low] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def test_variants_equal_all_pairs(session):
    rng = random.Random(11)
    stems = ["".join(rng.choice("aeinrtéÀ÷") for _ in range(rng.randint(7, 12))) for _ in range(25)]
    texts = list(ODD) + ["aaaaaaaa aaaaaaa aaaaaaaaa " * 3]
    for k in range(150):
        words = []
        for _ in range(60):
            w = rng.choice(stems[:3 + k % 23])
            if rng.random() < 0.08:
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + w[p + 1:], w[:p] + "x" + w[p:], w[:p] + "z" + w[p + 1:]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        texts.append(rng.choice([" ", ", ", "_", "7"]).join(words))
    texts += ["chainword " * 1200, "chainwort " * 110, "chainvort " * 10, "chainvord " * 2]
    ids = [None, 3, *range(2, len(texts))]
    rows = list(zip(ids, texts)) + [(7, texts[40]), (7, texts[40])]
    df = frame(session, [t for _, t in rows], [i for i, _ in rows])
    want = brute_variants(rows)
    got = spelling_variants.spelling_variants(df).collect()
    assert Counter(map(tuple, got)) == Counter(want)
    assert sum(w[1] is not None and w[2] != w[1] for w in want)        # chains of forms
    for symbols in (2, 31):
        assert Counter(map(tuple, spelling_variants.spelling_variants(
            df, symbols=symbols).collect())) == Counter(want)


def test_neighbourhood_holds_every_one_edit_string():
    def text_key(s):
        sym = np.array([[int(c) for c in s]], np.uint64)
        return int(spelling_variants.neighbourhood(sym, 3)[0][0, 0])
    word = "1132213"
    sym = np.array([[int(c) for c in word]], np.uint64)
    own, near, longer = spelling_variants.neighbourhood(sym, 3)
    same = {word[:i] + c + word[i + 1:] for i in range(7) for c in "123"}
    short = {word[:i] + word[i + 1:] for i in range(7)}
    more = {word[:i] + c + word[i:] for i in range(8) for c in "123"}
    assert {int(x) for x in near[0]} == {text_key(s) for s in same | short}
    assert {int(x) for x in longer[0]} == {text_key(s) for s in more}
    # each pair is sent by exactly one side
    for s in (same | short | more) - {word}:
        other = np.array([[int(c) for c in s]], np.uint64)
        sent = [int(own[0, 0]) in set(spelling_variants.sent_keys(other, 3)[2].tolist()),
                text_key(s) in set(spelling_variants.sent_keys(sym, 3)[2].tolist())]
        assert sum(sent) == 1


def test_variants_of_an_empty_table(session):
    assert spelling_variants.spelling_variants(frame(session, []).limit(0)).count() == 0
    assert spelling_variants.spelling_variants(frame(session, ODD[:5])).count() == 0


def test_blocks_over_several_batches(session):
    texts = [*ODD, *(f"text {i} of many" for i in range(40))]
    docs = frame(session, texts, range(len(texts))).coalesce(1)
    want = Counter(map(tuple, align(docs).collect()))
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert Counter(map(tuple, align(docs).collect())) == want
        made = token_alignment.blocks(docs, public_tokenizers.path(BYTES),
                                      public_tokenizers.path(PIECES), "doc_id", "text")
        assert made.count() == 1               # texts of one task, whatever its batches
    finally:
        common.tune(session)


def test_parts_encoded_together_are_those_encoded_alone(monkeypatch):
    pair = token_alignment.tokenizer_pair(public_tokenizers.path(BYTES),
                                          public_tokenizers.path(PIECES))
    words = [f"{w}{i}" for i, w in enumerate(["plain", "É", "日本", "don't", "ab\n", "<s>", "x."] * 30)]
    parts = [*words, " lead", "trail ", "\n", "e\u0301", "\x00", "ﬁ", "a\tb", "▁", "</s>"]
    asked, encoded = [], pair.encoded
    monkeypatch.setattr(pair, "encoded", lambda t: asked.append(len(t)) or encoded(t))
    together = pair.tokens(parts, 16)
    assert sum(asked) < len(parts) / 2                 # far fewer texts than parts
    alone = [encoded([p])[0] for p in parts]
    assert 0 < sum(x is None for x in alone) < 9
    assert together[0].tolist() == [x is not None for x in alone]
    for side in (0, 1):
        got = np.split(together[3 + side], np.cumsum(together[1 + side])[:-1])
        assert [g.tolist() for g in got] == [x[side] if x else [] for x in alone]


def many_texts(n, words, vocabulary):
    rng = random.Random(9)
    known = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
             for _ in range(vocabulary)]
    return [" ".join(rng.choices(known, k=words)) for _ in range(n)]


def test_blocks_are_stored_as_small_pieces(monkeypatch):
    texts = [t for t in ODD if t] + many_texts(30, 20, 200) + ["", None]
    pair = token_alignment.tokenizer_pair(public_tokenizers.path(BYTES),
                                          public_tokenizers.path(PIECES))
    import pyarrow as pa
    whole = token_alignment.block_row(pair, 1, pa.array(range(len(texts))), texts)
    assert whole.num_rows == 1
    monkeypatch.setattr(token_alignment, "ALIGNED", 100)
    monkeypatch.setattr(token_alignment, "PIECE", 50)
    pieces = token_alignment.block_row(pair, 1, pa.array(range(len(texts))), texts)
    assert pieces.num_rows > 10
    assert all(len(p["which"]) <= 50 or len(p["ids"]) == 1 for p in pieces.to_pylist())
    assert all(len(p["pairs"]) <= 50 for p in pieces.to_pylist()[:-1])
    for name in ("ids", "n_a", "n_b", "n_groups", "sha", "which", "links", "pairs", "texts"):
        assert pieces.column(name).flatten().equals(whole.column(name).flatten())
    sizes = [np.diff(x.values.to_numpy()) for c in (pieces, whole) for x in c.column("start")]
    assert np.concatenate(sizes[:-1]).tolist() == sizes[-1].tolist()


def test_a_block_leaves_nothing_behind_and_holds_little():
    import gc
    import tracemalloc
    import pyarrow as pa
    pair = token_alignment.tokenizer_pair(public_tokenizers.path(BYTES),
                                          public_tokenizers.path(PIECES))
    texts = many_texts(600, 200, 100_000)
    token_alignment.block_row(pair, 1, pa.array(range(3)), texts[:3])
    gc.collect()
    gc.disable()                                  # as in the tasks
    tracemalloc.start()
    try:
        token_alignment.block_row(pair, 1, pa.array(range(len(texts))), texts)
        left, most = tracemalloc.get_traced_memory()
        assert left < 1 << 20                     # a cycle would keep all parts
        assert most < 65 << 20
    finally:
        tracemalloc.stop()
        gc.enable()


def test_alignment_over_several_pieces(session, monkeypatch):
    monkeypatch.setattr(token_alignment, "GROUP", 1)
    texts = many_texts(1200, 40, 3000)
    docs = frame(session, texts).coalesce(1)
    made = token_alignment.blocks(docs, public_tokenizers.path(BYTES),
                                  public_tokenizers.path(PIECES), "doc_id", "text")
    assert 1 < made.count() < 9 and made.select("block").distinct().count() == 1
    import pyarrow.parquet as pq
    for path in made.inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file:")).metadata
        assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] \
            == [1] * meta.num_rows                # read one at a time
    want = Counter((i, *w) for i, w in enumerate(brute_alignment(texts)))
    assert Counter(map(tuple, align(docs).collect())) == want
