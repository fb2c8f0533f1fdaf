"""The trained operators against written-out formulas and odd texts through
fitted models; SQL of the scans on planted texts."""

from collections import Counter

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from marketlake.llm import (common, language_id, quality_fm, secret_scan, suffix_dedup,
                            toxicity)

GIVEN = "/root/testdata/sf0.01"
ODD = [None, "", " \n\t", "12 34 !!", "word", "É ß é ¼ 日本 ﬁ\x00", "x" * 300_000,
       "ab cd " * 100_000, "word", None]
FIRST = 10 ** 9        # ids of the odd rows


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def with_odd(spark):
    common.tune(spark)
    given = spark.read.parquet(f"{GIVEN}/documents.parquet")
    odd = spark.createDataFrame(
        [(FIRST + i, t, None, "s", None if t is None else len(t)) for i, t in enumerate(ODD)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return given.unionByName(odd.select(*[F.col(c).cast(given.schema[c].dataType)
                                          for c in given.columns])).repartition(4)


def test_sum_of_squares_equals_the_double_sum():
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 0.4, (50, 4))
    dense = rng.normal(0, 0.4, (quality_fm.STATS, 4))
    square = lambda a: np.concatenate(
        [a, (a[:, 1:] ** 2).sum(1, keepdims=True)], axis=1)
    machine = quality_fm.Machine(0.3, square(vectors), square(dense))
    slots = [[1, 4, 30], [], [7], list(range(50))]
    stats = rng.normal(0, 1, (len(slots), quality_fm.STATS))
    for got, some, z in zip(machine.score(slots, stats), slots, stats):
        x = np.concatenate([np.full(len(some), 1 / np.sqrt(max(1, len(some)))), z])
        rows = np.concatenate([vectors[some], dense])
        raw = 0.3 + sum(rows[i, 0] * x[i] for i in range(len(x)))
        for i in range(len(x)):
            for j in range(i + 1, len(x)):
                raw += rows[i, 1:] @ rows[j, 1:] * x[i] * x[j]
        assert abs(got - sigmoid(np.clip(raw, -30, 30))) < 1e-12


def test_severity_is_the_expected_grade_of_ordered_thresholds():
    rng = np.random.default_rng(2)
    rows, y = [], []
    for i in range(400):
        bad = i % 2
        words = [f"plain{rng.integers(60)}" for _ in range(8)]
        words += [f"nasty{k}" for k in rng.choice(6, 1 + i % 5, replace=False)] if bad else []
        rows.append(np.array(toxicity.text_features(" ".join(words))))
        y.append(bad)
    model = toxicity.fit(rows, np.array(y))
    assert (np.diff(model.theta) > 0).all()
    score = np.array([model.weights[r].sum() for r in rows], float)
    reach = model.at_least(score)
    assert np.allclose(reach, sigmoid(score[:, None] - model.theta))
    grades = np.concatenate([1 - reach[:, :1], reach[:, :-1] - reach[:, 1:], reach[:, -1:]], 1)
    assert (grades >= 0).all() and np.allclose(grades.sum(1), 1)
    assert np.allclose(reach.sum(1), grades @ np.arange(toxicity.GRADES + 1))
    assert ((reach[:, 0] >= 0.5) == np.array(y)).mean() > 0.99


def test_convolution_equals_loops():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 256, (3, language_id.WINDOW)).astype(np.uint8)
    x[2, 40:] = 0
    net = language_id.fit(x, np.array([0, 1, 2]), ["a", "b", "c"], steps=3)
    for got, window in zip(net.probabilities(x), x):
        e = [net.embed[b] for b in window] + [net.embed[0]] * 3
        top = []
        for i, width in enumerate(language_id.WIDTHS):
            for f in range(language_id.FILTERS):
                k = i * language_id.FILTERS + f
                kernel = net.conv[:, k].reshape(-1, language_id.EMBED)
                sums = [sum(float(e[p + o] @ kernel[o]) for o in range(width))
                        for p in range(language_id.WINDOW)]
                top.append(max(0.0, max(sums) + float(net.bias[k])))
        z = np.exp(np.array(top) @ net.dense + net.out)
        assert np.allclose(got, z / z.sum(), atol=1e-5)


def test_odd_texts_meet_fitted_models(spark):
    docs = with_odd(spark)
    labels = spark.read.parquet(f"{GIVEN}/labels.parquet")
    for told in (quality_fm.quality_scores(docs, labels),
                 toxicity.toxicity_scores(docs, labels)):
        rows = told.collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({round(r.score, 6) for r in rows}) > 20          # a fitted model
        odd = {r.doc_id - FIRST: r for r in rows if r.doc_id >= FIRST}
        assert odd[0].score == odd[9].score and odd[4].score == odd[8].score


def test_odd_texts_meet_a_net_of_all_languages(spark):
    rows = language_id.identify_languages(with_odd(spark)).collect()
    assert len({r.lang_pred for r in rows} - {"und"}) > 2
    odd = {r.doc_id - FIRST: r for r in rows if r.doc_id >= FIRST}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (0, 1, 2, 3, 9))
    assert all(odd[i].lang_pred != "und" and 0 < odd[i].score <= 1 for i in (4, 5, 6, 7, 8))
    assert odd[4].lang_pred == odd[8].lang_pred and odd[4].score == odd[8].score


def test_sql_of_scans_equals_the_operators(spark):
    common.tune(spark)
    passage = "é und weiter im langen Text, " * 20
    texts = [None, "", "kurz", passage, f"A {passage[:450]} B", f"C{passage[1:460]}", "z" * 900,
             "日本" * 200, "x 日本" + "日本" * 200, "TOKEN = 'abc123=' K api-key: nope api_key:short",
             "AKIA" + "A" * 16 + " AKIA" + "B" * 15 + " " + "0af" * 8, "sk_live_" + "a1" * 9,
             "toKen:ſ ſecret=abcdefg secret=abcdefg\x01\x02 password: \"a.b/c+d\"",
             "-----BEGIN RSA PRIVATE KEY-----\x01" + "f" * 24]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(3, passage), (None, "z" * 900)],
                                 "doc_id bigint, text string").repartition(3)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([tuple(r) for r in docs.collect()],
                                           columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    for got, sql in ((secret_scan.scan_secrets(docs), secret_scan.ORACLE),
                     (suffix_dedup.remove_repeats(docs), suffix_dedup.ORACLE)):
        want = con.execute(sql)
        names = [c[0] for c in want.description]
        assert Counter(want.fetchall()) == Counter(tuple(r) for r in got.select(*names).collect())
