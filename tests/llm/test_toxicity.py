import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cambio.llm import toxicity
from cambio.llm.common import id_remainder
from cambio.llm.queries import op3_toxicity
from tests.llm.helpers import HAVE_TABLES, ODD_TEXTS, SF_DIR, odd_documents



def fold3():
    return id_remainder("doc_id", 4) == 3



def corpus(spark, n=1200):
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(5, 80))]
        toxic = int(i % 8 == 0)
        if toxic:
            text.insert(r.randint(0, len(text)), r.choice(["vile", "nasty"]))
        docs.append((i, " ".join(text), "en"))
        labels.append((i, 0, toxic))
    return odd_documents(spark, docs), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_words_and_pairs():
    text, word, before = toxicity.words_and_pairs(["Ab c, ab", "", "ab-é", None or ""])
    assert text.tolist() == [0, 0, 0, 2, 2]
    assert word[0] == word[2] == word[3] and len(set(word.tolist())) == 3
    assert before[0] == before[3] == 0 and before[1] == word[0] and before[2] == word[1]
    assert len(toxicity.words_and_pairs(["", "..."])[0]) == 0
    long = "x" * 200
    assert len(set(toxicity.words_and_pairs([f"{long}a {long}b {long}"])[1].tolist())) == 3


def test_planted_words_are_learned(spark):
    docs, labels = corpus(spark)
    model = toxicity.learn(docs.where("doc_id % 5 <> 0"), labels, fold3())
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    held = [i for i in got if i % 5 == 0]
    toxic = [got[i].score for i in held if i % 8 == 0]
    clean = [got[i].score for i in held if i % 8]
    assert np.mean([t > c for t in toxic for c in clean]) > 0.97
    assert np.mean([got[i].predicted for i in held if i % 8 == 0]) > 0.9
    assert np.mean([got[i].predicted for i in held if i % 8]) < 0.05
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in got.items() if not r.predicted}


def test_long_documents_are_normalised(spark):
    docs, labels = corpus(spark)
    model = toxicity.learn(docs, labels, fold3())
    clean = docs.where("doc_id % 8 = 1").agg(F.array_join(F.collect_list("text"), " ").alias("t")).first().t
    assert toxicity.scores(model, [clean, clean + " vile"])[0] < toxicity.THRESHOLD


def test_counts_are_of_texts(spark):
    rows = [("bad bad bad", 1), ("bad good", 1), ("good", 0)]
    counted = toxicity.count_expressions(spark.createDataFrame(rows, "text string, toxic int"))
    words = {(r.ordinary, r.toxic) for r in counted.where("kind = 0").collect()}
    assert words == {(0, 2), (1, 1)}


def test_counts_are_exact(spark):
    """More different expressions than any fixed table would hold apart, and a word with very many neighbours."""
    n = 3000
    letters = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    rows = [(" ".join(f"hub {letters(200 * i + j)}" for j in range(200)), i % 2) for i in range(n // 10)] + [("hub last", 1)]
    counts = toxicity.count_expressions(spark.createDataFrame(rows, "text string, toxic int")).cache()
    assert counts.where("kind = 0").count() == 200 * (n // 10) + 2
    assert counts.where("kind = 1").count() == 400 * (n // 10) - n // 10 + 2
    hub = int(toxicity.words_and_pairs(["hub"])[1].view(np.int64)[0])
    words = toxicity.word_counts(counts).where(F.col("word").isin(hub, 0)).orderBy(F.col("word") != 0).collect()
    assert (words[0].ordinary, words[0].toxic, words[0].after, words[0].kinds) == (150, 151, 0, 1)
    assert (words[1].ordinary, words[1].toxic, words[1].kinds) == (150, 151, 200 * (n // 10) + 1)
    assert words[1].after == 199 * (n // 10) + 1  # every word but the last of each text, and the start


def brute_force(rows, discount, texts):
    """The normalised differences and window counts of some texts, from the formulas and dictionaries."""
    words = lambda text: re.findall(r"[^\W\d_]+", text.lower())
    seen = {"w": Counter(), "p": Counter()}
    for text, toxic in rows:
        w = words(text)
        seen["w"].update((x, toxic) for x in set(w))
        seen["p"].update((x, toxic) for x in set(zip(["", *w], w, strict=False)))
    types, pairs = {x for x, _ in seen["w"]}, {x for x, _ in seen["p"]}
    texts_with = {k: sum(1 for t, label in rows if label == k and words(t)) for k in (0, 1)}
    count = {k: {x: seen["w"][x, k] for x in types} | {"": texts_with[k]} for k in (0, 1)}
    count[2] = {x: count[0][x] + count[1][x] for x in count[0]}
    kinds, after = Counter(v for v, _ in pairs), Counter(x for _, x in pairs)
    off, total = {0: discount, 1: discount, 2: toxicity.POOLED_DISCOUNT}, {}
    less = lambda c, k: max(c - off[k], 0)
    for k in range(3):
        total[k] = sum(count[k][x] for x in types) + 1
    mass = {k: total[k] - sum(less(count[k][x], k) for x in types) for k in range(3)}
    places = len(pairs) + len(types) + 1

    def word(x, k):
        shared = (less(count[2].get(x, 0), 2) + mass[2] * (after[x] + 1) / places) / total[2]
        return shared if k == 2 else (less(count[k].get(x, 0), k) + mass[k] * shared) / total[k]

    def left(v, k):
        return toxicity.STRENGTH + off[k] * min(kinds[v], count[k].get(v, 0))

    def pair(v, x, k):
        c = seen["p"][(v, x), 0] + seen["p"][(v, x), 1] if k == 2 else seen["p"][(v, x), k]
        then = word(x, 2) if k == 2 else pair(v, x, 2) * word(x, k) / word(x, 2)
        return (less(c, k) + left(v, k) * then) / (count[k].get(v, 0) + left(v, k))

    def difference(v, x):
        return math.log(pair(v, x, 1) / pair(v, x, 0))

    out = []
    for text in texts:
        w = words(text)
        d = [difference(v, x) for v, x in zip(["", *w], w, strict=False)]
        n = min(len(d), toxicity.WINDOW)
        means = [sum(d[i : i + n]) / n for i in range(len(d) - n + 1)] if d else [0.0]
        out.append((max(means), math.log(len(means))))
    return out


@pytest.mark.parametrize("discount", [0.75, 2.0])
def test_against_brute_force(spark, monkeypatch, discount):
    r = random.Random(11)
    vocabulary = [a + b for a in "klmn" for b in "aeiou"]
    rows = [(" ".join(r.choice(vocabulary[: 8 + 4 * (i % 4)]) for _ in range(r.randint(0, 25))), int(i % 3 == 0)) for i in range(90)]
    monkeypatch.setattr(toxicity, "likeliest_discount", lambda words: discount)
    model = toxicity.build_model(toxicity.count_expressions(spark.createDataFrame(rows, "text string, toxic int")))
    texts = [text for text, _ in rows[:40]] + ["", "ka", "unknown", "ka unknown li ka ka", "!", "ka li mo"]
    assert np.allclose(toxicity.features(model, texts), brute_force(rows, discount, texts), atol=1e-9)


def test_discount_is_the_likeliest(spark):
    r = random.Random(2)
    names = ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    rows = [(" ".join(r.choice(names[:: 1 + i % 2]) for _ in range(12)), i % 2) for i in range(60)]
    words = toxicity.word_counts(toxicity.count_expressions(spark.createDataFrame(rows, "text string, toxic int")))
    counts = [(w.ordinary, w.toxic) for w in words.collect() if w.word]
    total = [sum(c[k] for c in counts) for k in (0, 1)]

    def likelihood(d):
        left = [sum(min(c[k], d) for c in counts) for k in (0, 1)]
        of = lambda c, k: max(c[k] - 1 - d, 0) + left[k] * (sum(c) - 0.5) / sum(total)
        return sum(c[k] * math.log(of(c, k)) for c in counts for k in (0, 1) if c[k])

    assert toxicity.likeliest_discount(words) == max(toxicity.DISCOUNTS, key=likelihood)
    assert toxicity.likeliest_discount(words.where("false")) == toxicity.DISCOUNTS[0]


def test_blocks_are_cut_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK_BYTES", 1000)
    rows = [(i, "x" * (5000 if i == 7 else 90)) for i in range(200)] + [(None, None)] * 30
    blocks = toxicity.in_blocks(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2), "block")
    held = blocks.groupBy("block").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("size"), F.count("*").alias("n")).collect()
    assert sum(b.n for b in held) == 230 and all(b.size <= 1000 or b.n == 1 for b in held)
    assert len(held) < 30


def test_joined_model_scores_as_the_broadcast_one(spark, monkeypatch):
    docs, labels = corpus(spark, 600)
    docs = docs.unionByName(odd_documents(spark))
    small = toxicity.learn(docs, labels, fold3())
    monkeypatch.setattr(toxicity, "BROADCAST_ENTRIES", 0)
    monkeypatch.setattr(toxicity, "BLOCK_BYTES", 5000)
    large = toxicity.learn(docs, labels, fold3())
    assert len(small.keys) == small.entries == large.entries > 0 and len(large.keys) == 0
    assert np.allclose(small.weights, large.weights)
    both = [sorted(map(tuple, toxicity.score_documents(docs, m).collect()), key=repr) for m in (small, large)]
    assert [r[0] for r in both[0]] == [r[0] for r in both[1]]
    assert np.allclose([r[1] for r in both[0]], [r[1] for r in both[1]])
    assert toxicity.drop_toxic(docs, small).count() == toxicity.drop_toxic(docs, large).count()


def test_all_but_the_chosen_rows_are_counted(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CALIBRATION_ROWS", 40)
    docs, labels = corpus(spark)
    seen = []
    count = toxicity.count_expressions
    monkeypatch.setattr(toxicity, "count_expressions", lambda rows: seen.append(rows.select("doc_id").collect()) or count(rows))
    toxicity.learn(docs, labels, fold3())
    fold = {r.doc_id for r in docs.where(fold3()).select("doc_id").collect()}
    counted = [r.doc_id for r in seen[0]]
    left = set(range(1200)) - set(counted)
    assert len(counted) == 1160 and len(left) == 40 and left < fold


def test_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(
        [(3, 1, 1), (7, 1, 0), (7, 1, 0), (8, None, None), (None, 1, 1), (6, 1, 0), (6, 1, 1), (4, 1, 7)],
        "doc_id bigint, quality int, toxic int",
    )
    model = toxicity.learn(docs, labels, fold3())
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == len(ODD_TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= toxicity.THRESHOLD) for r in got)
    empty = toxicity.learn(docs, labels.where("false"), fold3())
    assert {r.predicted for r in toxicity.score_documents(docs, empty).collect()} == {0}
    assert toxicity.score_documents(docs.where("false"), empty).count() == 0
    assert toxicity.drop_toxic(docs, empty).count() == len(ODD_TEXTS)


@pytest.mark.skipif(not HAVE_TABLES, reason="no driver tables")
def test_query(spark):
    got = op3_toxicity(spark, SF_DIR)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert got.count() == 200
