"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cambio.llm.importance import BUCKETS, Draw, bags, gains, importance_weights, ranked, resample, scan, unpacked
from tests.llm.helpers import ODD_TEXTS, odd_documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def features(text):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def buckets(text):
    return [zlib.crc32(f.encode()) % BUCKETS for f in features(text)]


def brute(rows, target, percent=5, least=20):
    of_corpus = Counter(b for _, text in rows for b in buckets(text))
    of_target = Counter(b for text in target for b in buckets(text))
    all_corpus, all_target = of_corpus.total() + BUCKETS, of_target.total() + BUCKETS
    gain = lambda b: math.floor(1000 * math.log((of_target[b] + 1) * all_corpus / ((of_corpus[b] + 1) * all_target)))
    scored = []
    for i, text in rows:
        weight = sum(map(gain, buckets(text)))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((i, len(words(text)), len(features(text)), weight, score))
    order = sorted({(-s[4], s[0]) for s in scored if s[1] >= least and s[0] is not None})
    places = {(i, -s): n + 1 for n, (s, i) in enumerate(order[: percent * len(order) // 100])}
    return Counter((*s, places.get((s[0], s[4])) if s[1] >= least else None) for s in scored)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ9 é.\0\n日_~", max_size=60))
def test_scan(text):
    n, found = scan(text)
    assert n == len(words(text))
    assert Counter(found) == Counter(zlib.crc32(f.encode()) for f in features(text))


def test_scan_of_long_texts():
    for text in ("word " * 50_000, "x" * 1_000_000, "a " * 100_000 + "." * 100_000):
        n, found = scan(text)
        assert n == len(words(text)) and len(found) == max(3 * n - 3, 1)


def test_bags(spark):
    rows = {r.doc_id: r for r in bags(odd_documents(spark, ODD_TEXTS[:9])).collect()}
    for i, text, _ in ODD_TEXTS[:9]:
        assert rows[i].n_features == len(features(text)) and rows[i].n_words == len(words(text))
        held = np.cumsum(np.frombuffer(rows[i].gaps, "<u2").astype(int))
        assert dict(zip(held.tolist(), np.frombuffer(rows[i].times, "<u4").tolist(), strict=True)) == Counter(buckets(text))
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([{"gaps": rows[i].gaps, "times": rows[i].times} for i in (3, 1, 7)])
    bounds, held, times = unpacked(batch)
    assert bounds.tolist()[1] == bounds.tolist()[2] and times.sum() == sum(rows[i].n_features for i in (3, 1, 7))
    assert Counter(held[bounds[2] :].tolist()) == Counter(set(buckets("word " * 30_000)))


def test_odd_documents(spark):
    rows = ODD_TEXTS + [(100 + i, f"text number {i} " + "of many words " * (i % 9), "en") for i in range(60)]
    rows += [(100, rows[-1][1], "en"), (101, "twice " * 30, "en"), (101, "twice " * 30, "en")]
    docs = odd_documents(spark, rows)
    target = ["number of words", None, "", "text of words, words!"]
    texts = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (5, 100, 0):
        found = resample(docs, texts, Draw(percent=percent)).collect()
        assert Counter(tuple(r) for r in found) == brute([(i, t) for i, t, _ in rows], target, percent)
    assert resample(docs.where("false"), texts).count() == 0
    none = importance_weights(docs, texts.where("false")).collect()
    assert Counter((r.doc_id, r.weight) for r in none) == Counter((i, w) for i, _, _, w, _, _ in brute([(i, t) for i, t, _ in rows], []).elements())


def test_gains():
    even = np.full(BUCKETS, 7)
    assert not gains(even, even).any()
    assert not gains(np.zeros(BUCKETS, int), np.zeros(BUCKETS, int)).any()
    assert gains(even, np.r_[100, np.zeros(BUCKETS - 1, int)])[0] > 0


def test_ranked_over_several_ranges(spark):
    rng = np.random.default_rng(1)
    pairs = sorted({(i, int(s)) for i, s in enumerate(rng.integers(0, 50, 3000))}, key=lambda p: (-p[1], p[0]))
    rows = spark.createDataFrame(pairs, "doc_id bigint, score bigint").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = ranked(rows, 1234).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted((r["rank"], r.doc_id, r.score) for r in found) == [(n + 1, i, s) for n, (i, s) in enumerate(pairs[:1234])]


def test_documents_like_the_target_are_drawn(spark):
    plain = [(i, f"lorem ipsum dolor sit amet consectetur {i} " * 6, "en") for i in range(300)]
    like = [(1000 + i, f"graph theory proves that every planar map {i} has four colours " * 4, "en") for i in range(15)]
    target = spark.createDataFrame([("every planar map has four colours, graph theory proves",)] * 20, "text string")
    drawn = {r.doc_id for r in resample(odd_documents(spark, plain + like), target).where("rank IS NOT NULL").collect()}
    assert drawn == {i for i, _, _ in like}
