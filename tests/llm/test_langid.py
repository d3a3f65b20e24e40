import numpy as np
import pytest
from pyspark.sql import functions as F

from cambio.llm import langid
from cambio.llm.queries import op2_language
from tests.llm.helpers import ODD_TEXTS, odd_documents


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    net = langid.new_network(["a", "b", "c"], rng)
    for p in net.parameters():
        p[...] = p + 0.01 * rng.standard_normal(p.shape)
    x, y = rng.integers(0, 256, (6, 20)), np.array([0, 1, 2, 0, 1, 2])
    net.embedding, net.weights, net.offset = (a.astype(np.float64) for a in (net.embedding, net.weights, net.offset))
    net.filters = [a.astype(np.float64) for a in net.filters]
    net.biases = [a.astype(np.float64) for a in net.biases]

    def loss():
        embedded, pooled = net.embedding[x], []
        for width, kernel, bias in zip(langid.WIDTHS, net.filters, net.biases, strict=True):
            stacked = np.concatenate([embedded[:, k : 20 - width + 1 + k] for k in range(width)], axis=2)
            pooled.append(np.maximum((stacked @ kernel + bias).max(axis=1), 0))
        p = langid.softmax(np.concatenate(pooled, axis=1) @ net.weights + net.offset)
        return -np.log(p[np.arange(6), y]).mean()

    for p, g in zip(net.parameters(), langid.gradients(net, x, y), strict=True):
        for at in [tuple(rng.integers(0, n) for n in p.shape) for _ in range(8)]:
            old = p[at]
            p[at] = old + 1e-6
            up = loss()
            p[at] = old - 1e-6
            down = loss()
            p[at] = old
            assert (up - down) / 2e-6 == pytest.approx(g[at], abs=1e-5)


def test_tables_equal_the_convolution():
    rng = np.random.default_rng(1)
    net = langid.new_network(["a", "b"], rng)
    x = rng.integers(0, 256, (5, langid.WINDOW_BYTES)).astype(np.uint8)
    pooled = []
    for width, kernel, bias in zip(langid.WIDTHS, net.filters, net.biases, strict=True):
        e = net.embedding[x]
        stacked = np.concatenate([e[:, k : x.shape[1] - width + 1 + k] for k in range(width)], axis=2)
        pooled.append(np.maximum((stacked @ kernel + bias).max(axis=1), 0))
    plain = np.concatenate(pooled, axis=1) @ net.weights + net.offset
    assert np.allclose(langid.Predictor(net).logits(x), plain, atol=1e-3)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    net = langid.learn(docs)
    assert net.languages == ["en", "fr"]  # the German row has no text
    got = langid.identify(docs, net).collect()
    assert len(got) == len(ODD_TEXTS)
    assert sorted((r.doc_id or 0) for r in got if r.lang_pred == "und") == [0, 1, 2, 5]
    assert all(r.score == 0 for r in got if r.lang_pred == "und") and all(0 <= r.score <= 1 for r in got)
    kept = langid.keep_identified(docs, net, 0.0)
    assert kept.columns == docs.columns and kept.count() == len(ODD_TEXTS) - 4
    assert langid.identify(docs.where("false"), net).count() == 0


def test_nothing_to_learn_from(spark):
    docs = odd_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert langid.learn(docs) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.keep_identified(docs, None, 0.5).count() == docs.count()
    one = langid.learn(odd_documents(spark, [(1, "only words", "xx")]))
    assert langid.identify(odd_documents(spark, [(2, "others", None)]), one).first().lang_pred == "xx"


def test_the_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_PER_LANGUAGE", 7)
    docs = odd_documents(spark, [(i, f"text number {i}", "en" if i % 10 else "de") for i in range(300)])
    sample = langid.training_sample(docs.select("doc_id", "text", "lang"))
    assert sorted(language for language, _ in sample) == ["de"] * 7 + ["en"] * 7


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.01"), reason="no driver tables")
def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    languages = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = op2_language(spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    held = got.where("held_out").join(languages, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) > 0


def test_training_reads_every_window_of_a_chunk(monkeypatch):
    seen = []
    count = langid.gradients
    monkeypatch.setattr(langid, "gradients", lambda net, x, y: seen.append(x) or count(net, x, y))
    monkeypatch.setattr(langid, "EPOCHS", 1)
    chunk = "я" * 599 + "ж"  # 1,200 bytes, five windows
    langid.train([("ru", chunk), ("en", "a" * 600)])
    windows = {row.tobytes() for x in seen for row in x}
    assert {w.tobytes() for w in langid.windows_of(chunk.encode())} <= windows
