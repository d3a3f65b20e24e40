"""Language identification by a byte convolutional network: filters of several widths, max pooling, softmax.

The network is trained in numpy on the driver, on a bounded sample of labelled text: SAMPLE_PER_LANGUAGE chunks of each
language, those whose id has the smallest hash. It is then applied to every fixed-length window of every whole text, in
batches inside the tasks. For that the filters are unrolled into tables by byte pair, so a convolution is a few lookups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cambio.llm.common import map_rows, text_chunks

#: Labelled chunks per language that the network learns from, and characters of each.
SAMPLE_PER_LANGUAGE = 500
SAMPLE_CHARS = 600
#: Tasks hand their part of the sample on to so many shares, and these theirs to the language.
SHARES = 64
WINDOW_BYTES = 256
EMBEDDING = 8
WIDTHS = (2, 3, 4)
FILTERS = 16
EPOCHS = 6
BATCH = 64
UNDETERMINED = "und"
#: Windows that are convolved together.
WINDOWS_AT_ONCE = 256

LETTER = regex.compile(r"\p{L}")


def windows_of(raw: bytes) -> np.ndarray:
    """All fixed-length windows of a text, A-Z in lower case, the last one filled up with zero bytes."""
    count = max(1, -(-len(raw) // WINDOW_BYTES))
    return np.frombuffer(raw.lower().ljust(count * WINDOW_BYTES, b"\0"), dtype=np.uint8).reshape(count, WINDOW_BYTES)


@dataclass
class Network:
    """Byte embedding, filters by width, and the softmax layer over the pooled filters."""

    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # per width: (width * EMBEDDING) x FILTERS
    biases: list[np.ndarray]
    weights: np.ndarray  # (len(WIDTHS) * FILTERS) x languages
    offset: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.weights, self.offset]


def new_network(languages: list[str], rng: np.random.Generator) -> Network:
    def draw(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * np.sqrt(2 / shape[0])).astype(np.float32)

    return Network(
        languages,
        rng.standard_normal((256, EMBEDDING)).astype(np.float32),
        [draw(w * EMBEDDING, FILTERS) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        draw(len(WIDTHS) * FILTERS, len(languages)),
        np.zeros(len(languages), np.float32),
    )


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross entropy, in the order of ``Network.parameters``."""
    rows, length = x.shape
    embedded = net.embedding[x]
    pooled, where = [], []
    for width, kernel, bias in zip(WIDTHS, net.filters, net.biases, strict=True):
        stacked = np.concatenate([embedded[:, k : length - width + 1 + k] for k in range(width)], axis=2)
        value = stacked @ kernel + bias
        at = value.argmax(axis=1)
        where.append(at)
        pooled.append(np.maximum(np.take_along_axis(value, at[:, None], axis=1)[:, 0], 0))
    features = np.concatenate(pooled, axis=1)
    error = softmax(features @ net.weights + net.offset)
    error[np.arange(rows), y] -= 1
    error /= rows
    back = (error @ net.weights.T) * (features > 0)
    d_embedding = np.zeros_like(net.embedding)
    d_filters, d_biases = [], []
    for n, (width, kernel) in enumerate(zip(WIDTHS, net.filters, strict=True)):
        g = back[:, n * FILTERS : (n + 1) * FILTERS]  # only the place of the maximum passes a gradient
        d_kernel = np.zeros_like(kernel)
        for k in range(width):
            part = kernel[k * EMBEDDING : (k + 1) * EMBEDDING]
            at = np.take_along_axis(x, where[n] + k, axis=1)  # the byte under the filter's k-th place
            np.add.at(d_embedding, at.ravel(), (g[:, :, None] * part.T[None]).reshape(-1, EMBEDDING))
            d_kernel[k * EMBEDDING : (k + 1) * EMBEDDING] = np.einsum("bf,bfe->ef", g, net.embedding[at])
        d_filters.append(d_kernel)
        d_biases.append(g.sum(axis=0))
    return [d_embedding, *d_filters, *d_biases, features.T @ error, error.sum(axis=0)]


def train(samples: list[tuple[str, str]], seed: int = 7) -> Network | None:
    """A network for (language, text) samples, by Adam; None without samples."""
    languages = sorted({language for language, _ in samples})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    net = new_network(languages, rng)
    x, y = [], []
    for language, text in sorted(samples):
        for window in windows_of(text.encode()):
            x.append(window)
            y.append(languages.index(language))
    x, y = np.array(x), np.array(y)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    step = 0
    for _ in range(EPOCHS if len(languages) > 1 else 0):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // BATCH)):
            step += 1
            for p, g, m, v in zip(net.parameters(), gradients(net, x[rows], y[rows]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(p.dtype)
    return net


class Predictor:
    """The network unrolled for inference: filter responses by byte pair (and by single byte for odd widths)."""

    def __init__(self, net: Network):
        self.net, self.tables = net, []
        for width, kernel, bias in zip(WIDTHS, net.filters, net.biases, strict=True):
            single = [net.embedding @ kernel[k * EMBEDDING : (k + 1) * EMBEDDING] for k in range(width)]
            parts = [
                (k, (single[k][:, None, :] + single[k + 1][None, :, :]).reshape(65536, FILTERS))
                for k in range(0, width - 1, 2)
            ]
            self.tables.append((width, parts, single[-1] if width % 2 else None, bias))

    def logits(self, windows: np.ndarray) -> np.ndarray:
        """Class scores of each window."""
        out = []
        for begin in range(0, len(windows), WINDOWS_AT_ONCE):
            x = windows[begin : begin + WINDOWS_AT_ONCE].astype(np.int64)
            pairs = x[:, :-1] << 8 | x[:, 1:]
            pooled = []
            for width, parts, odd, bias in self.tables:
                places = x.shape[1] - width + 1
                value = np.take(parts[0][1], pairs[:, :places], axis=0)
                for k, table in parts[1:]:
                    value += np.take(table, pairs[:, k : k + places], axis=0)
                if odd is not None:
                    value += np.take(odd, x[:, width - 1 :], axis=0)
                pooled.append(np.maximum(value.max(axis=1) + bias, 0))
            out.append(np.concatenate(pooled, axis=1) @ self.net.weights + self.net.offset)
        return np.concatenate(out)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and probability of each text, from the mean of its windows' scores."""
        labels, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        known = [i for i, text in enumerate(texts) if LETTER.search(text)]
        if not known:
            return labels, scores
        windows = [windows_of(texts[i].encode()) for i in known]
        starts = np.cumsum([0, *[len(w) for w in windows[:-1]]])
        sums = np.add.reduceat(self.logits(np.concatenate(windows)).astype(np.float64), starts, axis=0)
        probabilities = softmax(sums / np.array([[len(w)] for w in windows]))
        for i, p in zip(known, probabilities, strict=True):
            labels[i], scores[i] = self.net.languages[int(p.argmax())], float(p.max())
        return labels, scores


_predictors: dict[int, Predictor] = {}


def _predictor(net: Network) -> Predictor:
    if id(net) not in _predictors:
        _predictors.clear()
        _predictors[id(net)] = Predictor(net)
    return _predictors[id(net)]


def training_sample(rows: DataFrame) -> list[tuple[str, str]]:
    """At most SAMPLE_PER_LANGUAGE (language, chunk of text) of each language, those whose id has the smallest hash.

    The limit is applied to what a task holds of each language, before anything is shuffled, then to each share of the
    tasks, then to the language: what is shuffled does not grow with the texts of a task, and no task gets more than
    SAMPLE_PER_LANGUAGE rows from each share. Texts without a letter teach nothing.
    """
    place = F.xxhash64("doc_id", F.lit("chunk"))
    begin = F.pmod(place, F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1))).cast("int") + 1
    order = (F.xxhash64("doc_id"), "doc_id", "text")
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "doc_id",
        "lang",
        F.substring("text", begin, F.lit(SAMPLE_CHARS)).alias("text"),
        F.spark_partition_id().alias("task"),
    ).withColumn("share", F.col("task") % SHARES)
    for group in (["lang", "share", "task"], ["lang", "share"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        rows = rows.withColumn("place", place).where(F.col("place") <= SAMPLE_PER_LANGUAGE)
    return [(row.lang, row.text) for row in rows.select("lang", "text").collect()]


def learn(labelled: DataFrame) -> Network | None:
    """The network for rows (doc_id, text, lang)."""
    return train(training_sample(labelled.select("doc_id", "text", "lang")))


def identify(documents: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every whole text.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if there was nothing to learn from.
    Ties between languages go to the first in alphabetical order. Repeated rows are answered repeatedly, a null id stays
    null, other columns are not read. Narrow: no shuffle.
    """
    shared = documents.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            labels, scores = _answers(shared.value, texts)
            columns = [batch.column("doc_id"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_rows(rows, run, "doc_id bigint, lang_pred string, score double")


def _answers(net: Network | None, texts: list[str]) -> tuple[list[str], list[float]]:
    if net is None:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    return _predictor(net).predict(texts)


def keep_identified(documents: DataFrame, net: Network | None, least: float) -> DataFrame:
    """The documents, all columns, whose language is determined with a probability of at least ``least``.

    Rows are judged where they lie, so repeated rows and null ids need no care. Without a network nothing is rejected.
    """
    if net is None:
        return documents
    shared = documents.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            labels, scores = _answers(shared.value, texts)
            fits = [a != UNDETERMINED and s >= least for a, s in zip(labels, scores, strict=True)]
            yield batch.filter(pa.array(fits, pa.bool_()))

    return map_rows(documents, run, T.StructType(documents.schema.fields))
