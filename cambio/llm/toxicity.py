"""Toxicity by two class-conditional Kneser-Ney language models over words.

A class's counts of words and pairs are discounted and back off to what both classes share. For words that is the pooled
count, discounted and backed off to how many different words w was seen after. For pairs it is the pooled pair model
P(w | v), which itself backs off to P(w), times the class's word ratio P_c(w) / P(w). An expression that a class does not
know well thus gets nearly the same probability from both, and speaks for neither. A text's score comes from the
difference of its log-likelihoods, normalised by length: the largest that any WINDOW consecutive words have, a shorter
text's own. Over a whole long text the few words that make it toxic would be lost among the others.

Counts are of texts that hold the expression, so a text that repeats a word a thousand times counts as one. They are
exact, by the 64-bit hashes of word and word before, and grow with the corpus: Spark sums them up, and continuation counts
are counts over the different pairs. The discount is that of DISCOUNTS under which the words of both classes, each left
out of the counts in turn, are likeliest. What scoring looks up is a written table of keys and values. A pair is in it if a
class's count exceeds the discount; of any other pair the shared part cancels out of the difference, which is then the
word's value plus that of the word before. A table of up to BROADCAST_ENTRIES is broadcast; a larger one is joined to the
different keys of each block of texts, which are cut by bytes. Both give the same scores. They are calibrated on at most
CALIBRATION_ROWS labelled rows, which are the only ones that are not counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cambio.llm.common import id_sketch, map_rows, maybe_in, text_chunks, unused, written

#: A larger table (16 bytes an entry) is not broadcast but joined.
BROADCAST_ENTRIES = 4_000_000
#: Bytes of the texts of a block that is joined with its entries; a longer text is a block of its own.
BLOCK_BYTES = 16_000_000
#: Expressions that a task holds before it hands its sums on.
HELD = 1_000_000
#: What may be taken off a class's count of a word or a pair. Where the shared model explains most counts, as it does with
#: few toxic texts, more than one observation has to go: a word that one toxic text happens to hold is no evidence.
DISCOUNTS = (0.5, 0.75, 1.0, 1.5, 2.0, 2.5, 3.0)
#: Taken off the pooled count of a word or a pair.
POOLED_DISCOUNT = 0.75
#: Weight of the backoff, in observations, beside the mass that discounting leaves to it.
STRENGTH = 20.0
#: Rows of the calibration, those whose id has the smallest hash.
CALIBRATION_ROWS = 20_000
#: Consecutive words over which the difference of log-likelihoods is normalised.
WINDOW = 4
FEATURES = 2
THRESHOLD = 0.3

_LETTER_CODES = np.zeros(256, np.uint64)
for _b in range(256):
    _lower = _b + 32 if 65 <= _b <= 90 else _b
    if 97 <= _lower <= 122 or _b >= 128:
        _LETTER_CODES[_b] = _lower + 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(64, np.uint64(0x100000001B3)))


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _ODD
        return x ^ (x >> np.uint64(29))


def words_and_pairs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, word hash, hash of the word before, or 0 at the start) of every word; words are runs of letters."""
    raw = [text.encode() for text in texts]
    codes = _LETTER_CODES[np.frombuffer(b" ".join(raw), dtype=np.uint8)]
    at = np.flatnonzero(codes)
    if not len(at):
        empty = np.empty(0, np.uint64)
        return np.empty(0, np.int64), empty, empty
    begins = np.r_[True, np.diff(at) > 1]
    first = np.flatnonzero(begins)
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
    with np.errstate(over="ignore"):
        word = _mixed(np.add.reduceat(codes[at] * _POWERS[place & 63], first))
    ends = np.cumsum([len(r) + 1 for r in raw])
    text = np.searchsorted(ends, at[first], side="right")
    before = np.r_[np.uint64(0), word[:-1]]
    before[np.r_[True, np.diff(text) > 0]] = 0
    return text, word, before


def _context_key(before: np.ndarray) -> np.ndarray:
    return _mixed(before ^ np.uint64(0xC2B2AE3D27D4EB4F))


def _pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(_mixed(before * np.uint64(31) + word) + before)


COUNT_SCHEMA = "kind int, before bigint, word bigint, ordinary bigint, toxic bigint"
WORD, PAIR = 0, 1


def _starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where another value begins in sorted columns."""
    differ = np.zeros(len(columns[0]), bool)
    differ[:1] = True
    for c in columns:
        differ[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(differ)


def _summed(rows: list[np.ndarray]) -> list[np.ndarray]:
    """(kind, before, word, ordinary, toxic), each expression once."""
    order = np.lexsort(rows[:3][::-1])
    rows = [c[order] for c in rows]
    first = _starts(rows[:3])
    return [c[first] for c in rows[:3]] + [np.add.reduceat(c, first) if len(first) else c for c in rows[3:]]


def _expressions(texts: list[str], toxic: np.ndarray) -> list[np.ndarray]:
    """The words and pairs of some texts with their counts, each once per text, however often the text repeats it."""
    text, word, before = words_and_pairs(texts)
    parts = []
    for kind, left in ((WORD, np.zeros_like(word)), (PAIR, before)):
        order = np.lexsort((word, left, text))
        keys = [text[order], left[order], word[order]]
        held, left_held, word_held = (c[_starts(keys)] for c in keys)
        label = toxic[held]
        parts.append([np.full(len(held), kind, np.int32), left_held, word_held, 1 - label, label])
    return _summed([np.concatenate(c) for c in zip(*parts, strict=True)])


def count_expressions(labelled: DataFrame) -> DataFrame:
    """Counts (COUNT_SCHEMA) of every word (``before`` 0) and pair over all rows (text, toxic).

    Each task adds up what it holds before anything is shuffled.
    """
    names = [c.split(" ")[0] for c in COUNT_SCHEMA.split(", ")]

    def handed(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = [c.view(np.int64) if c.dtype == np.uint64 else c for c in rows]
        for begin in range(0, len(rows[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[begin : begin + 100_000]) for c in rows], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = []
        size = 0
        for batch, texts in text_chunks(batches):
            parts.append(_expressions(texts, np.array(batch.column("toxic").to_pylist(), dtype=np.int64)))
            size += len(parts[-1][0])
            if size > HELD:
                parts = [_summed([np.concatenate(c) for c in zip(*parts, strict=True)])]
                size = len(parts[0][0])
                if size > HELD // 2:
                    yield from handed(parts[0])
                    parts, size = [], 0
        if parts:
            yield from handed(_summed([np.concatenate(c) for c in zip(*parts, strict=True)]))

    counted = map_rows(labelled.select("text", F.col("toxic").cast("int").alias("toxic")), run, COUNT_SCHEMA)
    sums = [F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")]
    return counted.groupBy("kind", "before", "word").agg(*sums)


def word_counts(counts: DataFrame) -> DataFrame:
    """(word, ordinary, toxic, after, kinds): ``after`` is how many different words it follows, ``kinds`` how many follow it.

    The start of a text is the word 0, which every text with words holds and has one pair with.
    """
    pairs = counts.where(F.col("kind") == PAIR)
    nothing, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    names = ["word", "ordinary", "toxic", "after", "kinds"]

    def rows(frame: DataFrame, *columns: Column | str) -> DataFrame:
        return frame.select(*columns).toDF(*names)

    at_start = [F.when(F.col("before") == 0, F.col(c)).otherwise(nothing) for c in ("ordinary", "toxic")]
    every = (
        rows(counts.where(F.col("kind") == WORD), "word", "ordinary", "toxic", nothing, nothing)
        .unionByName(rows(pairs, "word", nothing, nothing, one, nothing))
        .unionByName(rows(pairs, "before", *at_start, nothing, one))
    )
    return every.groupBy("word").agg(*[F.sum(c).alias(c) for c in names[1:]])


@dataclass
class KneserNey:
    """What scoring looks up, by key; and the calibration.

    A word's key leads to log P_toxic(w) / P_ordinary(w), its key as a context to the same of the weight of the backoff,
    a pair's key to log P_toxic(w | v) / P_ordinary(w | v). ``keys`` and ``values`` are empty if the table is too large.
    """

    table: DataFrame | None  # (key, value); not sent to the tasks
    entries: int
    keys: np.ndarray  # sorted
    values: np.ndarray
    unknown: float  # of a word without a key
    discount: float
    weights: np.ndarray  # of the features, the constant first
    centre: np.ndarray
    scale: np.ndarray

    def find(self, keys: np.ndarray, otherwise: float) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), otherwise)
        some, where = np.unique(keys, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        return np.where(self.keys[at] == some, self.values[at], otherwise)[where]

    def holding(self, keys: np.ndarray, values: np.ndarray) -> KneserNey:
        """The model with these entries instead of its table."""
        keys = keys.view(np.uint64)
        order = np.argsort(keys)
        return replace(self, table=None, keys=keys[order], values=values[order])


def _over(count: Column, discount: float) -> Column:
    return F.greatest(count - F.lit(discount), F.lit(0.0))


def likeliest_discount(words: DataFrame) -> float:
    """That of DISCOUNTS under which the words of the texts, each left out in turn, are likeliest; the least at a tie.

    Words are as :func:`word_counts` gives them. What the discount takes off a class goes to the shared counts, which are
    taken without the word that is left out too. Two rows reach the driver.
    """
    words, classes = words.where("word <> 0"), [F.col("ordinary"), F.col("toxic")]
    sums = [F.sum(c) for c in classes] + [F.sum(_over(c, d)) for c in classes for d in DISCOUNTS]
    totals = [value or 0 for value in words.agg(*sums).first()]
    if not totals[0] + totals[1]:
        return DISCOUNTS[0]
    shared = (classes[0] + classes[1] - F.lit(0.5)) / F.lit(float(totals[0] + totals[1]))
    gains = []
    for i, d in enumerate(DISCOUNTS):
        gain = F.lit(0.0)
        for k, c in enumerate(classes):
            left = float(totals[k] - totals[2 + k * len(DISCOUNTS) + i])
            likely = _over(c - F.lit(1), d) + F.lit(left) * shared
            gain = gain + F.when(c > 0, c * F.log(likely)).otherwise(F.lit(0.0))
        gains.append(F.sum(gain))
    return DISCOUNTS[int(np.argmax(list(words.agg(*gains).first())))]


def build_model(counts: DataFrame) -> KneserNey:
    """The models of both classes from the counts. Three rows of totals reach the driver, and a table that is small."""
    counts = written(counts, "toxicity-counts")
    words = written(word_counts(counts), "toxicity-words")
    discount = likeliest_discount(words)
    ordinary, toxic = F.col("ordinary"), F.col("toxic")
    totals = words.where("word <> 0").agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("double")
            for c in (
                ordinary, toxic, _over(ordinary, discount), _over(toxic, discount),
                _over(ordinary + toxic, POOLED_DISCOUNT), F.col("after"), F.lit(1),
            )
        ]
    ).first()
    total, direct = (totals[0] + 1, totals[1] + 1), (totals[2], totals[3])
    pooled, pooled_direct, places = totals[0] + totals[1], totals[4], totals[5] + totals[6] + 1
    unknown = float(np.log(1 - direct[1] / total[1]) - np.log(1 - direct[0] / total[0]))
    unseen = (F.col("after") + 1) / F.lit(places)  # beside the known words one has some mass: unknown words are possible
    shared = (_over(ordinary + toxic, POOLED_DISCOUNT) + F.lit(pooled - pooled_direct + 1) * unseen) / F.lit(pooled + 1)
    words = words.withColumn("p2", shared).withColumn("c2", ordinary + toxic)
    for k, count in ((0, ordinary), (1, toxic)):
        mass = _over(count, discount) + F.lit(total[k] - direct[k]) * F.col("p2")
        words = words.withColumn(f"p{k}", mass / F.lit(total[k])).withColumn(f"c{k}", count)
    for k, less in ((0, discount), (1, discount), (2, POOLED_DISCOUNT)):
        words = words.withColumn(f"left{k}", F.lit(STRENGTH) + F.lit(less) * F.least("kinds", f"c{k}"))
    backoff = [F.col(f"left{k}") / (F.col(f"c{k}") + F.col(f"left{k}")) for k in (0, 1)]
    known = words.where((F.col("word") != 0) & (F.greatest("c0", "c1") > discount))
    single = known.select(
        F.lit(WORD).alias("kind"), F.lit(0).cast("bigint").alias("before"), "word", F.log(F.col("p1") / F.col("p0"))
    )
    contexts = words.select(F.lit(2), "word", F.lit(0).cast("bigint"), F.log(backoff[1] / backoff[0]))
    of_word = words.select("word", "p0", "p1", "p2")
    of_context = words.select(F.col("word").alias("before"), *[f"{c}{k}" for k in range(3) for c in ("c", "left")])
    pairs = counts.where((F.col("kind") == PAIR) & (F.greatest(ordinary, toxic) > discount))
    pairs = pairs.join(of_word, "word").join(of_context, "before")

    def given(k: int, count: Column, less: float, then: Column) -> Column:
        left = F.col(f"left{k}")
        return (_over(count, less) + left * then) / (F.col(f"c{k}") + left)

    both = given(2, ordinary + toxic, POOLED_DISCOUNT, F.col("p2"))
    by_class = [given(k, c, discount, both * F.col(f"p{k}") / F.col("p2")) for k, c in ((0, ordinary), (1, toxic))]
    double = pairs.select("kind", "before", "word", F.log(by_class[1] / by_class[0]))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, before, word = (batch.column(k).to_numpy() for k in range(3))
            before, word = before.view(np.uint64), word.view(np.uint64)
            key = np.where(kind == WORD, word, np.where(kind == PAIR, _pair_key(before, word), _context_key(before)))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(3)], names=["key", "value"])

    entries = single.union(contexts).union(double)
    table = written(map_rows(entries, keyed, "key bigint, value double"), "toxicity-model")
    n = table.count()
    none = np.empty(0, np.uint64), np.empty(0)
    model = KneserNey(table, n, *none, unknown, discount, np.zeros(FEATURES + 1), np.zeros(FEATURES), np.ones(FEATURES))
    if n <= BROADCAST_ENTRIES:
        found = table.toArrow()
        model = model.holding(found["key"].to_numpy(), found["value"].to_numpy())
        model.table = table
    return model


def differences(model: KneserNey, word: np.ndarray, before: np.ndarray) -> np.ndarray:
    """log P_toxic(w | v) - log P_ordinary(w | v) of every word."""
    alone = model.find(word, model.unknown) + model.find(_context_key(before), 0.0)
    pair = model.find(_pair_key(before, word), np.nan)
    return np.where(np.isnan(pair), alone, pair)


def in_blocks(rows: DataFrame, block: str) -> DataFrame:
    """The rows with the number of their block: at most BLOCK_BYTES of the texts of one task, a row at least."""
    first = F.shiftright(F.monotonically_increasing_id(), 33)
    last = T.StructType([*rows.schema.fields, T.StructField(block, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = 0, 0
        for batch in batches:
            numbers = []
            for length in pc.binary_length(batch.column("text")).fill_null(0).to_pylist():
                if size and size + length > BLOCK_BYTES:
                    number, size = number + 1, 0
                size += length + 1
                numbers.append(number)
            task = batch.column(block)
            yield batch.set_column(
                batch.num_columns - 1, block, pc.add(pc.multiply(task, pa.scalar(1 << 33)), pa.array(numbers, pa.int64()))
            )

    return map_rows(rows.withColumn(block, first), run, last)


def answered(rows: DataFrame, model: KneserNey, answer, schema) -> DataFrame:
    """``answer(model, batch, texts)`` of all rows, which have a text.

    A model that was not broadcast is joined to the different keys of each block of rows, and each block is answered with
    the entries that it needs. The blocks are written first, so that both sides mean the same rows.
    """
    context = rows.sparkSession.sparkContext
    if len(model.keys) == model.entries:
        shared = context.broadcast(replace(model, table=None))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in text_chunks(batches):
                yield answer(shared.value, batch, texts)

        return map_rows(rows, run, schema)
    columns, bare, block = rows.columns, replace(model, table=None), unused("block", [*rows.columns, "key", "value"])
    blocks = written(in_blocks(rows, block), "toxicity-blocks")

    def handed(number: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = np.unique(np.concatenate(held)).view(np.int64)
        for k in range(0, len(keys), 100_000):
            part = keys[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), number)), pa.array(part)], names=[block, "key"])

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a block's rows follow each other, so its keys are made different here and not by a shuffle. Those of a block that
        # two tasks read may come twice, which finds the same values.
        current, held = -1, []
        for batch in batches:
            number = batch.column(block).to_numpy()
            _, first = np.unique(number, return_index=True)
            for n in number[np.sort(first)].tolist():
                if n != current and held:
                    yield from handed(current, held)
                    held = []
                current = n
                for _, texts in text_chunks([batch.filter(pa.array(number == n))]):
                    _, word, before = words_and_pairs(texts)
                    held.append(np.unique(np.concatenate([word, _context_key(before), _pair_key(before, word)])))
        if held:
            yield from handed(current, held)

    def run_block(texts: pa.Table, entries: pa.Table) -> pa.Table:
        own = bare.holding(entries["key"].to_numpy(), entries["value"].to_numpy())
        chunks = text_chunks(texts.select(columns).combine_chunks().to_batches())
        return pa.Table.from_batches([answer(own, batch, part) for batch, part in chunks])

    keys = map_rows(blocks.select(block, "text"), wanted, f"{block} bigint, key bigint")
    entries = keys.join(model.table, "key").select(block, "key", "value")
    return blocks.groupBy(block).cogroup(entries.groupBy(block)).applyInArrow(run_block, schema)


def features(model: KneserNey, texts: list[str]) -> np.ndarray:
    """Per text: the largest difference of log-likelihoods by length of its windows, and the logarithm of their number.

    A text of fewer than WINDOW words is one window. The second is there because the largest of many is larger by chance
    alone. Both are 0 without words.
    """
    out = np.zeros((len(texts), FEATURES))
    text, word, before = words_and_pairs(texts)
    if not len(text):
        return out
    running = np.r_[0.0, np.cumsum(differences(model, word, before))]
    first = np.flatnonzero(np.r_[True, np.diff(text) > 0])
    n = np.diff(np.r_[first, len(text)])
    size = np.minimum(n, WINDOW)
    end = np.arange(1, len(text) + 1)
    begin = end - np.repeat(size, n)
    mean = (running[end] - running[np.maximum(begin, 0)]) / np.repeat(size, n)
    out[text[first], 0] = np.maximum.reduceat(np.where(begin >= np.repeat(first, n), mean, -np.inf), first)
    out[text[first], 1] = np.log(n - size + 1)
    return out


def calibrate(model: KneserNey, x: np.ndarray, y: np.ndarray) -> None:
    """Logistic regression of the label on the features, by Newton steps with a little shrinkage."""
    if len(y) == 0:
        model.weights = np.array([-4.0, 1.0, 0.0])
        return
    model.centre, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[np.ones(len(y)), (x - model.centre) / model.scale]
    beta, ridge = np.zeros(FEATURES + 1), np.diag([1e-6, *[1e-3] * FEATURES]) * len(y)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge
        step = np.linalg.solve(hessian, z.T @ (y - p) - ridge @ beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    model.weights = beta


def scores(model: KneserNey, texts: list[str]) -> np.ndarray:
    z = (features(model, texts) - model.centre) / model.scale
    return 1 / (1 + np.exp(-np.clip(model.weights[0] + z @ model.weights[1:], -30, 30)))


def learn(documents: DataFrame, labels: DataFrame, calibration) -> KneserNey:
    """Models and calibration from documents joined with their labels.

    ``calibration`` is a condition on ``doc_id``: at most CALIBRATION_ROWS of its labelled rows calibrate. Every other
    labelled row is counted, those of the condition that were not chosen included. Rows whose label is neither 0 nor 1 are no training rows, nor are ids that are labelled both ways. The model exists without
    labels too: then every text scores low.
    """
    votes = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    )
    known = votes.where(F.col("toxic") == F.col("most")).select("doc_id", "toxic")
    texts = documents.select("doc_id", "text")
    # a bounded sample, so its ids may be broadcast: the texts need no shuffle a second time
    sample = written(
        known.where(calibration).orderBy(F.xxhash64("doc_id"), "doc_id").limit(CALIBRATION_ROWS), "calibration"
    )
    counting = known.join(F.broadcast(sample.select("doc_id")), "doc_id", "left_anti")
    # only texts that have a label are shuffled: the sketch of the ids, of fixed size, drops most others in the scan.
    # The plan is the same at every size, and its tasks hold many texts, so their sums are worth their shuffle.
    maybe = maybe_in(documents.sparkSession, id_sketch(counting, "doc_id"), "doc_id")
    counted = texts.where(maybe).hint("merge").join(counting, "doc_id")
    model = build_model(count_expressions(counted))
    scored = texts.where(calibration).join(F.broadcast(sample), "doc_id")
    names = [f"feature_{k}" for k in range(FEATURES)]

    def answer(model: KneserNey, batch: pa.RecordBatch, chunk: list[str]) -> pa.RecordBatch:
        x = features(model, chunk)
        columns = [batch.column("toxic"), *[pa.array(x[:, k]) for k in range(FEATURES)]]
        return pa.RecordBatch.from_arrays(columns, names=["toxic", *names])

    schema = "toxic int, " + ", ".join(f"{name} double" for name in names)
    rows = answered(scored.select(F.col("toxic").cast("int").alias("toxic"), "text"), model, answer, schema)
    found = rows.toArrow()
    order = np.lexsort([found[k].to_numpy() for k in (*names, "toxic")])
    x = np.stack([found[k].to_numpy() for k in names], axis=1)[order]
    calibrate(model, x, found["toxic"].to_numpy()[order])
    return model


def score_documents(documents: DataFrame, model: KneserNey) -> DataFrame:
    """(doc_id, score, predicted) of every whole text.

    A null, empty or wordless text has the score of a text without evidence. Repeated rows are answered repeatedly, a null
    id stays null, other columns are not read. Narrow with a model that was broadcast.
    """

    def answer(model: KneserNey, batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        s = scores(model, texts)
        columns = [batch.column("doc_id"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return answered(rows, model, answer, "doc_id bigint, score double, predicted int")


def drop_toxic(documents: DataFrame, model: KneserNey) -> DataFrame:
    """The documents, all columns, that score below the threshold.

    Rows are judged where they lie, so repeated rows and null ids need no care, and columns may be called anything; a null,
    empty or wordless text is judged as in :func:`score_documents`. An empty table stays empty.
    """

    def answer(model: KneserNey, batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        return batch.filter(pa.array(scores(model, texts) < THRESHOLD))

    return answered(documents, model, answer, T.StructType(documents.schema.fields))
