"""Order-preserving packing of token streams into sequences by dynamic programming.

Documents of a partition follow each other as one token stream. Cuts are chosen at document or sentence boundaries
(inside a sentence only where it is too long) so that padding plus truncation penalties are least. With the boundaries
in order, the cost of ending a sequence at j is ``min over i of cost(i) + pos(i)``, i within one sequence length before
j: a sliding-window minimum, kept in a monotone queue. A sequence whose length is a power of two needs no padding; those
transitions are looked up by position.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cambio.llm.bpe import WORD_PATTERN, Vocabulary, load_vocabulary
from cambio.llm.common import map_rows, text_chunks

SEQUENCE_TOKENS = 2048
#: The id that ends every document.
END_ID = 1
#: Costs, in tokens of padding: a cut inside a document at a sentence's end, one inside a sentence, one more sequence.
SENTENCE_CUT = 4
HARD_CUT = 8
PER_SEQUENCE = 512
#: A stretch without a sentence's end that is longer than this may be cut at every HARD_STEP-th token.
LONG_SENTENCE = 64
HARD_STEP = 8
#: Tokens that are planned together; the last sequences of a plan are planned again with what follows.
PLAN_TOKENS = 1 << 18
REPLANNED = 4

OUTPUT = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint"
)


def plan_cuts(positions: np.ndarray, penalties: np.ndarray, size: int = SEQUENCE_TOKENS) -> list[int]:
    """Indexes into ``positions`` at which sequences end, of least total cost.

    ``positions`` rise from 0 to the stream's end, with no gap over ``size``; ``penalties`` are the costs of cutting there.
    """
    exact: dict[int, list[int]] = {}
    power = 1
    while power <= size:
        at = np.searchsorted(positions, positions - power)
        hit = np.flatnonzero((positions >= power) & (positions[np.minimum(at, len(positions) - 1)] == positions - power))
        for j, i in zip(hit.tolist(), at[hit].tolist(), strict=True):
            exact.setdefault(j, []).append(i)
        power *= 2
    where, fines = positions.tolist(), penalties.tolist()
    cost, before = [0.0] * len(where), [0] * len(where)
    keys = [0.0] * len(where)  # cost + position: what the window's minimum is taken of
    queue, head = [0], 0
    for j in range(1, len(where)):
        here = where[j]
        while where[queue[head]] < here - size:
            head += 1
        i = queue[head]
        best = keys[i] + size - here
        if j in exact:
            for k in exact[j]:
                if cost[k] < best:
                    best, i = cost[k], k
        cost[j], before[j] = best + fines[j] + PER_SEQUENCE, i
        key = keys[j] = cost[j] + here
        while len(queue) > head and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(where) - 1
    while j > 0:
        cuts.append(j)
        j = before[j]
    return cuts[::-1]


def boundaries(ids: np.ndarray, document_ends: np.ndarray, ends_sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where the stream may be cut, and what each cut costs."""
    total = len(ids)
    fine = np.full(total + 1, np.inf)
    fine[1:][ends_sentence[ids]] = SENTENCE_CUT
    fine[0] = fine[total] = 0
    fine[document_ends] = 0
    at = np.flatnonzero(np.isfinite(fine))
    for gap in np.flatnonzero(np.diff(at) > LONG_SENTENCE):
        inner = np.arange(at[gap] + HARD_STEP, at[gap + 1], HARD_STEP)
        fine[inner] = np.minimum(fine[inner], HARD_CUT)
    at = np.flatnonzero(np.isfinite(fine))
    return at, fine[at]


def sentence_ends(vocabulary: Vocabulary) -> np.ndarray:
    """Whether a token ends a sentence: its text ends in a full stop, question or exclamation mark, or a line break."""
    marks = (b".", b"!", b"?", b"\n")
    return np.array([t.endswith(marks) for t in vocabulary.tokens])


class Packer:
    """Packs the documents of one task as they come; holds about PLAN_TOKENS tokens, or one document if that is longer."""

    def __init__(self, ends: np.ndarray, task: int):
        self.ends, self.sequence = ends, task << 33
        self.segments: list[tuple] = []  # (doc_id, doc_tokens, ids before the segment, ids)
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.segments.append((doc_id, len(ids), 0, ids))
        self.held += len(ids)

    def flush(self, last: bool) -> list[tuple]:
        """The pieces of the sequences that are decided: all of them if ``last``."""
        if not self.held:
            return []
        lengths = np.array([len(s[3]) for s in self.segments])
        stops = np.cumsum(lengths)
        where, fines = boundaries(np.concatenate([s[3] for s in self.segments]), stops, self.ends)
        cuts = plan_cuts(where, fines)
        if not last:
            cuts = cuts[:-REPLANNED]
        pieces, begin, k = [], 0, 0
        for cut in where[cuts].tolist():
            offset = 0
            while begin < cut:
                doc_id, doc_tokens, before, ids = self.segments[k]
                inside = begin - int(stops[k] - lengths[k])
                length = min(cut, int(stops[k])) - begin
                raw = ids[inside : inside + length].astype("<u4").tobytes()
                pieces.append((doc_id, before + inside, length, zlib.crc32(raw), doc_tokens, self.sequence, offset))
                begin, offset = begin + length, offset + length
                k += begin == int(stops[k])
            self.sequence += 1
        rest = self.segments[k:]
        if rest:
            doc_id, doc_tokens, before, ids = rest[0]
            inside = begin - int(stops[k] - lengths[k])
            rest[0] = (doc_id, doc_tokens, before + inside, ids[inside:])
        self.segments, self.held = rest, self.held - begin
        return pieces


_tokenizers: dict[int, tuple] = {}


def _tokenizer(broadcast) -> tuple[tiktoken.Encoding, np.ndarray]:
    vocabulary = broadcast.value
    if id(vocabulary) not in _tokenizers:
        special = dict(vocabulary.special)
        ranks = {token: i for i, token in enumerate(vocabulary.tokens) if i not in special.values()}
        encoding = tiktoken.Encoding("packing", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        _tokenizers.clear()
        _tokenizers[id(vocabulary)] = encoding, sentence_ends(vocabulary)
    return _tokenizers[id(vocabulary)]


def pack_documents(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """Pieces (OUTPUT) of the sequences into which all documents are packed.

    Every token of every document lies in exactly one piece, a document's pieces follow each other, and the documents of
    a partition keep their order. A null or empty text is the end id alone; repeated rows are packed repeatedly; a null
    id stays null; other columns are not read. An empty table gives no pieces. No shuffle: each task packs what it scans
    and leaves at most a short last sequence. The file's ids are its merge ranks, so a tokenizer by ranks gives them.
    """
    spark = documents.sparkSession
    vocabulary = spark.sparkContext.broadcast(load_vocabulary(tokenizer_path))
    names = [c.split(" ")[0] for c in OUTPUT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, ends = _tokenizer(vocabulary)
        packer = Packer(ends, TaskContext.get().partitionId())

        def out(pieces: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*pieces, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch, texts in text_chunks(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                ids = encoding.encode_to_numpy(text, allowed_special="all")
                packer.add(doc_id, np.append(ids, np.uint32(END_ID)))
                if packer.held >= PLAN_TOKENS:
                    yield out(packer.flush(last=False))
        yield out(packer.flush(last=True))

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return map_rows(rows, run, OUTPUT)
