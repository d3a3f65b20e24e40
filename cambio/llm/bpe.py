"""Byte-level BPE: encoding by batched merge rounds over one flat symbol array, and decoding.

The vocabulary file is read on the driver and broadcast; its size does not depend on the data.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cambio.llm.common import map_rows, text_chunks

# Fixed value of the tokenizer format: how a text is cut into words before merging.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words whose ids a worker remembers at most; beyond it, the memory starts anew.
REMEMBERED_WORDS = 400_000

NO_RANK = np.int64(1 << 40)


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by id, merges as (left id, right id, merged id) in rank order, and special texts with their ids."""

    tokens: tuple[bytes, ...]
    merges: np.ndarray
    special: tuple[tuple[str, int], ...]


def printable_bytes() -> dict[str, int]:
    """The format writes each byte as one printable character: itself if printable, else 256 and up, in byte order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, byte_of = content["model"], printable_bytes()
    special = tuple((t["content"], t["id"]) for t in content["added_tokens"])
    size = 1 + max([*model["vocab"].values(), *[i for _, i in special]])
    tokens = [b""] * size
    for text, i in model["vocab"].items():
        tokens[i] = bytes(byte_of[c] for c in text) if all(c in byte_of for c in text) else text.encode()
    for text, i in special:
        tokens[i] = text.encode()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    vocab = model["vocab"]
    merges = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], dtype=np.int64).reshape(-1, 3)
    return Vocabulary(tuple(tokens), merges, special)


class Encoder:
    """Encodes texts with a vocabulary. Words seen before are looked up; the new words of a chunk are merged together."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words = regex.compile(WORD_PATTERN)
        self.special = dict(vocabulary.special)
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None
        keys = vocabulary.merges[:, 0] << 20 | vocabulary.merges[:, 1]
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int64)
        self.merged = vocabulary.merges[:, 2]
        byte_ids = {token: i for i, token in enumerate(vocabulary.tokens) if len(token) == 1}
        self.byte_ids = np.array([byte_ids[bytes([b])] for b in range(256)], dtype=np.int64)
        lengths = np.array([len(t) for t in vocabulary.tokens], dtype=np.int64)
        self.token_lengths, self.token_starts = lengths, np.cumsum(lengths) - lengths
        self.token_bytes = np.frombuffer(b"".join(vocabulary.tokens), dtype=np.uint8)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.starts, self.lengths = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.number) > REMEMBERED_WORDS:
            self.forget()
        number, fresh = self.number, []

        def of(word: str) -> int:
            known = number.get(word)
            if known is None:
                known = number[word] = len(number)
                fresh.append(word)
            return known

        rows = [list(map(of, self.split(text))) for text in texts]
        if fresh:
            self.learn(fresh)
        return [self.gather(np.array(row, dtype=np.int64)) for row in rows]

    def split(self, text: str) -> list[str]:
        if self.cut is None or not any(t in text for t in self.special):
            return self.words.findall(text)
        words: list[str] = []
        for part in self.cut.split(text):
            words += [part] if part in self.special else self.words.findall(part)
        return words

    def learn(self, fresh: list[str]) -> None:
        raw = [word.encode() for word in fresh]
        ids, lengths = self.merge_rounds(raw)
        for k, word in enumerate(fresh):
            if word in self.special:  # its bytes were merged as ordinary text; here it stands for itself
                first = int(lengths[:k].sum())
                ids = np.concatenate([ids[:first], [self.special[word]], ids[first + lengths[k] :]])
                lengths[k] = 1
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        self.starts, self.lengths = np.concatenate([self.starts, starts]), np.concatenate([self.lengths, lengths])

    def merge_rounds(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, flat, and their number per word.

        All symbols lie in one array. A round finds each word's pair of lowest rank, by binary search over the sorted
        pair keys, and merges every place of it (left to right where places overlap). Words without a pair leave.
        """
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_owner = [], []
        while len(symbols):
            ranks = np.full(len(symbols), NO_RANK)
            inside = np.flatnonzero(owner[:-1] == owner[1:])
            keys = symbols[inside] << 20 | symbols[inside + 1]
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            found = self.pair_keys[at] == keys
            ranks[inside[found]] = self.pair_ranks[at[found]]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(ranks, first)
            per_symbol = np.repeat(best, np.diff(np.r_[first, len(owner)]))
            ended = per_symbol == NO_RANK
            if ended.any():
                done_symbols.append(symbols[ended])
                done_owner.append(owner[ended])
            hits = (ranks == per_symbol) & ~ended
            # of overlapping places (runs of equal symbols) take every other one, from the left
            places = np.flatnonzero(hits)
            new_run = np.r_[True, np.diff(places) > 1]
            in_run = np.arange(len(places)) - np.flatnonzero(new_run)[np.cumsum(new_run) - 1]
            places = places[in_run % 2 == 0]
            symbols = symbols.copy()
            symbols[places] = self.merged[ranks[places]]
            keep = ~ended
            keep[places + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if not done_symbols:
            return np.empty(0, np.int64), np.zeros(len(words), np.int64)
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        return symbols[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def gather(self, row: np.ndarray) -> np.ndarray:
        return _spans(self.flat, self.starts[row], self.lengths[row])

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, special tokens included; bytes that are no UTF-8 become replacement characters."""
        raw = _spans(self.token_bytes, self.token_starts[ids], self.token_lengths[ids])
        return raw.tobytes().decode("utf-8", "replace")


def _spans(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[start : start + length] of each span, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


_encoders: dict[int, Encoder] = {}


def encoder_of(broadcast) -> Encoder:
    """One encoder per worker and broadcast vocabulary."""
    if broadcast.value is not None and id(broadcast.value) not in _encoders:
        _encoders.clear()
        _encoders[id(broadcast.value)] = Encoder(broadcast.value)
    return _encoders[id(broadcast.value)]


def encode_documents(documents: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every document: its token ids and the text they decode to.

    A null or empty text has no ids and decodes to the empty text. Rows are independent: repeated rows stay, a null id
    stays null, other columns are not read. Narrow, no shuffle.
    """
    return _map_texts(documents, tokenizer_path, text, "ids array<int>, decoded string", _id_columns)


def token_digests(documents: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the same, reduced to digests where the ids are made."""
    return _map_texts(
        documents, tokenizer_path, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", _digest_columns
    )


def _id_columns(encoder: Encoder, rows: list[np.ndarray]) -> list[pa.Array]:
    return [
        pa.array([row.astype(np.int32) for row in rows], pa.list_(pa.int32())),
        pa.array([encoder.decode(row) for row in rows], pa.string()),
    ]


def _digest_columns(encoder: Encoder, rows: list[np.ndarray]) -> list[pa.Array]:
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    return [
        pa.array([len(row) for row in rows], pa.int64()),
        pa.array([sha(row.astype("<u4").tobytes()) for row in rows], pa.string()),
        pa.array([sha(encoder.decode(row).encode()) for row in rows], pa.string()),
    ]


def _map_texts(documents: DataFrame, tokenizer_path: str, text: str, columns: str, derive) -> DataFrame:
    spark = documents.sparkSession
    vocabulary = spark.sparkContext.broadcast(load_vocabulary(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        for batch, texts in text_chunks(batches):
            derived = derive(encoder, encoder.encode(texts))
            names = ["doc_id", *[c.split(" ")[0] for c in columns.split(", ")]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *derived], names=names)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return map_rows(rows, run, f"doc_id bigint, {columns}")
