import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cambio.llm import packing
from cambio.llm.packing import END_ID, PER_SEQUENCE, SEQUENCE_TOKENS, pack_documents, plan_cuts
from tests.llm.helpers import HAVE_TABLES, ODD_TEXTS, SF_DIR, odd_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def cost(length, size):
    return 0 if length & (length - 1) == 0 else size - length


def cheapest(positions, penalties, size):
    best = [0.0]
    for j in range(1, len(positions)):
        best.append(
            min(
                best[i] + cost(positions[j] - positions[i], size) + penalties[j] + PER_SEQUENCE
                for i in range(j)
                if positions[j] - positions[i] <= size
            )
        )
    return best[-1]


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_cheapest(seed):
    r = random.Random(seed)
    size = r.choice([8, 64, 256])
    positions = [0]
    while len(positions) < 60:
        positions.append(positions[-1] + r.randint(1, size))
    penalties = [0] + [r.choice([0, 4, 48]) for _ in positions[1:]]
    cuts = plan_cuts(np.array(positions), np.array(penalties, float), size)
    assert cuts[-1] == len(positions) - 1
    total, before = 0, 0
    for j in cuts:
        length = positions[j] - positions[before]
        assert 0 < length <= size
        total, before = total + cost(length, size) + penalties[j] + PER_SEQUENCE, j
    assert total == cheapest(positions, penalties, size)


def check_pieces(pieces, texts):
    """Every id of every document in exactly one piece; sequences gapless and within the limit."""
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for sequence in by_sequence.values():
        offset = 0
        for p in sorted(sequence, key=lambda p: p.offset):
            assert p.offset == offset and p.length > 0
            offset += p.length
        assert offset <= SEQUENCE_TOKENS
    wanted = {}
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]
        wanted.setdefault(doc_id, []).append(ids)
    assert set(by_doc) == set(wanted)
    for doc_id, copies in wanted.items():
        found = sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in by_doc[doc_id])
        if len(copies) == 1:
            at = 0
            for start, length, crc, total in found:
                assert start == at and total == len(copies[0])
                assert crc == zlib.crc32(np.array(copies[0][at : at + length], "<u4").tobytes())
                at += length
            assert at == len(copies[0])
        else:
            assert sum(length for _, length, _, _ in found) == sum(map(len, copies))
    return by_sequence


def test_odd_documents(spark):
    docs = odd_documents(spark).coalesce(1)
    check_pieces(pack_documents(docs, PATH).collect(), [(i, t) for i, t, _ in ODD_TEXTS])
    assert pack_documents(docs.where("false"), PATH).count() == 0
    only = pack_documents(odd_documents(spark, [(9, None, "en")]), PATH).collect()
    assert [(p.doc_id, p.start, p.length, p.doc_tokens, p.offset) for p in only] == [(9, 0, 1, 1, 0)]


def test_plans_that_follow_each_other(spark, monkeypatch):
    """A small planning size: documents and sequences reach across plans."""
    texts = [(i, "Some words and then a stop. " * (i * 37 % 90)) for i in range(60)]
    monkeypatch.setattr(packing, "PLAN_TOKENS", 6000)
    packer_inputs = odd_documents(spark, [(i, t, "en") for i, t in texts]).coalesce(1)
    by_sequence = check_pieces(pack_documents(packer_inputs, PATH).collect(), texts)
    assert len(by_sequence) > 5


@pytest.mark.skipif(not HAVE_TABLES, reason="no driver tables")
def test_little_padding(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pieces = pack_documents(docs, PATH).collect()
    by_sequence = check_pieces(pieces, [(r.doc_id, r.text) for r in docs.collect()])
    lengths = [sum(p.length for p in s) for s in by_sequence.values()]
    padding = sum(cost(n, SEQUENCE_TOKENS) for n in lengths)
    assert padding <= 0.02 * sum(lengths)
    order = [p.doc_id for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset))]
    assert order == sorted(order, key=[r.doc_id for r in docs.collect()].index)
