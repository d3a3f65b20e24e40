import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cambio.llm.bpe import Encoder, encode_documents, load_vocabulary, token_digests
from tests.llm.helpers import HAVE_TABLES, ODD_TEXTS, SF_DIR, odd_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@pytest.fixture(scope="module")
def encoder():
    return Encoder(load_vocabulary(PATH))


def test_odd_texts(encoder, library):
    texts = [t or "" for _, t, _ in ODD_TEXTS]
    texts += ["a<|endoftext|> \n b  c<|endoftext|><|endoftext|>", "aaaa" * 300, "'s 're I'LL 12½", " " * 300 + "x", "ſİ​\r\n\t"]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert list(ids) == library.encode(text, add_special_tokens=False).ids
        assert encoder.decode(ids) == text


def test_random_texts(encoder, library):
    r = random.Random(3)
    letters = "ab zé\n!1日́'st  \U0001f600"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(400)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert list(ids) == library.encode(text, add_special_tokens=False).ids


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr("cambio.llm.bpe.REMEMBERED_WORDS", 3)
    small = Encoder(load_vocabulary(PATH))
    for text in ["some words here", "and some more words", "some words here"]:
        assert list(small.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_documents(spark, library):
    docs = odd_documents(spark)
    got = sorted(token_digests(docs, PATH).collect(), key=repr)
    expected = []
    for doc_id, text, _ in ODD_TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    full = encode_documents(docs, PATH)
    assert full.columns == ["doc_id", "ids", "decoded"]
    assert sorted(r.decoded for r in full.collect()) == sorted(t or "" for _, t, _ in ODD_TEXTS)
    assert token_digests(docs.where("false"), PATH).count() == 0


@pytest.mark.skipif(not HAVE_TABLES, reason="no driver tables")
def test_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in token_digests(docs, PATH).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
