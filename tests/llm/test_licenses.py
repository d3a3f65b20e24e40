import random
import re
import time

import pytest

from cambio.llm.licenses import BASE_PHRASES, BadExpression, Scanner, complies, evaluate, family, postfix, scan_licences
from tests.llm.helpers import HAVE_TABLES, ODD_TEXTS, SF_DIR, odd_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in BASE_PHRASES.items():
        wanted = phrase.split()
        for i in range(len(words) - len(wanted) + 1):
            if words[i : i + len(wanted)] == wanted:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def base(row):
    return row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]


def text_of(expression):
    return evaluate(expression).text


def test_expressions():
    assert postfix("a OR b AND c WITH d") == ["a", "b", "c", "d", "with", "and", "or"]
    assert postfix("(a OR b) AND c") == ["a", "b", "or", "c", "and"]
    assert text_of("MIT") == "mit"
    assert text_of("MIT or Apache-2.0 */ rest") == "apache-2.0 or mit"
    assert text_of("(Z OR Y) AND (MIT OR X)") == "(mit or x) and (y or z)"
    assert text_of("GPL-2.0 WITH Classpath-exception-2.0") == "gpl-2.0 with classpath-exception-2.0"
    assert text_of("a AND a OR a") == text_of("a OR a AND b") == text_of("a AND (b OR a)") == "a"
    assert text_of("c or ((a or b) and (b or a))") == "a or b or c"
    for bad in ("", "AND", "a OR", "(a", "OR a", "(a OR b) WITH c", "a AND )", "a WITH b WITH c", "a WITH (b OR c)"):
        with pytest.raises(BadExpression):
            evaluate(bad)
    assert evaluate("a or (a and b with c) and d").names == ("a", "b", "d")


def random_expression(rng, depth):
    if depth == 0 or rng.random() < 0.2:
        return rng.choice("abcde") if rng.random() < 0.8 else rng.choice("ab") + " with x"
    parts = [random_expression(rng, depth - 1) for _ in range(rng.choice([2, 2, 3]))]
    return "(" + f" {rng.choice(['or', 'and'])} ".join(parts) + ")"


@pytest.mark.parametrize("seed", range(100))
def test_expressions_mean_what_they_say(seed):
    """Under every set of accepted licences; the simplified text means the same, and is its own simplification."""
    expression = random_expression(random.Random(seed), 4)
    short = evaluate(expression)
    atoms = ["a", "b", "c", "d", "e", "a with x", "b with x"]
    assert set(short.names) == set(re.findall(r"\b[a-e]\b", expression))
    assert evaluate(short.text).text == short.text and len(short.text) <= len(expression)
    python = re.sub(r"\b([a-e])( with x)?\b", lambda m: f"('{m[0]}' in s)", expression)
    for bits in range(1 << len(atoms)):
        s = {a for k, a in enumerate(atoms) if bits >> k & 1}
        assert complies(expression, s) == complies(short.text, s) == eval(python, {"s": s})


def test_long_expressions():
    """Chains and nests of any length, with every licence named and no size from which on another rule holds."""
    start = time.monotonic()
    for op in ("or", "and"):
        chain = evaluate(f" {op} ".join(f"id{i}x" for i in range(100_000)))
        assert len(chain.names) == 100_000 and chain.text.count(f" {op} ") == 99_999
        right = "".join(f"(a{i}x {op} " for i in range(20_000)) + "z" + ")" * 20_000
        assert len(evaluate(right).names) == 20_001
    assert text_of("(" * 30_000 + "a" + ")" * 30_000) == "a"
    many = " AND ".join(f"(a{i}x OR b{i}x)" for i in range(2_000))
    assert len(evaluate(many).names) == 4_000
    nested = "z"
    for i in range(2_000):
        nested = f"(n{i}x {'or' if i % 2 else 'and'} {nested})"
    assert len(evaluate(nested).names) == 2_001
    assert time.monotonic() - start < 20
    nine = " and ".join(f"(p{i}x or q{i}x)" for i in range(9))
    labels = lambda text: Scanner().scan(f"SPDX-License-Identifier: {text}")["labels"].split(",")
    for k in (1, 9):
        some = " and ".join(nine.split(" and ")[:k])
        found = labels(f"(gpl-2.0-only with classpath-exception-2.0 or mit) and {some}")
        assert "classpath-exception" not in found and {"gpl", "mit"} <= set(found) and len(found) == 2 + 2 * k


def test_families():
    names = {"GPL-2.0-only": "gpl", "apache-2.0": "apache", "mit": "mit", "bsd-3-clause": "bsd-3-clause", "lgpl-3.0-or-later": "lgpl"}
    assert {k: family(k.lower()) for k in names} == names
    assert family("gpl-2.0 with classpath-exception-2.0") == "gpl"


def test_scan():
    scanner = Scanner()
    row = scanner.scan("// SPDX-License-Identifier: (MIT OR Apache-2.0)\nunder the MIT\nLicense, mit license")
    assert base(row) == brute("// SPDX-License-Identifier: (MIT OR Apache-2.0)\nunder the MIT\nLicense, mit license")
    assert row["base_labels"] == "mit" and row["labels"] == "apache,mit" and 0.9 < row["score"] <= 1
    assert row["expressions"] == ["apache-2.0 or mit"]
    assert scanner.scan("spdx license identifier: none of these")["labels"] == ""
    assert scanner.scan("GNU Lesser General Public License")["labels"] == "lgpl"


@pytest.mark.parametrize("seed", range(20))
def test_places_equal_brute_force(seed):
    r = random.Random(seed)
    pool = "gnu general public license apache cc by mit MIT License é ſ İ x - , \n cc-by".split(" ")
    text = " ".join(r.choice(pool) for _ in range(300))
    assert base(Scanner().scan(text)) == brute(text)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = scan_licences(docs).collect()
    assert len(got) == len(ODD_TEXTS)
    wanted = sorted((brute(t) for _, t, _ in ODD_TEXTS), key=repr)
    assert sorted((base(r.asDict()) for r in got), key=repr) == wanted
    assert scan_licences(docs.where("false")).count() == 0


@pytest.mark.skipif(not HAVE_TABLES, reason="no driver tables")
def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(base(r.asDict()) == brute(texts[r.doc_id]) for r in scan_licences(docs).collect())
