"""Licence scans: one Aho-Corasick pass finds notice phrases and identifier tags; expressions are parsed and evaluated.

The automaton runs over a text's words, lower-cased and joined by single blanks, so line breaks and punctuation inside a
notice don't matter. Where it meets an identifier tag, the expression after the tag is read from the raw text, brought
into postfix order by a shunting-yard parser (WITH binds before AND, AND before OR), and evaluated: what it allows is
simplified, and whether a set of accepted licences is enough can be asked of it.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cambio.llm.common import map_rows, text_chunks

# The phrases that must be found, with their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Further notice phrases, in words as above, with the label they add.
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "all rights reserved": "proprietary",
}
TAG_WORDS = "spdx license identifier"
TAG = re.compile(r"spdx-license-identifier\s*:[ \t]*([^\r\n]*)", re.IGNORECASE)
EXPRESSION_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+-]*|\S")
IDENTIFIER = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+-]*")
OPERATORS = {"or": 1, "and": 2, "with": 3}

#: How much one kind of evidence says: a valid identifier tag, a base phrase, another notice.
TAG_WEIGHT, BASE_WEIGHT, NOTICE_WEIGHT = 0.9, 0.7, 0.5

# Word characters are ASCII digits, lower-case letters and everything beyond ASCII; the rest separates words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """The words of a text, A-Z in lower case, in UTF-8."""
    return text.encode().translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Choice:
    """What an expression allows, written out in a fixed order, and the licences that it names."""

    text: str
    names: tuple[str, ...]


@dataclass(frozen=True)
class Formula:
    """A licence (no kind), or the alternatives (or) or joint requirements (and) of ``parts``, by their text."""

    text: str
    kind: str = ""
    parts: dict[str, Formula] = field(default_factory=dict)


@dataclass
class Growing:
    """A formula whose parts are still being collected, so that a chain of one operator costs one step a part."""

    kind: str
    parts: dict[str, Formula]

    def closed(self) -> Formula:
        """Without repeated parts, and without parts that hold another part: ``x or (x and y)`` is ``x``."""
        kept = {text: f for text, f in self.parts.items() if not any(inner in self.parts for inner in f.parts)}
        if len(kept) == 1:
            return next(iter(kept.values()))
        written = [text if not f.kind else f"({text})" for text, f in sorted(kept.items())]
        return Formula(f" {self.kind} ".join(written), self.kind, kept)


def _closed(node: Formula | Growing) -> Formula:
    return node.closed() if isinstance(node, Growing) else node


def _joined(kind: str, left: Formula | Growing, right: Formula | Growing) -> Growing:
    def growing(node: Formula | Growing) -> Growing:
        if isinstance(node, Growing) and node.kind == kind:
            return node
        whole = _closed(node)
        return Growing(kind, dict(whole.parts) if whole.kind == kind else {whole.text: whole})

    small, large = sorted((growing(left), growing(right)), key=lambda g: len(g.parts))
    large.parts.update(small.parts)
    return large


class BadExpression(ValueError):
    """The text after a tag is no licence expression."""


def postfix(expression: str) -> list[str]:
    """Shunting-yard: identifiers and operators in postfix order. Reads up to the first token that can't follow."""
    output: list[str] = []
    waiting: list[str] = []
    operand_next, depth = True, 0
    for token in EXPRESSION_TOKEN.findall(expression):
        word = token.lower()
        if token == "(":
            if not operand_next:
                break
            waiting.append(token)
            depth += 1
        elif token == ")":
            if operand_next or not depth:
                break
            depth -= 1
            while waiting[-1] != "(":
                output.append(waiting.pop())
            waiting.pop()
        elif word in OPERATORS:
            if operand_next:
                raise BadExpression(expression)
            while waiting and waiting[-1] != "(" and OPERATORS[waiting[-1]] >= OPERATORS[word]:
                output.append(waiting.pop())
            waiting.append(word)
            operand_next = True
        else:
            if not operand_next or not IDENTIFIER.fullmatch(token):
                break  # running text or a comment's end after the expression
            output.append(word)
            operand_next = False
    if operand_next or depth:
        raise BadExpression(expression)
    return output + waiting[::-1]


def evaluate(expression: str) -> Choice:
    """What a licence expression allows. ``with`` attaches an exception to one licence.

    The effort grows with the length of the expression, however many ways to comply it has; none are enumerated.
    """
    stack: list[Formula | Growing] = []
    names: list[str] = []
    for token in postfix(expression):
        if token not in OPERATORS:
            stack.append(Formula(token))
            names.append(token)
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            licence, exception = _closed(left), _closed(right)
            if licence.kind or exception.kind or " " in licence.text or " " in exception.text:
                raise BadExpression(expression)
            names.pop()  # the exception came last
            stack.append(Formula(f"{licence.text} with {exception.text}"))
        else:
            stack.append(_joined(token, left, right))
    return Choice(_closed(stack.pop()).text, tuple(dict.fromkeys(names)))


def complies(expression: str, accepted: Collection[str]) -> bool:
    """Whether following the accepted licences (lower case, a licence with an exception as ``x with y``) is enough."""
    stack: list[tuple[str, bool]] = []
    for token in postfix(expression):
        if token not in OPERATORS:
            stack.append((token, token in accepted))
            continue
        (right, second), (left, first) = stack.pop(), stack.pop()
        if token == "with":
            name = f"{left} with {right}"
            stack.append((name, name in accepted))
        else:
            stack.append(("", first or second if token == "or" else first and second))
    return stack.pop()[1]


def family(identifier: str) -> str:
    """The label of an identifier: the licence without version and exception, such as ``gpl`` for ``gpl-2.0-only``."""
    name = identifier.split(" ")[0]
    name = re.sub(r"-(only|or-later)$", "", name)
    return re.sub(r"-?v?[0-9][0-9.]*\+?$", "", name) or name


class Scanner:
    """The automaton over all phrases, each with a blank at both ends so that only whole words match."""

    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for phrase in {**BASE_PHRASES, **NOTICE_PHRASES, TAG_WORDS: ""}:
            self.automaton.add_word(f" {phrase} ", phrase)
        self.automaton.make_automaton()

    def scan(self, text: str) -> dict:
        """Word count, base places with their labels, all labels, parsed tags, score."""
        words = words_of(text)
        # a blank stands between words, and pieces overlap by it, so neighbours share it
        joined = f" {b' '.join(words).decode()} "
        places: list[tuple[int, str]] = []
        base, more, tagged = set(), set(), False
        at, word = 0, 0
        # the end of a match tells its start; matches come in the order of their ends
        for end, phrase in self.automaton.iter(joined):
            if phrase == TAG_WORDS:
                tagged = True
            elif phrase in BASE_PHRASES:
                first = end - len(phrase) - 1
                word += joined.count(" ", at, first) if first >= at else -joined.count(" ", first, at)
                at = first
                places.append((word, phrase))
                base.add(BASE_PHRASES[phrase])
            else:
                more.add(NOTICE_PHRASES[phrase])
        choices = self.tags(text) if tagged else []
        named = {family(name) for choice in choices for name in choice.names}
        miss = (1 - TAG_WEIGHT) if choices else 1.0
        miss *= (1 - BASE_WEIGHT) ** len(base) * (1 - NOTICE_WEIGHT) ** len(more)
        starts = [p for p, _ in places]
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min(starts) if starts else None,
            "last_word": max(starts) if starts else None,
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | more | named)),
            "score": 1 - miss if choices or base or more else 0.0,
            "expressions": [choice.text for choice in choices],
        }

    @staticmethod
    def tags(text: str) -> list[Choice]:
        """The expressions of all identifier tags that parse, in order."""
        found = []
        for match in TAG.finditer(text):
            try:
                found.append(evaluate(match[1]))
            except BadExpression:
                continue
        return found


SCAN_SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, expressions array<string>"
)


def scan_licences(documents: DataFrame) -> DataFrame:
    """SCAN_SCHEMA for every whole text; ``expressions`` are the tags' expressions, simplified and in a fixed order.

    ``labels`` has every licence that an expression names, whether or not another way to comply does without it. A null or empty text has no words, no labels and score 0. Overlapping places all count. A tag without a valid
    expression adds nothing. Repeated rows are answered repeatedly, a null id stays null, other columns are not read.
    Narrow: no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        names = [c.split(" ")[0] for c in SCAN_SCHEMA.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]
        for batch, texts in text_chunks(batches):
            rows = [scanner.scan(text) for text in texts]
            columns = [pa.array([row[n] for row in rows], k) for n, k in zip(names[1:], kinds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    return map_rows(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, SCAN_SCHEMA)
