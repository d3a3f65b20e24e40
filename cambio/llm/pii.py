"""Personal data: patterns, and terms that reveal whom the patterns protect. DataFrame functions only.

Entities are the addresses and numbers that the patterns find. A term that stands in the same documents as an entity,
wherever in them, may give the entity away even where the entity itself is masked. How much it reveals is estimated from
the corpus: the pointwise mutual information of term and entity, as a share of the entity's information content. All counts
are of different texts. The estimate is shrunk by one observation that knows nothing, and has to stand against chance with
as many trials as the corpus has different terms or texts, so a word that met an entity once proves nothing at any size.
Every place of a term above GENERALISE, in each document of the entity, is replaced by a general word, of terms above REMOVE
taken out. Terms are looked for in what the patterns leave of a text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cambio.llm.common import written

# The four patterns, written so that no repetition backtracks (the matches are the same). A match can only
# begin where a run of its characters begins, or where the last match ended.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without this has no match, so the pattern need not be tried.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
KINDS = tuple(PATTERNS)
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

TERM = r"\p{L}{3,}"
#: Chance that any term of the corpus seems to reveal an entity that it has nothing to do with.
SIGNIFICANCE = 0.05
GENERALISE = 0.5
REMOVE = 0.8
#: Arrays are run through in blocks of this size, see :func:`running`; a power of two.
BLOCK_BITS = 8
BLOCK = 1 << BLOCK_BITS
#: Words of 64 bits in the sketch of repeated texts: 1 MB.
SKETCH_WORDS = 1 << 17

SPAN = "struct<start:int,end:int,value:string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether 13 to 19 digits pass the checksum: from the right, every other digit is doubled, less 9 above 9."""
    back = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(back)),
        F.lit(0),
        lambda acc, i: acc + _luhn_digit(F.substring(back, i, F.lit(1)).cast("int"), i),
    )
    return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(False)


def _luhn_digit(digit: Column, place: Column) -> Column:
    twice = digit * 2
    return F.when(place % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        # a leading zero does not make a part larger; more than three digits after it do
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(
            F.split(value, r"\."),
            lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255),
        )
    if kind == "card":
        return _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _is_valid(kind: str):
    return lambda span: _valid(kind, span["value"])


def located(text: Column, pattern: str) -> tuple[Column, Column]:
    """Matches of a pattern in order, and the pieces between them."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """The running combination (sum, maximum) of an array of numbers from 0 on; ``values`` should be bound.

    An array grows by being copied, so appending to one result would take the square of its length. Here blocks are run
    through on their own, and what precedes each block is added afterwards.
    """
    nothing = F.array().cast("array<int>")
    empty = F.struct(F.lit(0).alias("last"), nothing.alias("out"))

    def step(acc: Column, value: Column) -> Column:
        now = combine(acc["last"], value)
        return F.struct(now.alias("last"), F.array_append(acc["out"], now).alias("out"))

    def shifted(blocks: Column) -> Column:
        before = F.aggregate(
            blocks,
            empty,
            lambda acc, b: F.struct(
                combine(acc["last"], b["last"]).alias("last"), F.array_append(acc["out"], acc["last"]).alias("out")
            ),
            lambda acc: acc["out"],
        )
        add = lambda all_before: F.transform(
            blocks, lambda b, i: F.transform(b["out"], lambda value: combine(F.get(all_before, i), value))
        )
        return F.flatten(bound(before, add))

    number = F.shiftright(F.size(values) - 1, BLOCK_BITS)
    blocks = F.transform(
        F.sequence(F.lit(0), number), lambda b: F.aggregate(F.slice(values, b * BLOCK + 1, F.lit(BLOCK)), empty, step)
    )
    return F.when(F.size(values) > 0, bound(blocks, shifted)).otherwise(nothing)


def placed(matches: Column, pieces: Column) -> Column:
    """SPANs of the matches: code points from 0, the end exclusive."""

    def spans(found: Column) -> Column:
        lengths = F.transform(found["matches"], lambda m, i: F.length(F.get(found["pieces"], i)) + F.length(m))
        ends = bound(lengths, lambda values: running(values, lambda a, b: a + b))

        def span(ends: Column) -> Column:
            return F.transform(
                found["matches"],
                lambda m, i: F.struct(
                    (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("value")
                ),
            )

        return bound(ends, span)

    found = F.struct(matches.alias("matches"), pieces.alias("pieces"))
    return F.when(F.size(matches) > 0, bound(found, spans)).otherwise(F.array().cast(f"array<{SPAN}>"))


def with_base_spans(documents: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_email``, ``_ip``, ``_card``, ``_phone``: the valid spans of each kind. A null text has none."""
    full = F.coalesce(F.col(text), F.lit(""))
    for kind, pattern in PATTERNS.items():
        matches, pieces = located(full, pattern)
        nothing = F.array().cast("array<string>")
        tried = F.when(full.contains(NEEDS[kind]), matches).otherwise(nothing) if kind in NEEDS else matches
        documents = documents.withColumn(f"_{kind}_found", tried)
        documents = documents.withColumn(
            f"_{kind}",
            F.filter(
                F.when(F.size(f"_{kind}_found") > 0, placed(F.col(f"_{kind}_found"), pieces)).otherwise(
                    F.array().cast(f"array<{SPAN}>")
                ),
                _is_valid(kind),
            ),
        ).drop(f"_{kind}_found")
    return documents


def _has_spans() -> Column:
    return F.greatest(*[F.size(f"_{kind}") for kind in KINDS]) > 0


MASKS = "array<struct<start:int,shorter:int,word:string>>"


def replaced(text: Column, masks: Column, fill: Callable[[Column], Column] = lambda place: place["word"]) -> Column:
    """The text with MASKS put in place; masks that overlap are one, under the word of the first, of those the longest.

    ``shorter`` is minus the end; ``fill`` makes what stands at a place of (start, end, word) instead. The effort grows with the text and the number of masks, not with their product: the text
    is cut into blocks first, and a piece is taken from its own blocks.
    """

    def build(found: Column) -> Column:
        masks, reach, blocks = found["masks"], found["reach"], found["blocks"]
        # a mask that begins at or after all earlier ones have ended begins a new place
        heads = F.filter(
            F.sequence(F.lit(0), F.size(masks) - 1),
            lambda i: F.coalesce(F.get(reach, i - 1) <= F.get(masks, i)["start"], F.lit(True)),
        )

        def piece(begin: Column, end: Column) -> Column:
            first = F.shiftright(begin, BLOCK_BITS)
            count = F.shiftright(end - 1, BLOCK_BITS) - first + 1

            def cut(block: Column, k: Column) -> Column:
                at = (first + k) * BLOCK
                low = F.greatest(begin - at, F.lit(0))
                return F.substring(block, low + 1, F.least(end - at, F.lit(BLOCK)) - low)

            return F.when(end > begin, F.array_join(F.transform(F.slice(blocks, first + 1, count), cut), "")).otherwise("")

        def places(heads: Column) -> Column:
            last = lambda k: F.coalesce(F.get(heads, k + 1), F.size(masks)) - 1
            return F.transform(
                heads,
                lambda i, k: F.struct(
                    F.get(masks, i)["start"].alias("start"),
                    F.get(reach, last(k)).alias("end"),
                    F.get(masks, i)["word"].alias("word"),
                ),
            )

        def joined(places: Column) -> Column:
            parts = F.transform(
                places,
                lambda p, k: F.concat(piece(F.coalesce(F.get(places, k - 1)["end"], F.lit(0)), p["start"]), fill(p)),
            )
            end = F.get(places, F.size(places) - 1)["end"]
            return F.concat(F.array_join(parts, ""), piece(end, found["length"]))

        return bound(bound(heads, places), joined)

    def with_reach(sorted_masks: Column) -> Column:
        ends = F.transform(sorted_masks, lambda m: -m["shorter"])
        return F.struct(
            sorted_masks.alias("masks"),
            bound(ends, lambda values: running(values, F.greatest)).alias("reach"),
            F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("blocks"),
            F.length(text).alias("length"),
        )

    return F.when(F.size(masks) > 0, bound(bound(F.array_sort(masks), with_reach), build)).otherwise(text)


def _masks(spans: Column, word: Callable[[Column], Column]) -> Column:
    return F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("shorter"), word(s).alias("word"))
    )


def blanked(text: Column) -> Column:
    """The text with blanks in place of its base spans, as long as before."""
    spans = F.concat(*[_masks(F.col(f"_{kind}"), lambda s: F.lit(" ")) for kind in KINDS])
    return replaced(text, spans, lambda place: F.repeat(F.lit(" "), place["end"] - place["start"]))


def term_words(text: Column) -> Column:
    """The different terms of a text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def entity_contexts(rows: DataFrame, carry: Sequence[str], text: str = "text") -> DataFrame:
    """(carry, spans by kind, text_key, entities, words, rest) of every row.

    The last three are the different entities of the text, its different terms outside the base spans, and the text with
    blanks in place of these; all four are null without spans.
    """
    rows = with_base_spans(rows.withColumn("full", F.coalesce(F.col(text), F.lit(""))), "full")

    def entity(kind: str):
        def make(span: Column) -> Column:
            value = F.lower(span["value"]) if kind == "email" else _digits(span["value"])
            return F.concat(F.lit(f"{kind}:"), span["value"] if kind == "ip" else value)

        return make

    entities = F.array_distinct(F.concat(*[F.transform(f"_{kind}", entity(kind)) for kind in KINDS]))
    some = rows.withColumn("rest", F.when(_has_spans(), blanked(F.col("full"))))
    return some.select(
        *carry,
        *[f"_{kind}" for kind in KINDS],
        F.when(_has_spans(), F.xxhash64("full")).alias("text_key"),
        F.when(_has_spans(), entities).alias("entities"),
        F.when(_has_spans(), term_words(F.col("rest"))).alias("words"),
        "rest",
    )


def occurrences(contexts: DataFrame) -> DataFrame:
    """(text_key, entities, words) of every different text with entities; copies collapse in each task first."""
    some = contexts.where("text_key IS NOT NULL").groupBy("text_key")
    return some.agg(F.first("entities").alias("entities"), F.first("words").alias("words"))


def different_texts(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(text): every different text once; ``keys`` (text_key, n) tells how often each one's hash occurs.

    A sketch of fixed size of the hashes that occur again is broadcast: texts that are not in it pass the scan, only the
    others are brought together by their hash.
    """
    bits = SKETCH_WORDS * 64
    place = F.pmod("text_key", F.lit(bits))
    sketch = (
        keys.where("n > 1")
        .select(F.floor(place / 64).cast("bigint").alias("word"), (place % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    )
    keyed = texts.select("text", F.xxhash64("text").alias("text_key"))
    keyed = keyed.withColumn("word", F.floor(place / 64).cast("bigint")).join(F.broadcast(sketch), "word", "left")
    again = F.coalesce(F.expr(f"(shiftrightunsigned(bits, cast(pmod(text_key, {bits}) % 64 AS int)) & 1L) = 1L"), F.lit(False))
    marked = keyed.select("text", "text_key", again.alias("again"))
    repeated = marked.where("again").groupBy("text_key").agg(F.first("text").alias("text")).select("text")
    return marked.where("NOT again").select("text").unionByName(repeated)


def corpus_terms(texts: DataFrame) -> DataFrame:
    """(hash, of_term): in how many of the texts each term occurs, by its 64-bit hash, added up in each task first."""
    words = texts.select(F.explode(term_words(F.col("text"))).alias("word"))
    return words.groupBy(F.xxhash64("word").alias("hash")).agg(F.count(F.lit(1)).cast("double").alias("of_term"))


@dataclass(frozen=True)
class Corpus:
    """What the estimate needs to know: the number of different texts, of trials, and the texts of every term."""

    texts: float
    trials: float
    terms: DataFrame  # (hash, of_term)

    @staticmethod
    def of(texts: DataFrame) -> Corpus:
        """Of rows (text). Two counts reach the driver."""
        some = texts.where("text IS NOT NULL").select("text")
        keys = written(some.groupBy(F.xxhash64("text").alias("text_key")).agg(F.count(F.lit(1)).alias("n")), "text-keys")
        terms = written(corpus_terms(different_texts(some, keys)), "corpus-terms")
        n = float(max(keys.count(), 2))
        return Corpus(n, max(n, float(terms.count())), terms)


def classes(rows: DataFrame, of: str) -> DataFrame:
    """(of, n, same_1, same_2) of rows (text_key, of), each pair once.

    What stands in exactly the same texts has equal numbers: the 128-bit hash of a set of texts.
    """
    same = [F.bit_xor(F.xxhash64("text_key", F.lit(k))).alias(f"same_{k}") for k in (1, 2)]
    return rows.groupBy(of).agg(F.count(F.lit(1)).cast("double").alias("n"), *same)


def revealing_pairs(corpus: Corpus, near: DataFrame) -> DataFrame:
    """(text_key, entity, term, reveals): the terms whose disclosure reaches GENERALISE, in each text with both.

    With c counting different texts and n all of them: the entity is as likely as (c(t, e) + c(e) / n) / (c(t) + 1) where the
    term is, and c(e) / n anywhere. The logarithm of their ratio, over the entity's information log(n / c(e)), is what the
    term reveals. By chance they would meet in m = c(t) c(e) / n texts; the Chernoff bound on the probability of c(t, e)
    meetings, times the trials, has to stay below SIGNIFICANCE. With at least n trials one meeting never suffices, so what
    stands in one text only is left out, as are terms so common that they reach no share of GENERALISE.

    Terms that stand in exactly the same texts are counted as one, and so are entities: ten thousand addresses and words of
    two versions of a log are one pair.
    """
    n, least = corpus.texts, math.log(corpus.trials / SIGNIFICANCE)
    in_texts = near.select("text_key", F.explode("entities").alias("entity"))
    entities = classes(in_texts, "entity").where("n >= 2").select(
        "entity", F.struct("n", "same_1", "same_2").alias("of_entity")
    )
    entities = written(entities, "entities")
    terms = near.select("text_key", F.explode("words").alias("term"))
    counted = classes(terms, "term").where("n >= 2").withColumn("hash", F.xxhash64("term")).join(corpus.terms, "hash")
    most = entities.agg(F.max("of_entity.n")).first()[0] or 1.0

    def rare(of_term: Column, of_entity: Column) -> Column:
        # a little more than the bound, which rounding must not move below a share of GENERALISE
        return of_term + 1 <= (of_entity + 1) * F.pow(F.lit(n) / of_entity, F.lit(1 - GENERALISE)) * (1 + 1e-9)

    counted = counted.where(rare(F.col("of_term"), F.lit(most))).select(
        "term", F.struct("of_term", "same_1", "same_2").alias("of_term")
    )
    counted = written(counted, "terms")
    entity_classes = in_texts.join(entities, "entity").select("text_key", "of_entity").distinct()
    term_classes = terms.join(counted, "term").select("text_key", "of_term").distinct()
    pairs = entity_classes.join(term_classes, "text_key").where(rare(F.col("of_term.of_term"), F.col("of_entity.n")))
    together = pairs.groupBy("of_entity", "of_term").agg(F.count(F.lit(1)).cast("double").alias("k"))
    k, of_entity, of_term = F.col("k"), F.col("of_entity.n"), F.col("of_term.of_term")
    by_chance = of_term * of_entity / n
    evidence = k * F.log(k / by_chance) - k + by_chance
    ratio = (k + of_entity / n) / (of_term + 1) * n / of_entity
    reveals = F.least(F.log(ratio) / F.log(F.lit(n) / F.least(of_entity, F.lit(n / 2))), F.lit(1.0))
    found = together.where((k > by_chance) & (evidence >= least)).withColumn("reveals", reveals)
    found = written(found.where(F.col("reveals") >= GENERALISE).select("of_entity", "of_term", "reveals"), "revealing-classes")
    # only entities and terms of some revealing pair are looked up in the texts again
    entities = entities.join(found.select("of_entity").distinct(), "of_entity")
    counted = counted.join(found.select("of_term").distinct(), "of_term")
    both = in_texts.join(entities, "entity").join(terms.join(counted, "term"), "text_key").join(found, ["of_entity", "of_term"])
    return both.select("text_key", "entity", "term", "reveals")


TERM_SPANS = "array<struct<start:int,end:int,kind:string>>"


def revealing_of_texts(pairs: DataFrame) -> DataFrame:
    """(text_key, revealing): per text its terms that reveal one of its entities, with kind generalised or removed."""
    kind = F.when(F.max("reveals") >= REMOVE, F.lit("removed")).otherwise(F.lit("generalised"))
    return (
        pairs.groupBy("text_key", "term")
        .agg(kind.alias("kind"))
        .groupBy("text_key")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "kind"))).alias("revealing"))
    )


def term_spans(rest: Column, revealing: Column) -> Column:
    """TERM_SPANS of every place of the revealing terms in what the patterns leave of a text; none without such terms."""
    matches, pieces = located(rest, TERM)
    nothing = F.array().cast(TERM_SPANS)

    def kinds(found: Column) -> Column:
        def one(span: Column) -> Column:
            kind = F.try_element_at(found["revealing"], F.lower(span["value"]))
            return F.struct(span["start"].alias("start"), span["end"].alias("end"), kind.alias("kind"))

        return F.filter(F.transform(found["spans"], one), lambda s: s["kind"].isNotNull())

    found = F.struct(placed(matches, pieces).alias("spans"), revealing.alias("revealing"))
    return F.when(F.size(revealing) > 0, bound(found, kinds)).otherwise(nothing)


def _with_terms(contexts: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of the contexts that have spans, with ``terms``: the TERM_SPANS of their text."""
    near = written(occurrences(contexts), "text-terms")
    found = revealing_of_texts(revealing_pairs(Corpus.of(texts), near))
    dirty = contexts.where("text_key IS NOT NULL").join(found, "text_key", "left")
    return dirty.withColumn("terms", term_spans(F.col("rest"), F.col("revealing")))


def find_personal_data(documents: DataFrame) -> DataFrame:
    """(doc_id, _email, _ip, _card, _phone, terms) of every document.

    A null or empty text has no spans. Repeated rows are answered repeatedly, a null id stays null, other columns are not
    read; an empty table gives no rows. No term overlaps a base span.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    contexts = written(entity_contexts(rows, ["doc_id"]), "contexts")
    columns = ["doc_id", *[f"_{kind}" for kind in KINDS]]
    without = contexts.where("text_key IS NULL").select(*columns, F.array().cast(TERM_SPANS).alias("terms"))
    return without.unionByName(_with_terms(contexts, rows).select(*columns, "terms"))


def span_texts(kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the spans of the given base kinds, by kind and start, as an array."""

    def written_as(kind: str):
        return lambda s: F.concat(F.lit(f"{kind}:"), s["start"], F.lit(":"), s["end"])

    return F.concat(*[F.transform(f"_{kind}", written_as(kind)) for kind in kinds])


def sanitise(documents: DataFrame) -> DataFrame:
    """The documents, all columns, with personal data masked, general words for generalised terms, others removed.

    Overlapping spans are masked as one, under the kind that begins first. ``n_chars``, if present, follows the new text. A
    null or empty text, and any without personal data, stays as it is; so do all other columns, whatever their names, and
    null ids. Repeated rows are answered repeatedly and count once as evidence. An empty table gives no rows. The patterns
    are run once; only texts with personal data take part in a join.
    """
    columns = documents.columns
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "text")
    contexts = written(entity_contexts(rows, ["row"]), "contexts")
    dirty = _with_terms(contexts, contexts.select("row.text"))
    base = [_masks(F.col(f"_{kind}"), lambda s, kind=kind: F.lit(PLACEHOLDERS[kind])) for kind in KINDS]
    of_terms = _masks(F.col("terms"), lambda s: F.when(s["kind"] == "removed", F.lit("")).otherwise(F.lit("[TERM]")))
    dirty = dirty.select("row", replaced(F.col("row.text"), F.concat(*base, of_terms)).alias("masked"))
    changed = {"text": F.col("masked")}
    if "n_chars" in columns:
        changed["n_chars"] = F.length("masked").cast(documents.schema["n_chars"].dataType)
    clean = contexts.where("text_key IS NULL").select("row.*")
    return clean.unionByName(dirty.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns]))
