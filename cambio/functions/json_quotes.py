"""Column expressions that read a quote document: ``{broker: {ask, totalAsk, bid, totalBid, time}}``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# A plain document, as the quote service sends it: without white space or escapes, and every broker an object of numbers that
# are not negative. All quantifiers are possessive, so a match is one pass over the text, without recursion.
_NUMBER = r"(?!0\d)\d++(?:\.\d++)?+(?:[eE][+-]?+\d++)?+"
_FIELD = rf'"\w++":{_NUMBER}'
_ENTRY = rf'"[\w #.-]++":\{{{_FIELD}(?:,{_FIELD})*+\}}'
_PLAIN = rf"^\{{{_ENTRY}(?:,{_ENTRY})*+\}}\z"


def is_plain(body: Column) -> Column:
    """Whether :func:`plain_entries` reads the document; any other one, malformed ones too, is for :func:`parsed_body`."""
    return F.coalesce(body.rlike(_PLAIN), F.lit(False))


def plain_entries(body: Column) -> Column:
    """The (key, value) entries of a plain document, the same as :func:`entries_of` gives, for a fraction of its time."""

    def entry(text: Column) -> Column:
        name = F.substring_index(F.substring_index(text, '"', 2), '"', -1)
        fields = F.substring_index(text, "{", -1)
        return F.struct(name.alias("key"), F.concat(F.lit("{"), fields, F.lit("}")).alias("value"))

    parts = F.split(body, r"\}")  # one per entry, and two empty ones for the end of the document
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 2), entry)


def plain_number(quote: Column, name: str) -> Column:
    """The text of a number in the object of a plain document, NULL without it; of a repeated one the last."""
    after = F.substring_index(quote, f'"{name}":', -1)
    number = F.substring_index(F.substring_index(after, ",", 1), "}", 1)
    return F.when(F.contains(quote, F.lit(f'"{name}":')), number)


def parsed_body(body: Column) -> Column:
    """``array<map<string,string>>`` holding the document.

    The array brackets make the parser read to the very end of the text, so trailing garbage is malformed too. Values
    stay raw text: one odd broker must not cost its document.
    """
    wrapped = F.concat(F.lit("["), body, F.lit("]"))
    return F.from_json(wrapped, "array<map<string,string>>", {"allowSingleQuotes": "false"})


def entries_of(parsed: Column) -> Column:
    """The document's (key, value) entries; fails the query on a malformed body. A JSON ``null`` has no entries."""
    malformed = F.raise_error(F.lit("malformed quote document: the body is not one JSON object"))
    return F.when(F.coalesce(F.size(parsed), F.lit(0)) == 1, F.map_entries(parsed[0])).otherwise(malformed)


def last_entry_per_key(entries: Column) -> Column:
    """Resolve repeated JSON keys to their last value. Documents without repeats pass through untouched."""
    keys = entries["key"]
    ordered = F.array_sort(
        F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"), e["value"].alias("value")))
    )
    # transform over a one-element array binds the sorted entries once for the inner lambda
    deduplicated = F.transform(
        F.array(ordered),
        lambda o: F.filter(o, lambda e, i: F.coalesce(F.get(o, i + 1)["key"] != e["key"], F.lit(True))),
    )[0]
    pairs = F.transform(
        deduplicated, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))
    )
    single, different = F.size(entries) == 1, F.size(F.array_distinct(keys)) == F.size(entries)
    return F.when(single, entries).when(different, entries).otherwise(pairs)


def is_object(value: Column) -> Column:
    return F.coalesce(value.startswith("{"), F.lit(False))


def strict_double(text: Column, name: str) -> Column:
    """Number text to double: NULL and NaN are missing, anything that is not a number fails the query."""
    number = text.try_cast("double")
    bad = F.raise_error(F.concat(F.lit(f"not a number in field {name}: "), text))
    return F.when(text.isNull() | (text == "NaN"), F.lit(None)).otherwise(F.coalesce(number, bad))
