"""From documents to quote rows: failed-poll skip, body decode, key-to-row unpivot, source tag, concatenation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cambio.functions.json_quotes import (
    entries_of,
    is_object,
    is_plain,
    last_entry_per_key,
    parsed_body,
    plain_entries,
    plain_number,
    strict_double,
)
from cambio.schemas import QUOTE_FIELDS


def split_by_status(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answered polls, failed polls). A missing status counts as failed."""
    answered = F.col("status") == 200
    return documents.where(answered), documents.where(~F.col("status").eqNullSafe(200))


def broker_entries(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per top-level key: ``(*carry, cripto, broker, quote)``, ``quote`` still raw text.

    A narrow step: it needs no shuffle, and an empty object gives no rows.
    """
    return _marked_entries(documents, carry).drop("_plain")


def _marked_entries(documents: DataFrame, carry: Sequence[str]) -> DataFrame:
    """:func:`broker_entries`, and whether the document is plain: only the others go through the JSON parser."""
    plain, body = F.col("_plain"), F.col("body")
    marked = documents.select(*carry, F.col("cripto_name").alias("cripto"), "body", is_plain(body).alias("_plain"))
    parsed = marked.select(
        *carry,
        "cripto",
        "_plain",
        F.when(plain, plain_entries(body)).alias("_entries"),
        F.when(~plain, parsed_body(body)).alias("parsed"),
    )
    entries = F.when(plain, F.col("_entries")).otherwise(entries_of(F.col("parsed"))).alias("entries")
    return (
        parsed.select(*carry, "cripto", "_plain", entries)
        .select(*carry, "cripto", "_plain", F.explode(last_entry_per_key(F.col("entries"))).alias("entry"))
        .select(*carry, "cripto", F.col("entry.key").alias("broker"), F.col("entry.value").alias("quote"), "_plain")
    )


def decode_entries(documents: DataFrame, carry: Sequence[str] = (), fields: Sequence[str] = QUOTE_FIELDS) -> DataFrame:
    """Every entry's fields, still as text: ``(*carry, cripto, broker, *fields, rejected)``.

    A field a broker does not report is NULL. ``rejected`` holds the raw text of an entry that is no object (``null`` for a
    JSON null), and is NULL for a quote. Numbers are not checked here: a bad price at a broker no one looks up, or in a
    field no one keeps, must not fail a load.
    """
    quote = F.col("quote")
    # the text of other fields may be kept, so it has to be the parser's
    plain = F.col("_plain") if set(fields) <= set(QUOTE_FIELDS) else F.lit(False)
    texts = [f"_text_{i}" for i in range(len(fields))]
    return (
        _marked_entries(documents, carry)
        .select("*", F.json_tuple(F.when(is_object(quote) & ~plain, quote), *fields).alias(*texts))
        .select(
            *carry,
            "cripto",
            "broker",
            *[
                F.when(plain, plain_number(quote, name)).otherwise(F.col(text)).alias(name)
                for name, text in zip(fields, texts)
            ],
            F.when(~is_object(quote), F.coalesce(quote, F.lit("null"))).alias("rejected"),
        )
    )


def accepted_quotes(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("rejected").isNull()).drop("rejected")


def rejected_entries(entries: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    rejected = F.col("rejected")
    return entries.where(rejected.isNotNull()).select(*carry, "cripto", "broker", rejected.alias("quote"))


def unpivot_quotes(documents: DataFrame, carry: Sequence[str] = (), extra_fields: Sequence[str] = ()) -> DataFrame:
    """Quote rows ``(*carry, cripto, broker, ask, totalAsk, bid, totalBid, time, *extra_fields)``.

    The five known fields are numbers, and text that is none fails the query; extra fields are kept as text.
    """
    entries = decode_entries(documents, carry, [*QUOTE_FIELDS, *extra_fields])
    return numbers(accepted_quotes(entries), QUOTE_FIELDS)


def numbers(quotes: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named text columns as doubles (:func:`strict_double`); columns that are no text stay as they are."""
    texts = {name for name, kind in quotes.dtypes if kind == "string" and name in names}
    return quotes.select(
        *[strict_double(F.col(c), c).alias(c) if c in texts else F.col(c) for c in quotes.columns]
    )


def rejected_quotes(documents: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Brokers whose value is not an object, ``(*carry, cripto, broker, quote)``; absent from :func:`unpivot_quotes`."""
    return rejected_entries(decode_entries(documents, carry), carry)


def tag_source(quotes: DataFrame, coin: str) -> DataFrame:
    """Put the constant coin code in front of one coin's rows."""
    return quotes.select(F.lit(coin).alias("cripto"), *quotes.columns)


def concat_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union by column name; columns missing on one side are NULL there."""
    frames = list(frames)
    if not frames:
        raise ValueError("no quotes to concatenate: every poll failed")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
