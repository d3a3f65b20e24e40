"""URL filters: given rules first, and for what they leave open, association rules mined from what they decided.

Every url is described by a few tokens, one per slot at most. Among the urls that a given rule decides, FP-growth finds the
token combinations that imply a verdict with enough support and confidence. These rules are looked up by an inverted index
over their rarest token; the most confident one that a url's tokens contain gives its verdict. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cambio.llm.common import written

ALLOW, BLOCK = "allow", "block"
#: Of the decided urls, the share that has to hold a rule's tokens and its verdict.
LEAST_SUPPORT = 0.01
#: Of the decided urls with a rule's tokens, the share that has its verdict.
LEAST_CONFIDENCE = 0.8
VERDICT = "verdict="

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """A verdict on a host, its subdomains included, below a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def _lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; the empty text without one."""
    at = F.instr(url, "://")
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def given_rule(rules: Sequence[UrlRule], host: Column, path: Column) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, null without one; of equally long ones a blocking one goes first."""
    order = sorted(rules, key=lambda r: (-len(r.text), r.verdict != BLOCK, r.text))

    def first(value) -> Column:
        return reduce(lambda rest, r: F.when(r.fits(host, path), value(r)).otherwise(rest), order[::-1], F.lit(None).cast("string"))

    return first(lambda r: F.lit(r.text)), first(lambda r: F.lit(r.verdict))


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """The tokens of a url, one per slot at most, digits written as ``#``; none without a host.

    Slots: scheme, top-level domain, site (its last two labels), first label below the site, first and last path segment,
    file extension, query keys (sorted, as one), presence of a fragment. With nine slots a url has at most 512 token
    combinations, so at most 512 / LEAST_SUPPORT combinations are frequent, whatever the number of urls.
    """
    labels = F.split(host, r"\.")
    size = F.size(labels)
    segments = F.filter(F.split(_lower(path), "/"), lambda s: s != "")
    shape = lambda text: F.regexp_replace(text, "[0-9]+", "#")
    last = F.try_element_at(segments, F.lit(-1))
    rest = _lower(_after_scheme(url))
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: shape(F.substring_index(p, "=", 1)))
    slots = {
        "scheme": F.when(host != "", _lower(F.substring_index(url, "://", 1))),
        "tld": F.when(size > 1, F.get(labels, size - 1)),
        "site": F.when(size > 1, F.concat_ws(".", F.get(labels, size - 2), F.get(labels, size - 1))),
        "sub": F.when(size > 2, shape(F.get(labels, F.lit(0)))),
        "dir": F.when(F.size(segments) > 0, shape(F.get(segments, F.lit(0)))),
        "page": F.when(F.size(segments) > 1, shape(F.regexp_replace(last, r"\.[^.]*$", ""))),
        "ext": F.when(last.rlike(r"[^.]\.[a-z0-9]+$"), shape(F.regexp_extract(last, r"\.([a-z0-9]+)$", 1))),
        "query": F.when(F.size(keys) > 0, F.array_join(F.array_sort(F.array_distinct(keys)), "&")),
        "fragment": F.when(rest.contains("#"), F.lit("yes")),
    }
    named = [F.concat(F.lit(f"{name}="), value) for name, value in slots.items()]
    nothing = F.array().cast("array<string>")
    return F.when(host != "", F.array_compact(F.array(*named))).otherwise(nothing)


MINED_SCHEMA = "tokens array<string>, verdict string, confidence double, support double, anchor string"


def mine(decided: DataFrame, least_support: float = LEAST_SUPPORT, least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """MINED_SCHEMA: token combinations that imply a verdict, from rows (tokens, verdict). Written, as an index by anchor.

    The anchor is the combination's rarest token (the first of several in alphabetical order): a url can only fit a rule
    whose anchor it has. Verdicts other than allow and block teach nothing. Without rows there are no rules.
    """
    spark = decided.sparkSession
    known = decided.where(F.col("verdict").isin(ALLOW, BLOCK))
    if known.isEmpty():
        return spark.createDataFrame([], MINED_SCHEMA)
    items = known.select(F.array_append("tokens", F.concat(F.lit(VERDICT), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=least_support, minConfidence=least_confidence).fit(items)
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rules = model.associationRules.where(F.col("consequent")[0].startswith(VERDICT)).select(
        F.array_sort("antecedent").alias("tokens"),
        F.substring_index(F.col("consequent")[0], "=", -1).alias("verdict"),
        "confidence",
        "support",
    )
    frequency = written(single, "token-frequencies")
    anchors = rules.select("*", F.explode("tokens").alias("token")).join(frequency, "token")
    rarest = F.min_by("token", F.struct("freq", "token")).alias("anchor")
    return written(anchors.groupBy("tokens", "verdict", "confidence", "support").agg(rarest), "url-rules")


def best_rules(classes: DataFrame, mined: DataFrame) -> DataFrame:
    """(tokens, verdict, mined, confidence): for each different set of tokens the best mined rule that it contains.

    The most confident one; of several the one with more support, then fewer tokens, then the first in alphabetical order,
    then a blocking one. Sets without a rule are left out.
    """
    rules = mined.select(F.col("tokens").alias("needed"), F.col("verdict").alias("implied"), "confidence", "support", "anchor")
    candidates = classes.select("tokens", F.explode("tokens").alias("anchor")).join(rules, "anchor")
    fitting = candidates.where(F.size(F.array_except("needed", "tokens")) == 0)
    text = F.array_join("needed", " ")
    order = F.struct(-F.col("confidence"), -F.col("support"), F.size("needed"), text, F.col("implied") != BLOCK)
    best = F.min_by(F.struct("implied", text.alias("mined"), "confidence"), order)
    answers = fitting.groupBy("tokens").agg(best.alias("best"))
    return answers.select("tokens", F.col("best.implied").alias("verdict"), "best.mined", "best.confidence")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[UrlRule],
    default: str = ALLOW,
    least_support: float = LEAST_SUPPORT,
    least_confidence: float = LEAST_CONFIDENCE,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined, confidence) of every row of pages (page_id, url).

    ``rule`` is the longest given rule that fits, null without one; then the best mined rule decides (``mined``, its tokens,
    and its confidence), and ``default`` where there is none. A null url, or one without ``://``, has an empty host and path
    and gets the default. Repeated rows are answered repeatedly and each counts as evidence, a null id stays null, other
    columns are not read, an empty table gives no rows.

    Urls without a given rule are looked up once per different set of tokens; the answers are joined back, where adaptive
    execution splits a set that many urls share. Only combinations of frequent tokens are ever held in one place.
    """
    url = F.col("url")
    placed = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), "url"
    )
    rule, verdict = given_rule(rules, F.col("host"), F.col("path"))
    tokens = url_tokens(url, F.col("host"), F.col("path"))
    judged = placed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), tokens.alias("tokens"))
    judged = written(judged, "urls")
    mined = mine(judged.where("rule IS NOT NULL").select("tokens", "verdict"), least_support, least_confidence)
    open_urls = judged.where("rule IS NULL").drop("verdict")
    answers = written(best_rules(open_urls.select("tokens").distinct(), mined), "url-answers")
    columns = ["page_id", "host", "path", "rule", "verdict", "mined", "confidence"]
    decided = judged.where("rule IS NOT NULL").withColumns(
        {"mined": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")}
    )
    found = open_urls.join(answers, "tokens", "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    return decided.select(*columns).unionByName(found.select(*columns))
