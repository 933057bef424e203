"""URL verdicts by given rules and by rules mined from the URLs that those label. DataFrame operations only."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemolake.llm.common import named, stage
from mnemolake.operators.staging import balanced_join

#: Verdict, host and path of the given rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"^(?s:.*?)://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty for a null or one without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.regexp_extract(url, _PARTS, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits the host, or a parent domain, and the path's beginning."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL, sorted: top-level domain, host labels and their words, path segments, query keys.

    Segments and keys are cut to their letters, so that numbers don't make every URL a kind of its own.
    """
    letters = lambda x: F.regexp_replace(F.lower(x), "[0-9]+", "0")
    labels = F.split(host, r"\.")
    query = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[^#]*?\?([^#]*)", 1)
    parts = [
        F.transform(F.slice(labels, -1, 1), lambda x: F.concat(F.lit("tld:"), x)),
        F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
        F.transform(F.split(host, r"[.-]"), lambda x: F.concat(F.lit("name:"), letters(x))),
        F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("path:"), letters(x))),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("key:"), letters(F.substring_index(x, "=", 1)))),
    ]
    return F.array_sort(F.array_distinct(F.filter(F.concat(*parts), lambda x: ~x.endswith(":"))))


def rule_tokens(rules: Sequence[tuple[str, str, str]]) -> tuple[list[str], list[str]]:
    """Tokens that repeat what the rules test, and beginnings of such tokens where a rule's path ends within a segment."""
    exact, begun = set(), set()
    letters = lambda x: re.sub("[0-9]+", "0", x.lower())
    for _, host, path in rules:
        labels = host.translate(str.maketrans(_UPPER, _LOWER)).split(".")
        exact |= {f"tld:{labels[-1]}", *[f"host:{x}" for x in labels], *[f"name:{letters(x)}" for label in labels for x in label.split("-")]}
        *whole, last = path.split("/")
        exact |= {f"path:{letters(x)}" for x in whole}
        begun |= {f"path:{letters(last)}"} if last else set()
    return sorted(t for t in exact if not t.endswith(":")), sorted(begun)


def mine_rules(labelled: DataFrame, support: float, confidence: float, label: str = "block") -> DataFrame:
    """``tokens, confidence, driver``: token combinations that speak for ``label``, mined from ``labelled (tokens, verdict)``.

    FP-growth over the tokens and the verdict of every labelled row; kept are rules to the label with the given
    support and confidence and a lift above 1. The driver is the rule's rarest token, under which it is indexed.
    """
    item = F.concat(F.lit("label:"), F.col("verdict"))
    baskets = labelled.where(F.col("verdict").isNotNull()).select(F.concat("tokens", F.array(item)).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where(
        (F.element_at("consequent", 1) == f"label:{label}") & (F.col("lift") > 1) & ~F.exists("antecedent", lambda x: x.startswith("label:"))
    ).select(F.array_sort("antecedent").alias("tokens"), "confidence")
    single = model.freqItemsets.where(F.size("items") == 1).select(F.element_at("items", 1).alias("token"), "freq")
    each = rules.select("tokens", "confidence", F.explode("tokens").alias("token")).join(single, "token")
    return each.groupBy("tokens", "confidence").agg(F.min_by("token", F.struct("freq", "token")).alias("driver"))


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, support: float = 0.01, confidence: float = 0.8,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence`` of every page.

    The given rules decide where one fits, the longest first. Their verdicts are also the labels: URLs with one are
    the transactions from which FP-growth mines token combinations that speak for blocking. The rest is blocked if
    it holds all tokens of a mined rule (the highest confidence is reported), and allowed otherwise. Tokens that a
    given rule tests itself (host labels, their words, path segments) are left out of the mined combinations: they
    explain the label by its own definition, and would block every page of a domain that has no allowed label.

    Matching goes by an inverted index from each rule's rarest token, over distinct token sets, so a host or URL
    that fills a third of the table costs one row there; its pages meet the verdict in a broadcast join where the
    verdicts are measured to be small, and in a join salted for hot keys where they aren't.
    Only the URL is read. Null URLs and those without ``://`` have empty host and path, no rule, and are allowed.
    Repeated rows get a row each. Without labelled rows nothing is mined.
    """
    host, path = host_and_path(named(url_col))
    parts = pages.select(named(id_col).cast("long").alias("page_id"), named(url_col).alias("_url"), host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    exact, begun = rule_tokens(rules)
    tested = lambda x: reduce(Column.__or__, [x.startswith(b) for b in begun], x.isin(exact))
    tokens = F.filter(url_tokens(F.col("_url"), F.col("host"), F.col("path")), lambda x: ~tested(x))
    known = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), tokens.alias("tokens"))
    kind = F.array_join("tokens", " ").alias("kind")
    mined = mine_rules(known, support, confidence).withColumnRenamed("tokens", "_rule_tokens")
    kinds = known.where("verdict is null").select("tokens").distinct()
    looked = kinds.select("tokens", F.explode("tokens").alias("driver")).join(mined, "driver")
    hit = looked.where(F.size(F.array_except("_rule_tokens", "tokens")) == 0)
    judged = stage(hit.groupBy(kind).agg(F.max("confidence").alias("confidence")))
    met = balanced_join(known.select("*", kind), judged.df, "kind", "left", right_small=judged.small)
    by_rule = F.col("rule").isNotNull()
    decided = F.when(by_rule, F.col("verdict")).when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return met.select("page_id", "host", "path", "rule", decided.alias("verdict"), F.when(~by_rule, F.col("confidence")).alias("confidence"))
