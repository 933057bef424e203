"""Scalar helpers on strings, JSON, timestamps and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DEFAULT_CONFIDENCE, DEFAULT_TARGET, TEXT_WEIGHT


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of every kind, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    """True for NULL, empty and white-space-only text."""
    return F.coalesce(~text.rlike(r"(?U)\S"), F.lit(True))


def prefix(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def tag_suffix(tags: Column) -> Column:
    """``' [a, b]'``, or an empty string without tags."""
    return F.when(F.size(tags) > 0, F.concat(F.lit(" ["), F.concat_ws(", ", tags), F.lit("]"))).otherwise("")


def context_line(target: Column, tags: Column, content: Column, width: int | None = None) -> Column:
    shown = content if width is None else prefix(content, width)
    return F.concat(F.lit("- ["), target, F.lit("]"), tag_suffix(tags), F.lit(" "), shown)


def cache_key(dim: int, provider: str, model: str, text: Column) -> Column:
    """Content address of an embedding: SHA-256 over width, provider, model and text."""
    return F.sha2(F.concat(F.lit(f"{dim}|{provider}|{model}|"), text), 256)


def json_int(value: Column) -> Column:
    """JSON text to int; NULL when it is no JSON or no whole number."""
    return F.try_variant_get(F.try_parse_json(value), "$", "int")


def json_merge(fixed: dict[str, Column], extra: Column) -> Column:
    """JSON object from fixed string entries; entries of ``extra`` (JSON text) win over them."""
    given = F.coalesce(F.from_json(extra, "map<string,variant>"), F.from_json(F.lit("{}"), "map<string,variant>"))
    entries = [x for k, v in fixed.items() for x in (F.lit(k), F.parse_json(F.to_json(F.struct(v.alias("v")))))]
    pairs = []
    for k, v in zip(entries[::2], entries[1::2]):
        pairs += [k, F.variant_get(v, "$.v", "variant")]
    base = F.map_filter(F.create_map(*pairs), lambda k, _: ~F.map_contains_key(given, k))
    return F.to_json(F.map_concat(base, given))


def iso_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def score_or_zero(score: Column) -> Column:
    """NULL counts as 0; NaN is a value and stays."""
    return F.coalesce(score, F.lit(0.0))


def text_weight(weight: Column | None = None) -> Column:
    """Weight of the text score, 0.5 unless given, kept within 0..1."""
    given = F.lit(TEXT_WEIGHT) if weight is None else F.coalesce(weight.cast("double"), F.lit(TEXT_WEIGHT))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), given))


def blend(text_score: Column, vector_score: Column, weight: Column) -> Column:
    return weight * score_or_zero(text_score) + (1 - weight) * score_or_zero(vector_score)


def default_tags(tags: Column) -> Column:
    return F.coalesce(tags, F.array().cast("array<string>"))


def default_metadata(metadata: Column) -> Column:
    return F.coalesce(metadata, F.lit("{}"))


def default_confidence(confidence: Column) -> Column:
    return F.coalesce(confidence, F.lit(DEFAULT_CONFIDENCE)).cast("smallint")


def default_target(target: Column) -> Column:
    return F.coalesce(target, F.lit(DEFAULT_TARGET))


def percent(ratio: Column) -> Column:
    return F.round(ratio * 100, 1)


def cap(n: Column, default: int, maximum: int | None = None) -> Column:
    """Requested row count with a default and, where one is wanted, an upper bound; a negative count is an error."""
    wanted = F.coalesce(n, F.lit(default))
    if maximum is not None:
        wanted = F.least(wanted, F.lit(maximum))
    return F.when(wanted < 0, F.raise_error(F.lit("row count must not be negative")).cast("int")).otherwise(wanted)
