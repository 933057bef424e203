"""Search: text only, hybrid, recent, and context blocks. Every plan answers a whole batch of queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.embedders import EmbedSpec
from ..functions.scalars import blend, cap, context_line, text_weight
from ..functions.vectors import cosine
from ..operators.embedding import embed_column
from ..operators.filters import active, by_target, gate_queries, has_vector, vector_state
from ..operators.joins import attach_vectors, resolve_query_category
from ..operators.staging import Staged, stage, top_per_query
from ..operators.text_index import analyze_queries, asked_by, asked_postings, distinct_searches, ranked_matches
from ..schemas import (
    CONTEXT_TOP_K,
    RECENT_LIMIT,
    SEARCH_TOP_K,
    WINDOW_FACTOR,
    WINDOW_MIN,
    vector_column,
    vector_dims,
)

RANK_DIGITS = 9
RESULT_FIELDS = ["target", "content", "created_at", "tags", "metadata"]


@dataclass(frozen=True)
class Batch:
    """A staged query batch with its lexemes."""

    queries: Staged
    terms: Staged

    @property
    def largest_k(self) -> int:
        return self.queries.seen["largest_k"]


def prepare_queries(
    q: DataFrame,
    categories: DataFrame | None = None,
    config: str = "simple",
    embed: EmbedSpec | None = None,
    top_k: int = SEARCH_TOP_K,
    max_k: int | None = None,
    weight: float | None = None,
    strict: bool = False,
    cache: DataFrame | None = None,
) -> Batch:
    """Fill in what a query row may lack, embed texts without a vector, and split texts into lexemes.

    ``q`` has qid and query_text and may have query_vector, target, category, top_k, text_weight.
    """
    rows = gate_queries(q)
    for c, t in (("target", "string"), ("category", "string"), ("top_k", "int"), ("text_weight", "double")):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(t))
    if categories is not None:
        rows = resolve_query_category(rows, categories, strict)
    else:
        rows = rows.withColumn("want_category", F.lit(None).cast("smallint"))
    rows = rows.withColumn("top_k", cap(F.col("top_k"), top_k, max_k))
    rows = rows.withColumn("text_weight", text_weight(F.coalesce("text_weight", F.lit(weight))))
    if embed is not None:
        embedded = embed_column(rows, "query_text", embed, cache).drop("key", "status", "error")
        rows = embedded.withColumnRenamed("vector", "query_vector")
    elif "query_vector" not in rows.columns:
        rows = rows.withColumn("query_vector", F.lit(None).cast("array<float>"))
    queries = stage(
        rows.select("qid", "query_text", "query_vector", "target", "want_category", "top_k", "text_weight"),
        largest_k=F.coalesce(F.max("top_k"), F.lit(0)),
    )
    return Batch(queries, stage(analyze_queries(queries.df, config)))


def _candidates(batch: Batch, m: DataFrame, postings: DataFrame, dim: int, skip_zero: bool, limit: int | None = None) -> DataFrame:
    """Every match that passes the filters, with its text rank; of each search the best ``limit`` if given."""
    rows = has_vector(active(m), dim)
    if skip_zero:
        rows = rows.where(vector_state(rows, dim) == 2)
    allowed = rows.select("id", F.col("target").alias("_target"), "category_id")
    options = batch.queries.df.select("qid", F.nullif("target", F.lit("")).alias("target"), "want_category", "top_k")
    filters = {"target": "_target", "want_category": "category_id"}
    searches, asked = distinct_searches(batch.terms, options, list(filters))
    found = asked_postings(batch.terms, postings, allowed, all_allowed=False)
    hits = ranked_matches(searches, found, allowed, filters, limit)
    if limit is not None:
        hits = top_per_query(hits, _by_score("text_rank"), limit, by="_sid")
    return asked_by(hits, asked).select("qid", "id", "top_k", "text_rank")


def _by_score(score: str) -> list[Column]:
    """Descending with NULL first, then by id; equal up to float noise counts as equal."""
    return [F.round(score, RANK_DIGITS).desc_nulls_first(), F.col("id").asc()]


def text_search(
    batch: Batch, m: DataFrame, postings: DataFrame, dim: int, n: int | None = None, skip_zero: bool = False
) -> DataFrame:
    """Candidates by text rank alone: ``(qid, id, text_rank)``.

    Without ``n`` every query keeps four times its top_k, at least 40, the window that a hybrid
    search re-ranks.
    """
    widest = max(batch.largest_k * WINDOW_FACTOR, WINDOW_MIN) if n is None else n
    window = F.greatest(F.col("top_k") * WINDOW_FACTOR, F.lit(WINDOW_MIN)) if n is None else n
    hits = _candidates(batch, m, postings, dim, skip_zero, widest)
    hits = top_per_query(hits, _by_score("text_rank"), window, bound=widest)
    return hits.select("qid", "id", "text_rank")


def hybrid_search(
    q: DataFrame | Batch,
    m: DataFrame,
    postings: DataFrame,
    dim: int,
    categories: DataFrame | None = None,
    skip_zero: bool = False,
    fields: list[str] | None = None,
    window: int | str | None = "reference",
    **options,
) -> DataFrame:
    """Text match and rank first, exact cosine over the best candidates second, blended top_k last.

    ``window`` is how many matches of a query, best text rank first, get a vector score: the reference's four times
    top_k, at least 40, by default; a number; or None for all, so that only the blended rank decides.
    Vectors are read for candidates only, and content, tags and metadata for results only. A zero
    vector has no similarity: it gives NaN, which ranks first, unless ``skip_zero`` is set.
    """
    vector_column(dim, vector_dims(m))
    batch = q if isinstance(q, Batch) else prepare_queries(q, categories, **options)
    if window is None:
        found = _candidates(batch, m, postings, dim, skip_zero).select("qid", "id", "text_rank")
    else:
        found = text_search(batch, m, postings, dim, None if window == "reference" else window, skip_zero)
    candidates = stage(found)
    per_query = batch.queries.df.select("qid", "query_vector", "top_k", "text_weight")
    scored = attach_vectors(candidates, m, dim).join(per_query, "qid")
    scored = scored.withColumn("vector_sim", cosine(F.col("vector"), F.col("query_vector"))).drop("vector", "query_vector")
    scored = scored.withColumn("rank", blend(F.col("text_rank"), F.col("vector_sim"), F.col("text_weight")))
    best = top_per_query(scored, _by_score("rank"), F.col("top_k"), bound=batch.largest_k, position="position")
    best = best.select("qid", "id", "position", "text_rank", "vector_sim", "rank")
    wanted = RESULT_FIELDS if fields is None else fields
    if not wanted:
        return best
    results = stage(best)
    details = m.select("id", *wanted)
    side = F.broadcast(results.df) if results.small else results.df
    return details.join(side, "id").select("qid", "position", "id", *wanted, "text_rank", "vector_sim", "rank")


def verification_search(
    batch: Batch, m: DataFrame, postings: DataFrame, dim: int, top_k: int = CONTEXT_TOP_K
) -> DataFrame:
    """Search ordered by similarity alone, over a text window of four times ``top_k``."""
    candidates = stage(text_search(batch, m, postings, dim, n=WINDOW_FACTOR * top_k))
    scored = attach_vectors(candidates, m, dim).join(batch.queries.df.select("qid", "query_vector"), "qid")
    scored = scored.withColumn("vector_sim", cosine(F.col("vector"), F.col("query_vector")))
    best = top_per_query(scored, _by_score("vector_sim"), top_k, position="position")
    return best.select("qid", "position", "id", "text_rank", "vector_sim")


def _newest() -> list[Column]:
    return [F.desc_nulls_first("created_at"), F.asc("id")]


def recent(m: DataFrame, target: str | None = None, limit: int = RECENT_LIMIT) -> DataFrame:
    """Newest active memories, rows without a time first."""
    if limit < 0:
        raise ValueError("row count must not be negative")
    rows = by_target(active(m), target).orderBy(*_newest()).limit(limit)
    return rows.select("id", *RESULT_FIELDS)


def recent_per_target(m: DataFrame, n: int = RECENT_LIMIT) -> DataFrame:
    """Newest active memories of every target in one pass."""
    rows = active(m).select("id", *RESULT_FIELDS)
    return top_per_query(rows, _newest(), n, by="target", position="position")


def context_blocks(
    q: DataFrame,
    m: DataFrame,
    postings: DataFrame,
    dim: int,
    heading: str = "## Memory Context",
    min_len: int = 1,
    max_len: int | None = None,
    width: int | None = None,
    **options,
) -> DataFrame:
    """One text block per query that has results: a heading and a line per memory, best first.

    Short queries, long queries and long contents are only dropped or cut where limits are given.
    """
    gated = gate_queries(q, min_len, max_len)
    hits = hybrid_search(
        gated, m, postings, dim, fields=["target", "content", "tags"], top_k=CONTEXT_TOP_K, max_k=CONTEXT_TOP_K, **options
    )
    line = context_line(F.col("target"), F.col("tags"), F.col("content"), width)
    ordered = F.array_sort(F.collect_list(F.struct("position", line.alias("line"))))
    lines = F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")
    return hits.groupBy("qid").agg(F.concat(F.lit(heading + "\n"), lines).alias("context"))
