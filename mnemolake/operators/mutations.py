"""Adds, edits, soft deletes, registry changes and backfill as functions of DataFrames.

Each returns the changed table; ``sources.tables.write_snapshot`` persists it as a new version.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.embedders import EmbedSpec
from ..functions.scalars import (
    default_confidence,
    default_metadata,
    default_tags,
    default_target,
    json_merge,
)
from ..schemas import MODEL_SEED, vector_column, vector_dims
from ..sources.tables import append_memories, state_columns
from .embedding import ERROR, FALLBACK, attach_embedding, cache_entries, embed_column, embed_texts
from .filters import REAL, existing, vector_state
from .joins import resolve_category, upsert
from .staging import Staged, missing, stage


def latest_per_key(mutations: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Last mutation per key. An aggregate, so a key with very many mutations combines map-side."""
    rest = [c for c in mutations.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return mutations.groupBy(key).agg(newest.alias("_row")).select(key, "_row.*")


def apply_by_id(m: DataFrame, changes: Staged) -> DataFrame:
    """Set the columns that ``changes`` carries on the rows it names; ids it lacks stay as they are.

    ``changes`` has one row per id and is broadcast when measured small, so that the wide memory
    rows are not shuffled for a small batch of changes.
    """
    plain = m.drop(*state_columns(m))
    columns = [c for c in changes.df.columns if c != "id"]
    renamed = changes.df.select("id", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = plain.join(F.broadcast(renamed) if changes.small else renamed, "id", "left")
    updated = {
        c: F.when(F.col("_hit"), F.col(f"_new_{c}").cast(plain.schema[c].dataType)).otherwise(F.col(c)) for c in columns
    }
    return joined.withColumns(updated).select(*plain.columns)


def applied(m: DataFrame, ids: DataFrame) -> DataFrame:
    """Whether each id exists, that is, whether a mutation of it takes effect."""
    hits = existing(m, ids.select("id").distinct()).withColumn("applied", F.lit(True))
    return ids.join(hits, "id", "left").withColumn("applied", F.coalesce("applied", F.lit(False)))


def prepare_memories(
    m: DataFrame, new: DataFrame, categories: DataFrame, embed: EmbedSpec, now: Column, cache: DataFrame | None = None
) -> DataFrame:
    """New rows in the table's layout: category id, defaults, and a vector at the embedder's width only.

    ``new`` has id and content and may have category, target, tags, metadata, confidence, expires_at.
    """
    column = vector_column(embed.dim, vector_dims(m))
    if "id" not in new.columns:
        raise ValueError("new rows need an id column")
    for c, t in (("category", "string"), ("target", "string"), ("tags", "array<string>"), ("metadata", "string"),
                 ("confidence", "smallint"), ("expires_at", "timestamp")):
        if c not in new.columns:
            new = new.withColumn(c, F.lit(None).cast(t))
    ready = embed_column(resolve_category(new, categories), "content", embed, cache)
    ready = ready.withColumns(
        {
            column: F.col("vector"),
            "target": default_target(F.col("target")),
            "tags": default_tags(F.col("tags")),
            "metadata": default_metadata(F.col("metadata")),
            "confidence": default_confidence(F.col("confidence")),
            "is_active": F.lit(True),
            "created_at": now,
            "updated_at": now,
        }
    )
    columns = [c for c in m.columns if c not in state_columns(m)]
    values = [
        (F.col(c) if c in ready.columns else F.lit(None)).cast(m.schema[c].dataType).alias(c) for c in columns
    ]
    return ready.select(*values)


def add_memories(
    m: DataFrame, new: DataFrame, categories: DataFrame, embed: EmbedSpec, now: Column, cache: DataFrame | None = None
) -> DataFrame:
    """The table with new memories. Ids that exist are rejected, as their key is taken."""
    fresh = missing(new, m, "id")
    plain = m.drop(*state_columns(m))
    return append_memories(plain, prepare_memories(m, fresh, categories, embed, now, cache))


def update_memories(
    m: DataFrame,
    edits: DataFrame,
    embed: EmbedSpec,
    now: Column,
    order: Sequence[str],
    clear_other_dims: bool = False,
    cache: DataFrame | None = None,
) -> DataFrame:
    """New content for existing ids, re-embedded at one width; inactive rows are edited too.

    Vectors of other widths keep describing the old content unless ``clear_other_dims`` is set.
    ``order`` names the columns that decide between several edits of one id.
    """
    column = vector_column(embed.dim, vector_dims(m))
    last = latest_per_key(edits, "id", order).select("id", "content")
    changes = embed_column(last, "content", embed, cache).select(
        "id", "content", F.col("vector").alias(column), now.alias("updated_at")
    )
    if clear_other_dims:
        others = [d for d in vector_dims(m) if d != embed.dim]
        changes = changes.withColumns({f"vector_{d}": F.lit(None).cast("array<float>") for d in others})
    return apply_by_id(m, stage(changes))


def forget(m: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    """Soft delete; rows that are inactive already get the new time as well."""
    changes = ids.select("id").distinct().select("id", F.lit(False).alias("is_active"), now.alias("updated_at"))
    return apply_by_id(m, stage(changes))


def model_set(models: DataFrame, changes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Registry after a batch of changes ``(dim, provider, model, ...)``; a NULL keeps the old value.

    A width that is not registered yet is inserted with its own defaults for what is missing. Per
    width and field the last given value wins. Rows embedded before the change are not re-embedded.
    """
    fields = [c for c in ("provider", "model") if c in changes.columns]
    given = F.struct(*order)
    last = changes.groupBy("dim").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), given)).alias(c) for c in fields]
    )
    last = last.where(F.coalesce(*[F.col(c) for c in fields]).isNotNull())
    defaults = {c: F.create_map(*[F.lit(x) for row in MODEL_SEED for x in (row[0], row[i])])
                for c, i in (("provider", 1), ("model", 2), ("api_key_env", 4))}
    merged = upsert(models, last, "dim")
    filled = {c: F.coalesce(F.col(c), defaults[c][F.col("dim").cast("int")]) for c in ("provider", "model")}
    known = models.select("dim", F.lit(True).alias("_known"))
    if "api_key_env" in models.columns:
        filled["api_key_env"] = F.when(F.col("_known"), F.col("api_key_env")).otherwise(
            defaults["api_key_env"][F.col("dim").cast("int")]
        )
    return merged.join(known, "dim", "left").withColumns(filled).select(*models.columns)


def set_default_dim(settings: DataFrame, dim: int, dims: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """Settings with the new default width, and whether a row was there to change; none is inserted."""
    vector_column(dim, dims)
    is_row = F.col("key") == "default_dim"
    changed = settings.withColumn("value", F.when(is_row, str(dim)).otherwise(F.col("value")))
    return changed, settings.agg((F.count_if(is_row) > 0).alias("applied"))


def mirror_writes(events: DataFrame) -> DataFrame:
    """Rows to add for mirrored writes: only ``add`` and ``replace`` with content, and both append.

    ``events`` has id, action, target, content and optional JSON metadata, whose entries win.
    """
    if "metadata" not in events.columns:
        events = events.withColumn("metadata", F.lit(None).cast("string"))
    kept = events.where(F.col("action").isin("add", "replace") & (F.length("content") > 0))
    fixed = {"source": F.lit("builtin_memory_tool"), "action": F.col("action")}
    return kept.select(
        "id",
        "target",
        "content",
        F.when(F.col("target") == "user", "user_profile").otherwise("fact").alias("category"),
        F.array(F.lit("mirrored"), F.lit("builtin")).alias("tags"),
        json_merge(fixed, F.col("metadata")).alias("metadata"),
    )


@dataclass(frozen=True)
class Backfill:
    """Result of a backfill: the table, counts per width, and new cache entries per width."""

    memory: DataFrame
    stats: DataFrame
    fresh: dict[int, DataFrame]


def pending(m: DataFrame, dim: int, limit: int = 0) -> DataFrame:
    """Active rows without a usable vector, oldest first when limited."""
    rows = m.where(F.col("is_active") & (vector_state(m, dim) != REAL))
    return rows.orderBy(F.asc_nulls_last("created_at"), "id").limit(limit) if limit else rows


def backfill(
    m: DataFrame,
    specs: Sequence[EmbedSpec],
    now: Column,
    limit: int = 0,
    dry_run: bool = False,
    cache: DataFrame | None = None,
) -> Backfill:
    """Embed what is missing at every given width.

    The table is read once for all rows: pending ones meet new vectors by the key of their text, the others have
    none. Counts come from the texts' own. A failed call of a fail-open embedder leaves a zero vector, which
    counts as embedded for the table and is told apart in ``zero_fallbacks``. With ``keep_errors`` a text that
    fails, or whose vector has another width, leaves its row as it is and counts in ``errors``; the others go on.
    ``skipped`` counts rows that another writer filled meanwhile: none, as a snapshot doesn't change.
    """
    plain = m.drop(*state_columns(m))
    dims = [s.dim for s in specs]
    for d in dims:
        vector_column(d, vector_dims(m))
    if limit:
        chosen = {d: stage(pending(m, d, limit).select("id")) for d in dims}
        marked = m
        for d in dims:
            flags = chosen[d].df.withColumn(f"_due_{d}", F.lit(True))
            marked = marked.join(F.broadcast(flags) if chosen[d].small else flags, "id", "left")
        due = {d: F.coalesce(F.col(f"_due_{d}"), F.lit(False)) for d in dims}
    else:
        marked = m
        due = {d: F.coalesce(F.col("is_active"), F.lit(False)) & (vector_state(m, d) != REAL) for d in dims}
    marked = marked.withColumns({f"_due_{d}": due[d] for d in dims}).drop(*state_columns(m))
    near = marked
    if limit and all(c.small for c in chosen.values()):
        # The few chosen ids leave out all other rows before their texts move.
        ids = chosen[dims[0]].df
        for d in dims[1:]:
            ids = ids.unionByName(chosen[d].df)
        near = m.drop(*state_columns(m)).join(F.broadcast(ids.distinct()), "id", "left_semi")
        for d in dims:
            near = near.join(F.broadcast(chosen[d].df.withColumn(f"_due_{d}", F.lit(True))), "id", "left")
        near = near.fillna(False, [f"_due_{d}" for d in dims])
    if dry_run:
        return Backfill(plain, _dry_stats(marked, dims), {})

    work = marked.withColumn("_touched", F.lit(False))
    fresh: dict[int, DataFrame] = {}
    stats: list[DataFrame] = []
    for spec in specs:
        d = spec.dim
        rows = near.where(f"_due_{d}")
        vectors = embed_texts(rows.select(F.col("content").alias("text")), spec, cache)
        fresh[d] = cache_entries(vectors.df, spec, F.unix_timestamp(now))
        text = f"_text_{d}"
        joined = attach_embedding(
            work.withColumn(text, F.when(F.col(f"_due_{d}"), F.col("content"))), text, spec, vectors
        )
        work = joined.withColumns(
            {
                f"vector_{d}": F.when(F.col(f"_due_{d}") & (F.col("status") != ERROR), F.col("vector")).otherwise(F.col(f"vector_{d}")),
                "_touched": F.col("_touched") | (F.col(f"_due_{d}") & (F.col("status") != ERROR)),
            }
        ).drop("vector", "status", "error", "key", text)
        stats.append(_embed_counts(rows, vectors.df, d))
    stamp = F.when(F.col("_touched"), now.cast(plain.schema["updated_at"].dataType)).otherwise(F.col("updated_at"))
    done = work.withColumn("updated_at", stamp)
    summary = stats[0]
    for s in stats[1:]:
        summary = summary.unionByName(s)
    return Backfill(done.select(*plain.columns), summary, fresh)


def _embed_counts(rows: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """Counts of one width: rows by number, failures from the texts' own counts, so no text is looked up again."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    failed = [F.coalesce(F.sum(F.when(F.col("status") == s, F.col("n"))), F.lit(0)).alias(c) for s, c in ((ERROR, "errors"), (FALLBACK, "zero_fallbacks"))]
    return total.join(vectors.agg(*failed), how="cross").select(
        F.lit(dim).alias("dim"), "total", (F.col("total") - F.col("errors")).alias("embedded"), "zero_fallbacks",
        F.lit(0).cast("long").alias("skipped"), "errors",
    )


def _dry_stats(marked: DataFrame, dims: Sequence[int]) -> DataFrame:
    counts = marked.agg(*[F.count_if(f"_due_{d}").alias(f"n_{d}") for d in dims])
    zero = F.lit(0).cast("long")
    rows = F.array(
        *[
            F.struct(F.lit(d).alias("dim"), F.col(f"n_{d}").alias("total"), F.col(f"n_{d}").alias("embedded"),
                     zero.alias("zero_fallbacks"), zero.alias("skipped"), zero.alias("errors"))
            for d in dims
        ]
    )
    return counts.select(F.inline(rows))


def current_state(events: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """State per memory after a stream of mutations ``(memory_id, op, content, ts, event_id)``.

    The first ``add`` of an unknown id inserts and later ones are rejected; ``update`` sets content
    and vector text, ``embed`` the vector text only, ``forget`` is final for activity. Mutations
    before the insert touch nothing. One aggregation with mergeable minima and maxima per id: order
    of arrival does not matter, and an id with very many mutations is combined map-side.

    ``base`` rows ``(id, content, is_active, created_at, updated_at)`` count as inserted before.
    """

    def pick(agg, op: str, name: str) -> Column:
        when = F.when(F.col("op") == op, F.struct("ts", "event_id", "content"))
        return agg(when).alias(name)

    per_id = events.groupBy(F.col("memory_id").alias("id")).agg(
        pick(F.min, "add", "_add"),
        pick(F.max, "update", "_update"),
        pick(F.max, "embed", "_embed"),
        pick(F.max, "forget", "_forget"),
    )
    if base is not None:
        kept = base.select(
            "id", F.col("content").alias("_content"), F.col("is_active").alias("_active"),
            F.col("created_at").alias("_created"), F.col("updated_at").alias("_updated"), F.lit(True).alias("_base"),
        )
        per_id = per_id.join(kept, "id", "full_outer")
        known = F.coalesce(F.col("_base"), F.lit(False))
    else:
        known = F.lit(False)

    def counts(name: str) -> Column:
        c = F.col(name)
        return c.isNotNull() & (known | (c > F.col("_add")))

    def or_base(column: str) -> Column:
        return F.col(column) if base is not None else F.lit(None)

    def value(name: str, field: str) -> Column:
        return F.when(counts(name), F.col(name).getField(field))

    inserted = ~known & F.col("_add").isNotNull()
    start_content = F.when(inserted, F.col("_add.content")).otherwise(or_base("_content"))
    start_time = F.when(inserted, F.col("_add.ts")).otherwise(or_base("_created"))
    last_touch = F.when(inserted, F.col("_add.ts")).otherwise(or_base("_updated"))
    newest_text = F.greatest(
        F.when(counts("_update"), F.col("_update")), F.when(counts("_embed"), F.col("_embed"))
    ).getField("content")
    return per_id.where(known | inserted).select(
        "id",
        F.coalesce(value("_update", "content"), start_content).alias("content"),
        F.coalesce(newest_text, start_content).alias("vector_text"),
        (F.coalesce(or_base("_active"), F.lit(True)) & ~counts("_forget")).alias("is_active"),
        start_time.alias("created_at"),
        F.greatest(last_touch, value("_update", "ts"), value("_embed", "ts"), value("_forget", "ts")).alias("updated_at"),
    )
