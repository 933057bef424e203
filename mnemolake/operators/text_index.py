"""Text analysis, postings, and the AND match of query lexemes against them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stemmer import stem_word, with_stems
from ..functions.text import CONFIGS, grammar_tokens, log_misses, positions, rank_at, rank_of_count, spread, stop_words, tokens
from .staging import (
    BROADCAST_BYTES,  # noqa: F401
    HEAVY_MIN_ROWS,
    Staged,
    balanced_join,
    counted_heavy_keys,
    may_hold,
    prunable,
    stage,
    top_per_query,
)


POSTING_BUCKETS = 64
LEXICON_WORDS = 500_000
#: Tokens that a task sorts at a time, if no single text has more, and words whose stems it remembers.
TOKENS_AT_A_TIME, KNOWN_WORDS = 1 << 20, 200_000
#: Positions of the memories of one block, and searches of one block: what a task holds at a time.
BLOCK_POSITIONS, BLOCK_SEARCHES = 1 << 22, 1 << 18
#: Blocks of memories are made so small that this many run at a time, but not below so many positions.
LEAST_BLOCKS, LEAST_POSITIONS = 24, 1 << 17
#: Pairs of search and memory, and positions, that a task compares at a time.
PAIRS_AT_A_TIME = 1 << 19
RANK_DIGITS = 9


def _check(config: str) -> None:
    if config not in CONFIGS:
        raise ValueError(f"unknown text config {config!r}; expected one of {list(CONFIGS)}")


def _words(text: Column, grammar: bool) -> Column:
    return grammar_tokens(text) if grammar else tokens(text)


def token_rows(df: DataFrame, text_col: str, keep: Sequence[str], config: str = "simple", grammar: bool = False) -> DataFrame:
    """One row per token with its 1-based position; stop words leave gaps, as they are counted first.

    ``grammar`` knows addresses, paths, numbers and compounds next to words, see ``grammar_parts``.
    """
    _check(config)
    rows = df.select(*keep, F.posexplode(_words(F.col(text_col), grammar)).alias("_p", "token"))
    rows = rows.select(*keep, "token", (F.col("_p") + 1).alias("pos"))
    return rows if config == "simple" else rows.where(~F.col("token").isin(stop_words()))


@dataclass(frozen=True)
class Lexicon:
    """Stems ``(token, lexeme)``: ``words`` has the frequent words, ``stems`` every word of the corpus.

    ``complete`` when ``words`` has every word too.
    """

    words: Staged
    stems: DataFrame
    complete: bool


def build_lexicon(tokens_df: DataFrame, max_words: int = LEXICON_WORDS) -> Lexicon:
    """Stem every token once, however often it occurs.

    ``words`` keeps tokens with at least ``1 / max_words`` of all occurrences, so there are at most
    ``max_words`` of them and the table can be broadcast whatever the corpus. A corpus of fewer
    tokens than that is covered completely. ``stems`` adds all rarer tokens, which are stemmed when it is read.
    """
    counts = stage(
        tokens_df.groupBy("token").agg(F.count(F.lit(1)).alias("n")), total=F.coalesce(F.sum("n"), F.lit(0))
    )
    frequent = F.col("n") * max_words >= counts.seen["total"]
    words = stage(with_stems(counts.df.where(frequent).select("token")))
    if words.rows == counts.rows:
        return Lexicon(words, words.df, True)
    rare = with_stems(counts.df.where(~frequent).select("token"))
    return Lexicon(words, words.df.unionByName(rare), False)


def analyze(
    df: DataFrame,
    text_col: str,
    keep: Sequence[str] = ("id",),
    config: str = "simple",
    lexicon: Lexicon | None = None,
) -> DataFrame:
    """Lexeme rows ``(*keep, lexeme, pos)`` of every text.

    ``english`` takes the stems of frequent words from a lexicon, built here unless given, and
    only rows of rare words pass through the stemmer. Neither way shuffles the token rows.
    """
    rows = token_rows(df, text_col, keep, config)
    if config == "simple":
        return rows.withColumnRenamed("token", "lexeme")
    complete = lexicon is None
    lexicon = lexicon or build_lexicon(rows.select("token"))
    words = F.broadcast(lexicon.words.df)
    frequent = rows.join(words, "token").select(*keep, "lexeme", "pos")
    if complete and lexicon.complete:
        return frequent
    rare = rows.join(words, "token", "left_anti")
    return frequent.unionByName(with_stems(rare).select(*keep, "lexeme", "pos"))


def build_postings(
    m: DataFrame,
    config: str = "simple",
    id_col: str = "id",
    text_col: str = "content",
    lexicon: Lexicon | None = None,
    grammar: bool = False,
) -> DataFrame:
    """Positions of every lexeme per memory: ``(id, lexeme, positions)``.

    All tokens of a text lie in its row, so its postings are built there and nothing is shuffled: in Arrow batches,
    tokens become numbers of a dictionary, numbers and positions are sorted text by text and cut into runs. ``english``
    stems the entries of the dictionary that are words or compounds. ``grammar`` as in ``token_rows``. With a ``lexicon``, stems come from there, by rows, which takes a shuffle.
    """
    _check(config)
    rows = m.select(F.col(id_col).alias("id"), text_col)
    if lexicon is not None:
        grouped = analyze(rows, text_col, ("id",), config, lexicon).groupBy("id", "lexeme").agg(F.collect_list("pos").alias("_all"))
        return grouped.select("id", "lexeme", positions(F.col("_all")).alias("positions"))
    english, stops = config == "english", stop_words() if config == "english" else []

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, str] = {}

        def stemmed(words: list[str]) -> list[str]:
            if len(known) > KNOWN_WORDS:
                known.clear()
            return [known[w] if w in known else known.setdefault(w, stem_word(w) if _is_word(w) else w) for w in words]

        for b in batches:
            sizes = b.column(1).value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum(sizes)
            for lo, hi in _parts(ends, TOKENS_AT_A_TIME):
                part = b.slice(lo, hi - lo)
                yield _runs(part.column(0), part.column(1), sizes[lo:hi], stops, stemmed if english else None)

    schema = rows.select("id", F.lit("").alias("lexeme"), F.array(F.lit(0)).alias("positions")).schema
    return rows.select("id", _words(F.col(text_col), grammar).alias("_tokens")).mapInArrow(build, schema)


def _is_word(token: str) -> bool:
    return all(map(str.isalnum, token.split("-")))


def _parts(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with some ``most`` tokens each; a longer text is a range of its own."""
    lo = 0
    while lo < len(ends):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + most, "right")))
        yield lo, hi
        lo = hi


def _runs(ids: pa.Array, lists: pa.Array, sizes: np.ndarray, stops: list[str], stems: Callable[[list[str]], list[str]] | None) -> pa.RecordBatch:
    """A row per text and lexeme with its positions; stop words are counted and left out."""
    coded = lists.flatten().dictionary_encode()
    words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    pos = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
    if stems is not None:
        keep = ~pc.is_in(words, value_set=pa.array(stops, pa.string())).to_numpy(zero_copy_only=False)[code] if len(words) else code == code
        text, pos, code = text[keep], pos[keep], code[keep]
        again = pa.array(stems(words.to_pylist()), pa.string()).dictionary_encode()
        words, code = again.dictionary, again.indices.to_numpy(zero_copy_only=False).astype(np.int64)[code]
    key = text * max(len(words), 1) + code
    order = np.argsort(key, kind="stable")  # positions of equal keys stay in order
    key = key[order]
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    first = order[start]
    offsets = pa.array(np.append(start, len(key)).astype(np.int32))
    found = pa.ListArray.from_arrays(offsets, pa.array(pos[order].astype(np.int32)))
    return pa.RecordBatch.from_arrays([ids.take(pa.array(text[first])), words.take(pa.array(code[first])), found], names=["id", "lexeme", "positions"])


def update_postings(
    postings: DataFrame, m: DataFrame, changed: Staged, config: str = "simple", lexicon: Lexicon | None = None, grammar: bool = False
) -> DataFrame:
    """Postings after the memories with the ``changed`` ids were added, edited or removed.

    Only those texts are analysed again; the postings of all others are kept as they are.
    """
    ids = changed.df.select("id")
    side = F.broadcast(ids) if changed.small else ids
    kept = postings.join(side, "id", "left_anti").select("id", "lexeme", "positions")
    rows = m.select("id", "content").join(side, "id", "left_semi")
    return kept.unionByName(build_postings(rows, config, lexicon=lexicon, grammar=grammar))


def document_frequency(postings: DataFrame) -> DataFrame:
    return postings.groupBy("lexeme").agg(F.count(F.lit(1)).alias("df"))


def analyze_queries(q: DataFrame, config: str = "simple", by: str = "qid", text_col: str = "query_text", grammar: bool = False) -> DataFrame:
    """Distinct lexemes per query with their number: ``(qid, lexeme, n_terms)``.

    Texts without a lexeme give no row, and so match nothing.
    """
    rows = token_rows(q, text_col, (by,), config, grammar).select(by, "token")
    if config == "english":
        word = F.col("token").rlike(r"^[\p{L}\p{N}]+(-[\p{L}\p{N}]+)*$")
        rows = with_stems(rows.distinct()).select(by, F.when(word, F.col("lexeme")).otherwise(F.col("token")).alias("lexeme"))
    else:
        rows = rows.withColumnRenamed("token", "lexeme")
    per_query = rows.groupBy(by).agg(F.array_sort(F.collect_set("lexeme")).alias("_terms"))
    return per_query.select(by, F.explode("_terms").alias("lexeme"), F.size("_terms").alias("n_terms"))


def postings_bucket(lexeme: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(lexeme), F.lit(buckets)).cast("int")


def write_postings(postings: DataFrame, path: str, buckets: int = POSTING_BUCKETS) -> None:
    """Persist postings in directories by lexeme bucket, sorted by lexeme inside each file.

    A search touches only the buckets of its own lexemes. The rebalance hint lets AQE split a bucket
    that one very frequent lexeme makes too large, so no single task writes it.
    """
    bucketed = postings.withColumn("bucket", postings_bucket(F.col("lexeme"), buckets))
    bucketed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "lexeme").write.partitionBy("bucket").parquet(path)


def distinct_searches(terms: Staged, wanted: DataFrame | None, filters: Sequence[str], by: str = "qid") -> tuple[Staged, Staged]:
    """Equal searches once: ``(_sid, _terms, *filters)``, and the queries ``(qid, _sid, ...)`` that ask them.

    Queries that have the same lexemes and filters have the same matches and ranks, so these are looked up once,
    however many ask for them. ``wanted`` has the filters and other columns per query.
    """
    per_query = terms.df.groupBy(by).agg(F.array_sort(F.collect_list("lexeme")).alias("_terms"))
    asked = per_query.where(F.col(by).isNotNull()) if wanted is None else per_query.join(wanted, by)
    if wanted is not None or terms.rows >= HEAVY_MIN_ROWS:
        asked = stage(asked).df
    key = ["_terms", *filters]
    searches = stage(asked.select(*key).distinct().withColumn("_sid", F.monotonically_increasing_id()))
    a, s = asked.alias("a"), searches.df.alias("s")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"s.{c}")) for c in key]
    found = a.join(F.broadcast(s) if searches.small else s, same)
    return searches, stage(found.select("_sid", *[F.col(f"a.{c}") for c in asked.columns if c not in key]))


def asked_postings(terms: Staged, postings: DataFrame, allowed: DataFrame, all_allowed: bool) -> Staged:
    """Postings ``(id, lexeme, n, positions)`` that a search may need, staged; there may be others among them.

    A large batch's words and the searchable ids are tested by hashed bits, which sends no posting through a shuffle.
    Where no query has several words, positions are only counted.
    """
    if "bucket" in postings.columns and terms.small:
        vocabulary = terms.df.select("lexeme").distinct().withColumn("bucket", postings_bucket(F.col("lexeme"), POSTING_BUCKETS))
        hits = postings.join(F.broadcast(prunable(vocabulary, "bucket")), ["bucket", "lexeme"], "left_semi")
    elif terms.small:
        hits = postings.join(F.broadcast(terms.df.select("lexeme").distinct()), "lexeme", "left_semi")
    else:
        hits = may_hold(postings, terms.df.select("lexeme"), "lexeme")
    if not all_allowed and postings.schema["id"].dataType == allowed.schema["id"].dataType:
        hits = may_hold(hits, allowed.select("id"), "id")
    several = terms.df.agg(F.coalesce(F.max("n_terms"), F.lit(0))).first()[0] > 1
    held = F.col("positions") if several else F.lit(None).cast(postings.schema["positions"].dataType)
    rows = hits.select("id", "lexeme", F.size("positions").alias("n"), held.alias("positions"))
    return stage(rows, held=F.coalesce(F.sum(F.when(F.col("positions").isNotNull(), F.col("n")).otherwise(0).cast("long")), F.lit(0)))


def ranked_matches(
    searches: Staged, found: Staged, allowed: DataFrame, filters: dict[str, str] | None = None, limit: int | None = None
) -> DataFrame:
    """Memories that hold every lexeme of a search: ``(_sid, id, text_rank)``, the best ``limit`` if given.

    A search of one lexeme ranks by its number of positions. All others are cut into blocks that meet blocks of memories:
    a task holds the postings of its memories, goes through those of each search's rarest lexeme, looks the others up by
    lexeme and memory, and gives back its best rows, so that no pair of search and memory goes through a shuffle.
    ``filters`` names for each column of the searches the column of ``allowed`` that it must equal, if it is not null.
    """
    filters = filters or {}
    frequency = document_frequency(found.df)
    asked = searches.df.select(F.explode("_terms").alias("lexeme")).distinct()
    words = stage(asked.join(frequency, "lexeme").withColumn("_code", F.monotonically_increasing_id()))
    listed = searches.df.select("_sid", F.explode("_terms").alias("lexeme"))
    listed = balanced_join(listed, words.df, "lexeme", right_small=words.small)
    codes = F.array_sort(F.collect_list(F.struct("df", "_code")))
    coded = listed.groupBy("_sid").agg(F.transform(codes, lambda x: x["_code"]).alias("_codes"))
    coded = coded.join(searches.df.select("_sid", F.size("_terms").alias("_n"), *filters), "_sid").where("size(_codes) = _n")
    coded = stage(coded, single=F.count_if(F.col("_n") == 1), several=F.count_if(F.col("_n") > 1))
    heavy = counted_heavy_keys(words.df, "lexeme", "df", found.rows)
    columns = [c for c in allowed.columns if c != "id"]
    named = words.df.select("lexeme", "_code")

    def own(needed: DataFrame, column: str) -> DataFrame:
        """Postings of the needed lexemes in searchable memories."""
        wanted = named if not (coded.seen["single"] and coded.seen["several"]) else named.join(needed.distinct(), "_code", "left_semi")
        rows = balanced_join(found.df.select("id", "lexeme", column), wanted, "lexeme", right_small=words.small, heavy=heavy)
        return rows.drop("lexeme").join(allowed, "id")

    parts = []
    if coded.seen["single"]:
        one = coded.df.where("_n = 1").select("_sid", F.col("_codes")[0].alias("_code"), *filters)
        hot = heavy.join(named, "lexeme").select("_code")
        met = balanced_join(own(one.select("_code"), "n"), one, "_code", right_small=coded.small, heavy=hot)
        for given, has in filters.items():
            met = met.where(F.col(given).isNull() | (F.col(given) == F.col(has)))
        hits = met.select("_sid", "id", rank_of_count(F.col("n")).alias("text_rank"))
        parts.append(hits if limit is None else top_per_query(hits, _best_first(), limit, by="_sid"))
    if coded.seen["several"]:
        many = coded.df.where("_n > 1").drop("_n")
        rows = own(many.select(F.explode("_codes").alias("_code")), "positions").select("id", "_code", "positions", *columns)
        parts.append(_block_matches(many, rows, found.seen["held"], coded.seen["several"], filters, limit))
    if not parts:
        return coded.df.select("_sid").limit(0).join(allowed.select("id"), how="cross").withColumn("text_rank", F.lit(0.0))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _best_first() -> list[Column]:
    return [F.round("text_rank", RANK_DIGITS).desc(), F.col("id").asc()]


def _block_matches(many: DataFrame, rows: DataFrame, held: int, asked: int, filters: dict[str, str], limit: int | None) -> DataFrame:
    """Every block of searches meets every block of memories, both of bounded size by a hash."""
    size = max(min(BLOCK_POSITIONS, held // LEAST_BLOCKS), LEAST_POSITIONS)
    m_blocks, s_blocks = -(-held // size) or 1, -(-asked // BLOCK_SEARCHES)

    def place(column: str, n: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = many.withColumn("_sb", place("_sid", s_blocks)).withColumn("_mb", each(m_blocks))
    right = rows.withColumn("_mb", place("id", m_blocks)).withColumn("_sb", each(s_blocks))
    key = ["_sb", "_mb"]
    schema = T.StructType([T.StructField("_sid", T.LongType()), rows.schema["id"], T.StructField("text_rank", T.DoubleType())])

    def meet(s: pa.Table, m: pa.Table) -> pa.Table:
        return _meet(s, m, filters, limit)

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, schema)


def _numbers(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Equal values of all columns as equal numbers, -1 for null."""
    coded = pa.chunked_array([c for column in columns for c in column.chunks], columns[0].type).combine_chunks().dictionary_encode()
    codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(codes, np.cumsum([len(c) for c in columns])[:-1])


def _meet(s: pa.Table, m: pa.Table, filters: dict[str, str], limit: int | None) -> pa.Table:
    """Ranks of the memories of one block for the searches of one block."""
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    ids = m.column("id").combine_chunks()
    if s.num_rows and m.num_rows:
        lists = m.column("positions").combine_chunks()
        sizes = lists.value_lengths().to_numpy().astype(np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(sizes) - sizes
        names = ids.dictionary_encode()
        doc = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n_docs = len(names.dictionary)
        place = np.empty(n_docs, np.int64)
        place[pc.sort_indices(names.dictionary).to_numpy()] = np.arange(n_docs)
        doc = place[doc]  # numbers in the order of the ids
        known, word = np.unique(m.column("_code").to_numpy(), return_inverse=True)
        key = word * n_docs + doc
        order = np.argsort(key, kind="stable")
        key = key[order]
        wanted = s.column("_codes").combine_chunks()
        n_terms = wanted.value_lengths().to_numpy().astype(np.int64)
        terms = wanted.flatten().to_numpy()
        at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
        here = known[at] == terms
        start = np.cumsum(n_terms) - n_terms
        able = np.flatnonzero(np.logical_and.reduceat(here, start))
        able = able[np.argsort(at[start[able]], kind="stable")]  # searches of one rarest lexeme side by side
        lo = np.searchsorted(key, at[start[able]] * n_docs)
        count = np.searchsorted(key, (at[start[able]] + 1) * n_docs) - lo
        checks = [_numbers(s.column(given), m.column(has).cast(s.column(given).type)) for given, has in filters.items()]
        table, reach = log_misses(), np.cumsum(count)
        i = 0
        while i < len(able):
            before = int(reach[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(reach, before + PAIRS_AT_A_TIME, "right")))
            owner = np.repeat(able[i:j], count[i:j])
            row = order[spread(lo[i:j], count[i:j])]
            i = j
            for given, has in checks:
                keep = (given[owner] < 0) | (given[owner] == has[row])
                owner, row = owner[keep], row[keep]
            found = [row]
            for t in range(1, n_terms[owner].max(initial=0)):
                has_t = np.flatnonzero(n_terms[owner] > t)
                want = at[start[owner[has_t]] + t] * n_docs + doc[row[has_t]]
                spot = np.minimum(np.searchsorted(key, want), len(key) - 1)
                other = np.full(len(row), -1)
                other[has_t] = order[spot]
                keep = np.ones(len(row), bool)
                keep[has_t] = key[spot] == want
                found = [f[keep] for f in [*found, other]]
                owner, row = owner[keep], row[keep]
            rank = np.zeros(len(row))
            most = np.cumsum(sum(np.where(f >= 0, sizes[f], 0) for f in found))
            a = 0
            while a < len(row):
                b = max(a + 1, int(np.searchsorted(most, (most[a - 1] if a else 0) + PAIRS_AT_A_TIME, "right")))
                rank[a:b] = rank_at([f[a:b] for f in found], first, sizes, flat, table)
                a = b
            if limit is not None:
                best = np.lexsort((doc[row], -np.round(rank, RANK_DIGITS), owner))
                head = np.searchsorted(owner[best], owner[best])
                best = best[np.arange(len(best)) - head < limit]
                owner, row, rank = owner[best], row[best], rank[best]
            done.append((owner, row, rank))
    owner, row, rank = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    sid = s.column("_sid").combine_chunks().take(pa.array(owner.astype(np.int64)))
    return pa.table({"_sid": sid, "id": ids.take(pa.array(row.astype(np.int64))), "text_rank": pa.array(rank)})


def asked_by(hits: DataFrame, asked: Staged) -> DataFrame:
    """The hits of every search for all queries that ask it."""
    if asked.small:
        return hits.join(F.broadcast(asked.df), "_sid").drop("_sid")
    return balanced_join(asked.df, hits, "_sid").drop("_sid")


def fts_match(terms: Staged, postings: DataFrame, allowed: DataFrame, by: str = "qid") -> DataFrame:
    """All ``(qid, id, text_rank)`` whose memory holds every lexeme of the query."""
    searches, asked = distinct_searches(terms, None, [], by)
    found = asked_postings(terms, postings, allowed, all_allowed=True)
    return asked_by(ranked_matches(searches, found, allowed.select("id")), asked).select(by, "id", "text_rank")
