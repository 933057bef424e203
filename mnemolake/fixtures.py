"""Memory stores derived from the test tables, each as a DataFrame and as the same thing in SQL.

All of them cover their whole source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import stemmer
from .functions.text import stop_words
from .operators.text_index import build_postings
from .operators.staging import split_by_keys
from .schemas import CATEGORY_SEED, category_seed
from .sources.tables import widen

DIM, SMALL_DIM = 64, 32
FIXTURE_DIMS = (DIM, SMALL_DIM)
NOW = "2024-06-01 00:00:00"
TEXT_TABLES = ("documents", "conversations", "embeddings")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return widen(rows) if name in TEXT_TABLES else rows


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def categories(spark: SparkSession) -> DataFrame:
    return category_seed(spark)


def memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One memory per document, with vectors of two widths where an embedding of its id exists."""
    docs = table(spark, sf_dir, "documents")
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    d = F.col("doc_id")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    born = F.when(d % 97 != 0, F.timestamp_add("MINUTE", d.cast("int"), start))
    v = F.col("embedding")
    # Texts without an embedding or a label stay where they lie.
    keys = vectors.select("doc_id").unionByName(labels.select(F.col("doc_id").cast(vectors.schema["doc_id"].dataType)))
    near, far = split_by_keys(docs, keys, "doc_id")
    known = near.join(vectors, "doc_id", "left").join(labels, "doc_id", "left")
    return (
        known.unionByName(far, allowMissingColumns=True)
        .select(
            d.alias("id"),
            F.when(d % 9 != 0, d % 9).cast("smallint").alias("category_id"),
            F.when(F.col("lang") == "en", "memory").otherwise("user").alias("target"),
            F.col("text").alias("content"),
            F.when(d % 17 == 0, F.transform(v, lambda x: (x * 0).cast("float"))).otherwise(v).alias(f"vector_{DIM}"),
            F.when(F.col("lang") != "en", F.slice(v, 1, SMALL_DIM)).alias(f"vector_{SMALL_DIM}"),
            F.lit(None).cast("string").alias("source_session"),
            F.when(F.col("quality") == 1, 90).when(F.col("quality") == 0, 40).otherwise(80).cast("smallint").alias("confidence"),
            (d % 10 != 3).alias("is_active"),
            born.alias("created_at"),
            born.alias("updated_at"),
            F.when(d % 7 == 0, F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")).alias("expires_at"),
            F.when(d % 11 == 0, F.array().cast("array<string>")).otherwise(F.array("source", "lang")).alias("tags"),
            F.to_json(F.struct(F.col("n_chars").alias("n"), F.col("source").alias("src"))).alias("metadata"),
        )
    )


def _with_vector(q: DataFrame, spark: SparkSession, sf_dir: str, number) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    total = vectors.agg(F.count(F.lit(1))).scalar()
    keyed = q.withColumn("_vec", number % total)
    return keyed.join(vectors.select(F.col("vec_id").alias("_vec"), F.col("embedding").alias("query_vector")), "_vec").drop("_vec")


def _word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = build_postings(table(spark, sf_dir, "documents"), id_col="doc_id", text_col="text")
    return words.select(F.col("id").alias("doc_id"), F.col("lexeme").alias("w"), F.size("positions").alias("n"))


def known_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query for every document: its most frequent and its longest word."""
    words = _word_counts(spark, sf_dir).groupBy(F.col("doc_id").alias("qid")).agg(
        F.min_by("w", F.struct(-F.col("n"), "w")).alias("_often"),
        F.min_by("w", F.struct(-F.length("w"), "w")).alias("_long"),
    )
    q = words.select("qid", F.concat_ws(" ", "_often", "_long").alias("query_text"))
    return _with_vector(q, spark, sf_dir, F.col("qid"))


def filtered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same queries with targets, categories, weights and limits of their own."""
    qid = F.col("qid")
    return known_items(spark, sf_dir).withColumns(
        {
            "target": F.when(qid % 3 == 1, "memory").when(qid % 3 == 2, "user"),
            "category": F.when(qid % 5 == 1, "fact").when(qid % 5 == 2, "workflow").when(qid % 5 == 3, "no_such_category"),
            "text_weight": F.when(qid % 4 == 1, 0.0).when(qid % 4 == 2, 1.5).when(qid % 4 == 3, 0.3),
            "top_k": F.when(qid % 4 == 1, 3).when(qid % 4 == 2, 60),
        }
    )


def frequent_words(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Distinct combinations of the n most frequent words of each document, as queries."""
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "w")))
    top = _word_counts(spark, sf_dir).groupBy("doc_id").agg(F.slice(order, 1, n).alias("t"))
    text = F.array_join(F.array_sort(F.transform("t", lambda x: x["w"])), " ")
    return top.select(text.alias("qid")).distinct().withColumn("query_text", F.col("qid"))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query_text"))
    return _with_vector(q, spark, sf_dir, F.col("qid"))


def mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mutation_events(table(spark, sf_dir, "events"))


def mutation_events(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    op = (
        F.when(kind == "signup", "add").when(kind == "error", "forget").when(kind == "purchase", "embed").otherwise("update")
    )
    return events.select(
        "event_id", F.col("user_id").alias("memory_id"), op.alias("op"), F.col("props").alias("content"), "ts"
    )


def mirror_events(conversations: DataFrame) -> DataFrame:
    action = F.when(F.col("role") == "system", "noop").when(F.col("turn") % 2 == 0, "add").otherwise("replace")
    return conversations.select(
        F.format_string("%d-%d", "conv_id", "turn").alias("id"),
        action.alias("action"),
        F.when(F.col("role") == "user", "user").otherwise("memory").alias("target"),
        F.col("text").alias("content"),
        F.to_json(F.struct("turn", F.when(F.col("turn") == 1, F.lit("given")).alias("action"))).alias("metadata"),
    )


def embed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    text = F.when(d % 101 == 0, "").when(d % 103 == 0, "   ").otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


# The same fixtures in SQL, as common table expressions.

CATEGORIES_SQL = "categories(id, name) AS (VALUES " + ", ".join(f"({i}, '{n}')" for i, n in CATEGORY_SEED) + ")"

MEMORY_SQL = f"""memory AS (
  SELECT d.doc_id AS id,
    CASE WHEN d.doc_id % 9 <> 0 THEN d.doc_id % 9 END AS category_id,
    CASE WHEN lang = 'en' THEN 'memory' ELSE 'user' END AS target,
    text AS content,
    CASE WHEN d.doc_id % 17 = 0 THEN list_transform(embedding, lambda x: (x * 0)::FLOAT) ELSE embedding END AS vector_{DIM},
    CASE WHEN lang <> 'en' THEN embedding[1:{SMALL_DIM}] END AS vector_{SMALL_DIM},
    CASE quality WHEN 1 THEN 90 WHEN 0 THEN 40 ELSE 80 END AS confidence,
    d.doc_id % 10 <> 3 AS is_active,
    CASE WHEN d.doc_id % 97 <> 0 THEN TIMESTAMP '2024-01-01' + d.doc_id * INTERVAL 1 MINUTE END AS created_at,
    CASE WHEN d.doc_id % 97 <> 0 THEN TIMESTAMP '2024-01-01' + d.doc_id * INTERVAL 1 MINUTE END AS updated_at,
    CASE WHEN d.doc_id % 7 = 0 THEN TIMESTAMP '2024-01-02' END AS expires_at,
    CASE WHEN d.doc_id % 11 = 0 THEN []::VARCHAR[] ELSE [source, lang] END AS tags,
    source, n_chars
  FROM documents d
  LEFT JOIN embeddings e ON e.vec_id = d.doc_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

TOKENS_SQL = r"""tokens AS (
  SELECT id, unnest(toks) AS lexeme, generate_subscripts(toks, 1) AS pos
  FROM (SELECT id, regexp_extract_all(lower(content), '[\p{L}\p{N}]+') AS toks FROM memory))"""

POSTINGS_SQL = """postings AS (
  SELECT id, lexeme, list_sort(list(DISTINCT pos)) AS positions, count(*) AS n
  FROM tokens GROUP BY id, lexeme)"""

TEXT_SQL = f"{MEMORY_SQL},\n{TOKENS_SQL},\n{POSTINGS_SQL}"



def _endings(rules) -> str:
    return "(" + "|".join(sorted(rules, key=lambda e: (-len(e), e))) + ")$"


def _map_sql(rules: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in rules.items()) + "}"


def stems_sql(words: str, name: str = "stems") -> str:
    """CTE ``name(token, lexeme)``: English stems of the rows of ``words(token)``, step by step from the rule tables."""
    region = stemmer.REGION.pattern
    short = stemmer.SHORT_END.pattern
    vowel = stemmer.VOWEL.pattern
    doubles = "(" + "|".join(c * 2 for c in "bdfgmnprt") + ")$"
    return f"""{name}_1 AS (SELECT token, regexp_replace(CASE WHEN token[1] = 'y' THEN 'Y' || token[2:] ELSE token END, '([aeiouy])y', '\\1Y', 'g') AS w FROM {words}),
{name}_2 AS (SELECT *, length(regexp_extract(w, '^(?:{stemmer.REGION_PREFIX.pattern}|{region})')) AS h FROM {name}_1),
{name}_3 AS (SELECT *, CASE h WHEN 0 THEN length(w) ELSE h END AS r1, length(regexp_extract(substr(w, CASE h WHEN 0 THEN length(w) ELSE h END + 1), '^{region}')) AS g FROM {name}_2),
{name}_4 AS (SELECT *, CASE g WHEN 0 THEN length(w) ELSE r1 + g END AS r2, CASE WHEN w LIKE '%sses' THEN w[:-3]
    WHEN regexp_matches(w, '(ied|ies)$') THEN CASE WHEN length(w) > 4 THEN w[:-3] ELSE w[:-2] END
    WHEN regexp_matches(w, '(us|ss)$') OR w NOT LIKE '%s' THEN w
    WHEN regexp_matches(w[:-3], '{vowel}') THEN w[:-2] ELSE w END AS p FROM {name}_3),
{name}_5 AS (SELECT *, regexp_extract(p, '{_endings(stemmer.PAST)}') AS e FROM {name}_4),
{name}_6 AS (SELECT *, left(p, length(p) - length(e)) AS b FROM {name}_5),
{name}_7 AS (SELECT token, r1, r2, p, CASE WHEN e LIKE 'eed%' THEN CASE WHEN length(b) >= r1 THEN b || 'ee' ELSE p END
    WHEN e = '' OR NOT regexp_matches(b, '{vowel}') THEN p WHEN regexp_matches(b, '(at|bl|iz)$') THEN b || 'e'
    WHEN regexp_matches(b, '{doubles}') THEN b[:-2] WHEN r1 >= length(b) AND regexp_matches(b, '{short}') THEN b || 'e' ELSE b END AS q FROM {name}_6),
{name}_8 AS (SELECT * REPLACE (CASE WHEN length(q) > 2 THEN regexp_replace(q, '([^aeiouy])[yY]$', '\\1i') ELSE q END AS q) FROM {name}_7),
{name}_9 AS (SELECT *, regexp_extract(q, '{_endings(stemmer.DERIVED)}') AS e, left(q, length(q) - length(regexp_extract(q, '{_endings(stemmer.DERIVED)}'))) AS b FROM {name}_8),
{name}_10 AS (SELECT token, r1, r2, p, CASE WHEN length(b) >= r1 AND CASE e WHEN 'ogi' THEN b LIKE '%l' WHEN 'li' THEN regexp_matches(b, '[cdeghkmnrt]$') ELSE e <> '' END
    THEN b || {_map_sql(stemmer.DERIVED)}[e] ELSE q END AS d FROM {name}_9),
{name}_11 AS (SELECT *, regexp_extract(d, '{_endings(stemmer.ADJECTIVAL)}') AS e, left(d, length(d) - length(regexp_extract(d, '{_endings(stemmer.ADJECTIVAL)}'))) AS b FROM {name}_10),
{name}_12 AS (SELECT token, r1, r2, p, CASE WHEN e <> '' AND length(b) >= CASE e WHEN 'ative' THEN greatest(r1, r2) ELSE r1 END
    THEN b || {_map_sql(stemmer.ADJECTIVAL)}[e] ELSE d END AS a FROM {name}_11),
{name}_13 AS (SELECT *, regexp_extract(a, '{_endings(stemmer.DROPPED)}') AS e, left(a, length(a) - length(regexp_extract(a, '{_endings(stemmer.DROPPED)}'))) AS b FROM {name}_12),
{name}_14 AS (SELECT token, r1, r2, p, CASE WHEN length(b) >= r2 AND CASE e WHEN 'ion' THEN regexp_matches(b, '[st]$') ELSE e <> '' END THEN b ELSE a END AS x FROM {name}_13),
{name}_15 AS (SELECT *, left(x, length(x) - 1) AS b FROM {name}_14),
{name} AS (SELECT token, CASE WHEN length(token) <= 2 THEN token WHEN {_map_sql(stemmer.IRREGULAR)}[token] IS NOT NULL THEN {_map_sql(stemmer.IRREGULAR)}[token]
    WHEN p IN ({", ".join(f"'{w}'" for w in stemmer.DONE_AFTER_PLURAL)}) THEN p
    WHEN x LIKE '%e' AND (length(b) >= r2 OR length(b) >= r1 AND NOT regexp_matches(b, '{short}')) THEN replace(b, 'Y', 'y')
    WHEN x LIKE '%ll' AND length(b) >= r2 THEN replace(b, 'Y', 'y') ELSE replace(x, 'Y', 'y') END AS lexeme FROM {name}_15)"""


#: Like ``TEXT_SQL``, with the words of all texts and of the queries in ``{q}(query_text)`` stemmed.
STOP_SQL = "(" + ", ".join(f"'{w}'" for w in stop_words()) + ")"
ENGLISH_SQL = rf"""{MEMORY_SQL},
raw AS (
  SELECT id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos
  FROM (SELECT id, regexp_extract_all(lower(content), '[\p{{L}}\p{{N}}]+') AS toks FROM memory)),
vocabulary AS (SELECT DISTINCT token FROM raw WHERE token NOT IN {STOP_SQL}),
{stems_sql("vocabulary")},
tokens AS (SELECT id, lexeme, pos FROM raw JOIN stems USING (token)),
{POSTINGS_SQL}"""

_VECTOR_OF = "JOIN embeddings e ON e.vec_id = q.qid % (SELECT count(*) FROM embeddings)"

KNOWN_SQL = f"""words AS (
  SELECT id AS qid, arg_min(lexeme, (-n, lexeme)) AS often, arg_min(lexeme, (-length(lexeme), lexeme)) AS long
  FROM postings GROUP BY id),
known AS (SELECT q.qid, q.often || ' ' || q.long AS query_text, e.embedding AS query_vector FROM words q {_VECTOR_OF})"""

FREQUENT_SQL = """frequent AS (
  SELECT DISTINCT array_to_string(list_sort(list(lexeme)), ' ') AS qid
  FROM (SELECT id, lexeme, row_number() OVER (PARTITION BY id ORDER BY n DESC, lexeme) AS k FROM postings)
  WHERE k <= {n} GROUP BY id)"""

BENCHMARK_SQL = f"""bench AS (
  SELECT q.qid, q.query_text, e.embedding AS query_vector
  FROM (SELECT item_id AS qid, text AS query_text FROM benchmark) q {_VECTOR_OF})"""

MUTATIONS_SQL = """mutations AS (
  SELECT event_id, user_id AS memory_id, props AS content, ts,
    CASE event_type WHEN 'signup' THEN 'add' WHEN 'error' THEN 'forget' WHEN 'purchase' THEN 'embed' ELSE 'update' END AS op
  FROM events)"""

MIRROR_SQL = """mirror AS (
  SELECT conv_id || '-' || turn AS id,
    CASE WHEN role = 'system' THEN 'noop' WHEN turn % 2 = 0 THEN 'add' ELSE 'replace' END AS action,
    CASE WHEN role = 'user' THEN 'user' ELSE 'memory' END AS target,
    text AS content, turn
  FROM conversations)"""

REQUESTS_SQL = """requests AS (
  SELECT doc_id, CASE WHEN doc_id % 101 = 0 THEN '' WHEN doc_id % 103 = 0 THEN '   ' ELSE text END AS text
  FROM documents)"""
