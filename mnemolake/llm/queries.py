"""Every operator of this subpackage as a query over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemolake.llm.binary_ids import read_ids, write_ids
from mnemolake.llm.common import read
from mnemolake.llm.decontaminate import decontaminate
from mnemolake.llm.licenses import TEMPLATES, scan_licenses
from mnemolake.llm.merkle import FIELDS, fold_path, leaf_digest, manifest, proof_digest
from mnemolake.llm.negatives import hard_negatives
from mnemolake.llm.packing import pack
from mnemolake.llm.pieces import decode_pieces, encode_pieces
from mnemolake.llm.pii import personal_data, span_digest
from mnemolake.llm.pivot_search import top_products
from mnemolake.llm.resample import resample
from mnemolake.llm.simhash import near_duplicates
from mnemolake.llm.toxicity import score_toxicity, train_lexicon
from mnemolake.llm.url_rules import judge_urls
from mnemolake.operators.staging import scratch_path


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), known_words=600_000, keep_words=True)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans, _ = personal_data(read(spark, sf_dir, "documents"))
    return spans.select("doc_id", span_digest(F.col("spans")).alias("d")).select("doc_id", "d.*")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op4_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    write_ids(read(spark, sf_dir, "documents"), path, known_words=600_000, keep_words=True)
    return read_ids(spark, path)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return score_toxicity(documents, train_lexicon(documents, read(spark, sf_dir, "labels")))


def op8_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages")).drop("confidence")


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids, text = F.col("ids"), decode_pieces(F.col("ids"))
    return encode_pieces(read(spark, sf_dir, "documents")).select(
        "doc_id",
        (F.octet_length(ids) / 4).cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(text.cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = leaf_digest([more if f == "n_chars" else F.col(f) for f in FIELDS])
    rows = manifest(read(spark, sf_dir, "documents"), other=F.when(touched & F.col("n_chars").isNotNull(), tampered))
    rows = rows.withColumn("folded_root", fold_path(F.coalesce("other", "leaf"), F.col("path")))
    proof = proof_digest(F.col("path")).alias("proof_sha256")
    return rows.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pack, op2_pii, op3_licenses, op4_resample, op5_decontaminate, op6_token_files, op7_toxicity, op8_top_products,
        op9_simhash, op10_urls, op11_pieces, op12_negatives, op13_manifest,
    )
}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _template_rows() -> str:
    rows = []
    for number, t in enumerate(TEMPLATES):
        w = t.text.split()
        rows += [f"({number}, '{t.label}', {t.base}, {len(w) - 1}, {at}, '{w[at]}', '{w[at + 1]}')" for at in range(len(w) - 1)]
    return ", ".join(rows)


def _field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


_LEAF = " || ".join(map(_field, FIELDS))
_TAMPERED = " || ".join(_field("(n_chars::HUGEINT + 1)" if f == "n_chars" else f) for f in FIELDS)
_CRC_STEP = "list_reduce([xor(c, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
_CRC = f"xor(list_reduce(list_prepend(4294967295, list_transform(str_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), lambda c, b: {_CRC_STEP}), 4294967295)"
#: Two trees, one below the other: ``t`` of every language and ``u`` over their roots; ``s`` are siblings, ``f`` and ``g`` fold tampered leaves.
_MANIFEST = f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '') AS k, sha256({_LEAF}) AS leaf,
    CASE WHEN n_chars IS NOT NULL AND {_CRC} % 7 = 0 THEN sha256({_TAMPERED}) END AS other FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY k) AS n FROM d),
t AS (SELECT k, 0 AS lvl, pos, n, leaf AS h FROM l UNION ALL
    SELECT k, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY k, lvl, pos // 2, n),
r AS (SELECT k, h AS subroot, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, pos, n, subroot AS h FROM r UNION ALL
    SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY lvl, pos // 2, n),
s AS (SELECT l.k, l.pos, string_agg(t.h, '' ORDER BY t.lvl) AS h FROM l, unnest(range(64)) x(i) JOIN t ON t.k = l.k AND t.lvl = i AND t.pos = xor(l.pos >> i, 1) WHERE l.n > 1 GROUP BY ALL),
us AS (SELECT r.k, string_agg(u.h, '' ORDER BY u.lvl) AS h FROM r, unnest(range(64)) x(i) JOIN u ON u.lvl = i AND u.pos = xor(r.pos >> i, 1) GROUP BY ALL),
f AS (SELECT k, pos AS own, 0 AS lvl, pos, n, other AS h FROM l WHERE other IS NOT NULL UNION ALL
    SELECT f.k, own, f.lvl + 1, f.pos // 2, (f.n + 1) // 2, sha256(CASE WHEN t.h IS NULL THEN f.h WHEN f.pos % 2 = 1 THEN t.h || f.h ELSE f.h || t.h END)
    FROM f LEFT JOIN t ON t.k = f.k AND t.lvl = f.lvl AND t.pos = xor(f.pos, 1) WHERE f.n > 1),
g AS (SELECT f.k, own, 0 AS lvl, r.pos, r.n, f.h FROM f JOIN r ON r.k = f.k WHERE f.n = 1 UNION ALL
    SELECT g.k, own, g.lvl + 1, g.pos // 2, (g.n + 1) // 2, sha256(CASE WHEN u.h IS NULL THEN g.h WHEN g.pos % 2 = 1 THEN u.h || g.h ELSE g.h || u.h END)
    FROM g LEFT JOIN u ON u.lvl = g.lvl AND u.pos = xor(g.pos, 1) WHERE g.n > 1)
SELECT l.doc_id, l.leaf, r.subroot, top.h AS root, sha256(coalesce(s.h, '') || coalesce(us.h, '')) AS proof_sha256,
    coalesce(g.h, top.h) AS folded_root, coalesce(g.h, top.h) = top.h AS verified
FROM l JOIN r ON r.k = l.k JOIN (SELECT h FROM u WHERE n = 1) top ON true LEFT JOIN s ON s.k = l.k AND s.pos = l.pos
LEFT JOIN us ON us.k = l.k LEFT JOIN g ON g.k = l.k AND g.own = l.pos AND g.n = 1"""

#: The other operators use SimHash with XXH64, tokenizers or learnt models; the tests hold them against brute force.
SQL: dict[str, str] = {
    "op3_licenses": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
t(template, label, base, grams, k, a, b) AS (VALUES {_template_rows()}),
g AS (SELECT doc_id, i - 1 AS pos, w[i] AS a, w[i + 1] AS b FROM d, unnest(range(1, len(w))) u(i)),
diagonals AS (SELECT doc_id, template, label, base, grams, pos - k AS diagonal, list(DISTINCT k) AS ats FROM g JOIN t USING (a, b) GROUP BY ALL),
apart AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= 2 THEN 0 ELSE 1 END AS apart FROM diagonals),
numbered AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM apart),
spans AS (SELECT doc_id, template, label, base, span, len(list_distinct(flatten(list(ats)))) / any_value(grams) AS covered, count(*) FILTER (len(ats) = grams) AS places,
  min(diagonal) FILTER (len(ats) = grams) AS f, max(diagonal) FILTER (len(ats) = grams) AS l FROM numbered GROUP BY ALL)
SELECT d.doc_id, len(any_value(w))::BIGINT AS n_words, coalesce(sum(places) FILTER (base), 0)::BIGINT AS n_base, min(f) FILTER (base)::BIGINT AS first_word, max(l) FILTER (base)::BIGINT AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND places > 0), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND places > 0 OR NOT base AND covered >= 0.8), '') AS labels, coalesce(max(covered), 0.0)::DOUBLE AS score
FROM d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op5_decontaminate": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS g FROM d, sizes, unnest(range(1, len(w) - size + 2)) u(i)),
hits AS (SELECT doc_id, item, i, size FROM dw JOIN bw USING (size, g)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + size)) u(p) GROUP BY doc_id),
m AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id""",
    "op8_top_products": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.vec_id % 100 = 0 AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op12_negatives": """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
    "op13_manifest": _MANIFEST,
}
