import math

import pytest
from brute import lexemes, rank
from pyspark.sql import functions as F

from mnemolake import queries as catalogue
from mnemolake.functions.stemmer import stem_word, with_stems
from mnemolake.functions.text import grammar_parts, positions, stop_words, tokens, ts_rank
from mnemolake.operators import text_index as ti
from mnemolake.operators.staging import stage


def one(df):
    return df.first()[0]


def rank_of(spark, lists):
    df = spark.createDataFrame([(lists,)], "l array<array<int>>")
    return one(df.select(ts_rank(F.col("l"))))


def test_tokens(spark):
    df = spark.createDataFrame([("Élan, x2  don't—Ünder_score",)], "t string")
    assert one(df.select(tokens(F.col("t")))) == ["élan", "x2", "don", "t", "ünder", "score"]


def test_rank_of_one_lexeme(spark):
    assert rank_of(spark, [[3]]) == pytest.approx(0.0607927, abs=1e-7)
    assert rank_of(spark, [[3, 9]]) == pytest.approx(0.0607927 * 1.25, abs=1e-7)


def test_rank_of_adjacent_lexemes(spark):
    assert rank_of(spark, [[1], [2]]) == pytest.approx(0.0991, abs=1e-4)


def test_rank_of_far_equal_and_no_pairs(spark):
    assert rank_of(spark, [[1], [500]]) == pytest.approx(1e-16, rel=1e-6)
    assert rank_of(spark, [[5], [5]]) == 1e-20
    assert rank_of(spark, []) is None


@pytest.mark.parametrize("lists", [[[1, 4, 7], [2, 9]], [[1], [50], [99, 100, 101]], [[1, 2, 3], [4, 5], [6], [120]]])
def test_rank_matches_definition(spark, lists):
    assert rank_of(spark, lists) == pytest.approx(rank(lists), rel=1e-9)


def test_positions_are_capped_on_request_only(spark):
    many = list(range(1, 400)) + [20000, 30000]
    df = spark.createDataFrame([(many,)], "p array<int>")
    assert one(df.select(positions(F.col("p")))) == many
    assert one(df.select(positions(F.col("p"), max_positions=256))) == list(range(1, 257))
    late = one(spark.createDataFrame([([16400, 17000, 3],)], "p array<int>").select(positions(F.col("p"), 16383)))
    assert late == [3, 16383]


def test_stop_words():
    words = stop_words()
    assert len(words) == 127
    assert {"the", "don", "t", "s", "now"} <= set(words)
    assert not {"cannot", "could", "ought", "would", "don't"} & set(words)


# Word and stem pairs from the published description of the algorithm and its sample vocabulary.
STEMS = {
    "consign": "consign", "consigned": "consign", "consigning": "consign", "consignment": "consign",
    "consist": "consist", "consisted": "consist", "consistency": "consist", "consistent": "consist",
    "consistently": "consist", "consisting": "consist", "consists": "consist", "consolation": "consol",
    "consolations": "consol", "consolatory": "consolatori", "console": "consol", "consoled": "consol",
    "consoles": "consol", "consolidate": "consolid", "consolidated": "consolid", "consolidating": "consolid",
    "consoling": "consol", "consolingly": "consol", "consols": "consol", "consonant": "conson",
    "consort": "consort", "consorted": "consort", "consorting": "consort", "conspicuous": "conspicu",
    "conspicuously": "conspicu", "conspiracy": "conspiraci", "conspirator": "conspir",
    "conspirators": "conspir", "conspire": "conspir", "conspired": "conspir", "conspiring": "conspir",
    "constable": "constabl", "constables": "constabl", "constance": "constanc", "constancy": "constanc",
    "constant": "constant", "knack": "knack", "knackeries": "knackeri", "knacks": "knack", "knag": "knag",
    "knave": "knave", "knaves": "knave", "knavish": "knavish", "kneaded": "knead", "kneading": "knead",
    "knee": "knee", "kneel": "kneel", "kneeled": "kneel", "kneeling": "kneel", "kneels": "kneel",
    "knees": "knee", "knell": "knell", "knelt": "knelt", "knew": "knew", "knick": "knick",
    "knif": "knif", "knife": "knife", "knight": "knight", "knightly": "knight", "knights": "knight",
    "knit": "knit", "knits": "knit", "knitted": "knit", "knitting": "knit", "knives": "knive",
    "knob": "knob", "knobs": "knob", "knock": "knock", "knocked": "knock", "knocker": "knocker",
    "knockers": "knocker", "knocking": "knock", "knocks": "knock", "knopp": "knopp", "knot": "knot",
    "knots": "knot", "skies": "sky", "dying": "die", "news": "news", "ties": "tie", "cries": "cri",
    "gas": "gas", "this": "this", "gaps": "gap", "kiwis": "kiwi", "hopping": "hop", "hoped": "hope",
    "hoping": "hope", "luxuriated": "luxuri", "cry": "cri", "by": "by", "say": "say", "generate": "generat",
    "generously": "generous", "communism": "communism", "arsenal": "arsenal", "inning": "inning",
    "exceeding": "exceed", "succeeds": "succeed", "adoption": "adopt", "rational": "ration",
    "radically": "radic", "hopefulness": "hope", "goodness": "good", "sensibility": "sensibl", "youth": "youth",
    "boyish": "boyish", "enjoyment": "enjoy", "beautiful": "beauti", "apologies": "apolog", "apology": "apolog",
}


def test_stemmer(spark):
    df = spark.createDataFrame([(w,) for w in STEMS], "token string")
    got = {r.token: r.lexeme for r in with_stems(df).collect()}
    assert {w: s for w, s in got.items() if s != STEMS[w]} == {}


def test_postings_match_definition(spark, memory):
    got = {(r.id, r.lexeme): r.positions for r in ti.build_postings(memory).collect()}
    want = {(r.id, k): v for r in memory.collect() for k, v in lexemes(r.content).items()}
    assert got == want


def test_english_positions_count_stop_words(spark, memory):
    rows = ti.build_postings(memory.where("id = 1"), "english").collect()
    assert {r.lexeme: r.positions for r in rows} == {
        "quick": [2], "brown": [3], "fox": [4], "jump": [5], "lazi": [8], "dog": [9]
    }


def test_unknown_config(memory):
    with pytest.raises(ValueError):
        ti.build_postings(memory, "klingon")


def test_written_postings_are_pruned_and_equal(spark, memory, tmp_path):
    plain = ti.build_postings(memory)
    path = str(tmp_path / "postings")
    ti.write_postings(plain, path)
    stored = spark.read.parquet(path)
    terms = stage(ti.analyze_queries(spark.createDataFrame([(1, "quick dog"), (2, "brown")], "qid int, query_text string")))
    ids = memory.select("id")
    needed = {f"bucket={r.b}" for r in terms.df.select(ti.postings_bucket(F.col("lexeme"), ti.POSTING_BUCKETS).alias("b")).collect()}
    others = [f for f in (tmp_path / "postings").glob("bucket=*/*.parquet") if f.parent.name not in needed]
    assert others
    for f in others:
        f.write_bytes(b"unreadable")
    from_plain = ti.fts_match(terms, plain, ids).collect()
    assert sorted(from_plain) == sorted(ti.fts_match(terms, stored, ids).collect())
    assert {(r.qid, r.id) for r in from_plain} == {(1, 1), (1, 2), (2, 1), (2, 2), (2, 4), (2, 5), (2, 6)}


def test_query_terms_and_empty_queries(spark):
    q = spark.createDataFrame([(1, "the The dogs"), (2, "..."), (3, "the a of")], "qid int, query_text string")
    simple = {(r.qid, r.lexeme, r.n_terms) for r in ti.analyze_queries(q).collect()}
    assert simple == {(1, "the", 2), (1, "dogs", 2), (3, "the", 3), (3, "a", 3), (3, "of", 3)}
    assert {tuple(r) for r in ti.analyze_queries(q, "english").collect()} == {(1, "dog", 1)}


def test_match_without_broadcast_equals_broadcast(spark, memory, monkeypatch):
    q = spark.createDataFrame([(i, t) for i, t in enumerate(["quick", "quick brown", "brown dog", "cat x"])], "qid int, query_text string")
    terms = stage(ti.analyze_queries(q))
    postings = ti.build_postings(memory)
    small = sorted(ti.fts_match(terms, postings, memory.select("id")).collect())
    monkeypatch.setattr("mnemolake.operators.staging.BROADCAST_BYTES", -1)
    monkeypatch.setattr("mnemolake.operators.staging.HEAVY_MIN_ROWS", 1)
    monkeypatch.setattr("mnemolake.operators.text_index.HEAVY_MIN_ROWS", 1)
    assert not terms.small
    assert sorted(ti.fts_match(terms, postings, memory.select("id")).collect()) == small
    assert all(not math.isnan(r.text_rank) for r in small)


def test_rare_words_are_stemmed_without_the_lexicon(memory):
    rows = ti.token_rows(memory, "content", ("id",), "english")
    everything = sorted(ti.build_postings(memory, "english").collect())
    few = ti.build_lexicon(rows, max_words=5)
    assert 0 < few.words.rows <= 5 and not few.complete
    assert sorted(ti.build_postings(memory, "english", lexicon=few).collect()) == everything


def test_the_lexicon_has_every_word(memory):
    rows = ti.token_rows(memory, "content", ("id",), "english")
    want = sorted(with_stems(rows.select("token").distinct()).collect())
    for most in (5, 1, ti.LEXICON_WORDS):
        built = ti.build_lexicon(rows, max_words=most)
        assert built.complete == (built.words.rows == len(want)) == (most == ti.LEXICON_WORDS)
        assert sorted(built.stems.collect()) == want


def test_lexicon_query_keeps_words_rarer_than_one_in_the_broadcast_limit(spark, memory, monkeypatch):
    text = F.concat(F.repeat(F.lit("tiger "), ti.LEXICON_WORDS + 1), F.lit("running foxes"))
    monkeypatch.setattr(catalogue.fx, "memory", lambda spark, sf: memory.limit(1).select("id", text.alias("content")))
    got = sorted(tuple(r) for r in catalogue.QUERIES["lexicon_english"](spark, "none").collect())
    assert got == [("foxes", "fox"), ("running", "run"), ("tiger", "tiger")]


def test_update_postings(spark, memory):
    before = ti.build_postings(memory)
    edited = memory.where("id <> 3").withColumn("content", F.when(F.col("id") == 1, "new words").otherwise(F.col("content")))
    changed = stage(spark.createDataFrame([(1,), (3,)], "id long"))
    assert sorted(ti.update_postings(before, edited, changed).collect()) == sorted(ti.build_postings(edited).collect())


def test_english_match_survives_filters_on_the_lexeme(spark, memory):
    q = spark.createDataFrame([(1, "jumping foxes"), (2, "dogs")], "qid int, query_text string")
    terms = stage(ti.analyze_queries(q, "english"))
    got = ti.fts_match(terms, ti.build_postings(memory, "english"), memory.select("id")).collect()
    assert {(r.qid, r.id) for r in got} == {(1, 1), (2, 1), (2, 2)}


def test_stems_as_expressions_equal_stems_of_single_words(spark):
    heads = ("gener", "commun", "arsen", "y", "say", "hopp", "luxuri", "cr", "sens", "feud", "abl", "rat", "", "é")
    ends = ("ational", "ization", "izer", "ing", "ed", "eedly", "eed", "sses", "ied", "ies", "ly", "li", "logi", "fulli", "ative", "icate",
            "ement", "sion", "tion", "ll", "e", "y", "yy", "ness", "ously", "us", "ss", "ical", "entli", "s")
    words = {h + e for h in heads for e in ends} | set(STEMS) | {"skies", "dying", "inning", "succeed", "syzygy", "a", "yes", "x2s"}
    df = spark.createDataFrame([(w,) for w in sorted(words)] + [(None,)], "token string")
    got = {r.token: r.lexeme for r in with_stems(df).collect()}
    assert {w: (s, stem_word(w)) for w, s in got.items() if w is not None and s != stem_word(w)} == {}
    assert got[None] is None


@pytest.mark.parametrize("config", ["simple", "english"])
def test_postings_without_a_shuffle(spark, config):
    rows = [(1, "the runs, run running; run"), (2, None), (3, ""), (4, "x " * 3000 + "y"), (5, "one two one")]
    m = spark.createDataFrame(rows, "id long, content string")
    found = ti.build_postings(m, config)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    got = {(r.id, r.lexeme): r.positions for r in found.collect()}
    assert got[5, "one"] == [1, 3] and got[4, "x"] == list(range(1, 3001)) and got[4, "y"] == [3001]
    assert (got.get((1, "run")) == [2, 3, 4, 5]) == (config == "english") and ((1, "the") in got) == (config == "simple")
    assert {i for i, _ in got} == {1, 4, 5}


def test_postings_in_small_parts(memory, monkeypatch):
    want = sorted(ti.build_postings(memory).collect())
    monkeypatch.setattr(ti, "TOKENS_AT_A_TIME", 3)
    assert sorted(ti.build_postings(memory).collect()) == want


def test_ranks_of_a_batch(spark):
    import random

    rng = random.Random(9)
    cases = [[sorted(rng.sample(range(1, rng.choice([30, 400, 40_000])), rng.randint(1, 25))) for _ in range(rng.randint(0, 5))] for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, l array<array<int>>").select("i", ts_rank(F.col("l")).alias("r"))
    for r in df.collect():
        want = rank(cases[r.i]) if cases[r.i] else None
        assert (r.r is None) if want is None else r.r == pytest.approx(want, rel=1e-9), cases[r.i]


GRAMMAR_CASES = {
    "Mail Jo.Doe+x@mail.example.com, now.": [("word", "mail"), ("email", "jo.doe+x@mail.example.com"), ("word", "now")],
    "see https://Example.com/a/b?x=1.": [("word", "see"), ("url", "example.com/a/b?x=1"), ("host", "example.com"), ("url_path", "/a/b?x=1")],
    "http://host.org:8080 www.x-y.de": [("host", "host.org:8080"), ("host", "www.x-y.de")],
    "a well-known state-of-the-art- thing": [
        ("word", "a"), ("hword", "well-known"), ("hword_part", "well"), ("hword_part", "known"), ("hword", "state-of-the-art"),
        ("hword_part", "state"), ("hword_part", "of"), ("hword_part", "the"), ("hword_part", "art"), ("word", "thing"),
    ],
    "-12 +3.5 1.2.3 6e-3 42 2nd 10-20": [
        ("int", "-12"), ("float", "+3.5"), ("version", "1.2.3"), ("float", "6e-3"), ("int", "42"), ("word", "2nd"), ("int", "10"), ("int", "20"),
    ],
    "in /usr/local/lib.txt, wait...what ½": [("word", "in"), ("file", "/usr/local/lib.txt"), ("word", "wait"), ("word", "what"), ("other", "½")],
    "": [], " -- @ / . ": [],
}


def test_token_grammar(spark):
    df = spark.createDataFrame([(t,) for t in GRAMMAR_CASES] + [(None,)], "t string")
    got = {r.t: r.p for r in df.select("t", grammar_parts(F.col("t")).alias("p")).collect()}
    assert {t: [tuple(x) for x in got[t]] for t in GRAMMAR_CASES} == GRAMMAR_CASES and got[None] is None


def test_token_grammar_of_long_runs(spark):
    runs = ["x" * 200_000, "a-" * 100_000, "a." * 100_000, "1." * 100_000, "a@" * 100_000, "/a" * 100_000, "9" * 200_000, "ab://" * 40_000]
    df = spark.createDataFrame([(t,) for t in runs], "t string").select(F.size(grammar_parts(F.col("t"))).alias("n"))
    assert min(r.n for r in df.collect()) >= 1


def test_search_by_grammar(spark):
    m = spark.createDataFrame([(1, "write to jo@mail.example.com"), (2, "jo mail example com"), (3, "well-known houses")], "id long, content string")
    for config, text, want in (("simple", "JO@mail.example.com", {1}), ("simple", "known", {3}), ("english", "well-known house", {3})):
        q = spark.createDataFrame([(1, text)], "qid long, query_text string")
        terms = stage(ti.analyze_queries(q, config, grammar=True))
        hits = ti.fts_match(terms, ti.build_postings(m, config, grammar=True), m.select("id"))
        assert {r.id for r in hits.collect()} == want


def test_plain_words_are_found_as_by_the_whole_grammar(spark):
    """Plain words skip the other classes; all strings of pieces that could go on as one give the same tokens."""
    import random

    from mnemolake.functions import text as tx

    rng = random.Random(3)
    bits = ["word", "e1", "1e5", "a", "ß9", ".", "..", "-", "@", ":", "://", "/", " ", "\n", ",", ";", "'", '"', "(", ")", "[", "{", "<", ">", "?", " ", "com", "x" * 70, "7", "+3"]
    texts = [("".join(rng.choices(bits, k=rng.randint(1, 9))),) for _ in range(4000)]
    df = spark.createDataFrame(texts, "t string")
    whole = F.regexp_extract_all(F.lower("t"), F.lit(tx.GRAMMAR_PATTERN), F.lit(0))
    quick = F.regexp_extract_all(F.lower("t"), F.lit(tx._SCAN), F.lit(0))
    assert df.where(whole != quick).collect() == []
    plain = df.select(F.explode(quick).alias("w")).where(F.col("w").rlike(f"^{tx.PLAIN}\\z"))
    others = "|".join(f"(?:{p})" for kind, p in tx.GRAMMAR.items() if kind != "run")
    assert plain.where(F.col("w").rlike(f"^(?:{others})$")).count() == 0 < plain.count()
