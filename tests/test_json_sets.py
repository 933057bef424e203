import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from mnemolake.functions.json_sets import holds, path_values, read_json
from mnemolake.operators import filters

KNOWN = [
    ('{"a":1}', "{}", True), ('{"a":1,"b":2}', '{"b":2}', True), ('{"a":{"b":1,"c":[1,2]}}', '{"a":{"c":[2]}}', True),
    ("[1,2,3]", "[3,1,1]", True), ('[{"a":1},{"b":2}]', '[{"a":1,"b":2}]', False), ('[{"a":1,"b":2}]', '[{"a":1},{"b":2}]', True),
    ('{"a":true}', '{"a":1}', False), ('{"a":1.0}', '{"a":1}', True), ('{"a":"1"}', '{"a":1}', False), ('{"a":null}', '{"a":null}', True),
    ("{}", '{"a":null}', False), ('{"a":[]}', '{"a":{}}', False), ('{"a.b":1}', '{"a":{"b":1}}', False), ('{"a":[[1],[2]]}', '{"a":[[2]]}', True),
    ("1e400", "1e400", True), ("-0.0", "0", True),
]


@pytest.mark.parametrize("big,small,want", KNOWN)
def test_known_cases(big, small, want):
    a, b = read_json(big)[0], read_json(small)[0]
    assert holds(a, b) is want
    assert not want or path_values(b) <= path_values(a)


documents = st.recursive(
    st.none() | st.booleans() | st.integers(-2, 2) | st.sampled_from(["", "a", 'q"', "1"]),
    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.sampled_from(["a", "b", "a.b", "[]"]), x, max_size=3),
    max_leaves=8,
)


@given(documents, documents)
def test_inclusion_of_pairs_is_necessary(big, small):
    a, b = (read_json(json.dumps(x))[0] for x in (big, small))
    assert holds(a, a)
    if holds(a, b):
        assert path_values(b) <= path_values(a)


def test_batch_against_batch(spark):
    texts = [b for b, _, _ in KNOWN] + ["not json", None, "", "NaN", "[" * 100_000, '{"a":1}', '{"a":1}']
    wanted = [s for _, s, _ in KNOWN] + ["not json", None, '{"zzz":0}']
    m = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)], "id long, metadata string, qid string")
    q = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(wanted)], "qid long, wanted string, id string")
    got = sorted(tuple(r) for r in filters.match_metadata(q, m).collect())
    parsed = [read_json(t) for t in texts], [read_json(t) for t in wanted]
    assert got == sorted((j, i) for j, b in enumerate(parsed[1]) for i, a in enumerate(parsed[0]) if a and b and holds(a[0], b[0]))
    assert sorted(r.id for r in filters.containing_metadata(m, '{"a":1}').collect()) == sorted(i for j, i in got if j == 7)
    assert filters.match_metadata(q.limit(0), m).count() == filters.match_metadata(q, m.limit(0)).count() == 0
