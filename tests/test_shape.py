"""Typed and strict reading agree with each other and with a plain model."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import model
from scholarlake import ENTITIES
from scholarlake.functions.shape import JSON, NUMBER, SELDOM_TEXT, TEXT, TRUTH, WHOLE
from scholarlake.operators.records import parse_records, record_shape

tricky_texts = st.sampled_from(
    ["", "a", "5", "-1.5e3", "true", "null", "NaN", "Infinity", "{", '{"id":"x"}', "[1]", '"q"',
     "2024-01-02", "é \n7", "a\n5\nb", "\U0001f600", "\\", "tab\t", "5\n"]
)
texts = tricky_texts | st.text(st.characters(codec="utf-8", exclude_categories=("Cs", "Cc")), max_size=5)
integers = st.sampled_from([0, 1, -1, 2**31, 2**32 + 5, 2**63 - 1, -(2**63), 2**63, 10**25]) | st.integers(
    -(10**6), 10**6
)
# Multiples of 1/8 that are no integers: exact in every representation.
floats = st.integers(-(10**6), 10**6).map(lambda n: (2 * n + 1) / 8)
anything = st.recursive(
    st.none() | st.booleans() | integers | texts,
    lambda inner: st.lists(inner, max_size=3)
    | st.dictionaries(st.sampled_from(["id", "a", "b"]), inner, max_size=3),
    max_leaves=5,
)


def values(shape, junk):
    """Mostly values of the shape, now and then something else."""
    if isinstance(shape, list):
        good = st.lists(values(shape[0], junk), max_size=4)
    elif isinstance(shape, dict):
        good = st.fixed_dictionaries(
            {}, optional={key: values(part, junk) for key, part in shape.items()}
        )
    else:
        good = {
            TEXT: texts, SELDOM_TEXT: texts | integers, WHOLE: integers, NUMBER: floats | integers, TRUTH: st.booleans(),
            JSON: anything,
        }[shape]
    return st.one_of(*[good] * 8, st.none(), *([anything | floats] if junk and shape != JSON else []))


def plain(value):
    if hasattr(value, "asDict"):
        return {key: plain(part) for key, part in value.asDict().items()}
    return [plain(e) for e in value] if isinstance(value, list) else value


def check(lines, entity, records):
    tables = ENTITIES[entity]
    shape = record_shape(tables)
    numbered = [{**r, "id": f"{n}"} for n, r in enumerate(records)]
    df = parse_records(lines(*numbered), tables)
    got = {row.id: row for row in df.collect()}
    presence = {t.child for t in tables if t.child and not t.required}
    assert len(got) == len(records)
    for record in numbered:
        row = got[record["id"]]
        for key, part in shape.items():
            expected = model.read(record.get(key, model.MISSING), part)
            actual = plain(row[key])
            if key in presence:
                assert (actual is None) == (expected is None), (key, record)
            assert model.blank(actual, part) == model.blank(expected, part), (key, record)


@pytest.mark.parametrize("entity", ENTITIES)
@pytest.mark.parametrize("junk", [False, True])
@settings(
    max_examples=4, deadline=None, derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow, HealthCheck.data_too_large],
)
@given(data=st.data())
def test_records_match_model(lines, entity, junk, data):
    shape = record_shape(ENTITIES[entity])
    records = data.draw(st.lists(values(shape, junk).map(lambda r: r if isinstance(r, dict) else {}),
                                 min_size=40, max_size=60))
    check(lines, entity, records)


# One record each, since a doubt about one value sends the whole record the strict way.
SINGLES = [
    {"doi": 5}, {"doi": "5"}, {"doi": True}, {"doi": [1]}, {"doi": {"a": 1}}, {"title": '"x"'},
    {"publication_year": 5.5}, {"publication_year": "5"}, {"publication_year": 2**63},
    {"is_paratext": "true"}, {"is_paratext": 1}, {"open_access": None}, {"open_access": {}},
    {"open_access": 1}, {"open_access": {"oa_url": 7}}, {"primary_location": "x"},
    {"primary_location": {"source": ["x"]}}, {"primary_location": {"source": {"id": 1}}},
    {"authorships": {}}, {"authorships": [None]}, {"authorships": [{"author": {"id": 7}}]},
    {"authorships": [{"author": {"id": "a"}, "institutions": [{"id": 7}, {"id": "i"}]}]},
    {"authorships": [{"author": {"id": "a"}, "institutions": None}, {"author": {"id": "b"},
     "institutions": [{"id": False}]}]},
    {"authorships": [{"author": {"id": "a"}, "institutions": ["i"]}]},
    {"topics": [{"id": "t", "score": "NaN"}]}, {"topics": [{"id": "t", "score": "0.5"}]},
    {"topics": [{"id": "t", "score": 1}, {"id": 1, "score": 2.5}]},
    {"referenced_works": ["a", None, 7, "7", True, ["x"], {"y": 1}]}, {"referenced_works": "a"},
    {"abstract_inverted_index": None}, {"abstract_inverted_index": {"b": [1], "a": [0, 2]}},
]


def test_single_doubts(lines):
    check(lines, "works", SINGLES)


def test_repeated_keys_last_one_counts(lines):
    texts = [
        '{"id":"0","doi":"a","doi":5}',
        '{"id":"1","doi":5,"doi":"a"}',
        '{"id":"2","publication_year":"x","publication_year":7}',
        '{"id":"3","topics":["x"],"topics":[{"id":"t","id":"u"}]}',
        '{"id":9,"id":"4","open_access":{"oa_url":"a"},"open_access":null}',
        '{"id":"5","id":9}',
    ]
    records = {r["id"]: r for r in map(json.loads, texts)}
    df = parse_records(lines(*texts), ENTITIES["works"])
    got = {r.id: r for r in df.where("id is not null").collect()}
    assert got.keys() == {"0", "1", "2", "3", "4"}
    for id, row in got.items():
        for key, part in record_shape(ENTITIES["works"]).items():
            expected = model.read(records[id].get(key, model.MISSING), part)
            assert model.blank(plain(row[key]), part) == model.blank(expected, part), (id, key)
    assert got["4"].open_access is not None
