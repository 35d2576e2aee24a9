"""Hand-written records and the rows they must give."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from scholarlake import entity_table


def rows(df):
    return [tuple(r) for r in df.collect()]


def table(lines, name, *values):
    return rows(entity_table(lines(*values), name))


AUTHOR = {
    "id": "A1", "orcid": "o", "display_name": "N", "display_name_alternatives": ["b", "a"],
    "works_count": 3, "cited_by_count": 4, "last_known_institution": {"id": "I1", "ror": "r"},
    "works_api_url": "u", "updated_date": "d",
    "ids": {"openalex": "A1", "orcid": "o", "scopus": "s", "twitter": "t", "wikipedia": "w", "mag": 5},
    "counts_by_year": [
        {"year": 2020, "works_count": 1, "cited_by_count": 2, "oa_works_count": 3},
        {"year": 2021}, {"year": "2022"}, {"works_count": 1}, None, 7,
    ],
}


def test_authors(lines):
    assert table(lines, "authors", AUTHOR) == [("A1", "o", "N", '["b","a"]', 3, 4, "I1", "u", "d")]
    assert table(lines, "authors", {"id": ""}) == [("", None, "Unknown", None, 0, 0, None, None, None)]


def test_authors_ids(lines):
    assert table(lines, "authors_ids", AUTHOR) == [("A1", "A1", "o", "s", "t", "w", None)]


def test_authors_counts_by_year(lines):
    assert table(lines, "authors_counts_by_year", AUTHOR) == [
        ("A1", 2020, 1, 2, 3), ("A1", 2021, 0, 0, 0),
    ]


def test_institutions(lines):
    record = {
        "id": "I1", "ror": "r", "display_name": None, "country_code": "c", "type": "t",
        "homepage_url": "h", "image_url": "i", "image_thumbnail_url": "j",
        "display_name_acronyms": None, "display_name_alternatives": {"b": 1, "a": []},
        "works_count": 1.0, "cited_by_count": 2, "works_api_url": "w", "updated_date": "d",
    }
    assert table(lines, "institutions", record) == [
        ("I1", "r", "Unknown", "c", "t", "h", "i", "j", "null", '{"a":[],"b":1}', 0, 2, "w", "d")
    ]


def test_institutions_geo(lines):
    geo = {"city": "c", "geonames_city_id": "5", "region": "r", "country_code": "cc",
           "country": "n", "latitude": 1, "longitude": -2.5}
    assert table(lines, "institutions_geo", {"id": "I1", "geo": geo}) == [
        ("I1", "c", "5", "r", "cc", "n", 1.0, -2.5)
    ]


def test_publishers(lines):
    record = {
        "id": "P1", "display_name": "N", "alternate_titles": [], "country_codes": ["x"],
        "hierarchy_level": 2, "parent_publisher": {"id": "P0"}, "works_count": 1,
        "cited_by_count": 2, "sources_api_url": "s", "updated_date": "d",
    }
    assert table(lines, "publishers", record) == [
        ("P1", "N", "[]", '["x"]', 2, None, 1, 2, "s", "d")
    ]


def test_topics(lines):
    record = {
        "id": "T1", "display_name": "N", "subfield": {"id": "s", "display_name": "S"},
        "field": {"id": 17, "display_name": "F"}, "domain": "x", "description": "d",
        "keywords": ["k", 5, "l"], "works_api_url": "w", "ids": {"wikipedia": "p"},
        "works_count": 1, "cited_by_count": 2, "updated": "u", "updated_date": "decoy",
        "siblings": [{"id": "T2", "display_name": "M"}],
    }
    assert table(lines, "topics", record) == [
        ("T1", "N", "s", "S", "Unknown", "F", "Unknown", "Unknown", "d", "k; l", "w", "p", 1, 2,
         "u", '[{"display_name":"M","id":"T2"}]')
    ]


WORK = {
    "id": "W1", "doi": "d", "title": "t", "display_name": "n", "publication_year": 2020,
    "publication_date": "2020-01-02", "type": "article", "cited_by_count": 5, "is_retracted": True,
    "is_paratext": False, "cited_by_api_url": "c", "abstract_inverted_index": {"b": [1], "a": [0]},
    "language": "en",
    "primary_location": {"source": {"id": "S1"}, "landing_page_url": "l", "pdf_url": None,
                         "is_oa": True, "version": "v", "license": "by"},
    "authorships": [
        {"author": {"id": "A1"}, "author_position": "first", "raw_affiliation_string": "r",
         "institutions": [{"ror": "x"}, {"id": "I1"}, {"id": "I2"}]},
        {"author": {"id": "A1"}, "institutions": []},
        {"author": {"id": None}, "author_position": "last"},
        {"author_position": "last"},
    ],
    "topics": [{"id": "T1", "score": 0.5}, {"id": "T1"}, {"score": 1}],
    "open_access": {"is_oa": True, "oa_status": "gold", "oa_url": "u",
                    "any_repository_has_fulltext": False},
    "referenced_works": ["W2", "W3", "W2", None, 4],
}


def test_works(lines):
    assert table(lines, "works", WORK) == [
        ("W1", "d", "t", "n", 2020, "2020-01-02", "article", 5, True, False, "c",
         '{"a":[0],"b":[1]}', "en")
    ]
    assert table(lines, "works", {"id": "W2"}) == [
        ("W2", None, None, "", None, None, None, 0, False, None, None, None, None)
    ]


def test_works_locations(lines):
    assert table(lines, "works_locations", WORK) == [
        ("W1", "S1", "l", None, True, "v", "by", "primary")
    ]
    without = [None, {}, {"source": None}, {"source": {}}, {"source": {"id": 1}}, "x", []]
    records = [{"id": str(n), "primary_location": p} for n, p in enumerate(without)]
    assert table(lines, "works_locations", *records, {"id": "none"}) == []


def test_works_authorships(lines):
    # The same author twice stays; several institutions give one row.
    assert table(lines, "works_authorships", WORK) == [
        ("W1", "first", "A1", "I1", "r"), ("W1", "unknown", "A1", None, None),
    ]


def test_works_topics(lines):
    assert table(lines, "works_topics", WORK) == [("W1", "T1", 0.5), ("W1", "T1", None)]


def test_works_open_access(lines):
    assert table(lines, "works_open_access", WORK) == [("W1", True, "gold", "u", False)]


def test_works_citations(lines):
    assert table(lines, "works_citations", WORK) == [("W1", "W2"), ("W1", "W3"), ("W1", "W2")]


@pytest.mark.parametrize(
    ("name", "key"),
    [("authors_ids", "ids"), ("institutions_geo", "geo"), ("works_open_access", "open_access")],
)
def test_presence_of_child_objects(lines, name, key):
    """A key that is there gives a row, whatever its value; a missing key gives none."""
    records = [{"id": f"{n}", key: v} for n, v in enumerate([None, {}, 5, "x", [1], True])]
    got = table(lines, name, *records, {"id": "missing"})
    assert sorted(r[0] for r in got) == ["0", "1", "2", "3", "4", "5"]
    assert all(v is None for r in got for v in r[1:])


@pytest.mark.parametrize("name", ["authors_counts_by_year", "works_topics", "works_citations"])
@pytest.mark.parametrize("value", [None, [], {}, "x", 5])
def test_no_child_rows(lines, name, value):
    key = {"authors_counts_by_year": "counts_by_year", "works_topics": "topics",
           "works_citations": "referenced_works"}[name]
    assert table(lines, name, {"id": "a", key: value}, {"id": "b"}) == []


def test_lines_without_a_record(lines):
    skipped = ["", "  \t", "\r", " 　", "\u0085", "[1]", '"x"', "5", "true", "null", '{"id":5}',
               '{"id":null}', "{}", '{"id":["a"]}', ' [{"id":"x"}]']
    kept = ['{"id":"a"}', ' \t{"id":"b"}', '{"id":"c"}\r', '{ "id" : "5" }', '{"id":"d"} \t ',
            '{"id":"e"}\r\r']
    got = sorted(r[0] for r in table(lines, "publishers", *skipped, *kept))
    assert got == ["5", "a", "b", "c", "d", "e"]


BAD = [
    '{"id":"a"', "nope", '{"id":"a","unread":nope}', "{'id':'a'}", '{"id":"a","works_count":NaN}',
    '{"id":"a","works_count":01}', "[1", '{"id":"a",}', " x", '{"id":"a\nb"}',
    # Text behind a value.
    '{"id":"a"} x', '{"id":"a"},', '{"id":"a"}]', ' {"id":"a"} 5', '{"id":"W1"}{"id":"W2"}',
    '{"id":"a"},{"id":"b"}', '{"id":"a"}}', '{"id":"a"}} x', '{"id":"a"}}]', '{"id":5} {"id":"b"}',
    '{"id":"a"},"x":{"id":"b"}', '{"id":"a"}],"x":[{"id":"b"}', '{"id":"a"}]}', '{"id":"a"}]} {',
    "[1] x", "1 2", '"x" y', "null null", "1]", "1,2", "null,", '{"id":"a"}null',
    # Halves of surrogate pairs.
    '{"id":"\\ud800"}', '{"id":"a","unread":"x\\uDC00y"}', '{"id":"\\ude00\\ud83d"}',
]


@pytest.mark.parametrize("bad", BAD)
def test_malformed_line_fails(lines, bad):
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        table(lines, "publishers", '{"id":"fine"}', bad)


@settings(max_examples=25, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sampled_from(['{"id":"a"}', '{"id":5}', "[1]", "7", "null", '"s"', ' {"id":"b","works_count":"x"}']),
       st.text(st.sampled_from(list('{}[],:"a1 \t')), max_size=8))
def test_any_text_behind_a_value_fails(lines, value, tail):
    """Whatever follows a value, unless it is white space or makes another value of it."""
    try:
        json.loads(value + tail)
    except ValueError:
        with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
            table(lines, "publishers", value + tail)
    else:
        table(lines, "publishers", value + tail)


def test_whole_escapes_are_read(lines):
    good = ['{"id":"\\ud83d\\ude00"}', '{"id":"a\\\\ud800"}', '{"id":"\\u00e9"}']
    assert sorted(r[0] for r in table(lines, "publishers", *good)) == sorted(map(lambda t: json.loads(t)["id"], good))


def test_bytes_that_are_not_utf8_fail(spark):
    df = spark.createDataFrame([("f", 0, b'{"id":"T\xff1"}')], "file_key string, line_no long, b binary")
    df = df.selectExpr("file_key", "line_no", "cast(b AS string) AS value")
    with pytest.raises(Exception, match="UTF"):
        rows(entity_table(df, "publishers"))


@pytest.mark.parametrize(
    ("name", "record"),
    [
        ("works_topics", '{"id":"W","topics":[{"id":"t","score":0.5},{"id":"u","score":1e999}]}'),
        ("works_topics", '{"id":"W","topics":[{"id":7,"score":-1e999}]}'),
        ("institutions_geo", '{"id":"I","geo":{"latitude":1e999}}'),
    ],
)
def test_numbers_beyond_double_range_fail(lines, name, record):
    with pytest.raises(Exception, match="MALFORMED number"):
        table(lines, name, record)


def test_required_columns_have_no_nulls(lines):
    records = [AUTHOR, WORK, {"id": "x"}]
    required = {
        "authors": ("id", "display_name", "works_count", "cited_by_count"),
        "works": ("id", "display_name", "cited_by_count", "is_retracted"),
        "works_authorships": ("work_id", "author_id", "author_position"),
        "topics": ("subfield_id", "subfield_display_name", "field_id", "domain_id"),
    }
    for name, columns in required.items():
        for row in entity_table(lines(*records), name).collect():
            assert all(row[c] is not None for c in columns)
