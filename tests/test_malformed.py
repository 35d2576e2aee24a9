"""The report of malformed lines against the lines that fail a run."""

import pytest

from scholarlake import ENTITIES
from scholarlake.operators import malformed_lines
from scholarlake.operators.records import HALF_PAIR, NOT_ONE_VALUE, NOT_UTF8, TOO_LARGE
from test_tables import BAD

GOOD = ["", " \t", "\u0085", "[1]", '"x"', "5", "null", '{"id":5}', "{}", '{"id":"a"}',
        ' {"id":"5" }\r', '{"id":"\\ud83d\\ude00"}', '{"id":"a\\\\ud800"}', '[1e999]',
        '{"id":"a","unread":1e999}', '{"id":"a","works_count":5.0,"geo":7}']
LARGE = {
    "works": '{"id":"W","topics":[{"id":"t","score":0.5},{"id":"u","score":1e999}]}',
    "institutions": '{"id":"I","geo":{"latitude":-1e999}}',
    "authors": '{"id":"A","display_name_alternatives":[1,"x",1e999]}',
}


def report(df, entity):
    return {r.line_no: r.reason for r in malformed_lines(df, ENTITIES[entity]).collect()}


@pytest.mark.parametrize("entity", ["publishers", "works"])
def test_every_kind(lines, entity):
    got = report(lines(*GOOD, *BAD), entity)
    want = {
        n: HALF_PAIR if "\\u" in bad else NOT_ONE_VALUE for n, bad in enumerate(BAD, len(GOOD))
    }
    assert got == want


@pytest.mark.parametrize("entity", LARGE)
def test_numbers(lines, entity):
    assert report(lines('{"id":"a"}', LARGE[entity]), entity) == {1: TOO_LARGE}


def test_bytes(spark):
    df = spark.createDataFrame([("f", 3, b'{"id":"T\xff1"}')], "file_key string, line_no long, b binary")
    df = df.selectExpr("file_key", "line_no", "cast(b AS string) AS value")
    assert report(df, "publishers") == {3: NOT_UTF8}
    assert report(df.limit(0), "publishers") == {}


def test_no_shuffle(lines):
    plan = malformed_lines(lines("{}"), ENTITIES["works"])._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_a_line_is_parsed_once_for_the_report(lines):
    told = malformed_lines(lines('{"id":"a"}', "x"), ENTITIES["institutions"])
    text = told._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1
    assert text.count("USER_RAISED") == 0
