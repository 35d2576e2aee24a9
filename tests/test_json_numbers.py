"""Numbers in JSON text, against Python's shortest digits of a double."""

import json
import random
import struct

import pytest
from pyspark.sql import functions as F

from model import json_text
from scholarlake import entity_table
from scholarlake.functions import json_numbers as jn


def plain(text):
    """Compact text with sorted keys of any JSON text."""
    return json_text(json.loads(text, parse_int=lambda t: -0.0 if t == "-0" else int(t)))


NUMBERS = (
    "5.0 1e2 0.1 0.10 -0 0 -0.0 -1.50 1e30 1E+30 1.5e-7 0.0001 0.00001 0.000001 1e15 1e16 1e17"
    " 12345678.5 123456789012345.6 1234567.0 9999999.0 10000000.0 0.001 0.00099 100 -7 1e0 1e-5"
    " 9223372036854775807 9223372036854775808 18446744073709551615 18446744073709551616"
    " -9223372036854775808 -9223372036854775809 123456789012345678901234567890"
    " 0.1234567890123456789 3.0e-4 2.5E5 2.2250738585072014e-308 1.7976931348623157e308 19446744073709551615"
    " 99999999999999999999 184467440737095516150"
).split()


@pytest.fixture(scope="module")
def alternatives(lines):
    """JSON texts as a value of authors.display_name_alternatives, read as JSON text."""

    def read(*texts):
        given = [f'{{"id":"A{i}","display_name_alternatives":{t}}}' for i, t in enumerate(texts)]
        rows = entity_table(lines(*given), "authors").collect()
        got = {r.id: r.display_name_alternatives for r in rows}
        return [got[f"A{i}"] for i in range(len(texts))]

    return read


def test_every_kind_of_number(alternatives):
    texts = [n for n in NUMBERS] + [f"[ {n} ,{{ \"k\" : {n}}}]" for n in NUMBERS]
    texts += ["[" + ",".join(NUMBERS) + "]"]
    assert alternatives(*texts) == list(map(plain, texts))


def test_random_doubles(alternatives):
    r = random.Random(3)
    values = [struct.unpack("d", r.randbytes(8))[0] for _ in range(300)]
    values += [r.randrange(1, 10**9) / 10 ** r.randrange(20) for _ in range(300)]
    values = [v for v in values if v == v and abs(v) != float("inf")]
    for text, got in zip(values, alternatives(*map(repr, values)), strict=True):
        # Digits are the JVM's: up to version 18 now and then one more than needed.
        assert float(got) == text
        assert got == plain(repr(text)) or len(got) > len(plain(repr(text))) or len(got) >= 17


def test_what_is_in_strings_stays(alternatives):
    odd = ['a 5.0 "q" \\ 1.50e3', '\\", 5.0, "', ":5.0,-0,", "1.0E30", "\\\\", 'x"1.0E7"', "é "]
    texts = [json.dumps({o: [o, 5.0, 1e30], "z": o}) for o in odd]
    texts += [json.dumps([odd, 2.50]), json.dumps({"Infinity": "Infinity", "a": 1.0})]
    assert alternatives(*texts) == list(map(plain, texts))


def test_long_texts(alternatives):
    long = json.dumps({"t": 'a "quoted" \\ 1.0E7 word, ' * 20_000, "n": [1.0] * 5000 + [1e30] * 5000})
    assert alternatives(long) == [plain(long)]


def test_other_keys_are_not_touched(lines):
    record = '{"id":"W1","publication_year":2020,"abstract_inverted_index":{"b":[1.0],"a":[2]},"cited_by_count":5.0,"x":7.50}'
    (row,) = entity_table(lines(record), "works").collect()
    assert row.abstract_inverted_index == '{"a":[2],"b":[1.0]}'
    assert (row.publication_year, row.cited_by_count) == (2020, 0)


@pytest.mark.parametrize("number", ["1e999", "-1e400", "9" * 400, "1" + "0" * 309 + ".5"])
def test_beyond_double_range_fails(lines, number):
    record = f'{{"id":"A1","display_name_alternatives":[{number}]}}'
    with pytest.raises(Exception, match="MALFORMED number"):
        entity_table(lines(record), "authors").collect()


def test_patterns_of_integers_beyond_64_bits(spark):
    values = [jn.GREATEST + d for d in (-1, 0, 1, 2, 10**5, 10**25)] + [10**19, 10**20, 5, 0]
    df = spark.createDataFrame([(str(v),) for v in values], "s string")
    got = [r[0] for r in df.select(jn.with_doubles(F.col("s"))).collect()]
    assert got == [f"{v}e0" if v > jn.GREATEST else str(v) for v in values]


def test_a_double_is_taken_apart_once(spark):
    df = spark.createDataFrame([('[1.0E19,-1.5E-7,"1.0E19"]',)], "t string")
    out = df.select(jn.shortest(F.col("t")).alias("t"))
    assert out.first().t == '[1e19,-1.5e-7,"1.0E19"]'
    assert "regexp_extract(" not in out._jdf.queryExecution().optimizedPlan().toString()
