"""Against plain Python: pieces as lists of words, runs as tuples of words."""

import functools
import re

import pytest

from samples import ODD, SF001
from scholarlake.llm import substring_dedup as sd
from scholarlake.llm.queries import QUERIES
from scholarlake.llm.tokens import words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def sentence_ends(text, found):
    """For each word whether a sentence ends with it."""
    out = []
    for i, m in enumerate(found):
        last = i + 1 == len(found)
        gap = text[m.end() : len(text) if last else found[i + 1].start()]
        stop = re.search(r"[.!?]", gap) and re.search(r"[ \t-\r]", gap)
        out.append(bool(last or "\n" in gap or stop))
    return out


@functools.cache
def hash_of(word):
    """The library's: which words a piece ends with is its choice."""
    return int(words([word.encode()]).hash[0])


def pieces(text):
    """(begin, words) of each piece; the next one's begin is its end."""
    text = text or ""
    found = list(WORD.finditer(text.translate(LOWER)))
    hashes = [hash_of(m.group()) for m in found]
    out, own, begin = [], [], None
    for i, (m, end) in enumerate(zip(found, sentence_ends(text, found), strict=True)):
        begin = m.start() if begin is None else begin
        own.append(m.group())
        around = hashes[i - sd.AROUND : i + sd.AROUND + 1] if i >= sd.AROUND else []
        least = len(around) == 2 * sd.AROUND + 1 and hashes[i] == min(around)
        if end or hashes[i] % 8 == 0 or least:
            out.append((begin, own))
            own, begin = [], None
    return out


def shortest_runs(lengths, least):
    """[i, j) of the shortest runs of at least so many words from, and up to, every piece."""
    out = set()
    for i in range(len(lengths)):
        total = 0
        for j in range(i, len(lengths)):
            total += lengths[j]
            if total >= least:
                out.add((i, j + 1))
                break
        total = 0
        for h in range(i, -1, -1):
            total += lengths[h]
            if total >= least:
                out.add((h, i + 1))
                break
    return out


def plain(rows, least=sd.WORDS):
    """(doc_id, text left, pieces, removed) of rows (k1, k2, text); repeated rows are one."""
    texts = {(k1, k2): text for k1, k2, text in rows}
    parts = {key: pieces(text) for key, text in texts.items()}
    runs = []
    for key, own in parts.items():
        for i, j in shortest_runs([len(w) for _, w in own], least):
            runs.append((tuple(w for _, s in own[i:j] for w in s), key, i, j))
    first = {}
    for run, key, i, _ in runs:
        first[run] = min(first.get(run, (key, i)), (key, i))
    gone = {key: set() for key in texts}
    for run, key, i, j in runs:
        if first[run] != (key, i):
            gone[key].update(range(i, j))
    out = []
    for k1, k2, text in rows:
        own, away = parts[k1, k2], gone[k1, k2]
        left = text
        if away:
            edges = [b for b, _ in own] + [len(text)]
            kept = [text[edges[i] : edges[i + 1]] for i in range(len(own)) if i not in away]
            left = (text[: edges[0]] + "".join(kept)).rstrip(" \t\n\r\x0b\x0c") if kept else ""
        out.append((k1, left, len(own), len(away)))
    return sorted(out, key=repr)


def keyed(df):
    k1, k2 = sd.row_key()
    return [(r.a, r.b, r.text) for r in df.select(k1.alias("a"), k2.alias("b"), "text").collect()]


def check(df, **options):
    out, (left, total, removed) = sd.without_repeats(df, **options)
    assert out.columns == [*df.columns, left, total, removed]
    got = [(r["doc_id"] or 0, r[left], r[total], r[removed]) for r in out.collect()]
    assert sorted(got, key=repr) == plain(keyed(df), *options.values())
    return got


def test_the_registered_query(spark):
    got = QUERIES["op2_substring_dedup"](spark, SF001).collect()
    expected = plain(keyed(spark.read.parquet(f"{SF001}/documents.parquet")))
    assert sorted(map(tuple, got), key=repr) == expected
    assert any(0 < r.n_removed < r.n_pieces for r in got)


@pytest.mark.parametrize("most", [1, 40])
def test_any_filter_gives_the_same(table, monkeypatch, most):
    monkeypatch.setattr(sd, "MOST_BITS", 6 + most // 4)
    monkeypatch.setattr(sd, "LEAST_BITS", 6)
    check(table([(i, f"Own word{i}. {P} Own end{i}.", "", "") for i in range(9)]))


def test_filter_bits():
    assert sd.filter_bits(0) == sd.LEAST_BITS and sd.filter_bits(10**12) == sd.MOST_BITS
    for n in (10**5, 10**6):
        assert 16 * n <= 1 << sd.filter_bits(n) <= 32 * n


P = (
    "This passage has well over fifty words. It stands in many documents, and it must be found in"
    " all of them. Its sentences are neither short nor long. Some of them have a comma, some do"
    " not! Would a question help? It would not hurt. In the end it is the run of sentences that"
    " counts, whatever stands around it here or there."
)


def test_passages(table):
    rows = [
        *ODD,
        (11, f"Own words come first. {P} Own words come last.", "en", "a"),
        (12, f"Quite another document\n{P.upper()}\n\nwith other words behind it.", "en", "a"),
        (13, P, "en", "a"),
        (14, f"Twice here: {P} and {P}", "en", "a"),
        (15, "A clean text. It repeats nothing that others have. It says so. " * 1, "en", "a"),
        (16, "no stop in it " + " ".join(f"w{i}" for i in range(300)), "en", "a"),
        (17, "before " + " ".join(f"w{i}" for i in range(100, 250)) + " after", "en", "a"),
    ]
    got = {(i, left): removed for i, left, _, removed in check(table(rows))}
    assert (13, "") in got
    assert got[12, "Quite another document\nwith other words behind it."] > 5
    assert any(i == 11 and not removed for (i, _), removed in got.items())
    kept = table(rows)
    assert 13 not in {r.doc_id for r in sd.stripped(kept).collect()}
    assert sd.stripped(kept).columns == kept.columns


def test_repeats_inside_a_text_and_small_limits(table):
    check(table([(1, "a. a. a. a. b.", "", ""), (2, "b. a. a. c", "", "")]), least=2)


def test_empty_table(table):
    assert sd.without_repeats(table([]))[0].count() == 0


@pytest.mark.parametrize("text", ["", "x", "a. b\nc! d", "3.5 is no end. But this is."])
def test_sentence_ends(text):
    found = list(WORD.finditer(text))
    assert sd.sentence_ends(words([text.encode()])).tolist() == sentence_ends(text, found)
