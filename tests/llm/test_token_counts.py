import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from samples import ODD
from scholarlake.llm import token_counts as tc


@pytest.fixture(scope="module")
def counter():
    with open(tc.VOCABULARY, "rb") as f:
        return tc.Counter(f.read())


TEXT = st.text(st.sampled_from(list("ab 'slre\n\t .,19é日")), max_size=300)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 600), st.integers(0, 60), TEXT), max_size=6))
def test_edits_lead_to_the_count_of_the_edited_text(counter, text, edits):
    tree = tc.CountTree(counter.cut(text), counter)
    for begin, size, replacement in edits:
        begin = min(begin, len(text))
        end = min(len(text), begin + size)
        text = text[:begin] + replacement + text[end:]
        tree.edit(begin, end, replacement)
        assert tree.text == text
        assert [p for leaf in tree.leaves for p in leaf] == counter.cut(text)
        assert tree.total == len(counter.encoding.encode_ordinary(text))


def test_an_edit_touches_its_region_only(counter):
    text = "some words and some more " * 5000
    tree = tc.CountTree(counter.cut(text), counter)
    tree.edit(60_000, 60_004, "other")
    assert tree.reencoded < 10
    tree.edit(10, 10, "inserted words " * 400)  # outgrows its leaf
    text = text[:60_000] + "other" + text[60_004:]
    text = text[:10] + "inserted words " * 400 + text[10:]
    assert tree.text == text
    assert tree.total == len(counter.encoding.encode_ordinary(text))


def test_query(table, counter):
    rows = [*ODD, (20, "Mail a.b@mail.example.com or +1 (017) 555-7713, token = xyz9 now", "en", "a")]
    got = tc.counted(table(rows)).collect()
    pattern = tc.redactions()
    expected = []
    for doc_id, text, *_ in rows:
        text = text or ""
        edited = pattern.sub(lambda m: f"<{m.lastgroup}>", text)
        expected.append((
            doc_id, len(counter.encoding.encode_ordinary(text)), len(list(pattern.finditer(text))),
            len(counter.encoding.encode_ordinary(edited)),
        ))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)[:4]) for r in got)
    assert {r.n_edits for r in got if r.doc_id == 20} == {3}
    assert tc.counted(table([])).count() == 0


def test_hints_miss_no_edit():
    pattern = tc.redactions()
    for text in ("a@b.c", "password=1", "Token: x", "1.2.3.4", "+1234567890", "123456789"):
        assert tc.edits_of(text, pattern)
