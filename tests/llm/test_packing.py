import random
import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from samples import ODD, SF01
from scholarlake.llm import packing as pk


def plain(lengths, sources, clusters, capacity):
    """The tightest compatible bin, by looking at all of them."""
    bins, out = [], []
    for length, source, cluster in zip(lengths, sources, clusters):
        fits = [
            (b["room"], i) for i, b in enumerate(bins)
            if b["room"] >= length and source not in b["sources"] and cluster not in b["clusters"]
        ]
        if fits:
            at = min(fits)[1]
        else:
            at = len(bins)
            bins.append({"room": capacity, "sources": set(), "clusters": set()})
        bins[at]["room"] -= length
        bins[at]["sources"] |= {source} - {-1}
        bins[at]["clusters"] |= {cluster} - {-1}
        out.append(at)
    return out


PIECES = st.lists(st.tuples(st.integers(1, 50), st.integers(-1, 6), st.integers(-1, 20)), max_size=60)


@settings(max_examples=300, deadline=None)
@given(PIECES, st.integers(50, 90))
def test_best_fit_is_that_of_the_plain_search(pieces, capacity):
    pieces.sort(key=lambda p: -p[0])
    columns = [list(c) for c in zip(*pieces)] or [[], [], []]
    assert pk.best_fit(*columns, capacity) == plain(*columns, capacity)


def test_large_group():
    rng = random.Random(2)
    pieces = sorted(((rng.randint(1, 2048), rng.choice([0, 0, 0, *range(1, 20)]), i) for i in range(1500)),
                    reverse=True)
    columns = [list(c) for c in zip(*pieces)]
    assert pk.best_fit(*columns, 2048) == plain(*columns, 2048)


def check(rows, got, capacity):
    """Every word of every row once, no bin too full, no conflict in a bin."""
    pieces = Counter((r.doc_id, r.start, r.length) for r in got)
    expected = Counter()
    for doc_id, text, *_ in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        for start in range(0, n, capacity):
            expected[doc_id, start, min(capacity, n - start)] += 1
    assert pieces == expected
    used = defaultdict(int)
    for r in got:
        used[r.bin] += r.length
    assert all(used[r.bin] + r.room == capacity for r in got)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = pk.packed_documents(docs, 1024, 300).collect()
    check(rows, got, 1024)
    source = {i: s for i, _, s in rows}
    text = {i: "".join(t.lower().split()) for i, t, _ in rows}
    held = defaultdict(list)
    for r in got:
        held[r.bin].append(r.doc_id)
    for ids in held.values():
        assert len({source[i] for i in ids}) == len(ids) == len({text[i] for i in ids})
    # The same bins, however the table is cut.
    again = pk.packed_documents(docs.repartition(5), 1024, 300).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_odd_rows(table):
    got = pk.packed_documents(table(ODD), 64).collect()
    check(ODD, got, 64)
    assert pk.packed_documents(table([])).count() == 0
    assert pk.packed_documents(table([(1, None, None, None)])).count() == 0


def test_a_hot_source_spreads_over_groups(table):
    rows = [(i, f"text {i} of one source", "en", "hot") for i in range(400)] + [(0, "twice", "en", None)] * 300
    got = pk.packed_documents(table(rows), 64, 50).collect()
    check(rows, got, 64)
    per_group = Counter(r.bin >> pk.GROUP_BITS for r in got)
    assert len(per_group) == 14 and max(per_group.values()) < 100
