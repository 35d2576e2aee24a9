import hashlib
import re

from samples import LONG, ODD
from scholarlake.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, items, window=10):
    windows = set()
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        if item is not None and n:
            windows.update((str(item), tuple(w[i : i + n])) for i in range(len(w) - n + 1))
    out = []
    for doc_id, text, *_ in docs:
        w = words(text)
        hit, of = set(), set()
        for item, win in windows:
            for i in range(len(w) - len(win) + 1):
                if w[i] == win[0] and tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    of.add(item)
        digest = hashlib.sha256(",".join(sorted(of)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(of), digest, bool(hit)))
    return sorted(out, key=repr)


ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu."
ITEMS = [
    (1, ITEM), (2, "alpha BETA gamma, delta epsilon zeta eta theta iota kappa"), (2, "alpha"),
    (10, "only five words stand here"), (3, "two words"), (4, ""), (5, None), (None, "never found"),
    (6, "one"), (7, "a b a b a b a b a b a b"), (8, "ünï cödé 日本"), (9, ITEM),
]


def test_against_plain(spark, table):
    docs = [
        *ODD,
        (30, f"before it {ITEM} behind it", "", ""),
        (31, ITEM, "", ""),
        (32, "beta gamma delta epsilon zeta eta theta iota kappa lambda", "", ""),
        (33, "beta gamma delta epsilon zeta eta theta iota kappa lambdas mu", "", ""),
        (34, "a b " * 40, "", ""),
        (35, "only five words stand here, two words. ünï-cödé 日本 Never found", "", ""),
        (36, "alpha " * 3 + LONG[:3000], "", ""),
        (37, " ".join(words(ITEM)[:9]), "", ""),
    ]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = dc.contamination(table(docs), items).drop("k1", "k2").collect()
    assert sorted(map(tuple, got), key=repr) == plain(docs, ITEMS)
    kept = dc.without_contaminated(table(docs), items)
    assert kept.columns == table(docs).columns
    clean = sorted(repr(r[0]) for r in plain(docs, ITEMS) if not r[-1])
    assert sorted(repr(r.doc_id) for r in kept.collect()) == clean


def test_empty_tables(spark, table):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contamination(table([]), none).count() == 0
    got = dc.contamination(table(ODD), none).collect()
    assert len(got) == len(ODD) and not any(r.contaminated for r in got)
