"""Lines as content or boilerplate: a linear-chain conditional random field.

Each line that has a word is described by its shape (length, symbols, capitals,
digits, separators, closing punctuation), by repetition (an equal earlier line,
words in repeated windows, words equal to the one before) and by its place.
Viterbi decoding finds the likeliest sequence of labels; the share of words in
content lines decides whether a document is retained.

The field's weights are fitted by gradient ascent on the exact log-likelihood of
a sample of labelled documents, at most ``sample`` of either quality: lines of
low-quality documents, and lines that many of the sampled documents have, are
boilerplate, all others content.  That sample is the only bound; every text is
decoded whole.

Base counts of a text: words (runs of anything but ASCII white space), code
points in words, symbols, duplicate lines, and words in eight-word windows that
the text has twice or more.  A text fails them with fewer than 20 words, or with
more than 30 % of its words in repeated windows; null and empty texts have no
words and fail.  Without labels to learn from, all that pass are kept.  Repeated
rows get equal results.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarlake.llm.common import labelled_sample, map_batches, remainder
from scholarlake.llm.tokens import SPACED, Words, blocks, bytes_of, mix, span_hashes, words

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent
CONTENT_SHARE = 0.5
SAMPLE = 2000  # documents of either quality
COMMON_LINE = 0.004  # share of the sampled documents that have a line

# The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

EPOCHS, RATE, L2 = 6, 0.3, 1e-4


def _class(values: bytes) -> np.ndarray:
    table = np.zeros(256, np.int32)
    table[list(values)] = 1
    return table


_IS_SYMBOL = _class(SYMBOLS)
_IS_UPPER = _class(bytes(range(ord("A"), ord("Z") + 1)))
_IS_LOWER = _class(bytes(range(ord("a"), ord("z") + 1)) + bytes(range(0xC3, 0x100)))
_IS_DIGIT = _class(b"0123456789")
_IS_BAR = _class(b"|>")
_IS_COMMA = _class(b",.;:!?")
_CLOSES = np.zeros(256, bool)
_CLOSES[list(b".!?:;\"')")] = True


@dataclass
class Block:
    """Counts and lines of a block of texts.  ``line_first`` numbers the first line of each text."""

    base: dict[str, np.ndarray]
    features: np.ndarray
    line_words: np.ndarray
    line_first: np.ndarray
    line_hash: np.ndarray


def _repeated(w: Words) -> np.ndarray:
    """For each word whether it is in a window that its text has twice or more."""
    hashes, begin = w.shingles(WINDOW)
    keys = mix(hashes + w.of[begin].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(edges, begin[twice], 1)
    np.add.at(edges, begin[twice] + WINDOW, -1)
    return np.cumsum(edges)[:-1] > 0


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values, dtype=np.int64)])


def describe(texts: list[bytes]) -> Block:
    w = words(texts, SPACED)
    covered = _sums(_repeated(w))
    text, first = w.text, w.first
    first_byte = _sums((w.raw & 0xC0) != 0x80)
    of_words = _sums(first_byte[w.end] - first_byte[w.start])
    symbols = _sums(_IS_SYMBOL[w.raw])

    # Lines: the line feeds between texts end the last line of each.
    breaks = np.flatnonzero(w.raw == 10)
    begin, end = breaks[:-1] + 1, breaks[1:]
    word_a, word_b = np.searchsorted(w.start, begin), np.searchsorted(w.start, end)
    some = word_b > word_a
    begin, end, word_a, word_b = begin[some], end[some], word_a[some], word_b[some]
    of = np.searchsorted(text, begin, side="right") - 1
    line_first = np.searchsorted(of, np.arange(len(texts) + 1))
    hashes = span_hashes(w.raw.astype(np.uint64) + np.uint64(1), begin, end)
    keys = mix(hashes + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys, kind="stable")
    duplicate = np.zeros(len(keys), bool)
    duplicate[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    base = {
        "n_words": w.counts,
        "word_chars": of_words[first[1:]] - of_words[first[:-1]],
        "n_symbols": symbols[text[1:] - 1] - symbols[text[:-1]],
        "n_dup_lines": np.bincount(of[duplicate], minlength=len(texts)),
        "n_repeat_words": covered[first[1:]] - covered[first[:-1]],
    }

    def share(table: np.ndarray, part: np.ndarray) -> np.ndarray:
        sums = _sums(table[w.raw])
        return (sums[end] - sums[begin]) / np.maximum(part, 1)

    n = word_b - word_a
    size = end - begin
    upper, lower = share(_IS_UPPER, size), share(_IS_LOWER, size)
    again = np.zeros(len(w.hash), np.int64)
    again[1:] = w.hash[1:] == w.hash[:-1]
    again = _sums(again)
    last = w.end[word_b - 1] - 1
    position = np.arange(len(n)) - line_first[of]
    lines = line_first[of + 1] - line_first[of]
    columns = [
        np.ones(len(n)),
        n <= 3,
        n <= 8,
        n >= 30,
        np.log1p(n) / 5,
        np.minimum(4 * share(_IS_SYMBOL, n), 4),
        share(_IS_SYMBOL, n) > 0.3,
        np.minimum(4 * share(_IS_BAR, n), 4),
        upper / np.maximum(upper + lower, 0.01),
        upper > lower,
        10 * share(_IS_DIGIT, size),
        np.minimum(share(_IS_COMMA, n), 2),
        _CLOSES[w.raw[last]],
        duplicate,
        (covered[word_b] - covered[word_a]) / np.maximum(n, 1),
        (again[word_b] - again[word_a]) / np.maximum(n, 1),
        position == 0,
        position == lines - 1,
    ]
    return Block(base, np.stack(columns, axis=1).astype(np.float64), n, line_first, hashes)


@dataclass
class Field:
    """Scores of content over boilerplate per feature, and of each pair of neighbours."""

    weights: np.ndarray
    turns: np.ndarray  # 2 x 2; boilerplate is 0, content 1

    def decode(self, scores: list[float]) -> list[int]:
        """The likeliest labels (Viterbi)."""
        (stay0, to1), (to0, stay1) = self.turns.tolist()
        zero, one = 0.0, scores[0] if scores else 0.0
        came = []
        for score in scores[1:]:
            a, b = zero + stay0, one + to0
            c, d = zero + to1, one + stay1
            came.append((b > a, d >= c))
            zero, one = (b if b > a else a), (d if d >= c else c) + score
        label = int(one >= zero)
        out = [label] if scores else []
        for from_zero in reversed(came):
            label = int(from_zero[label])
            out.append(label)
        return out[::-1]


def _marginals(scores: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(content) of each line, and the expected number of each turn."""
    n = len(scores)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    forward[0, 1] = scores[0]
    for i in range(1, n):
        for label in (0, 1):
            forward[i, label] = np.logaddexp(
                forward[i - 1, 0] + turns[0, label], forward[i - 1, 1] + turns[1, label]
            ) + label * scores[i]
    for i in range(n - 2, -1, -1):
        for label in (0, 1):
            backward[i, label] = np.logaddexp(
                turns[label, 0] + backward[i + 1, 0],
                turns[label, 1] + scores[i + 1] + backward[i + 1, 1],
            )
    total = np.logaddexp(forward[-1, 0], forward[-1, 1])
    content = np.exp(forward[:, 1] + backward[:, 1] - total)
    following = backward[1:] + np.stack([np.zeros(n - 1), scores[1:]], axis=1)
    pairs = np.exp(forward[:-1, :, None] + turns + following[:, None, :] - total).sum(axis=0)
    return content, pairs


def fit(sequences: list[tuple[np.ndarray, np.ndarray]]) -> Field:
    """The field of (features, labels) sequences, by adaptive gradient ascent."""
    width = sequences[0][0].shape[1]
    weights, turns = np.zeros(width), np.zeros((2, 2))
    past_w, past_t = np.full(width, 1e-6), np.full((2, 2), 1e-6)
    random = np.random.default_rng(6)
    for _ in range(EPOCHS):
        for i in random.permutation(len(sequences)):
            x, y = sequences[i]
            content, pairs = _marginals(x @ weights, turns)
            step = x.T @ (y - content) - L2 * weights
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[:-1], y[1:]), 1)
            step_t = seen - pairs - L2 * turns
            past_w += step * step
            past_t += step_t * step_t
            weights += RATE * step / np.sqrt(past_w)
            turns += RATE * step_t / np.sqrt(past_t)
    return Field(weights, turns)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field | None:
    """A field from (doc_id, text) and (doc_id, quality).

    Ids whose crc32 as text leaves 2 modulo 4 are not learned from, so that the
    result can be measured on them.
    """

    def read(batch: pa.RecordBatch) -> dict:
        features, hashes = [], []
        texts = bytes_of(batch.column("text"))
        for low, high in blocks(texts):
            block = describe(texts[low:high])
            for i in range(high - low):
                a, b = block.line_first[i : i + 2]
                features.append(block.features[a:b].tobytes())
                hashes.append(block.line_hash[a:b].tobytes())
        return {
            "doc_id": batch.column("doc_id").cast(pa.int64()),
            "label": batch.column("label"),
            "features": features,
            "hashes": hashes,
        }

    chosen = labelled_sample(docs, labels, "quality", sample, remainder("doc_id", 4) != 2)
    rows = (
        map_batches(
            chosen, read, "doc_id bigint, label int, features binary, hashes binary"
        )
        .where(F.length("hashes") > 0)
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("features", "ascending")])
        .to_pydict()
    )
    if not rows["doc_id"]:
        return None
    hashes_of = [np.frombuffer(hashes, np.uint64) for hashes in rows["hashes"]]
    documents_with = Counter(h for hashes in hashes_of for h in set(hashes.tolist()))
    common = max(3, COMMON_LINE * len(hashes_of))
    sequences = []
    for label, features, hashes in zip(rows["label"], rows["features"], hashes_of, strict=True):
        rare = np.array([documents_with[h] < common for h in hashes.tolist()])
        y = (rare & (label == 1)).astype(np.int64)
        sequences.append((np.frombuffer(features).reshape(len(hashes), -1), y))
    return fit(sequences)


def judged(docs: DataFrame, field: Field | None, share: float = CONTENT_SHARE) -> DataFrame:
    """Per row of (doc_id, text): the base counts, base_failed, content_share and kept."""
    shipped = docs.sparkSession.sparkContext.broadcast(field)

    def score(batch: pa.RecordBatch) -> dict:
        field = shipped.value
        texts = bytes_of(batch.column("text"))
        out: dict[str, list] = {}
        shares = []
        for low, high in blocks(texts):
            block = describe(texts[low:high])
            for name, values in block.base.items():
                out.setdefault(name, []).append(values)
            if field is None:
                shares += [1.0] * (high - low)
                continue
            scores = (block.features @ field.weights).tolist()
            sizes = block.line_words.tolist()
            firsts = block.line_first.tolist()
            for a, b in zip(firsts, firsts[1:], strict=False):
                labels = field.decode(scores[a:b])
                content = sum(n for n, label in zip(sizes[a:b], labels, strict=True) if label)
                shares.append(content / max(1, sum(sizes[a:b])))
        counts = {name: np.concatenate(parts) for name, parts in out.items()}
        failed = (counts["n_words"] < LEAST_WORDS) | (
            100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"]
        )
        shares = np.array(shares)
        return {
            "doc_id": batch.column("doc_id"),
            **counts,
            "base_failed": failed,
            "content_share": shares,
            "kept": ~failed & (shares >= share),
        }

    return map_batches(
        docs.select("doc_id", "text"),
        score,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint,"
        " word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
        " base_failed boolean, content_share double, kept boolean",
    )
