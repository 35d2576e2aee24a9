"""Language of a text: sparse multinomial logistic regression on character n-grams.

Features are the n-grams of one to four characters inside words (a word has one
space on either side), of the lower-cased letters, hashed into 2**14 buckets.
A value is log(1 + count) times the inverse document frequency, and a text's
vector has length one.  Weights come from the follow-the-regularised-leader
algorithm with an L1 and an L2 penalty, one rate per weight; probabilities are
then calibrated with one temperature on texts that were not trained on.

Document frequencies are counted over all training texts.  The regression is
fitted on a sample of about ``sample`` texts per language, at most twice as many
in all, the only bound here, by one task; only weights and counts are collected.
Ids are chosen by hash and stored with one text each, that of the smallest hash.

A null text, or one without a letter, is ``und`` with score 0; so is every text
if there is nothing to learn from.  Repeated rows get equal results; document
frequencies count them as often as they occur, the sample once.  Rows with a null id are predicted
like others and not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from scholarlake.llm.common import fresh, map_batches, remainder, slices, stored
from scholarlake.llm.tokens import BLOCK_BYTES, blocks

UNKNOWN = "und"
BITS = 14
SIZES = (1, 2, 3, 4)
SAMPLE = 800  # texts per language
LEAST_SCORE = 0.4  # below, a text is in none of the learned languages
BLOCK_TEXTS = 16

ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.01
EPOCHS = 3


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)


def counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, n): how often each text has n-grams of a bucket, in that order."""
    # A line feed between the texts, as any character that is no letter, ends a word.
    lower = [text.lower() for text in texts]
    joined = "\n" + "\n".join(lower) + "\n"
    chars = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    sizes = np.fromiter((len(text) + 1 for text in lower), np.int64, len(texts))
    letter = _letters()[np.minimum(chars, 0xFFFF)] | (chars > 0xFFFF)
    sizes[0] += 1
    of = np.repeat(np.arange(len(texts), dtype=np.int32) << BITS, sizes)
    # One space between words.
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[0] = True
    chars = np.where(letter, chars, np.uint32(32))[kept]
    letter, of = letter[kept], of[kept]
    codes = []
    n = len(chars)
    grams = np.zeros(n, np.uint32)
    inside = np.ones(n, bool)
    for size in SIZES:
        m = n - size + 1
        if m <= 0:
            break
        grams = grams[:m] * np.uint32(0x01000193) + chars[size - 1 :]
        if size > 2:
            # All but the first and the last character are letters.
            inside = inside[:m] & letter[size - 2 : size - 2 + m]
            valid = inside
        else:
            inside = inside[:m]
            valid = letter[:m] if size == 1 else letter[:m] | letter[1:]
        hashed = (grams ^ np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(0xC2B2AE35)
        # An n-gram belongs to the text of the word that it is in.
        owner = of[size // 2 : size // 2 + m]
        codes.append((owner + (hashed >> np.uint32(32 - BITS)).astype(np.int32))[valid])
    times = np.bincount(np.concatenate(codes), minlength=1)
    some = np.flatnonzero(times)
    return some >> BITS, some & ((1 << BITS) - 1), times[some]


def text_blocks(column) -> Iterator[tuple[int, int, list[str]]]:
    """A column in blocks of a few texts; null is empty."""
    texts = [text or "" for text in column.to_pylist()]
    raw = [text.encode("utf-8", "replace") for text in texts]
    for low, high in blocks(raw, BLOCK_BYTES):
        for begin in range(low, high, BLOCK_TEXTS):
            end = min(high, begin + BLOCK_TEXTS)
            yield begin, end, texts[begin:end]


@dataclass
class Model:
    """``weights`` has a row per bucket and a last one that always counts."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def probabilities(self, texts: list[str]) -> np.ndarray:
        of, at, times = counts(texts)
        values = np.log1p(times) * self.idf[at]

        def total(x: np.ndarray) -> np.ndarray:
            return np.bincount(of, x, len(texts))

        norm = np.sqrt(total(values * values))
        weights = self.weights[at]
        scores = np.stack([total(values * column) for column in weights.T], axis=1)
        scores /= np.where(norm > 0, norm, 1)[:, None]
        return softmax((scores + self.weights[-1]) / self.temperature)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """The number of texts, and of those that have an n-gram of each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, have = 0, np.zeros(1 << BITS, np.int64)
        for batch in (part for whole in batches for part in slices(whole)):
            for begin, end, part in text_blocks(batch.column("text")):
                total += end - begin
                have += np.bincount(counts(part)[1], minlength=1 << BITS)
        if total:
            some = np.flatnonzero(have)
            yield pa.RecordBatch.from_pydict(
                {"bucket": np.append(some, -1), "n": np.append(have[some], total)}
            )

    rows = (
        texts.select("text")
        .mapInArrow(count, "bucket bigint, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    out = np.zeros((1 << BITS) + 1, np.int64)  # the last one is bucket -1
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return int(out[-1]), out[:-1]


def follow_the_regularised_leader(
    rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, features: int, l1: float = L1
) -> np.ndarray:
    """Weights of a multinomial regression on sparse (indices, values).

    ``target`` has a row of class probabilities for each of ``rows``.
    """
    classes = target.shape[1]
    z = np.zeros((features, classes))
    n = np.zeros((features, classes))

    def weights(at) -> np.ndarray:
        zs = z[at]
        shrunk = np.sign(zs) * l1 - zs
        return np.where(
            np.abs(zs) > l1, shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0
        )

    random = np.random.default_rng(4)
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            at, x = rows[i]
            w = weights(at)
            gradient = np.outer(x, softmax(x @ w) - target[i])
            squares = gradient * gradient
            rate = (np.sqrt(n[at] + squares) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - rate * w
            n[at] += squares
    return weights(np.arange(features))


def with_constant(at: np.ndarray, x: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """A sparse vector with one more feature, which is always 1; small in memory."""
    return (
        np.append(at, np.int32(last)).astype(np.int32),
        np.append(x, np.float32(1)).astype(np.float32),
    )


def calibrated(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that makes the labels likeliest."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(scores / np.exp(log_t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-300)).mean()

    low, high = np.log(0.05), np.log(20.0)
    golden = (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from (doc_id, text, lang); rows with a null in them are not used."""
    usable = labelled.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    # Ids, not rows: one with many rows is one text of the sample.
    counted = usable.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n"))
    per_language = {r.lang: r.n for r in counted.collect()}
    languages = sorted(per_language)
    if not languages:
        return None
    total, have = document_frequencies(usable)
    idf = (np.log((1 + total) / (1 + have)) + 1).astype(np.float32)

    spread = 1 << 30
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(spread))
    share = F.create_map(
        *(x for lang in languages
          for x in (F.lit(lang), F.lit(min(spread, spread * sample // per_language[lang]))))
    )
    # Combined in each task first: an id with many rows sends one per task.
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    chosen = stored(
        usable.where(place < share[F.col("lang")])
        .groupBy("lang", "doc_id")
        .agg(one)
        .select(
            place.alias("place"),
            "one.hash",
            "one.text",
            "lang",
            F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(5)).alias("part"),
        )
    )

    def sparse(batch: pa.RecordBatch) -> dict:
        at, values = [], []
        for _, _, texts in text_blocks(batch.column("text")):
            of, buckets, times = counts(texts)
            cuts = np.searchsorted(of, np.arange(1, len(texts)))
            at += [part.tobytes() for part in np.split(buckets.astype(np.int32), cuts)]
            values += [part.tobytes() for part in np.split(times.astype(np.int32), cuts)]
        kept = ("place", "hash", "lang", "part")
        return {c: batch.column(c) for c in kept} | {"at": at, "n": values}

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, schema=arrow)
        weights, temperature = fitted(rows, languages, idf)
        yield pa.RecordBatch.from_pydict(
            {"weights": [weights.tobytes()], "temperature": [temperature]}
        )

    schema = "lang string, part bigint, at binary, n binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    # The limit makes the bound certain; its order is that of the ids' hashes.  One
    # task fits the model; only the weights come to the driver.
    found = (
        map_batches(chosen, sparse, "place bigint, hash bigint, " + schema)
        .orderBy("place", "lang", "hash", "part")
        .limit(2 * sample * len(languages))
        .select("lang", "part", "at", "n")
        .coalesce(1)
        .mapInArrow(fit, "weights binary, temperature double")
        .first()
    )
    if found is None:
        return None
    weights = np.frombuffer(found.weights, np.float32).reshape(-1, len(languages))
    return Model(languages, idf, weights, found.temperature)


def fitted(rows: pa.Table, languages: list[str], idf: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and temperature from (lang, part, at, n); part 0 calibrates."""
    rows = rows.sort_by([(c, "ascending") for c in ("part", "lang", "n", "at")])
    features = (1 << BITS) + 1
    vectors = []
    for at, n in zip(rows["at"], rows["n"], strict=True):
        at = np.frombuffer(at.as_py(), np.int32)
        x = np.log1p(np.frombuffer(n.as_py(), np.int32)) * idf[at]
        norm = np.sqrt((x * x).sum())
        vectors.append(with_constant(at, x / (norm or 1), features - 1))
    labels = np.array([languages.index(lang) for lang in rows["lang"].to_pylist()], np.int64)
    held = rows["part"].to_numpy() == 0
    trained = np.flatnonzero(~held) if not held.all() else np.arange(len(held))
    weights = follow_the_regularised_leader(
        [vectors[i] for i in trained], np.eye(len(languages))[labels[trained]], features
    )
    held = np.flatnonzero(held) if len(trained) < len(held) else np.zeros(0, np.int64)
    scores = np.array([x @ weights[at] for at, x in (vectors[i] for i in held)])
    return weights.astype(np.float32), calibrated(scores, labels[held])


def predict(
    docs: DataFrame, model: Model | None, names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` (with a text column) with two columns more: the language and its probability."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> dict:
        model = shipped.value
        languages, scores = [], []
        for _, _, texts in text_blocks(batch.column("text")):
            known = [any(map(str.isalpha, text)) and model is not None for text in texts]
            p = model.probabilities(texts) if any(known) else np.zeros((len(texts), 1))
            for best, top, ok in zip(p.argmax(axis=1), p.max(axis=1), known, strict=True):
                languages.append(model.languages[best] if ok else UNKNOWN)
                scores.append(float(top) if ok else 0.0)
        return {c: batch.column(c) for c in batch.schema.names} | {
            names[0]: languages, names[1]: scores
        }

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(docs, score, f"{own}, `{names[0]}` string, `{names[1]}` double")


def labelled_part(docs: DataFrame) -> DataFrame:
    """What may be learned from: ids whose crc32 as text does not leave 2 modulo 4."""
    return docs.where(remainder("doc_id", 4) != 2).select(
        "doc_id", "text", F.col("lang").cast("string")
    )


def identified(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of (doc_id, text, lang).

    Held out are ids whose crc32 as text leaves 2 modulo 4; labels of all others
    are learned from.
    """
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = train(labelled_part(docs), sample)
    return predict(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")


def accepted(docs: DataFrame, least: float = LEAST_SCORE, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` in a known language with at least this probability, all columns."""
    language, score = fresh(docs, "lang_pred", "score")
    found = predict(docs, train(labelled_part(docs), sample), (language, score))
    return found.where((F.col(language) != UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)
