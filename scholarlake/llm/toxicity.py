"""Toxicity by weak supervision: many voters, a label model, a linear classifier.

Voters are mined from labelled texts: single words (a lexicon) and beginnings of
words (patterns) that toxic texts have far more often, each in several ranges of
occurrences per hundred words.  A voter fires or abstains.

The label model is generative: given the hidden class, every voter fires at its
own rate; rates and the voters' correlations within the classes are estimated by
expectation maximisation.  It is half supervised: gold labels choose the voters,
are the first guess of the classes, give the share of toxic texts, and are a share
``ANCHOR`` of what every round estimates from; the rest is the posterior.  Without
that anchor rare voters are lost, as their texts drift to the other class.  All this
is counted over all learnable labelled texts: texts with the same votes are one row,
and a round is one aggregation of sums.

The posterior of each text, not its label, is what the classifier is trained on:
a logistic regression on hashed words and beginnings, fitted by a
follow-the-regularised-leader step per text.  Its scores are then calibrated on a
fifth of the sample, each text weighted by how many of its label it stands for.

Only rows whose crc32 of the id as text does not leave 1 modulo 3 are learned
from.  The classifier, and nothing else, is fitted on a sample of at most
``sample`` texts of either label, by one task; that is the only bound.  Null and empty texts are scored like texts without any such word.  With
no toxic or no other labels to learn from, every score is 0.  Repeated rows get
equal results; rows with a null id are scored and not learned from.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from scholarlake.llm.bitmap import bitmap
from scholarlake.llm.bitmap import found as found_in
from scholarlake.llm.common import labelled_sample, map_batches, remainder, stored
from scholarlake.llm.language_id import follow_the_regularised_leader, with_constant
from scholarlake.llm.tokens import Words, blocks, bytes_of, words

SAMPLE = 2000  # texts of either label, for the classifier
VOTERS = 160
BEGINNINGS = (4, 5, 6, 7)  # bytes
RANGES = (0.4, 1.0)  # bounds of a voter's range, in occurrences per hundred words
LIFT = 4.0  # how much more often than in other texts a voter must fire in toxic ones
EVIDENCE = 40.0  # least log-likelihood ratio; millions of candidates are compared
QUIET = 0.5  # how much a voter counts that does not fire
TELLING = 15.0  # the same for the classifier's features, of which there are fewer
L1 = 0.3
BITS = 17
THRESHOLD = 0.7
ANCHOR = 0.5  # share of the gold label in what a round estimates from
ROUNDS = 10  # of expectation maximisation
UNIT = 1 << 24  # sums of probabilities are whole numbers of these parts: exact in any order


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every word and beginning of a word."""
    of = w.of
    hashes, owners = [w.hash], [of]
    for size in BEGINNINGS:
        own, which = w.beginnings(size)
        hashes.append(own ^ np.uint64(size * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        owners.append(of[which])
    return np.concatenate(hashes), np.concatenate(owners)


def rates(w: Words, hashes: np.ndarray, owners: np.ndarray):
    """(text, hash, occurrences per hundred words), each pair once."""
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(hashes)))
    return owners[at], hashes[at], 100 * times / np.maximum(w.counts[owners[at]], 1)


@dataclass
class Voters:
    """Sorted hashes, and for each the range in which it fires."""

    hashes: np.ndarray
    ranges: np.ndarray

    def votes(self, of: np.ndarray, hashes: np.ndarray, rate: np.ndarray, n: int) -> np.ndarray:
        """Which voters fire on each of n texts."""
        out = np.zeros((n, len(self.hashes)), bool)
        low = np.searchsorted(self.hashes, hashes, "left")
        high = np.searchsorted(self.hashes, hashes, "right")
        for i in np.flatnonzero(high > low):
            which = slice(low[i], high[i])
            out[of[i], which] |= self.ranges[which] == np.searchsorted(RANGES, rate[i])
        return out


def mined(sample: DataFrame, texts: tuple[int, int], most: int = VOTERS) -> Voters:
    """The voters of labelled texts (text, label), so many of them of label 0 and of 1."""

    def count(batch: pa.RecordBatch) -> dict:
        labels = batch.column("label").to_numpy()
        texts = batch.column("key").to_numpy().view(np.uint64)
        raw = bytes_of(batch.column("text"))
        keys, marks, fired = [], [], []
        for low, high in blocks(raw):
            w = words(raw[low:high])
            of, hashes, rate = rates(w, *features(w))
            keys.append(hashes)
            marks.append(2 * np.searchsorted(RANGES, rate) + labels[low + of])
            fired.append(texts[low + of])
        hashes, mark = np.concatenate(keys), np.concatenate(marks).astype(np.int64)
        order = np.lexsort((mark, hashes))
        hashes, mark, on = hashes[order], mark[order], np.concatenate(fired)[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (mark[1:] != mark[:-1])
        at = np.flatnonzero(new)
        return {
            "hash": hashes[at].view(np.int64),
            "level": mark[at] // 2,
            "label": mark[at] % 2,
            "n": np.diff(np.append(at, len(hashes))),
            # Two times 24 bits: their sums do not overflow below 2**39 texts.
            "on1": np.add.reduceat(on >> np.uint64(40), at).view(np.int64) if len(at) else [],
            "on2": np.add.reduceat(on & np.uint64(0xFFFFFF), at).view(np.int64) if len(at) else [],
        }

    clean, toxic = texts
    counted = (
        map_batches(
            sample.withColumn("key", F.xxhash64("text")),
            count,
            "hash bigint, level bigint, label bigint, n bigint, on1 bigint, on2 bigint",
        )
        .groupBy("hash", "level")
        .agg(
            F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
            F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"),
            F.sum("on1").alias("on1"),
            F.sum("on2").alias("on2"),
        )
        .where(F.col("toxic") >= 5)
    )
    fired = F.col("toxic") + F.col("clean")

    def information(part, expected):
        return F.when(part > 0, 2 * part * F.log(part / expected)).otherwise(0.0)

    evidence = information(F.col("toxic"), fired * toxic / (toxic + clean)) + information(
        F.col("clean"), fired * clean / (toxic + clean)
    )
    lift = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    best = (
        counted.withColumns({"lift": lift, "evidence": evidence})
        .where((F.col("lift") >= LIFT) & (F.col("evidence") >= EVIDENCE))
        # Beginnings of one word fire on the same texts, told by the sums of these
        # texts' hashes: one of each kind is enough.
        .groupBy("level", "toxic", "clean", "on1", "on2")
        .agg(F.max("evidence").alias("evidence"), F.min("hash").alias("hash"))
        .orderBy(F.desc("evidence"), "hash", "level")
        .limit(most)
        .toArrow()
    )
    hashes = best["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes, kind="stable")
    return Voters(hashes[order], best["level"].to_numpy()[order])


@dataclass
class LabelModel:
    """Rates of firing of every voter in either class, and how voters agree within them.

    A text on which no voter fires is one more voter's, the last: silence.  What
    a voter adds to the log-odds is divided by how much it agrees with all that
    fire with it, so that copies of a voter count once together and independent
    ones in full.
    """

    prior: float  # log-odds of a toxic text
    on: np.ndarray
    off: np.ndarray
    agreement: np.ndarray

    def posterior(self, fires: np.ndarray) -> np.ndarray:
        """P(toxic) of each text from its votes alone."""
        weight = fires / np.maximum(fires @ self.agreement, 1)
        odds = self.prior + weight @ (np.log(self.on) - np.log(self.off))
        # Voters that do not fire, each by its share of all that it agrees with.
        quiet = QUIET * (np.log1p(-self.on) - np.log1p(-self.off)) / self.agreement.sum(axis=0)
        odds += (1 - fires[:, :-1]) @ quiet[:-1]
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def with_silence(votes: np.ndarray) -> np.ndarray:
    return np.column_stack([votes, ~votes.any(axis=1)]).astype(np.float64)


def sums(fires: np.ndarray, texts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """In UNITs, of texts that are toxic with these probabilities: their number, the
    sum of squares, and of every voter the toxic texts on which it fires."""
    one = np.rint(toxic * UNIT).astype(np.int64) * texts
    square = np.rint(toxic * toxic * UNIT).astype(np.int64) * texts
    return np.concatenate([[one.sum(), square.sum()], fires.astype(np.int64).T @ one])


def anchored(
    fires: np.ndarray, texts: np.ndarray, gold: np.ndarray, posterior: np.ndarray, anchor: float
) -> np.ndarray:
    """The ``sums`` of posteriors mixed with gold labels, by which ``gold`` are toxic."""
    mixed = (1 - anchor) * posterior
    return sums(fires, gold, mixed + anchor) + sums(fires, texts - gold, mixed)


def estimated(prior: float, texts: int, together: np.ndarray, found: np.ndarray) -> LabelModel:
    """The model of ``sums`` and of how many texts any two voters fire on together."""
    toxic, square, *both = found / UNIT
    both, fired = np.array(both), together.diagonal()
    on = (both + 0.5) / (toxic + 1)
    off = (fired - both + 0.5) / (texts - toxic + 1)

    def cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.outer(a, b) + np.outer(b, a)

    # What the classes leave unexplained, summed over the texts: the products of
    # fires - toxic * on - (1 - toxic) * off, multiplied out.
    left = together - cross(both, on) - cross(fired - both, off)
    left += square * np.outer(on, on) + (texts - 2 * toxic + square) * np.outer(off, off)
    left += (toxic - square) * cross(on, off)
    scale = np.sqrt(left.diagonal().clip(0)).clip(1e-9)
    agreement = np.maximum(left / np.outer(scale, scale), 0)
    np.fill_diagonal(agreement, 1)
    return LabelModel(prior, on, off, agreement)


def expectation_maximisation(
    texts: int,
    together: np.ndarray,
    first: np.ndarray,
    again: Callable[[LabelModel], np.ndarray],
    rounds: int = ROUNDS,
) -> LabelModel:
    """From the ``sums`` of a first guess; ``again`` gives those of a model's posterior."""
    toxic = first[0] / UNIT
    prior = float(np.log(toxic + 1) - np.log(texts - toxic + 1))
    model = estimated(prior, texts, together, first)
    for _ in range(rounds - 1):
        model = estimated(prior, texts, together, again(model))
    return model


def label_model(
    votes: np.ndarray, first: np.ndarray, rounds: int = ROUNDS, anchor: float = ANCHOR
) -> np.ndarray:
    """P(toxic) of each text of a matrix of votes; ``first`` is the gold label of each."""
    fires = with_silence(votes)
    one, gold = np.ones(len(fires), np.int64), first.astype(np.int64)
    model = expectation_maximisation(
        len(fires),
        fires.T @ fires,
        sums(fires, gold, np.ones(len(fires))),
        lambda model: anchored(fires, one, gold, model.posterior(fires), anchor),
        rounds,
    )
    return model.posterior(fires)


def patterns(texts: DataFrame, voters: Voters) -> DataFrame:
    """(votes, n, toxic), stored: how many of (text, label) have just these votes."""

    def vote(batch: pa.RecordBatch) -> dict:
        raw, out = bytes_of(batch.column("text")), []
        for low, high in blocks(raw):
            w = words(raw[low:high])
            fired = voters.votes(*rates(w, *features(w)), high - low)
            out += [v.tobytes() for v in np.packbits(fired, axis=1)]
        return {"votes": out, "label": batch.column("label")}

    return stored(
        map_batches(texts, vote, "votes binary, label int")
        .groupBy("votes")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic"))
    )


def unpacked(votes: pa.Array, voters: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(votes.to_pylist()), np.uint8).reshape(len(votes), -(-voters // 8))
    return np.unpackbits(raw, axis=1, count=voters).astype(bool)


def fitted_label_model(
    counted: DataFrame, voters: int, rounds: int = ROUNDS, anchor: float = ANCHOR
) -> LabelModel:
    """The label model of stored ``patterns``; every round is one aggregation."""
    size = voters + 1

    def summed(rows: Callable[[np.ndarray, pa.RecordBatch], np.ndarray], length: int):
        def over(batch: pa.RecordBatch) -> dict:
            values = rows(with_silence(unpacked(batch.column("votes"), voters)), batch)
            at = np.flatnonzero(values)
            return {"at": at, "value": values[at].astype(np.int64)}

        out = np.zeros(length)
        added = map_batches(counted, over, "at bigint, value bigint").groupBy("at")
        for row in added.agg(F.sum("value").alias("value")).collect():
            out[row["at"]] = row["value"]
        return out

    def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
        return batch.column(name).to_numpy()

    def pairs(fires: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        return (fires.T @ (fires * numbers(batch, "n")[:, None])).ravel()

    def labelled(fires: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        return sums(fires, numbers(batch, "toxic"), np.ones(len(fires)))

    def again(model: LabelModel) -> np.ndarray:
        def told(fires: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
            n, gold = numbers(batch, "n"), numbers(batch, "toxic")
            return anchored(fires, n, gold, model.posterior(fires), anchor)

        return summed(told, size + 2)

    texts = counted.agg(F.sum("n")).first()[0]
    together = summed(pairs, size * size).reshape(size, size)
    return expectation_maximisation(texts, together, summed(labelled, size + 2), again, rounds)


@dataclass
class Model:
    weights: np.ndarray  # of hashed features, by rate; then by whether the rate is high
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        w = words(texts)
        hashes, owners = features(w)
        buckets = _bucket(hashes)
        by_rate, by_range = self.weights.reshape(2, -1)
        matters = ((by_rate != 0) | (by_range != 0))[buckets]
        of, at, rate = rates(w, buckets[matters], owners[matters])
        told = by_rate[at] * np.log1p(rate) + by_range[at] * (rate > RANGES[0])
        total = np.bincount(of, told, len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(text, label), stored: every row of ``docs`` with a text and an id of ``known``.

    ``known`` (doc_id, label) has each id once.  A filter of its ids keeps most other
    texts out of the shuffle; beyond some eight million ids more of them pass.
    """
    bits = min(max(20, (16 * known.count()).bit_length()), 27)  # 128 KB to 16 MB
    hashed = F.xxhash64(F.col("doc_id").cast("long"))
    shipped = docs.sparkSession.sparkContext.broadcast(
        bitmap(known.select(hashed.alias("hash")), "hash", bits)
    )

    @F.pandas_udf("boolean")
    def passes(hashes: pd.Series) -> pd.Series:
        return pd.Series(found_in(shipped.value, hashes.to_numpy(np.int64).view(np.uint64)))

    likely = docs.where("text IS NOT NULL AND doc_id IS NOT NULL").where(passes(hashed))
    # Spark broadcasts the labels if they are small, else it splits a hot id.
    return stored(likely.select("doc_id", "text").join(known, "doc_id").select("text", "label"))


def train(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, anchor: float = ANCHOR
) -> Model | None:
    learnable = remainder("doc_id", 3) != 1
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learnable)
        .groupBy("doc_id")
        .agg(F.min(F.col("toxic").cast("int")).alias("label"))
        .where("label IN (0, 1)")
    )
    texts = labelled(docs, stored(known))
    found = {r.label: r.n for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(found) < 2:
        return None
    voters = mined(texts, (found[0], found[1]))
    model = fitted_label_model(patterns(texts, voters), len(voters.hashes), anchor=anchor)
    looked_at = _bucket(voters.hashes)
    looked_at = np.concatenate([looked_at, looked_at + (1 << BITS)])
    stands_for = np.array([found[0], found[1]]) / (found[0] + found[1])

    def read(batch: pa.RecordBatch) -> dict:
        raw = bytes_of(batch.column("text"))
        posterior, ats, values = [], [], []
        for low, high in blocks(raw):
            w = words(raw[low:high])
            hashes, owners = features(w)
            fired = voters.votes(*rates(w, hashes, owners), high - low)
            posterior += model.posterior(with_silence(fired)).tolist()
            of, at, rate = rates(w, _bucket(hashes), owners)
            cuts = np.searchsorted(of, np.arange(1, high - low))
            for own, value in zip(np.split(at, cuts), np.split(rate, cuts), strict=True):
                many = own[value > RANGES[0]] + (1 << BITS)
                ats.append(np.append(own, many).astype(np.int32).tobytes())
                told = np.append(np.log1p(value), np.ones(len(many)))
                values.append(told.astype(np.float32).tobytes())
        return {
            "doc_id": batch.column("doc_id").cast(pa.int64()),
            "label": batch.column("label"),
            "posterior": posterior,
            "at": ats,
            "value": values,
        }

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches, schema=arrow)
        weights, bias = fitted(rows, stands_for, looked_at)
        yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()], "bias": [bias]})

    schema = "doc_id bigint, label int, posterior double, at binary, value binary"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    chosen = labelled_sample(docs, labels, "toxic", sample, learnable)
    # One task fits the classifier; only the weights come to the driver.
    got = (
        map_batches(chosen.select("doc_id", "text", "label"), read, schema)
        .coalesce(1)
        .mapInArrow(fit, "weights binary, bias double")
        .first()
    )
    return Model(np.frombuffer(got.weights, np.float32), got.bias)


def fitted(
    rows: pa.Table, stands_for: np.ndarray, voters: np.ndarray
) -> tuple[np.ndarray, float]:
    """Calibrated weights and bias from (doc_id, label, posterior, at, value).

    Both labels were sampled alike; ``stands_for`` is the share of either in all
    texts, ``voters`` where the features are that voters look at.
    """
    rows = rows.sort_by([("doc_id", "ascending"), ("at", "ascending")])
    posterior, label = rows["posterior"].to_numpy(), rows["label"].to_numpy()
    size = (2 << BITS) + 1
    vectors = [
        with_constant(
            np.frombuffer(at.as_py(), np.int32), np.frombuffer(value.as_py(), np.float32), size - 1
        )
        for at, value in zip(rows["at"], rows["value"], strict=True)
    ]
    vectors = told_apart(vectors, posterior, size, voters)
    ids = rows["doc_id"].to_pylist()
    held = np.array([zlib.crc32(b"part" + str(i).encode()) % 5 == 0 for i in ids])
    trained = np.flatnonzero(~held)
    weights = follow_the_regularised_leader(
        [vectors[i] for i in trained],
        np.stack([1 - posterior, posterior], axis=1)[trained],
        size,
        L1,
    )
    weights = weights[:, 1] - weights[:, 0]
    counts = (stands_for / np.bincount(label, minlength=2).clip(1))[label]
    told = np.array([x @ weights[at] for at, x in vectors])
    scale, shift = calibrated(told[held], posterior[held], counts[held] * held.sum())
    return (weights[:-1] * scale).astype(np.float32), float(weights[-1] * scale + shift)


def told_apart(
    vectors: list[tuple[np.ndarray, np.ndarray]],
    posterior: np.ndarray,
    size: int,
    voters: np.ndarray,
) -> list[tuple[np.ndarray, np.ndarray]]:
    """The vectors without features that say nothing of the class.

    The last feature stays, and so do those at ``voters``, which voters look at.
    """
    texts = np.stack([1 - posterior, posterior])
    have = np.zeros((2, size))
    for (at, _), weight in zip(vectors, texts.T, strict=True):
        have[:, at] += weight[:, None]
    total = texts.sum(axis=1, keepdims=True)
    expected = have.sum(axis=0) * total / total.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        information = 2 * np.nansum(have * np.log(have / expected), axis=0)
    kept = information >= TELLING
    kept[-1] = True
    kept[voters] = True
    return [(at[kept[at]], x[kept[at]]) for at, x in vectors]


def calibrated(scores: np.ndarray, target: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """(scale, shift) that make sigmoid(scale * score + shift) likeliest (Platt scaling)."""
    theta = np.array([1.0, 0.0])
    x = np.stack([scores, np.ones(len(scores))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        # A little weight holds the scale where the scores separate the classes.
        gradient = x.T @ (counts * (p - target)) + np.array([0.1, 0.01]) * (theta - [1, 0])
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + np.diag([0.1, 0.01])
        step = np.linalg.solve(curve, gradient)
        theta -= step / max(1.0, np.abs(step).max())
    return float(max(theta[0], 0.05)), float(theta[1])


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row of (doc_id, text): doc_id, held_out, score, predicted."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> dict:
        model = shipped.value
        raw = bytes_of(batch.column("text"))
        out = np.zeros(len(raw))
        if model is not None:
            for low, high in blocks(raw):
                out[low:high] = model.score(raw[low:high])
        return {
            "doc_id": batch.column("doc_id"),
            "held_out": batch.column("held_out"),
            "score": out,
            "predicted": (out >= THRESHOLD).astype(np.int32),
        }

    held = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return map_batches(
        docs.select("doc_id", held.alias("held_out"), "text"),
        score,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean,"
        " score double, predicted int",
    )
