"""Repeated passages: runs of consecutive pieces of sentences, hashed and joined globally.

A sentence ends at a line feed, or at one of ``.!?`` that white space follows
before the next word.  Words are those of ASCII letters, digits and everything
beyond ASCII, lower-cased, so case and punctuation do not matter.  So that a passage is
also found where its host's sentences begin and end elsewhere, sentences are cut into
pieces by their words alone: after words whose hash is a multiple of eight or the
smallest of the 17 around.  Pieces, not sentences, are what is counted and removed.

From every piece on, and up to every piece, the shortest run of at least ``least``
words is hashed to 128 bits, be it one piece or many.  The first occurrence of a run
is the one in the smallest row key (doc_id, hash of the text) and there the first
place; all others are repeated, also within a text.  Pieces inside a repeated run that
is not the first are removed, with the characters up to the next word.  So a passage of
that many words that begins and ends with sentences is removed from end to end; any
other one from its first cut to its last, if there are as many words between them.

Null texts stay null, texts without words and shorter texts than a run stay as
they are.  Repeated rows have one key and get equal results: they are one
occurrence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarlake.llm.bitmap import bitmap, found
from scholarlake.llm.common import fresh, map_batches, row_key, stored
from scholarlake.llm.tokens import Words, blocks, bytes_of, span_hashes, words

WORDS = 25
AROUND = 8  # words before and behind one that a piece may end with
# Bits of the filter of repeated hashes, as powers of two: 128 KB to 16 MB.
LEAST_BITS, MOST_BITS = 20, 27

_LINE = np.zeros(256, np.int32)
_LINE[ord("\n")] = 1
_STOP = np.zeros(256, np.int32)
_STOP[list(b".!?")] = 1
_SPACE = np.zeros(256, np.int32)
_SPACE[list(b" \t\n\x0b\x0c\r")] = 1


def sentence_ends(w: Words) -> np.ndarray:
    """For each word whether a sentence ends with it."""
    n = len(w.hash)
    if not n:
        return np.zeros(0, bool)
    def between(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[w.raw], dtype=np.int64)])
        return sums[np.append(w.start[1:], len(w.raw))] - sums[w.end]

    ends = between(_LINE) > 0
    ends |= (between(_STOP) > 0) & (between(_SPACE) > 0)
    last = w.first[1:][w.counts > 0] - 1
    ends[last] = True
    return ends


def piece_ends(w: Words) -> np.ndarray:
    """For each word whether a piece ends with it."""
    ends = sentence_ends(w) | (w.hash % np.uint64(8) == 0)
    width = 2 * AROUND + 1
    if len(w.hash) >= width:
        # Words that repeat in a circle need not have a hash of the first kind.
        least = np.lib.stride_tricks.sliding_window_view(w.hash, width).min(axis=1)
        inside = w.of[: -2 * AROUND] == w.of[2 * AROUND :]
        ends[AROUND:-AROUND] |= inside & (w.hash[AROUND:-AROUND] == least)
    return ends


def runs(w: Words, least: int):
    """First and last piece of every run; begin and end word of every piece.

    They are the shortest runs that begin with a piece, and those that end with one.
    """
    end = np.flatnonzero(piece_ends(w)) + 1
    begin = np.concatenate([[0], end[:-1]]).astype(np.int64)
    count = len(end)
    every = np.arange(count)
    first = np.concatenate([every, np.searchsorted(begin, end - least, "right") - 1])
    last = np.concatenate([np.searchsorted(end, begin + least), every])
    inside = (first >= 0) & (last < count)
    first, last = np.divmod(np.unique(first[inside] * count + last[inside]), max(count, 1))
    of = w.of
    same = of[begin[first]] == of[begin[last]]
    return first[same], last[same], begin, end


def _pieces_of(w: Words, begin: np.ndarray) -> np.ndarray:
    """The number of the first piece of each text; one more for the end."""
    return np.searchsorted(begin, w.first)


def run_table(docs: DataFrame, least: int, known: np.ndarray | None = None) -> DataFrame:
    """(k1, k2, place, last, h1, h2): every run, by the numbers of its pieces.

    With a filter, only the runs whose first hash it may hold.
    """

    def scan(batch: pa.RecordBatch) -> dict:
        texts = bytes_of(batch.column("text"))
        k1, k2 = (batch.column(k).to_numpy() for k in ("k1", "k2"))
        out: dict[str, list] = {c: [] for c in ("k1", "k2", "place", "last", "h1", "h2")}
        for low, high in blocks(texts):
            w = words(texts[low:high])
            first, last, begin, end = runs(w, least)
            hashes = [span_hashes(w.hash, begin[first], end[last], which) for which in (0, 1)]
            if known is not None:
                may = found(known, hashes[0])
                first, last, hashes = first[may], last[may], [h[may] for h in hashes]
            if not len(first):
                continue
            doc = w.of[begin[first]]
            base = _pieces_of(w, begin)[doc]
            out["k1"].append(k1[low + doc])
            out["k2"].append(k2[low + doc])
            out["place"].append((first - base).astype(np.int32))
            out["last"].append((last - base).astype(np.int32))
            for which in (0, 1):
                out[f"h{which + 1}"].append(hashes[which].view(np.int64))
        return {c: np.concatenate(v) if v else [] for c, v in out.items()}

    return map_batches(
        docs, scan, "k1 bigint, k2 bigint, place int, last int, h1 bigint, h2 bigint"
    )


def filter_bits(hashes: int) -> int:
    """How many bits a filter of so many hashes has: sixteen each, within bounds."""
    return min(MOST_BITS, max(LEAST_BITS, (16 * hashes).bit_length()))


def repeated(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """(k1, k2, spans): per text the runs that occurred before, as [first, last] pieces."""
    k1, k2 = row_key()
    keyed = docs.select("text", k1.alias("k1"), k2.alias("k2"))
    # Most runs occur once: only those whose hash may be there again are dealt out
    # with their places.  A filter that is too full lets more pass and changes no result.
    again = stored(
        run_table(keyed, least)
        .groupBy("h1")
        .agg(F.count(F.lit(1)).alias("times"))
        .where("times > 1")
        .select("h1")
    )
    every = run_table(keyed, least, bitmap(again, "h1", filter_bits(again.count())))
    # Combined in each task first: a run that fills a third of the input sends
    # one row per task.
    # Stored, so that the join below has a shuffle on either side and Spark can
    # split what a hot run makes of the left one.
    firsts = stored(
        every.groupBy("h1", "h2")
        .agg(
            F.count(F.lit(1)).alias("times"),
            F.min(F.struct("k1", "k2", "place")).alias("earliest"),
        )
        .where("times > 1")
        .drop("times")
    )
    return (
        every.join(firsts, ["h1", "h2"])
        .where(F.struct("k1", "k2", "place") != F.col("earliest"))
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("place", "last")).alias("spans"))
    )


def without_repeats(
    docs: DataFrame, least: int = WORDS, text: str = "text"
) -> tuple[DataFrame, list[str]]:
    """``docs`` with three columns more, and their names.

    They are the text that is left, the number of pieces, and the number of removed ones.
    """
    names = fresh(docs, "text_left", "n_pieces", "n_removed")
    k1, k2, spans = fresh(docs, "k1", "k2", "spans")
    one, two = row_key()
    again = repeated(docs, least)
    again = again.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("spans").alias(spans))
    joined = docs.withColumns({k1: one, k2: two}).join(again, [k1, k2], "left").drop(k1, k2)
    schema = ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
         f"`{names[0]}` string, `{names[1]}` bigint, `{names[2]}` bigint"]
    )

    def cut(batch: pa.RecordBatch) -> dict:
        column = batch.column(text)
        texts = bytes_of(column)
        all_spans = batch.column(spans).to_pylist()
        left, counts, removed = [], [], []
        for low, high in blocks(texts):
            w = words(texts[low:high])
            end = np.flatnonzero(piece_ends(w)) + 1
            begin = np.concatenate([[0], end[:-1]]).astype(np.int64)
            of_text = _pieces_of(w, begin)
            for i in range(high - low):
                count = int(of_text[i + 1] - of_text[i])
                counts.append(count)
                if not all_spans[low + i]:
                    left.append(texts[low + i])
                    removed.append(0)
                    continue
                gone = np.zeros(count + 1, np.int64)
                for span in all_spans[low + i]:
                    gone[span["place"]] += 1
                    gone[span["last"] + 1] -= 1
                gone = np.cumsum(gone)[:count] > 0
                # A piece reaches to the first word of the next one.
                edges = w.start[begin[of_text[i] : of_text[i + 1]]] - w.text[i]
                edges = [*edges.tolist(), len(texts[low + i])]
                own = texts[low + i]
                parts = [own[: edges[0]]]
                parts += [own[edges[j] : edges[j + 1]] for j in range(count) if not gone[j]]
                left.append(b"".join(parts).rstrip() if not gone.all() else b"")
                removed.append(int(gone.sum()))
        valid = column.is_valid().to_pylist()
        kept = [t.decode() if ok else None for t, ok in zip(left, valid, strict=True)]
        return {f.name: batch.column(f.name) for f in batch.schema if f.name != spans} | {
            names[0]: kept, names[1]: counts, names[2]: removed
        }

    return map_batches(joined, cut, schema), names


def stripped(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeats cut out of their texts; texts that were all repeats go.

    ``n_chars``, where there is one, is counted anew.
    """
    out, (left, total, removed) = without_repeats(docs)
    changed = {"text": F.col(left)}
    if "n_chars" in docs.columns:
        again = F.char_length(left).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col(removed) > 0, again).otherwise(F.col("n_chars"))
    keep = (F.col(removed) == 0) | (F.col(removed) < F.col(total))
    return out.where(keep).select(
        *(changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns)
    )
