"""Token counts that follow edits: pre-token segment trees.

A byte-level BPE encodes each pre-token by itself, so a text has as many tokens
as its pre-tokens have together.  A tree per edited text holds them: its leaves
are runs of pre-tokens, every node the characters and tokens below it.  An edit
finds its place by the sums, cuts pre-tokens anew from a little before it until
the new cuts meet the old ones again, counts only those, and updates the sums on
the way to the root.

How far an edit reaches: the pattern looks at most two characters beyond a
pre-token's end, so those that end more than two characters before the edit
stay; and where a new cut meets an old one behind the edit, all that follows is
cut alike.

The query counts every text, then the same text with personal data and secrets
replaced, by way of the tree.  Null and empty texts have no tokens and no edits.
Repeated rows get equal results.  The vocabulary is read by the driver from a
path and sent to the tasks; its size does not depend on the data.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from scholarlake.llm.common import map_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: how this vocabulary's public tokenizer cuts pre-tokens.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
LOOKAHEAD = 2  # characters that PATTERN sees beyond a match
LEAF = 64  # pre-tokens
CACHE = 300_000  # pre-tokens whose counts a task remembers

# What the query replaces, and by what.  Long runs are read once: an address begins with
# its run, and nothing that was read is given back.
REDACTIONS = {
    "EMAIL": r"(?<![\w.+-])[\w.+-]++@[\w-]++(?:\.[\w-]++)++",
    "SECRET": r"(?:[Pp]assword|[Tt]oken|[Ss]ecret|[Aa][Pp][Ii][_-]?[Kk]ey)\s*[=:]\s*\S+",
    "IP": r"\b\d{1,3}(?:\.\d{1,3}){3}\b",
    "PHONE": r"\+\d[\d ()-]{6,}\d",
    "NUMBER": r"\b\d{9,}\b",
}

# Every text that one of these patterns matches has one of these characters: \d is
# any script's digit, as it is there.
HINTS = re.compile(r"[\d@=:]")

Edit = tuple[int, int, str]  # characters from, to, and what replaces them


class Counter(dict):
    """Tokens of a pre-token, remembered."""

    def __init__(self, vocabulary: bytes):
        ranks = {
            base64.b64decode(token): int(rank)
            for token, rank in map(bytes.split, vocabulary.splitlines())
        }
        self.encoding = tiktoken.Encoding(
            "byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.cut = regex.compile(PATTERN).findall

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[piece] = n = len(self.encoding.encode_ordinary(piece))
        return n

    def total(self, pieces: Iterable[str]) -> int:
        return sum(map(self.__getitem__, pieces))


class CountTree:
    """The pre-tokens of a text, with sums of characters and tokens."""

    def __init__(self, pieces: list[str], counter: Counter):
        self.counter = counter
        self.reencoded = 0  # pre-tokens that edits have counted anew
        self._build(pieces)

    def _build(self, pieces: list[str]) -> None:
        self.leaves = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars = [0] * (2 * self.size)
        self.tokens = [0] * (2 * self.size)
        for i, leaf in enumerate(self.leaves):
            self._measure(i, leaf)
        for i in range(self.size - 1, 0, -1):
            self._add_up(i)

    def _measure(self, i: int, leaf: list[str]) -> None:
        self.chars[self.size + i] = sum(map(len, leaf))
        self.tokens[self.size + i] = self.counter.total(leaf)

    def _add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(map("".join, self.leaves))

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf of a character, and how many characters come before that leaf."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if place - before >= self.chars[node] and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        return node - self.size, before

    def _following(self, leaf: int, skip: int) -> Iterator[tuple[int, str]]:
        for i in range(leaf, len(self.leaves)):
            for piece in self.leaves[i][skip if i == leaf else 0 :]:
                yield i, piece

    def edit(self, begin: int, end: int, replacement: str) -> None:
        """Replace characters [begin, end) of the text as it is now."""
        first_leaf, at = self._find(max(0, begin - LOOKAHEAD))
        skip = 0
        for piece in self.leaves[first_leaf]:
            if at + len(piece) + LOOKAHEAD > begin:
                break
            at += len(piece)
            skip += 1

        # Old pre-tokens from there on, more of them until the cuts meet.
        old: list[tuple[int, str]] = []
        cuts = {0}  # where old ones begin, from `at` on
        reach, wanted = 0, end - at + 16
        source = self._following(first_leaf, skip)
        grown = len(replacement) - (end - begin)
        while True:
            complete = True
            for found in source:
                old.append(found)
                reach += len(found[1])
                cuts.add(reach)
                if reach >= wanted:
                    complete = False
                    break
            before = "".join(piece for _, piece in old)
            after = before[: begin - at] + replacement + before[end - at :]
            new, upto = [], 0
            meets = None
            for piece in self.counter.cut(after):
                # What is near the end of this stretch may be cut otherwise in the text.
                if not complete and upto + len(piece) + LOOKAHEAD > len(after):
                    break
                new.append(piece)
                upto += len(piece)
                if upto - grown >= end - at and upto - grown in cuts:
                    meets = upto - grown
                    break
            if meets is None and complete:
                meets = reach
            if meets is not None:
                break
            wanted = 2 * reach + 16

        gone = passed = 0
        while passed < meets:
            passed += len(old[gone][1])
            gone += 1
        self._splice(first_leaf, skip, old[:gone], new)

    def _splice(self, leaf: int, skip: int, old: list[tuple[int, str]], new: list[str]) -> None:
        self.reencoded += len(new)
        last = old[-1][0] if old else leaf
        gone = [0] * (last - leaf + 1)
        for i, _ in old:
            gone[i - leaf] += 1
        for i in range(leaf, last + 1):
            start = skip if i == leaf else 0
            self.leaves[i][start : start + gone[i - leaf]] = new if i == leaf else []
            self._measure(i, self.leaves[i])
        if len(self.leaves[leaf]) > 4 * LEAF:
            self._build([piece for own in self.leaves for piece in own])
            return
        low, high = (self.size + leaf) // 2, (self.size + last) // 2
        while low:
            for node in range(low, high + 1):
                self._add_up(node)
            low, high = low // 2, high // 2


def redactions() -> re.Pattern:
    return re.compile("|".join(f"(?P<{name}>{p})" for name, p in REDACTIONS.items()))


def edits_of(text: str, pattern: re.Pattern) -> list[Edit]:
    if not HINTS.search(text):
        return []
    return [(m.start(), m.end(), f"<{m.lastgroup}>") for m in pattern.finditer(text)]


def counted(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_tokens, n_edits, n_tokens_after, n_reencoded."""
    with open(vocabulary, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())
    kept: list = []  # per worker process

    def count(batch: pa.RecordBatch) -> dict:
        if not kept:
            kept.extend((Counter(shipped.value), redactions()))
        counter, pattern = kept
        out: dict[str, list[int]] = {
            c: [] for c in ("n_tokens", "n_edits", "n_tokens_after", "n_reencoded")
        }
        for text in batch.column("text").to_pylist():
            pieces = counter.cut(text or "")
            edits = edits_of(text or "", pattern)
            before = counter.total(pieces)
            after, again = before, 0
            if edits:
                tree = CountTree(pieces, counter)
                # From the last to the first: earlier places stay as they were.
                for edit in reversed(edits):
                    tree.edit(*edit)
                after, again = tree.total, tree.reencoded
            for name, n in zip(out, (before, len(edits), after, again), strict=True):
                out[name].append(n)
        return {"doc_id": batch.column("doc_id"), **out}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        docs.select("doc_id", "text"),
        count,
        f"doc_id {kind}, n_tokens bigint, n_edits bigint, n_tokens_after bigint,"
        " n_reencoded bigint",
    )
