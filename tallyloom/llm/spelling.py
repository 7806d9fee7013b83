"""Grouping spelling variants: words one edit apart, found by k-d trees over their letter counts.

One inserted or deleted letter changes one letter count by one, a replaced one two counts, so words one edit apart
lie within L1 distance two. Counts are held in 32 letter classes up to two, in unary: a word is 64 bits, and the L1
distance of two words, or of a word and a tree node's box, is a number of differing bits. Neither classes
nor the limit of two can raise a distance, so no pair is lost; the letters' order is then verified.

A tree over a sample deals the words out to groups. A word lies in one group, and is searched for in every group
whose box its ball of radius two touches, among words of its own length and of the next one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.staging import stage
from tallyloom.llm.components import roots
from tallyloom.llm.grouped import HELD, PASSING, by_group

SHORTEST, LEAST = 7, 2
#: A word in DELETE_EVERY of a document loses a letter; a form occurs at least TIMES as often as its variant.
DELETE_EVERY, TIMES = 31, 10
#: Words counted before a task sends them, words of a group and of a tree leaf, the sample of the dealing tree (bounds
#: of memory that change no result), and the radius.
COUNTED, GROUP_WORDS, LEAF_WORDS, SAMPLE, RADIUS = 300_000, 50_000, 16, 100_000, 2
#: Pairs that a task holds before it sends what they say of each word.
PAIRS = 1_000_000
_PIECE = 1 << 20
_LATIN = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % SHORTEST)
_EDGE = re.compile(r"[^A-Za-zÀ-ÿ]")


def _pieces(text: str) -> Iterator[str]:
    """A text cut into pieces of about ``_PIECE`` code points, never inside a word."""
    at = 0
    while at < len(text):
        edge = _EDGE.search(text, at + _PIECE)
        end = edge.start() if edge else len(text)
        yield text[at:end]
        at = end


def document_words(doc_id: int | None, text: str) -> Iterator[bytes]:
    """The words of a document, in Latin-1: runs of A-Z and U+00C0 to U+00FF, A-Z lower-cased, of which a
    fixed share, by the checksum of id and word, lack one letter."""
    seed = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    for piece in _pieces(text):
        for word in _RUN.findall(piece.encode("latin-1", "replace").translate(_LATIN)):
            known = word if word.isascii() else word.decode("latin-1").encode()
            checksum = zlib.crc32(known, seed)
            if checksum % DELETE_EVERY:
                yield word
            elif len(word) > SHORTEST:
                at = checksum % len(word)
                yield word[:at] + word[at + 1 :]


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of ``SHORTEST`` or more letters in all documents."""

    def run(batches):
        counts: dict[bytes, int] = {}

        def sent():
            words = pa.array([w.decode("latin-1") for w in counts], pa.string())
            yield pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                for word in document_words(doc, text.as_py() or ""):
                    counts[word] = counts.get(word, 0) + 1
                if len(counts) >= COUNTED:
                    yield from sent()
        yield from sent()

    partial = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


class Words:
    """Words as letter codes (0 to 25 and, for U+00C0 to U+00FF, 26 to 89), lengths, and 64-bit counts."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        solid = data != 0xC3  # the first of the two bytes of a letter beyond z
        places = np.concatenate(([0], np.cumsum(solid)))
        self.starts = places[offsets - offsets[0]]
        self.lengths = np.diff(self.starts)
        self.letters = np.where(data >= 0x80, data - (0x80 - 26), data - ord("a"))[solid]
        classes = np.where(self.letters < 26, self.letters, 26 + self.letters % 6).astype(np.int64)
        owner = np.repeat(np.arange(len(self.lengths)), self.lengths)
        counts = np.bincount(owner * 32 + classes, minlength=len(self.lengths) * 32).reshape(-1, 32)
        unary = np.concatenate((counts >= 1, counts >= 2), axis=1)
        self.codes = np.packbits(unary, axis=1, bitorder="little").view("<u8").ravel()

    def matrix(self, at: np.ndarray, length: int) -> np.ndarray:
        """The letters of words of one length."""
        return self.letters[self.starts[at][:, None] + np.arange(length)]


class Tree:
    """A k-d tree over unary counts, and optionally lengths. Each node has a box: bits that are fixed, their values, and
    lengths. ``tight`` boxes are those of the words in it, else the splits alone make them, so that any word has a leaf."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray | None, leaf: int, tight: bool):
        self.fixed, self.value, self.shortest, self.longest, self.kids, self.leaves = [], [], [], [], [], []
        self._grow(codes, lengths, np.arange(len(codes)), (0, 0, 0, 1 << 60), leaf, tight)

    def _grow(self, codes, lengths, rows, box, leaf, tight) -> None:
        waiting = [(rows, box, None)]
        while waiting:
            rows, (fixed, value, shortest, longest), parent = waiting.pop()
            node, own = len(self.kids), codes[rows]
            if parent is not None:
                self.kids[parent].append(node)
            parts = None
            if len(rows) > leaf:
                sizes = lengths[rows] if lengths is not None else None
                if sizes is not None and sizes.min() < sizes.max():
                    cut = min(int(np.median(sizes)), int(sizes.max()) - 1)
                    low = sizes <= cut
                    parts = [(rows[low], (fixed, value, shortest, cut)), (rows[~low], (fixed, value, cut + 1, longest))]
                else:
                    ones = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
                    bit = int(np.argmin(np.abs(2 * ones - len(rows))))
                    if 0 < ones[bit] < len(rows):
                        mark = 1 << bit
                        has = (own & np.uint64(mark)) != 0
                        parts = [
                            (rows[~has], (fixed | mark, value, shortest, longest)),
                            (rows[has], (fixed | mark, value | mark, shortest, longest)),
                        ]
            if tight and len(rows):
                every, some = int(np.bitwise_and.reduce(own)), int(np.bitwise_or.reduce(own))
                fixed, value = ~(every ^ some) & (2**64 - 1), every
            self.fixed.append(np.uint64(fixed))
            self.value.append(np.uint64(value))
            self.shortest.append(shortest)
            self.longest.append(longest)
            self.kids.append([])
            self.leaves.append(None if parts else rows)
            waiting += [(part, box, node) for part, box in parts or ()]

    def visit(self, codes: np.ndarray, radius: int, low: np.ndarray | None = None, high: np.ndarray | None = None):
        """(leaf, numbers of the words whose ball meets its box); lengths from ``low`` to ``high``, if given, must too."""
        waiting = [(0, np.arange(len(codes)))]
        while waiting:
            node, at = waiting.pop()
            near = np.bitwise_count((codes[at] ^ self.value[node]) & self.fixed[node]) <= radius
            if low is not None:
                near &= (low[at] <= self.longest[node]) & (high[at] >= self.shortest[node])
            at = at[near]
            if len(at):
                if self.kids[node]:
                    waiting += [(kid, at) for kid in self.kids[node]]
                else:
                    yield node, at


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.count_nonzero(a != b, axis=1) == 1


def _one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether the longer word is the shorter one with a letter more: equal before some place, and shifted after it."""
    length = short.shape[1]
    same, shifted = short == long[:, :-1], short == long[:, 1:]
    before = np.where(same.all(axis=1), length, np.argmin(same, axis=1))
    after = np.where(shifted.all(axis=1), 0, length - np.argmin(shifted[:, ::-1], axis=1))
    return before >= after


class Group:
    """The words of a group with their n, as a k-d tree for each length."""

    def __init__(self, rows: pa.Table):
        self.words, self.text, self.n = Words(rows.column("word")), rows.column("word").combine_chunks(), rows.column("n").to_numpy()
        self.trees = {}
        for length in np.unique(self.words.lengths).tolist():
            (at,) = np.nonzero(self.words.lengths == length)
            self.trees[length] = at, Tree(self.words.codes[at], None, LEAF_WORDS, True)

    def near(self, asked: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (number asked, number held) exactly one edit apart, held words being as long or one letter longer."""
        for length in np.unique(asked.lengths).tolist():
            (own,) = np.nonzero(asked.lengths == length)
            for other, verified in ((length, _one_replaced), (length + 1, _one_inserted)):
                if other not in self.trees:
                    continue
                held, tree = self.trees[other]
                for leaf, at in tree.visit(asked.codes[own], RADIUS):
                    rows = held[tree.leaves[leaf]]
                    for start in range(0, len(at), 50_000):
                        part = own[at[start : start + 50_000]]
                        for first in range(0, len(rows), 64):  # many words may have the same counts
                            some = rows[first : first + 64]
                            close = np.bitwise_count(asked.codes[part][:, None] ^ self.words.codes[some]) <= RADIUS
                            x, y = np.nonzero(close)
                            if len(x):
                                a, b = part[x], some[y]
                                right = verified(asked.matrix(a, length), self.words.matrix(b, other))
                                yield a[right], b[right]


def _best(owner: np.ndarray, other: np.ndarray, n: np.ndarray, text: pa.Array, of: pa.Array) -> pa.RecordBatch:
    """Per owner of pairs: its word, how many pairs it has, and the n and word of its best partner."""
    names = pa.compute.rank(text.take(pa.array(other)), sort_keys="ascending", tiebreaker="dense").to_numpy()
    order = np.lexsort((names, -n[other], owner))
    first = np.flatnonzero(np.diff(owner[order], prepend=-1))
    chosen = order[first]
    counts = np.diff(np.append(first, len(order)))
    columns = [of.take(pa.array(owner[chosen])), counts, n[other[chosen]], text.take(pa.array(other[chosen]))]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c.astype(np.int64)) for c in columns], _PARTIAL)


_PARTIAL = ["word", "n_near", "best_n", "best"]


def _search(held: pa.Table):
    group = Group(held)

    def answer(asked: pa.Table):
        text, n = asked.column("word").combine_chunks(), asked.column("n").to_numpy()
        words = Words(text)

        def partial(found: list[tuple[np.ndarray, np.ndarray]]):
            a, b = (np.concatenate(side) for side in zip(*found, strict=True))
            if len(a):
                yield _best(a, b, group.n, group.text, text)
                longer = words.lengths[a] < group.words.lengths[b]  # pairs of equal length are found from both sides
                if longer.any():
                    yield _best(b[longer], a[longer], n, text, group.text)

        found, size = [], 0
        for pair in group.near(words):
            found.append(pair)
            size += len(pair[0])
            if size >= PAIRS:
                yield from partial(found)
                found, size = [], 0
        if found:
            yield from partial(found)

    return answer


def _dealt(words: DataFrame) -> tuple[DataFrame, int]:
    """Words once for the group they lie in and once for each group they are searched for in; and the groups' number."""
    total = words.count()
    share = F.lit(min(1.0, SAMPLE / max(total, 1)))
    hashed = F.pmod(F.xxhash64("word", F.lit(1)), F.lit(1 << 30)) < share * (1 << 30)
    sample = Words(words.where(hashed).select("word").limit(2 * SAMPLE).toArrow().column("word"))  # at most 2 * SAMPLE words
    per_leaf = max(1, int(GROUP_WORDS * min(1.0, SAMPLE / max(total, 1))))
    tree = Tree(sample.codes, sample.lengths, per_leaf, False)
    # A leaf that no split makes small enough is dealt out in parts; words searched for in it go to each part.
    parts = np.array([0 if rows is None else max(1, -(-len(rows) // per_leaf)) for rows in tree.leaves])
    firsts = np.cumsum(parts) - parts
    shared = words.sparkSession.sparkContext.broadcast((tree, firsts, parts))

    def run(batches):
        known, first, number = shared.value
        for batch in batches:
            column = batch.column("word")
            own = Words(column)
            spread = batch.column("part").to_numpy()
            for kind in (HELD, PASSING):
                reach = (own.lengths, own.lengths + (kind == PASSING))
                for leaf, at in known.visit(own.codes, RADIUS if kind == PASSING else 0, *reach):
                    for k in range(number[leaf]):
                        chosen = at if kind == PASSING else at[spread[at] % number[leaf] == k]
                        some = batch.take(pa.array(chosen))
                        columns = [np.full(len(chosen), first[leaf] + k, np.int32), np.full(len(chosen), kind, np.int32)]
                        yield pa.RecordBatch.from_arrays(
                            [*map(pa.array, columns), some.column("word"), some.column("n")], ["group", "kind", "word", "n"]
                        )

    marked = words.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(1 << 30)))
    return marked.mapInArrow(run, "group int, kind int, word string, n long"), int(parts.sum())


def near_words(words: DataFrame) -> DataFrame:
    """For each of ``words`` (word, n), distinct and stored, that has one: ``n_near``, the words exactly one edit apart,
    and the one of them with the largest n, ``best`` (ties: the smallest) with ``best_n``."""
    rows, groups = _dealt(words)
    found = by_group(rows, groups, _search, "word string, n_near long, best_n long, best string", most=50_000)
    best = F.min(F.struct(-F.col("best_n"), F.col("best"))).alias("top")
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return merged.select("word", "n_near", (-F.col("top.col1")).alias("best_n"), F.col("top.best").alias("best"))


def group_variants(docs: DataFrame) -> DataFrame:
    """One row per word of at least ``SHORTEST`` code points that occurs at least twice in all documents: ``word``,
    ``form`` (its near word of largest n, if that is TIMES its own or more; else null), ``root`` (where following forms
    ends), ``n``, ``n_near`` and ``form_n``.

    Null and empty texts have no words. A row without an id has an empty one; repeated rows count as often as they
    occur. Words of any length and any number are compared; other columns are ignored.
    """
    words = stage(count_words(docs).where(F.col("n") >= LEAST), "words")
    near = near_words(words)
    formed = F.col("best_n") >= TIMES * F.col("n")
    joined = stage(
        words.join(near, "word", "left").select(
            "word",
            F.when(formed, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(joined.where("form is not null").select(F.col("word").alias("node"), F.col("form").alias("parent")))
    root = ends.select(F.col("node").alias("word"), F.col("parent").alias("root"))
    return joined.join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
