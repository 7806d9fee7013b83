"""Benchmark passages inside documents, up to a share of edits: q-gram lemma filtering and banded alignment.

An occurrence of an item of m characters with at most k edits shares at least m - q + 1 - k * q of its q-grams,
and their diagonals (place in the document less place in the item) differ by at most k. Diagonals are cut into
bands of 2 (k + 1) that overlap by half, so one band holds them all; a band with enough shared q-grams is aligned
in full, the others cannot hold an occurrence.

Texts that repeat an item's q-grams, such as rules of dashes, share a number of them that grows as text times item. So shared
q-grams are counted in pieces of fixed size, and for pairs that share very many, bands are counted by asking for each
place of the item whether its q-gram lies within the band, and neighbouring bands are aligned together.

Items go out in blocks of at most ``BLOCK_CHARS`` characters, one scan of the documents per block: what is sent
to the executors has that bound however many items there are.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.tables import released, slices

Q, EDIT_SHARE = 8, 0.1
#: Normalised characters of the items of one block; their index takes 16 bytes a character.
BLOCK_CHARS = 4_000_000
SLICE, FILTER_BITS = 500_000, 22
#: Shared q-grams worked on at once; the number of them from which a text and an item count as repeating; and
#: diagonals of a repeating pair aligned at once. They bound the memory of a task, not the results.
PIECE, DENSE, MERGED = 1_000_000, 20_000, 8_192
_POWER, _SPREAD = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


def normalized(text: str | None) -> str:
    """Lower case, runs of white space as one space; zero characters are kept out as they part documents."""
    return " ".join((text or "").replace("\0", " ").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of all runs of Q = 8 characters, by doubling."""
    h, span = codes.astype(np.uint64), 1
    while span < Q:
        if len(h) <= span:
            return np.zeros(0, np.uint64)
        h = h[:-span] * np.uint64(pow(_POWER, span, 1 << 64)) + h[span:]
        span *= 2
    return h * _SPREAD


def edit_budget(size: int) -> int:
    """The edits allowed in an item of ``size`` characters: a share of it, and few enough for the lemma to bind."""
    return max(0, min(int(size * EDIT_SHARE), (size - Q) // Q))


@dataclass(frozen=True)
class Block:
    ids: list
    codes: list[np.ndarray]
    grams: np.ndarray  # sorted distinct hashes
    first: np.ndarray  # where each one's places begin
    items: np.ndarray
    places: np.ndarray
    present: np.ndarray  # by the leading bits of a hash
    short: dict[int, dict[str, list[int]]]  # items without a q-gram: length, text, numbers

    @staticmethod
    def of(ids: list, texts: list[str]) -> Block:
        codes = [_codes(t) for t in texts]
        hashes = [gram_hashes(c) for c in codes]
        items = np.concatenate([np.full(len(h), i, np.int32) for i, h in enumerate(hashes)])
        places = np.concatenate([np.arange(len(h), dtype=np.int32) for h in hashes])
        every = np.concatenate(hashes)
        order = np.argsort(every, kind="stable")
        grams, first = np.unique(every[order], return_index=True)
        present = np.zeros(1 << FILTER_BITS, bool)
        present[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        short: dict[int, dict[str, list[int]]] = {}
        for i, text in enumerate(texts):
            if 0 < len(text) < Q:
                short.setdefault(len(text), {}).setdefault(text, []).append(i)
        return Block(ids, codes, grams, np.append(first, len(every)), items[order], places[order], present, short)

    def short_matches(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) of the items of fewer than Q characters, letter by letter, without overlaps of one item."""
        letters = _codes(text).astype(np.uint64)
        for size, items in self.short.items():
            if len(text) < size:
                continue
            powers = np.array([pow(_POWER, k, 1 << 64) for k in range(size)], np.uint64)
            hashes = sum(letters[k : len(text) - size + 1 + k] * powers[k] for k in range(size))
            wanted = [np.sum(_codes(t).astype(np.uint64) * powers, dtype=np.uint64) for t in items]
            free: dict[int, int] = {}
            for start in np.flatnonzero(np.isin(hashes, np.array(wanted, np.uint64))).tolist():
                for item in items.get(text[start : start + size], ()):
                    if start >= free.get(item, 0):
                        free[item] = start + size
                        yield item, start, start + size

    def _expanded(self, found: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number, entry) for every place of an item that has the q-gram ``found[number]``, some ``PIECE`` at a time and
        those of one number together."""
        times = self.first[found + 1] - self.first[found]
        total = np.cumsum(times)
        start = 0
        while start < len(found):
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + PIECE, side="right")))
            own, ends = times[start:stop], total[start:stop] - before
            entry = np.arange(ends[-1]) - np.repeat(ends - own, own) + np.repeat(self.first[found[start:stop]], own)
            yield np.repeat(np.arange(start, stop), own), entry
            start = stop

    def regions(self, codes: np.ndarray, bounds: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
        """(text, item, first diagonal) of the bands that meet the bound, and the pairs (text, item) that share q-grams so
        often that their bands have to be counted otherwise; ``bounds`` are the texts' first places."""
        hashes = gram_hashes(codes)
        at = np.flatnonzero(self.present[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.grams, hashes[at]), len(self.grams) - 1)
        same = self.grams[found] == hashes[at]
        at, found = at[same], found[same]
        if not len(at):
            return [], []
        sizes = np.array([len(c) for c in self.codes])
        budgets = np.array([edit_budget(s) for s in sizes])
        needs = np.maximum(sizes - Q + 1 - budgets * Q, 1)
        text = np.searchsorted(bounds, at, side="right") - 1
        kinds, kind, times = np.unique(text * len(self.grams) + found, return_inverse=True, return_counts=True)
        text_of, gram_of = kinds // len(self.grams), kinds % len(self.grams)

        def slot(text: np.ndarray, entry: np.ndarray) -> np.ndarray:
            return (text * len(sizes) + self.items[entry]) & ((1 << FILTER_BITS) - 1)

        # Fewer q-grams of an item in all of a text than one band needs: most hits go here, counted by a hash, from how
        # often a text has each q-gram.
        counts = np.zeros(1 << FILTER_BITS)
        for number, entry in self._expanded(gram_of):
            np.add.at(counts, slot(text_of[number], entry), times[number])
        useful, dense = np.zeros(len(kinds), bool), set()
        for number, entry in self._expanded(gram_of):
            often = counts[slot(text_of[number], entry)]
            many = often > DENSE
            dense.update(np.unique(text_of[number[many]] * len(sizes) + self.items[entry[many]]).tolist())
            useful[number[~many & (often >= needs[self.items[entry]])]] = True
        at, found, text = at[useful[kind]], found[useful[kind]], text[useful[kind]]
        bands, kept, size = [], [], 0
        for number, entry in self._expanded(found):
            often = counts[slot(text[number], entry)]
            enough = (often <= DENSE) & (often >= needs[self.items[entry]])
            kept.append((number[enough], entry[enough]))
            size += len(kept[-1][0])
            if size >= PIECE:  # the bands of whole texts can be counted at once
                number, entry = (np.concatenate(x) for x in zip(*kept, strict=True))
                last = int(np.searchsorted(text[number], text[number[-1]]))
                bands += self._bands(text[number[:last]], at[number[:last]], entry[:last], bounds, sizes, budgets, needs)
                kept, size = [(number[last:], entry[last:])], 0
        if kept:
            number, entry = (np.concatenate(x) for x in zip(*kept, strict=True))
            bands += self._bands(text[number], at[number], entry, bounds, sizes, budgets, needs)
        return bands, [(pair // len(sizes), pair % len(sizes)) for pair in sorted(dense)]

    def _bands(self, text, at, entry, bounds, sizes, budgets, needs) -> list[tuple[int, int, int]]:
        if not len(at):
            return []
        item = self.items[entry]
        # An item may begin before its text does, by as many places as it may lose characters.
        diagonal = at - bounds[text] - self.places[entry] + sizes[item]
        band = diagonal // (budgets[item] + 1)
        top = int(band.max()) + 2
        keys = (text.astype(np.int64) * len(sizes) + item) * top
        # A band reaches over two steps, so a q-gram counts for its own step and the one before.
        # A place of an item counts once in a band, however often the text repeats its q-gram.
        widest = int(sizes.max())
        marks = np.concatenate((keys + band, keys + np.maximum(band - 1, 0))) * widest + np.tile(self.places[entry], 2)
        found_keys, counts = np.unique(np.unique(marks) // widest, return_counts=True)
        item = found_keys // top % len(sizes)
        enough = counts >= needs[item]
        found_keys, item = found_keys[enough], item[enough]
        start = found_keys % top * (budgets[item] + 1) - sizes[item]
        return list(zip((found_keys // top // len(sizes)).tolist(), item.tolist(), start.tolist(), strict=True))


def dense_bands(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The first diagonals of the bands of an item that meet the bound, for texts that repeat its q-grams very often.

    For each place of the item and each band it is only asked whether the text has that q-gram at any of the places
    that the band allows, by its sorted places; so the work is bands times the item's places, a piece at a time.
    """
    budget = edit_budget(len(item))
    need, step = max(len(item) - Q + 1 - budget * Q, 1), budget + 1
    own, every = gram_hashes(item), gram_hashes(text)
    names, name = np.unique(own, return_inverse=True)
    at = np.minimum(np.searchsorted(names, every), len(names) - 1)
    (places,) = np.nonzero(names[at] == every)
    span = len(text) + len(item) + 3 * step  # more than any place
    known = np.sort(at[places].astype(np.int64) * span + places)
    number = (len(text) + len(item)) // step + 1
    chunk = max(1, PIECE // len(own))
    found = []
    for first in range(0, number, chunk):
        starts = np.arange(first, min(first + chunk, number)) * step - len(item)
        low = starts[:, None] + np.arange(len(own))
        base = name.astype(np.int64) * span
        ends = [np.searchsorted(known, base + np.clip(low + far, 0, span - 1)) for far in (0, 2 * step)]
        found.append(starts[(ends[1] > ends[0]).sum(axis=1) >= need])
    return np.concatenate(found)


def _last_row(item: np.ndarray, window: np.ndarray, base: int, first: np.ndarray, budget: int) -> np.ndarray | None:
    """The edits of the whole ``item`` against the pieces of ``window`` that end at column ``base + len(item) + j``,
    over diagonals ``base + j``; ``first`` are the costs of starting there. None once all exceed ``budget``."""
    m, n, width = len(item), len(window), len(first)
    before, after = max(0, -base), max(0, base + m + width - n)
    # No letter equals the padding. Columns before the text start too dear and stay so; those after it only grow.
    padded = np.concatenate((np.full(before, 0xFFFFFFFF, np.uint32), window, np.full(after, 0xFFFFFFFF, np.uint32)))
    at = before + base
    column = np.arange(width)
    cost, above = first.astype(np.int64), np.full(width, len(item) + n + 2, np.int64)
    for i in range(m):
        above[:-1] = cost[1:]
        above[:-1] += 1
        cost += padded[at + i : at + i + width] != item[i]
        np.minimum(cost, above, out=cost)
        # Letters of the text alone: the cheapest entry to the left plus one for each column.
        cost -= column
        np.minimum.accumulate(cost, out=cost)
        cost += column
        if i % 16 == 15 and cost.min() > budget:
            return None
    cost[column + base + m > n] = m + n + 2
    cost[column + base + m < 0] = m + n + 2
    return cost if cost.min() <= budget else None


def align(item: np.ndarray, text: np.ndarray, start: int, budget: int) -> tuple[int, int, int] | None:
    """The best occurrence of the whole ``item`` that begins within a band: (edits, start, end) in ``text``, the
    first end among equals and then the longest piece, or None beyond ``budget`` edits. The band's diagonals are
    ``start`` to ``start + 2 * budget + 1``, and an occurrence may leave them by ``budget`` on either side."""
    m, base = len(item), start - budget
    low, high = max(0, base), min(len(text), start + 3 * budget + 2 + m)
    window = text[low:high]
    width, far = 4 * budget + 3, m + len(window) + 2
    columns = np.arange(width) + base - low
    last = _last_row(item, window, base - low, np.where((columns >= 0) & (columns <= len(window)), 0, far), budget)
    if last is None:
        return None
    end = int(np.argmin(last)) + base + m
    return int(last.min()), _start_of(item, text, end, budget), end


def dense_hits(item: np.ndarray, text: np.ndarray) -> list[tuple[int, int, int]]:
    """(edits, start, end) of occurrences in all bands of one item that meet the bound, none overlapping another, the
    best first and the leftmost among equals. Neighbouring bands are aligned together, ``MERGED`` diagonals at a time."""
    m, budget = len(item), edit_budget(len(item))
    starts = dense_bands(item, text)
    if not len(starts):
        return []
    cost = np.full(len(text) + 1, budget + 1, np.int64)  # the least edits of a piece that ends at a place
    breaks = np.flatnonzero(np.diff(starts) > budget + 1)
    for low, high in zip(starts[np.append(0, breaks + 1)], starts[np.append(breaks, len(starts) - 1)] + 2 * (budget + 1), strict=True):
        for start in range(int(low), int(high), MERGED):
            base, stop = start - budget, min(start + MERGED, int(high)) + budget
            left, right = max(0, base), min(len(text), stop + m)
            window, width = text[left:right], stop - base
            columns = np.arange(width) + base - left
            first = np.where((columns >= 0) & (columns <= len(window)), 0, m + len(window) + 2)
            last = _last_row(item, window, base - left, first, budget)
            if last is not None:
                ends = np.arange(width) + base + m
                real = (ends >= 0) & (ends <= len(text))
                np.minimum.at(cost, ends[real], last[real])
    taken: list[tuple[int, int, int]] = []  # (start, end, edits), in order
    for edits in range(budget + 1):
        blocked = np.zeros(len(text) + 1, bool)
        for start, end, _ in taken:  # a piece with so few edits that ends here must overlap
            blocked[start + 1 : end + m - edits] = True
        free = np.flatnonzero((cost == edits) & ~blocked)
        k = 0
        while k < len(free):
            end = int(free[k])
            start = end - m if edits == 0 else _start_of(item, text, end, budget)
            at = bisect_left(taken, (start, end, -1))
            clear = (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= end)
            if clear:
                taken.insert(at, (start, end, edits))
            k = max(k + 1, int(np.searchsorted(free, end + m - edits))) if clear else k + 1
    return sorted((edits, start, end) for start, end, edits in taken)


def _start_of(item: np.ndarray, text: np.ndarray, end: int, budget: int) -> int:
    """Where the longest of the best pieces that end at ``end`` begins."""
    m = len(item)
    piece = text[max(0, end - m - budget) : end][::-1]
    first = np.full(2 * budget + 1, m + len(piece) + 2)
    first[budget:] = np.arange(budget + 1)
    back = _last_row(item[::-1], piece, -budget, first, budget)
    return end - (int(np.flatnonzero(back == back.min())[-1]) - budget + m)


def _matches(block: Block, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of the occurrences in normalised ``texts``; of overlapping occurrences of
    one item only the best, the leftmost among equals, is reported."""
    sizes = [len(t) for t in texts]
    joined = _codes("\0".join(texts))
    bounds = np.concatenate(([0], np.cumsum(np.array(sizes) + 1)))[: len(texts)]
    found: dict[tuple[int, int], set] = {}
    bands, dense = block.regions(joined, bounds)
    for text, item, start in bands:
        letters = joined[bounds[text] : bounds[text] + sizes[text]]
        hit = align(block.codes[item], letters, start, edit_budget(len(block.codes[item])))
        if hit:
            found.setdefault((text, item), set()).add(hit)
    for text, item in dense:
        for edits, start, end in dense_hits(block.codes[item], joined[bounds[text] : bounds[text] + sizes[text]]):
            yield text, item, start, end, edits
    for (text, item), hits in found.items():
        taken: list[tuple[int, int]] = []
        for edits, start, end in sorted(hits):
            if all(end <= a or start >= b for a, b in taken):
                taken.append((start, end))
                yield text, item, start, end, edits
    if block.short:
        for number, text in enumerate(texts):
            for item, start, end in block.short_matches(text):
                yield number, item, start, end, 0


def _blocks(benchmark: DataFrame) -> Iterator[Block]:
    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        text = normalized(row["text"])
        if not text:
            continue
        ids.append(row["item_id"])
        texts.append(text)
        size += len(text)
        if size >= BLOCK_CHARS:
            yield Block.of(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Block.of(ids, texts)


SCHEMA = "doc_id long, item_id long, start long, end long, edits long"


def benchmark_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per occurrence of a benchmark item in a document: ``doc_id``, ``item_id``, ``start`` and ``end`` in
    the normalised document, and ``edits``, at most a tenth of the item's characters.

    Null and empty texts and documents shorter than an item have none; items of fewer than 8 normalised characters
    have no q-gram and are searched letter by letter, without edits. Repeated rows give repeated hits; empty tables give none. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    narrow = docs.select("doc_id", "text")
    results = []
    for block in _blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch in slices(batches, "text", SLICE):
                ids = batch.column("doc_id").to_pylist()
                texts = [normalized(t) for t in batch.column("text").to_pylist()]
                rows = [(ids[t], block.ids[i], s, e, k) for t, i, s, e, k in _matches(block, texts)]
                columns = list(zip(*rows, strict=True)) if rows else [()] * 5
                names = ["doc_id", "item_id", "start", "end", "edits"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        results.append(narrow.mapInArrow(lambda batches, run=run: released(run(batches)), SCHEMA))
    return reduce(DataFrame.unionByName, results) if results else spark.createDataFrame([], SCHEMA)


def without_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without any occurrence of a benchmark item, each judged by its own text, with or without an id."""
    for block in _blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch in slices(batches, "text", SLICE):
                texts = [normalized(t) for t in batch.column("text").to_pylist()]
                hit = {match[0] for match in _matches(block, texts)}
                yield batch.filter(pa.array([t not in hit for t in range(len(texts))], pa.bool_()))

        docs = docs.mapInArrow(lambda batches, run=run: released(run(batches)), docs.schema)
    return docs
