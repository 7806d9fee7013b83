"""Byte-pair encoding and decoding with the vocabulary of a public byte-level tokenizer.

Merging keeps the symbols of a pre-token in a doubly linked list and the possible merges in a priority queue of
(rank, position); an entry whose symbols have changed since is stale and skipped. Texts are cut at white space
first and the merges of short chunks are remembered during a task, up to a fixed number of chunks.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallyloom.llm.tables import released, slices

#: The pre-token pattern of byte-level tokenizers, and Unicode's white space.
SPACE = "\t-\r\x20\x85\xa0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
CACHE_CHUNKS, CACHE_CHARS, SLICE = 400_000, 40, 1_000_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next free from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


class ByteBpe:
    """Encodes as the ``tokenizers`` library does without added special tokens; built once per worker."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.first = [ids[letter] for letter in letters]
        none: dict[int, int] = {}
        self.followers, self.made_by = [none] * (max(ids.values()) + 1), []
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            if self.followers[ids[a]] is none:
                self.followers[ids[a]] = {}
            self.followers[ids[a]][ids[b]] = rank
            self.made_by.append(ids[a + b])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: bytes(byte_of[c] for c in s) for s, i in ids.items()}
        self.strings |= {i: s.encode() for s, i in self.added.items()}
        # At one place the longest added token wins.
        names = sorted(self.added, key=len, reverse=True)
        self.split_added = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.chunks = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        self.pieces = regex.compile(PATTERN)
        self.known: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: str) -> list[int]:
        """The ids of one pre-token: always the lowest-ranked merge next, the leftmost among equal ranks."""
        first, followers, made_by = self.first, self.followers, self.made_by
        symbols = [first[b] for b in piece.encode()]
        size = len(symbols)
        queue, last = [], size - 1
        # An entry is rank * size + place: small integers compare fastest.
        for i in range(last):
            rank = followers[symbols[i]].get(symbols[i + 1])
            if rank is not None:
                queue.append(rank * size + i)
        if not queue:
            return symbols
        heapq.heapify(queue)
        before, after = list(range(-1, last)), list(range(1, size + 1))
        pop, push = heapq.heappop, heapq.heappush
        symbols.append(-1)
        while queue:
            rank, at = divmod(pop(queue), size)
            a, right = symbols[at], after[at]
            # Stale: the symbol was merged away (-1) or the pair at this place is another one by now.
            if a < 0 or followers[a].get(symbols[right]) != rank:
                continue
            symbols[at] = made = made_by[rank]
            symbols[right] = -1
            beyond = after[at] = after[right]
            if beyond < size:
                before[beyond] = at
                rank = followers[made].get(symbols[beyond])
                if rank is not None:
                    push(queue, rank * size + at)
            left = before[at]
            if left >= 0:
                rank = followers[symbols[left]].get(made)
                if rank is not None:
                    push(queue, rank * size + left)
        return [s for s in symbols if s >= 0]

    def _remember(self, key: str, ids: list[int]) -> tuple[int, ...]:
        kept = tuple(ids)
        if len(key) <= CACHE_CHARS:
            if len(self.known) >= CACHE_CHUNKS:
                self.known.clear()
            self.known[key] = kept
        return kept

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        found = self.known.get(chunk)
        if found is not None:
            return found
        if chunk.isalpha() or chunk[0] == " " and chunk[1:].isalpha():
            return self._remember(chunk, self.merge(chunk))
        pieces = self.pieces.findall(chunk)
        if len(pieces) == 1:
            return self._remember(chunk, self.merge(chunk))
        ids: list[int] = []
        for piece in pieces:
            found = self.known.get(piece)
            ids += self._remember(piece, self.merge(piece)) if found is None else found
        return self._remember(chunk, ids)

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for nth, part in enumerate(self.split_added.split(text) if self.split_added else [text]):
            if nth % 2:
                ids.append(self.added[part])
                continue
            chunks = self.chunks.findall(part)
            found = list(map(self.known.get, chunks))
            if None in found:
                found = [self._chunk(chunk) if known is None else known for known, chunk in zip(found, chunks, strict=True)]
            ids += chain.from_iterable(found)
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def coder_of(vocabulary: str) -> ByteBpe:
    """One encoder per Python worker; Spark keeps the worker for later tasks, also other ones."""
    return ByteBpe(vocabulary)


SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """Per row: ``doc_id``, the number of tokens, and SHA-256 digests of the decimal ids joined by commas and of
    the decoded text; ``with_ids`` adds ``ids`` (array of int) and ``decoded``. A null text is an empty one.

    ``vocabulary`` is a path that every executor can open.
    """
    extra = ", ids array<int>, decoded string" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(vocabulary)
        numerals = [str(i) for i in range(max(coder.strings) + 1)]
        for batch in slices(batches, "text", SLICE):
            counts, id_digests, text_digests, all_ids, decoded = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                ids = coder.encode(text or "")
                back = coder.decode(ids)
                counts.append(len(ids))
                id_digests.append(hashlib.sha256(",".join(map(numerals.__getitem__, ids)).encode()).hexdigest())
                text_digests.append(hashlib.sha256(back.encode()).hexdigest())
                if with_ids:
                    all_ids.append(ids)
                    decoded.append(back)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)
        coder.known.clear()

    narrow = docs.select("doc_id", "text")
    return narrow.mapInArrow(lambda batches: released(run(batches)), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {SCHEMA}{extra}")
