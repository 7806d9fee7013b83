"""Token counts under a unigram vocabulary: the best segmentation's number of pieces, without its pieces.

An Aho-Corasick automaton enumerates the vocabulary's matches in a word by their ends, longest first, and dynamic
programming carries the best score and its number of pieces. Ties keep the earlier candidate, the longer piece,
and a character without a piece of its own costs the lowest score less 10 and counts its UTF-8 bytes, as the
``tokenizers`` library's unigram model with byte fallback does.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tallyloom.llm.tables import slices

SPACE_MARK, UNKNOWN_PENALTY = "▁", 10.0
CACHE_WORDS, CACHE_CHARS, SLICE = 400_000, 40, 8_000_000


def vocabulary_of(model: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file without its control symbols; the unknown piece comes first."""
    spec = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = [i for i in range(spec.get_piece_size()) if not spec.is_control(i) and not spec.is_unused(i)]
    pieces.sort(key=lambda i: not spec.is_unknown(i))
    return [(spec.id_to_piece(i), spec.get_score(i)) for i in pieces]


class UnigramCounter:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.singles = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.known: dict[str, int] = {}

    def pieces(self, word: str) -> int:
        """The number of pieces of one word that starts with the space mark."""
        size = len(word)
        best, count = [0.0] * (size + 1), [0] * (size + 1)
        reached, singles, unknown = 0, self.singles, self.unknown

        def unknown_until(place: int) -> None:
            # Ends that no match has: a character on its own, which has no piece.
            nonlocal reached
            while reached < place:
                best[reached + 1] = best[reached] + unknown
                count[reached + 1] = count[reached] + len(word[reached].encode())
                reached += 1

        def alone(place: int) -> None:
            # The last candidate of an end that longer pieces reach: its character without a piece.
            if word[place - 1] not in singles and best[place - 1] + unknown > best[place]:
                best[place] = best[place - 1] + unknown
                count[place] = count[place - 1] + len(word[place - 1].encode())

        for last, (length, score) in self.automaton.iter(word):
            end = last + 1
            if end > reached:
                if reached:
                    alone(reached)
                unknown_until(last)
                reached = end
                best[end] = best[end - length] + score
                count[end] = count[end - length] + 1
            elif best[end - length] + score > best[end]:
                best[end] = best[end - length] + score
                count[end] = count[end - length] + 1
        if reached:
            alone(reached)
        unknown_until(size)
        return count[size]

    def _learn(self, word: str) -> int:
        found = self.pieces(SPACE_MARK + word)
        if len(word) <= CACHE_CHARS:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def count(self, text: str) -> int:
        """Every space begins a word, and so does the text; no text has no pieces."""
        if not text:
            return 0
        words = text.replace(SPACE_MARK, " ").split(" ")
        if not words[0]:
            del words[0]
        counts = list(map(self.known.get, words))
        if None in counts:
            return sum(self.known.get(w) or self._learn(w) for w in words)
        return sum(counts)


@lru_cache(maxsize=1)
def counter_of(model: str) -> UnigramCounter:
    """One counter per Python worker, so that its remembered words serve all the worker's tasks."""
    return UnigramCounter(vocabulary_of(model))


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``n_tokens`` per row. Null and empty texts have none; repeated rows give repeated rows; other
    columns are ignored. ``model`` is a path that every executor can open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model)
        for batch in slices(batches, "text", SLICE):
            counts = [counter.count(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long")
