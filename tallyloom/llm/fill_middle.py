"""Fill-in-the-middle rewriting of documents: a text is cut at two units and its parts are moved behind marks.

A unit is a run of A-Z letters (either case) or any other single code point. A text's UTF-8 bytes lie in blocks of
fixed size; a Fenwick tree holds how many units begin in each block and how many code points do. A cut is found by
binary-lifting descent to its block and then inside that block alone, and its place in code points is the tree's
count before the block plus a local one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from tallyloom.llm.tables import slices

#: Bytes of a block, marks of the three parts, and percentages of texts that stay plain and of suffix-first ones.
BLOCK = 4096
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SUFFIX_FIRST = 90, 20
SLICE = 4_000_000


def _begins(data: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes begin a unit and which a code point, after the byte ``before``."""
    lower = data | 0x20
    letter = (lower >= ord("a")) & (lower <= ord("z"))
    points = (data & 0xC0) != 0x80
    follows = np.empty(len(data), bool)
    if len(data):
        follows[0] = chr(before).isascii() and chr(before).isalpha()
        follows[1:] = letter[:-1]
    return points & ~(letter & follows), points


class BlockIndex:
    """Units and code points of one text by blocks, as Fenwick trees; node i holds the counts of its lowest bit's span."""

    def __init__(self, data: bytes | memoryview, block: int = BLOCK):
        self.data, self.block = np.frombuffer(data, np.uint8), block
        n = -(-len(self.data) // block)
        sums = np.zeros((n + 1, 2), np.int64)
        for k in range(n):
            sums[k + 1] = [np.count_nonzero(begins) for begins in self._block(k)]
        np.cumsum(sums, axis=0, out=sums)
        nodes = np.arange(n + 1)
        self.tree = (sums - sums[nodes - (nodes & -nodes)]).tolist()  # node i sums the blocks after i - lowbit(i)
        self.units, self.points = sums[n].tolist()

    def _block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        start = k * self.block
        return _begins(self.data[start : start + self.block], int(self.data[start - 1]) if start else 0)

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` units, of which the text has at least as many."""
        if units == self.units:
            return len(self.data), self.points
        at, points, step = 0, 0, 1 << max(len(self.tree) - 1, 1).bit_length()
        while step:  # as many blocks as begin no unit beyond the wanted ones
            node = at + step
            if node < len(self.tree) and self.tree[node][0] <= units:
                at, units, points = node, units - self.tree[node][0], points + self.tree[node][1]
            step >>= 1
        begins, starts = self._block(at)
        place = int(np.flatnonzero(begins)[units])
        return at * self.block + place, points + int(np.count_nonzero(starts[:place]))


@dataclass
class Rewritten:
    units: int
    form: str
    output: bytes
    prefix_chars: int | None = None
    middle_chars: int | None = None


def rewrite(doc_id: int | None, text: bytes, block: int = BLOCK) -> Rewritten:
    """The text in the form that its id decides; cuts and form come from the id's hash alone."""
    index = BlockIndex(text, block)
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= PLAIN_FROM:
        return Rewritten(index.units, "plain", text)
    first, second = sorted((h1 % (index.units + 1), h2 % (index.units + 1)))
    (a, points_a), (b, points_b) = index.cut(first), index.cut(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SUFFIX_FIRST:
        form, output = "spm", b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    else:
        form, output = "psm", b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return Rewritten(index.units, form, output, points_a, points_b - points_a)


def restore(output: bytes, form: str) -> bytes:
    """The text that an output of ``rewrite`` was made of; no part holds a mark, and none can end in half of one."""
    if form == "plain":
        return output
    second, third = output.index(SUFFIX if form == "psm" else PREFIX), output.rindex(MIDDLE)
    one, other, middle = output[3:second], output[second + 3 : third], output[third + 3 :]
    return one + middle + other if form == "psm" else other + middle + one


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def fill_middle(docs: DataFrame, with_texts: bool = True) -> DataFrame:
    """One row per document: its units ``n``, its ``form`` (plain, psm or spm), the code points of prefix and middle
    (null if plain), ``output``, ``restored`` (with ``with_texts``), ``output_sha256`` and ``restored_sha256``.

    Null counts as the empty text, which is plain. A row without an id is cut as one with an empty id. Repeated rows
    give repeated rows; texts of any length are cut whole; other columns are ignored.
    """
    more = [*(["output", "restored"] if with_texts else []), "output_sha256", "restored_sha256"]

    def run(batches):
        for batch in slices(batches, "text", SLICE):
            texts = pa.compute.fill_null(batch.column("text").cast(pa.large_binary()), b"")
            found: dict[str, list] = {name: [] for name in names}
            for doc, value in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                done = rewrite(doc, value.as_py())
                back = restore(done.output, done.form)
                row = (doc, done.units, done.form, done.prefix_chars, done.middle_chars)
                texts_out = (done.output.decode(), back.decode()) if with_texts else ()
                digests = (hashlib.sha256(part).hexdigest() for part in (done.output, back))
                for column, item in zip(found.values(), (*row, *texts_out, *digests), strict=True):
                    column.append(item)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * len(more)]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(found.values(), kinds, strict=True)], names)

    schema = ", ".join([SCHEMA, *[f"{name} string" for name in more]])
    names = [field.split()[0] for field in schema.split(", ")]
    return docs.select("doc_id", "text").mapInArrow(run, schema)
