"""Self-join of documents on the Jaccard similarity of their word n-gram sets, by token-combination prefixes.

A token is the hash of an n-gram. Tokens are ordered rare ones first, then by hash. A similar pair differs in at
most ``size // 5`` tokens of either set (at 0.8), so a prefix that cannot lose all its signatures to that many
differences must share one. Rare tokens are signatures of their own. A frequent token is none: frequent tokens
are dealt into classes, and two tokens of a class in one prefix are a signature (any two sets that agree on two of
them share it), for which the prefix grows by one token per class met. Shared passages are frequent and so come
last: a document that has enough other text never indexes them.

The classes hold for sizes within a band; a set signs for its own band and the next one up, so any two sets that
can be similar share a band. In the smallest bands frequent tokens sign alone.

Sets that share no rare token share frequent ones alone, so each set's number of these bounds the sizes of the sets it can
be similar to by combinations. Sets made of a common passage and much text of their own therefore never meet each
other, however many there are: they would have to share some of their own text, and then meet by that.

Candidates are verified on whole sets. First each set is compared with one partner, the set with the fewest
rare tokens of a signature it shares most with; what that links becomes one component, and then only pairs across
components remain. Equal
sets are one node throughout, so a group of copies is never paired with itself. ``similar_pairs`` verifies all
candidates and gives every link.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions.joins import skew_join
from tallyloom.functions.staging import stage
from tallyloom.llm.components import components
from tallyloom.llm.tables import release_memory, released as _released, slices

PERCENT = 80
#: A token in more documents is frequent; the limit doubles until at most MOST_FREQUENT tokens are (8 MB, broadcast).
FREQUENT, MOST_FREQUENT = 50, 1 << 20
#: Tokens counted per group, tokens sorted at once in a task, and bits of the filter of candidate documents (2 MB).
GROUP_TOKENS, SORT_TOKENS, FILTER_BITS = 2_000_000, 2_000_000, 1 << 24
#: Signatures sent to Spark at once.
SEND_ENTRIES = 250_000
BAND, SMALL_BAND = 1.26, 10
#: Steps of sizes per unit of their logarithm; sets meet by combinations within steps that a similar one can have.
SIZE_STEPS = 50
#: Bytes of text taken at once, and 64-bit words of the bitmap that stands for a set.
SLICE, BITMAP_WORDS = 400_000, 16
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_tables() -> tuple[np.ndarray, np.ndarray]:
    """A number for each byte, the same for both cases of A-Z, and which bytes are white space."""
    numbers = _mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
    numbers[ord("A") : ord("Z") + 1] = numbers[ord("a") : ord("z") + 1]
    blank = np.zeros(256, bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    return numbers, blank


_NUMBERS, _BLANK = _word_tables()


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie in ``data`` one after the other, and where each text's words begin (and
    the end). A word's hash is a polynomial of its bytes, mixed with its length."""
    solid = ~_BLANK[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = bounds[1:-1]
    inner = inner[inner < len(data)]
    begins[inner] = solid[inner]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    last = solid.copy()
    last[:-1] &= begins[1:] | ~solid[1:]
    sizes = np.flatnonzero(last) - starts + 1
    firsts = np.cumsum(sizes) - sizes
    at = np.flatnonzero(solid)
    place = np.arange(len(at)) - np.repeat(firsts, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), _STEP, np.uint64))
    hashes = np.add.reduceat(_NUMBERS[data[at]] * powers[place], firsts)
    return _mix(hashes + sizes.astype(np.uint64)), np.searchsorted(starts, bounds)


def token_sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """Per row of a batch with column ``text``: the sorted distinct n-gram tokens, A-Z lower-cased. A text with fewer
    words than ``size`` has one token for all of them, a text without words none."""
    for part in slices(iter([batch]), "text", SLICE):
        column = pa.compute.fill_null(part.column("text").cast(pa.large_string()), "")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        flat, firsts = word_hashes(data, offsets - offsets[0])
        grams = np.zeros(max(len(flat) - size + 1, 0), np.uint64)
        for k in range(size):
            grams = grams * _STEP + flat[k : k + len(grams)]
        grams = _mix(grams)
        for start, end in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            if end - start >= size:
                tokens = np.sort(grams[start : end - size + 1])
                fresh = np.empty(len(tokens), bool)
                fresh[0] = True
                np.not_equal(tokens[1:], tokens[:-1], out=fresh[1:])
                yield tokens if fresh.all() else tokens[fresh]
            elif end > start:
                one = np.array([end - start], np.uint64)
                for h in flat[start:end]:
                    one = _mix(one * _STEP + h)
                yield one
            else:
                yield np.zeros(0, np.uint64)


def _fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, f1, f2) per row: the size of its set and two sums that equal sets agree in."""

    def run(batches):
        for batch in batches:
            n, f1, f2 = [], [], []
            for tokens in token_sets(batch, size):
                n.append(len(tokens))
                f1.append(int(np.sum(_mix(tokens ^ _STEP), dtype=np.uint64).view(np.int64)))
                f2.append(int(np.sum(_mix(tokens * _STEP), dtype=np.uint64).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64())],
                ["doc_id", "n", "f1", "f2"],
            )

    return docs.mapInArrow(lambda batches: _released(run(batches)), "doc_id long, n long, f1 long, f2 long")


def _pack(tokens: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as the byte planes of their differences, compressed."""
    steps = np.diff(tokens, prepend=np.uint32(0)).astype("<u4")
    return zlib.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct one of sorted numbers begins, and how many there are of it."""
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return first, np.diff(np.append(first, len(keys)))


def _repeats(counts: np.ndarray) -> bytes:
    """Places and numbers of the counts above 1, which are few."""
    (at,) = np.nonzero(counts > 1)
    return np.concatenate((at, counts[at])).astype("<u4").tobytes()


def _counts(size: int, repeats: bytes) -> np.ndarray:
    at, many = np.frombuffer(repeats, "<u4").reshape(2, -1).astype(np.int64)
    counts = np.ones(size, np.uint64)
    counts[at] = many
    return counts


def frequent_tokens(docs: DataFrame, total: int, size: int) -> tuple[np.ndarray, int]:
    """The leading bits (their number comes second) of the tokens in too many documents, sorted.

    Every token of every document counts. Tasks sort and count their tokens, ``SORT_TOKENS`` at a time, and send each
    one once with its count, packed, by range of the leading bits; so a group merges about ``GROUP_TOKENS`` numbers,
    however many documents hold a token. Tokens that agree in ``bits`` leading bits, 32
    more than the ranges take, count as one; that may make a rare token frequent but never changes a result.
    """
    high = max(0, math.ceil(math.log2(max(total, 1) / GROUP_TOKENS)))
    bits = high + 32

    def deal(batches):
        held: list[np.ndarray] = []

        def packed():
            keys = np.concatenate(held)
            held.clear()
            keys >>= np.uint64(64 - bits)
            keys.sort()
            first, counts = _runs(keys)
            keys = keys[first]
            groups = (keys >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(groups)) + 1
            parts = np.split((keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), cuts)
            names = groups[np.concatenate(([0], cuts))]
            columns = [names, [_pack(p) for p in parts], [_repeats(c) for c in np.split(counts, cuts)]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "data", "repeats"])

        count = 0
        for batch in batches:
            for tokens in token_sets(batch, size):
                if len(tokens):
                    held.append(tokens)
                    count += len(tokens)
                if count >= SORT_TOKENS:
                    yield packed()
                    count = 0
        if held:
            yield packed()

    def merge(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        sent = [_unpack(x.as_py()) for x in table.column("data")]
        numbers = [_counts(len(k), x.as_py()) for k, x in zip(sent, table.column("repeats"), strict=True)]
        both = np.concatenate(sent).astype(np.uint64)
        both <<= np.uint64(32)
        both |= np.concatenate(numbers)
        del sent, numbers
        both.sort()
        keys = (both >> np.uint64(32)).astype(np.uint32)
        first, _ = _runs(keys)
        counts = np.add.reduceat((both & np.uint64(0xFFFFFFFF)).astype(np.int64), first)
        many = counts > FREQUENT
        tokens = keys[first[many]].astype(np.int64) + (part << 32)
        del both, keys, first
        release_memory()
        return pa.table({"token": tokens, "n_docs": counts[many].astype(np.int64)})

    dealt = docs.mapInArrow(lambda batches: _released(deal(batches)), "part long, data binary, repeats binary")
    found = stage(dealt.groupBy("part").applyInArrow(merge, "token long, n_docs long"), "frequent")
    level = F.floor(F.log2(F.col("n_docs") / FREQUENT)).cast("int").alias("level")
    levels = {r["level"]: r["n"] for r in found.groupBy(level).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, kept = 0, sum(levels.values())
    while kept > MOST_FREQUENT:
        kept -= levels.get(least, 0)
        least += 1
    # At most MOST_FREQUENT numbers come to the driver.
    rows = found.where(F.col("n_docs") > FREQUENT * 2**least).select("token").toArrow().column("token").to_numpy()
    return np.sort(rows).astype(np.uint64), bits


def _signatures(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set's signatures by rare tokens, and by combinations (or, in small bands, single frequent tokens)."""
    n = len(tokens)
    need = n * (100 - PERCENT) // 100 + 1
    rare, common = tokens[~frequent], tokens[frequent]
    if len(rare) >= need or not len(common):
        return rare[:need], common[:0]
    own, found = int(math.log(n) / math.log(BAND)), []
    for band in (own, own + 1):
        salt = _mix(np.array([band + 1], np.uint64))
        if band <= SMALL_BAND:
            found.append(_mix(common[: need - len(rare)] ^ salt))
            continue
        classes = _mix(common ^ salt) % np.uint64(int(0.18 * BAND**band) + 1)
        order = np.argsort(classes, kind="stable")
        fresh = np.concatenate(([True], np.diff(classes[order]) != 0))
        second = np.empty(len(common), bool)
        second[order] = ~fresh  # not the first of its class in the order of hashes
        length = int(np.searchsorted(np.cumsum(second), need - len(rare))) + 1
        order = order[order < length]
        prefix, groups = common[order], classes[order]
        for gap in range(1, length):
            same = groups[gap:] == groups[:-gap]
            if not same.any():
                break
            pair = _mix(prefix[:-gap][same] + salt) * _STEP + prefix[gap:][same]
            found.append(_mix(pair ^ salt))
    return rare, np.concatenate(found) if found else common[:0]


def _entries(docs: DataFrame, size: int, frequent: np.ndarray, bits: int) -> DataFrame:
    """(doc_id, n, signature, kind, common) rows. Kind 0 is a rare token of a set that needs nothing else, 1 one of a
    set that needs combinations, too, and 2 a combination; ``common`` is its set's number of frequent tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        known = shared.value
        quick = np.zeros(1 << 20, bool)
        quick[(known >> np.uint64(bits - 20)).astype(np.int64)] = True
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            out_ids, sizes, signatures, kinds, commons = [], [], [], [], []
            for doc, tokens in zip(ids, token_sets(batch, size), strict=True):
                if not len(tokens):
                    continue
                often = quick[(tokens >> np.uint64(44)).astype(np.int64)]
                maybe = tokens[often] >> np.uint64(64 - bits)
                if len(maybe):
                    at = np.minimum(np.searchsorted(known, maybe), len(known) - 1)
                    often[often] = known[at] == maybe
                rare, combined = _signatures(tokens, often)
                need = len(tokens) * (100 - PERCENT) // 100 + 1
                for found, kind in ((rare, 0 if len(rare) >= need else 1), (combined, 2)):
                    if len(found):
                        signatures.append(found)
                        out_ids.append(np.full(len(found), doc, np.int64))
                        sizes.append(np.full(len(found), len(tokens), np.int32))
                        kinds.append(np.full(len(found), kind, np.int8))
                        commons.append(np.full(len(found), len(tokens) - len(rare) if kind == 2 else 0, np.int32))
                if sum(map(len, signatures)) > SEND_ENTRIES:
                    yield _entry_batch(out_ids, sizes, signatures, kinds, commons)
                    out_ids, sizes, signatures, kinds, commons = [], [], [], [], []
            if signatures:
                yield _entry_batch(out_ids, sizes, signatures, kinds, commons)

    return docs.mapInArrow(lambda batches: _released(run(batches)), "doc_id long, n int, signature long, kind byte, common int")


def _entry_batch(ids, sizes, signatures, kinds, commons) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in (ids, sizes, signatures, kinds, commons)]
    columns[2] = columns[2].view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "n", "signature", "kind", "common"])


def _postings(entries: DataFrame, members: DataFrame) -> DataFrame:
    """(signature, node, n, kind, common) with one row per node, of signatures that two nodes hold."""
    by = Window.partitionBy("signature").orderBy("doc_id")
    # A rare token is in at most as many documents as make it frequent, so its rows may meet in one task.
    near = F.coalesce(F.lag("doc_id").over(by), F.lead("doc_id").over(by))
    rare = entries.where("kind < 2").withColumn("near", near).where("near is not null").drop("near")
    either = rare.unionByName(entries.where("kind = 2"))
    nodes = either.join(members.select("doc_id", "node").distinct(), "doc_id")
    return nodes.groupBy("signature", "node").agg(*[F.max(c).alias(c) for c in ("n", "kind", "common")])


def _overlap_bound(n: str, m: str) -> str:
    """The fewest tokens that similar sets of n and m tokens share."""
    return f"ceil({PERCENT} * ({n} + {m}) / (100 + {PERCENT}))"


def _plausible(pairs: DataFrame) -> DataFrame:
    """Of pairs (a, b, n_a, n_b, shared, kind): those whose sizes allow it and, where both prefixes consist of rare
    tokens alone (kind 0), that share as many tokens as the earlier ending prefix cannot lose."""
    need = f"{{0}} * {100 - PERCENT} div 100 + 1 - ({{0}} - {_overlap_bound('n_a', 'n_b')})"
    enough = f"least({need.format('n_a')}, {need.format('n_b')})"
    sizes = f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)"
    return pairs.where(sizes).where(f"kind > 0 or shared >= {enough}")


def _of_nodes(docs: DataFrame, nodes: DataFrame, schema: str, values) -> DataFrame:
    """What ``values`` makes of the sets of the given nodes, as rows (node, ...). A bit filter of fixed size spares
    most other documents the work; the join that follows is exact."""
    at = F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS)).cast("int")
    by_word = nodes.select(at.alias("at")).groupBy(F.expr("at div 64").cast("int").alias("word"))
    rows = by_word.agg(F.bit_or(F.expr("shiftleft(1L, at % 64)")).alias("bits")).toArrow()
    filled = np.zeros(FILTER_BITS // 64, np.int64)  # at most FILTER_BITS / 64 rows
    filled[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    passed = docs.sparkSession.sparkContext.broadcast(filled.view(np.uint8))

    def run(batches):
        bits = passed.value
        for batch in batches:
            at = batch.column("at").to_numpy()
            batch = batch.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *values(batch)], names)

    names = ["node", *(field.split()[0] for field in schema.split(", "))]
    marked = docs.withColumn("at", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).cast("int"))
    found = marked.mapInArrow(lambda batches: _released(run(batches)), f"node long, {schema}")
    return found.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def _sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    return _of_nodes(
        docs, nodes, "tokens binary", lambda batch: [pa.array([t.tobytes() for t in token_sets(batch, size)], pa.binary())]
    )


def _bitmaps(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """For each node ``BITMAP_WORDS`` words of bits; a bit is 1 if an odd number of tokens falls on it."""

    def values(batch):
        rows = np.zeros((batch.num_rows, BITMAP_WORDS), np.uint64)
        for row, tokens in zip(rows, token_sets(batch, size), strict=True):
            spread = _mix(tokens + _STEP)
            word = (spread >> np.uint64(6)) % np.uint64(BITMAP_WORDS)
            np.bitwise_xor.at(row, word.astype(np.int64), np.uint64(1) << (spread & np.uint64(63)))
        return [pa.array(column.view(np.int64)) for column in np.ascontiguousarray(rows.T)]

    return _of_nodes(docs, nodes, ", ".join(f"w{k} long" for k in range(BITMAP_WORDS)), values)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("left")), "a")
    both = first.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(lambda batches: _released(run(batches)), "a long, b long")


def _size_step(n: str) -> str:
    return f"cast(floor(ln({n}) * {SIZE_STEPS}) as int)"


def _beside(a: DataFrame, b: DataFrame, on: list[str], condition: str) -> DataFrame:
    """Pairs of postings with columns named ``..._a`` and ``..._b`` that agree in ``on`` and meet ``condition``."""
    sides = [
        p.select(*on, *[F.col(c).alias(f"{c}_{side}") for c in p.columns if c not in on]) for p, side in ((a, "a"), (b, "b"))
    ]
    # Tokens in one set only flip a bit each, so sets differ in at least as many tokens as their bitmaps in bits.
    differing = " + ".join(f"bit_count(w{k}_a ^ w{k}_b)" for k in range(BITMAP_WORDS))
    same = [sides[0][c] == sides[1][c] for c in on]
    bound = _overlap_bound("n_a", "n_b")
    sizes = F.expr(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")
    met = sides[0].join(sides[1], [*same, F.expr(condition) & sizes & F.expr(f"{differing} <= n_a + n_b - 2 * {bound}")])
    return met.select(
        F.least("node_a", "node_b").alias("a"),
        F.greatest("node_a", "node_b").alias("b"),
        F.expr("if(node_a < node_b, n_a, n_b)").alias("n_a"),
        F.expr("if(node_a < node_b, n_b, n_a)").alias("n_b"),
        F.greatest("kind_a", "kind_b").alias("kind"),
    )


def _reaching(combined: DataFrame, upward: bool, among: DataFrame | None = None) -> DataFrame:
    """Postings by combinations once for each step of sizes, from their own up or down, that a similar set can have.

    Sets that share a rare token meet by it. Any others share frequent tokens alone, so a set with ``common`` of
    them is similar only to sets of at most ``common * (100 + PERCENT) / PERCENT - n`` tokens. With ``among``, the
    postings to look for, only sizes between the least and the largest of their signature count, so a posting that can
    meet none of them reaches nowhere.
    """
    least, most = ("n", f"n * 100 div {PERCENT}") if upward else (f"cast(ceil(n * {PERCENT} / 100) as int)", "n")
    shared = "common"
    if among is not None:
        ends = [F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.max("common").alias("most_common")]
        combined = combined.join(among.groupBy("signature").agg(*ends), "signature")
        least, most, shared = f"greatest({least}, least_n)", f"least({most}, most_n)", "least(common, most_common)"
    most = f"least({most}, {shared} * {100 + PERCENT} div {PERCENT} - n)"
    steps = F.explode(F.expr(f"sequence({_size_step('least_size')}, {_size_step('most_size')})"))
    sized = combined.withColumns({"least_size": F.expr(least), "most_size": F.expr(most)}).where("least_size <= most_size")
    return sized.withColumn("step", steps).drop("least_size", "most_size", "least_n", "most_n", "most_common")


def _sized(combined: DataFrame) -> DataFrame:
    return combined.withColumn("step", F.expr(_size_step("n")))


def _meeting(rest: DataFrame, settled: str) -> DataFrame:
    """Plausible pairs (a, b) of nodes that share a signature, but for those of which ``settled`` holds; ``rest`` are
    postings with the bitmaps of their nodes, of which ``other`` marks those that are not of their signature's main
    component, whose nodes need not meet each other."""
    rare, combined = rest.where("kind < 2").drop("common", "other"), rest.where("kind = 2")
    others, sized = combined.where("other"), _sized(combined)
    open_ = f"not ({settled})"
    allowed = f"{open_} and least(common_a, common_b) >= {_overlap_bound('n_a', 'n_b')}"
    after = "(n_a < n_b or n_a = n_b and node_a < node_b)"
    on = ["signature", "step"]
    main = sized.where("not other")
    # A pair has a node that is not of the main component. It looks upward among all, and downward in the main component
    # (downward among the others, they have looked upward).
    made = (
        _beside(rare, rare, ["signature"], f"node_a < node_b and {open_}")
        .unionByName(_beside(_reaching(others, True, combined), sized, on, f"{allowed} and {after}"))
        .unionByName(_beside(_reaching(others, False, main), main, on, f"{allowed} and not {after}"))
    )
    pairs = made.groupBy("a", "b").agg(
        F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"), F.max("kind").alias("kind"), F.count(F.lit(1)).alias("shared")
    )
    return _plausible(pairs).select("a", "b")


def _with_others(rest: DataFrame) -> DataFrame:
    """Postings with ``other``: whether their component is not the main one of their signature, that with most of its
    nodes (with the smallest id, if several have). So a large group of near copies never is what looks for the few
    other sets of its signatures. Only combinations need it; rare tokens have few nodes."""
    held = rest.where("kind = 2").groupBy("signature", "component").agg(F.count(F.lit(1)).alias("held"))
    main = held.groupBy("signature").agg(F.max_by("component", F.struct("held", -F.col("component"))).alias("main"))
    marked = rest.join(main, "signature", "left").withColumn("other", F.coalesce(F.col("component") != F.col("main"), F.lit(True)))
    return marked.drop("main")


def _verify(docs: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return stage(_verified(pairs, stage(_sets(docs, nodes, size), "sets")), "links")


def _links(docs: DataFrame, postings: DataFrame, size: int) -> DataFrame:
    """Enough similar pairs (a, b) to connect every component."""
    # The set with the fewest rare tokens is the likeliest to be similar to the others of a combination.
    order = F.struct(F.expr("if(kind = 2, n - common, 0)"), F.col("node"))
    firsts = postings.groupBy("signature").agg(
        F.min_by(F.struct("node", "n", "kind", "common"), order).alias("p"), F.count(F.lit(1)).alias("held")
    )
    pivots = stage(firsts.where("held > 1").select("signature", "p"), "pivots")
    possible = f"kind < 2 or least(common, p.common) >= {_overlap_bound('n', 'p.n')}"
    met = postings.join(pivots, "signature").where("node <> p.node").where(possible)
    counted = met.groupBy(F.col("p.node").alias("a"), F.col("node").alias("b")).agg(
        F.max("p.n").alias("n_a"),
        F.max("n").alias("n_b"),
        F.max(F.greatest("kind", "p.kind")).alias("kind"),
        F.count(F.lit(1)).alias("shared"),
    )
    best = _plausible(counted).groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a"))
    chosen = stage(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "first-pairs")
    linked = _verify(docs, chosen, size)
    found = components(linked)
    placed = postings.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stage(placed, "placed")
    spread = placed.groupBy("signature").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    rest = stage(placed.join(spread.where("x <> y").select("signature"), "signature"), "unsettled")
    if rest.isEmpty():
        return linked
    bitmaps = _bitmaps(docs, rest.select("node").distinct(), size)
    rest = stage(_with_others(rest).join(bitmaps, "node"), "unsettled-bits")
    pairs = _meeting(rest, "component_a = component_b")
    left = stage(pairs.join(chosen, ["a", "b"], "left_anti"), "second-pairs")
    return linked if left.isEmpty() else linked.unionByName(_verify(docs, left, size))


def _indexed(docs: DataFrame, prints: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The node of each document with a set, (doc_id, n, node), and the postings of the nodes."""
    named = prints.where("doc_id is not null and n > 0")
    classes = stage(named.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("node")), "classes")
    members = stage(named.join(classes, ["n", "f1", "f2"]).select("doc_id", "n", "node"), "members")
    total = named.agg(F.sum("n")).first()[0] or 0
    frequent, bits = frequent_tokens(docs, total, size)
    return members, stage(_postings(_entries(docs, size, frequent, bits), members), "postings")


def _digest(text: str = "text"):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _names(docs: DataFrame, prints: DataFrame) -> DataFrame | None:
    """(doc_id, digest, name): a number for each text of each id, in the order of ids, if an id has texts with
    different sets; None if the ids can stand for their texts."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("n", "f1", "f2") for f in (F.min, F.max)]
    spans = prints.where("doc_id is not null").groupBy("doc_id").agg(*ends)
    if spans.where("min_n < max_n or min_f1 < max_f1 or min_f2 < max_f2").isEmpty():
        return None
    texts = docs.where("doc_id is not null").select("doc_id", _digest().alias("digest")).distinct()
    return stage(texts.orderBy("doc_id", "digest").withColumn("name", F.monotonically_increasing_id()), "names")


def _named(docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Documents whose id is that of one set, their fingerprints, and the names that stand for their ids, if any."""
    docs = docs.select("doc_id", "text")
    prints = stage(_fingerprints(docs, size), "fingerprints")
    names = _names(docs, prints)
    if names is None:
        return docs, prints, None
    named = docs.withColumn("digest", _digest()).join(names, ["doc_id", "digest"], "left")
    docs = stage(named.select(F.col("name").alias("doc_id"), "text"), "named")
    return docs, stage(_fingerprints(docs, size), "fingerprints"), names


def similar_pairs(docs: DataFrame, size: int = 5) -> DataFrame:
    """Every link between different sets: rows (a, b), a <= b, of Jaccard similarity 0.8 or more, where documents with
    equal sets are named by their smallest id.

    The result itself grows with the square of a group of near copies; ``similar_documents`` does without. Rows
    without an id or without words have no link. Rows that share an id but not the text are documents of their own;
    a link between two of them has a = b.
    """
    docs, prints, names = _named(docs, size)
    docs = docs.where("doc_id is not null")
    _, postings = _indexed(docs, prints, size)
    shared = postings.groupBy("signature").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    rest = stage(postings.join(shared.select("signature"), "signature", "left_semi"), "shared")
    bitmaps = _bitmaps(docs, rest.select("node").distinct(), size)
    met = stage(rest.join(bitmaps, "node").withColumn("other", F.lit(True)), "shared-bits")
    pairs = stage(_meeting(met, "false"), "pairs")
    links = _verify(docs, pairs, size)
    for end in ("a", "b") if names is not None else ():
        known = names.select(F.col("name").alias(end), "doc_id")
        links = skew_join(links, known, end).withColumn(end, F.col("doc_id")).drop("doc_id")
    return links.select("a", "b")


def _placed(docs: DataFrame, prints: DataFrame, size: int) -> DataFrame:
    docs = docs.where("doc_id is not null")
    members, postings = _indexed(docs, prints, size)
    found = stage(components(_links(docs, postings, size)), "components")
    placed = members.join(found, "node", "left").select("doc_id", "n", F.coalesce("component", "node").alias("component_id"))
    alone = prints.where("doc_id is null or n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return placed.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def similar_documents(docs: DataFrame, size: int = 5) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` (size of its set of ``size``-word shingles) and
    ``component_id``, the smallest id it reaches over links of Jaccard similarity 0.8 or more.

    Null and empty texts and texts without words have an empty set and are linked with nothing. Rows without an id
    keep their count and have no component. Repeated rows give repeated rows. Rows that share an id but not the text
    are documents of their own, which link by their own texts; two components may then have the same id, as
    ``one_of_each`` knows. Words, shingles and sets are compared by 64-bit hashes (sets by two). Other columns are
    ignored.
    """
    docs, prints, names = _named(docs, size)
    placed = _placed(docs, prints, size)
    if names is None:
        return placed
    rows = stage(placed.withColumnRenamed("doc_id", "name"), "placed-names")
    own = rows.join(names.select("name", "doc_id"), "name", "left").drop("name")
    smallest = names.select(F.col("name").alias("component_id"), F.col("doc_id").alias("smallest"))
    return skew_join(stage(own, "own-names"), smallest, "component_id", "left").select(
        "doc_id", "n_shingles", F.col("smallest").alias("component_id")
    )


def one_of_each(docs: DataFrame, size: int = 5) -> DataFrame:
    """One row of each component, that with the smallest id, and all rows without an id; all columns."""
    named, prints, names = _named(docs, size)
    first = _placed(named, prints, size).where("doc_id = component_id").select("doc_id")
    if names is None:
        kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    else:
        chosen = names.join(first.select(F.col("doc_id").alias("name")), "name", "left_semi")
        chosen = chosen.select("doc_id", F.col("digest").alias("__digest"))
        marked = docs.withColumn("__digest", _digest()).join(chosen, ["doc_id", "__digest"], "left_semi")
        kept = marked.dropDuplicates(["doc_id", "__digest"])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))
