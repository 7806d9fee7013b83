"""Running a Python function over groups of which one side is held and the other streams by."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

HELD, PASSING = 0, 1
Work = Callable[[pa.Table], Callable[[pa.Table], Iterator[pa.RecordBatch]]]


def by_group(rows: DataFrame, tasks: int, work: Work, schema: str, order: tuple[str, ...] = (), most: int = 20_000) -> DataFrame:
    """Rows of ``rows`` meet by their int column ``group`` (from 0), one group after the other in ``tasks`` tasks.

    ``work`` gets the rows of a group whose column ``kind`` is HELD, in ``order``, and returns a function that turns
    PASSING rows, of which at most ``most`` come at once, into batches. Only the held rows of one group are in
    memory, so whoever deals out the groups bounds them; the passing rows of a group may be any number.
    """

    def run(batches):
        group, held, passing, found = None, [], [], None

        def passed():
            nonlocal found
            if found is None and held:
                found = work(pa.Table.from_batches(held))
            if found is not None and passing:
                yield from found(pa.Table.from_batches(passing))
            passing.clear()

        for batch in batches:
            groups, kinds = batch.column("group").to_numpy(), batch.column("kind").to_numpy()
            at = 0
            while at < len(groups):
                if groups[at] != group:
                    yield from passed()
                    group, held, found = groups[at], [], None
                same = (groups[at:] == group) & (kinds[at:] == kinds[at])
                length = len(same) if same.all() else int(same.argmin())
                if kinds[at] == HELD:
                    held.append(batch.slice(at, length))
                else:
                    length = min(length, most)
                    passing.append(batch.slice(at, length))
                    if sum(len(p) for p in passing) >= most:
                        yield from passed()
                at += length
        yield from passed()

    dealt = rows.repartitionById(tasks, "group")
    return dealt.sortWithinPartitions("group", "kind", *order).mapInArrow(run, schema)
