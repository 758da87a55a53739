"""Disputed segments in shards: tasks read whole anchors, in order, a bounded number of bytes at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: A shard is closed at the first change of anchor after so many bytes.
SHARD_BYTES = 4 << 20

Segment = tuple[int, int, int, int, int, bytes]  # key, rank, twin, first, windows, units


def in_shards(
    disputed: DataFrame, work: Callable[[list[Segment]], Iterator[tuple]], schema: str
) -> DataFrame:
    """Rows that ``work`` gives for each shard of ``disputed`` (see ``anchors.with_texts``).

    All segments of an anchor are in one shard, in the order of their documents and places.
    """
    parts = int(disputed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[Segment] = []
        size = 0

        def done():
            rows = list(work(shard))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names)

        for batch in batches:
            for segment in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SHARD_BYTES and segment[0] != shard[-1][0]:
                    yield from done()
                    shard, size = [], 0
                shard.append(segment)
                size += len(segment[5])
        if shard:
            yield from done()

    dealt = disputed.repartition(parts, "key").sortWithinPartitions("key", "rank", "twin", "first")
    return dealt.mapInArrow(run, schema)
