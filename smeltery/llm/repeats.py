"""Maximal repeats of bytes: an enhanced suffix array and its tree of common-prefix intervals.

A byte goes when a string of ``window`` bytes that covers it also starts earlier in the table: in a
document with a smaller key, or before in the same one. See ``anchors`` for how equal strings come
into one shard.

In a shard, the suffixes that start a window are sorted, and the common prefixes of neighbours are
scanned with a stack. Each interval is a string and *all* places where it occurs. It is a maximal
repeat when it can not be extended: not to the right, as it is an interval, and not to the left,
as the bytes before its places differ (the start of a segment counts as different from all others).
Every string of ``window`` bytes that occurs twice lies in a maximal repeat with the same number of
places, so keeping the first place of each and removing the others removes exactly what is asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from smeltery.llm import anchors, shards

WINDOW = 100
GRAM = 32


def suffix_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes ``data[start:end]``, and the common prefix of each with the one before."""
    sizes = ends - starts
    width = int(sizes.max())
    table = np.zeros((len(starts), width), np.uint8)
    for i in range(0, len(starts), 4096):
        places = starts[i : i + 4096, None] + np.arange(width)
        inside = places < ends[i : i + 4096, None]
        table[i : i + 4096] = np.where(inside, data[np.minimum(places, len(data) - 1)], 0)
    order = np.argsort(table.view(f"S{width}")[:, 0], kind="stable")
    common = np.zeros(len(order), np.int64)
    for i in range(1, len(order), 4096):
        these, before = order[i : i + 4096], order[i - 1 : i + 4095][: len(order[i : i + 4096])]
        differ = table[these] != table[before]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        common[i : i + 4096] = np.minimum(same, np.minimum(sizes[these], sizes[before]))
    return order, common


def intervals(common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Length, first and last position of each interval of the suffix array with a common prefix of ``least`` or more."""
    stack: list[tuple[int, int]] = []  # length, first position
    for i, length in enumerate([*common.tolist(), 0]):
        first = i - 1
        while stack and stack[-1][0] > length:
            size, first = stack.pop()
            yield size, first, i - 1
        if length >= least and (not stack or stack[-1][0] < length):
            stack.append((length, first))


def maximal_repeats(segments: list, window: int) -> Iterator[tuple[int, list[int], np.ndarray, np.ndarray]]:
    """Length and places of each maximal repeat: index of the segment and offset of its start there."""
    data = np.frombuffer(b"".join(s[5] for s in segments), np.uint8)
    sizes = np.array([len(s[5]) for s in segments])
    counts = np.array([s[4] for s in segments])
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(segments)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begins[owner] + offset
    order, common = suffix_array(data, starts, (begins + sizes)[owner])
    # What stands before each suffix; a different number for each start of a segment.
    before = np.where(offset > 0, data[np.maximum(starts - 1, 0)].astype(np.int64), 256 + owner)[order]
    owner, offset = owner[order], offset[order]
    changes = np.concatenate(([0], np.cumsum(before[1:] != before[:-1])))
    for length, first, last in intervals(common, window):
        if changes[first] != changes[last]:
            yield length, owner[first : last + 1], offset[first : last + 1]


def judge_shard(segments: list, window: int) -> Iterator[tuple[int, int, int, int]]:
    """Stretches of bytes (rank, twin, first, size): each place of each repeat but the first."""
    spans: dict[tuple[int, int], int] = {}
    # Anchors share no windows: sort the suffixes of a few anchors at a time.
    start = 0
    while start < len(segments):
        end, windows = start, 0
        while end < len(segments) and (windows < 100_000 or segments[end][0] == segments[end - 1][0]):
            windows += segments[end][4]
            end += 1
        part = segments[start:end]
        spans.clear()
        for length, owners, offsets in maximal_repeats(part, window):
            # Segments are in order, so the first place has the smallest index, then offset.
            places = owners.astype(np.int64) << 32 | offsets
            for place in np.delete(places, places.argmin()).tolist():
                where = place >> 32, place & 0xFFFFFFFF
                spans[where] = max(spans.get(where, 0), length)
        for (owner, offset), length in spans.items():
            _, rank, twin, first, _, _ = part[owner]
            yield rank, twin, first + offset, length
        start = end


def _kept(text: bytes, removed: np.ndarray) -> tuple:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], removed.view(np.int8), [0]))) > 0)
    kept = np.frombuffer(text, np.uint8)[~removed].tobytes()
    return len(text), int(removed.sum()), len(edges), hashlib.sha256(kept).hexdigest(), kept


def deduplicate(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256, kept`` for each row: ``kept`` are the bytes that stay.

    ``n_spans`` counts maximal removed runs. Null and empty texts have no bytes; texts shorter than a
    window stay whole. Rows that repeat a key with another text are documents of their own, ordered
    by a hash of the text; rows that repeat both are one document and get the same result. A null key
    comes before all others. An empty table gives an empty table.
    """
    cut = anchors.Cut(words=False, window=window, gram=gram)
    own = anchors.documents(docs, key, text)

    def judge(disputed: DataFrame) -> DataFrame:
        return shards.in_shards(
            disputed, lambda shard: judge_shard(shard, window), "rank bigint, twin bigint, first bigint, size bigint"
        )

    spans = anchors.later_spans(own, cut, judge)
    schema = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return anchors.without_later(own, key, spans, schema, _kept, len)
