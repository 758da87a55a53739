"""Where equal stretches of text meet: anchors chosen by content.

A *window* is a run of units (words or bytes) of one document. Of the short grams inside a window,
the one with the smallest hash, leftmost if several, is its *anchor*. Equal windows have equal
anchors at equal offsets, wherever they stand; so windows need to be compared only with windows of
the same anchor, and every document is looked at by itself. Consecutive windows with one anchor make
a *segment*; a text has two segments for about every (window - gram) units.

1. Each task cuts its documents into segments and collapses identical ones; of these, all but the
   first start later than an equal text and are known to be *later* at once. A passage that a third
   of all documents hold leaves a task as one row for each of its segments.
2. One shuffle by anchor brings the rest together, as numbers without text. Identical segments
   collapse again; anchors that only one segment has are dropped. What remains, distinct segments
   around one anchor, is *disputed*: parts of them may be equal, and only their texts can tell.
   An anchor inside a passage that a large share of all documents hold, each in a context of its own,
   would bring all of them together. Such anchors are counted beforehand; their segments are split
   into single windows, which meet by their own content and collapse like identical segments.
3. The texts of disputed segments, and no others, are cut from their documents and brought to
   *shards* by anchor, where an operator compares them.

Order is by document, then start. A document is ``rank, twin``: its key (null: before all others)
and, only in a table where keys repeat, a hash of its text. Rows that share both are one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm import texts
from smeltery.sources.folders import written

#: Bits for a position inside a piece; the others rank grams by hash.
PLACE_BITS = 22
PIECE = 1 << 21
#: Segments that a task holds before it collapses and sends them.
HELD = 1 << 20

#: An anchor with so many different segments in one task is reported as crowded there; the
#: SPLIT_ANCHORS most crowded are split. Others hold at most CROWD of HELD segments of any task.
CROWD = 64
SPLIT_ANCHORS = 100_000

SEGMENT = "key bigint, content bigint, rank bigint, twin bigint, first bigint, windows int"


@dataclass(frozen=True)
class Cut:
    """Units and sizes: windows of ``window`` units, anchored at grams of ``gram`` units."""

    words: bool
    window: int
    gram: int

    def units(self, data: np.ndarray, bounds: np.ndarray):
        """Codes of all units, and the index of each document's first unit (one more at the end)."""
        if not self.words:
            return texts.BYTE_CODES[data], bounds
        starts, ends, first = texts.word_spans(data, bounds)
        return texts.word_hashes(data, starts, ends), first


@dataclass(frozen=True)
class Documents:
    """``rank, twin, text`` of every row, and of every document once."""

    rows: DataFrame
    once: DataFrame


def documents(docs: DataFrame, key: str, text: str) -> Documents:
    repeats = not docs.groupBy(F.col(key)).count().where("count > 1").isEmpty()
    twin = F.xxhash64(F.col(text).cast("string")) if repeats else F.lit(0).cast("bigint")
    rows = docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(-(2**63))).alias("rank"),
        twin.alias("twin"),
        F.col(text).cast("string").alias("text"),
    )
    return Documents(rows, rows.dropDuplicates(["rank", "twin"]) if repeats else rows)


def cut_segments(codes: np.ndarray, first: np.ndarray, cut: Cut):
    """Segments of several documents: document, first window (from its start), windows, key, content."""
    grams = texts.rolling(codes, cut.gram)
    inside = cut.window - cut.gram + 1
    total = len(codes) - cut.window + 1
    if total <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    low = np.uint64((1 << PLACE_BITS) - 1)
    places = []
    for start in range(0, total, PIECE):
        some = grams[start : start + PIECE + inside - 1]
        least = (some & ~low) | np.arange(len(some), dtype=np.uint64)
        size = 1
        while 2 * size <= inside:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if inside > size:
            least = np.minimum(least[: len(least) - (inside - size)], least[inside - size :])
        places.append((least & low).astype(np.int64) + start)
    place = np.concatenate(places)[:total]
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)[:total]
    valid = np.arange(total) + cut.window <= first[1:][owner]
    change = np.ones(total, bool)
    change[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(change & valid)
    # A run of valid windows ends at the next change or the next invalid window.
    stops = np.flatnonzero(change | ~valid)
    following = np.append(stops, total)[np.searchsorted(stops, heads, "right")]
    doc = owner[heads]
    content = texts.span_hashes(codes, heads, following + cut.window - 1)
    return doc, heads - first[doc], following - heads, grams[place[heads]], content


def _sorted_runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by columns, the first counting most, and where the first column changes."""
    order = np.lexsort(columns[::-1])
    lead = columns[0][order]
    new = np.ones(len(order), bool)
    new[1:] = lead[1:] != lead[:-1]
    return order, new


def _rows(kind: int, rows: dict[str, np.ndarray], pick: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(np.full(len(pick), kind, np.int8))] + [pa.array(v[pick]) for v in rows.values()]
    return pa.RecordBatch.from_arrays(arrays, ["kind", *rows])


SINGLE, SEVERAL, LATER, DISPUTED = range(4)


def _collapse(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Identical segments of one task: the first with whether there are more; the others as later."""
    order, new = _sorted_runs(rows["key"], rows["content"], rows["rank"], rows["twin"], rows["first"])
    content = rows["content"][order]
    new[1:] |= content[1:] != content[:-1]
    run = np.cumsum(new) - 1
    many = np.bincount(run)[run] > 1
    yield _rows(SINGLE, rows, np.sort(order[new & ~many]))
    yield _rows(SEVERAL, rows, np.sort(order[new & many]))
    late = np.sort(order[~new])
    # Their anchor does not matter any more; spread them by their place.
    spread = texts.mixed((rows["rank"] * 1_000_003 + rows["first"]).astype(np.uint64)).astype(np.int64)
    yield _rows(LATER, rows | {"key": spread}, late)


def _held_segments(docs: DataFrame, cut: Cut, split: np.ndarray, use: Callable, schema: str) -> DataFrame:
    """What ``use`` makes of the segments that a task holds, some at a time."""
    names = ("key", "content", "rank", "twin", "first", "windows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0

        def flush():
            return use({n: np.concatenate(x) for n, x in zip(names, zip(*held))})

        for whole in batches:
            for batch in texts.groups(whole, "text"):
                data, bounds = texts.flat(batch.column(2))
                codes, first = cut.units(data, bounds)
                doc, start, windows, key, content = _split(cut_segments(codes, first, cut), split, codes, first, cut)
                rank = batch.column(0).to_numpy(zero_copy_only=False)
                twin = batch.column(1).to_numpy(zero_copy_only=False)
                held.append((
                    key.astype(np.int64), content.astype(np.int64), rank[doc], twin[doc],
                    start, windows.astype(np.int32),
                ))
                count += len(doc)
                if count >= HELD:
                    yield from flush()
                    held, count = [], 0
        if held:
            yield from flush()

    return docs.mapInArrow(run, schema)


def _split(found: tuple, split: np.ndarray, codes: np.ndarray, first: np.ndarray, cut: Cut) -> tuple:
    """Segments whose anchor is in ``split`` as single windows, keyed by what they hold."""
    doc, start, windows, key, content = found
    busy = np.isin(key, split)
    if not busy.any():
        return found
    counts = windows[busy]
    each = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    owner, begin = np.repeat(doc[busy], counts), np.repeat(start[busy], counts) + each
    place = first[owner] + begin
    single = texts.span_hashes(codes, place, place + cut.window)
    parts = (owner, begin, np.ones(len(owner), np.int64), single, np.repeat(key[busy], counts))
    return tuple(np.concatenate((old[~busy], new)) for old, new in zip(found, parts))


def crowded_anchors(docs: DataFrame, cut: Cut) -> np.ndarray:
    """Anchors to split: the ones with the most different segments, of those that crowd any task."""

    def report(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(rows["key"], kind="stable")
        key, content = rows["key"][order], rows["content"][order]
        edges = np.flatnonzero(np.diff(key, prepend=~key[:1]))
        sizes = np.diff(np.append(edges, len(key)))
        many = [(e, e + n) for e, n in zip(edges[sizes >= CROWD], sizes[sizes >= CROWD])]
        found = [(int(key[a]), n) for a, b in many if (n := len(np.unique(content[a:b]))) >= CROWD]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*found)], ["key", "n"])

    counted = _held_segments(docs, cut, np.zeros(0, np.uint64), report, "key bigint, n bigint")
    top = counted.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(SPLIT_ANCHORS)
    return np.sort(np.array([r.key for r in top.collect()], np.int64).astype(np.uint64))


def segments(docs: DataFrame, cut: Cut) -> DataFrame:
    """Collapsed segments of all documents: ``kind`` and the columns of SEGMENT."""
    return _held_segments(docs, cut, crowded_anchors(docs, cut), _collapse, f"kind tinyint, {SEGMENT}")


def settled(found: DataFrame) -> DataFrame:
    """Rows of kind LATER and DISPUTED, after segments with one anchor have met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            kind = batch.column(0).to_numpy(zero_copy_only=False)
            rows = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names) if i}
            late = np.flatnonzero(kind == LATER)
            if len(late):
                yield _rows(LATER, rows, late)
            parts.append({n: v[kind != LATER] for n, v in (rows | {"kind": kind}).items()})
        if not parts:
            return
        rows = {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}
        del parts
        # Most anchors stand alone: put them aside before sorting by all columns.
        order = np.argsort(rows["key"], kind="stable")
        key = rows["key"][order]
        same = np.zeros(len(key) + 1, bool)
        same[1:-1] = key[1:] == key[:-1]
        shared = order[same[:-1] | same[1:]]
        rows = {n: v[shared] for n, v in rows.items() if n != "kind"}
        if not len(shared):
            return
        order, new_key = _sorted_runs(rows["key"], rows["content"], rows["rank"], rows["twin"], rows["first"])
        content = rows["content"][order]
        new = new_key.copy()
        new[1:] |= content[1:] != content[:-1]
        group = np.cumsum(new_key) - 1
        variants = np.bincount(group, weights=new)[group] > 1
        yield _rows(LATER, rows, order[~new])
        yield _rows(DISPUTED, rows, order[new & variants])

    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(parts, "key").mapInArrow(run, f"kind tinyint, {SEGMENT}")


def with_texts(disputed: DataFrame, docs: DataFrame, cut: Cut) -> DataFrame:
    """Disputed segments with their units as bytes (words joined by one blank)."""
    per_doc = disputed.groupBy("rank", "twin").agg(
        F.collect_list(F.struct("key", "first", "windows")).alias("segments")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(3)
            inner = wanted.flatten()
            owner = np.repeat(np.arange(len(wanted)), np.diff(wanted.offsets.to_numpy()))
            key, first, windows = (inner.field(i) for i in range(3))
            starts = first.to_numpy(zero_copy_only=False)
            ends = starts + windows.to_numpy(zero_copy_only=False) + cut.window - 1
            whole = batch.column(2).cast(pa.large_binary())
            units: list[bytes] = []
            last, parts = -1, b""
            for doc, start, end in zip(owner.tolist(), starts.tolist(), ends.tolist()):
                if doc != last:
                    last, parts = doc, whole[doc].as_py()
                    parts = parts.split() if cut.words else parts
                units.append(b" ".join(parts[start:end]) if cut.words else parts[start:end])
            taken = pa.array(owner)
            arrays = [key, batch.column(0).take(taken), batch.column(1).take(taken), first, windows, pa.array(units, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "rank", "twin", "first", "windows", "units"])

    joined = docs.join(per_doc, ["rank", "twin"]).select("rank", "twin", "text", "segments")
    return joined.mapInArrow(
        run, "key bigint, rank bigint, twin bigint, first bigint, windows int, units binary"
    )


def later_spans(docs: Documents, cut: Cut, judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rank, twin, first, size``: stretches of units covered by windows that also start earlier.

    ``judge`` turns disputed segments with texts into such rows.
    """
    found = written(settled(segments(docs.once, cut)), "segments")
    known = found.where(F.col("kind") == LATER).select(
        "rank", "twin", "first", (F.col("windows") + (cut.window - 1)).cast("bigint").alias("size")
    )
    disputed = found.where(F.col("kind") == DISPUTED)
    return known.unionByName(judge(with_texts(disputed, docs.once, cut)))


def without_later(
    docs: Documents,
    key: str,
    spans: DataFrame,
    schema: str,
    finish: Callable[[bytes, np.ndarray], tuple],
    units: Callable[[bytes], int],
) -> DataFrame:
    """One row for each document: key and what ``finish(text, removed)`` says.

    ``removed`` flags the document's units, of which there are ``units(text)``.
    """
    gathered = spans.groupBy("rank", "twin").agg(F.collect_list(F.struct("first", "size")).alias("spans"))
    joined = docs.rows.join(gathered, ["rank", "twin"], "left").select("rank", "text", "spans")
    names = [key, *[c.split()[0] for c in schema.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            ids = [None if r == -(2**63) else r for r in batch.column(0).to_pylist()]
            for text, held in zip(batch.column(1).cast(pa.large_binary()), batch.column(2)):
                text = text.as_py() or b""
                steps = np.zeros(units(text) + 1, np.int64)
                if held.is_valid and len(held.values):
                    first, size = (held.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                    np.add.at(steps, first, 1)
                    np.add.at(steps, first + size, -1)
                out.append(finish(text, np.cumsum(steps[:-1]) > 0))
            columns = [pa.array(ids, pa.int64()), *[pa.array(list(c)) for c in zip(*out)]]
            if out:
                yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, f"`{key}` bigint, {schema}")
