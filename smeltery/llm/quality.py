"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

1. *Statistics*: each text becomes a row of ``STATISTICS`` numbers (shares of byte classes, word and
   line lengths, repetition of words, phrases and lines). Nothing but the text is looked at.
2. *Training*: up to ``SAMPLE`` labelled rows, those with the smallest hashes of key and text, come
   to the driver as statistics (about 6 MB). Each statistic is cut into at most ``BINS`` bins;
   trees grow best split first on sums of gradients and curvatures by bin.
3. *Scoring*: all trees lie in one set of flat arrays. Rows walk down all trees at once, one step of
   array indexing for each level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.llm import texts

#: Most labelled rows a model learns from; bounds what comes to the driver.
SAMPLE = 20_000
BINS = 128
ROUNDS = 150
LEAVES = 12
RATE = 0.1
#: Least curvature (rows weighted by how undecided they are) on each side of a split.
LEAST_WEIGHT = 2.0
L2 = 1.0
#: Scores from here on are predicted as label 1.
ACCEPTED = 0.3

_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "blank": b" \t",
    "line": b"\n\r",
    "stop": b".",
    "comma": b",",
    "shout": b"!?",
    "colon": b":;",
    "bar": b"|\\/",
    "symbol": b"#$%&*@^~+=<>",
    "quote": b"\"'`()[]{}",
    "dash": b"-_",
    "lead": bytes(range(0xC0, 0x100)),
    "inner": bytes(range(0x80, 0xC0)),
}
_MARKS = np.zeros(256, bool)
_MARKS[[c for name in ("stop", "comma", "shout", "colon", "bar", "symbol", "quote", "dash") for c in _CLASSES[name]]] = True
_UPPER = np.zeros(256, bool)
_UPPER[list(_CLASSES["upper"])] = True

STATISTICS = (
    *(f"share_{name}" for name in _CLASSES),
    "log_bytes",
    "entropy",
    "top_byte",
    "log_words",
    "word_mean",
    "word_deviation",
    "word_longest",
    "words_one",
    "words_long",
    "words_marked",
    "words_doubly_marked",
    "words_upper",
    "words_bare_mark",
    "words_distinct",
    "word_top",
    "words_again",
    "phrases_distinct",
    "log_lines",
    "line_mean",
    "lines_distinct",
    "words_a_stop",
)


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of different hashes of each of ``n`` owners, and the count of the commonest."""
    keys = texts.mixed(hashes + owner.astype(np.uint64) * texts.FACTOR)
    _, first, counts = np.unique(keys, return_index=True, return_counts=True)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, owner[first], counts)
    return np.bincount(owner[first], minlength=n), most


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` for each text; a null or empty text has zeros."""
    data, bounds = texts.flat(column)
    n = len(bounds) - 1
    size = np.diff(bounds)
    histogram = np.bincount(np.repeat(np.arange(n) * 256, size) + data, minlength=n * 256).reshape(n, 256)
    some = np.maximum(size, 1)
    share = histogram / some[:, None]
    out = {f"share_{name}": histogram[:, list(members)].sum(axis=1) / some for name, members in _CLASSES.items()}
    out["log_bytes"] = np.log1p(size)
    out["entropy"] = -np.sum(share * np.log2(np.where(share > 0, share, 1)), axis=1)
    out["top_byte"] = share.max(axis=1)

    starts, ends, first = texts.word_spans(data, bounds)
    counts = np.diff(first)
    words = np.maximum(counts, 1)
    owner = np.repeat(np.arange(n), counts)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=values, minlength=n) / words

    lengths = (ends - starts).astype(np.float64)
    out["log_words"] = np.log1p(counts)
    out["word_mean"] = mean(lengths)
    out["word_deviation"] = np.sqrt(np.maximum(mean(lengths**2) - out["word_mean"] ** 2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, owner, lengths)
    out["word_longest"] = np.log1p(longest)
    out["words_one"] = mean(lengths == 1)
    out["words_long"] = mean(lengths > 14)
    last, head = data[ends - 1], data[starts]
    marked = _MARKS[last]
    out["words_marked"] = mean(marked)
    out["words_doubly_marked"] = mean(marked & (lengths > 1) & _MARKS[data[np.maximum(ends - 2, 0)]])
    second = data[np.minimum(starts + 1, len(data) - 1)] if len(data) else head
    out["words_upper"] = mean(_UPPER[head] & (lengths > 1) & _UPPER[second])
    out["words_bare_mark"] = mean(marked & (lengths == 1))
    hashes = texts.word_hashes(data, starts, ends)
    kinds, most = _distinct(hashes, owner, n)
    out["words_distinct"] = kinds / words
    out["word_top"] = most / words
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    out["words_again"] = mean(again)
    phrases = texts.rolling(hashes, 3)
    whole = owner[: len(phrases)] == owner[2 : 2 + len(phrases)] if len(phrases) else np.zeros(0, bool)
    kinds, _ = _distinct(phrases[whole], owner[: len(phrases)][whole], n)
    out["phrases_distinct"] = kinds / np.maximum(counts - 2, 1)

    cuts = np.union1d(np.flatnonzero(data == 10) + 1, bounds[:-1])
    cuts = cuts[cuts < len(data)]
    line_ends = np.append(cuts[1:], len(data)) if len(cuts) else cuts
    line_owner = np.searchsorted(bounds, cuts, "right") - 1
    lines = np.bincount(line_owner, minlength=n)
    out["log_lines"] = np.log1p(lines)
    out["line_mean"] = np.log1p(size / np.maximum(lines, 1))
    kinds, _ = _distinct(texts.word_hashes(data, cuts, line_ends), line_owner, n)
    out["lines_distinct"] = kinds / np.maximum(lines, 1)
    out["words_a_stop"] = np.log1p(counts / (1 + histogram[:, [46, 33, 63]].sum(axis=1)))
    return np.column_stack([out[name] for name in STATISTICS]).astype(np.float64)


@dataclass(frozen=True)
class Trees:
    """All trees in flat arrays; a leaf is its own left and right child."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, rows: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
        row = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            below = rows[row, self.feature[at]] <= self.threshold[at]
            at = np.where(below, self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -40, 40)))


def _edges(values: np.ndarray) -> np.ndarray:
    """Thresholds of one statistic: midway between values, at most ``BINS - 1`` of them."""
    kinds = np.unique(values)
    if len(kinds) > BINS:
        kinds = np.unique(np.quantile(values, np.linspace(0, 1, BINS), method="nearest"))
    return (kinds[:-1] + kinds[1:]) / 2


class _Tree:
    """One tree, grown best split first from sums by bin."""

    def __init__(self, codes: np.ndarray, gradient: np.ndarray, curvature: np.ndarray):
        self.codes, self.gradient, self.curvature = codes, gradient, curvature
        self.nodes: list[list] = []  # feature, bin, left, right, value, depth

    def sums(self, rows: np.ndarray) -> np.ndarray:
        columns = self.codes.shape[1]
        flat = (self.codes[rows] + np.arange(columns) * BINS).ravel()
        weights = (np.repeat(w[rows], columns) for w in (self.gradient, self.curvature))
        return np.stack([np.bincount(flat, w, columns * BINS).reshape(columns, BINS) for w in weights])

    def best(self, sums: np.ndarray) -> tuple[float, int, int]:
        """Gain, feature and last bin of the left side; ties go to the first."""
        left = np.cumsum(sums, axis=2)
        whole = left[:, :1, -1:]
        right = whole - left
        allowed = (left[1] >= LEAST_WEIGHT) & (right[1] >= LEAST_WEIGHT)

        def worth(part):
            return part[0] ** 2 / (np.maximum(part[1], 0) + L2)

        gain = np.where(allowed, worth(left) + worth(right) - worth(whole), 0)
        place = int(np.argmax(gain))
        return float(gain.flat[place]), *divmod(place, BINS)

    def add(self, rows: np.ndarray, sums: np.ndarray, depth: int) -> tuple:
        total = sums[:, 0].sum(axis=1)
        self.nodes.append([0, 0, None, None, -RATE * total[0] / (total[1] + L2), depth])
        return (*self.best(sums), len(self.nodes) - 1, rows, sums)

    def grow(self) -> list[list]:
        rows = np.arange(len(self.codes))
        open_leaves = [self.add(rows, self.sums(rows), 0)]
        while len(open_leaves) < LEAVES:
            chosen = max(range(len(open_leaves)), key=lambda i: open_leaves[i][0])
            gain, feature, last, node, rows, sums = open_leaves[chosen]
            if gain <= 1e-9:
                break
            below = self.codes[rows, feature] <= last
            sides = [rows[below], rows[~below]]
            small = int(len(sides[1]) < len(sides[0]))
            own = self.sums(sides[small])
            both = [own, sums - own] if small == 0 else [sums - own, own]
            depth = self.nodes[node][5] + 1
            made = [self.add(side, part, depth) for side, part in zip(sides, both)]
            self.nodes[node][:4] = [feature, last, made[0][3], made[1][3]]
            open_leaves[chosen] = made[0]
            open_leaves.append(made[1])
        return self.nodes


def fit(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Trees for rows of statistics with labels 0 and 1; without both labels, a constant score."""
    positive = float(labels.sum())
    rate = (positive + 1) / (len(labels) + 2)
    base = float(np.log(rate / (1 - rate)))
    out: list[tuple] = []
    roots: list[int] = []
    deepest = 0
    if 0 < positive < len(labels):
        edges = [_edges(rows[:, i]) for i in range(rows.shape[1])]
        codes = np.column_stack([np.searchsorted(e, rows[:, i], "left") for i, e in enumerate(edges)])
        margin = np.full(len(labels), base)
        for _ in range(ROUNDS):
            chance = 1 / (1 + np.exp(-margin))
            nodes = _Tree(codes, chance - labels, chance * (1 - chance)).grow()
            if len(nodes) == 1:
                break
            start = len(out)
            roots.append(start)
            for i, (feature, last, left, right, value, depth) in enumerate(nodes):
                deepest = max(deepest, depth)
                if left is None:
                    out.append((0, 0.0, start + i, start + i, value))
                else:
                    out.append((feature, edges[feature][last], start + left, start + right, 0.0))
            model = _trees(base, [start], out, deepest)
            margin += model.margin(rows) - base
    return _trees(base, roots, out, deepest)


def _trees(base: float, roots: list[int], nodes: list[tuple], depth: int) -> Trees:
    parts = list(zip(*nodes)) if nodes else [()] * 5
    kinds = (np.int32, np.float64, np.int32, np.int32, np.float64)
    return Trees(base, np.array(roots, np.int32), *[np.array(p, k) for p, k in zip(parts, kinds)], depth)


def with_statistics(docs: DataFrame, text: str = "text", into: str = "statistics") -> DataFrame:
    """``docs`` without the text, with its statistics as an array."""
    place = docs.columns.index(text)
    others = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.groups(batch, place):
                rows = statistics(part.column(place))
                offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in others] + [lists], [*others, into])

    schema = T.StructType([docs.schema[c] for c in others]).add(into, T.ArrayType(T.DoubleType()))
    return docs.mapInArrow(run, schema)


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
) -> Trees:
    """A model from at most ``sample`` labelled documents.

    Labels other than 0 and 1, null keys and labels without a document are passed over; a key with
    both labels counts once for each. Repeated keys and texts are bounded by the same sample, as
    it is drawn by a hash of both. Without rows, or with one label only, the score is constant.
    """
    marks = (
        labels.select(F.col(key).cast("bigint").alias("key"), F.col(label).cast("int").alias("label"))
        .where("key is not null and label in (0, 1)")
        .distinct()
        .orderBy(F.xxhash64("key"), "key", "label")
        .limit(sample)
    )
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    joined = rows.join(F.broadcast(marks), "key").withColumn("place", F.xxhash64("key", "text"))
    found = with_statistics(joined).orderBy("place", "key", "label").limit(sample).toArrow()
    values = found.column("statistics").combine_chunks()
    values = values.flatten().to_numpy(zero_copy_only=False) if len(found) else np.zeros(0)
    return fit(values.reshape(len(found), len(STATISTICS)), found.column("label").to_numpy().astype(np.float64))


def score(docs: DataFrame, model: Trees, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` without the text, with a score from 0 to 1 (higher: label 1 is likelier).

    Null texts count as empty; an empty table gives an empty table; other columns stay, but for one
    that is named like the score.
    """
    docs = docs.drop(into)
    place = docs.columns.index(text)
    others = [i for i in range(len(docs.columns)) if i != place]
    names = [*(docs.columns[i] for i in others), into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.groups(batch, place):
                found = pa.array(model.score(statistics(part.column(place))))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in others), found], names)

    schema = T.StructType([docs.schema.fields[i] for i in others]).add(into, T.DoubleType())
    return docs.mapInArrow(run, schema)
