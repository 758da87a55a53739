"""Spelling variants: a bit-sliced position index over the words of a corpus.

1. *Words*: runs of letters are counted over all whole texts, in tasks first.
2. *Shards*: of two words that differ by one letter, the shorter (or either) can be cut into pieces so
   that all but one piece agree. A word goes to one shard for each piece it may differ in, by a hash
   of the rest of it, once with its own length as the shorter one and once with one less. A pair
   counts in the one shard whose piece holds the first letter that differs, so nothing is found
   twice. Shards that grow too large are cut again at half the piece; at a piece of one letter only
   words that differ in that letter can meet.
3. *Index*: for each position and letter a shard has one bitset over its words. Looking up a
   word runs over its letters once; four sets of words are advanced together, 64 words an
   operation: no error, one letter replaced, one more letter, one letter fewer. Sets of one more and
   one fewer read the bitsets shifted by a position.
4. *Forms*: the near word with the largest count, if it is large enough, and what chains of forms
   lead to, by doubling joins.

Null texts have no words. A null key counts as an empty one. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.sources.folders import written

LETTERS = "a-zÀ-ÿ"
#: Contract of the corpus: of one in so many words of a document a letter is lost.
LOSS = 199
#: Words held by a task before it passes their counts on.
HELD_WORDS = 200_000
#: Longer texts are read match by match.
LONG_TEXT = 1 << 20
PIECES = 4
#: Average words of a shard, and the number from which its piece is halved.
SHARD_WORDS = 16_384
CROWD = 65_536
#: Words of one index, and words looked up at once.
BLOCK = 4_096
BATCH = 256
#: Most bytes of one index: long words get smaller blocks.
INDEX_BYTES = 1 << 25

SHARD = ("la", "lo", "hi", "bucket")


def with_losses(key: str, run: str) -> str:
    """A run as the corpus spells it: for one hash in ``LOSS``, without the letter the hash names."""
    return _lossy(crc32(f"{key}:".encode()), run)


def _lossy(start: int, run: str) -> str:
    h = crc32(run.encode(), start)
    if h % LOSS:
        return run
    place = h % len(run)
    return run[:place] + run[place + 1 :]


def word_counts(docs: DataFrame, key: str, text: str, least_length: int, least_count: int) -> DataFrame:
    """``word, n`` of all words that are long and frequent enough."""
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                if not t.is_valid:
                    continue
                low = t.as_py().lower().decode()  # of bytes: only A-Z change
                said = runs.findall(low) if len(low) < LONG_TEXT else (m.group() for m in runs.finditer(low))
                start = crc32(f"{k or ''}:".encode())
                for word, n in Counter(said).items():
                    word = _lossy(start, word)
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield _counted(held)
                    held = Counter()
        yield _counted(held)

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    counts = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


def _counted(held: Counter) -> pa.RecordBatch:
    columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["word", "n"])


def _placed(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows of ``word, n, la, lo, hi`` with their bucket: a hash of the word without the piece."""
    rest = "concat(left(word, lo), right(word, la - hi))"
    return rows.withColumn("bucket", F.expr(f"cast(pmod(xxhash64({rest}), {buckets}) as int)"))


def shards(words: DataFrame, shard_words: int = SHARD_WORDS, crowd: int = CROWD) -> DataFrame:
    """``word, n`` with shards: ``la`` letters of the shorter word, which differ from ``lo`` to ``hi``."""
    buckets = max(1, words.count() // shard_words)
    piece = f"transform(sequence(0, {PIECES - 1}), j -> struct(la * j div {PIECES} as lo, la * (j + 1) div {PIECES} as hi))"
    rows = (
        words.withColumn("la", F.explode(F.array(F.char_length("word"), F.char_length("word") - 1)))
        .where("la > 0")
        .withColumn("piece", F.explode(F.expr(piece)))
        .select("word", "n", "la", F.col("piece.lo").cast("int").alias("lo"), F.col("piece.hi").cast("int").alias("hi"))
        .where("lo < hi")
    )
    rows = _placed(rows, buckets)
    while True:
        crowded = rows.groupBy(*SHARD).count().where(f"count > {crowd} and hi - lo > 1").drop("count")
        crowded = written(crowded, "crowded-shards")
        if crowded.isEmpty():
            return rows
        half = "transform(array(0, 1), s -> struct(if(s = 0, lo, (lo + hi) div 2) as lo, if(s = 0, (lo + hi) div 2, hi) as hi))"
        cut = (
            rows.join(crowded, [*SHARD], "left_semi")
            .withColumn("piece", F.explode(F.expr(half)))
            .select("word", "n", "la", F.col("piece.lo").cast("int").alias("lo"), F.col("piece.hi").cast("int").alias("hi"))
        )
        rest = rows.join(crowded, [*SHARD], "left_anti").select("word", "n", *SHARD)
        rows = written(rest.unionByName(_placed(cut, buckets)), "shards")


class Index:
    """Bitsets over up to ``BLOCK`` words for each position and letter."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, letters: int):
        self.words = len(codes)
        self.columns = -(-self.words // 64)
        width = codes.shape[1]
        # One more position at either end, so that shifted reads need no special case.
        bits = np.zeros((width + 2, letters, self.columns * 64), bool)
        for p in range(width):
            inside = np.flatnonzero(codes[:, p] >= 0)
            bits[p + 1, codes[inside, p], inside] = True
        self.bits = np.packbits(bits, axis=2, bitorder="little").view(np.uint64)
        self.lengths = lengths

    def of_length(self, length: int) -> np.ndarray:
        bits = np.zeros(self.columns * 64, bool)
        bits[: self.words] = self.lengths == length
        return np.packbits(bits, bitorder="little").view(np.uint64)

    def near(self, looked_up: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row, word) that differ by exactly one letter; ``looked_up`` has words of one length."""
        exact = np.full((len(looked_up), self.columns), ~np.uint64(0))
        replaced, more, fewer = (np.zeros_like(exact) for _ in range(3))
        length = looked_up.shape[1]
        for p in range(length):
            letter = looked_up[:, p]
            before, here, after = (self.bits[p + shift, letter] for shift in range(3))
            more = (more | exact) & after
            fewer = (fewer & before) | exact
            replaced = (replaced & here) | (exact & ~here)
            exact = exact & here
        found = replaced & self.of_length(length)
        found |= (more | exact) & self.of_length(length + 1)
        found |= fewer & self.of_length(length - 1)
        row, column = np.nonzero(found)
        each, bit = np.nonzero(np.unpackbits(found[row, column].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        return row[each], column[each] * 64 + bit


def _coded(words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Words as rows of letter numbers (-1 behind their end), their lengths, and the number of letters."""
    lengths = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    letters, numbers = np.unique(flat, return_inverse=True)
    codes = np.full((len(words), int(lengths.max(initial=0))), -1, np.int32)
    codes[np.arange(codes.shape[1]) < lengths[:, None]] = numbers
    return codes, lengths, len(letters)


def near_pairs(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All ordered pairs of different words that are one letter apart, with the first place that differs."""
    codes, lengths, letters = _coded(words)
    most = INDEX_BYTES // ((codes.shape[1] + 2) * max(1, letters))
    block = max(64, min(BLOCK, most // 64 * 64))
    queries = [
        part
        for length in np.unique(lengths)
        for own in [np.flatnonzero(lengths == length)]
        for part in np.split(own, range(BATCH, len(own), BATCH))
    ]
    for start in range(0, len(words), block):
        index = Index(codes[start : start + block], lengths[start : start + block], letters)
        for part in queries:
            row, other = index.near(codes[part, : lengths[part[0]]])
            row, other = part[row], other + start
            yield row, other, np.argmax(codes[row] != codes[other], axis=1)


def _best_near(table: pa.Table) -> pa.Table:
    """For each word of a shard: near words that count here, and the best of them."""
    la, lo, hi = (table.column(c)[0].as_py() for c in SHARD[:3])
    words = table.column("word").to_pylist()
    n = table.column("n").to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    lengths = np.array([len(w) for w in words])
    counts = np.zeros(len(words), np.int64)
    best = np.full(len(words), len(words), np.int64)
    for a, b, place in near_pairs(words):
        place = np.minimum(place, la - 1)
        here = (np.minimum(lengths[a], lengths[b]) == la) & (place >= lo) & (place < hi)
        a, b = a[here], b[here]
        np.add.at(counts, a, 1)
        np.minimum.at(best, a, rank[b])
    some = np.flatnonzero(counts)
    chosen = [order[r] for r in best[some]]
    return pa.table(
        {
            "word": pa.array([words[i] for i in some], pa.string()),
            "n_near": pa.array(counts[some]),
            "near": pa.array([words[i] for i in chosen], pa.string()),
            "near_n": pa.array(n[chosen] if len(chosen) else np.zeros(0, np.int64), pa.int64()),
        }
    )


def near_words(words: DataFrame, **limits: int) -> DataFrame:
    """``word, n_near, near, near_n`` of words with near ones: how many, and the one with the largest count.

    Ties go to the word that is smallest in code point order. ``words`` has distinct ``word`` and ``n``.
    """
    found = shards(words, **limits).groupBy(*SHARD).applyInArrow(
        _best_near, "word string, n_near bigint, near string, near_n bigint"
    )
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", F.col("best.word").alias("near"), (-F.col("best.n")).alias("near_n"))
    )


def last_of_chains(links: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: each word's last form. Links must not run in circles."""
    ends = written(links.select("word", F.col("form").alias("root")), "chains")
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = ends.join(further, "root", "left")
        ends = written(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "chains")
        if ends.where("moved").isEmpty():
            return ends.drop("moved")
        ends = ends.drop("moved")


def variants(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_length: int = 6,
    least_count: int = 5,
    ratio: int = 5,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words of at least ``least_length`` letters.

    ``form`` is the near word with the largest count, if that is at least ``ratio`` times the word's
    own, else null; ``root`` is what forms lead to. Counts grow along a chain, so it has an end.
    Repeated rows count as often as they stand in the table.
    """
    words = written(word_counts(docs, key, text, least_length, least_count), "words")
    near = written(near_words(words), "near-words")
    named = F.col("near_n") >= ratio * F.col("n")
    judged = written(
        words.join(near, "word", "left").select(
            "word",
            F.when(named, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(named, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = last_of_chains(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
