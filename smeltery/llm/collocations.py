"""Phrase collocations by Toivonen mining: a sample proposes, full passes count and close the border.

1. *Sample*: phrases that occur at least twice in a quarter of the documents are proposed. Proposals
   are closed downwards: a phrase is proposed only if its parts are.
2. *Full pass*: counts of all words, and of every phrase whose two parts (without its last and without
   its first word) are proposed. These are the proposals and their negative border.
3. *Expansion*: phrases of the border that turn out frequent are added to the proposals, and another
   pass counts what this adds to the border. Passes end when no frequent phrase is left outside.
4. *Texts*: passes count 64-bit codes. Two phrases with one code can only raise its count, so no
   frequent phrase is missed; phrases with a frequent code are then counted as text, exactly.
5. *Score*: the counts of a phrase's parts are joined to it, and arithmetic is in decimals of 38 digits.

Tasks know the proposals as one bitmap of ``PLACES`` bits a phrase length, whatever the corpus: a
phrase that shares a place with a proposal is counted too, which costs time and changes nothing. Each
phrase is counted in exactly one pass.

Null texts are empty, a null language is ``und``, repeated rows count as often as they stand in the
table, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.llm import texts
from smeltery.sources.folders import written

LONGEST = 3
#: Share of documents that propose phrases, and how often a phrase must occur among them.
SAMPLED = 0.25
PROPOSED = 2
#: Bits of a bitmap of proposals (8 MB).
PLACES = 1 << 26
#: Texts are counted in parts of about so many bytes.
CHUNK_BYTES = 1 << 21
#: Codes of a few parts that a task merges before it passes them on.
HELD_CODES = 1 << 20
#: Rows of a much-used part are dealt over so many groups of a join.
SALTS = 4
UNKNOWN = "und"

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 10
_PLAIN[9] = 32

#: For each length, a bitmap of the codes of phrases.
Bitmaps = dict[int, np.ndarray]


def _word_codes(words: pa.Array, lang: str) -> np.ndarray:
    """A hash of each word in its language, for places in bitmaps only."""
    data, bounds = texts.flat(words)
    own = np.uint64(xxhash.xxh64_intdigest(lang))
    return texts.mixed(texts.word_hashes(data, bounds[:-1], bounds[1:]) + own)


def _longer(codes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases that are one word longer."""
    return texts.mixed(codes * texts.FACTOR + words)


def _held(bitmap: np.ndarray, codes: np.ndarray) -> np.ndarray:
    place = codes & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def _parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text cut at ends of pieces, so that no phrase is cut."""
    start = 0
    while start < len(data):
        end = start + CHUNK_BYTES
        while end < len(data) and data[end - 1] != 10:
            near = np.flatnonzero(data[end : end + CHUNK_BYTES] == 10)
            end = end + int(near[0]) + 1 if len(near) else end + CHUNK_BYTES
        yield data[start:end]
        start = end


def _words(data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words, and for each whether it stands in one piece with the word before."""
    starts, ends, _ = texts.word_spans(data, np.array([0, len(data)]))
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    letters = data[(data != 32) & (data != 10)]
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))]
    )
    cuts = np.cumsum(data == 10, dtype=np.int32)
    joined = np.zeros(len(starts), bool)
    joined[1:] = cuts[starts[1:]] == cuts[ends[:-1] - 1]
    return words, joined


class _Part:
    """The words of one part, numbered, with a code each."""

    def __init__(self, data: np.ndarray, lang: str):
        words, self.joined = _words(data)
        coded = words.dictionary_encode()
        self.kinds, self.ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.kind_codes = _word_codes(self.kinds, lang)

    def phrases(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length from 2: codes of all runs of so many words, and whether they are in one piece."""
        codes = word_codes = self.kind_codes[self.ids]
        inside = np.ones(len(codes), bool)
        for size in range(2, longest + 1):
            codes = _longer(codes[:-1], word_codes[size - 1 :])
            inside = inside[:-1] & self.joined[size - 1 :]
            yield size, codes, inside


def _code_counts(
    data: np.ndarray, lang: str, now: Bitmaps | None, before: Bitmaps | None, longest: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Lengths, codes and counts: what ``now`` admits and ``before`` did not.

    Without ``now`` everything is admitted; without ``before``, words are counted as well.
    """
    part = _Part(data, lang)
    if not len(part.ids):
        return
    if before is None:
        yield 1, part.kind_codes, np.bincount(part.ids, minlength=len(part.kinds))
    fine = np.ones(len(part.ids), bool) if now is None else _held(now[1], part.kind_codes)[part.ids]
    old = np.zeros(len(part.ids), bool) if before is None else _held(before[1], part.kind_codes)[part.ids]
    for size, codes, inside in part.phrases(longest):
        fine, old = fine[:-1] & fine[1:] & inside, old[:-1] & old[1:] & inside
        yield size, *np.unique(codes[fine & ~old], return_counts=True)
        if size < longest:
            if now is not None:
                fine &= _held(now[size], codes)
            if before is not None:
                old &= _held(before[size], codes)


def _text_counts(data: np.ndarray, lang: str, wanted: Bitmaps) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Lengths, phrases and counts of what ``wanted`` holds; length 0 is the number of words."""
    part = _Part(data, lang)
    if not len(part.ids):
        return
    yield 0, pa.array([b""], pa.large_binary()), np.array([len(part.ids)])
    kept = _held(wanted[1], part.kind_codes)
    yield 1, part.kinds.filter(pa.array(kept)), np.bincount(part.ids, minlength=len(kept))[kept]
    fine = kept[part.ids]
    keys, radix = part.ids, len(part.kinds)
    for size, codes, inside in part.phrases(max(wanted)):
        fine = fine[:-1] & fine[1:] & inside & _held(wanted[size], codes)
        if radix > 2**62 // len(part.kinds):
            smaller, keys = np.unique(keys, return_inverse=True)
            radix = len(smaller)
        keys = keys[:-1] * len(part.kinds) + part.ids[size - 1 :]
        radix *= len(part.kinds)
        at = np.flatnonzero(fine)
        _, first, n = np.unique(keys[at], return_index=True, return_counts=True)
        said = [part.kinds.take(pa.array(part.ids[at[first] + i])) for i in range(size)]
        yield size, pc.binary_join_element_wise(*said, pa.scalar(b" ", pa.large_binary())), n


def _parts_of(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """Languages and parts of the texts of a batch of ``lang, text``."""
    langs = batch.column(0).dictionary_encode()
    for i, lang in enumerate(langs.dictionary.to_pylist()):
        for group in texts.groups(batch.filter(pc.equal(langs.indices, i)), 1, CHUNK_BYTES):
            data, bounds = texts.flat(group.column(1))
            # The end of a text ends its last piece.
            for part in _parts(np.insert(_PLAIN[data], bounds[1:], 10)):
                yield lang, part


def counted(docs: DataFrame, now: Bitmaps | None, before: Bitmaps | None, longest: int) -> DataFrame:
    """``code, n``: counts of the codes that one pass has to count; the last two bits are the length.

    Tasks merge equal codes of a few parts and then deal them by code: what most codes have is one or two
    occurrences, and a table of all codes of a task would save little and hold much.
    """
    most = HELD_CODES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size_held = 0

        def merged() -> pa.RecordBatch:
            codes, n = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(codes)
            codes, n = codes[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            columns = [pa.array(codes[first].view(np.int64)), pa.array(np.add.reduceat(n, first))]
            return pa.RecordBatch.from_arrays(columns, ["code", "n"])

        for batch in batches:
            for lang, part in _parts_of(batch):
                for size, codes, n in _code_counts(part, lang, now, before, longest):
                    if len(n):
                        held.append((codes << np.uint64(2) | np.uint64(size), n.astype(np.int64)))
                        size_held += len(n)
                if size_held >= most:
                    yield merged()
                    held, size_held = [], 0
        if held:
            yield merged()

    rows = docs.mapInArrow(run, "code bigint, n bigint")
    return rows.repartition("code").groupBy("code").agg(F.sum("n").alias("n"))


def spelled(docs: DataFrame, wanted: Bitmaps) -> DataFrame:
    """``lang, size, phrase, n``: exact counts of all phrases whose codes are wanted, and totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, part in _parts_of(batch):
                for size, phrases, n in _text_counts(part, lang, wanted):
                    columns = [
                        pa.repeat(pa.scalar(lang, pa.string()), len(n)),
                        pa.array(np.full(len(n), size, np.int32)),
                        phrases.cast(pa.large_string()).cast(pa.string()),
                        pa.array(n.astype(np.int64)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "n"])

    rows = docs.mapInArrow(run, "lang string, size int, phrase string, n bigint")
    return rows.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def _bitmaps(codes: DataFrame, longest: int) -> Bitmaps:
    """Bitmaps of ``code``: gathered on the cluster, at most 16 MB a length come to the driver."""
    place = F.shiftrightunsigned("code", 2).bitwiseAND(F.lit(PLACES - 1))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    out = {}
    for size in range(1, longest + 1):
        found = (
            codes.where(F.col("code").bitwiseAND(F.lit(3)) == size)
            .select(place.alias("place"))
            .groupBy((F.col("place") / 64).cast("int").alias("block"))
            .agg(F.bit_or(bit).alias("bits"))
            .toArrow()
        )
        out[size] = np.zeros(PLACES // 64, np.uint64)
        out[size][found.column("block").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def frequent_phrases(
    docs: DataFrame, least: int, key: str, text: str, lang: str, longest: int = LONGEST, sampled: float = SAMPLED
) -> DataFrame:
    """``lang, size, phrase, n``: all words and phrases with at least ``least`` occurrences, and totals.

    A row of size 0 holds the number of all words of a language.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.xxhash64(key, text).alias("place"),
    )
    sample = rows.where(F.pmod("place", F.lit(1 << 20)) < int(sampled * (1 << 20))).select("lang", "text")
    rows = rows.select("lang", "text")
    proposed = counted(sample, None, None, longest - 1).where(F.col("n") >= PROPOSED)
    now, before = _bitmaps(written(proposed, "proposals"), longest - 1), None
    frequent: Bitmaps = {}
    while True:
        passed = written(counted(rows, now, before, longest).where(F.col("n") >= least), "passes")
        found = _bitmaps(passed, longest)
        frequent = {size: bits | frequent.get(size, np.uint64(0)) for size, bits in found.items()}
        before, now = now, {size: now[size] | found[size] for size in now}
        if all(np.array_equal(now[size], before[size]) for size in now):
            break
    exact = spelled(rows, frequent).where((F.col("n") >= least) | (F.col("size") == 0))
    return written(exact, "phrases")


def _exact_share(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), for counts below 10^16."""
    a, left, right = (c.cast("decimal(16,0)") for c in (a, left, right))
    squared = (a * a).cast("decimal(32,0)")
    return F.call_function("div", (squared * F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(38,0)"), left * right)


def scored(counts: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the phrases that no longer phrase stands for.

    A phrase goes if a longer one holds it and has at least half its occurrences. The cut with the
    lowest score counts; ties go to the shortest first part.
    """
    phrases = counts.where("size > 1").select(
        "lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words")
    )
    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), k -> transform(sequence(1, size - k + 1), i -> array_join(slice(words, i, k), ' '))))"
    )
    longer = (
        phrases.where("size > 2")
        .select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    own = phrases.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a"))
    )
    cuts = F.expr(
        "transform(sequence(1, size - 1), k -> struct(k, array_join(slice(words, 1, k), ' ') as first,"
        " array_join(slice(words, k + 1, size - k), ' ') as rest))"
    )
    rows = own.select("lang", "phrase", "a", F.explode(cuts).alias("cut")).select(
        "lang", "phrase", "a", "cut.*", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt")
    )
    parts = counts.where(F.col("size").between(1, LONGEST - 1)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    for column, name in (("first", "l"), ("rest", "r")):
        side = parts.select("lang", "salt", F.col("phrase").alias(column), F.col("n").alias(name))
        rows = rows.join(side, ["lang", "salt", column])
    best = F.min(F.struct(_exact_share(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r"))
    return (
        rows.groupBy("lang", "phrase", "a")
        .agg(best.alias("best"))
        .select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    )


def collocations(
    docs: DataFrame,
    least: int = 10,
    top: int = 2_000,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    Ties go to the larger count, then to the phrase that is smaller in byte order.
    """
    counts = frequent_phrases(docs, least, key, text, lang)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored(counts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = counts.where("size = 0").select("lang", F.col("n").alias("total"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
