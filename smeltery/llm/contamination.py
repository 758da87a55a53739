"""Benchmark items inside documents: latent semantic retrieval, then subsequence and answer checks.

Words are compared without case and ASCII punctuation. The benchmark is the query set; it is read to
the driver in blocks that end with the item that brings them to ``BLOCK_WORDS`` words, each with tables
bounded by these words. A block's items are of like length: at most 64 words, 128, 256 and so on. For
each block, three passes over all documents:

1. *Document frequencies* of the block's words. Each item leaves out its commonest words, as long as
   they are at most ``LEFT_OUT`` of it. That is less than ``SIMILAR``: whatever keeps ``SIMILAR`` of the
   item holds some of the other words, so no passage that counts is lost.
2. *Randomised SVD*: passages are runs of three blocks of words, each next one a block further; a block
   is half as long as the items of the class may be. With A the TF-IDF matrix of all passages (over the
   terms kept) and B that of the items, tasks add up ``A'A`` times a random matrix; the driver adds
   ``B'B`` times the same and takes the ``LATENT`` first singular vectors of the small sketch.
3. *Search*: every passage is compared with every item by the cosine of their latent vectors, and is a
   candidate from the item's own bound on: the cosine that the lightest subsequence which counts still
   has among other words of the mean weight of a passage. Words are the audit: a passage that keeps
   ``SIMILAR`` of an item has so many of its words, less those of the terms not kept. Candidates without
   them are not read, as they cannot hold the item; passages with them are read although the cosine
   left them out, and their finds are marked as not ``retrieved``. Reading goes word by word: the longest
   common subsequence with the item, and with its answer.

An item's answer is what follows ``answer`` and a colon, or else its last fifth. A document holds an
item when a stretch of a passage keeps ``SAME`` of the item in order, or ``SIMILAR`` of the item and of its
answer; a stretch has at most ``SPAN`` times the words of the item. An item of fewer than ``WHOLE`` words
is held only as a whole, word after word, and one of fewer than ``FEWEST`` by nothing: its words are common
phrases that tell nothing about the benchmark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm import texts
from smeltery.llm.words import Terms, hashes_of, plain_words, words_of

BLOCK_WORDS = 1 << 16
LATENT = 128
OVERSAMPLING = 16
#: Items and terms of passages are met so many at a time.
MET = 1 << 22
SAME = 0.8
SIMILAR = 0.6
#: Must be less than SIMILAR; a smaller share reads fewer passages and meets more common words.
LEFT_OUT = 0.5
#: Words in order must lie within so many times the item's words.
SPAN = 2
#: Items of fewer words must be found whole; those of fewer than a shingle are not searched.
WHOLE = 10
FEWEST = 5


def common_subsequence(masks: dict, size: int, words) -> int:
    """Length of the longest common subsequence; ``masks`` has the places of each word as bits."""
    full = (1 << size) - 1
    row = full
    for word in words:
        match = masks.get(word)
        if match is not None:
            both = row & match
            row = ((row + both) | (row - both)) & full
    return size - row.bit_count()


def _masks(words) -> dict:
    masks: dict = {}
    for i, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


@dataclass(frozen=True)
class Item:
    item_id: int
    words: list[int]  # hashes
    masks: dict
    answer: list[int]
    answer_masks: dict


def make_item(item_id: int, text: str) -> Item | None:
    words = hashes_of(plain_words(text)).tolist()
    if len(words) < FEWEST:
        return None
    cue = re.search(r"answer\s*:(.*)", text, re.I | re.S)
    answer = hashes_of(plain_words(cue[1])).tolist() if cue else []
    answer = answer or words[-max(1, len(words) // 5) :]
    return Item(item_id, words, _masks(words), answer, _masks(answer))


def shares_in(item: Item, read: list[int]) -> tuple[float, float] | None:
    """Shares of the item and of its answer in the best stretch of ``read``; None where it is not held."""
    size = len(item.words)
    if size < WHOLE:
        whole = any(read[i : i + size] == item.words for i in range(len(read) - size + 1))
        return (1.0, 1.0) if whole else None
    # Other words do not count, but they do take room.
    told = [(i, w) for i, w in enumerate(read) if w in item.masks]
    words, best = [w for _, w in told], None
    if common_subsequence(item.masks, size, words) / size < SIMILAR:
        return None
    low = high = 0
    while low < len(told) and high < len(told):
        while high < len(told) and told[high][0] < told[low][0] + SPAN * size:
            high += 1
        share = common_subsequence(item.masks, size, words[low:high]) / size
        if share >= SIMILAR:
            answer = common_subsequence(item.answer_masks, len(item.answer), words[low:high]) / len(item.answer)
            if share >= SAME or answer >= SIMILAR:
                best = max(best or (share, answer), (share, answer))
        # The next stretch that is not a part of this one begins where one more word fits.
        while high < len(told) and told[high][0] >= told[low][0] + SPAN * size:
            low += 1
    return best


def _frequencies(docs: DataFrame, terms: Terms) -> tuple[int, np.ndarray]:
    """Number of documents, and of those that hold each term."""
    size = len(terms.hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size + 1, np.int64)
        for whole in batches:
            for batch in texts.groups(whole, "text"):
                words, first = words_of(batch.column(0))
                places, term = terms.find(words)
                doc = np.searchsorted(first, places, "right") - 1
                held = np.unique(doc * size + term) % size
                counts[:size] += np.bincount(held, minlength=size)
                counts[size] += batch.num_rows
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["term", "n"])

    found = docs.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    counts = np.zeros(size + 1, np.int64)
    for term, n in found.collect():  # at most one row for each term
        counts[term] = n
    return int(counts[size]), counts[:size]


@dataclass(frozen=True)
class _Passages:
    """Passages that hold terms, and the blocks of words that they are made of.

    A passage is its first block and the two after it; ``parts`` says which of the blocks with terms
    these are, and for each block ``within`` says which passages it is in (one past the end: none).
    """

    heads: np.ndarray  # where the terms of each block begin, among all terms found
    block: np.ndarray  # of each term found
    doc: np.ndarray  # of each passage
    at: np.ndarray  # number of each passage's first block
    parts: np.ndarray
    within: np.ndarray


def _passages(places: np.ndarray, first: np.ndarray, size: int) -> _Passages:
    """Of terms found at ``places``, in blocks of ``size`` words."""
    doc = np.searchsorted(first, places, "right") - 1
    # Numbers of all blocks, with room for two before each document's first.
    most = int(np.diff(first).max()) // size + 3
    number = doc * most + (places - first[doc]) // size + 2
    heads = np.flatnonzero(np.diff(number, prepend=-1))
    blocks = number[heads]
    starts = np.unique(np.concatenate((blocks, blocks - 1, blocks - 2)))
    starts = starts[starts % most >= 2]

    def find(sought: np.ndarray, among: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(among, sought), len(among) - 1)
        return np.where(among[at] == sought, at, len(among))

    three = np.arange(3)
    return _Passages(
        heads, np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(places)))),
        starts // most, starts % most - 2,
        find(starts[:, None] + three, blocks), find(blocks[:, None] - three, starts),
    )


def _three(rows: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Sums of up to three rows; an index past the end adds nothing."""
    out = np.zeros((len(index), rows.shape[1]), rows.dtype)
    for part in index.T:
        some = np.flatnonzero(part < len(rows))
        out[some] += rows[part[some]]
    return out


def _sketch(docs: DataFrame, terms: Terms, test: np.ndarray, block: int) -> tuple[np.ndarray, float]:
    """``T'T test`` with T the term counts of all passages, added up over tasks, and their number."""
    size, width = test.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(test.shape, np.float64)
        passages = 0
        for whole in batches:
            for batch in texts.groups(whole, "text"):
                words, first = words_of(batch.column(0))
                places, term = terms.find(words)
                if not len(places):
                    continue
                found = _passages(places, first, block)
                passages += len(found.doc)
                heard = _three(np.add.reduceat(test[term], found.heads, axis=0), found.parts)
                back = _three(heard, found.within)
                order = np.argsort(term, kind="stable")
                heads = np.flatnonzero(np.diff(term[order], prepend=-1))
                total[term[order][heads]] += np.add.reduceat(back[found.block[order]], heads, axis=0)
        some = np.append(np.flatnonzero(total.any(axis=1)), size)  # the number of passages comes last
        rows = [total[i].astype("<f4").tobytes() for i in some[:-1]] + [np.array([passages], "<f4").tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(rows, pa.binary())], ["term", "part"])

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in parts:
            for term, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                row = np.frombuffer(part.as_py(), "<f4").astype(np.float64)
                sums[term] = sums[term] + row if term in sums else row
        rows = [v.astype("<f8").tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(rows, pa.binary())], ["term", "part"])

    parts = docs.mapInArrow(run, "term bigint, part binary")
    sums = parts.repartition(16, "term").mapInArrow(add, "term bigint, part binary")
    found = {term: np.frombuffer(part, "<f8") for term, part in sums.collect()}  # one row for each term
    passages = float(found.pop(size, np.zeros(1))[0])
    total = np.zeros((size, width))
    for term, part in found.items():
        total[term] = part
    return total, passages


def latent_basis(sketch: np.ndarray, test: np.ndarray) -> np.ndarray:
    """Singular vectors of a matrix M, from ``M test`` with M symmetric and without negative values."""
    core = test.T @ sketch
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > values.max(initial=0) * 1e-10
    root = sketch @ (vectors[:, good] / np.sqrt(values[good]))
    left, singular, _ = np.linalg.svd(root, full_matrices=False)
    return left[:, singular > singular.max(initial=0) * 1e-5]


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(size > 0, size, 1)


def least_words(size: int) -> int:
    """Words of an item of ``size`` words that a subsequence of the share ``SIMILAR`` has."""
    return next(n for n in range(int(SIMILAR * size), size + 1) if n / size >= SIMILAR)


def _least_cosine(
    latent: np.ndarray, count: np.ndarray, rarity: np.ndarray, words: float, target: np.ndarray, mean_square: float
) -> float:
    """Cosine with ``target`` of an item's lightest ``words`` words, given by term, beside a passage of mean weight."""
    order = np.argsort(rarity, kind="stable")
    held = np.clip(words - (np.cumsum(count[order]) - count[order]), 0, count[order])
    kept = held @ latent[order].astype(np.float64)
    return float(kept @ target / np.sqrt(max(kept @ kept + mean_square, 1e-12)))


def _searcher(docs: DataFrame, items: list[Item], block: int):
    """A function that finds items in a column of texts; ``docs`` have the corpus as ``text``."""
    everything = Terms.of(np.array([w for i in items for w in i.words], np.uint64))
    n_docs, held = _frequencies(docs, everything)
    rarity = np.log((n_docs + 1) / (held + 1)) + 1e-3
    kept = []
    for item in items:
        own, count = np.unique(np.array(item.words, np.uint64), return_counts=True)
        order = np.argsort(-held[np.searchsorted(everything.hashes, own)], kind="stable")  # commonest first
        most = min(LEFT_OUT * len(item.words), least_words(len(item.words)) - 1)
        kept.append(own[order[np.cumsum(count[order]) > most]])
    terms = Terms.of(np.concatenate(kept))
    rarity = rarity[np.searchsorted(everything.hashes, terms.hashes)]
    size = len(terms.hashes)

    known = np.zeros((len(items), size))
    meeting = []  # term, item, kept words of the item that are the term
    for number, (item, own) in enumerate(zip(items, kept)):
        words = np.array(item.words, np.uint64)
        term = terms.find(words)[1]
        np.add.at(known[number], term, rarity[term])
        term, count = np.unique(terms.find(words[np.isin(words, own)])[1], return_counts=True)
        meeting.append((term, np.full(len(term), number), count))
    in_term, in_item, in_count = (np.concatenate(x) for x in zip(*meeting))
    dropped = np.array([len(i.words) for i in items]) - np.bincount(in_item, in_count)
    least = np.array([least_words(len(i.words)) for i in items]) - dropped
    order = np.argsort(in_term, kind="stable")
    in_item, in_count = in_item[order], in_count[order]
    edges = np.searchsorted(in_term[order], np.arange(size + 1))
    test = np.random.default_rng(11).normal(size=(size, min(size, LATENT + OVERSAMPLING)))
    counted, passages = _sketch(docs, terms, (rarity[:, None] * test).astype(np.float32), block)
    corpus = rarity[:, None] * counted
    # The test matrix is of unit variance: this is the mean square of a passage's length.
    mean_square = max(0.0, np.vdot(test, corpus)) / test.shape[1] / max(passages, 1.0)
    own = known.T @ (known @ test)
    # The items weigh as much as the strongest direction of the corpus.
    own *= max(1.0, np.linalg.norm(corpus) / max(np.linalg.norm(own), 1e-9))
    basis = latent_basis(corpus + own, test)[:, :LATENT]
    targets = _unit(_unit(known) @ basis)
    latent = (rarity[:, None] * basis).astype(np.float32)
    bound = np.array([
        _least_cosine(latent[term], count, rarity[term], n, target, mean_square)
        for (term, _, count), n, target in zip(meeting, least, targets)
    ], np.float32)
    targets = targets.astype(np.float32)

    def candidates(found: _Passages, term: np.ndarray) -> Iterator[tuple[int, int, float, bool]]:
        """Passages and items to read, with the cosine; those below the item's bound come from the audit."""
        heard = np.add.reduceat(latent[term], found.heads, axis=0)
        inside = found.within[found.block]
        some = inside < len(found.doc)
        passage, held = np.divmod(np.unique(inside[some] * size + np.repeat(term, 3).reshape(-1, 3)[some]), size)
        meets = edges[held + 1] - edges[held]
        ends = np.append(np.flatnonzero(np.diff(passage)) + 1, len(passage))
        load = np.cumsum(meets)[ends - 1] + np.arange(1, len(ends) + 1) * len(items)
        low = done = 0
        while low < len(ends):
            high = max(low + 1, int(np.searchsorted(load, done + MET, "right")))
            some = slice(ends[low - 1] if low else 0, ends[high - 1])
            n, head = meets[some], edges[held[some]]
            at = np.repeat(head - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            base = int(passage[some.start])
            place = np.repeat(passage[some] - base, n) * len(items) + in_item[at]
            rows = int(passage[some.stop - 1]) - base + 1
            words = np.bincount(place, in_count[at], rows * len(items)).reshape(rows, len(items))
            cosine = _unit(_three(heard, found.parts[base : base + rows])) @ targets.T
            near, able = cosine >= bound, words >= least
            for audit, chosen in ((False, near & able), (True, able & ~near)):
                where, number = np.nonzero(chosen)
                for w, n in zip(where.tolist(), number.tolist()):
                    yield w + base, n, float(cosine[w, n]), not audit
            low, done = high, int(load[high - 1])

    def held_by(column: pa.Array) -> dict[tuple[int, int], tuple]:
        """Shares, cosine and whether retrieved, of the best passage for each text and item that it holds."""
        words, first = words_of(column)
        places, term = terms.find(words)
        best: dict[tuple[int, int], tuple] = {}
        if not len(places):
            return best
        found = _passages(places, first, block)
        for where, number, cosine, retrieved in candidates(found, term):
            d, item = int(found.doc[where]), items[number]
            start = int(first[d] + found.at[where] * block)
            passage = words[start : min(start + 3 * block, int(first[d + 1]))]
            held = shares_in(item, passage.tolist())
            if held:
                shares = (*held, cosine, retrieved)
                best[d, number] = max(best.get((d, number), shares), shares)
        return best

    return held_by


def half_longest(size: int) -> int:
    """Words in a block of passages for items of ``size`` words: 32, 64, 128 and so on."""
    return 1 << max(5, (size - 1).bit_length() - 1)


def _searchers(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str) -> Iterator:
    """One for each block of items, and its items; the query set is read a block at a time."""
    corpus, held = docs.select(F.col(text).cast("string").alias("text")), {}
    for number, value in benchmark.select(F.col(item).cast("bigint"), F.col(item_text).cast("string")).toLocalIterator():
        made = make_item(number, value or "")
        if not made:
            continue
        block = half_longest(len(made.words))
        held.setdefault(block, []).append(made)
        if sum(len(i.words) for i in held[block]) >= BLOCK_WORDS:
            yield _searcher(corpus, held[block], block), held.pop(block)
    for block, items in sorted(held.items()):
        yield _searcher(corpus, items, block), items


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``key, item_id, lcs_share, answer_share, cosine, retrieved`` for each row of ``docs`` and item it holds.

    Shares and cosine are those of the document's best passage; ``retrieved`` says whether the cosine made it
    a candidate, or the audit by words did. Null and blank texts hold nothing;
    null or blank items, and those of fewer than ``FEWEST`` words, are held by nothing. A repeated row gives its results again; items that
    repeat give one result each. An empty table on either side gives an empty result.
    """
    names = [key, "item_id", "lcs_share", "answer_share", "cosine", "retrieved"]
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, item_id bigint, lcs_share double, answer_share double, cosine double, retrieved boolean"
    rows = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("text"))
    result = docs.sparkSession.createDataFrame([], schema)
    for held_by, items in _searchers(docs, benchmark, text, item, item_text):

        def run(batches: Iterator[pa.RecordBatch], held_by=held_by, items=items) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in texts.groups(whole, "text"):
                    best, ids = held_by(batch.column(1)), batch.column(0)
                    out = [(ids[d].as_py(), items[n].item_id, *found) for (d, n), found in sorted(best.items())]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out)], names)

        result = result.unionByName(rows.mapInArrow(run, schema))
    return result


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    place, result = docs.columns.index(text), docs
    for held_by, _ in _searchers(docs, benchmark, text, item, item_text):

        def run(batches: Iterator[pa.RecordBatch], held_by=held_by) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in texts.groups(whole, text):
                    clean = np.ones(batch.num_rows, bool)
                    clean[[d for d, _ in held_by(batch.column(place))]] = False
                    yield batch.filter(pa.array(clean))

        result = result.mapInArrow(run, docs.schema)
    return result
