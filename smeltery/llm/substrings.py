"""Repeated word sequences: suffix automata of reference shards, matching statistics of documents.

A word goes when a window of ``window`` words that covers it also starts earlier in the table: in a
document with a smaller key, or before in the same one. See ``anchors`` for how equal windows come
into one shard and why an automaton never needs more than the shard's texts.

Within a shard the texts stream past the automaton in the order of the table. Each word extends the
longest suffix that the automaton knows (its matching statistic); where that suffix has at least a
window's length, the window that ends there was seen before. What is new in a text is then added.
Automata go to the texts that can match them and to no others; sending each to every document would
read the corpus once for every shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from smeltery.llm import anchors, shards

WINDOW = 20
GRAM = 8


class SuffixAutomaton:
    """Of all word sequences added; a sequence never runs over the end of a text."""

    def __init__(self) -> None:
        self.step: list[dict] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]

    def _state(self, step: dict, link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, state: int, word, target: int) -> int:
        """The part of ``target`` that is one word longer than ``state``, as a state of its own."""
        step, link, length = self.step, self.link, self.length
        clone = self._state(dict(step[target]), link[target], length[state] + 1)
        link[target] = clone
        while state != -1 and step[state].get(word) == target:
            step[state][word] = clone
            state = link[state]
        return clone

    def _extend(self, last: int, word) -> int:
        step, link, length = self.step, self.link, self.length
        target = step[last].get(word)
        if target is not None:
            return target if length[target] == length[last] + 1 else self._split(last, word, target)
        made = self._state({}, 0, length[last] + 1)
        while last != -1 and word not in step[last]:
            step[last][word] = made
            last = link[last]
        if last != -1:
            target = step[last][word]
            whole = length[target] == length[last] + 1
            link[made] = target if whole else self._split(last, word, target)
        return made

    def add(self, words: list) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def statistics(self, words: list) -> list[int]:
        """For each word, the length of the longest known sequence that ends with it."""
        step, link, length = self.step, self.link, self.length
        state, size, out = 0, 0, []
        for word in words:
            while state and word not in step[state]:
                state = link[state]
                size = length[state]
            following = step[state].get(word)
            if following is not None:
                state, size = following, size + 1
            out.append(size)
        return out


def judge_shard(segments: list, window: int) -> Iterator[tuple[int, int, int, int]]:
    """Maximal stretches of words (rank, twin, first, size) whose windows start earlier in the shard."""
    automaton = SuffixAutomaton()
    for _, rank, twin, first, windows, units in segments:
        words = units.split(b" ")
        known = automaton.statistics(words)
        start = None
        for i in range(windows):
            if known[i + window - 1] >= window:
                start = i if start is None else start
                continue
            if start is not None:
                yield rank, twin, first + start, i - start + window - 1
            start = None
        if start is not None:
            yield rank, twin, first + start, windows - start + window - 1
        if start != 0:  # else there is nothing new in it
            automaton.add(words)


def _kept(text: bytes, removed: np.ndarray) -> tuple:
    words = text.split()
    kept = b" ".join(w for w, gone in zip(words, removed.tolist()) if not gone)
    return len(words), int(removed.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()


def deduplicate(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """``key, n_words, n_removed, kept_sha256, kept`` for each row: ``kept`` are the words that stay.

    Words are ``[^\\x20\\x09-\\x0D]+``; kept ones are joined by one blank. Null and empty texts have
    none. Texts shorter than a window stay whole. Rows that repeat a key with another text are
    documents of their own, ordered by a hash of the text; rows that repeat both are one document and
    get the same result. A null key comes before all others. An empty table gives an empty table.
    """
    cut = anchors.Cut(words=True, window=window, gram=gram)
    own = anchors.documents(docs, key, text)

    def judge(disputed: DataFrame) -> DataFrame:
        return shards.in_shards(
            disputed, lambda shard: judge_shard(shard, window), "rank bigint, twin bigint, first bigint, size bigint"
        )

    spans = anchors.later_spans(own, cut, judge)
    schema = "n_words bigint, n_removed bigint, kept_sha256 string, kept string"
    return anchors.without_later(own, key, spans, schema, _kept, lambda t: len(t.split()))
