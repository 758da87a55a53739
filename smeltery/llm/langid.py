"""Language identification by a small byte convolutional network in numpy.

Bytes are embedded, convolved by filters of several widths, pooled by their maximum over a window of
fixed length, and weighed by a softmax. A text of any length is cut into windows that together cover
all of it; its language has the highest mean log probability over them, weighted by their bytes.

The network is trained on the driver with Adam on windows of a bounded sample: at most
``docs_per_language`` documents of each language, those of the smallest hashes of key and text, and at
most ``windows_per_doc`` windows of each. A document that repeats, or a key with many texts, counts by its
different texts. One count for each language comes to the driver. Neither key, language nor source is an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.llm import texts

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8  # of each width
DEPTH = 8  # of the byte embedding
SLACK = 4
#: Windows in one matrix product; keeps its operands in a processor's cache.
BLOCK = 64


@dataclass(frozen=True)
class Network:
    languages: tuple[str, ...]
    embedding: np.ndarray  # 256 x DEPTH
    filters: np.ndarray  # (widest * DEPTH) x all filters; zero beyond a filter's width
    offsets: np.ndarray
    weights: np.ndarray  # all filters x languages
    bias: np.ndarray

    def spread(self, windows: np.ndarray) -> np.ndarray:
        """What the filters see at each position: window, position, (widest * DEPTH)."""
        n, length = windows.shape
        seen = np.zeros((n, length, max(WIDTHS) * DEPTH), np.float32)
        embedded = self.embedding[windows]
        for i in range(max(WIDTHS)):
            seen[:, : length - i, i * DEPTH : (i + 1) * DEPTH] = embedded[:, i:]
        return seen

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        parts = [self._block(windows[i : i + BLOCK]) for i in range(0, len(windows), BLOCK)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)), np.float32)

    def _block(self, windows: np.ndarray) -> np.ndarray:
        seen = self.spread(windows)
        heard = (seen.reshape(-1, seen.shape[2]) @ self.filters).reshape(*windows.shape, -1)
        pooled = np.maximum(heard.max(axis=1) + self.offsets, 0)
        return log_softmax(pooled @ self.weights + self.bias)


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _filter_mask() -> np.ndarray:
    mask = np.zeros((max(WIDTHS) * DEPTH, len(WIDTHS) * FILTERS), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[: width * DEPTH, i * FILTERS : (i + 1) * FILTERS] = 1
    return mask


def fit(windows: np.ndarray, labels: np.ndarray, languages: tuple[str, ...], epochs: int = 6, seed: int = 7) -> Network:
    """Train on windows (bytes, zero-padded) and the index of each one's language."""
    rng = np.random.default_rng(seed)
    mask = _filter_mask()
    params = {
        "embedding": rng.normal(0, 0.5, (256, DEPTH)),
        "filters": rng.normal(0, 0.3, mask.shape) * mask,
        "offsets": np.zeros(mask.shape[1]),
        "weights": rng.normal(0, 0.3, (mask.shape[1], len(languages))),
        "bias": np.zeros(len(languages)),
    }
    params = {k: v.astype(np.float32) for k, v in params.items()}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    # Languages count alike, however many windows each has.
    share = np.bincount(labels, minlength=len(languages)).clip(1)
    importance = (len(labels) / len(languages) / share)[labels].astype(np.float32)
    step = 0
    for epoch in range(epochs):
        rate = 0.01 * 0.5 ** max(0, epoch - epochs // 2)
        for batch in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // BLOCK)):
            step += 1
            grads = _gradients(params, languages, windows[batch], labels[batch], importance[batch])
            grads["filters"] *= mask
            for name, grad in grads.items():
                mean, square = moments[name]
                mean += 0.1 * (grad - mean)
                square += 0.001 * (grad * grad - square)
                size = np.sqrt(square / (1 - 0.999**step)) + 1e-8
                params[name] -= (rate * mean / (1 - 0.9**step) / size).astype(np.float32)
    return Network(languages, **params)


def _gradients(params: dict, languages, windows: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> dict:
    net = Network(languages, **params)
    seen = net.spread(windows)
    n, length, wide = seen.shape
    heard = (seen.reshape(-1, wide) @ net.filters).reshape(n, length, -1)
    best = heard.argmax(axis=1)  # only the pooled position passes a gradient back
    pooled = np.take_along_axis(heard, best[:, None], 1)[:, 0] + net.offsets
    active = np.maximum(pooled, 0)
    wrong = np.exp(log_softmax(active @ net.weights + net.bias))
    wrong[np.arange(n), labels] -= 1
    wrong *= (importance / n)[:, None]
    back = (wrong @ net.weights.T) * (pooled > 0)
    rows = np.arange(n)[:, None]
    inputs = seen[rows, best]  # window, filter, input
    grad_inputs = (back[:, :, None] * net.filters.T[None]).reshape(n, -1, max(WIDTHS), DEPTH)
    places = best[:, :, None] + np.arange(max(WIDTHS))
    inside = places < length
    values = windows[rows[:, :, None], np.minimum(places, length - 1)]
    embedding = np.zeros_like(net.embedding)
    np.add.at(embedding, values[inside], grad_inputs[inside])
    return {
        "embedding": embedding,
        "filters": np.einsum("nf,nfi->if", back, inputs),
        "offsets": back.sum(axis=0),
        "weights": active.T @ wrong,
        "bias": wrong.sum(axis=0),
    }


def cut(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over all bytes of each text, the text each belongs to, and its number of bytes."""
    sizes = np.diff(bounds)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = bounds[:-1][owner] + number * WINDOW
    lengths = np.minimum(bounds[1:][owner] - starts, WINDOW)
    places = starts[:, None] + np.arange(WINDOW)
    out = np.where(np.arange(WINDOW) < lengths[:, None], data[np.minimum(places, len(data) - 1)], 0)
    return out.astype(np.uint8), owner, lengths


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    docs_per_language: int = 500,
    windows_per_doc: int = 6,
) -> Network | None:
    """A network for the languages of ``docs``; None where no text with letters has one."""
    name = F.col(language).cast("string")
    value = F.col(text).cast("string")
    labelled = docs.where(F.col(language).isNotNull() & has_letters(value))
    counts = {r[0]: r[1] for r in labelled.groupBy(name).count().collect()}  # one row a language
    if not counts:
        return None
    # A document that repeats has one hash and counts once; of n rows, SLACK times the sample pass the
    # first look, and the smallest hashes of them stay, so that the bound holds however often one repeats.
    sample_hash = F.xxhash64(F.lit("sample"), F.col(key), value)
    part = F.lit(1.0)
    for lang, n in counts.items():
        part = F.when(name == lang, min(1.0, SLACK * docs_per_language / n)).otherwise(part)
    chance = F.pmod(sample_hash, F.lit(1 << 30)) / float(1 << 30)
    smallest = Window.partitionBy("lang").orderBy(F.pmod("picked", F.lit(1 << 30)), "picked")
    sample = (
        labelled.where(chance < part)
        .select(
            name.alias("lang"), sample_hash.alias("picked"), F.xxhash64(F.lit("crop"), F.col(key), value).alias("seed"),
            value.alias("text"),
        )
        .dropDuplicates(["lang", "picked"])
        .withColumn("place", F.row_number().over(smallest))
        .where(F.col("place") <= docs_per_language)
        .select("lang", "seed", "text")
    )

    def crops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, found = [], []
            for lang, seed, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rng = np.random.default_rng(seed % 2**63)
                value = value.encode()
                for _ in range(min(windows_per_doc, 1 + len(value) // WINDOW)):
                    # One in three is shorter, as short texts are.
                    size = WINDOW if rng.random() < 2 / 3 else int(rng.integers(24, WINDOW))
                    start = int(rng.integers(0, max(1, len(value) - size)))
                    langs.append(lang)
                    found.append(value[start : start + size])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], ["lang", "window"])

    rows = sample.mapInArrow(crops, "lang string, window binary").distinct().collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.window)))
    languages = tuple(sorted(counts))
    windows = np.zeros((len(rows), WINDOW), np.uint8)
    for i, r in enumerate(rows):
        windows[i, : len(r.window)] = np.frombuffer(r.window, np.uint8)
    labels = np.array([languages.index(r.lang) for r in rows], np.int64)
    return fit(windows, labels, languages)


def predict(
    docs: DataFrame,
    network: Network | None,
    text: str = "text",
    into: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """``docs`` with the language and its score (0 to 1) added or replaced.

    Texts that are null or have no letters are ``und`` with score 0; so is every text where there is
    no network. Rows and other columns stay as they are; an empty table stays empty.
    """
    docs = docs.drop(*into)
    place = docs.columns.index(text)
    names = [*docs.columns, *into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = pc.match_substring_regex
        for whole in batches:
            for batch in texts.groups(whole, whole.schema.names[place]):
                n = batch.num_rows
                column = batch.column(place)
                best, score = np.zeros(n, np.int64), np.zeros(n)
                known = pc.fill_null(letters(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
                data, bounds = texts.flat(column)
                if network is not None and len(data):
                    windows, owner, sizes = cut(data, bounds)
                    logs = network.log_probabilities(windows).astype(np.float64) * sizes[:, None]
                    sums = np.zeros((n, len(network.languages)))
                    np.add.at(sums, owner, logs)
                    chances = np.exp(log_softmax(sums / np.maximum(np.diff(bounds), 1)[:, None]))
                    best, score = chances.argmax(axis=1), chances.max(axis=1)
                else:
                    known = np.zeros(n, bool)
                tongue = [network.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                score = pa.array(np.where(known, score, 0.0))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tongue, pa.string()), score], names)

    schema = T.StructType([*docs.schema.fields])
    return docs.mapInArrow(run, schema.add(into[0], T.StringType()).add(into[1], T.DoubleType()))
