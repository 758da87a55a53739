"""SentencePiece: sampled segmentations, drawn exactly, and lossless decoding.

A text gets a leading blank and becomes *chunks*: blanks with what follows them up to the next blank;
a character without a piece of its own is a chunk that is spelled by bytes. No piece crosses the
bounds of a chunk, so the lattice of a text is the chain of its chunks' lattices.

*Forward filtering*: for each end inside a chunk, the total weight of all segmentations up to there,
where a piece weighs ``exp(score * sharpness)``. *Backward sampling*: from the end of a chunk, the
last piece is drawn in proportion to its share of that weight, then the one before, to the start:
an exact draw from all segmentations. Random numbers are hashes of seed, row key and place, so a row
gets the same pieces in any partition, order or company.

Lattices are filled once for each distinct chunk of a group of texts; draws are made for all its
occurrences at once. The model is read on the driver; its tables (about 1 MB) go with the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.llm import texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SEED = 1
SHARPNESS = 1 / 2000
BLANK = "▁"  # how the model writes a blank


@dataclass(frozen=True)
class Model:
    hashes: np.ndarray  # of the pieces' characters, sorted
    ids: np.ndarray
    weights: np.ndarray  # logarithms
    filter: np.ndarray  # by the last 22 bits of a hash: whether any piece has them
    slots: np.ndarray  # by the first 20 bits of a hash: a piece that has them
    single: np.ndarray  # by code point: whether it is a piece
    longest: int
    byte_ids: np.ndarray
    spelled: np.ndarray  # bytes of all pieces, one after the other
    spelled_at: np.ndarray  # where each piece's bytes begin (one more at the end)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` that are pieces, and which."""
        likely = np.flatnonzero(_flag(self.filter, (hashes & np.uint64((1 << 22) - 1)).astype(np.int64)))
        hashes = hashes[likely]
        at = self.slots[(hashes >> np.uint64(44)).astype(np.int64)]
        other = np.flatnonzero(self.hashes[at] != hashes)  # a piece with the same bits, or none
        at[other] = np.minimum(np.searchsorted(self.hashes, hashes[other]), len(self.hashes) - 1)
        real = self.hashes[at] == hashes
        return likely[real], at[real]


def _grown(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of strings one character longer."""
    return hashes * texts.FACTOR + codes


def _codes(points: np.ndarray) -> np.ndarray:
    return texts.mixed(points.astype(np.uint64) + np.uint64(1))


def load(path: str = MODEL, sharpness: float = SHARPNESS) -> Model:
    source = sentencepiece.SentencePieceProcessor(model_file=path)
    size = source.vocab_size()
    spelled, byte_ids, plain = [], np.zeros(256, np.int32), []
    for i in range(size):
        piece = source.id_to_piece(i)
        if source.is_byte(i):
            spelled.append(bytes([int(piece[3:-1], 16)]))
            byte_ids[spelled[-1][0]] = i
        elif source.is_control(i) or source.is_unknown(i) or source.is_unused(i):
            spelled.append(b"")
        else:
            text = piece.replace(BLANK, " ")
            spelled.append(text.encode())
            plain.append((i, text, max(source.get_score(i), -1e6) * sharpness))
    single = np.zeros(0x110000, bool)
    single[[ord(t) for _, t, _ in plain if len(t) == 1]] = True
    # A blank inside a piece would join chunks.
    plain = [p for p in plain if " " not in p[1].lstrip(" ")]
    hashes = np.zeros(len(plain), np.uint64)
    for i in range(max(len(t) for _, t, _ in plain)):
        some = np.array([n for n, (_, t, _) in enumerate(plain) if len(t) > i])
        points = np.array([ord(plain[n][1][i]) for n in some])
        hashes[some] = _grown(hashes[some], _codes(points))
    order = np.argsort(hashes)
    some = np.zeros(1 << 22, bool)
    some[(hashes & np.uint64(len(some) - 1)).astype(np.int64)] = True
    slots = np.zeros(1 << 20, np.int32)
    slots[(hashes[order] >> np.uint64(44)).astype(np.int64)] = np.arange(len(order))
    return Model(
        hashes=hashes[order],
        ids=np.array([i for i, _, _ in plain], np.int32)[order],
        weights=np.array([w for _, _, w in plain], np.float32)[order],
        filter=np.packbits(some),
        slots=slots,
        single=np.packbits(single),
        longest=max(len(t) for _, t, _ in plain),
        byte_ids=byte_ids,
        spelled=np.frombuffer(b"".join(spelled), np.uint8),
        spelled_at=np.concatenate(([0], np.cumsum([len(s) for s in spelled]))),
    )


def _flag(bits: np.ndarray, index: np.ndarray) -> np.ndarray:
    return (bits[index >> 3] >> (7 - (index & 7)).astype(np.uint8) & 1).astype(bool)


def _lattice(model: Model, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the last piece's lengths at each end, summed up, and the pieces' ids.

    ``codes`` are the characters of chunks of one length. Both results are by chunk, end and piece
    length.
    """
    count, length = codes.shape
    most = min(length, model.longest)
    weights = np.full((count, length, most), -np.inf, np.float32)
    ids = np.zeros(weights.shape, np.int32)
    hashes = np.zeros((count, length + 1), np.uint64)
    for size in range(1, most + 1):
        hashes = _grown(hashes[:, :-1], codes[:, size - 1 :])
        places, found = model.find(hashes.ravel())
        chunk, start = np.divmod(places, length - size + 1)
        weights[chunk, start + size - 1, size - 1] = model.weights[found]
        ids[chunk, start + size - 1, size - 1] = model.ids[found]
    total = np.zeros((count, length + 1), np.float32)
    shares = np.ones(weights.shape, np.float32)
    for end in range(1, length + 1):
        sizes = min(end, most)
        x = weights[:, end - 1, :sizes] + total[:, end - sizes : end][:, ::-1]
        top = x.max(axis=1, keepdims=True)
        x = np.cumsum(np.exp(x - top), axis=1)
        total[:, end] = top[:, 0] + np.log(x[:, -1])
        shares[:, end - 1, :sizes] = x / x[:, -1:]
    return shares, ids


def encode_group(model: Model, values: list[str | None], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and where each text's begin (one more at the end)."""
    values = [" " + v if v else "" for v in values]
    sizes = np.array([len(v) for v in values], np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    points = np.frombuffer("".join(values).encode("utf-32-le"), np.uint32)
    total = len(points)
    if not total:
        return np.zeros(0, np.int32), np.zeros(len(values) + 1, np.int64)
    own = _flag(model.single, points.astype(np.int64))
    blank = points == 32
    begins = ~own
    begins[1:] |= ~own[:-1] | (blank[1:] & ~blank[:-1])
    begins[bounds[:-1][sizes > 0]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], total)
    codes = _codes(points)
    sums = texts.span_sums(codes)
    found = np.full(total, -1, np.int64)
    lone = ~own[starts]
    found[starts[lone]] = -2 - points[starts[lone]].astype(np.int64)
    starts, ends = starts[~lone], ends[~lone]
    _, example, chunk = np.unique(texts.sum_hashes(sums, starts, ends), return_index=True, return_inverse=True)
    doc = np.searchsorted(bounds, starts, "right") - 1
    keys = keys.astype(np.uint64)[doc]
    place = starts - bounds[doc]
    lengths = ends - starts
    by_length = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[by_length], prepend=-1, append=-1))
    for low, high in zip(edges[:-1], edges[1:]):
        some = by_length[low:high]
        length = int(lengths[some[0]])
        kinds, row = np.unique(chunk[some], return_inverse=True)
        shares, ids = _lattice(model, codes[starts[example[kinds]][:, None] + np.arange(length)])
        end = np.full(len(some), length)
        while len(some):
            draw = texts.mixed(keys[some] + (place[some] + end).astype(np.uint64) * texts.FACTOR)
            draw = (draw >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
            size = 1 + (shares[row, end - 1] <= draw[:, None]).sum(axis=1)
            found[starts[some] + end - size] = ids[row, end - 1, size - 1]
            end = end - size
            left = end > 0
            some, row, end = some[left], row[left], end[left]
    counts = np.where(found == -1, 0, 1)
    spelled = np.flatnonzero(found < -1)
    letters = [chr(-2 - x).encode() for x in found[spelled].tolist()]
    counts[spelled] = [len(b) for b in letters]
    out = np.repeat(found, counts)
    out[out < -1] = model.byte_ids[np.frombuffer(b"".join(letters), np.uint8)]
    return out.astype(np.int32), np.concatenate(([0], np.cumsum(counts)))[bounds]


def decode_group(model: Model, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The texts that ids spell, without the leading blank."""
    lengths = np.diff(model.spelled_at)[ids]
    ends = np.cumsum(lengths)
    shift = model.spelled_at[ids] - (ends - lengths)
    data = model.spelled[np.repeat(shift, lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]
    data = data.tobytes()
    at = np.concatenate(([0], ends))[bounds].tolist()
    return [data[a:b].removeprefix(b" ") for a, b in zip(at[:-1], at[1:])]


def encode(
    docs: DataFrame,
    model: Model,
    key: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    into: str = "piece_ids",
    back: str | None = None,
) -> DataFrame:
    """``docs`` with ``into`` added or replaced: 32-bit numbers, little-endian, in one binary value.

    With ``back``, what the ids decode to is added under that name, without a second pass. A null text
    has null ids, an empty one none. Rows that repeat a key draw the same numbers; a null key is a
    key like any other. Rows and other columns stay as they are.
    """
    docs = docs.drop(into, *([back] if back else []))
    place = docs.columns.index(text)
    keyed = docs.withColumn(texts.fresh(docs, "sampling_key"), F.xxhash64(F.lit(seed), F.col(key)))
    names = [*docs.columns, into, *([back] if back else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in texts.groups(whole, text):
                values = batch.column(place).to_pylist()
                keys = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
                ids, bounds = encode_group(model, values, keys)
                data, at = ids.astype("<i4").tobytes(), (4 * bounds).tolist()
                made = [None if v is None else data[a:b] for v, a, b in zip(values, at[:-1], at[1:])]
                columns = [*batch.columns[:-1], pa.array(made, pa.binary())]
                if back:
                    found = zip(values, decode_group(model, ids, bounds))
                    columns.append(_strings([None if v is None else f for v, f in found]))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType([*docs.schema.fields]).add(into, T.BinaryType())
    return keyed.mapInArrow(run, schema.add(back, T.StringType()) if back else schema)


def _strings(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def decode(docs: DataFrame, model: Model, ids: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text that ``ids`` spell added or replaced; null ids give null."""
    docs = docs.drop(text)
    place = docs.columns.index(ids)
    names = [*docs.columns, text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in texts.groups(whole, ids):
                data, bounds = texts.flat(batch.column(place))
                # Ids are read as bytes of whole numbers, so bounds are multiples of four.
                found = decode_group(model, np.frombuffer(data.tobytes(), "<i4"), bounds // 4)
                made = [f if v.is_valid else None for f, v in zip(found, batch.column(place))]
                yield pa.RecordBatch.from_arrays([*batch.columns, _strings(made)], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields]).add(text, T.StringType()))
