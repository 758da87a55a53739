"""SimHash near-duplicates: bit counts of segments, a grid, then exact distances.

1. *Fingerprint* of each whole text: bit i is set where over half of the shingles' hashes set it.
2. *Embedding*: the fingerprint is cut into 32 segments of two bits; the bit counts of the segments
   are a point whose Manhattan distance to another never exceeds the Hamming distance.
3. *Grid range join*: each point is put into its own cell and into the cells one step away. Two
   points share a cell exactly when they are at most two steps apart. Only counts leave a cell, so
   a crowded one costs as little as any other.
4. *Exact check* of the fingerprints that have company: two fingerprints differ in at most two
   bits exactly when both can be turned into one and the same by flipping at most one bit each.
   Fingerprints that reach the same one are linked to the smallest of them: at most 65, whatever
   the size of a group of near copies.

Every step works on distinct fingerprints, so exact copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.llm.graph import components
from smeltery.llm.texts import fresh
from smeltery.sources.folders import written

SEED = 42
#: Shingles whose bits are counted at once; bounds the memory a very long text takes.
CHUNK = 1 << 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """The 64-bit fingerprint of a text, as a signed number; 0 for a text without words."""
    words = text.lower().split()  # of bytes: only A-Z change, only ASCII blanks split
    if not words:
        return 0
    if len(words) < width:
        shingles = iter([words])
        total = 1
    else:
        shingles = zip(*(words[i:] for i in range(width)))
        total = len(words) - width + 1
    counts = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    while True:
        hashes = np.fromiter(
            (digest(join(s), SEED) for _, s in zip(range(CHUNK), shingles)), np.uint64
        )
        if not len(hashes):
            break
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", width: int = 3, into: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each row's text added or replaced."""
    docs = docs.drop(into)
    place = docs.columns.index(text)
    names = [*docs.columns, into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.large_binary())
            prints = [fingerprint(t.as_py() or b"", width) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.int64())], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields]).add(into, T.LongType()))


def segment_counts(fingerprint: Column) -> Column:
    """Bit counts of the 32 segments, two bits of the result for each."""
    even = fingerprint.bitwiseAND(F.lit(0x5555555555555555))
    odd = F.shiftrightunsigned(fingerprint, 1).bitwiseAND(F.lit(0x5555555555555555))
    return even.bitwiseXOR(odd).bitwiseOR(F.shiftleft(even.bitwiseAND(odd), 1))


def _cells(point: Column) -> Column:
    """The point's own cell and those one step away: counts stay between 0 and 2."""
    steps = []
    for i in range(0, 64, 2):
        count = F.shiftrightunsigned(point, i).bitwiseAND(F.lit(3))
        low, both = (F.shiftleft(F.lit(bits).cast("bigint"), i) for bits in (1, 3))
        # In two bits, 0 and 1 differ in the low one, 1 and 2 in both.
        steps += [F.when(count != 2, point.bitwiseXOR(low)), F.when(count != 0, point.bitwiseXOR(both))]
    return F.filter(F.array(point, *steps), lambda x: x.isNotNull())


def near_links(prints: DataFrame) -> DataFrame:
    """Links ``a, b`` that join all distinct fingerprints at most two bits apart into groups.

    ``prints`` has one column ``fingerprint`` of distinct values.
    """
    # Each value becomes some fifty rows: spread the work before, not after. By a hash of its own, since the
    # planner leaves out a repartition by the column that rows are already grouped by.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = prints.repartition(parts, F.xxhash64("fingerprint"))
    placed = spread.select("fingerprint", F.explode(_cells(segment_counts(F.col("fingerprint")))).alias("cell"))
    shared = (
        placed.groupBy("cell")
        .agg(F.min("fingerprint").alias("least"), F.max("fingerprint").alias("most"))
        .where("least <> most")
    )
    candidates = placed.join(shared.select("cell"), "cell", "left_semi").select("fingerprint").distinct()
    flips = F.array(F.lit(0).cast("bigint"), *[F.shiftleft(F.lit(1).cast("bigint"), i) for i in range(64)])
    reached = candidates.select(
        "fingerprint",
        F.explode(F.transform(flips, lambda f: F.col("fingerprint").bitwiseXOR(f))).alias("middle"),
    )
    least = F.min("fingerprint").over(Window.partitionBy("middle"))
    return reached.select(F.col("fingerprint").alias("a"), least.alias("b")).where("a <> b").distinct()


def groups_of(prints: DataFrame, key: str) -> DataFrame:
    """``fingerprint, component_id`` for each fingerprint of ``key, fingerprint``."""
    distinct = prints.groupBy("fingerprint").agg(F.min(key).alias("first"))
    groups = components(near_links(distinct.select("fingerprint")))
    named = distinct.join(groups, F.col("fingerprint") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "fingerprint")
    )
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return written(named.join(names, "component").select("fingerprint", "component_id"), "groups")


def _prints(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``key, digest, fingerprint`` of each row, written; ``digest`` is a hash of the text."""
    value = F.col(text).cast("string")
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(value).alias("digest"), value.alias("text"))
    return written(with_fingerprint(rows, "text", width).drop("text"), "fingerprints")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``key, fingerprint, component_id``: the smallest key that links of two bits or less reach.

    Null and blank texts have fingerprint 0 and link like any other. Repeated rows and repeated
    keys give as many rows as went in; null keys belong to groups but never name one (a group of
    null keys alone has a null name). An empty table gives an empty table.
    """
    prints = _prints(docs, key, text, width)
    found = prints.join(groups_of(prints, "key"), "fingerprint")
    return found.select(F.col("key").alias(key), "fingerprint", "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """The row with the smallest key of each group of near-duplicates, with all its columns.

    A null key comes last; of rows with one key, the one whose text has the smallest hash stays, and
    of rows that also agree in this any one.
    """
    prints = _prints(docs, key, text, width)
    groups = groups_of(prints, "key")
    same = Window.partitionBy("component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")))
    order = same.orderBy(F.col("key").asc_nulls_last(), "digest")
    kept = prints.join(groups, "fingerprint").withColumn("place", F.row_number().over(order)).where("place = 1")
    # Texts are moved once, to meet the few columns that say which of them stay.
    digest = fresh(docs, "digest")
    marked = docs.withColumn(digest, F.xxhash64(F.col(text).cast("string")))
    kept = kept.select("key", F.col("digest").alias("kept")).hint("shuffle_hash")
    own = F.col(key).cast("bigint").eqNullSafe(F.col("key")) & (F.col(digest) == F.col("kept"))
    rows = marked.join(kept, own, "left_semi")
    if not prints.groupBy("key", "digest").count().where("count > 1").isEmpty():
        rows = rows.dropDuplicates([key, digest])
    return rows.select(*docs.columns)


def hexadecimal(fingerprint: Column) -> Column:
    """16 lowercase digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
