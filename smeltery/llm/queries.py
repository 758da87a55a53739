"""The operators as queries over the test tables, and their SQL twins.

Each query runs its operator over a whole table and derives digest columns from the operator's
output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.llm import (
    chat,
    collocations,
    contamination,
    langid,
    licenses,
    neighbours,
    pieces,
    pii,
    quality,
    repeats,
    simhash,
    spelling,
    substrings,
    twins,
)
from smeltery.llm.packaging import shipped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(builder):
        QUERIES[name] = shipped(builder)
        if sql is not None:
            ORACLES[name] = sql.strip()
        return builder

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op7_simhash_groups")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.withColumn("fingerprint", simhash.hexadecimal(F.col("fingerprint")))


@query("op8_personal_data")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))

    def only(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(only(kind)).cast("bigint").alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(pii.joined(only(*pii.BASE_KINDS)), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


# Texts of one more conversation: an escape, both marks of the template.
_HARD = "\\### Assistant: </turn> ok"


@query(
    "op2_chat_format",
    rf"""
    with rows as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -7, 0, 'user', '{_HARD}'
        union all select -7, 1, 'assistant', '{_HARD}'),
    sized as (
        select *, length(replace(replace(replace(text, '\', '\b'), '### ', '\h'), '</turn>', '\e')) as chars,
          length(replace(replace(replace(replace(role, '\', '\b'), '### ', '\h'), '</turn>', '\e'), ':', '\c'))
            as role_chars,
          case when role = 'assistant' then text else '' end as taught
        from rows)
    select conv_id, count(*) as n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
      cast(sum(length(taught)) as bigint) as loss_chars,
      sha256(string_agg(taught, '' order by turn, role, text)) as loss_sha256,
      cast(sum(chars + role_chars + 14) as bigint) as formatted_chars
    from sized group by conv_id
    """,
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_HARD).alias("text"),
    )
    out = chat.formatted(chat.canonical_turns(rows.unionByName(hard)))
    out = out.withColumns(
        {
            "back": chat.read_back(F.col("formatted")),
            "loss": chat.under_mask(F.col("formatted"), F.col("loss_mask")),
        }
    )
    said = F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        "conv_id",
        F.size("back").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def held_out(doc_id: Column) -> Column:
    """The third of the documents that the language network never learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query("op3_language")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    network = langid.train(docs.where(~held_out(F.col("doc_id"))))
    found = langid.predict(docs.select("doc_id", "text"), network)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op1_substring_dedup", twins.REPEATED_WORDS)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.deduplicate(table(spark, folder, "documents")).drop("kept")


@query("op9_maximal_repeats", twins.REPEATED_BYTES)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.deduplicate(table(spark, folder, "documents")).drop("kept")


@query("op10_sampled_pieces")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    model = pieces.load()
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = pieces.encode(docs, model, back="decoded")
    return out.select(
        "doc_id",
        (F.length("piece_ids") / 4).cast("bigint").alias("n_pieces"),
        F.sha2("piece_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


@query("op6_benchmark_leaks")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op4_embedding_groups", twins.NEAR_VECTORS)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, folder, "embeddings"))


@query("op5_license_matches")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find(table(spark, folder, "documents"))


@query("op13_quality")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    def held_out(key: Column) -> Column:
        return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))

    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    model = quality.train(docs, labels.where(~held_out(F.col("doc_id"))))
    return quality.score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.ACCEPTED).cast("int").alias("predicted"),
    )


@query("op11_spelling_variants")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


@query("op12_collocations", twins.COLLOCATIONS)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))
