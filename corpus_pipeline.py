"""A corpus pipeline of five operators; each stage takes what its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mcrunstat.llm import decontaminate, mixing, quality, simhash, tokenfiles
from mcrunstat.llm.common import scratch, ship, stored, table, word_count


def _coded(docs: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """The columns of ``docs`` under names that no operator uses, and its text."""
    names = tuple(f"_c{i}" for i in range(len(docs.columns)))
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], F.col("text")), names


def _decoded(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the trees keep.  The trees learn from the table of
    labels; a null or empty text fails the rules."""
    ship(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    coded, names = _coded(docs)
    return _decoded(quality.judge(coded, model, carry=names).filter("kept"), docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id, and of equal ids the
    one with the smallest hash of its columns.  Rows equal in all columns are one."""
    ship(spark)
    every = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.select(F.col("text"), F.struct(
        F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
        F.xxhash64(*every).alias("a"), F.xxhash64(F.lit(1), *every).alias("b")).alias("name"))
    found = simhash.near_duplicates(named, shingle=4, distance=4, key="name")
    kept = found.filter("name = component_id").select(F.col("name.a").alias("_a"), F.col("name.b").alias("_b"))
    return (docs.withColumns({"_a": F.xxhash64(*every), "_b": F.xxhash64(F.lit(1), *every)})
            .join(kept, ["_a", "_b"], "left_semi").dropDuplicates(["_a", "_b"]).drop("_a", "_b"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that hold benchmark windows; documents in which no other
    word is left go."""
    ship(spark)
    known = decontaminate.phrases(table(spark, sf_dir, "benchmark", "item_id", "text"))
    coded, names = _coded(docs)
    found = decontaminate.search(coded, known, carry=names, with_text=True).filter("n_hit = 0 or n_hit < n_words")
    text, size = (f"_c{docs.columns.index(c)}" if c in docs.columns else None for c in ("text", "n_chars"))
    new = {text: F.col("kept_text")}
    if size:
        new[size] = F.when(F.col("n_hit") > 0, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(size))
    return _decoded(found.withColumns(new), docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ship(spark)
    coded, names = _coded(docs)
    sized = coded.select(*names, F.array(F.col(names[docs.columns.index("source")])).alias("_members"),
                         word_count(F.col("text")).alias("_size"))
    mixed, _, _ = mixing.mix(sized, "_members", "_size", mixing.weighted, names)
    return _decoded(mixed.withColumn("_again", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))), docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of the mix, as read back: a row per document."""
    import public_tokenizers

    ship(spark)
    folder = scratch(spark, "pipeline-tokens")
    tokenfiles.write(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokenfiles.read(spark, folder, values=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: The trees, the fingerprints and the tokenizer are beyond SQL; the tests hold each stage
#: against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
