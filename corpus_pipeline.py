"""From raw documents to packed training sequences, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.

1. toxicity: rows that the positive-unlabelled classifier scores at its threshold or above go.
2. line dedup: later occurrences of three-line windows are cut out of the texts; a row goes if nothing of its text is left.
3. n-gram Jaccard join: of each component of texts that share 0.8 of their five-word shingles, one row stays.
4. mixing: rows repeat until the domains' expected tokens match their target shares; every row stays at least once.
5. packing: the token ids of all rows, cut and packed into sequences of 2048 tokens; one row per piece.

Defined cases, in every stage: an empty table gives no rows; repeated rows are rows of their own until stage 3, which leaves one
of each text; null texts count as empty, are no copies of anything and pass stages 1 to 4 (packed as their end id alone); null
ids are never learnt from and tie last; null ``lang``, and labels that are null, missing or contradicting, only mean that a row
teaches no domain; without any toxic label nothing is toxic, without any domain nothing is repeated; extra columns pass
through to stage 4.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantlake.llm import jaccard, linededup, mixing, packing, toxicity
from quantlake.llm.common import prepare, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = linededup.dedup_lines(docs)
    nothing_left = (F.col("n_removed") > 0) & ~F.col("kept").rlike(r"\S")
    columns = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("kept")}
    if "n_chars" in columns:
        columns["n_chars"] = F.coalesce(F.length("kept"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return done.where(~nothing_left).select(*[columns[c].alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard.first_of_groups(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = mixing.language_quality(docs, table(spark, sf_dir, "labels"))
    return mixing.mixed_documents(docs, labelled)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mix_domains),
    ("best-fit packing", pack_sequences),
]

#: Tokenisation and training have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
