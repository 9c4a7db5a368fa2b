"""A training corpus from `documents`: five stages, each written and read again by the next.

Every stage works on all rows that its predecessor kept. Toxic documents go, repeated runs of lines
go from the texts, one document of each group of near copies stays, sources are mixed by repeating
documents, and the texts become piece ids. Null ids and texts, empty texts and empty tables
pass: each stage's operator defines what becomes of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.llm import linededup, mixing, pieces, simhash, toxicity
from haulmark.llm.common import written
from haulmark.llm.queries import TOKENIZERS

#: A document from this score on is rejected.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on `labels`, scores below `TOXIC`.

    Null and empty texts are no sign of anything and stay unless most such texts are labelled toxic; repeated
    rows are judged each; columns stay as they are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    name = "_".join(["toxicity", *docs.columns])  # longer than every other
    return toxicity.score_documents(docs, labels, name=name).filter(F.col(name) < TOXIC).select(docs.columns)


def _carried(docs: DataFrame, *used: str) -> DataFrame:
    """The columns that a stage uses, and the others as one, `row`, so that none has a name of the stage's own."""
    others = [docs[c] for c in docs.columns if c not in used]
    return docs.select(F.struct(F.lit(0), *others).alias("row"), *used)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the runs of lines that repeat earlier ones; `n_chars` follows the text.

    No document goes; null texts stay null, and columns stay as they are.
    """
    cut = linededup.remove_repeated_runs(_carried(docs, "doc_id", "text"))
    made = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars")).cast("long")
    return cut.select(*(made.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, by `simhash.one_of_each`: the smallest id, null last."""
    return simhash.one_of_each(docs, shingle=3, distance=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to near equal token shares of the sources; every document stays at least once.

    A null source is one; null and empty texts count one token; columns stay as they are.
    """
    used = ("doc_id", "source", "text")
    mixed = mixing.mix(_carried(docs, *used))
    return mixed.select(*(F.col(c) if c in used else F.col("row")[c].alias(c) for c in docs.columns))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of each text; a null text has none, a repeated row its own."""
    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    coded = pieces.encode(docs, model, keep=["doc_id", "lang", "source"])
    return coded.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("sentencepiece_encoding", encode_texts),
]

#: Fitted weights and hashes of other engines' functions are beyond SQL; tests/llm has the comparison.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
