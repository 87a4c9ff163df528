"""From raw documents to packed training windows: five stages, each a table of the shared folder.

Every stage takes all that its predecessor kept, and all but the last keep the columns of the documents,
whatever they are. Defined results: null and empty texts are not toxic, hold no boilerplate, are nobody's
copies, are drawn by the probability of their category, and are packed as their end id alone; rows
without an id stay, and their text is nobody's copy; rows that repeat an id and a text share every
decision, and as copies of a row with a smaller id they go with it; of equal copies all rows of the least id
stay; an empty table gives no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import jaccard, line_dedup, mixing, packing, toxicity
from lectern.llm.common import WRITTEN, remove_stored, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a large share of their source's pages repeat."""
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("text").cast(kind)).otherwise(F.col("row.n_chars"))
    return line_dedup.cleaned(docs).select(*line_dedup.own_columns(docs.columns, **changed))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word Jaccard similarity 0.8 or more."""
    return jaccard.keep_one(docs, words=5, threshold=(4, 5))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn with their calibrated probabilities."""
    return mixing.drawn(docs).filter("sampled").select("row.*")


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in windows of 1024 tokens; executors that four stages have filled get smaller runs of text."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), size=1024, end_id=0, chunk=4 << 20, remembered=300_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: No SQL can train the classifier or pack by best fit; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written before the next reads it, and what the
    stages wrote on their way is removed."""
    docs, mark = table(spark, sf_dir, "documents"), len(WRITTEN)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        remove_stored(spark, mark, but=WRITTEN[-1])
    return docs
