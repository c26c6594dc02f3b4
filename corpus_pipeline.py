"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but the
last return the columns of ``documents``:

- quality: documents that the quality rules or their host's verdict reject go.
- toxicity: documents predicted toxic go. The model learns from the labelled documents that are still there.
- near_duplicates: one document of each class of near copies stays.
- mix: each document as often as the mix of sources takes it.
- pack: token pieces of the mixed documents in sequences.

Defined cases: null texts are empty and go in the first stage; nulls in any other column are kept as they are, a null
id or source being one of its own; repeated rows and equal texts leave one document in the third stage; columns
beyond those of ``documents`` are carried through all stages but the last; without labels of both kinds no document is
toxic; an empty table gives an empty result.

No SQL can express the string kernel, so ``ORACLE_SQL`` is None and the stages are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from surveyloom.llm.common import saved, table
from surveyloom.llm.mixing import repeat_documents
from surveyloom.llm.neardup import keep_first
from surveyloom.llm.packing import best_fit_pack
from surveyloom.llm.quality import keep_good
from surveyloom.llm.toxicity import keep_clean

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeat_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit_pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
