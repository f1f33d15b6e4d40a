"""A corpus from documents: quality rules, line dedup, one of each near duplicate, no repeated passages, packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nameharbor.llm.line_dedup import dedup_lines, document_columns
from nameharbor.llm.ngram_join import one_of_each
from nameharbor.llm.packing import packed
from nameharbor.llm.quality_rules import quality_verdicts
from nameharbor.llm.suffix_dedup import remove_repeats
from nameharbor.session import drop_folder, recorded, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are mostly content."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_verdicts(docs, labels).filter("kept").select(*(F.col(f"`{c}`") for c in docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents hold stay in one."""
    return document_columns(dedup_lines(docs), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    return document_columns(remove_repeats(docs), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    import public_tokenizers

    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


#: Scratch folders of each stage. A stage starts when what the one before gave is written and read
#: again, so those of the stages before it are dropped then.
_scratch: dict[int, list[str]] = {}


def _staged(place: int, stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for earlier in range(place):
            for path in _scratch.pop(earlier, []):
                drop_folder(spark, path)
        with recorded() as made:
            out = stage(spark, docs, sf_dir)
        _scratch.setdefault(place, []).extend(made)
        return out

    return run_stage


STAGES = [(name, _staged(place, stage)) for place, (name, stage) in enumerate([
    ("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_copies), ("suffix-array dedup", passages), ("packing", packing)])]
ORACLE_SQL = None  # neither the quality model nor the token ids can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
