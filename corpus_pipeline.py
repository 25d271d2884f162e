"""Documents made into training sequences: five stages, each one of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vestibule.llm.jaccard_join import jaccard_components
from vestibule.llm.packing import pack_documents
from vestibule.llm.quality_pu import fit_quality, keep_quality
from vestibule.llm.queries import tokenizer_path
from vestibule.llm.shared import read_table, share_package, written
from vestibule.llm.suffix_dedup import repeated_spans
from vestibule.llm.winnowing import contaminated, find_contamination


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_quality(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def numbered(docs: DataFrame) -> DataFrame:
    """``(rid, row)``: every row with a number of its own, written so that it stays."""
    rid = F.monotonically_increasing_id().alias("rid")
    return written(docs.select(rid, F.struct(*docs.columns).alias("row")), "numbered")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that link, directly or not, the one with the smallest id stays.

    Rows without an id come after all others, and of rows with equal ids one stays. A
    row without words links with none and stays.
    """
    rows = numbered(docs)
    # The join tells documents apart by id: here a row's number is its id.
    groups = jaccard_components(rows.select(F.col("rid").alias("doc_id"), F.col("row.text")))
    groups = groups.select(F.col("doc_id").alias("rid"), "component_id")
    doc_id = F.col("row.doc_id")
    ids = rows.select("rid", doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"))
    first = F.min(F.struct("no_id", "doc_id", "rid")).alias("first")
    stays = ids.join(groups, "rid").groupBy("component_id").agg(first).select("first.rid")
    return rows.join(stays, "rid", "left_semi").select("row.*")


# Passages of over 50 words are to be found. Fifty short words are some 250 bytes; what
# has as many bytes in fewer words stays.
PASSAGE_BYTES = 250
PASSAGE_WORDS = 50


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in several places are cut out, whole characters only.

    A passage is covered by repeated strings of ``PASSAGE_BYTES`` bytes and has at least
    ``PASSAGE_WORDS`` words. Every document stays, if only with an empty text; ``n_chars`` follows the text.
    """
    cut = repeated_spans(
        docs, length=PASSAGE_BYTES, carry=docs.columns, characters=True, words=PASSAGE_WORDS
    )
    text = F.when(F.col("row.text").isNotNull(), F.col("kept").cast("string"))
    kept = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": text}
    if "n_chars" in docs.columns:
        kept["n_chars"] = F.coalesce(F.length(text).cast("bigint"), F.col("row.n_chars"))
    return cut.select(*[value.alias(c) for c, value in kept.items()])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of which a twentieth or more stands in the benchmark go, whatever their id."""
    rows = numbered(docs)
    texts = rows.select(F.col("rid").alias("doc_id"), F.col("row.text"))
    found = find_contamination(texts, read_table(spark, sf_dir, "benchmark"))
    hit = found.filter(contaminated(F.col("n_hit"), F.col("n_words")))
    hit = hit.select(F.col("doc_id").alias("rid"))
    return rows.join(hit, "rid", "left_anti").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left becomes pieces in sequences."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("n-gram jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

# Classifier, suffix sort and packing have no counterpart in SQL; the tests compare the
# stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read back."""
    share_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    *stages, (_, last) = STAGES
    for name, stage in stages:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
