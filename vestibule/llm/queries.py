"""One registered query per operator, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vestibule.llm import sql
from vestibule.llm.alignment import align_tokens, alignment_digests
from vestibule.llm.chat_parts import chat_digests, format_turns, probe_turns, text_parts
from vestibule.llm.cross_polytope import nearest_vectors
from vestibule.llm.jaccard_join import jaccard_components
from vestibule.llm.license_scan import scan_licenses
from vestibule.llm.packing import pack_documents
from vestibule.llm.pieces import encode_pieces
from vestibule.llm.quality_pu import fit_quality, score_quality
from vestibule.llm.repair import damaged_turns, repair_report, repaired_turns
from vestibule.llm.shard_tree import assign_shards, topology
from vestibule.llm.shared import read_table, share_package, written
from vestibule.llm.suffix_dedup import repeated_spans
from vestibule.llm.wavelet import token_shards
from vestibule.llm.winnowing import contaminated, find_contamination

NEIGHBOURS = 20
QUERY_ONE_IN = 20
SHARDS = 24
TOKENIZER = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A vocabulary file, at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named or quoted in every document."""
    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")


def op2_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learned from rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document stands in the benchmark."""
    docs, benchmark = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return find_contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op5_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted and read back."""
    turns = probe_turns(spark).unionByName(text_parts(read_table(spark, sf_dir, "conversations")))
    return chat_digests(written(format_turns(turns), "chat"))


def op6_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the ids of every document lie in the shard files, read from them."""
    return token_shards(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors of every twentieth one."""
    is_query = F.col("vec_id") % QUERY_ONE_IN == 0
    return nearest_vectors(read_table(spark, sf_dir, "embeddings"), is_query, NEIGHBOURS)


def op8_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, and that with one shard more."""
    docs = read_table(spark, sf_dir, "documents")
    return assign_shards(docs, topology(SHARDS), topology(SHARDS + 1))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence and place of every piece of every document."""
    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings."""
    return repeated_spans(read_table(spark, sf_dir, "documents")).select(
        "row.doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # What is left to read; a character that lost some of its bytes shows as U+FFFD.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies lie on the bytes of every document."""
    paths = (tokenizer_path(name) for name in (BYTE_VOCABULARY, PIECE_VOCABULARY))
    return alignment_digests(align_tokens(read_table(spark, sf_dir, "documents"), *paths))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by rule and repaired by the cheapest edits."""
    turns = read_table(spark, sf_dir, "conversations")
    return repair_report(repaired_turns(damaged_turns(turns), turns))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The piece ids of every document and what they read back as, as digests."""
    docs = read_table(spark, sf_dir, "documents")
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encode_pieces(docs, tokenizer_path(PIECE_VOCABULARY)).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "agrees",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query of the operators, by name."""
    registered = (
        op1_license_scan,
        op2_quality_pu,
        op3_jaccard_join,
        op4_winnowing,
        op5_chat_parts,
        op6_wavelet_shards,
        op7_cross_polytope,
        op8_shard_tree,
        op9_best_fit_packing,
        op10_suffix_dedup,
        op11_token_alignment,
        op12_turn_repair,
        op13_sentencepiece,
    )
    return {query.__name__: _shared(query) for query in registered}


def _shared(query: Callable[[SparkSession, str], DataFrame]):
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        share_package(spark)
        return query(spark, sf_dir)

    return run


def oracle_sql() -> dict[str, str]:
    """DuckDB counterparts of the queries that SQL can express."""
    return {
        "op3_jaccard_join": sql.JACCARD_JOIN,
        "op4_winnowing": sql.WINNOWING,
        "op5_chat_parts": sql.CHAT_PARTS,
    }
