"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audit, fingerprint, gam, lines, lm, minhash, mixing, packing, pieces, ranked, suffix, topk, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A file of the public tokenizers that every machine has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_minhash_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents at a similarity of 0.85."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op2_temperature_mixing", mixing.SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of all documents mixed by temperature: as many tokens as there are, no source read more than twice."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", "pass_no", "block_no", "n_tokens", "order_key")


@query("op4_sequence_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op5_fuzzy_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with one line of each group of near-equal lines left; (doc_id, text, n_removed)."""
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True).select("doc_id", "text", "n_removed")


@query("op8_quality_additive")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels that are not held out."""
    return gam.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of repeated 200-byte strings."""
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


@query("op6_warc_round_trip", warc.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op9_exact_topk", topk.SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best inner products for every vector whose id is divisible by 100, among all other vectors."""
    return topk.search_self(table(spark, sf_dir, "embeddings"))


@query("op10_scaled_fingerprint")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited forms."""
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


@query("op1_maxent_lm_score")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents, learned from the nine tenths that are not held out."""
    return lm.score_documents(table(spark, sf_dir, "documents"))


@query("op11_ranked_lexical", ranked.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest-scoring documents for every benchmark item, among all documents."""
    return ranked.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_filter_audit", audit.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents: what each step of each order keeps, removes and loses."""
    return audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_piece_round_trip")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to pieces and decoded again, as digests."""
    return pieces.digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
