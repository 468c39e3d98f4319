"""Registered queries of this package: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialise, read_table
from tessera.llm.embeddings import near_duplicate_vectors
from tessera.llm.importance import fit_ratio, resample
from tessera.llm.langid import fit_languages, label_languages
from tessera.llm.manifest import field_digest, fold, manifest, siblings
from tessera.llm.mixing import mix
from tessera.llm.negatives import hard_negatives
from tessera.llm.packing import pack_examples
from tessera.llm.pii import pseudonymise
from tessera.llm.repeats import remove_repeats
from tessera.llm.search import search
from tessera.llm.simhash import near_duplicates
from tessera.llm.toxicity import crc_mod, fit_toxicity, toxicity_score
from tessera.llm.warc import convert, read_warc, resolved, write_arc
from tessera.session import scratch_path

#: The key of the pseudonyms; a user passes a secret of their own.
PII_KEY = "demonstration key"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids; every id bears loss."""
    return pack_examples(read_table(spark, sf_dir, "documents"))


def op2_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents, sampled towards those labelled as of good quality; one row for each document."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    ratio = fit_ratio(docs, labels.filter("quality = 1"))
    return resample(docs, ratio, fraction=0.5).select(F.col("id").alias("doc_id"), "log_weight", "key", "selected")


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated runs of 35 words removed; a digest of what is kept."""
    found = remove_repeats(read_table(spark, sf_dir, "documents"), window=35)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; fitted on the labelled rows whose crc32 fold of five is not 0."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"), folds=5, held_out=0)
    return toxicity_score(docs, model).select(
        F.col("id").alias("doc_id"), (crc_mod(F.col("id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the rows whose crc32 fold of three is not 1."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit_languages(docs, where=crc_mod(F.col("doc_id"), 3) != 1)
    return label_languages(docs, model).select(
        F.col("id").alias("doc_id"), (crc_mod(F.col("id"), 3) == 1).alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def op6_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents by BM25 for every document whose id is divisible by 20, its whole text the query."""
    docs = read_table(spark, sf_dir, "documents")
    found = search(docs, docs.filter("doc_id % 20 = 0"), k=10)
    return found.select("query_id", "rank", F.col("id").alias("doc_id"), "score")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints over 4-word shingles, linked at 4 or fewer differing bits."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=4, distance=4)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings of equal label at cosine 0.93 or more, linked and grouped."""
    found = near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.93)
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed by weights 1, 2, 3 in turn, no document more than three times."""
    found = mix(read_table(spark, sf_dir, "documents"), weights=(1, 2, 3), cap=3)
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal values replaced, and how many there were."""
    found = pseudonymise(read_table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY, count_col="n_replaced")
    return found.select("doc_id", "text", "n_replaced")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaf, roots and proof of every document; where 7 divides crc32(doc_id) the proof is tried on a row with one character more."""
    docs = read_table(spark, sf_dir, "documents")
    rest = [F.col(c) for c in ("doc_id", "source", "lang")]
    leaf = field_digest(*rest, F.col("n_chars"), F.col("text"))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, field_digest(*rest, F.try_add("n_chars", F.lit(1)), F.col("text")))
    found = manifest(docs, leaf, "doc_id", "lang", carry={"tampered": tampered})
    folded = found.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding, at 80 to 100 per cent of a positive's score; every seventh label is changed first."""
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), label=changed, every=100, scale=256, positives=5, negatives=5, low=80, high=100)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page in a legacy archive, converted to WARC and read back."""
    path = scratch_path(spark, "archives")
    write_arc(read_table(spark, sf_dir, "pages"), f"{path}/arc", url=F.col("url"), payload=F.col("html"), key=F.col("page_id"), key_field="X-Page-Id")
    convert(spark, f"{path}/arc", f"{path}/warc", key_field="X-Page-Id")
    found = resolved(materialise(read_warc(spark, f"{path}/warc", key_field="X-Page-Id", content=False).drop("payload"), "warc-index"))
    return found.select(F.col("key").alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"),
                        F.col("first_key").alias("refers_to"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_importance, op3_repeats, op4_toxicity, op5_language, op6_search, op7_simhash, op8_embeddings, op9_mixing, op10_pii, op11_manifest, op12_negatives, op13_warc)}
