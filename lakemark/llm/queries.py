"""The queries that apply the operators of this folder to the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemark.llm.bpe import encode
from lakemark.llm.collocations import collocations
from lakemark.llm.common import table
from lakemark.llm.embedding_dedup import near_vectors
from lakemark.llm.fingerprints import fingerprint, with_successor
from lakemark.llm.language_id import fit_prototypes, held_out, identify
from lakemark.llm.lm_scoring import backoff_scores
from lakemark.llm.mixing import mixing_plan
from lakemark.llm.ngram_join import similar
from lakemark.llm.pii import replace_pii
from lakemark.llm.secret_scan import fit_formats, scan_secrets
from lakemark.llm.token_counts import counted_in_files
from lakemark.llm.toxicity import REJECT_AT, fit_toxicity, score_toxicity
from lakemark.llm.vector_codes import encode_vectors, fit_codebooks, with_label_errors


def tokenizer_path() -> str:
    """Place of the vocabulary of the BPE queries."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def graded_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity grades of the labelled documents: 0 clean, 1 toxic, 2 toxic and of low quality."""
    worse = F.coalesce(F.col("quality"), F.lit(1)) == 0
    grade = F.when(F.col("toxic") == 0, 0).when(F.col("toxic") == 1, 1 + worse.cast("int"))
    return table(spark, sf_dir, "labels").select("doc_id", grade.alias("grade"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = encode(docs, tokenizer_path())
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document under the counts of up to three words of all others."""
    rows = backoff_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))
    mean = F.when(F.col("n_words") > 0, F.col("log10_score") / F.col("n_words"))
    return rows.select(
        F.col("id").alias("doc_id"), "n_words", F.round("log10_score", 3).alias("log10_score"),
        F.round(mean, 5).alias("log10_per_word"),
    )


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with a cosine of 0.95 or more."""
    rows = near_vectors(table(spark, sf_dir, "embeddings"))
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return rows.select(F.col("id").alias("vec_id"), "n_links", "component_id", kept.alias("kept"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document, by five-word sets and similarity 0.8."""
    rows = similar(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "class_id", "n_links")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    docs = with_successor(table(spark, sf_dir, "documents"))
    own, follower = F.coalesce("text", F.lit("")), F.coalesce("next_text", F.lit(""))
    length = F.char_length(own)
    cut = F.floor(length / 4).cast("int")
    edited = F.concat(F.substring(own, F.lit(1), length - cut), F.substring(follower, F.lit(1), cut))
    rows = docs.select("doc_id", length.cast("long").alias("n_chars"), "text", edited.alias("edited"), "next_text")
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    texts = {"fingerprint": "text", "edited_fingerprint": "edited", "next_fingerprint": "next_text"}
    likeness = {
        "near_edited": ("fingerprint", "edited_fingerprint"), "near_next": ("fingerprint", "next_fingerprint")
    }
    rows = fingerprint(rows, texts, likeness, keep=["doc_id", "n_chars", "edited_sha256"])
    return rows.drop("next_fingerprint")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files written from all documents.

    The files hold one id a word.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return counted_in_files(docs).select(F.col("id").alias("doc_id"), "n_tokens")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, next to the targets of its source."""
    rows = mixing_plan(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: those of fixed patterns, and all with inferred formats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scan_secrets(docs, fit_formats(docs))
    base = F.filter("spans", lambda s: s["kind"] != "format")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        line = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(line, ",")

    return rows.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), number("format"),
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for its personal data, and how many there are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_pii(docs, count="n_entities")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, and whether it is rejected."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, graded_labels(spark, sf_dir))
    severity = F.round("severity", 6)
    return score_toxicity(docs, model).select(
        "doc_id", severity.alias("severity"), (F.col("severity") >= REJECT_AT).alias("rejected")
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of two to five words of every language."""
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors by four codebooks of 256 entries, and their errors."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    codebooks = fit_codebooks(vectors)
    coded = encode_vectors(vectors, codebooks).drop("embedding")
    return with_label_errors(coded).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codebooks.sha256).alias("codebooks_sha256")
    )


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    prototypes = fit_prototypes(docs.filter(~held_out(F.col("doc_id"))))
    rows = identify(docs.select("doc_id", "text"), prototypes)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_embeddings": op3_embeddings,
    "op4_ngram_join": op4_ngram_join,
    "op5_fingerprints": op5_fingerprints,
    "op6_token_counts": op6_token_counts,
    "op7_mixing": op7_mixing,
    "op8_secrets": op8_secrets,
    "op9_pii": op9_pii,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_vector_codes": op12_vector_codes,
    "op13_language_id": op13_language_id,
}
