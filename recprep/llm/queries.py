"""The registered queries of this package and their SQL, where SQL can
express them. The digest columns of each query are derived here from the
operators' real outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recprep.llm import (bpe, embedding_dedup, fingerprints, html_text, language, packing, quality, simhash,
                         spelling, token_alignment, token_counts, toxicity, warc)
from recprep.llm.common import staged, table
from recprep.session import staging_path


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents left, packed; one row per piece."""
    out = packing.pack_documents(docs, _vocabulary("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens; one row per
    piece."""
    return pack_stage(spark, table(spark, sf_dir, "documents"), sf_dir)


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and likenesses."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again; digests of ids and text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.encode(docs, _vocabulary("byte_bpe_50k.json"), decoded_col="decoded").drop("text")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",")
                              .cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the model of trusted text (quality
    label 1, not toxic) of its language, and whether it is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.classify(docs, _trusted(spark, sf_dir), keep=["doc_id", "lang"])


def _trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the quality classifier keeps."""
    return quality.classify(docs, _trusted(spark, sf_dir)).where("kept").select(*docs.columns)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and best path score of every document under the unigram
    reading of a public vocabulary (its pieces and their scores)."""
    pieces, unknown = token_counts.sentencepiece_vocabulary(_vocabulary("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, pieces, unknown).select("doc_id", "n_tokens", "best_score")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text",
                                           F.char_length("text").cast("long").alias("n_chars"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language.identify(docs, keep=["doc_id"])
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language is recognised, with it as
    their ``lang``."""
    out = language.identify(docs).where("not rejected")
    return out.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with equal labels."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "fingerprint", "component_id")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each near-duplicate group the document with the
    smallest id (one of its rows, if that row is repeated). Of a group whose
    documents have no id one stays."""
    groups = simhash.near_duplicates(docs, words=3, max_bits=2)
    first = groups.where("doc_id = component_id").select(F.col("doc_id").alias("first")).distinct()
    named = docs.join(first, docs["doc_id"] == first["first"], "left_semi").dropDuplicates(["doc_id", "text"])
    nameless = groups.where("component_id is null").select(
        F.col("fingerprint").alias("fp"), "component_key").distinct()
    marked = simhash.fingerprints(docs.where("doc_id is null"), "text", 3, "__fp")
    alone = marked.join(nameless, simhash.as_hex(F.col("__fp")) == F.col("fp")).dropDuplicates(
        ["component_key"]).select(*docs.columns)
    return named.unionByName(alone)


#: ways that the revisits of one page are dealt
SALTS = 64


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to web archives and read back."""
    path = staging_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    back = staged(warc.read_archives(spark, path).select(
        "record", "type", "row_id", "refers_to", "refers_to_row", "error",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest")), "archive-rows")
    # a revisit has the size and digest of its origin; very many may share one,
    # so both sides are dealt out by a salt as well
    revisits = back.where("type = 'revisit'").drop("payload_bytes", "payload_digest").withColumn(
        "salt", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)))
    origins = (back.where("type = 'response'")
                   .join(revisits.select(F.col("refers_to").alias("o")).distinct(), F.col("record") == F.col("o"),
                         "left_semi")
                   .select(F.col("record").alias("o"), "payload_bytes", "payload_digest").distinct()
                   .withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    found = revisits.join(origins, (F.col("refers_to") == F.col("o")) & (F.col("salt") == F.col("s")), "left")
    rows = back.where("type = 'response'").unionByName(found.select(*back.columns))
    return rows.select(F.col("row_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                       F.col("type").alias("record_type"),
                       F.col("refers_to_row").cast("long").alias("refers_to"))


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html,
                  strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS origin FROM p WHERE n >= 100 GROUP BY h)
SELECT p.page_id, CAST(n AS BIGINT) AS payload_bytes, p.h AS payload_digest,
       CASE WHEN origin <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN origin <> p.page_id THEN origin END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h"""


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and near words of the vocabulary of all documents, some of whose
    runs lose a code point by the contract's rule."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.spelling_variants(spelling.word_counts(docs, drop_every=31))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; learned from the labels of four folds of
    five."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.classify(docs, labels, keep=["doc_id"])


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers' tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.link_counts(docs, _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"),
                                       keep=["doc_id"])


def queries() -> dict:
    return {f.__name__: f for f in (op1_quality_classifier, op2_packing, op3_order_minhash, op4_bpe,
                                    op5_token_counts, op6_html_extraction,
                                    op7_language_id, op8_embedding_dedup, op9_simhash, op10_warc,
                                    op11_spelling_variants, op12_toxicity, op13_token_alignment)}


def oracle_sql() -> dict[str, str]:
    return {"op10_warc": OP10_SQL}
