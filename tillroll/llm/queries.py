"""One query for each operator of this folder, over whole tables, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tillroll.llm import (
    bpe,
    byte_bpe,
    collocations,
    embedding_neardup,
    html_extraction,
    language_id,
    line_dedup,
    oracles,
    packing,
    quality_nbsvm,
    quality_rules,
    shallot,
    simhash_neardup,
    toxicity_fm,
)
from tillroll.llm.common import fold_of, table
from tillroll.llm.shipping import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def _query(function: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


@_query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 4096 tokens."""
    docs = table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    digest = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.best_fit(digest)


@_query
def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text")
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op3_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    linked = simhash_neardup.link_documents(table(spark, sf_dir, "documents"))
    hex_digits = F.lpad(F.lower(F.hex("simhash")), 16, "0")
    return linked.select("doc_id", hex_digits.alias("fingerprint"), "component_id")


@_query
def op4_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels of four crc32 folds of five."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    known = labels.where((fold_of("doc_id", 5) != 0) & F.col("toxic").isNotNull())
    model = toxicity_fm.fit(docs, known, "doc_id", "text", "toxic")
    scored = toxicity_fm.score(docs, model)
    return scored.select(
        "doc_id",
        (fold_of("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    base = quality_rules.plan_cascade(docs, quality_rules.BASE_RULES, "doc_id", have=names)
    own = quality_rules.plan_cascade(docs, quality_rules.RULES, "doc_id", have=names, after=tuple(base))
    # All rows have the five measures; the method's others are computed in the branches that need them.
    measured = quality_rules.measure(docs, list(names))
    passed = quality_rules.cascade(measured, base, have=set(names))
    kept = quality_rules.cascade(measured, [*base, *own], have=set(names))
    return measured.select("doc_id", *names, (~passed).alias("base_failed"), kept.alias("kept"))


@_query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from two crc32 folds of three."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(fold_of("doc_id", 3) != 1))
    held_out = (fold_of("doc_id", 3) == 1).alias("held_out")
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out, "lang_pred", "score")


@_query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier line of the corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_lines = F.size(F.split("text", "\n")).cast("long")
    before = docs.withColumn("n_lines", F.coalesce(n_lines, F.lit(0)))
    after = line_dedup.drop_repeated_lines(before)
    return after.withColumn("n_chars", F.length("text").cast("long"))


@_query
def op8_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from labels of three crc32 folds of four."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    scored = quality_nbsvm.score(docs, model)
    return scored.select(
        "doc_id",
        (fold_of("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= quality_nbsvm.PASS_SCORE).cast("int").alias("predicted"),
    )


def quality_model(docs: DataFrame, labels: DataFrame) -> quality_nbsvm.QualityModel:
    """The quality model of the labelled rows outside fold 2 of 4."""
    known = labels.select("doc_id", "quality").where((fold_of("doc_id", 4) != 2) & F.col("quality").isNotNull())
    return quality_nbsvm.fit(docs, known, "doc_id", "text", "quality")


@_query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    texts = html_extraction.extract(pages, html_extraction.fit(pages))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query
def op10_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector, among vectors of its label."""
    return embedding_neardup.near_vectors(table(spark, sf_dir, "embeddings"))


@_query
def op11_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertias of every vector of 64 finite components."""
    found = shallot.shallot_clusters(table(spark, sf_dir, "embeddings"))
    of_cluster = F.col("cluster") + 1
    inertias = F.array(*[F.lit(i).cast("long") for i in found.inertias]).cast("array<bigint>")
    digests = F.array(*map(F.lit, found.digests())).cast("array<string>")
    return found.vectors.select(
        "vec_id",
        "cluster",
        "distance",
        F.try_element_at(inertias, of_cluster).alias("cluster_inertia"),
        F.lit(found.inertia).cast("long").alias("inertia"),
        F.try_element_at(digests, of_cluster).alias("centroid_sha256"),
    )


@_query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids by ranks and of the bytes decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.round_trip(docs, ranks, packed=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best phrases of two or three words."""
    return collocations.collocations(table(spark, sf_dir, "documents"))
