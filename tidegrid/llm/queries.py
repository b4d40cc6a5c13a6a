"""Every operator over its whole table, and the pipeline."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import decontam, dedup, fim, jaccard, langid, licenses, lm, packing, pii, suffix, tokenfiles, vafile, warc
from tidegrid.llm.common import table
from tidegrid.llm.oracles import LLM_ORACLES  # noqa: F401
from tidegrid.llm.tokens import tokenizer_path
from tidegrid.session import scratch_path

KEY = "a key for examples"


def op1_jaccard_join(spark, sf_dir) -> DataFrame:
    classes, _ = jaccard.jaccard_join(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "n_shingles", "component_id")


def op2_best_fit_packing(spark, sf_dir) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_benchmark_decontamination(spark, sf_dir) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_suffix_array_dedup(spark, sf_dir) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op5_pii(spark, sf_dir) -> DataFrame:
    return pii.pseudonymize(table(spark, sf_dir, "documents"), KEY)


def op6_language_id(spark, sf_dir) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op7_lm_scoring(spark, sf_dir) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark, sf_dir) -> DataFrame:
    return dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op9_warc(spark, sf_dir) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_archives(warc.with_originals(table(spark, sf_dir, "pages")), folder).agg(F.sum("records")).collect()
    records = warc.resolve_revisits(warc.read_archives(spark, folder, payloads=False))
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


def op10_license_scans(spark, sf_dir) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.TEMPLATES)


def op11_fill_in_middle(spark, sf_dir) -> DataFrame:
    cut = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    restored = fim.restore(F.col("output"), F.col("form"))
    return cut.withColumns({"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(restored, 256)}).drop("output")


def op12_token_files(spark, sf_dir) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    manifest = tokenfiles.write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer_path("byte_bpe_50k.json"))
    return tokenfiles.read_documents(spark, manifest, folder)


def op13_centroid_clustering(spark, sf_dir) -> DataFrame:
    return vafile.cluster_vectors(table(spark, sf_dir, "embeddings"))[0]


def pipeline(spark, sf_dir) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_jaccard_join,
        op2_best_fit_packing,
        op3_benchmark_decontamination,
        op4_suffix_array_dedup,
        op5_pii,
        op6_language_id,
        op7_lm_scoring,
        op8_exact_dedup,
        op9_warc,
        op10_license_scans,
        op11_fill_in_middle,
        op12_token_files,
        op13_centroid_clustering,
        pipeline,
    )
}
