"""The queries of the training-data operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import alignment, ann, audit, bitplanes, jaccard, langid, licenses, media, mixing, pieces, pivots, transcripts, urls


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "pipeline": pipeline,
        "op1_wav_fingerprints": media.op1_wav_fingerprints,
        "op2_host_reputation": urls.op2_host_reputation,
        "op3_bit_plane_tokens": bitplanes.op3_bit_plane_tokens,
        "op4_ngram_jaccard": jaccard.op4_ngram_jaccard,
        "op5_sentencepiece_viterbi": pieces.op5_sentencepiece_viterbi,
        "op6_source_mixing": mixing.op6_source_mixing,
        "op7_ppm_language": langid.op7_ppm_language,
        "op8_additive_quantisation": ann.op8_additive_quantisation,
        "op9_license_scan": licenses.op9_license_scan,
        "op10_transcript_roles": transcripts.op10_transcript_roles,
        "op11_lockstep_alignment": alignment.op11_lockstep_alignment,
        "op12_filter_audit": audit.op12_filter_audit,
        "op13_pivot_search": pivots.op13_pivot_search,
    }


def oracle_sql() -> dict:
    return {
        "op2_host_reputation": urls.OP2_SQL,
        "op4_ngram_jaccard": jaccard.OP4_SQL,
        "op9_license_scan": licenses.OP9_SQL,
        "op12_filter_audit": audit.OP12_SQL,
        "op13_pivot_search": pivots.OP13_SQL,
    }
