"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventmarts.llm import (
    decision_list,
    hard_negatives,
    host_reputation,
    interleave,
    license_diagonals,
    merkle_butterfly,
    nra_topk,
    poisson_mix,
    secret_forest,
    simhash_vp,
    suffix_dedup,
    weak_quality,
    window_packing,
)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_forest": secret_forest.query,
        "op2_simhash_vp": simhash_vp.query,
        "op3_nra_topk": nra_topk.query,
        "op4_url_reputation": host_reputation.query,
        "op5_weak_quality": weak_quality.query,
        "op6_window_packing": window_packing.query,
        "op7_decision_list": decision_list.query,
        "op8_license_diagonals": license_diagonals.query,
        "op9_poisson_mix": poisson_mix.query,
        "op10_suffix_dedup": suffix_dedup.query,
        "op11_merkle_butterfly": merkle_butterfly.query,
        "op12_segment_negatives": hard_negatives.query,
        "op13_interleave": interleave.query,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op3_nra_topk": nra_topk.ORACLE,
        "op4_url_reputation": host_reputation.ORACLE,
        "op9_poisson_mix": poisson_mix.ORACLE,
        "op11_merkle_butterfly": merkle_butterfly.ORACLE,
        "op12_segment_negatives": hard_negatives.ORACLE,
        "op13_interleave": interleave.ORACLE,
    }
