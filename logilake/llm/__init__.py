"""Operators for training data, their queries and the SQL each must agree with."""

import sys

from logilake.llm import bpe, common, decontaminate, exact_dedup, filter_audit, hard_negatives, histogram_shards, html_text, license_scan, lm_lbl, minhash_join, packing, quality_qda, toxicity
from logilake.llm.common import ORACLE, QUERIES

common.ship_by_value(sys.modules[__name__])

__all__ = ["all_queries", "all_sql", "bpe", "decontaminate", "exact_dedup", "filter_audit", "hard_negatives", "histogram_shards", "html_text", "license_scan", "lm_lbl", "minhash_join", "packing", "quality_qda", "toxicity"]


def all_queries():
    return dict(QUERIES)


def all_sql():
    return dict(ORACLE)
