"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import brown_lm, decontaminate, html_text, media, mix_sources, quality, shard, simhash_dedup, toxicity, url_filter
from .common import table

QUERIES = {
    "op1_mix_sources": lambda spark, d: mix_sources.result(table(spark, d, "documents")),
    "op2_simhash_dedup": lambda spark, d: simhash_dedup.result(table(spark, d, "documents")),
    "op3_decontaminate": lambda spark, d: decontaminate.result(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op4_html_text": lambda spark, d: html_text.result(table(spark, d, "pages")),
    "op5_url_filter": lambda spark, d: url_filter.result(table(spark, d, "pages")),
    "op6_quality": lambda spark, d: quality.result(table(spark, d, "documents"), table(spark, d, "labels")),
    "op7_brown_lm": lambda spark, d: brown_lm.result(table(spark, d, "documents")),
    "op8_media": lambda spark, d: media.result(table(spark, d, "documents")),
    "op9_toxicity": lambda spark, d: toxicity.result(table(spark, d, "documents"), table(spark, d, "labels")),
    "op10_shard": lambda spark, d: shard.result(table(spark, d, "documents")),
}
ORACLE_SQL = {"op3_decontaminate": decontaminate.ORACLE_SQL, "op5_url_filter": url_filter.ORACLE_SQL}
