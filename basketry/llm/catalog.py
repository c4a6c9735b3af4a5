"""Queries of this subpackage over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import (
    alignment,
    chat,
    classifier,
    decontaminate,
    filteraudit,
    licences,
    linededup,
    mixing,
    pieces,
    quality,
    secrets,
    simhash,
    tokencounts,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_secret_scan": secrets.op1_secret_scan,
        "op2_decontamination": decontaminate.op2_decontamination,
        "op3_chat_format": chat.op3_chat_format,
        "op4_quality_classifier": classifier.op4_quality_classifier,
        "op5_line_dedup": linededup.op5_line_dedup,
        "op6_token_counts": tokencounts.op6_token_counts,
        "op7_quality_rules": quality.op7_quality_rules,
        "op8_source_mixing": mixing.op8_source_mixing,
        "op9_simhash_bktree": simhash.op9_simhash_bktree,
        "op10_license_scan": licences.op10_license_scan,
        "op11_filter_audit": filteraudit.op11_filter_audit,
        "op12_token_alignment": alignment.op12_token_alignment,
        "op13_sentencepiece": pieces.op13_sentencepiece,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_chat_format": chat.OP3_SQL,
        "op8_source_mixing": mixing.OP8_SQL,
        "op11_filter_audit": filteraudit.OP11_SQL,
    }
