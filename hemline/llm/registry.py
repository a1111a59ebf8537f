"""Queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hemline.llm import oracles
from hemline.llm.contamination import op8_decontamination
from hemline.llm.divergence import op13_source_divergence
from hemline.llm.licenses import op3_license_scan
from hemline.llm.line_dedup import op10_line_dedup
from hemline.llm.personal import op12_personal_data
from hemline.llm.pieces import op2_sentencepiece
from hemline.llm.search import op11_ranked_search
from hemline.llm.secret_scan import op1_secret_scan
from hemline.llm.simhash import op9_simhash
from hemline.llm.substrings import op5_substring_dedup
from hemline.llm.suffix_tree import op7_lm_score
from hemline.llm.toxicity import op4_toxicity
from hemline.llm.vectors import op6_embedding_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_license_scan": op3_license_scan,
    "op4_toxicity": op4_toxicity,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_lm_score": op7_lm_score,
    "op8_decontamination": op8_decontamination,
    "op9_simhash": op9_simhash,
    "op10_line_dedup": op10_line_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_personal_data": op12_personal_data,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES: dict[str, str] = {
    "op5_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op6_embedding_dedup": oracles.EMBEDDING_DEDUP,
    "op8_decontamination": oracles.DECONTAMINATION,
    "op10_line_dedup": oracles.LINE_DEDUP,
    "op11_ranked_search": oracles.RANKED_SEARCH,
    "op13_source_divergence": oracles.DIVERGENCE,
}
