"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpus_pipeline import ORACLE_SQL, run
from tradeloom.llm.ann import OP1_SQL, op1_ann
from tradeloom.llm.chat import OP12_SQL, op12_chat
from tradeloom.llm.html import op2_html_extraction
from tradeloom.llm.jaccard import OP4_SQL, op4_ngram_jaccard
from tradeloom.llm.lm import op8_lm_scoring
from tradeloom.llm.mixing import op9_mixing
from tradeloom.llm.phrases import OP11_SQL, op11_phrases
from tradeloom.llm.quality import op7_quality_classifier
from tradeloom.llm.rules import op6_quality_rules
from tradeloom.llm.secrets import op3_secret_scans
from tradeloom.llm.segment import op10_sentencepiece
from tradeloom.llm.sharding import OP5_SQL, op5_sharding
from tradeloom.llm.spelling import op13_spelling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": op1_ann,
    "op2_html_extraction": op2_html_extraction,
    "op3_secret_scans": op3_secret_scans,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_sharding": op5_sharding,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_mixing": op9_mixing,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_phrases": op11_phrases,
    "op12_chat": op12_chat,
    "op13_spelling": op13_spelling,
    "pipeline": run,
}

ORACLE: dict[str, str] = {
    "op1_ann": OP1_SQL,
    "op4_ngram_jaccard": OP4_SQL,
    "op5_sharding": OP5_SQL,
    "op11_phrases": OP11_SQL,
    "op12_chat": OP12_SQL,
}
if ORACLE_SQL is not None:
    ORACLE["pipeline"] = ORACLE_SQL
