"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemill.llm.chunk_bpe import op7_chunk_bpe
from tidemill.llm.cross_parsing import op13_cross_parsing
from tidemill.llm.fuzzy_lines import op6_fuzzy_lines
from tidemill.llm.harmonic_packing import op5_harmonic_packing
from tidemill.llm.hidden_markov import op3_hidden_markov
from tidemill.llm.license_automaton import op8_license_automaton
from tidemill.llm.pivot_negatives import OP12_SQL, op12_pivot_negatives
from tidemill.llm.pivot_simhash import op9_pivot_simhash
from tidemill.llm.position_bitmaps import OP11_SQL, op11_position_bitmaps
from tidemill.llm.streaming_dedup import OP10_SQL, op10_streaming_dedup
from tidemill.llm.subsequence_svm import op1_subsequence_svm
from tidemill.llm.warc_derivatives import OP4_SQL, op4_warc_derivatives
from tidemill.llm.weighted_fingerprints import op2_weighted_fingerprints

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_subsequence_svm": op1_subsequence_svm,
    "op2_weighted_fingerprints": op2_weighted_fingerprints,
    "op3_hidden_markov": op3_hidden_markov,
    "op4_warc_derivatives": op4_warc_derivatives,
    "op5_harmonic_packing": op5_harmonic_packing,
    "op6_fuzzy_lines": op6_fuzzy_lines,
    "op7_chunk_bpe": op7_chunk_bpe,
    "op8_license_automaton": op8_license_automaton,
    "op9_pivot_simhash": op9_pivot_simhash,
    "op10_streaming_dedup": op10_streaming_dedup,
    "op11_position_bitmaps": op11_position_bitmaps,
    "op12_pivot_negatives": op12_pivot_negatives,
    "op13_cross_parsing": op13_cross_parsing,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op4_warc_derivatives": OP4_SQL,
    "op10_streaming_dedup": OP10_SQL,
    "op11_position_bitmaps": OP11_SQL,
    "op12_pivot_negatives": OP12_SQL,
}
