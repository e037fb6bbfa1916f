"""The registered queries of this package, with the SQL to compare them with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tutorlake.llm.decontamination import op1_pigeonhole_decontamination
from tutorlake.llm.lm_scoring import op5_backoff_automaton
from tutorlake.llm.minhash import op12_minhash_multi_index
from tutorlake.llm.packing import op3_vector_best_fit
from tutorlake.llm.periodic_runs import op13_periodic_runs
from tutorlake.llm.quality import OP10_SQL, op10_quality_divergence
from tutorlake.llm.sharding import op2_rendezvous_shards
from tutorlake.llm.simhash import op6_simhash_golay
from tutorlake.llm.spelling import op11_trie_frontier
from tutorlake.llm.suffix_dedup import op9_suffix_array_dedup
from tutorlake.llm.token_counts import op7_prefix_token_counts
from tutorlake.llm.toxicity import op4_toxicity_neighbours
from tutorlake.llm.warc import OP8_SQL, op8_warc_transactions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pigeonhole_decontamination,
        op2_rendezvous_shards,
        op3_vector_best_fit,
        op4_toxicity_neighbours,
        op5_backoff_automaton,
        op6_simhash_golay,
        op7_prefix_token_counts,
        op8_warc_transactions,
        op9_suffix_array_dedup,
        op10_quality_divergence,
        op11_trie_frontier,
        op12_minhash_multi_index,
        op13_periodic_runs,
    )
}
ORACLES: dict[str, str] = {"op8_warc_transactions": OP8_SQL, "op10_quality_divergence": OP10_SQL}
