"""The operators as queries on the supplied tables."""

from __future__ import annotations

from holdfast.llm import decontaminate, divergence, lattice, sharding, warc
from holdfast.llm.decontaminate import op12_benchmark_decontamination
from holdfast.llm.divergence import op13_source_divergence
from holdfast.llm.lattice import op3_embedding_near_dedup
from holdfast.llm.mixing import op7_mixing_sources
from holdfast.llm.packing import op9_best_fit_packing
from holdfast.llm.periodic import op11_periodic_runs
from holdfast.llm.quality import op5_quality_rules
from holdfast.llm.secrets import op1_secret_scans
from holdfast.llm.sharding import op2_sharding
from holdfast.llm.simhash import op8_simhash_near_dedup
from holdfast.llm.token_counts import op4_token_counts
from holdfast.llm.toxicity import op6_toxicity
from holdfast.llm.warc import op10_warc

QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_sharding": op2_sharding,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_quality_rules": op5_quality_rules,
    "op6_toxicity": op6_toxicity,
    "op7_mixing_sources": op7_mixing_sources,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_warc": op10_warc,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_benchmark_decontamination": op12_benchmark_decontamination,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE: dict[str, str] = {
    "op2_sharding": sharding.ORACLE,
    "op3_embedding_near_dedup": lattice.ORACLE,
    "op10_warc": warc.ORACLE,
    "op12_benchmark_decontamination": decontaminate.ORACLE,
    "op13_source_divergence": divergence.ORACLE,
}
