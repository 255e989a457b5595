"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from trafficcast.llm.bpe import op3_bpe
from trafficcast.llm.collocations import OP11_SQL, op11_collocations
from trafficcast.llm.decontaminate import op9_decontamination
from trafficcast.llm.doc_digest import op6_digests
from trafficcast.llm.divergence import OP12_SQL, op12_source_divergence
from trafficcast.llm.exact_dedup import OP13_SQL, op13_exact_dedup
from trafficcast.llm.language_id import op2_language_id
from trafficcast.llm.licenses import op10_license_scan
from trafficcast.llm.line_dedup import OP4_SQL, op4_line_dedup
from trafficcast.llm.quality import op7_quality
from trafficcast.llm.repeats import op8_repeats
from trafficcast.llm.simhash import op5_simhash
from trafficcast.llm.token_counts import op1_token_counts

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_language_id": op2_language_id,
    "op3_bpe": op3_bpe,
    "op4_line_dedup": op4_line_dedup,
    "op5_simhash": op5_simhash,
    "op6_digests": op6_digests,
    "op7_quality": op7_quality,
    "op8_repeats": op8_repeats,
    "op9_decontamination": op9_decontamination,
    "op10_license_scan": op10_license_scan,
    "op11_collocations": op11_collocations,
    "op12_source_divergence": op12_source_divergence,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLES = {
    "op4_line_dedup": OP4_SQL,
    "op11_collocations": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
    "op13_exact_dedup": OP13_SQL,
}
