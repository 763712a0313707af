"""Queries of the training-data operators and their DuckDB equivalents."""

from __future__ import annotations

from millstone.llm.align import op11_alignment
from millstone.llm.bpe import op5_bpe
from millstone.llm.chat import OP1_SQL, op1_chat_format
from millstone.llm.compression import op7_quality
from millstone.llm.decontam import OP2_SQL, op2_decontamination
from millstone.llm.embeddings import op4_embedding_dedup
from millstone.llm.lines import OP9_SQL, op9_line_dedup
from millstone.llm.minhash import op6_minhash
from millstone.llm.phrases import OP12_SQL, op12_collocations
from millstone.llm.repeats import op10_repeats
from millstone.llm.secrets import op3_secret_scan
from millstone.llm.shards import op13_sharding
from millstone.llm.subwords import op8_toxicity

LLM_QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_decontamination": op2_decontamination,
    "op3_secret_scan": op3_secret_scan,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_bpe": op5_bpe,
    "op6_minhash": op6_minhash,
    "op7_quality": op7_quality,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_repeats": op10_repeats,
    "op11_alignment": op11_alignment,
    "op12_collocations": op12_collocations,
    "op13_sharding": op13_sharding,
}

LLM_ORACLE = {
    "op1_chat_format": OP1_SQL,
    "op2_decontamination": OP2_SQL,
    "op9_line_dedup": OP9_SQL,
    "op12_collocations": OP12_SQL,
}
