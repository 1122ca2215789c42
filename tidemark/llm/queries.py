"""The registered corpus queries: functions of (spark, folder of Parquet tables), and their SQL."""

from __future__ import annotations

from tidemark.llm import audit, bpe, chat, decontam, extract, records, rlz, runs, sharding, simhash, suffix, topk, toxicity

QUERIES = {
    "op1_relative_lempel_ziv": rlz.op1,
    "op2_decontamination": decontam.op2,
    "op3_exact_top_k": topk.op3,
    "op4_suffix_array": suffix.op4,
    "op5_hypergeometric_shards": sharding.op5,
    "op6_framed_records": records.op6,
    "op7_byte_pair_round_trip": bpe.op7,
    "op8_simhash_components": simhash.op8,
    "op9_page_text": extract.op9,
    "op10_toxicity": toxicity.op10,
    "op11_chat_format": chat.op11,
    "op12_filter_audit": audit.op12,
    "op13_periodic_runs": runs.op13,
}

SQL = {"op3_exact_top_k": topk.OP3_SQL, "op11_chat_format": chat.OP11_SQL, "op12_filter_audit": audit.OP12_SQL}
