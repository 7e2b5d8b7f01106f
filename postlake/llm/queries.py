"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from postlake.llm import audit, bitslice, bpe, chat, crf, ctph, cutbpe, fptree, pivotal, rlz, simhash, unigram, urltrees

QUERIES = {
    "op1_rlz_substring_dedup": rlz.op1,
    "op2_pivotal_mix": pivotal.op2,
    "op3_bitslice_topk": bitslice.op3,
    "op4_url_trees": urltrees.op4,
    "op5_chat_template": chat.op5,
    "op6_crf_quality": crf.op6,
    "op7_simhash_ball": simhash.op7,
    "op8_ctph": ctph.op8,
    "op9_unigram_counts": unigram.op9,
    "op10_bpe_replay": bpe.op10,
    "op11_audit_repair": audit.op11,
    "op12_fp_tree_rank": fptree.op12,
    "op13_cut_bpe": cutbpe.op13,
}

ORACLE = {"op1_rlz_substring_dedup": rlz.OP1_SQL, "op3_bitslice_topk": bitslice.OP3_SQL, "op5_chat_template": chat.OP5_SQL,
          "op12_fp_tree_rank": fptree.OP12_SQL}
