"""Queries of this subpackage, and their SQL where SQL can express them."""

from . import bpe, decontaminate, licenses, lm, near, quality, substrings, token_files, topk, warc

QUERIES = {
    "op1_licenses": licenses.op1_licenses,
    "op2_warc": warc.op2_warc,
    "op3_quality": quality.op3_quality,
    "op4_near_join": near.op4_near_join,
    "op5_substring_dedup": substrings.op5_substring_dedup,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_bpe": bpe.op7_bpe,
    "op8_language_model": lm.op8_language_model,
    "op9_token_files": token_files.op9_token_files,
    "op10_top_k": topk.op10_top_k,
}

ORACLE_SQL = {
    "op2_warc": warc.OP2_SQL,
    "op10_top_k": topk.OP10_SQL,
}
