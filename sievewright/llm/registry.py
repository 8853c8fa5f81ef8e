"""The queries of the ten operators; ORACLES holds SQL where SQL can express one."""

from __future__ import annotations

from . import context_lm, license_scan, mixing, near_dup, nn_descent, ogg_media, packing, quote_threads, token_files, toxicity

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_context_lm": context_lm.op2_context_lm,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_packing": packing.op4_packing,
    "op5_nn_descent": nn_descent.op5_nn_descent,
    "op6_ogg_media": ogg_media.op6_ogg_media,
    "op7_token_files": token_files.op7_token_files,
    "op8_near_dup": near_dup.op8_near_dup,
    "op9_license_scan": license_scan.op9_license_scan,
    "op10_quote_threads": quote_threads.op10_quote_threads,
}
ORACLES: dict[str, str] = {
    "op9_license_scan": license_scan.oracle(),
}
