"""The registered queries of this subpackage, with their SQL where there is some."""

from __future__ import annotations

from tallyline.llm.archives import op9_warc_from_arc
from tallyline.llm.merkle import OP11_SQL, op11_merkle_manifest
from tallyline.llm.minhash import op4_minhash_near_dedup
from tallyline.llm.packing import op1_best_fit_packing
from tallyline.llm.pages import op5_main_text
from tallyline.llm.pieces import op7_sampled_pieces
from tallyline.llm.polytope import op3_polytope_near_dedup
from tallyline.llm.prints import op12_document_fingerprints
from tallyline.llm.secrets import op2_secret_scan
from tallyline.llm.suffixes import op6_suffix_array_dedup
from tallyline.llm.topk import OP8_SQL, op8_exact_top_k
from tallyline.llm.toxicity import op10_toxicity
from tallyline.llm.turns import OP13_SQL, op13_conversation_trie

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_secret_scan": op2_secret_scan,
    "op3_polytope_near_dedup": op3_polytope_near_dedup,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_main_text": op5_main_text,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_sampled_pieces": op7_sampled_pieces,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_warc_from_arc": op9_warc_from_arc,
    "op10_toxicity": op10_toxicity,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLES: dict[str, str] = {
    "op8_exact_top_k": OP8_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op13_conversation_trie": OP13_SQL,
}
