"""The corpus queries and their oracle SQL."""

from __future__ import annotations

from yardstick.llm.classifier import op6_nb_svm
from yardstick.llm.licenses import OP12_SQL, op12_rare_token_index
from yardstick.llm.linededup import op2_content_defined_lines
from yardstick.llm.lm import op7_elias_fano_trie
from yardstick.llm.mixing import op8_pfair_mixing
from yardstick.llm.neardup import OP4_SQL, op4_tensored_minhash
from yardstick.llm.packing import op9_harmonic_packing
from yardstick.llm.quality import op1_ngram_llr
from yardstick.llm.sharding import op10_external_shuffle
from yardstick.llm.spelling import op13_asymmetric_qchunks
from yardstick.llm.urls import OP3_SQL, op3_host_reputation
from yardstick.llm.vectors import OP5_SQL, op5_cover_tree
from yardstick.llm.whitening import op11_multiplicity_whitening

QUERIES = {f.__name__: f for f in (
    op1_ngram_llr, op2_content_defined_lines, op3_host_reputation, op4_tensored_minhash, op5_cover_tree, op6_nb_svm,
    op7_elias_fano_trie, op8_pfair_mixing, op9_harmonic_packing, op10_external_shuffle, op11_multiplicity_whitening,
    op12_rare_token_index, op13_asymmetric_qchunks)}
ORACLE_SQL = {"op3_host_reputation": OP3_SQL, "op4_tensored_minhash": OP4_SQL, "op5_cover_tree": OP5_SQL,
              "op12_rare_token_index": OP12_SQL}
