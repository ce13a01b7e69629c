"""The registered queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

import corpus_pipeline
from argent.llm import collocations, preference, prefixtrie, urllist
from argent.llm.bpe import op6_bpe
from argent.llm.collocations import op13_collocations
from argent.llm.extract import op10_html_text
from argent.llm.fingerprints import op1_fingerprints
from argent.llm.langid import op12_language_id
from argent.llm.lshforest import op9_ngram_jaccard
from argent.llm.mixing import op5_mixing
from argent.llm.preference import op8_preferences
from argent.llm.prefixtrie import op11_prefix_trie
from argent.llm.sharding import op2_sharding
from argent.llm.topk import op3_topk
from argent.llm.toxicity import op4_toxicity
from argent.llm.urllist import op7_url_filters

REGISTRY = {
    "op1_fingerprints": op1_fingerprints,
    "op2_sharding": op2_sharding,
    "op3_topk": op3_topk,
    "op4_toxicity": op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_bpe": op6_bpe,
    "op7_url_filters": op7_url_filters,
    "op8_preferences": op8_preferences,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_html_text": op10_html_text,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_language_id": op12_language_id,
    "op13_collocations": op13_collocations,
    "pipeline": corpus_pipeline.run,
}

#: Hashes, learned models, exact BPE and searches have no SQL form; those
#: queries are tested against brute-force versions.
ORACLES: dict[str, str] = {
    "op7_url_filters": urllist.ORACLE,
    "op8_preferences": preference.ORACLE,
    "op11_prefix_trie": prefixtrie.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
