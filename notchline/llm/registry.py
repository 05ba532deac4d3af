"""All registered queries of the subpackage, by operator number."""

from __future__ import annotations

from importlib import import_module

MODULES = ("preference_chat", "repair_shards", "viterbi_count", "fuzzy_lines", "toxicity_knn", "bpe_backtrack", "host_lines", "simhash_anchor", "template_decon", "license_patience", "langid_forward", "fim_regex", "tokenizer_links")

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
for _name in MODULES:
    _module = import_module(f"notchline.llm.{_name}")
    QUERIES |= _module.QUERIES
    ORACLE |= _module.ORACLE
