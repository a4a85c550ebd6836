"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import importlib

#: One module of this subpackage for each operator; each has QUERIES and ORACLES.
_MODULES = ["q_bpe", "q_url", "q_lang", "q_warc", "q_tox", "q_near", "q_lines", "q_decon", "q_pii", "q_ann", "q_variants", "q_pack", "q_trie"]


def _modules():
    return [importlib.import_module(f"shelfloom.llm.{m}") for m in _MODULES]


def queries() -> dict:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracles() -> dict:
    return {k: v for m in _modules() for k, v in m.ORACLES.items()}
