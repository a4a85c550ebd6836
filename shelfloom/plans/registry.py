"""Collects the queries and oracles of every query module."""

from __future__ import annotations

_MODULES = ["q_core", "q_io", "q_model", "q_rules"]


def _modules():
    import importlib

    return [importlib.import_module(f"shelfloom.plans.{m}") for m in _MODULES]


def queries() -> dict:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracles() -> dict:
    return {k: v for m in _modules() for k, v in m.ORACLES.items()}
