"""Imports every plan module so their queries register."""

from __future__ import annotations

import importlib

from docflow.plans.registry import ORACLE, QUERIES

MODULES = ["reports", "documents", "relational", "batching", "reconcile", "textsearch", "vectors_qa", "predictive", "io_queries", "stream_queries"]

for _m in MODULES:
    importlib.import_module(f"docflow.plans.{_m}")


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
