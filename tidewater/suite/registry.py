"""All registered queries and oracles, merged from the suite modules."""

from __future__ import annotations

import importlib

MODULES = ["relational", "features", "profiling", "querylog", "text", "streaming", "sources"]


def _modules():
    return [importlib.import_module(f"tidewater.suite.{m}") for m in MODULES]


def queries():
    out = {}
    for m in _modules():
        for k, v in m.Q.items():
            if k in out:
                raise ValueError(f"duplicate query {k}")
            out[k] = v
    return out


def oracles():
    out = {}
    for m in _modules():
        out.update(m.O)
    return out
