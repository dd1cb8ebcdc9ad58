"""Import every query module so the registry is complete."""
from __future__ import annotations

import importlib

from .registry import ORACLES, QUERIES

_MODULES = ("q_text", "q_rows", "q_vectors", "q_eval", "q_models", "q_io", "q_extra")


def load() -> tuple[dict, dict]:
    for m in _MODULES:
        try:
            importlib.import_module(f"{__package__}.{m}")
        except ModuleNotFoundError as e:  # pragma: no cover - partial trees
            if e.name != f"{__package__}.{m}":
                raise
    return QUERIES, ORACLES
