"""Import every plan module so their queries register."""

from __future__ import annotations

from . import collection, evaluation, html, needs, prepare, profile, quality, query_edits, retrieval, retrieval_variants, trials  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
