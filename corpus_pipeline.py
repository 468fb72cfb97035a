"""Cleaning of a corpus in stages; each is one operator of ``orelayer.llm``."""

from __future__ import annotations

from orelayer.llm.stages import ORACLE_SQL, STAGES, run  # noqa: F401
