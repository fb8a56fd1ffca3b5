"""The corpus pipeline, as the driver runs it: see ``gristmill.llm.pipeline``."""

from __future__ import annotations

from gristmill.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
