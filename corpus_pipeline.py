"""From documents to token ids: the stages of a training-data pipeline."""

from __future__ import annotations

from tidemark.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
