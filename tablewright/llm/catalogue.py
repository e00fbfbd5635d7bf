"""All queries of this subpackage."""

import corpus_pipeline
from tablewright.llm import (  # noqa: F401
    chat,
    decontaminate,
    licenses,
    neardup,
    packing,
    periodic,
    quality,
    resampling,
    secrets,
    sentences,
    sharding,
    suffixes,
    tokens,
)
from tablewright.llm.common import ORACLE, QUERIES, register

__all__ = ["ORACLE", "QUERIES"]

register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
