"""Spec-driven dataset generation and dataset quality checks as Spark DataFrame jobs."""

from gristmill.plans.evaluate import EvaluationOptions, evaluate, quality_report
from gristmill.plans.linked import (
    GenerationOptions,
    evaluate_entities,
    generate_linked,
    generate_with_fallbacks,
    linked_report,
    validate_entities,
)
from gristmill.session import build_session
from gristmill.spec import load_spec

__all__ = [
    "EvaluationOptions",
    "GenerationOptions",
    "build_session",
    "evaluate",
    "evaluate_entities",
    "generate_linked",
    "generate_with_fallbacks",
    "linked_report",
    "load_spec",
    "quality_report",
    "validate_entities",
]
