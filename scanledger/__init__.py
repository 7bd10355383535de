"""Clinical report analytics on Spark."""

from .operators.combine import combine_stages
from .operators.enforce import enforce_labels, parse_label_responses
from .operators.labels import label_concepts, label_results, mentions, to_long, to_nested, to_wide
from .operators.lexicon import ConceptRule, LesionRule, default_lexicon
from .operators.metrics import (
    answered_cases,
    coverage_metrics,
    eval_categories,
    eval_correctness,
    eval_questions,
    evaluable_metrics,
    imperfect_tasks,
    predicted_cases,
)
from .operators.requests import build_requests, label_requests
from .operators.responses import apply_responses, integrity_report, parse_response_lines, valid_results
from .operators.sampling import qc_categories, qc_findings, qc_questions, sample_reports
from .plans.completion import complete
from .plans.stages import check_stage_inputs, run_stages
from .session import build_session
from .sources.catalog import Catalog, Category, read_catalog
from .sources.reports import read_reports
from .sources.store import StageStore

__all__ = [name for name in dir() if not name.startswith("_")]
