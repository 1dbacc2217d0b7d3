"""Detection, explanation and masking of personal identifiers, on PySpark.

    from veilgrid import detect_text, run, preset, with_lines, synthetic

``detect_text`` finds identifiers in plain texts, ``run`` takes documents with tokens and boxes through rules, a model and a
policy, ``mask_text`` and ``mask_rectangles`` hide what a run decided. All take and give DataFrames.
"""

from veilgrid.functions.labels import CATEGORIES, parse_field_labels
from veilgrid.operators.catalog import detect as detect_text
from veilgrid.operators.layout import synthetic, with_lines
from veilgrid.operators.masking import mask_text, of_run as mask_rectangles
from veilgrid.operators.ner import logits_provider
from veilgrid.operators.policy import Policy, from_json as policy_from_json, load as load_policy, preset, save as save_policy
from veilgrid.operators.spans import deduplicate, low_confidence
from veilgrid.plans.detect import Run, ocr_spans, run, text_spans
from veilgrid.session import clear, local_session
from veilgrid.sources.documents import run_document, write_evaluation, write_run

__all__ = [
    "CATEGORIES", "Policy", "Run", "clear", "deduplicate", "detect_text", "load_policy", "local_session", "logits_provider", "low_confidence", "mask_rectangles",
    "mask_text", "ocr_spans", "parse_field_labels", "policy_from_json", "preset", "run", "run_document", "save_policy", "synthetic", "text_spans", "with_lines",
    "write_evaluation", "write_run",
]
