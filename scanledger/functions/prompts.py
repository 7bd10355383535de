"""Prompt texts and rendering them into a column.

The prompt texts are fixed values: what a model answers depends on every
character, so they are stated whole.  ``render`` fills a template with columns.
"""

from __future__ import annotations

import json
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import CONCEPT_QUESTIONS

# --- Stage prompts (fixed values) ---
REMOVE_COMPARISON = (
    "The following report might have references to previous reports or scans (i.e., comes with comparisons). \n"
    "This may be indicated by the presence of a COMPARISON section.  If this is the case, please remove the \n"
    "comparisons from the report and rewrite the sentences to remove comparisons. Go sentence by sentence.\n"
    'For sentences without comparisons (e.g., no words such as \\"newer\\"), output them verbatim without\n'
    "changing anything. For sentences with comparisons, minimally rewrite the sentence to remove comparisons.\n"
    'Your output should not include words such as \\"newer\\", \\"increased\\", or \\"improved\\"\n'
    "that indicate comparisons with previous reports or scans. Please output the raw report without adding other comments \n"
    "in the response. If there are no comparisons in the report, output the raw report without adding other comments.\n"
    "\n"
    "{report}\n"
)
EXTRACT_FINDINGS = (
    "This is a radiology report:\n"
    "{report}\n"
    "\n"
    "Please extract the following FINDING section verbatim from the report. \n"
    "It may be called FINDINGS, FINDINGS/IMPRESSIONS, IMPRESSIONS, or not have a section heading. "
    "It should give the detailed radiolgist analysis of the contents of the image.\n"
    "This section will generally be after the clinical history, after the technical details of image aqusition "
    "and before the final sign-off. \n"
    "Remove the section heading but do not omit any part of the radioligst analysis. "
    "Put all the extracted content verbatim under section heading called FINDINGS. \n"
    'If there is no findings section, output "No such section". \n'
)
FINDINGS_QUESTION = (
    "Based on the following radiology report:\n"
    "{report}\n"
    "\n"
    "{question} Answer Yes or No only.\n"
)
MAP_CATEGORY_FINDINGS = (
    "Given the following findings from a radiology report:\n"
    "{findings}\n"
    "\n"
    "Extract and summarize all findings relevant to the {category} category.\n"
    "Category description: {description}\n"
    "\n"
    'If there are no findings relevant to this category, output "No relevant findings".\n'
    "Otherwise, provide a concise summary of the findings specific to this category. \n"
    "Reuse language from the report verbatim as much as possible.  Do not add any other comments.\n"
)
# --- Label prompt (fixed values; the schema and key list in it follow the concepts) ---
LABEL_HEADER = (
    "You are extracting document-level disease labels from a radiology report's FINDINGS text.\n"
    "Return JSON only. No explanation, no markdown, no extra keys.\n\n"
    "Label meaning:\n"
    "  1 = present (ONLY if you can quote explicit supporting evidence)\n"
    "  0 = absent (explicitly negated or clearly stated absent)\n"
    " -1 = uncertain / equivocal / limited evaluation / cannot determine\n\n"
    "Global rules:\n"
    "- Use ONLY the provided FINDINGS text as evidence.\n"
    "- If evidence is uncertain (may/likely/possible/indeterminate/TSTC/limited eval), use -1 unless a definitive positive exists.\n"
    "- If both positive and negative statements exist, choose 1 only if there is a clear affirmative statement; otherwise -1.\n"
    "- For label=1 you MUST include at least one exact quote substring from the FINDINGS text in evidence.<disease>.\n\n"
    "Disease-specific rules:\n"
    "- coronary_calcification: label 1 ONLY if FINDINGS contains explicit 'coronary' AND a calcification cue.\n"
    "- renal_hypodensities vs renal_cyst: if renal hypodensities are interpreted as cysts, set renal_cyst=1 and renal_hypodensities=0.\n\n"
    "Output schema (keys must exactly match):\n"
)
LABEL_KEYS_LINE = "Disease keys: "
LABEL_TEXT_OPEN = "FINDINGS TEXT:\n-----\n"
LABEL_TEXT_CLOSE = "\n-----\n"

DEFAULT_TEMPLATES = {
    "remove_comparison": REMOVE_COMPARISON,
    "extract_findings": EXTRACT_FINDINGS,
    "findings_question": FINDINGS_QUESTION,
    "map_category_findings": MAP_CATEGORY_FINDINGS,
}


def render(template: str, **values: Column) -> Column:
    """Fill ``{name}`` placeholders with columns.

    The template is cut at its placeholders here, once, so text that arrives in
    a column is never read as a template itself.
    """
    pieces: list[Column] = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            if name not in values:
                raise ValueError(f"no column for placeholder {{{name}}}")
            pieces.append(F.coalesce(values[name], F.lit("")))
    return F.concat(*pieces) if pieces else F.lit("")


def label_prompt_parts(concepts: tuple[str, ...] = tuple(CONCEPT_QUESTIONS)) -> tuple[str, str]:
    """What stands before and after the report text in the label prompt."""
    schema = json.dumps(
        {"labels": dict.fromkeys(concepts, 0), "evidence": {c: [] for c in concepts}}, indent=2
    )
    opening = f"{LABEL_HEADER}{schema}\n\n{LABEL_KEYS_LINE}{', '.join(concepts)}\n\n{LABEL_TEXT_OPEN}"
    return opening, LABEL_TEXT_CLOSE


def label_prompt(text: Column, concepts: tuple[str, ...] = tuple(CONCEPT_QUESTIONS)) -> Column:
    """The prompt asking for labels and quotes of every concept in ``text``."""
    opening, closing = label_prompt_parts(concepts)
    return F.concat(F.lit(opening), F.coalesce(text, F.lit("")), F.lit(closing))
