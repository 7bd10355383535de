"""What to look for: one rule per concept.

A rule is plain data.  ``operators.labels`` turns it into column expressions, so
a user adds concepts by writing more rules.  Patterns use the syntax Java and
Python regular expressions share and are searched without regard to case.
"""

from __future__ import annotations

from dataclasses import dataclass

from ..functions import fixed_values as fixed


@dataclass(frozen=True)
class ConceptRule:
    """A concept found through mentions in sentences.

    ``require`` / ``forbid``: patterns a sentence must all / must not contain.
    ``always_present``: a sentence with one counts as present, mention or not.
    ``special_uncertain``: turns a mention that is not negated into uncertain.
    ``evidence_context``: evidence must match it; present without any is absent.
    ``anchors``: lower-case words of which every mention or always-present
    phrase contains at least one.  They only save work; empty means unknown.
    """

    name: str
    mentions: tuple[str, ...]
    require: tuple[str, ...] = ()
    forbid: tuple[str, ...] = ()
    always_present: tuple[str, ...] = ()
    special_uncertain: tuple[str, ...] = ()
    evidence_context: str | None = None
    anchors: tuple[str, ...] = ()


@dataclass(frozen=True)
class LesionRule:
    """A finding that is only kept while another concept does not explain it.

    A sentence counts when it has ``context`` and ``mention`` and is not negated
    there.  ``confirming`` cues make it present (uncertain beside an uncertainty
    cue or an ``equivocal`` one), ``excluding`` cues without a confirming one
    drop it, ``equivocal`` alone makes it uncertain.  An uncertain document
    gives way to ``yields_to`` being present.
    """

    name: str
    context: str
    mention: str
    confirming: str
    excluding: str
    equivocal: str
    yields_to: str
    anchors: tuple[str, ...] = ()


# Words of which every mention of the concept contains one, for skipping reports early.
# Concepts share words where they can: each distinct word is looked for once.
_ANCHORS = {
    "submucosal_edema": ("edema", "enterocolitis", "gastritis"),
    "aortic_valve_calcification": ("aortic valv",),
    "coronary_calcification": ("coronary",),
    "thrombosis": ("thromb",),
    "metastatic_disease": ("metasta", "carcinomatosis", "omental caking", "tumor deposit"),
    "pancreatic_atrophy": ("pancrea",),
    "renal_cyst": ("cyst",),
    "osteopenia": ("osteopenia", "demineral"),
    "surgically_absent_gallbladder": ("gallbladder", "cholecystectomy"),
    "atelectasis": ("ectasis",),
    "abdominal_aortic_aneurysm": ("aortic aneurysm", "aaa"),
    "anasarca": ("anasarca", "edema"),
    "hiatal_hernia": ("hiatal hernia",),
    "lymphadenopathy": ("lymphadenopathy", "enlarged"),
    "prostatomegaly": ("megaly", "enlarged"),
    "biliary_ductal_dilation": ("biliary", "common bile duct"),
    "cardiomegaly": ("megaly", "enlarged"),
    "splenomegaly": ("megaly",),
    "hepatomegaly": ("megaly",),
    "atherosclerosis": ("atherosclero",),
    "ascites": ("ascites",),
    "pleural_effusion": ("effusion",),
    "hepatic_steatosis": ("hepatic steatosis", "fatty liver", "fatty infiltration"),
    "appendicitis": ("appendicitis",),
    "gallstones": ("gallstones", "cholelithiasis"),
    "hydronephrosis": ("hydro", "ectasis", "collecting system"),
    "bowel_obstruction": ("bowel obstruction", "sbo"),
    "free_air": ("free air", "pneumoperitoneum"),
    "fracture": ("fracture",),
}

_CONDITIONS = {
    "pleural_effusion": {"forbid": fixed.EFFUSION_FORBIDDEN},
    "coronary_calcification": {"require": fixed.CORONARY_REQUIRED, "forbid": fixed.CORONARY_FORBIDDEN},
    "renal_cyst": {"always_present": fixed.CYST_ALWAYS_PRESENT, "evidence_context": fixed.RENAL_CONTEXT},
    "hydronephrosis": {"special_uncertain": fixed.HYDRONEPHROSIS_SPECIAL},
}


def default_lexicon() -> tuple[ConceptRule | LesionRule, ...]:
    """The thirty built-in concepts in output order."""
    rules: list[ConceptRule | LesionRule] = []
    for name in fixed.CONCEPT_QUESTIONS:
        if name == "renal_hypodensities":
            rules.append(
                LesionRule(
                    name=name,
                    context=fixed.RENAL_CONTEXT,
                    mention=fixed.HYPODENSITY_MENTION,
                    confirming=fixed.NON_CYSTIC_CUES,
                    excluding=fixed.CYSTIC_CUES,
                    equivocal=fixed.TOO_SMALL_CUES,
                    yields_to="renal_cyst",
                    anchors=("hypodens", "renal mass", "renal lesion"),
                )
            )
        else:
            rules.append(
                ConceptRule(
                    name=name,
                    mentions=fixed.MENTIONS[name],
                    anchors=_ANCHORS[name],
                    **_CONDITIONS.get(name, {}),
                )
            )
    return tuple(rules)


def check_lexicon(rules) -> None:
    """Refuse duplicate names and lesion rules without the concept they yield to."""
    names = [r.name for r in rules]
    if len(set(names)) != len(names):
        raise ValueError("concept names must be unique")
    plain = {r.name for r in rules if isinstance(r, ConceptRule)}
    for rule in rules:
        if isinstance(rule, LesionRule) and rule.yields_to not in plain:
            raise ValueError(f"{rule.name} yields to {rule.yields_to}, which is not a concept rule")
        if isinstance(rule, ConceptRule) and not (rule.mentions or rule.always_present):
            raise ValueError(f"{rule.name} has nothing to look for")
