"""A plain, slow statement of the label definition, for comparing with Spark."""

import re

from scanledger.functions import fixed_values as fixed
from scanledger.operators.lexicon import ConceptRule


def find(pattern, text):
    return re.search(pattern, text, re.IGNORECASE)


def region(text):
    hit = find(fixed.FINDINGS_HEADING, text)
    return text[hit.start():].strip() if hit else text


def drop_blocks(text, ends):
    opening = re.compile(rf"(?:{'|'.join(fixed.SKIPPED_HEADINGS)})\s*:?", re.IGNORECASE)
    kept, inside = [], False
    for line in text.splitlines():
        if opening.fullmatch(line.strip()):
            inside = True
        else:
            inside = inside and not ends(line.strip())
            if not inside:
                kept.append(line)
    return "\n".join(kept)


def known_heading(line):
    return re.fullmatch(rf"(?:{'|'.join(fixed.KEPT_HEADINGS)})\s*:?", line, re.IGNORECASE)


def upper_heading(line):
    return re.fullmatch(fixed.UPPER_CASE_HEADING, line)


def eligible(text, mode):
    text = region(text or "")
    if mode == "direct":
        text = drop_blocks(text, upper_heading)
    return drop_blocks(text, known_heading).strip()


def split_sentences(text):
    return [s.strip() for s in re.split(r"(?<=[.?!])\s+|\n+", text) if s.strip()]


def negated(sentence, at):
    before = sentence[max(0, at - fixed.WINDOW_BEFORE):at]
    after = sentence[at:at + fixed.WINDOW_AFTER]
    return any(find(c, before) for c in fixed.NEGATION_CUES) or bool(find(fixed.NEGATION_AFTER, after))


def unsure(sentence):
    return any(find(c, sentence) for c in fixed.UNCERTAINTY_CUES)


def top(items):
    seen = {}
    for item in items:
        seen.setdefault(item.lower().strip(), item)
    return list(seen.values())[:fixed.MAX_EVIDENCE]


def judge(rule, sentence):
    if any(find(p, sentence) for p in rule.forbid) or not all(find(p, sentence) for p in rule.require):
        return set()
    if any(find(p, sentence) for p in rule.always_present):
        return {"P"}
    kinds = set()
    for p in rule.mentions:
        hit = find(p, sentence)
        if hit and negated(sentence, hit.start()):
            kinds.add("A")
        elif hit:
            vague = any(find(q, sentence) for q in rule.special_uncertain) or unsure(sentence)
            kinds.add("U" if vague else "P")
    return kinds


def label_concept(rule, text_sentences):
    kinds = [(s, judge(rule, s)) for s in text_sentences]
    stated = {k: [s for s, ks in kinds if k in ks] for k in "PUA"}
    if stated["P"]:
        label, evidence = 1, stated["P"]
    elif stated["U"] and not stated["A"]:
        label, evidence = -1, stated["U"]
    else:
        label, evidence = 0, stated["A"]
    evidence = top(evidence)
    if rule.evidence_context:
        kept = [e for e in evidence if find(rule.evidence_context, e)]
        if kept:
            evidence = kept
        elif label == 1:
            label, evidence = 0, []
    return label, evidence


def label_lesion(rule, text_sentences, other_label):
    present, uncertain = [], []
    for s in text_sentences:
        hit = find(rule.mention, s)
        if not (hit and find(rule.context, s)) or negated(s, hit.start()):
            continue
        confirmed, equivocal = find(rule.confirming, s), find(rule.equivocal, s)
        if find(rule.excluding, s) and not confirmed:
            continue
        if confirmed and not (unsure(s) or equivocal):
            present.append(s)
        elif confirmed or equivocal:
            uncertain.append(s)
    if present:
        return 1, top(present)
    if uncertain and other_label != 1:
        return -1, top(uncertain)
    return 0, []


def label_report(text, rules, mode="report"):
    parts = split_sentences(eligible(text, mode))
    out = {r.name: label_concept(r, parts) for r in rules if isinstance(r, ConceptRule)}
    for r in rules:
        if not isinstance(r, ConceptRule):
            out[r.name] = label_lesion(r, parts, out[r.yields_to][0])
    return out
