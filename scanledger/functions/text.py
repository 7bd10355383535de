"""Text columns: blanks, report regions, sentences.

All of it is built-in column expressions over one row, so none of it shuffles.
``pattern`` marks a regular expression for Java so that it behaves like the
Python expression it was written as: ``i`` no case, ``U`` Unicode blanks and
word characters, ``d`` only a line feed ends a line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import (
    BLANKS,
    FINDINGS_HEADING,
    KEPT_HEADINGS,
    LINE_BREAKS_BEYOND_LF,
    SKIPPED_HEADINGS,
    UPPER_CASE_HEADING,
)

_BLANK = r"[\s\x1c-\x1f]"
_LINE_BLANK = r"[[^\S\n]\x1f]"


def pattern(regex: str) -> str:
    return f"(?iUd){regex}"


def sql_text(value: str) -> str:
    """A text as a Spark SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def any_of(regexes) -> str:
    """One expression that matches where any of ``regexes`` does.

    Word boundaries that all alternatives share are tested once, in front of
    and behind the alternatives, which makes a search several times faster.
    """
    regexes = list(regexes)
    if any("[" in r or _has_top_level_bar(r) for r in regexes):
        return pattern("|".join(f"(?:{r})" for r in regexes))
    edge = r"\b"
    before = edge if all(r.startswith(edge) for r in regexes) else ""
    after = edge if all(r.endswith(edge) and len(r) > len(edge) for r in regexes) else ""
    inner = "|".join(r[len(before) : len(r) - len(after)] for r in regexes)
    return pattern(f"{before}(?:{inner}){after}")


def _has_top_level_bar(regex: str) -> bool:
    depth = 0
    for at, char in enumerate(regex):
        if regex[at - 1 : at] == "\\":
            continue
        depth += (char == "(") - (char == ")")
        if char == "|" and depth == 0:
            return True
    return False


def matches(text: Column, regex: str) -> Column:
    """Does the case-insensitive ``regex`` occur in ``text``?"""
    return text.rlike(pattern(regex))


def strip(text: Column) -> Column:
    """Remove leading and trailing blanks of every kind, not just spaces."""
    return F.trim(text, F.lit(BLANKS))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def squeeze(text: Column) -> Column:
    """One space for each run of blanks, none at the ends."""
    return strip(F.regexp_replace(text, f"(?U){_BLANK}+", " "))


def fold(text: Column) -> Column:
    """Lower case, with the letters that match i or s without regard to case.

    Those are the long s, the dotless i and the combining dot a dotted capital I
    leaves behind; a text of plain ASCII has none.  ``text`` is used several
    times, so it should be a column or bound by ``let``.
    """
    lowered = F.lower(text)
    folded = lowered
    for special, letter in (("\u017f", "s"), ("\u0131", "i"), ("i\u0307", "i")):
        folded = F.replace(folded, F.lit(special), F.lit(letter))
    return F.when(F.octet_length(text) == F.length(text), lowered).otherwise(folded)


def findings_region(text: Column) -> Column:
    """From the first findings heading to the end, or the whole text without one."""
    text = F.coalesce(text, F.lit(""))
    region = F.regexp_extract(text, f"(?iUs){FINDINGS_HEADING}.*", 0)
    return let(region, lambda r: F.when(r != "", strip(r)).otherwise(text))


def unix_lines(text: Column) -> Column:
    """Every kind of line end as a line feed, and none at the very end."""

    def plain(t: Column) -> Column:
        # The bracket alone tells whether there is one: it holds the carriage return too.
        found = t.rlike(LINE_BREAKS_BEYOND_LF.split("|")[1])
        return F.when(found, F.regexp_replace(t, LINE_BREAKS_BEYOND_LF, "\n")).otherwise(t)

    def shortened(t: Column) -> Column:
        return F.when(F.endswith(t, F.lit("\n")), F.left(t, F.length(t) - 1)).otherwise(t)

    return let(let(F.coalesce(text, F.lit("")), plain), shortened)


def _may_have_blocks(folded: Column) -> Column:
    """Does any word of a skipped heading occur at all?"""
    stems = {name.split()[-1] for name in SKIPPED_HEADINGS}
    tests = [F.contains(folded, F.lit(stem)) for stem in sorted(stems)]
    return reduce(lambda x, y: x | y, tests)


def _without_blocks(lines: Column, stays_open: str) -> Column:
    """Drop each block that a skipped heading on its own line opens.

    Every line is written as a line feed and its content, so a block is its
    heading line followed by lines for which ``stays_open`` holds.  The
    possessive repeat keeps the match linear in the text.
    """
    opens = _heading_line(SKIPPED_HEADINGS)
    block = rf"(?Ud)\n{opens}(?:\n{stays_open}[^\n]*)*+"
    return F.substr(F.regexp_replace(F.concat(F.lit("\n"), lines), block, ""), F.lit(2))


def _heading_line(names) -> str:
    words = "|".join(names)
    return rf"{_LINE_BLANK}*+(?i:{words}){_LINE_BLANK}*+:?{_LINE_BLANK}*+(?=\n|\z)"


_STAYS_OPEN = {
    "report": rf"(?!{_heading_line(KEPT_HEADINGS)})",
    "direct": rf"(?:(?={_heading_line(SKIPPED_HEADINGS)})|(?!{_LINE_BLANK}*{UPPER_CASE_HEADING}{_LINE_BLANK}*(?=\n|\z)))",
}


def without_headed_blocks(text: Column) -> Column:
    """Remove history and indication blocks up to the next known heading."""
    return strip(_without_blocks(unix_lines(text), _STAYS_OPEN["report"]))


def without_upper_case_blocks(text: Column) -> Column:
    """The same blocks, ended only by an upper-case heading with a colon."""
    return _without_blocks(unix_lines(text), _STAYS_OPEN["direct"])


def report_lines(text: Column) -> Column:
    """The findings region with plain line ends: the first half of ``eligible_text``."""
    return unix_lines(findings_region(text))


def eligible_lines(lines: Column, folded: Column, mode: str = "report") -> Column:
    """The second half: ``report_lines`` without skipped blocks, given them folded too."""
    return strip(F.when(_may_have_blocks(folded), _without_blocks(lines, _STAYS_OPEN[mode])).otherwise(lines))


def eligible_text(text: Column, mode: str = "report") -> Column:
    """The part of a report that may support a label.

    ``report`` cuts a whole report (any known heading ends a skipped block).
    ``direct`` is for text handed straight to the rules, where only an
    upper-case heading ends one.  Both drop every skipped heading line, so one
    pass over the lines is enough in either mode.
    """
    if mode not in _STAYS_OPEN:
        raise ValueError(f"mode must be one of {sorted(_STAYS_OPEN)}, not {mode!r}")
    return let(
        report_lines(text), lambda lines: let(fold(lines), lambda folded: eligible_lines(lines, folded, mode))
    )


def sentences(text: Column) -> Column:
    """The stripped, non-empty sentences of ``text`` in order.

    A sentence ends after . ? ! before blanks, and at line ends.  The cut takes
    all blanks around it, so in a stripped text no part needs stripping and only
    an empty text gives an empty part.
    """
    # A run of blanks is looked at from its start alone, so the cut is linear in the text.
    cut = rf"(?U)(?<=[.?!]){_BLANK}++|(?<!{_BLANK})(?=[[^\S\n]\x1c-\x1f]*+\n){_BLANK}++"
    return F.array_remove(F.split(strip(text), cut), "")
