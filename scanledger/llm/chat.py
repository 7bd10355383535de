r"""Chat formatting with a grammar that reads back what it wrote.

A turn is ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a line
feed.  The parser cuts at every end mark, wants one start mark at the front of
each piece and none behind it, ends a role at the first line feed, and takes one
backslash out of each ``<\|``, ``<\\|`` and so on.  A turn that does not come back
from the parser as it was is escaped: one backslash goes into each such place,
and into each ``<|``.  A line feed in a role is written as ``<\n|`` with the two
characters backslash and n.

Everything is built-in column functions.  Escaping looks at one turn alone; the
turns of a conversation meet in one row, which is the unit of training.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanledger.llm.common import narrow
from scanledger.session import settle

START, END = "<|im_start|>", "<|im_end|>"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(role, r"<(\\+n?|)\|", r"<\\$1|"), "\n", r"<\\n|")


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(role, r"<\\n\|", "\n"), r"<\\(\\+n|\\*)\|", "<$1|")


def render(role: Column, text: Column) -> Column:
    """A turn as it stands in the output, of a role and a text that are escaped where needed."""
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n"))


def _turn(piece: Column) -> Column:
    rest = F.substr(piece, F.lit(len(START) + 1))
    cut = F.locate("\n", rest)
    fits = piece.startswith(START) & ~rest.contains(START) & (cut > 0)
    role, text = F.substr(rest, F.lit(1), cut - 1), F.substr(rest, cut + 1)
    return F.when(fits, F.struct(unescape_role(role).alias("role"), unescape_text(text).alias("text")))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of an output by the grammar alone; null where it does not hold."""
    pieces = F.split(formatted, rf"\Q{END}\E", -1)
    bodies = F.slice(pieces, 1, F.size(pieces) - 1)
    turns = F.transform(bodies, lambda p, i: _turn(F.when(i == 0, p).when(p.startswith("\n"), F.substr(p, F.lit(2)))))
    return F.when(F.element_at(pieces, -1).isin("\n", "") & (F.size(pieces) > 1) | (formatted == ""), turns)


def _comes_back(role: Column, text: Column, rendered: Column) -> Column:
    return F.coalesce(parse(rendered) == F.array(F.struct(role.alias("role"), text.alias("text"))), F.lit(False))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """One row for each conversation: conv_id, formatted, loss_spans.

    Turns stand in the order of their turn number, null first, then of role and
    text; repeated rows are turns of their own.  Null roles and texts are empty.
    ``loss_spans`` are the places (start, end) in ``formatted``, in code points,
    of the texts of ``trained_role``.  Each row without a conversation id is a
    conversation of its own.  The run fails if a conversation does not come back from the
    parser exactly as it was.
    """
    rows = narrow(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).fillna("", ["role", "text"])
    rows = rows.withColumn("alone", F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()))
    role, text = F.col("role"), F.col("text")
    tried = settle(rows, {"plain": _comes_back(role, text, render(role, text))})
    shown = tried.withColumns({"shown_role": F.when(F.col("plain"), role).otherwise(escape_role(role)), "shown_text": F.when(F.col("plain"), text).otherwise(escape_text(text))})
    order = Window.partitionBy("conv_id", "alone").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    piece = render(F.col("shown_role"), F.col("shown_text"))
    placed = shown.withColumn("piece", piece).withColumns(
        {
            "place": F.row_number().over(order),
            "start": F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("shown_role") + len(START) + 1,
        }
    )
    own = F.struct("place", "piece", "role", "text", "start", (F.col("start") + F.length("shown_text")).alias("end"))
    joined = placed.groupBy("conv_id", "alone").agg(F.array_sort(F.collect_list(own)).alias("all"))
    whole = settle(joined, {"formatted": F.array_join(F.col("all.piece"), "")})
    source = F.transform("all", lambda t: F.struct(t.role.alias("role"), t.text.alias("text")))
    same = F.coalesce(parse(F.col("formatted")) == source, F.lit(False))
    spans = F.transform(F.filter("all", lambda t: t.role == trained_role), lambda t: F.struct(t.start.alias("start"), t.end.alias("end")))
    checked = F.when(same, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation does not come back from the parser")).cast("string"))
    return whole.select("conv_id", checked.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What an output holds: its turns by the parser, and the text under the loss mask, unescaped."""
    spans = F.transform("loss_spans", lambda s: unescape_text(F.substr(F.col("formatted"), (s.start + 1).cast("int"), (s.end - s.start).cast("int"))))
    return settle(formatted, {"turns": parse(F.col("formatted")), "loss_text": F.array_join(spans, "")})
