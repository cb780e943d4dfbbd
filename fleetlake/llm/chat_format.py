"""Conversations as one marked text each, which a parser reads back to the same turns.

A turn is written as ``### role: text</turn>`` and a line end. Three strings
carry the structure: head and tail everywhere, the role's end inside a role. A
control string inside content is escaped by a backslash after its first
character (``<\\/turn>``); one that has such backslashes gets one more, so that
reading takes exactly one away and every text comes back.

Which content needs that is found by reading: every turn is written plainly,
read back by the parser and compared with its source; where they differ its
text is escaped, then its role too, until they are identical. All of it is
DataFrame functions, and done row by row before the rows of a conversation meet.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the template.
HEAD, ROLE_END, TAIL, LINE_END = "### ", ": ", "</turn>", "\n"
#: The control strings as first character and rest; backslashes between the two are escapes.
IN_TEXT = (("#", "## "), ("<", "/turn>"))
IN_ROLE = (*IN_TEXT, (":", " "))


def escape(content: Column, controls: tuple = IN_TEXT) -> Column:
    """One more backslash inside each control string, however many it has."""
    for first, rest in controls:
        content = F.regexp_replace(content, rf"{first}(\\*){rest}", rf"{first}$1\\{rest}")
    return content


def unescape(content: Column, controls: tuple = IN_TEXT) -> Column:
    """One backslash less inside each escaped control string."""
    for first, rest in controls:
        content = F.regexp_replace(content, rf"{first}\\(\\*){rest}", f"{first}$1{rest}")
    return content


@dataclass(frozen=True)
class Parsed:
    """One turn as read from its written form; ``valid`` tells whether that follows the grammar."""

    role: Column
    text: Column
    valid: Column


def write_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(ROLE_END), text, F.lit(TAIL + LINE_END))


def before_text(written: Column) -> Column:
    """Characters of a written turn before its text."""
    return F.instr(written, ROLE_END) + F.lit(len(ROLE_END) - 1)


def read_turn(written: Column) -> Parsed:
    """A head, a role up to its end, a text without head, the only tail, a line end."""
    turn = F.substring_index(written, TAIL, 1)
    body = F.substring(turn, F.lit(len(HEAD) + 1), F.length(turn))
    end = F.instr(body, ROLE_END)
    role = F.substring(body, F.lit(1), end - 1)
    text = F.substring(body, end + len(ROLE_END), F.length(body))
    one_tail = F.concat(turn, F.lit(TAIL + LINE_END)) == written
    valid = one_tail & F.startswith(turn, F.lit(HEAD)) & (F.instr(body, HEAD) == 0) & (end > 0)
    return Parsed(unescape(role, IN_ROLE), unescape(text), valid)


def round_trip(role: Column, text: Column) -> Column:
    """The turn's written form, escaped as far as it takes to read the same role and text back."""
    tried = []
    for form in (
        write_turn(role, text),
        write_turn(role, escape(text)),
        write_turn(escape(role, IN_ROLE), escape(text)),
    ):
        parsed = read_turn(form)
        tried.append(F.when(parsed.valid & (parsed.role == role) & (parsed.text == text), form))
    return F.coalesce(*tried, F.raise_error(F.lit("a turn does not read back as it was written")).cast("string"))


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans) of each conversation of (conv_id, turn, role, text).

    ``loss_spans`` has an entry for every turn in order: (start, end) of its
    written text in code points of ``formatted``, end exclusive, where the role
    is ``loss_role``, else NULL.

    Turns come in the order of ``turn``, NULL first, equal ones by role and
    text. NULL roles and texts count as empty; repeated rows are turns of their
    own; a NULL conv_id is a conversation. An empty table has no conversations.
    Further columns are left out, whatever they are called. Texts of any length
    are written whole; a conversation is one value and has to stay below 2 GB.
    Rows are written, read back and escaped before the exchange, so that a
    conversation with many turns costs its task only the joining.
    """
    role, text = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    written = rows.withColumn("written", round_trip(F.col("role"), F.col("text")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    size = F.length("written").cast("long")
    end = F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = written.withColumns({"n": F.row_number().over(order), "end": end})
    span = F.struct(
        (F.col("end") - size + before_text(F.col("written"))).alias("start"),
        (F.col("end") - len(TAIL + LINE_END)).alias("end"),
    )
    piece = F.struct("n", "written", F.when(F.col("role") == loss_role, span).alias("span"))
    joined = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    return joined.select(
        "conv_id",
        F.concat_ws("", "pieces.written").alias("formatted"),
        F.col("pieces.span").alias("loss_spans"),
    )


def read_chats(chats: DataFrame) -> DataFrame:
    """(conv_id, n, role, text, loss_text, chars) of every turn, read from ``format_chats``'s result alone.

    ``n`` counts from 0. ``loss_text`` is what the turn's loss span covers,
    unescaped; NULL without a span. ``chars`` is the length of the written turn.
    What breaks the grammar is an error. Every turn is cut out once, so that
    reading is linear in a conversation's length.
    """
    pieces = F.split("formatted", TAIL + LINE_END, -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    zipped = F.arrays_zip(pieces.alias("turn"), F.col("loss_spans").alias("span"))
    each = chats.select("conv_id", F.posexplode(zipped).alias("n", "turn")).select("conv_id", "n", "turn.turn", "turn.span")
    written = each.withColumn("written", F.concat("turn", F.lit(TAIL + LINE_END)))
    order = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("written").cast("long")
    placed = written.withColumn("at", F.sum(size).over(order) - size)
    parsed = read_turn(F.col("written"))
    start = (F.col("span.start") - F.col("at") + 1).cast("int")
    covered = F.substring(F.col("written"), start, (F.col("span.end") - F.col("span.start")).cast("int"))
    broken = F.raise_error(F.lit("a conversation breaks the grammar")).cast("string")
    return placed.select(
        "conv_id",
        "n",
        F.when(parsed.valid, parsed.role).otherwise(broken).alias("role"),
        parsed.text.alias("text"),
        unescape(covered).alias("loss_text"),
        size.alias("chars"),
    )
