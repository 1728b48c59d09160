r"""Chat formatting checked by a grammar round trip.

The grammar of a formatted conversation::

    conversation := turn*
    turn         := "<|im_start|>" role "\n" text "<|im_end|>" "\n"

An escape puts one backslash between ``<`` and ``|`` (``<|`` -> ``<\|``, ``<\|`` ->
``<\\|``); reading takes one backslash out. No escaped text holds ``<|``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskline.llm.common import text_of

START, END = "<|im_start|>", "<|im_end|>"
_NEWLINE = "<|nl|>"  # a line feed inside a role; free in escaped text


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(_NEWLINE))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(_NEWLINE), F.lit("\n")))


def _render(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit("\n"), turn["text"], F.lit(END + "\n"))


def pieces(formatted: Column) -> Column:
    """The formatted text cut at its end marks. What follows the last one belongs to no turn; it is empty in a sound text."""
    cut = F.split(formatted, r"<\|im_end\|>\n?")
    return F.when(F.endswith(formatted, F.lit(END + "\n")), F.slice(cut, 1, F.size(cut) - 1)).otherwise(cut)


def read_turns(cut: Column) -> Column:
    """The turns of a formatted text from its pieces: an array of (role, text, head, body).

    ``head`` and ``body`` are the code points before and of the text as it stands in
    the formatted one. A piece that does not begin with the start mark gives a turn
    with a null role, so a text that breaks the grammar never reads as the turns it
    came from. ``cut`` has to be a column of its own: each piece is read once.
    """
    mark = len(START)

    def turn(piece: Column) -> Column:
        head = F.instr(piece, "\n")
        rest = F.substring(piece, F.lit(mark + 1), F.length(piece))
        sound = piece.startswith(START) & (head > mark) & ~F.contains(rest, F.lit(START))
        role = F.when(sound, _unescape_role(F.substring(piece, F.lit(mark + 1), head - mark - 1)))
        body = F.substring(piece, head + 1, F.length(piece))
        return F.struct(role.alias("role"), unescape(body).alias("text"), head.alias("head"), F.length(body).alias("body"))

    return F.transform(cut, turn)


def _same(read: Column, source: Column) -> Column:
    def plain(turns: Column) -> Column:
        return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))

    return F.coalesce(plain(read) == plain(source), F.lit(False))


def _read(df: DataFrame, formatted: Column, name: str) -> DataFrame:
    """``df`` with ``name``, the turns read from ``formatted``."""
    return df.withColumn("__cut", pieces(formatted)).withColumn(name, read_turns(F.col("__cut"))).drop("__cut")


def chat_format(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``turns``, ``loss_mask``, ``round_trip``.

    Each turn is rendered as it is and read back alone; if it does not come back
    the same, its role and text are escaped. The conversation is then rendered and
    read back as a whole; one that still differs is rendered with every turn
    escaped, which the grammar always reads back. ``turns`` is what was read from
    ``formatted`` (role, text, head, body). ``loss_mask`` covers ``formatted`` in
    runs of (code points, loss): the texts of ``loss_role`` are under it, marks and
    roles are not. ``round_trip`` says whether the turns read equal the source.

    A conversation is one row of the result, so its turns meet in one task; a hot
    first turn or a text that recurs moves nothing together. All steps are linear in
    the text. Turns are in order of ``turn``, nulls first, equal ones by role and
    text; repeated rows are repeated turns. A null role or text is empty. Null ids
    are one conversation. Other input columns are ignored. No rows give no
    conversations.
    """
    raw = turns.select(
        F.col("conv_id"), F.struct(F.col("turn"), text_of("role").alias("role"), text_of("text").alias("text")).alias("t")
    )
    raw = _read(raw, _render(F.col("t")), "read")
    sound = _same(F.col("read"), F.array(F.col("t")))
    safe = F.struct(_escape_role(F.col("t.role")).alias("role"), escape(F.col("t.text")).alias("text"))
    plain = F.struct(F.col("t.role").alias("role"), F.col("t.text").alias("text"))
    one = raw.select(
        "conv_id", F.struct("t.turn", "t.role", "t.text", F.when(sound, plain).otherwise(safe).alias("out")).alias("t")
    )
    whole = one.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("source"))
    lines = F.transform("source", lambda t: _render(t["out"]))
    whole = _read(whole.withColumn("formatted", F.array_join(lines, "")), F.col("formatted"), "turns")
    whole = whole.withColumn("agreed", _same(F.col("turns"), F.col("source")))
    all_safe = F.transform(
        "source", lambda t: _render(F.struct(_escape_role(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    )
    whole = whole.withColumn("final", F.when(F.col("agreed"), F.col("formatted")).otherwise(F.array_join(all_safe, "")))
    whole = _read(whole.drop("formatted", "turns"), F.col("final"), "turns")
    runs = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(t["head"].alias("chars"), F.lit(False).alias("loss")),
                F.struct(t["body"].alias("chars"), (t["role"] == loss_role).alias("loss")),
                F.struct(F.lit(len(END) + 1).alias("chars"), F.lit(False).alias("loss")),
            ),
        )
    )
    return whole.select(
        "conv_id", F.col("final").alias("formatted"), "turns", runs.alias("loss_mask"),
        _same(F.col("turns"), F.col("source")).alias("round_trip"),
    )


def loss_text(turns: Column, loss_role: str = "assistant") -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == loss_role), lambda t: t["text"]), "")
