"""Chat formatting with a verified round trip, DataFrame operations only.

Template of a conversation, turn after turn:

    <s>[ROLE] text</s>

``<s>``, ``</s>``, ``[INST]`` and ``[/INST]`` are control strings; ROLE is the
turn's role.  The escape of a control string puts a backslash after its first
character, before any that are there (``</s>`` to ``<\\/s>``, ``<\\/s>`` to
``<\\\\/s>``); taking one away reverses it, so escaping is one to one.

The grammar is deterministic: a turn ends at the first ``</s>``, its role at
the first ``] ``, and the rest is text to unescape.  Every conversation is
first rendered as it is, parsed back and compared with its source; the texts
(or roles) of the turns that came back changed are escaped and the whole is
parsed and compared again; last, all turns are escaped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>[", "</s>"
#: A control string with any backslashes after its first character.
CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _escape_role(role: Column) -> Column:
    """A role's ``]`` and backslashes, besides control strings."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(role, r"\\", r"\\\\"), r"\]", r"\\c"), "<", r"\\l")


def _unescape_role(role: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\l", "$1<"), r"(?<!\\)((?:\\\\)*)\\c", "$1]")
    return F.regexp_replace(plain, r"\\\\", r"\\")


def render_turn(role: Column, text: Column, escaped: Column) -> Column:
    return F.concat(F.lit(OPEN), _escape_role(role), F.lit("] "), F.when(escaped, escape(text)).otherwise(text), F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation: array of (role, text, start, length),
    the text unescaped; start (from 0) and length mark its form in
    ``formatted``.  A turn that does not open as the grammar says has a null
    role."""
    pieces = F.split(formatted, r"</s>", -1)
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    # start of each piece: the pieces and closes before it
    empty = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<piece:string,at:int>>)").alias("out"))
    step = lambda a, p: F.struct((a["at"] + F.length(p) + len(CLOSE)).alias("at"), F.concat(a["out"], F.array(F.struct(p.alias("piece"), a["at"].alias("at")))).alias("out"))
    placed = F.aggregate(pieces, empty, step)["out"]
    return F.transform(placed, _turn)


def _turn(x: Column) -> Column:
    piece, at = x["piece"], x["at"]
    head = F.instr(piece, "] ")
    good = piece.startswith(OPEN) & (head > len(OPEN))
    role = _unescape_role(F.substring(piece, len(OPEN) + 1, head - len(OPEN) - 1))
    raw = F.substring(piece, head + 2, F.length(piece))
    return F.struct(
        F.when(good, role).alias("role"),
        F.when(good, unescape(raw)).otherwise(piece).alias("text"),
        F.when(good, at + head + 1).otherwise(at).alias("start"),
        F.when(good, F.length(raw)).otherwise(F.length(piece)).alias("length"),
    )


def _same(turns: Column, parsed: Column) -> Column:
    back = F.transform(parsed, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return back == turns


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans, level, round_trip, turns): one row per
    conversation.

    ``loss_spans``: start (from 0) and length, in code points of
    ``formatted``, of each assistant text in order.  ``level``: 0 if nothing
    needed escaping, 1 if the turns that conflicted did, 2 if all were
    escaped.  ``round_trip`` is true where the parsed turns equal the source,
    and a row where they do not stops the job.

    Turns are ordered by turn, role and text (nulls first; repeated rows stay);
    null texts and roles are empty; rows with a null conv_id are one
    conversation; other columns are ignored; an empty table gives an empty
    table.  A conversation is one row of the result and so must fit in
    memory.
    """
    src = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    conv = src.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    conv = conv.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))

    def rendered(marked: Column) -> Column:
        return F.array_join(F.transform(marked, lambda t: render_turn(t["role"], t["text"], t["e"])), "")

    def mark(how) -> Column:
        return F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), how(t).alias("e")))

    # level 0 as it is; level 1: what a turn alone would not give back is escaped
    changed = lambda t: (F.size(F.split(t["text"], CLOSE, -1)) > 1) | (unescape(t["text"]) != t["text"])
    conv = conv.withColumn("f0", rendered(mark(lambda t: F.lit(False)))).withColumn("p0", parse(F.col("f0")))
    conv = conv.withColumn("ok0", _same(F.col("turns"), F.col("p0")))
    conv = conv.withColumn("f1", F.when(~F.col("ok0"), rendered(mark(changed)))).withColumn("p1", parse(F.col("f1")))
    conv = conv.withColumn("ok1", F.coalesce(_same(F.col("turns"), F.col("p1")), F.lit(False)))
    conv = conv.withColumn("f2", F.when(~F.col("ok0") & ~F.col("ok1"), rendered(mark(lambda t: F.lit(True))))).withColumn("p2", parse(F.col("f2")))
    conv = conv.withColumn("level", F.when(F.col("ok0"), 0).when(F.col("ok1"), 1).otherwise(2))
    conv = conv.withColumn("formatted", F.coalesce(F.when(F.col("ok0"), F.col("f0")), F.when(F.col("ok1"), F.col("f1")), F.col("f2")))
    conv = conv.withColumn("parsed", F.when(F.col("ok0"), F.col("p0")).when(F.col("ok1"), F.col("p1")).otherwise(F.col("p2")))
    trip = _same(F.col("turns"), F.col("parsed"))
    loss = F.transform(F.filter("parsed", lambda t: t["role"] == LOSS_ROLE), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    checked = F.when(trip, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no round trip: conversation "), F.col("conv_id").cast("string"))).cast("boolean"))
    return conv.select("conv_id", "formatted", loss.alias("loss_spans"), "level", checked.alias("round_trip"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars) from ``conv_id``, ``formatted`` and ``loss_spans`` alone."""
    parsed = parse(F.col("formatted"))
    turns = F.array_join(F.transform(parsed, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    out = formatted.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), F.size(parsed).cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), loss.alias("loss"))
    return out.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
