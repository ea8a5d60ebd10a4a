r"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of the output::

    conversation := turn*
    turn         := "<|" role "|>" text "</s>"

A deterministic parser splits at every ``</s>``, takes the role between the first ``<|`` and
``|>`` and the rest as text, and takes escapes back. A control string anywhere else is a mark
that the grammar does not allow there, so such a turn is not recovered: a text cannot forge
a role. A role or text is written raw; if the
parser does not recover exactly that turn from it, its control strings are escaped; if that
fails too, every backslash, ``<``, ``|`` and ``[`` is. Escapes are ``\b`` for a backslash,
``\l`` for ``<``, ``\p`` for ``|`` and ``\s`` for ``[``, so nothing is lost. After rendering,
the whole conversation is parsed again and must equal its source.

The loss mask is the list of spans (start, length in code points; the same in UTF-8 bytes, from
where a reader can cut without counting characters) of assistant texts in the output. Everything
the query reports is read back from the output: turns from the parser, loss text from the spans.
Starts are running sums in chunks, so work grows with the output, not with its square.

Defined cases: turns are ordered by turn, then role, then text, nulls first; repeated rows are
repeated turns; null role and null text are empty; a null conversation id is one conversation;
an empty table gives no conversation; extra columns are not read.

Scale: rendering and its check run per row, before the one shuffle that brings the turns of a
conversation together. A conversation is one output string, so it has to fit in memory; nothing
else is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.arrays import running_starts

OPEN, SHUT, END = "<|", "|>", "</s>"
#: Strings that a reader of the output, or of a common template, could take for a mark.
CONTROL = (END, OPEN, SHUT, "[INST]", "[/INST]", "<s>")
CODES = {"<": "\\l", "|": "\\p", "[": "\\s"}
TRAINED = "assistant"


def _swap(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape_control(text: Column) -> Column:
    """Escape backslashes and the first character of every control string."""
    out = _swap(text, "\\", "\\b")
    for mark in CONTROL:
        out = _swap(out, mark, CODES[mark[0]] + mark[1:])
    return out


def escape_all(text: Column) -> Column:
    out = _swap(text, "\\", "\\b")
    for char, code in CODES.items():
        out = _swap(out, char, code)
    return out


def unescape(text: Column) -> Column:
    for char, code in CODES.items():
        text = _swap(text, code, char)
    return _swap(text, "\\b", "\\")


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(SHUT), text, F.lit(END))


def _turn(piece: Column) -> Column:
    """Role and text of a rendered turn without its end mark, still escaped."""
    at = F.locate(SHUT, piece)
    role = F.substring(piece, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
    text = F.substring(piece, at + len(SHUT), F.length(piece))
    ok = piece.startswith(OPEN) & (at > 0)
    for mark in CONTROL:
        ok = ok & ~role.contains(mark) & ~text.contains(mark)
    return F.when(ok, F.struct(role.alias("role"), text.alias("text")))


def parse(formatted: Column) -> Column:
    """Turns (role, text) of an output; a null turn where it does not follow the grammar."""
    pieces = F.split(formatted, r"\Q" + END + r"\E", -1)
    turns = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), _turn)
    return F.transform(turns, lambda t: F.when(t.isNotNull(), F.struct(
        unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text"))))


def format_conversations(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, formatted, mask (spans of assistant texts).

    Fails if an output does not parse back to its source.
    """
    source = rows.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    itself = F.array(F.struct("role", "text"))
    raw, some, every = (
        _rendered(how(F.col("role")), how(F.col("text")))
        for how in (lambda c: c, escape_control, escape_all))
    chosen = (F.when(parse(raw) == itself, raw).when(parse(some) == itself, some)
              .otherwise(every))
    turns = source.withColumn("piece", chosen)
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("turn", "role", "text", "piece"))).alias("turns"))
    whole = grouped.withColumn("formatted", F.array_join(
        F.transform("turns", lambda t: t["piece"]), ""))
    checked = whole.withColumn("back", parse(F.col("formatted"))).withColumn(
        "formatted", F.when(
            F.col("back") == F.transform("turns", lambda t: F.struct(
                t["role"].alias("role"), t["text"].alias("text"))), F.col("formatted"))
        .otherwise(F.raise_error(F.lit("a conversation does not parse back to its source"))))
    head = lambda t: F.locate(SHUT, t["piece"]) + len(SHUT) - 1
    size = lambda c: F.octet_length(c)
    pieces = F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), F.length(t["piece"]).alias("n"), size(t["piece"]).alias("bytes"),
        head(t).alias("head"), size(F.substring(t["piece"], F.lit(1), head(t))).alias("head_bytes")))
    placed = checked.select("conv_id", "formatted", pieces.alias("pieces"))
    starts = placed.withColumns({
        "starts": running_starts(F.transform("pieces", lambda p: p["n"])),
        "byte_starts": running_starts(F.transform("pieces", lambda p: p["bytes"]))})
    spans = F.transform(
        F.arrays_zip("pieces", "starts", "byte_starts"), lambda z: F.when(
            z["pieces"]["role"] == TRAINED, F.struct(
                (z["starts"] + z["pieces"]["head"] + 1).alias("start"),
                (z["pieces"]["n"] - z["pieces"]["head"] - len(END)).alias("length"),
                (z["byte_starts"] + z["pieces"]["head_bytes"] + 1).alias("start_byte"),
                (z["pieces"]["bytes"] - z["pieces"]["head_bytes"] - len(END)).alias("n_bytes"))))
    return starts.select(
        "conv_id", "formatted", F.filter(spans, lambda s: s.isNotNull()).alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text recovered from the outputs alone."""
    raw = F.col("formatted").cast("binary")
    loss = F.element_at(F.transform(F.array(raw), lambda b: F.array_join(F.transform(
        "mask", lambda s: unescape(F.substring(b, s["start_byte"], s["n_bytes"]).cast("string"))),
        "")), 1)
    return formatted.select(
        "conv_id", parse(F.col("formatted")).alias("turns"), loss.alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"))
