"""Chat formatting in Spark expressions only.

A conversation's rows are collected as structs, sorted by turn, and adjacent turns of one role are merged into one message:

    ### <role>
    <text></turn><text></turn>

with one `</turn>` after each turn, so the merge loses no turn.  In texts and roles a backslash, `#` and `<` (and a line feed
in a role) become a backslash and a letter, so no control string can occur inside them and the escape can be undone.  The loss mask is a list of
spans [start, start + length) in code points of the formatted text: the texts of assistant turns, without headers and
marks.

A conversation is one row, so its turns must fit into one task; the spans of its loss mask are appended one by one, so time grows
with the square of its turns (1,500 turns take a second).

Defined results: a null text or role is an empty one; turns are sorted by turn (null first), then role and text; repeated rows are turns of
their own; a null conversation id is a conversation; an empty table has no conversations; extra columns don't
come back, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER, END = "### ", "</turn>"
#: Escapes of control characters, the backslash first (fixed values).
_ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
_ROLE_ESCAPES = (*_ESCAPES, ("\n", "\\n"))


def _escaped(x: Column, escapes=_ESCAPES) -> Column:
    for plain, code in escapes:
        x = F.replace(x, F.lit(plain), F.lit(code))
    return x


def unescaped(x: Column, escapes=_ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        x = F.replace(x, F.lit(code), F.lit(plain))
    return x


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans array<struct<start, length>> for each conversation."""
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.struct(F.coalesce(F.col(f"`{turn_col}`").cast("long"), F.lit(-(1 << 63))).alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).alias("t"),
    )
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    n = F.size("turns")
    role = lambda i: F.get("turns", i)["role"]
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (role(i) != role(i - 1)))
    convs = convs.withColumn("starts", starts)
    messages = F.transform("starts", lambda s, k: F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), n) - s))
    convs = convs.select("conv_id", messages.alias("messages"))
    # Each message: its header, then a piece for each turn, which a loss covers but for its mark.
    pieces = F.flatten(F.transform("messages", lambda m: F.concat(
        F.array(F.struct(F.concat(F.lit(HEADER), _escaped(F.get(m, F.lit(0))["role"], _ROLE_ESCAPES), F.lit("\n")).alias("piece"), F.lit(False).alias("loss"))),
        F.transform(m, lambda t: F.struct(F.concat(_escaped(t["text"]), F.lit(END)).alias("piece"), (t["role"] == loss_role).alias("loss"))),
    )))
    convs = convs.select("conv_id", pieces.alias("pieces"))
    empty = F.array().cast("array<struct<start:long,length:long>>")
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.char_length(p["piece"])).alias("at"),
            F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), (F.char_length(p["piece"]) - len(END)).cast("long").alias("length"))))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return convs.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column | str) -> Column:
    """The turns of a formatted conversation as array<struct<role, text>>."""
    formatted = F.col(formatted) if isinstance(formatted, str) else formatted
    # What stands before the first header, and after a message's last mark, is empty.
    messages = F.slice(F.split(formatted, HEADER), 2, F.greatest(F.size(F.split(formatted, HEADER)) - 1, F.lit(0)))

    def turns(m: Column) -> Column:
        role = unescaped(F.substring_index(m, "\n", 1), _ROLE_ESCAPES)
        body = F.split(F.substring(m, F.char_length(F.substring_index(m, "\n", 1)) + 2, F.char_length(m)), END)
        return F.transform(F.slice(body, 1, F.size(body) - 1), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(messages, turns))


def read_loss(formatted: Column | str, spans: Column | str) -> Column:
    """The texts under the loss mask, unescaped, as an array."""
    formatted, spans = (F.col(x) if isinstance(x, str) else x for x in (formatted, spans))
    return F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
