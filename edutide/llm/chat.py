"""Chat formatting with a grammar round trip (operator 4), in DataFrame functions alone.

    conversation := turn*
    turn         := <|im_start|> role NEWLINE body <|im_end|> NEWLINE          a literal turn
                  | <|im_start|> \\ hex(role) NEWLINE body <|im_end|> NEWLINE   an escaped turn

Each turn is first rendered literally and parsed again. Where that does not give back the same role and text, and only
there, the turn is escaped: the role in hexadecimal; in the body a backslash as two and `<|` as `<\\|`, so that no control
string is left in it. Escaped turns always come back, since the role can't end early and the body holds no control string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, MARK = "<|im_start|>", "<|im_end|>", "\\"
TURN_END = r"<\|im_end\|>\n"


def _render(role: Column, body: Column, mark: str = "") -> Column:
    return F.concat(F.lit(START + mark), role, F.lit("\n"), body, F.lit(END + "\n"))


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(MARK), F.lit(MARK * 2)), F.lit("<|"), F.lit("<" + MARK + "|"))


def unescaped(body: Column) -> Column:
    return F.regexp_replace(body, r"(?s)\\(.)", "$1")


def _parse_turn(segment: Column) -> Column:
    """What stands before one turn's <|im_end|>: role and text, or nulls if it isn't a turn."""
    inside = F.substr(segment, F.lit(len(START) + 1))
    head = F.substring_index(inside, "\n", 1)
    body = F.substr(inside, F.length(head) + 2)
    ok = F.startswith(segment, F.lit(START)) & F.contains(inside, F.lit("\n")) & ~F.contains(inside, F.lit(START)) & ~F.contains(inside, F.lit(END))
    marked = F.startswith(head, F.lit(MARK))
    role = F.when(marked, F.decode(F.unhex(F.substr(head, F.lit(2))), "UTF-8")).otherwise(head)
    return F.struct(F.when(ok, role).alias("role"), F.when(ok, F.when(marked, unescaped(body)).otherwise(body)).alias("text"))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of role and text."""
    segments = F.split(formatted, TURN_END, -1)
    return F.transform(F.slice(segments, F.lit(1), F.size(segments) - 1), _parse_turn)


def _comes_back(role: Column, text: Column) -> Column:
    turns = parsed(_render(role, text))
    first = F.get(turns, F.lit(0))
    return (F.size(turns) == 1) & F.coalesce((first["role"] == role) & (first["text"] == text), F.lit(False))


def format_chats(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: conv_id, formatted, n_escaped, same (the parsed turns are the source's).

    Turns are in order of turn, then role, then text (null first). Null roles and texts are empty; rows with a null conversation
    are one conversation; repeated rows are turns of their own; an empty table gives no rows. Other columns are not read.

    A conversation is one string and so is made in one task; rendering and escaping are done row by row before that.
    """
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("plain", _comes_back(F.col("role"), F.col("text")))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "plain"))).alias("turns"))

    def render(t: Column) -> Column:
        return F.when(t["plain"], _render(t["role"], t["text"])).otherwise(_render(F.hex(F.encode(t["role"], "UTF-8")), escaped(t["text"]), MARK))

    out = turns.select("conv_id", F.array_join(F.transform("turns", render), "").alias("formatted"), F.size(F.filter("turns", lambda t: ~t["plain"])).alias("n_escaped"), F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))
    return out.select("conv_id", "formatted", "n_escaped", (parsed(F.col("formatted")) == F.col("source")).alias("same"))


def loss_texts(turns: Column) -> Column:
    """The texts under the loss mask: those of the assistant."""
    return F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), lambda t: t["text"])


def digests(formatted: DataFrame) -> DataFrame:
    """Read back from `formatted`: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    turns = formatted.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), parsed(F.col("formatted")).alias("turns"))
    loss = F.array_join(loss_texts(F.col("turns")), "")
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
