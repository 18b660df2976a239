"""Chat formatting by prefix-target expansion.

A turn is written as ``<turn:role>``, a line break, the text and ``</turn>`` with a line break. Inside roles and
texts the signs the template is made of are escaped, so no text can open or close a turn, and unescaping gives
back exactly what went in. Every assistant turn becomes an example of its own: all turns before it and its own
head are the prompt, its text alone is under the loss. Examples are kept as places in the formatted conversation,
so a long conversation is stored once, not once per example; ``expand`` cuts them out.

Places are running sums of a window, which spills for a conversation of any length; its formatted text is one
value, as any output of it must be. Turns go by number, null first, ties by role and text; repeated rows are
turns of their own. Null roles and texts are empty, rows with a null id are one conversation. A conversation
without assistant turns has no example. An empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: What stands for a sign inside a role or text; the backslash is escaped first and undone last.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
CLOSE = "</turn>\n"


def escape(text: Column) -> Column:
    for sign, written in ESCAPES:
        text = F.replace(text, F.lit(sign), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for sign, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(sign))
    return text


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, formatted, examples): examples are structs (example, loss_start from 1, loss_chars), one per assistant turn."""
    of = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = turns.select(F.col(f"`{conv_id}`").alias("id"), F.col(f"`{turn}`").alias("at"), of(role).alias("role"), of(text).alias("text"))
    head, body = F.concat(F.lit("<turn:"), escape(F.col("role")), F.lit(">\n")), escape(F.col("text"))
    parts = rows.select("*", head.alias("head"), body.alias("body"))
    size = F.length("head") + F.length("body") + F.lit(len(CLOSE))
    order = Window.partitionBy("id").orderBy("at", "role", "text")
    placed = parts.select(
        "id", "role", F.row_number().over(order).alias("no"), F.concat("head", "body", F.lit(CLOSE)).alias("piece"), F.length("body").cast("long").alias("loss_chars"),
        (F.sum(size.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size + F.length("head") + 1).alias("loss_start"),
    )
    example = F.when(F.col("role") == "assistant", F.struct(F.col("no").alias("example"), "loss_start", "loss_chars"))
    pieces = F.array_sort(F.collect_list(F.struct("no", "piece")))
    found = placed.groupBy("id").agg(F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("formatted"), F.array_sort(F.collect_list(example)).alias("examples"))
    return found.withColumnRenamed("id", conv_id)


def expand(formatted: DataFrame, prompts: bool = True) -> DataFrame:
    """One row per assistant turn: prompt and reply as written, other columns kept; a conversation without one keeps a row with nulls.

    Replies are taken from the turns the text splits into, so their cost is that of the text. Prompts are as long
    together as the square of the number of turns; without ``prompts`` there is in their place ``prompt_chars``, how
    much of ``formatted`` is the prompt.
    """
    kept = [F.col(f"`{c}`") for c in formatted.columns if c not in ("formatted", "examples")]
    turns = formatted.withColumn("_turns", F.split("formatted", CLOSE))
    reply = lambda e: F.regexp_replace(F.element_at("_turns", e["example"]), r"^<turn:[^>]*>\n", "")
    before = lambda e: (e["loss_start"] - 1).alias("prompt_chars")
    each = turns.select(*kept, *(["formatted"] if prompts else []), F.inline_outer(F.transform("examples", lambda e: F.struct(e["example"].alias("example"), before(e), reply(e).alias("reply")))))
    if not prompts:
        return each
    return each.select(*kept, "example", F.substr("formatted", F.lit(1), F.col("prompt_chars").cast("int")).alias("prompt"), "reply")


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as structs (role, text), unescaped."""
    pieces = F.filter(F.split(formatted, CLOSE), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(F.substring(p, 7, 1 << 30), ">\n", 1)).alias("role"), unescape(F.substr(p, F.locate(">\n", p) + 2)).alias("text"),
    ))
