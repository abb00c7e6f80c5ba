"""Chat formatting with loss flags. DataFrame functions only.

A conversation's turns, in the order of turn, role and text, go through a finite-state machine over
roles: an optional system turn, then user and assistant by turns, user first. ``state`` is where it
ends: start, system, user, assistant, or invalid. Every conversation is formatted, valid or not.

The template is a table: per role the strings before and behind a text, and whether the text counts
for the loss. Roles not in the table get ``<|role|>`` and ``<|end|>``. Within texts and role names
control strings are escaped: a backslash becomes ``\\0`` and the k-th control string ``\\k``, so a text
holds no control string and the escape can be undone. ``segments`` lists every piece of the output
with its loss flag; ``formatted`` is their concatenation.

``read`` parses ``formatted`` again. A null text or role is empty; null turns come first; rows may
repeat; a null conv_id is one conversation. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

TEMPLATE = {"system": ("<<SYS>>", "<</SYS>>", False), "user": ("[INST]", "[/INST]", False), "assistant": ("<s>", "</s>", True)}
OTHER = ("<|", "|>", "<|end|>")
NEXT = {("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user", ("user", "assistant"): "assistant", ("assistant", "user"): "user"}
CONTROLS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<|", "|>"]


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\0"))
    for k, control in enumerate(CONTROLS, 1):
        out = F.replace(out, F.lit(control), F.lit(f"\\{k}"))
    return out


def unescape(text: Column) -> Column:
    for k, control in enumerate(CONTROLS, 1):
        text = F.replace(text, F.lit(f"\\{k}"), F.lit(control))
    return F.replace(text, F.lit("\\0"), F.lit("\\"))


def _by_role(role: Column, of, other):
    out = F.when(F.lit(False), other)
    for name, parts in TEMPLATE.items():
        out = out.when(role == name, of(parts))
    return out.otherwise(other)


def _segments(turn: Column) -> Column:
    role, text = turn["role"], turn["text"]
    before = _by_role(role, lambda p: F.lit(p[0]), F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1])))
    behind = _by_role(role, lambda p: F.lit(p[1]), F.lit(OTHER[2]))
    loss = _by_role(role, lambda p: F.lit(p[2]), F.lit(False))
    piece = lambda c, flag: F.struct(c.alias("text"), flag.alias("loss"))
    return F.array(piece(before, F.lit(False)), piece(escape(text), loss), piece(behind, F.lit(False)))


def _step(state: Column, turn: Column) -> Column:
    out = F.when(F.lit(False), "")
    for (at, role), to in NEXT.items():
        out = out.when((state == at) & (turn["role"] == role), to)
    return out.otherwise("invalid")


def format_chat(conversations: DataFrame) -> DataFrame:
    """(conv_id, state, segments, formatted) per conversation of (conv_id, turn, role, text)."""
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    df = conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    df = df.select("conv_id", F.aggregate("turns", F.lit("start"), _step).alias("state"), F.flatten(F.transform("turns", _segments)).alias("segments"))
    return df.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    q = re.escape
    known = [f"{q(a)}.*?{q(b)}" for a, b, _ in TEMPLATE.values()]
    other = f"{q(OTHER[0])}.*?{q(OTHER[1])}.*?{q(OTHER[2])}"
    found = F.regexp_extract_all(formatted, F.lit("(?s)" + "|".join([*known, other])), F.lit(0))

    def turn(whole: Column) -> Column:
        role = text = None
        for name, (a, b, _) in TEMPLATE.items():
            fits, inner = F.startswith(whole, F.lit(a)), F.substring(whole, len(a) + 1, F.char_length(whole) - len(a) - len(b))
            role = F.when(fits, name) if role is None else role.when(fits, name)
            text = F.when(fits, inner) if text is None else text.when(fits, inner)
        start, end = F.lit(len(OTHER[0]) + 1), F.locate(OTHER[1], whole)
        body = F.substring(whole, end + len(OTHER[1]), F.char_length(whole) - end - len(OTHER[1]) - len(OTHER[2]) + 1)
        role, text = role.otherwise(F.substring(whole, start, end - start)), text.otherwise(body)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(found, turn)


def digests(formatted: DataFrame) -> DataFrame:
    """What the output says, read back from it."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    df = formatted.withColumn("turns", read(F.col("formatted"))).withColumn("loss", loss)
    return df.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.char_length("loss").cast("bigint").alias("loss_chars"),
                     F.sha2("loss", 256).alias("loss_sha256"), F.char_length("formatted").cast("bigint").alias("formatted_chars"), "state")
