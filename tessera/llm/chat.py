"""Prefix-target expansion of conversations into chat training examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The template's marks, and strings that other chat templates
# treat as control. None of them survives unescaped inside a text or role.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>", "<unk>", "<pad>"]
ESCAPE = "\\"


def escaped(text: Column) -> Column:
    """Double each backslash, then put one behind the first character of each
    control string. `unescaped` gives the text back exactly."""
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + ESCAPE + c[1:]))
    return out


def unescaped(text: Column) -> Column:
    """A backslash stands before each character that it protects."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chat(conversations: DataFrame, trainable: str = "assistant") -> DataFrame:
    """One example for each trainable turn: all turns before it as context, the
    turn itself as the only text under the loss mask.

    In: conv_id, turn, role, text. Out: conv_id, example (from 0), n_turns
    (turns in it), text, loss_start and loss_length (code points of `text`; the
    mask covers the escaped reply without marks).

    Turns go by `turn` (nulls first), then role and text, so repeated turns keep
    a fixed order. Null role or text counts as empty; a null conv_id is a
    conversation of its own. Turns behind the last trainable one, or of a
    conversation without any, would be lost, so such a conversation ends in one
    more example with all its turns and an empty mask (loss_length 0,
    loss_start null). An empty table gives no examples.

    A conversation is gathered into one row, as its examples must be; they are
    exploded from positions in that row, with no join."""
    rows = conversations.select(
        "conv_id",
        F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"),
    )
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    bodies = turns.select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(F.lit(TURN), escaped(t.role), F.lit(BODY))).alias("heads"),
        F.transform("turns", lambda t: escaped(t.text)).alias("texts"),
        F.transform("turns", lambda t: t.role == trainable).alias("train"),
    )
    n = F.size("texts")
    at = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at("train", i))
    targets = F.when(F.element_at("train", -1), at).otherwise(F.concat(at, F.array(n)))
    one = bodies.select("*", F.posexplode(targets).alias("example", "k"))
    whole = F.zip_with(F.slice("heads", F.lit(1), F.col("k")), F.slice("texts", F.lit(1), F.col("k")), lambda h, t: F.concat(h, t, F.lit(END)))
    text, loss = F.array_join(whole, ""), F.element_at("texts", F.col("k"))
    trained = F.element_at("train", F.col("k"))
    size = F.when(trained, F.char_length(loss)).otherwise(0).cast("long")
    return one.select("conv_id", "example", F.col("k").cast("long").alias("n_turns"), text.alias("text"), size.alias("loss_length"), trained.alias("t")).select(
        "conv_id",
        "example",
        "n_turns",
        "text",
        F.when(F.col("t"), F.char_length("text") - F.col("loss_length") - len(END)).cast("long").alias("loss_start"),
        "loss_length",
    )


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of what the formatted text holds, one row per conversation.

    The longest example has all turns; each mask has one reply. conv_id,
    n_turns, turns_sha256 (role, line feed, text, line feed of each turn),
    loss_chars and loss_sha256 (unescaped replies in order), formatted_chars
    (code points of all examples)."""
    reply = unescaped(F.substr("text", F.col("loss_start").cast("int") + 1, F.col("loss_length").cast("int")))
    parts = examples.groupBy("conv_id").agg(
        F.max_by("text", "n_turns").alias("text"),
        F.array_sort(F.collect_list(F.struct("example", F.coalesce(reply, F.lit("")).alias("r")))).alias("replies"),
        F.sum(F.char_length("text")).alias("formatted_chars"),
    )
    turns = F.filter(F.split("text", r"<\|end\|>"), lambda p: p != "")
    plain = F.transform(turns, lambda p: F.concat(unescaped(F.regexp_replace(F.substr(p, F.lit(len(TURN) + 1)), r"<\|body\|>", "\n")), F.lit("\n")))
    lost = F.array_join(F.transform("replies", lambda r: r.r), "")
    return parts.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(plain, ""), 256).alias("turns_sha256"),
        F.char_length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
