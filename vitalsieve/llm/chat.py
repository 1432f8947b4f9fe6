"""Chat formatting in Spark expressions: sorted turns, merged runs of one role, a reversible template and its loss mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The marks of the template.
OPEN, CLOSE, NEXT = "<|im_start|>", "<|im_end|>", "<|im_next|>"
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """``<``, any backslashes, ``|`` gets one backslash more, so no mark can stand inside a text."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_out(role: Column) -> Column:
    """Roles stand on the line of the mark: line feeds in them are written as %0A."""
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, messages, parts, formatted) per conversation of (conv_id, turn, role, text).

    Turns are collected as structs and sorted by turn, then role and text, NULL turns first; rows that repeat are turns of their own. A NULL role
    is an empty role, a NULL text an empty text, a NULL conv_id a conversation. Adjacent turns of one role become one message with their
    texts in an array. ``parts`` are the pieces of the output, each with a flag that says whether the loss counts it: texts of
    the assistant count, marks don't. ``formatted`` is their concatenation, one value per conversation by nature.

    Runs are found by comparing neighbours and cut out with slice(), so the work is linear in the length of a conversation; a fold
    with a growing array would copy it at every turn.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    indexes = F.sequence(F.lit(0), F.size("turns") - 1)
    begins = F.filter(indexes, lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.get(F.col("turns"), i - 1)["role"]))
    rows = rows.withColumn("begins", begins)
    size = lambda i: F.coalesce(F.get(F.col("begins"), i + 1), F.size("turns")) - F.col("begins")[i]
    message = F.transform("begins", lambda b, i: F.struct(
        F.col("turns")[b]["role"].alias("role"),
        F.transform(F.slice("turns", b + 1, size(i)), lambda t: t["text"]).alias("texts")))
    rows = rows.withColumn("messages", message)
    mark = lambda text: F.struct(text.alias("text"), F.lit(False).alias("loss"))
    parts = F.flatten(F.transform("messages", lambda m: F.concat(
        F.array(mark(F.concat(F.lit(OPEN), _role_out(m["role"]), F.lit("\n")))),
        F.flatten(F.transform(m["texts"], lambda t, i: F.array(
            mark(F.when(i > 0, F.lit(NEXT)).otherwise(F.lit(""))),
            F.struct(escaped(t).alias("text"), (m["role"] == LEARNED_ROLE).alias("loss"))))),
        F.array(mark(F.lit(CLOSE + "\n"))))))
    rows = rows.withColumn("parts", parts)
    return rows.select("conv_id", "messages", "parts", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("formatted"))


def read_back(text: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    messages = F.filter(F.split(text, F.lit(r"<\|im_start\|>")), lambda m: m != "")

    def turns(m: Column) -> Column:
        role = F.substring_index(m, "\n", 1)
        inside = F.substring(m, F.char_length(role) + 2, F.char_length(m) - F.char_length(role) - len(CLOSE) - 2)
        return F.transform(F.split(inside, F.lit(r"<\|im_next\|>")), lambda t: F.struct(_role_in(role).alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(messages, turns))


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), all read back from the formatted output."""
    rows = formatted(turns).select("conv_id", "formatted", "parts", read_back(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("parts", lambda p: p["loss"]), lambda p: unescaped(p["text"])), "")
    return rows.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"), F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
