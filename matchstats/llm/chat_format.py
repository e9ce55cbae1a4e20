"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted, and laid out message by
message: adjacent turns of one role share a message, a separator between them. The
result is one string and its loss mask, run lengths of characters in the string's order.

    <|im_start|>ROLE
    TEXT<|cont|>TEXT<|im_end|>

Inside roles and texts a backslash is doubled, then one is put behind the first
character of anything that looks like a control string of this or other common
templates, so that the layout can be read back exactly.

Null texts and roles count as empty. Turns with equal numbers are ordered by role, then
text; a null turn number comes first. Rows without a conversation id form one
conversation. Repeated rows are turns of their own. Further columns are ignored. An
empty table gives no rows. One conversation is one output row, so it must fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, JOINED, CLOSE = "<|im_start|>", "<|cont|>", "<|im_end|>\n"
# What follows the first character of a control string.
_CONTROL = r"(?=\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, rf"([<\[]){_CONTROL}", r"$1\\")


def unescape(text: Column) -> Column:
    single = F.regexp_replace(text, rf"([<\[])\\{_CONTROL}", "$1")
    return F.replace(single, F.lit("\\\\"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    # A lone backslash before n is a line break; doubled ones are set aside meanwhile.
    kept = F.replace(role, F.lit("\\\\"), F.lit("\n"))
    broken = F.regexp_replace(kept, r"\\n", "\u0000")
    lines = F.replace(broken, F.lit("\n"), F.lit("\\\\"))
    return F.replace(unescape(lines), F.lit("\u0000"), F.lit("\n"))


def format_chats(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned_role: str = "assistant",
) -> DataFrame:
    """(conv_id, formatted, loss_mask): one row for each conversation.

    ``loss_mask`` is an array of (chars, loss): lengths that add up to the string's, with
    the texts of the learned role under the loss and everything else outside it.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("line"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    lines = F.col("lines")

    def role_at(index: Column) -> Column:
        return F.get(lines, index)["role"]

    def laid_out(line: Column, index: Column) -> Column:
        opens = (index == 0) | (role_at(index - 1) != line["role"])
        closes = (index == F.size(lines) - 1) | (role_at(index + 1) != line["role"])
        head = F.concat(F.lit(OPEN), _escape_role(line["role"]), F.lit("\n"))
        return F.struct(
            F.when(opens, head).otherwise(F.lit(JOINED)).alias("before"),
            escape(line["text"]).alias("text"),
            F.when(closes, F.lit(CLOSE)).otherwise(F.lit("")).alias("after"),
            (line["role"] == learned_role).alias("loss"),
        )

    def run(chars: Column, loss: Column) -> Column:
        return F.struct(F.length(chars).alias("chars"), loss.alias("loss"))

    pieces = sorted_turns.select("conv_id", F.transform(lines, laid_out).alias("pieces"))
    return pieces.select(
        "conv_id",
        F.array_join(
            F.transform("pieces", lambda p: F.concat(p["before"], p["text"], p["after"])), ""
        ).alias("formatted"),
        F.flatten(
            F.transform(
                "pieces",
                lambda p: F.array(
                    run(p["before"], F.lit(False)),
                    run(p["text"], p["loss"]),
                    run(p["after"], F.lit(False)),
                ),
            )
        ).alias("loss_mask"),
    )


def read_chats(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts, formatted): what the string and its mask say.

    ``turns`` are (role, text) as they were before formatting; ``loss_texts`` the texts
    under the mask. A mask that doesn't fit the string raises an error.
    """
    messages = F.filter(
        F.split("formatted", r"<\|im_start\|>", -1), lambda _, index: index > 0
    )

    def turns_of(message: Column) -> Column:
        head = F.substring_index(message, "\n", 1)
        body = F.substring(message, F.length(head) + 2, F.length(message))
        body = F.substring(body, F.lit(1), F.length(body) - len(CLOSE))
        return F.transform(
            F.split(body, r"<\|cont\|>", -1),
            lambda text: F.struct(
                _unescape_role(head).alias("role"), text.alias("escaped")
            ),
        )

    runs = F.filter("loss_mask", lambda _, index: index % 3 == 1)
    paired = formatted.select(
        "conv_id",
        "formatted",
        "loss_mask",
        F.arrays_zip(
            F.flatten(F.transform(messages, turns_of)).alias("turn"), runs.alias("run")
        ).alias("pairs"),
    )
    chars = F.aggregate("loss_mask", F.lit(0), lambda total, r: total + r["chars"])
    fits = (chars == F.length("formatted")) & F.forall(
        "pairs", lambda p: F.length(p["turn"]["escaped"]) == p["run"]["chars"]
    )
    return paired.select(
        "conv_id",
        F.transform(
            "pairs",
            lambda p: F.struct(
                p["turn"]["role"].alias("role"), unescape(p["turn"]["escaped"]).alias("text")
            ),
        ).alias("turns"),
        F.when(
            fits,
            F.transform(
                F.filter("pairs", lambda p: p["run"]["loss"]),
                lambda p: unescape(p["turn"]["escaped"]),
            ),
        )
        .otherwise(F.raise_error(F.lit("the loss mask does not fit the formatted text")))
        .alias("loss_texts"),
        "formatted",
    )


def chat_digest(formatted: DataFrame) -> DataFrame:
    """Counts and checksums of what is read back from formatted conversations."""
    loss = F.array_join("loss_texts", "")
    spoken = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read_chats(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
