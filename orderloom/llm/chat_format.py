"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted, adjacent turns of one role are merged,
and the template is concatenated. Control strings inside texts are escaped by one more backslash
after their first character, which is undone by taking one away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Opening and closing marks of the known roles. Any other role is written out.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
ROLE, TEXT, ROLE_END = "[ROLE]", "[TEXT]", "[/ROLE]"
#: Between the texts of merged turns.
SEPARATOR = "[SEP]"
LOSS_ROLE = "assistant"

#: What follows the first character, and any backslashes, of a control string.
TAILS = r"(<SYS>>|</SYS>>|/?s>|/?INST\]|/?ROLE\]|TEXT\]|SEP\])"
ESCAPE = rf"([<\[])(\\*){TAILS}"
UNESCAPE = rf"([<\[])\\(\\*){TAILS}"
TURN = (
    r"(?s)(?:<<SYS>>|\[INST\]|<s>|\[ROLE\])(?:.*?)(?:<</SYS>>|\[/INST\]|</s>|\[/ROLE\])"
)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def opening(role: Column) -> Column:
    out = F.concat(F.lit(ROLE), escape(role), F.lit(TEXT))
    for name, (mark, _) in MARKS.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def closing(role: Column) -> Column:
    out = F.lit(ROLE_END)
    for name, (_, mark) in MARKS.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, segments) of ``turns(conv_id, turn, role, text)``.

    ``segments`` are (text, loss) in order; their texts make up ``formatted``, and those with loss
    are the assistant's texts, one a turn. Turns are sorted by turn, then role and text, so ties
    and repeated rows have a place; null turns come first. A null text or role is empty, null
    conv_ids form one conversation, and an empty table gives no rows. A conversation is one row
    of the result, so it is put together in one task.
    """
    names = turns.columns
    rows = turns.toDF(*[f"in{i}" for i in range(len(names))]).select(
        *[F.col(f"in{names.index(n)}").alias(n) for n in ("conv_id", "turn", "role", "text")]
    )
    turn = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    at = F.col("turns")
    opens = F.filter(
        F.sequence(F.lit(0), F.size(at) - 1),
        lambda i: (i == 0) | (F.get(at, i)["role"] != F.get(at, i - 1)["role"]),
    )
    begun = sorted_turns.withColumn("opens", opens)
    merged = F.transform(
        "opens",
        lambda first, run: F.struct(
            F.get(at, first)["role"].alias("role"),
            F.transform(
                F.slice(
                    at, first + 1, F.coalesce(F.get("opens", run + 1), F.size(at)) - first
                ),
                lambda t: escape(t["text"]),
            ).alias("texts"),
        ),
    )
    runs = begun.select("conv_id", merged.alias("runs"))
    silent = F.lit(False)

    def pieces(run: Column) -> Column:
        loss = run["role"] == LOSS_ROLE
        texts = F.transform(
            run["texts"],
            lambda text, i: F.when(i == 0, F.array(segment(text, loss))).otherwise(
                F.array(segment(F.lit(SEPARATOR), silent), segment(text, loss))
            ),
        )
        return F.concat(
            F.array(segment(opening(run["role"]), silent)),
            F.flatten(texts),
            F.array(segment(closing(run["role"]), silent)),
        )

    whole = runs.select("conv_id", F.flatten(F.transform("runs", pieces)).alias("segments"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
    )


def turns_in(text: Column) -> Column:
    """array of (role, texts) read back from a formatted conversation."""

    def of(run: Column) -> Column:
        written = F.substring_index(F.substr(run, F.lit(len(ROLE) + 1)), TEXT, 1)
        role, start = unescape(written), F.length(written) + len(ROLE) + len(TEXT)
        end = F.lit(len(ROLE_END))
        for name, (mark, close) in MARKS.items():
            known = run.startswith(mark)
            role = F.when(known, F.lit(name)).otherwise(role)
            start = F.when(known, F.lit(len(mark))).otherwise(start)
            end = F.when(known, F.lit(len(close))).otherwise(end)
        body = F.substr(run, start + 1, F.length(run) - start - end)
        return F.struct(role.alias("role"), body.alias("body"))

    runs = F.transform(F.regexp_extract_all(text, F.lit(TURN), F.lit(0)), of)
    return F.transform(
        runs,
        lambda run: F.struct(
            run["role"].alias("role"),
            F.transform(F.split(run["body"], r"\[SEP\]", -1), unescape).alias("texts"),
        ),
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """One row per conversation of ``formatted``: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256 and formatted_chars, taken from the formatted text and the loss mask alone."""
    turns = F.flatten(
        F.transform(
            turns_in(F.col("formatted")),
            lambda run: F.transform(
                run["texts"], lambda text: F.struct(run["role"].alias("role"), text.alias("text"))
            ),
        )
    )
    masked = F.array_join(
        F.transform(
            F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])
        ),
        "",
    )
    read = conversations.select(
        "conv_id",
        turns.alias("turns"),
        masked.alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
