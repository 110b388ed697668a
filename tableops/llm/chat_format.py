"""Chat formatting with Spark expressions only.

The rows of a conversation are collected as structs and sorted; adjacent turns of one role are
merged into one message by array functions; the messages are put together as text. The template:

    <|im_start|>role\\ntext<|im_end|>\\n              one message
    <|im_start|>role\\ntext<|im_part|>text<|im_end|>\\n    adjacent turns of one role

Inside roles and texts every control string, the template's own and some that other templates
use, gets a backslash after its first character, and one that has backslashes there gets one
more. No text can therefore form a control string, and taking one backslash away gives the text
back. A line feed in a role becomes backslash n, a backslash in a role two.

The loss mask covers the assistant texts: start and end (exclusive) of each in code points, and in
bytes of UTF-8.

A null text or role is empty. Turns are ordered by number, null first, then role and text, so
repeated rows stay, side by side. Rows of a null id form one conversation. A conversation is one
value of the result, so its rows come together; partial collection happens before the shuffle.
A very long conversation takes time about in proportion to its turns. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, PART, END = "<|im_start|>", "<|im_part|>", "<|im_end|>"
#: Control strings by their first character and what follows it.
_REST = (
    r"\|im_start\|>|\|im_part\|>|\|im_end\|>|\|endoftext\|>|/?s>|SYS>>|/SYS>>|<SYS>>|</SYS>>"
    r"|/?INST\]"
)
ESCAPE = rf"([<\[])(\\*)({_REST})"
UNESCAPE = rf"([<\[])(\\*)\\({_REST})"
_MESSAGE = r"<\|im_start\|>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, r"$1$2$3")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    """Pairs of backslashes are set aside while \\n is read; no role has that mark unescaped."""
    parts = F.split(unescaped(role), r"\\\\", -1)
    return F.array_join(
        F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\"
    )


def format_conversations(
    turns: DataFrame, loss_role: str = "assistant"
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans array of (start, end, byte_start, byte_end).

    `turns` has conv_id, turn, role, text; other columns are not looked at.
    """
    sorted_turns = (
        turns.select(
            "conv_id",
            F.struct(
                F.col("turn"),
                F.coalesce("role", F.lit("")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text"),
            ).alias("t"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )
    # a message starts where the role changes; it runs to the next start
    starts = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0)
        | (F.get("turns", i).getField("role") != F.get("turns", i - 1).getField("role")),
    )
    merged = F.transform(
        F.col("starts"),
        lambda s, k: F.struct(
            F.get("turns", s).getField("role").alias("role"),
            F.transform(
                F.slice(
                    "turns", s + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - s
                ),
                lambda t: escaped(t.getField("text")),
            ).alias("texts"),
        ),
    )
    shown = F.transform(
        "messages",
        lambda m: F.struct(
            F.concat(F.lit(START), escaped_role(m.getField("role")), F.lit("\n")).alias("head"),
            m.getField("texts").alias("texts"),
            (m.getField("role") == loss_role).alias("loss"),
        ),
    )
    # where each message begins, in code points and in bytes
    placed = F.zip_with(
        F.zip_with("shown", running(_lengths(F.length)), lambda m, at: F.struct(m.alias("m"), at.alias("at"))),
        running(_lengths(F.octet_length)),
        lambda x, at: F.struct(
            x.getField("m").alias("m"), x.getField("at").alias("at"), at.alias("byte_at")
        ),
    )
    spans = F.flatten(
        F.transform(F.filter(placed, lambda x: x.getField("m").getField("loss")), _spans)
    )
    text = F.array_join(
        F.transform(
            "shown",
            lambda m: F.concat(
                m.getField("head"), F.array_join(m.getField("texts"), PART), F.lit(END + "\n")
            ),
        ),
        "",
    )
    return (
        sorted_turns.withColumn("starts", starts)
        .select("conv_id", merged.alias("messages"))
        .select("conv_id", shown.alias("shown"))
        .select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))
    )


def _lengths(measure: Callable[[Column], Column]) -> Column:
    """The length of each message shown."""
    return F.transform(
        "shown",
        lambda m: measure(m.getField("head"))
        + measure(F.array_join(m.getField("texts"), PART))
        + len(END)
        + 1,
    )


def _spans(placed: Column) -> Column:
    """Where each text of a message lies."""
    head, texts = placed.getField("m").getField("head"), placed.getField("m").getField("texts")

    def begins(at: Column, measure: Callable[[Column], Column]) -> Column:
        before = running(F.transform(texts, lambda t: measure(t) + len(PART)))
        return F.transform(before, lambda n: at + measure(head) + n)

    spans = F.zip_with(
        texts,
        begins(placed.getField("at"), F.length),
        lambda t, at: F.struct(
            at.alias("start"), (at + F.length(t)).alias("end"), F.octet_length(t).alias("bytes")
        ),
    )
    return F.zip_with(
        spans,
        begins(placed.getField("byte_at"), F.octet_length),
        lambda s, at: F.struct(
            s.getField("start").alias("start"),
            s.getField("end").alias("end"),
            at.alias("byte_start"),
            (at + s.getField("bytes")).alias("byte_end"),
        ),
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value worked out once, however often and however deep in lambdas it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(numbers: Column) -> Column:
    """For each of an array of ints the sum of those before it.

    Appending copies an array, so sums are made in blocks of about the root of the size: first
    over the blocks, then within each from its start.
    """

    def sums(block: Column, start: Column) -> Column:
        return F.aggregate(
            block, F.array(start), lambda done, n: F.array_append(done, F.element_at(done, -1) + n)
        )

    def blocks(all_: Column) -> Column:
        rows = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(all_))).cast("int"))
        last = F.floor((F.size(all_) - 1) / rows).cast("int")
        return F.transform(
            F.sequence(F.lit(0), F.greatest(F.lit(0), last)),
            lambda i: F.slice(all_, i * rows + 1, rows),
        )

    def within(cut: Column) -> Column:
        totals = F.transform(cut, lambda b: F.aggregate(b, F.lit(0), lambda x, n: x + n))
        return let(
            sums(totals, F.lit(0)),
            lambda starts: F.flatten(
                F.transform(cut, lambda b, i: F.slice(sums(b, F.get(starts, i)), 1, F.size(b)))
            ),
        )

    return let(let(numbers, blocks), within)


def read_back(formatted: DataFrame) -> DataFrame:
    """Reads the text again: conv_id, turns array of (role, text), loss_texts, formatted_chars."""
    parts = F.split("formatted", _MESSAGE, -1)
    body = F.transform(
        F.slice(parts, 2, F.size(parts) - 1),
        lambda m: F.substring(m, F.lit(1), F.length(m) - F.lit(len(END) + 1))
    )
    turns = F.flatten(
        F.transform(
            body,
            lambda m: F.transform(
                F.split(_after_line(m), r"<\|im_part\|>", -1),
                lambda t: F.struct(
                    unescaped_role(F.substring_index(m, "\n", 1)).alias("role"),
                    unescaped(t).alias("text"),
                ),
            ),
        )
    )
    # a place in text is found by reading up to it, in bytes at once
    loss = let(
        F.col("formatted").cast("binary"),
        lambda text: F.transform(
            "loss_spans",
            lambda s: unescaped(
                F.substring(
                    text,
                    s.getField("byte_start") + 1,
                    s.getField("byte_end") - s.getField("byte_start"),
                ).cast("string")
            ),
        ),
    )
    return formatted.select(
        "conv_id",
        turns.alias("turns"),
        loss.alias("loss_texts"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _after_line(m: Column) -> Column:
    return F.substring(m, F.locate("\n", m) + 1, F.length(m))
