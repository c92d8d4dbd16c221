"""Chat formatting with a grammar round trip, in DataFrame functions only.

A turn is rendered as ``<|im_start|>role\\ntext<|im_end|>\\n``. A conversation is rendered as it is,
parsed again by the fixed grammar below, and compared with its source turns. Where the two
differ, roles and texts are escaped, and rendered and parsed once more; the job fails should they
differ still. Escaping puts one backslash more between ``<`` and ``|`` (and writes a line break in a
role as ``<\\n|``-like text), so escaped content holds no control string and the original comes back.

One conversation is one value: its turns meet in one row, as the formatted text must.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed: the template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"


def escaped(content: Column) -> Column:
    return F.regexp_replace(content, r"<(\\*)\|", r"<\\$1|")


def unescaped(content: Column) -> Column:
    return F.regexp_replace(content, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    r"""A line break would end the header, so it is written as the mark ``<\n|``; a mark that the role has itself gets one more ``\``."""
    return F.replace(F.regexp_replace(escaped(role), r"<(\\+)n\|", r"<\\$1n|"), F.lit("\n"), F.lit("<\\n|"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.regexp_replace(F.replace(role, F.lit("<\\n|"), F.lit("\n")), r"<\\(\\+)n\|", r"<$1n|"))


def rendered(turns: Column, role=lambda value: value, text=lambda value: value) -> Column:
    return F.array_join(
        F.transform(
            turns, lambda turn: F.concat(F.lit(START), role(turn["role"]), F.lit("\n"), text(turn["text"]), F.lit(END + "\n"))
        ),
        "",
    )


def parsed(formatted: Column) -> Column:
    """Turns of a formatted text: at each start mark a header line, then text up to the end mark.

    ``start`` is the place of the text (from 0) and ``length`` its length, in code points, as formatted.
    """
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda _, at: at > 0)
    before = F.length(F.element_at(F.split(formatted, r"<\|im_start\|>", -1), 1))

    def turn(piece: Column) -> Column:
        header = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(header) + 2, F.length(piece))
        return F.struct(
            header.alias("header"), F.substring_index(body, END, 1).alias("body"), F.length(piece).alias("size")
        )

    cut = F.transform(pieces, turn)
    sizes = F.aggregate(
        cut,
        F.struct(before.cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("starts")),
        lambda state, piece: F.struct(
            (state["at"] + len(START) + piece["size"]).alias("at"),
            F.concat(state["starts"], F.array(state["at"] + len(START) + F.length(piece["header"]) + 1)).alias("starts"),
        ),
    )["starts"]
    return F.transform(
        F.arrays_zip(cut.alias("cut"), sizes.alias("start")),
        lambda each: F.struct(
            unescaped_role(each["cut"]["header"]).alias("role"),
            unescaped(each["cut"]["body"]).alias("text"),
            each["start"].alias("start"),
            F.length(each["cut"]["body"]).cast("bigint").alias("length"),
        ),
    )


def _said(turns: Column) -> Column:
    return F.transform(turns, lambda turn: F.struct(turn["role"].alias("role"), turn["text"].alias("text")))


def format_conversations(conversations: DataFrame, learned: str = LEARNED) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns as parsed back, loss spans, whether it was escaped.

    Turns are ordered by turn, then role, then text, nulls first; repeated rows are turns of their own. Null
    role and text count as empty; null ids form one conversation. ``loss`` holds (start, length) in code
    points of ``formatted``, one span per turn of the role ``learned``. Other columns are ignored.
    """
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("source"))
    plain = grouped.select("conv_id", _said(F.col("source")).alias("source"), rendered(F.col("source")).alias("plain"))
    same = _said(parsed(F.col("plain"))) == F.col("source")
    safe = plain.withColumn("escaped", ~same)
    formatted = safe.withColumn(
        "formatted",
        F.when(F.col("escaped"), rendered(F.col("source"), escaped_role, escaped)).otherwise(F.col("plain")),
    ).withColumn("turns", parsed(F.col("formatted")))
    checked = formatted.withColumn(
        "turns",
        F.when(_said(F.col("turns")) == F.col("source"), F.col("turns")).otherwise(
            F.raise_error(F.lit("a formatted conversation does not parse back to its turns"))
        ),
    )
    spans = F.transform(
        F.filter("turns", lambda each: each["role"] == learned),
        lambda each: F.struct(each["start"].alias("start"), each["length"].alias("length")),
    )
    return checked.select("conv_id", "formatted", _said(F.col("turns")).alias("turns"), spans.alias("loss"), "escaped")


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what the formatted texts and loss spans hold, read back from them alone."""
    turns = parsed(F.col("formatted"))
    read = formatted.select("conv_id", "formatted", "loss", _said(turns).alias("turns"))
    whole = F.array_join(F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n"))), "")
    learned = F.array_join(
        F.transform(
            "loss",
            lambda span: unescaped(
                F.substring(F.col("formatted"), (span["start"] + 1).cast("int"), span["length"].cast("int"))
            ),
        ),
        "",
    )
    return read.withColumns({"whole": whole, "learned": learned}).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2("whole", 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
