"""Conversations as one training text each, with a loss mask, by Spark expressions only.

Layout of a conversation: its turns in order, adjacent turns of one role under one header,

    <|im_start|>ROLE\\nTEXT<|im_sep|>TEXT<|im_end|>\\n<|im_start|>ROLE\\n ...

``<|im_sep|>`` stands where two adjacent turns of one role were merged, so every turn can be read back.  Inside texts and roles
a backslash is put between ``<`` (and any backslashes behind it) and ``|``: no control string can appear in a text, and taking the
backslash out restores the text.  Line breaks in roles are written ``\\n`` with their backslashes doubled.

The loss mask lists (start, length) in code points of the assistant texts, without headers, separators or end marks.

Defined cases: null texts and roles count as empty; turns with equal numbers are ordered by role, then text, a null turn number
comes first; a null conversation id is one conversation; an empty table gives an empty table; other columns do not matter.  A conversation is one output
value and is assembled by one task: its length is bounded by what a sequence of turns can hold, not by the number of conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.frames import col

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # doubled backslashes are parked on a character that a role line cannot hold: the line break
    parked = F.replace(unescape(role), F.lit("\\\\"), F.lit("\n"))
    # a parked pair is one backslash; what is left of "\n" is a line break
    return F.array_join(F.transform(F.split(parked, r"\\n"), lambda part: F.replace(part, F.lit("\n"), F.lit("\\"))), "\n")


def block_begins(turns: Column) -> Column:
    """Where the role changes in an array of sorted turn structs."""
    numbers = F.sequence(F.lit(0), F.size(turns) - 1)
    return F.filter(numbers, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, F.greatest(i - 1, F.lit(0)))["role"]))


def merged(turns: Column, begins: Column) -> Column:
    """Sorted turn structs -> array of (role, texts): adjacent turns of one role together.  ``begins`` is a column, not an
    expression, which would be evaluated anew for every block."""
    return F.transform(
        begins,
        lambda b, j: F.struct(
            F.get(turns, b)["role"].alias("role"),
            F.transform(
                F.slice(turns, b + 1, F.coalesce(F.get(begins, j + 1), F.size(turns)) - b), lambda t: t["text"]
            ).alias("texts"),
        ),
    )


def format_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", trained_role: str = "assistant"
) -> DataFrame:
    """``conv_id, formatted, loss_spans`` per conversation."""
    turn = F.struct(
        col(turn_col).alias("turn"),
        F.coalesce(col(role_col), F.lit("")).alias("role"),
        F.coalesce(col(text_col), F.lit("")).alias("text"),
    )
    collected = rows.groupBy(col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    begun = collected.withColumn("begins", block_begins(F.col("turns")))
    blocks = begun.select("conv_id", merged(F.col("turns"), F.col("begins")).alias("blocks"))
    # per block: header, body and end, and the lengths of its escaped texts
    written = blocks.select(
        "conv_id",
        F.transform(
            "blocks",
            lambda b: F.struct(
                (b["role"] == trained_role).alias("trained"),
                F.concat(F.lit(START), escape_role(b["role"]), F.lit("\n")).alias("header"),
                F.transform(b["texts"], escape).alias("texts"),
            ),
        ).alias("blocks"),
    )
    text = F.array_join(
        F.transform("blocks", lambda b: F.concat(b["header"], F.array_join(b["texts"], SEP), F.lit(f"{END}\n"))),
        "",
    )
    # one flat list of pieces (length of what stands before the text, length of the text, trained); starts are running sums
    pieces = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.transform(
                b["texts"],
                lambda t, i: F.struct(
                    F.when(i == 0, F.length(b["header"])).otherwise(F.lit(len(SEP))).alias("before"),
                    F.length(t).alias("length"),
                    F.when(i == F.size(b["texts"]) - 1, F.lit(len(END) + 1)).otherwise(F.lit(0)).alias("after"),
                    b["trained"].alias("trained"),
                ),
            ),
        )
    )
    whole = written.select("conv_id", text.alias("formatted"), pieces.alias("pieces"))
    return whole.select("conv_id", "formatted", spans_of(F.col("pieces")).alias("loss_spans"))


def spans_of(pieces: Column) -> Column:
    """Running starts, within chunks of about the root of the number of pieces: an array that grows turn by turn is copied at every
    step, which over all pieces at once would be quadratic."""
    width = F.ceil(F.sqrt(F.size(pieces))).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), F.size(pieces) - 1, width), lambda at: F.slice(pieces, at + 1, width))
    span = "array<struct<start:int,length:int>>"

    def all_of(p: Column) -> Column:
        return p["before"] + p["length"] + p["after"]

    def advance(s: Column, p: Column) -> Column:
        start = s["at"] + p["before"]
        own = F.array(F.struct(start.alias("start"), p["length"].alias("length")))
        return F.struct((s["at"] + all_of(p)).alias("at"), F.when(p["trained"], F.concat(s["spans"], own)).otherwise(s["spans"]).alias("spans"))

    def within(s: Column, chunk: Column) -> Column:
        first = F.struct(s["at"].alias("at"), F.array().cast(span).alias("spans"))
        done = F.aggregate(chunk, first, advance)
        return F.struct(F.aggregate(chunk, s["at"], lambda at, p: at + all_of(p)).alias("at"), F.concat(s["chunks"], F.array(done["spans"])).alias("chunks"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("chunks"))
    return F.aggregate(chunks, begin, within, lambda s: F.flatten(s["chunks"]))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text), one per original turn."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b.startswith(START))
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.substring(b, F.instr(b, F.lit("\n")) + 1, F.length(b)), r"<\|im_sep\|>"),
                lambda t: F.struct(
                    unescape_role(F.substring(b, F.lit(len(START) + 1), F.instr(b, F.lit("\n")) - len(START) - 1)).alias("role"),
                    unescape(t).alias("text"),
                ),
            ),
        )
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """What the mask covers, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")
