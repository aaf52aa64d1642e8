"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted. Adjacent turns of one role are merged into
one block; the texts of a block keep a mark between them, so the turns can be read back:

    <|im_start|>role
    text<|im_sep|>text<|im_end|>

Control strings inside a text or role are escaped: `<`, any backslashes and `|` get one backslash more, so no
`<|` is left and the step can be undone exactly. A line feed in a role becomes `<n`, and `<n` gets a backslash too.

The loss mask is a list of byte spans of the formatted text, one per text of the roles trained on. Bytes, since
a span is then cut out in the time of its own length, however long the conversation is. Offsets are summed
in blocks of `BLOCK` turns and over the blocks, so the work stays near proportional to the turns.

What bounds memory: one shuffle by conversation, whose result is one row and one text per conversation; that
text (up to the 2 GB of a Spark string) is what a task has to hold, a few times over. Conversations are
independent, so a large one delays its own task only; its turns cannot be spread over tasks without giving up the single text.

Defined results: null and empty texts are empty turns; a null role is an empty one; a null turn number comes
first; ties in the turn go by role, then text; rows that are repeated are turns of their own; rows with a null
id form one conversation. An empty table gives an empty result. Other columns of the input are not read, so names
cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostrata.llm.native import let

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LOSS_ROLES = ("assistant",)
BLOCK = 512

TURNS = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    """`text` without any `<|`; undone by `unescape`."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """`role` without any `<|` or line feed."""
    return F.replace(F.regexp_replace(role, r"<(\\*)([n|])", r"<\\$1$2"), F.lit("\n"), F.lit("<n"))


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(F.replace(role, F.lit("<n"), F.lit("\n")), r"<\\(\\*)([n|])", r"<$1$2")


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def _sums_before(numbers: Column, start: Column) -> Column:
    """`start` plus the sum of all numbers before each one."""

    def step(state: Column, number: Column) -> Column:
        return F.struct(
            F.concat(state["sums"], F.array(state["at"])).alias("sums"), (state["at"] + number).alias("at")
        )

    nothing = F.struct(F.array().cast("array<bigint>").alias("sums"), start.cast("long").alias("at"))
    return F.aggregate(numbers, nothing, step)["sums"]


def running_sums(numbers: Column) -> Column:
    """Sum of the numbers before each one, by blocks: appending to an array copies it, so arrays stay short."""

    def blocks(all_numbers: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(all_numbers), F.lit(1)), F.lit(BLOCK))
        return F.transform(starts, lambda i: F.slice(all_numbers, i, F.lit(BLOCK)))

    def offsets(parts: Column) -> Column:
        before = _sums_before(F.transform(parts, _total), F.lit(0))
        return F.flatten(F.transform(F.arrays_zip(parts.alias("part"), before.alias("at")), _part_sums))

    def _part_sums(pair: Column) -> Column:
        return _sums_before(pair["part"], pair["at"])

    return let(numbers, lambda n: let(blocks(n), offsets))


def collected(rows: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """One row per conversation: its id and `_turns`, sorted, with escaped role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    turns = F.sort_array(F.collect_list(turn))
    escaped = F.transform(
        turns, lambda t: F.struct(t["role"].alias("role"), escape_role(t["role"]).alias("head"), escape(t["text"]).alias("body"))
    )
    return rows.groupBy(conv_id).agg(escaped.alias("_turns"))


def _merged(turns: Column) -> Column:
    """Per turn: what stands before its text (it opens a block, or goes on with one) and the text."""

    def lead(turn: Column, i: Column) -> Column:
        opened = F.concat(F.lit(START), turn["head"], F.lit("\n"))
        before = F.get(turns, i - 1)["role"]
        lead = F.when(i == 0, opened).when(before == turn["role"], F.lit(SEP)).otherwise(F.concat(F.lit(END + "\n"), opened))
        return F.struct(lead.alias("lead"), turn["body"].alias("body"), turn["role"].alias("role"))

    return F.transform(turns, lead)


def format_conversations(
    rows: DataFrame, loss_roles: Sequence[str] = LOSS_ROLES, conv_id: str = "conv_id"
) -> DataFrame:
    """(conv_id, formatted, loss_mask): the text of each conversation and the byte spans
    `[start, end)` that are trained on. `rows` has `turn`, `role` and `text`."""
    pieces = collected(rows, conv_id).withColumn("_pieces", let(F.col("_turns"), _merged))
    joined = F.array_join(F.transform("_pieces", lambda p: F.concat(p["lead"], p["body"])), "")
    sizes = F.transform("_pieces", lambda p: (F.octet_length(p["lead"]) + F.octet_length(p["body"])).cast("long"))
    placed = F.transform(
        F.arrays_zip(F.col("_pieces").alias("p"), running_sums(sizes).alias("at")),
        lambda z: F.struct(
            (z["at"] + F.octet_length(z["p"]["lead"])).alias("start"),
            (z["at"] + F.octet_length(z["p"]["lead"]) + F.octet_length(z["p"]["body"])).alias("end"),
            z["p"]["role"].isin(*loss_roles).alias("loss"),
        ),
    )
    mask = F.transform(
        F.filter(placed, lambda s: s["loss"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
    )
    return pieces.select(conv_id, F.concat(joined, F.lit(END + "\n")).alias("formatted"), mask.alias("loss_mask"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, in order: array of (role, text)."""

    def block_turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        body = F.substring(block, F.length(head) + 2, F.length(block))
        texts = F.split(F.substring_index(body, END, 1), r"<\|im_sep\|>")
        role = unescape_role(head)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    blocks = F.split(formatted, r"<\|im_start\|>")
    return F.flatten(F.transform(F.slice(blocks, 2, F.greatest(F.size(blocks) - 1, F.lit(0))), block_turns)).cast(TURNS)


def read_loss(formatted: Column, loss_mask: Column) -> Column:
    """The texts under the mask, unescaped, in order."""
    return let(
        formatted.cast("binary"),
        lambda raw: F.transform(
            loss_mask,
            lambda s: unescape(
                F.substring(raw, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")).cast("string")
            ),
        ),
    )


def block_count(formatted: Column) -> Column:
    """Number of blocks after the merge."""
    return (F.size(F.split(formatted, r"<\|im_start\|>")) - 1).cast("long")


def digests(formatted: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """What the formatted text and its mask give back: counts and digests of turns and of the text trained on."""
    told = F.array_join(F.transform("_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = formatted.withColumns(
        {"_read": read_turns(F.col("formatted")), "_loss": F.array_join(read_loss(F.col("formatted"), F.col("loss_mask")), "")}
    )
    return back.select(
        conv_id,
        F.size("_read").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        block_count(F.col("formatted")).alias("n_blocks"),
    )
