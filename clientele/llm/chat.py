r"""Chat formatting by prefix-target expansion.

Every assistant turn of a conversation becomes an example of its own: all turns before it as
context, then the reply.  Only the reply's text is trainable; its span is given in code points.
Turns behind the last reply would be lost to a reader, so a conversation that does not end with
a reply gives one more example with all of its turns and an empty span.

A turn is written ``<|im_start|>role<|im_sep|>text<|im_end|>``.  Control strings inside roles
and texts, these three and some of other templates, get a backslash behind their first
character; such strings that have backslashes there already get one more, so that taking one
away restores every text.  No control string is left inside, so the marks are unambiguous.

All is DataFrame expressions.  A conversation is one row while it is expanded; the
examples of a conversation of n turns have together, as the method has it, the length of n / 2
conversations.

Defined results: a NULL text or role is empty.  Turns are in the order of their number, role and
text, NULLs first; repeated rows are turns of their own.  A row without a conversation id
belongs to no other row: it is a conversation by itself.  Only the role ``assistant`` is a reply.
An empty table gives no rows.  Columns beside the four are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import keep

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
REPLY = "assistant"
# Control strings as the first character and what follows it.
_CONTROLS = (r"(<)", r"(\|(?:im_start|im_sep|im_end|endoftext)\|>|/?s>)"), (r"(\[)", r"(/?INST\])")


def escaped(text: Column) -> Column:
    for first, rest in _CONTROLS:
        text = F.regexp_replace(text, first + r"(\\*)" + rest, r"$1\\$2$3")
    return text


def unescaped(text: Column) -> Column:
    for first, rest in _CONTROLS:
        text = F.regexp_replace(text, first + r"\\(\\*)" + rest, "$1$2$3")
    return text


def _formatted(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit(SEP), turn["text"], F.lit(END))


def examples(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Examples of all conversations: conv_id, example (from 0), formatted, loss_from, loss_to.

    Characters ``loss_from`` to ``loss_to`` (the end not included) of ``formatted`` are trainable.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            escaped(F.coalesce(role, F.lit(""))).alias("role"),
            escaped(F.coalesce(text, F.lit(""))).alias("text"),
            F.coalesce(F.col(role) == REPLY, F.lit(False)).alias("reply"),
            F.struct(F.col(role).alias("r"), F.col(text).alias("t")).alias("plain"),
        ).alias("turn"),
    )
    # Sorted by what the rows hold, not by their escaped forms.
    in_order = F.array_sort(
        F.collect_list(F.struct(F.col("turn.turn").alias("n"), F.col("turn.plain").alias("p"), F.col("turn").alias("turn")))
    )
    known = rows.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(in_order.alias("sorted"))
    whole = known.select("conv_id", F.transform("sorted", lambda x: x["turn"]).alias("turns")).unionByName(
        rows.filter("conv_id IS NULL").select("conv_id", F.array("turn").alias("turns"))
    )
    numbered = F.transform("turns", lambda x, i: F.struct(i.alias("at"), x["reply"].alias("reply")))
    last = F.size("turns") - 1
    ends = F.filter(numbered, lambda x: x["reply"] | (x["at"] == last))
    one = whole.select("conv_id", "turns", F.posexplode(ends).alias("example", "end")).select(
        "conv_id",
        "example",
        F.array_join(F.transform(F.slice("turns", 1, F.col("end.at") + 1), _formatted), "").alias("formatted"),
        F.when(F.col("end.reply"), F.length(F.get("turns", F.col("end.at"))["text"])).otherwise(0).alias("_reply"),
    )
    loss_to = F.length("formatted") - len(END)
    return one.select("conv_id", "example", "formatted", (loss_to - F.col("_reply")).alias("loss_from"), loss_to.alias("loss_to"))


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    marked = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda x: x != "")
    return F.transform(
        marked,
        lambda x: F.struct(
            unescaped(F.substring_index(x, SEP, 1)).alias("role"),
            unescaped(F.substring_index(F.substring_index(x, SEP, -1), END, 1)).alias("text"),
        ),
    )


def trained_text(formatted: Column, loss_from: Column, loss_to: Column) -> Column:
    """The text under the loss mask."""
    return unescaped(F.substring(formatted, loss_from + 1, loss_to - loss_from))


def digests(written: DataFrame) -> DataFrame:
    """What the examples of each conversation hold, read off their formatted texts."""
    read = written.select(
        "conv_id",
        # Rows without an id are each a conversation.
        F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("_row"),
        "example",
        "formatted",
        trained_text(F.col("formatted"), F.col("loss_from"), F.col("loss_to")).alias("trained"),
    )
    replies = F.transform(F.array_sort(F.collect_list(F.struct("example", "trained"))), lambda x: x["trained"])
    whole = read.groupBy("conv_id", "_row").agg(
        turns_of(F.max_by("formatted", "example")).alias("turns"),
        F.array_join(replies, "").alias("trained"),
        F.sum(F.length("formatted")).cast("long").alias("formatted_chars"),
    )
    said = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def format_and_read(turns: DataFrame) -> DataFrame:
    """Write the examples to the shared folder and return their digests from what is read back."""
    return digests(keep(examples(turns), "chat-examples"))
