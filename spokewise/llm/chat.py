"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all preceding turns are its context, and its own text is
the only trainable part. A turn is written as ``[INST]role[/INST]text</s>``. Control strings
(``[INST]``, ``[/INST]``, ``<s>``, ``</s>``) inside a role or text get a backslash after their first
character and backslashes are doubled, so no control string is left in them and reading back is
exact. A conversation that does not end with an assistant turn has one more example, without a
trainable part, so that no turn is lost.

An example is written as its turns, one row each, so that no task has to hold a long one; ``render`` joins
them. A turn is repeated for every example from its own on, where it lies: the expanded text is not
shuffled, and as the copies of a turn follow each other, files hold little more than the turns.

Turns are ordered by turn, then role, then text, nulls first; repeated rows stay. Null roles and
texts are empty. Rows with a null conv_id form one conversation. Turns are dealt out by range, so a long
conversation takes several tasks, which continue each other's counts. ``read_back`` alone streams
a conversation through one task, since the digest of its turns has no parts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spokewise.llm.common import small_batches
from spokewise.session import stored

OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, r"(\[(?=/?INST\])|<(?=/?s>))", r"$1\\")


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``formatted`` of every row; nothing is shuffled."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    piece = F.concat(F.lit(OPEN), escape(role), F.lit(CLOSE), escape(text), F.lit(END))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), piece.alias("formatted"))


def in_order(turns: DataFrame) -> DataFrame:
    """Turns in order, dealt out by range; equal beginnings of role and text stay in one task."""
    near = [F.substring(c, 1, 32) for c in ("role", "text")]
    return turns.repartitionByRange("conv_id", "turn", *near).sortWithinPartitions("conv_id", "turn", "role", "text")


def _counted(turns: DataFrame) -> DataFrame:
    """(part, conv_id, formatted, loss, at, chars, answers): turns and what its task saw of the conversation before.

    loss is the place of the trained text in an assistant's turn, null for others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, at, chars, answers = object(), 0, 0, 0
        for batch in batches:
            out: list[list] = [[] for _ in range(4)]
            for c, role, formatted in zip(*(batch.column(i).to_pylist() for i in range(1, 4))):
                if c != conv:
                    conv, at, chars, answers = c, 0, 0, 0
                trained = formatted.index(CLOSE) + len(CLOSE) if role == ASSISTANT else None
                for column, value in zip(out, (trained, at, chars, answers)):
                    column.append(value)
                at, chars, answers = at + 1, chars + len(formatted), answers + (trained is not None)
            columns = [batch.column(0), batch.column(1), batch.column(3), *(pa.array(v, pa.int64()) for v in out)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["part", "conv_id", "formatted", "loss", "at", "chars", "answers"]
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = f"part int, conv_id {kind}, formatted string, loss long, at long, chars long, answers long"
    return (
        in_order(turns)
        .select(F.spark_partition_id().alias("part"), "conv_id", "role", "formatted")
        .mapInArrow(run, schema)
    )


def pieces(conversations: DataFrame) -> DataFrame:
    """(conv_id, piece, formatted, start, loss_start, loss_end, example, n_examples): each turn once.

    start is the code point where the turn begins in every example that shows it; example is the first
    of these, the last one is n_examples - 1. For an assistant turn, the target of its first example,
    [loss_start, loss_end) is trained; both are null for other turns.
    """
    counted = stored(_counted(format_turns(conversations)), "chat-turns")
    # one row for each conversation and task, without texts
    seen = counted.groupBy("part", "conv_id").agg(
        F.count("*").alias("turns"),
        F.sum(F.char_length("formatted")).alias("length"),
        F.count("loss").alias("targets"),
        F.max(F.struct("at", F.col("loss").isNull().alias("open"))).alias("end"),
    )
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)

    def earlier(column: str) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0)).alias(f"earlier_{column}")

    open_ = F.max(F.struct("part", "end.open")).over(whole)["open"].cast("long")
    bases = seen.select(
        F.col("part").alias("p"),
        F.col("conv_id").alias("c"),
        *(earlier(c) for c in ("turns", "length", "targets")),
        (F.sum("targets").over(whole) + open_).alias("n_examples"),
    )
    told = counted.join(bases, (F.col("part") == F.col("p")) & F.col("conv_id").eqNullSafe(F.col("c")))
    start = F.col("earlier_length") + F.col("chars")
    return told.select(
        "conv_id",
        (F.col("earlier_turns") + F.col("at")).alias("piece"),
        "formatted",
        start.alias("start"),
        (start + F.col("loss")).alias("loss_start"),
        F.when(F.col("loss").isNotNull(), start + F.char_length("formatted") - len(END)).alias("loss_end"),
        (F.col("earlier_targets") + F.col("answers")).alias("example"),
        "n_examples",
    )


def examples(turns: DataFrame) -> DataFrame:
    """(conv_id, example, n_examples, piece, formatted, start, loss_start, loss_end) of ``pieces``.

    Every example with all its turns, a row each; the places are those in the example's whole text. Only
    its target has a trained span, in the context both places are null.
    """
    shown = F.explode(F.sequence("example", F.col("n_examples") - 1))
    every = turns.select("*", shown.alias("shown"))
    mine = [F.when(F.col("shown") == F.col("example"), F.col(c)).alias(c) for c in ("loss_start", "loss_end")]
    return every.select("conv_id", F.col("shown").alias("example"), "n_examples", "piece", "formatted", "start", *mine)


def render(written: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end) of ``examples``, each in one row; example is its last turn's number.

    A row holds a whole example, so this is for conversations that a model's context can take, not
    for one that holds much of the table.
    """
    parts = F.sort_array(F.collect_list(F.struct("piece", "formatted")))
    return written.groupBy("conv_id", F.col("example").alias("number")).agg(
        F.max("piece").alias("example"),
        F.array_join(F.transform(parts, lambda p: p["formatted"]), "").alias("text"),
        F.max("loss_start").alias("loss_start"),
        F.max("loss_end").alias("loss_end"),
    ).drop("number")


def unescape(text: str) -> str:
    """The text behind an escaped one: a backslash stands for the character after it."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def read_piece(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, _, rest = formatted.removeprefix(OPEN).partition(CLOSE)
    return unescape(role), unescape(rest.removesuffix(END))


def read_back(written: DataFrame) -> DataFrame:
    """One row per conversation of ``examples``, from the formatted text alone.

    n_turns and turns_sha256, over role, newline, text, newline of each turn, are read from the last
    example, which shows all turns; loss_chars and loss_sha256 from the trained span of every
    example; formatted_chars is the length of all examples.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def out(rows: list[list]) -> pa.RecordBatch:
            done = [[c, n, turns.hexdigest(), chars, loss.hexdigest()] for c, n, turns, chars, loss in rows]
            kinds = [kind_of[0], pa.int64(), pa.string(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

        kind_of = [None]
        for batch in small_batches(batches):
            kind_of[0], rows = batch.schema.field(0).type, []
            for conv, last, formatted, start, loss_start, loss_end in zip(
                *(batch.column(i).to_pylist() for i in range(6))
            ):
                if state is None or state[0] != conv:
                    rows += [state] if state else []
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256()]
                if last:
                    role, text = read_piece(formatted)
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                if loss_start is not None:
                    trained = unescape(formatted[loss_start - start : loss_end - start])
                    state[3] += len(trained)
                    state[4].update(trained.encode())
            if rows:
                yield out(rows)
        if state:
            yield out([state])

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    kind = written.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string"
    last = F.col("example") == F.col("n_examples") - 1
    read = written.where(last | F.col("loss_start").isNotNull())
    ordered = read.repartition("conv_id").sortWithinPartitions("conv_id", "piece", "example")
    digests = ordered.select("conv_id", last, "formatted", "start", "loss_start", "loss_end").mapInArrow(run, schema)
    lengths = written.groupBy("conv_id").agg(F.sum(F.char_length("formatted")).alias("formatted_chars"))
    both = digests.unionByName(lengths, allowMissingColumns=True)
    return both.groupBy("conv_id").agg(*(F.max(c).alias(c) for c in (*names[1:], "formatted_chars")))
