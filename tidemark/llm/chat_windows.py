"""Chat formatting in windows of a token budget.

Turns are marked by control strings, and control strings inside texts are escaped
reversibly. Prefix sums of the turns' tokens, taken per conversation in blocks of
turns, place every turn in a slot of SLOT_BUDGETS budgets; a slot is the unit of
work, so that a conversation of any length is dealt over many tasks. Within a slot
windows are filled with whole turns up to the budget. Each window starts with the
conversation's system turn and repeats up to `history` tokens of the turns before
it; the loss mask covers the assistant texts that are new in the window, so that
every assistant text is a target exactly once.

Defined results: a null text or role is empty. Turns are ordered by turn, role and
text, a null turn first; repeated rows are turns of their own. A turn that exceeds
the budget has a window that exceeds it. A null conv_id is a conversation of its
own. Extra columns are ignored. An empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.session import materialize

START, END = "<|im_start|>", "<|im_end|>"
# Tokens that the marks of a turn cost, besides those of its role and text.
MARK_TOKENS = 6
BLOCK_TURNS = 1024
SLOT_BUDGETS = 16

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)

WINDOWS = (
    "conv_id long, first_turn long, repeated int, tokens long, text string, "
    "loss array<struct<start:int, stop:int>>"
)


def escape(text: str) -> str:
    """No control string is left: every <| (also <\\| and so on) gets one more backslash."""
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    plain = unescape(role)
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], plain)


def format_turn(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


def parse(window: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text, and the place of the escaped text, of each turn of a window."""
    for m in _TURN.finditer(window):
        yield unescape_role(m[1]), unescape(m[2]), m.start(2), m.end(2)


def _with_cost(turns: DataFrame, vocabulary: str) -> DataFrame:
    def counted(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode = tokens.encoder(vocabulary, tokens.SpacePrefixed).encode
        for batch in batches:
            costs = [
                len(encode(escape_role(role).encode()) + encode(escape(text).encode()))
                // tokens.ID_BYTES
                + MARK_TOKENS
                for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(costs, pa.int64())],
                names=["conv_id", "turn", "role", "text", "cost"],
            )

    source = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    schema = "conv_id long, turn long, role string, text string, cost long"
    return materialize(source.mapInArrow(counted, schema), "turns")


def _with_prefix(turns: DataFrame) -> DataFrame:
    """Adds `before` (tokens) and `position` (turns) ahead of each turn of its conversation."""
    block = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(2**62)))
    turns = turns.withColumn("block", block.cast("long"))
    earlier = Window.partitionBy("conv_id").orderBy("block")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    blocks = (
        turns.groupBy("conv_id", "block")
        .agg(F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("turns"))
        .select(
            F.col("conv_id").alias("_conv"),
            F.col("block").alias("_block"),
            F.coalesce(F.sum("cost").over(earlier), zero).alias("cost_before"),
            F.coalesce(F.sum("turns").over(earlier), zero).alias("turns_before"),
        )
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    ahead = inside.rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    return (
        turns.withColumn("cost_ahead", F.coalesce(F.sum("cost").over(ahead), zero))
        .withColumn("number", F.row_number().over(inside) - 1)
        .join(blocks, same)
        .select(
            "conv_id", "role", "text", "cost",
            (F.col("cost_before") + F.col("cost_ahead")).alias("before"),
            (F.col("turns_before") + F.col("number")).alias("position"),
        )
    )


def windows(turns: DataFrame, vocabulary: str, budget: int, history: int) -> DataFrame:
    """Formatted windows of all conversations."""
    size = budget * SLOT_BUDGETS
    placed = _with_prefix(_with_cost(turns, vocabulary)).withColumn(
        "slot", F.floor(F.col("before") / size).cast("long")
    )
    placed = materialize(placed.withColumn("kind", F.lit(2)), "slots")
    # What a later slot needs of earlier ones: the system turn and the last turns.
    system = placed.filter("position = 0 and role = 'system'")
    later = (
        placed.filter("slot > 0")
        .select(F.col("conv_id").alias("_conv"), F.col("slot").alias("_slot"))
        .distinct()
    )
    systems = (
        system.join(later, F.col("conv_id").eqNullSafe(F.col("_conv")))
        .withColumn("slot", F.col("_slot"))
        .withColumn("kind", F.lit(0))
        .select(*placed.columns)
    )
    end = (F.col("slot") + 1) * size
    tails = (
        placed.filter((F.col("before") + F.col("cost") > end - history))
        .filter("not (position = 0 and role = 'system')")
        .withColumn("slot", F.col("slot") + 1)
        .withColumn("kind", F.lit(1))
    )
    rows = (
        placed.unionByName(systems)
        .unionByName(tails)
        .select("conv_id", "slot", "position", "kind", "role", "text", "cost")
        .repartition("conv_id", "slot")
        .sortWithinPartitions("conv_id", "slot", "position")
    )

    def filled(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def all_rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        loss_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), loss_type]
        names = ["conv_id", "first_turn", "repeated", "tokens", "text", "loss"]

        def batch_of(out: list[tuple]):
            columns = zip(*out) if out else ([] for _ in types)
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        out: list[tuple] = []
        held = 0
        for (conv_id, _), group in groupby(all_rows(), key=lambda r: r[:2]):
            for window in fill_windows([r[2:] for r in group], budget, history):
                out.append((conv_id, *window))
                held += len(window[3])
            if held >= 8 << 20:
                yield batch_of(out)
                out, held = [], 0
        yield batch_of(out)

    return rows.mapInArrow(filled, WINDOWS)


def fill_windows(turns: list[tuple], budget: int, history: int) -> Iterator[tuple]:
    """Windows of one slot, from its turns (position, kind, role, text, cost) in order.

    kind is 0 for the system turn of an earlier slot, 1 for history, 2 for new turns.
    """
    system = [t for t in turns if t[0] == 0 and t[2] == "system"][:1]
    other = [t for t in turns if not (t[0] == 0 and t[2] == "system")]
    fresh = [t for t in system if t[1] == 2]
    at = next((i for i, t in enumerate(other) if t[1] == 2), len(other))
    while fresh or at < len(other):
        past: list[tuple] = []
        if not fresh:  # later windows repeat the system turn and some history
            room = history
            while len(past) < at and other[at - 1 - len(past)][4] <= room:
                past.append(other[at - 1 - len(past)])
                room -= past[-1][4]
            past.reverse()
        lead = [] if fresh else system
        used = sum(t[4] for t in lead + past + fresh)
        # History gives way to the first new turn.
        while past and at < len(other) and used + other[at][4] > budget:
            used -= past.pop(0)[4]
        new = list(fresh)
        while at < len(other) and (not new or used + other[at][4] <= budget):
            new.append(other[at])
            used += other[at][4]
            at += 1
        fresh = []
        parts, loss, place = [], [], 0
        for turn in lead + past + new:
            formatted = format_turn(turn[2], turn[3])
            if turn[2] == "assistant" and len(parts) >= len(lead) + len(past):
                stop = place + len(formatted) - len(END) - 1
                loss.append({"start": stop - len(escape(turn[3])), "stop": stop})
            parts.append(formatted)
            place += len(formatted)
        yield new[0][0], len(lead) + len(past), used, "".join(parts), loss


def summary(stored: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: digests of turns and targets."""

    def digested(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
        names.append("formatted_chars")
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def all_rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out: list[tuple] = []
        for conv_id, group in groupby(all_rows(), key=lambda r: r[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = formatted = 0
            for _, repeated, text, spans in group:
                formatted += len(text)
                for i, (role, said, _, _) in enumerate(parse(text)):
                    if i >= repeated:
                        n_turns += 1
                        turns.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    target = unescape(text[span["start"] : span["stop"]])
                    loss_chars += len(target)
                    loss.update(target.encode())
            out.append(
                (conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), formatted)
            )
            if len(out) >= 10_000:
                arrays = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                out = []
        if out:
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    # The digests run over a conversation in order; only one window is held at a time.
    return (
        stored.select("conv_id", "first_turn", "repeated", "text", "loss")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "first_turn")
        .select("conv_id", "repeated", "text", "loss")
        .mapInArrow(
            digested,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
            "loss_sha256 string, formatted_chars long",
        )
    )
