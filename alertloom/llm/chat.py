"""Chat formatting: the least costly repair of a conversation's roles, then its rendering.

A legal conversation is an optional system turn, then user and assistant in turns, ending with the
assistant. Each turn may be relabelled or merged into the turn before; empty turns may be inserted. The
cheapest repair is a shortest path through the automaton of legal turns: its states are what was said
last, and each turn is a matrix of the costs from state to state.

Such matrices multiply (least sum for product), so a conversation is cut into chunks, chunks into chunks of
chunks, and only matrices go up. States at the chunks' borders come down the same way. No task sees
more than `CHUNK` turns of a conversation together, however long it is.

Defined cases: turns are taken in order of turn (null first), then role, then a hash of the text. A null conv_id is a
conversation of its own. Null and unknown roles have to be relabelled; null texts are empty. Marks of turns
within a text get a backslash, which `parse` takes away again. Repeated
rows are turns of their own. Of equally cheap repairs one is taken, always the same. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertloom.llm.order import numbered
from alertloom.session import stored

# States: nothing yet, and the role that spoke last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
ALIASES = {
    "system": SYSTEM,
    "developer": SYSTEM,
    "user": USER,
    "human": USER,
    "prompter": USER,
    "assistant": ASSISTANT,
    "gpt": ASSISTANT,
    "bot": ASSISTANT,
    "model": ASSISTANT,
}
LEGAL = {NOTHING: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
CHUNK = 1024
_FAR = 1 << 50


@dataclass(frozen=True)
class Costs:
    merge: int = 1
    relabel: int = 2
    insert: int = 3


def _paths() -> dict[tuple[int, int], list[int]]:
    """The fewest roles to insert after state s before role r may follow."""
    out = {}
    for s in range(4):
        reached = {s: []}
        frontier = [s]
        while frontier:
            for r in LEGAL[frontier[0]]:
                if r not in reached:
                    reached[r] = [*reached[frontier[0]], r]
                    frontier.append(r)
            frontier.pop(0)
        for r in ROLES:
            ways = [way for p, way in reached.items() if r in LEGAL[p]]
            if ways:
                out[s, r] = min(ways, key=len)
    return out


_INSERTED = _paths()
# What is missing at the end of a conversation in each state.
_CLOSING = {NOTHING: [], SYSTEM: [USER, ASSISTANT], USER: [ASSISTANT], ASSISTANT: []}


class Automaton:
    """The cost matrix of a turn for each label (0 for an unknown one), and what each step does."""

    def __init__(self, costs: Costs = Costs()):
        self.steps = np.full((4, 4, 4), _FAR, np.int64)
        self.merges = np.zeros((4, 4, 4), bool)
        for label in range(4):
            for s in range(4):
                for r in ROLES:
                    change = 0 if r == label else costs.relabel
                    join = costs.merge if s == r else _FAR
                    add = costs.insert * len(_INSERTED[s, r]) if (s, r) in _INSERTED else _FAR
                    self.steps[label, s, r] = min(_FAR, change + min(join, add))
                    self.merges[label, s, r] = join < add
        self.closing = np.array([costs.insert * len(_CLOSING[s]) for s in range(4)], np.int64)

    def actions(self, label: int, s: int, r: int) -> tuple[list[int], bool]:
        """Roles inserted before a turn, and whether the turn is merged into the one before."""
        merged = bool(self.merges[label, s, r])
        return ([] if merged else _INSERTED[s, r]), merged


def product(matrices: np.ndarray) -> np.ndarray:
    """Least-sum product of a run of matrices; neighbours are joined in pairs, all at once."""
    while len(matrices) > 1:
        even = len(matrices) // 2 * 2
        a, b = matrices[:even:2], matrices[1:even:2]
        joined = np.minimum((a[:, :, :, None] + b[:, None, :, :]).min(axis=2), _FAR)
        matrices = np.concatenate([joined, matrices[even:]])
    return matrices[0]


def states(matrices: np.ndarray, start: int, ends: np.ndarray) -> list[int]:
    """The states before and after each matrix on a cheapest path; `ends` has the cost of each last state."""
    cost = np.full(4, _FAR, np.int64)
    cost[start] = 0
    ahead = [cost]
    for m in matrices:
        ahead.append(np.minimum((ahead[-1][:, None] + m).min(axis=0), _FAR))
    path = [int((ahead[-1] + ends).argmin())]
    for m, before in zip(matrices[::-1], ahead[-2::-1]):
        path.append(int((before + m[:, path[-1]]).argmin()))
    return path[::-1]


def _labels(role: pa.Array) -> list[int]:
    return [ALIASES.get((r or "").strip().lower(), 0) for r in role.to_pylist()]


def _by_chunk(df: DataFrame, columns: list[str], run, kind: T.StructType | str) -> DataFrame:
    """Apply `run(rows)` to the rows of each (conv, chunk), in order of pos; `rows` is a list of tuples."""
    dealt = df.select("conv", "chunk", "pos", *columns).repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "pos")

    def each(batches):
        key, rows = None, []
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != key:
                    if rows:
                        out.append(run(rows))
                    key, rows = row[:2], []
                rows.append(row)
            if out:
                yield pa.RecordBatch.from_pylist([r for x in out for r in x], schema=arrow)
        if rows:
            yield pa.RecordBatch.from_pylist(run(rows), schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    kind = T.StructType.fromDDL(kind) if isinstance(kind, str) else kind
    arrow = to_arrow_schema(kind)
    return dealt.mapInArrow(each, kind)


def _matrix_of(automaton: Automaton, row: tuple) -> np.ndarray:
    """A row's matrix: of its label at the lowest level, else the one that it carries."""
    return automaton.steps[row[3]] if row[4] is None else np.array(row[4], np.int64).reshape(4, 4)


def _up(level: DataFrame, automaton: Automaton, chunk: int) -> DataFrame:
    """One matrix for each chunk of a level, numbered by the chunk."""

    def run(rows):
        m = product(np.array([_matrix_of(automaton, r) for r in rows]))
        return [{"conv": rows[0][0], "pos": rows[0][1], "label": None, "matrix": m.ravel().tolist()}]

    kind = "conv long, pos long, label int, matrix array<long>"
    return _chunked(stored(_by_chunk(level, ["label", "matrix"], run, kind)), chunk)


def _chunked(level: DataFrame, chunk: int) -> DataFrame:
    return level.withColumn("chunk", F.floor(F.col("pos") / chunk))


def _down(level: DataFrame, above: DataFrame | None, automaton: Automaton) -> DataFrame:
    """The states before and after each row of a level, from those of its chunk in the level above."""
    if above is None:
        framed = level.withColumns({"first": F.lit(NOTHING), "final": F.lit(-1)})
    else:
        ends = above.select("conv", F.col("pos").alias("chunk"), "first", "final")
        framed = level.join(ends, ["conv", "chunk"])

    def run(rows):
        first, final = rows[0][5], rows[0][6]
        ends = automaton.closing if final < 0 else np.where(np.arange(4) == final, 0, _FAR)
        path = states(np.array([_matrix_of(automaton, r) for r in rows]), first, ends)
        return [{"conv": r[0], "pos": r[2], "first": a, "final": b} for r, a, b in zip(rows, path, path[1:])]

    kind = "conv long, pos long, first int, final int"
    return _by_chunk(framed, ["label", "matrix", "first", "final"], run, kind)


def repair(conversations: DataFrame, costs: Costs = Costs(), chunk: int = CHUNK) -> DataFrame:
    """Per turn: conv_id, turn, position, role as given, its label, and the states before and after it.

    Also `is_last`, for what must be added at the end of the conversation.
    """
    automaton = Automaton(costs)
    known = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    label = F.coalesce(known[F.lower(F.trim("role"))], F.lit(0))
    rows = conversations.select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("mixed"))
    turns = numbered(rows, ["conv_id", "turn", "role", "mixed"], "place").drop("mixed")
    spans = turns.groupBy("conv_id").agg(F.min("place").alias("conv"), F.count("*").alias("turns"))
    # Each conversation goes by the number of its first turn, which also tells nulls from ids.
    placed = turns.alias("t").join(spans.alias("s"), F.expr("t.conv_id <=> s.conv_id")).select(
        "conv", "t.conv_id", "turn", "role", "text", (F.col("place") - F.col("conv")).alias("pos"), "turns"
    )
    rows = stored(placed.withColumn("label", label))
    longest = rows.agg(F.max("turns")).first()[0] or 0
    bottom = _chunked(rows.select("conv", "pos", "label", F.lit(None).cast("array<long>").alias("matrix")), chunk)
    levels = [bottom]
    while longest > chunk:
        levels.append(_up(levels[-1], automaton, chunk))
        longest = -(-longest // chunk)
    found = None
    for level in reversed(levels):
        found = stored(_down(level, found, automaton))
    joined = rows.join(found, ["conv", "pos"])
    return joined.select(
        "conv_id", "turn", F.col("pos").alias("position"), "role", "text", "label", "first", "final",
        (F.col("pos") == F.col("turns") - 1).alias("is_last"),
    )


def render(repaired: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Per turn: conv_id, turn, position, role (repaired), action, and its piece of the rendered conversation.

    The pieces of a conversation, in order of position, make up its text. A piece opens its turn, after
    inserted empty turns, and closes the turn before unless it is merged into that.
    """
    automaton = Automaton(costs)
    kind = T.StructType([repaired.schema["conv_id"], repaired.schema["turn"], T.StructField("position", T.LongType())])
    for c in ("role", "action", "rendered"):
        kind = kind.add(c, T.StringType())

    def run(batches):
        for batch in batches:
            role, action, piece = [], [], []
            texts, labels, before, after, last = (batch.column(i).to_pylist() for i in range(3, 8))
            for text, label, s, r, ends in zip(texts, labels, before, after, last):
                inserted, merged = automaton.actions(label, s, r)
                done = ["merge"] * merged + ["relabel"] * (label != r)
                done += [f"insert {ROLES[x]}" for x in inserted]
                role.append(ROLES[r])
                piece.append(_piece(escape(text or ""), s, r, inserted, merged, _CLOSING[r] if ends else None))
                done += [f"close {ROLES[x]}" for x in (_CLOSING[r] if ends else [])]
                action.append(", ".join(done) or "keep")
            rest = [pa.array(x, pa.string()) for x in (role, action, piece)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *rest], names=[f.name for f in kind])

    return repaired.select("conv_id", "turn", "position", "text", "label", "first", "final", "is_last").mapInArrow(run, kind)


_MARK = re.compile(r"<(\\*)\|im_(start|end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|im_(start|end)\|>")


def escape(text: str) -> str:
    """The text with a backslash added to each mark of turns in it, so that it opens or ends none."""
    return _MARK.sub(r"<\\\1|im_\2|>", text) if "|im_" in text else text


def unescape(text: str) -> str:
    """The text that `escape` was given."""
    return _ESCAPED.sub(r"<\1|im_\2|>", text) if "|im_" in text else text


def parse(rendered: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a whole rendered conversation."""
    turns = rendered.split("<|im_start|>")[1:]
    parts = (t.removesuffix("<|im_end|>\n").partition("\n") for t in turns)
    return [(role, unescape(body)) for role, _, body in parts]


def _piece(text: str, s: int, r: int, inserted: list[int], merged: bool, closing: list[int] | None) -> str:
    if merged:
        out = "\n" + text
    else:
        out = "" if s == NOTHING else "<|im_end|>\n"
        out += "".join(f"<|im_start|>{ROLES[x]}\n<|im_end|>\n" for x in inserted)
        out += f"<|im_start|>{ROLES[r]}\n{text}"
    if closing is not None:
        out += "<|im_end|>\n" + "".join(f"<|im_start|>{ROLES[x]}\n<|im_end|>\n" for x in closing)
    return out


def format_conversations(conversations: DataFrame, costs: Costs = Costs(), chunk: int = CHUNK) -> DataFrame:
    """Repair and render: conv_id, turn, position, role, action, rendered."""
    return render(repair(conversations, costs, chunk), costs)
