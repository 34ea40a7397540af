"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in turns, from a user
turn to an assistant turn. Every turn of a conversation is kept under its role, relabelled, or
merged into the turn before it; empty turns may be inserted before any turn and at the end.
The cheapest such repair is a shortest path over the states of the automaton: what a stretch of
turns costs from each state to each other is a matrix, and stretches are joined by min-plus
products. So a conversation of any length is cut into stretches, whose matrices are found
apart; the states at the cuts follow from their products; and the path inside a stretch from
its two states.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.session import cut_lineage

ROLES = ("system", "user", "assistant")
#: States: nothing so far, and the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = 4
_FAR = 1 << 40
#: Costs of a relabelled turn, a merged turn of the same and of another role, an inserted turn.
RELABEL, MERGE_SAME, MERGE_OTHER, INSERT = 3, 1, 4, 2
#: Inserted roles on the way from one state to the next, fewest first.
_FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Turns of a stretch are 2 to this power at most, and so are stretches of a tract.
_BITS = 12
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _insertions() -> dict[tuple[int, int], tuple[int, ...]]:
    """Fewest empty turns that lead from one state to another."""
    found: dict[tuple[int, int], tuple[int, ...]] = {}
    for first in range(_STATES):
        found[first, first], edge = (), [first]
        while edge:
            state = edge.pop(0)
            for then in _FOLLOWS[state]:
                if (first, then) not in found:
                    found[first, then] = (*found[first, state], then)
                    edge.append(then)
    return found


INSERTED = _insertions()


def _moves(role: int) -> list[tuple[int, int, int, str, tuple[int, ...]]]:
    """(from, to, cost, action, inserted roles) for a turn of a role (0 if it is none of the three).

    Of moves between the same states the cheapest is kept, of equals the first in this order:
    keep, relabel, merge.
    """
    best: dict[tuple[int, int], tuple] = {}
    for first in range(_STATES):
        options = []
        for before, roles in [(s, r) for (f, s), r in INSERTED.items() if f == first]:
            for then in _FOLLOWS[before]:
                action, cost = ("keep", 0) if then == role else ("relabel", RELABEL)
                options.append((then, INSERT * len(roles) + cost, action, roles))
        if first != START:
            options.append((first, MERGE_SAME if first == role else MERGE_OTHER, "merge", ()))
        for then, cost, action, roles in options:
            if (first, then) not in best or cost < best[first, then][0]:
                best[first, then] = (cost, action, roles)
    return [(f, t, *move) for (f, t), move in sorted(best.items())]


MOVES = [_moves(role) for role in range(_STATES)]


def _matrices() -> np.ndarray:
    out = np.full((_STATES, _STATES, _STATES), _FAR, np.int64)
    for role, moves in enumerate(MOVES):
        for first, then, cost, *_ in moves:
            out[role, first, then] = cost
    return out


MATRICES = _matrices()


def end_costs() -> np.ndarray:
    """Costs of the empty turns after the last one; an assistant turn must be last."""
    return np.array([INSERT * len(INSERTED[s, ASSISTANT]) for s in range(_STATES)], np.int64)


def between(matrices: np.ndarray, first: int, last: int) -> list[int]:
    """States before, between and after matrices on the cheapest way from `first` to `last`."""
    cost = np.full(_STATES, _FAR, np.int64)
    cost[first] = 0
    came = np.empty((len(matrices), _STATES), np.int8)
    for i, matrix in enumerate(matrices):
        ways = cost[:, None] + matrix
        came[i] = ways.argmin(axis=0)
        cost = np.minimum(_FAR, ways.min(axis=0))
    states = [last]
    for i in range(len(matrices) - 1, -1, -1):
        states.append(int(came[i, states[-1]]))
    return states[::-1]


def product(matrices: np.ndarray) -> np.ndarray:
    """Min-plus product of matrices in their order."""
    while len(matrices) > 1:
        even = len(matrices) // 2 * 2
        pairs = matrices[:even:2, :, :, None] + matrices[1:even:2, None, :, :]
        matrices = np.concatenate([np.minimum(_FAR, pairs.min(axis=2)), matrices[even:]])
    return matrices[0]


def _matrices_of(flat: np.ndarray) -> np.ndarray:
    return np.asarray(flat, np.int64).reshape(-1, _STATES, _STATES)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _turn_costs(roles: pd.Series) -> pd.Series:
    return pd.Series([product(MATRICES[np.asarray(r, np.int64)]).ravel() for r in roles])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _part_costs(flat: pd.Series) -> pd.Series:
    return pd.Series([product(_matrices_of(f)).ravel() for f in flat])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _whole_states(flat: pd.Series) -> pd.Series:
    """States of the whole conversation, and then its cost."""
    out = []
    for f in flat:
        matrices = _matrices_of(f)
        total = product(matrices)[START] + end_costs()
        last = int(total.argmin())
        out.append([*between(matrices, START, last), int(total[last])])
    return pd.Series(out)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _part_states(flat: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
    return pd.Series([between(_matrices_of(f), a, b) for f, a, b in zip(flat, first, last)])


@F.pandas_udf(T.ArrayType(T.StructType().add("before", T.IntegerType()).add("after", T.IntegerType())))
def _turn_states(roles: pd.Series, first: pd.Series, last: pd.Series) -> pd.Series:
    out = []
    for r, a, b in zip(roles, first, last):
        states = between(MATRICES[np.asarray(r, np.int64)], a, b)
        out.append([{"before": x, "after": y} for x, y in zip(states, states[1:])])
    return pd.Series(out)


def _gathered(rows: DataFrame, by: list[str], key: str) -> DataFrame:
    """The parts of a stretch in order: keys, counts and costs."""
    each = F.array_sort(F.collect_list(F.struct(F.col(key).alias("key"), "n", "costs")))
    return rows.groupBy(*by).agg(each.alias("each"), F.sum("n").alias("n"))


def _handed_down(parents: DataFrame, key: str) -> DataFrame:
    """A row for each part of a stretch: its key, the states before and after it, turns before it.

    `parents` has each, states and offset.
    """
    sizes = F.col("each.n")
    before = lambda i: F.aggregate(F.slice(sizes, 1, i), F.lit(0).cast("long"), lambda a, n: a + n)
    parts = F.transform(
        F.col("each.key"),
        lambda k, i: F.struct(
            k.alias(key),
            F.get(F.col("states"), i).alias("first"),
            F.get(F.col("states"), i + 1).alias("last"),
            (F.col("offset") + before(i)).alias("offset"),
        ),
    )
    return parents.select("conv", F.explode(parts).alias("part")).select("conv", "part.*")


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, position, turn, role, action, cost, rendered.

    `conversations` has conv_id, turn, role and text. Turns are ordered by turn, null last, then
    by a hash of role and text; position counts from 1. Role names are taken without regard to
    case and outer blanks; a null or unknown role always has to be relabelled or merged. A null
    text counts as empty. cost is that of the whole conversation. The strings `rendered`, put
    together by position, are the conversation's text; so no conversation is gathered into one
    row. Rows without conv_id form one conversation; repeated rows are turns of their own; no
    rows give no rows; other columns do not matter.
    """
    role = F.lower(F.trim(F.coalesce("role", F.lit(""))))
    code = F.coalesce(*(F.when(role == name, F.lit(i + 1)) for i, name in enumerate(ROLES)), F.lit(0))
    turns = conversations.select(
        F.struct("conv_id").alias("conv"),
        "turn",
        F.coalesce("text", F.lit("")).alias("text"),
        code.cast("int").alias("role"),
        F.xxhash64("role", "text").alias("tie"),
        F.rand(7).alias("salt"),  # rows alike in all else need not share a task
    )
    order = ["conv", F.col("turn").asc_nulls_last(), "tie", "salt"]
    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(placed.drop("tie", "salt").withColumn("seq", F.monotonically_increasing_id()))

    shifted = lambda c, bits: F.shiftright(c, bits)
    each = F.array_sort(F.collect_list(F.struct("seq", "role")))
    stretches = placed.groupBy("conv", shifted("seq", _BITS).alias("stretch")).agg(each.alias("each"))
    stretches = cut_lineage(
        stretches.select(
            "conv", "stretch", F.col("each.seq").alias("seqs"), F.col("each.role").alias("roles"),
            F.size("each").cast("long").alias("n"), _turn_costs(F.col("each.role")).alias("costs"),
        )
    )
    tracts = _gathered(stretches.withColumn("tract", shifted("stretch", _BITS)), ["conv", "tract"], "stretch")
    tracts = cut_lineage(tracts.withColumn("costs", _part_costs(F.flatten("each.costs"))))
    wholes = _gathered(tracts.select("conv", "tract", "n", "costs"), ["conv"], "tract")
    wholes = wholes.withColumn("states", _whole_states(F.flatten("each.costs"))).withColumn("offset", F.lit(0).cast("long"))
    wholes = cut_lineage(wholes)
    ends = wholes.select(
        "conv", F.element_at("states", -1).alias("cost"), F.element_at("states", -2).alias("end"), F.col("n").alias("turns")
    )

    of_tracts = _handed_down(wholes, "tract")
    known = tracts.join(of_tracts, ["conv", "tract"])
    known = known.withColumn("states", _part_states(F.flatten("each.costs"), F.col("first"), F.col("last")))
    of_stretches = _handed_down(known, "stretch")
    solved = stretches.select("conv", "stretch", "seqs", "roles").join(of_stretches, ["conv", "stretch"])
    solved = solved.withColumn("states", _turn_states(F.col("roles"), F.col("first"), F.col("last")))
    moves = F.transform(
        "seqs",
        lambda seq, i: F.struct(
            seq.alias("seq"), (F.col("offset") + i + 1).alias("position"), F.get(F.col("states"), i).alias("state")
        ),
    )
    moves = solved.select("conv", F.explode(moves).alias("move")).select("conv", "move.seq", "move.position", "move.state.*")
    rows = placed.drop("conv").join(moves, "seq").join(ends, "conv")
    return _rendered(rows)


def _rendered(rows: DataFrame) -> DataFrame:
    """What each turn adds to its conversation's text."""
    cases = [(role, f, t, action, ins) for role, moves in enumerate(MOVES) for f, t, _, action, ins in moves]
    here = lambda role, f, t: (F.col("role") == role) & (F.col("before") == f) & (F.col("after") == t)
    action = F.coalesce(*(F.when(here(role, f, t), F.lit(a)) for role, f, t, a, _ in cases))
    empty = F.coalesce(*(F.when(here(role, f, t), F.lit(empty_turns(ins))) for role, f, t, _, ins in cases))
    name = F.element_at(F.array(*map(F.lit, ROLES)), F.col("after"))
    closed = F.when(F.col("before") == START, F.lit("")).otherwise(F.lit(CLOSE))
    opened = F.concat(closed, empty, F.lit(OPEN), name, F.lit("\n"), F.col("text"))
    piece = F.when(action == "merge", F.concat(F.lit("\n"), F.col("text"))).otherwise(opened)
    final = F.coalesce(
        *(F.when(F.col("end") == s, F.lit(CLOSE + empty_turns(INSERTED[s, ASSISTANT]))) for s in range(1, _STATES))
    )
    last = F.when(F.col("position") == F.col("turns"), final).otherwise(F.lit(""))
    return rows.select(
        "conv.conv_id", "position", "turn", name.alias("role"), action.alias("action"),
        F.col("cost").cast("long").alias("cost"), F.concat(piece, last).alias("rendered"),
    )


def empty_turns(states: tuple[int, ...]) -> str:
    return "".join(f"{OPEN}{ROLES[s - 1]}\n{CLOSE}" for s in states)
