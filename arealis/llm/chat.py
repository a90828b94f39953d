"""Chat formatting: minimum-cost repair of role sequences, and their rendering."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import quoted, small_side, staged, text_of
from arealis.session import ensure_checkpoint_dir

ROLES = ("system", "user", "assistant")
# which role may follow which; the start is followed by a system turn or a user turn
LEGAL = {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
LAST = "assistant"  # a conversation ends with this role
STATES = (None, *ROLES)
UNKNOWN = len(ROLES)
ACTIONS = ("keep", "merge", "insert")


@dataclass(frozen=True)
class Costs:
    merge: float = 1.0
    relabel: float = 2.0
    insert: float = 3.0


@dataclass(frozen=True)
class Automaton:
    """For each role of a turn (the last one: unknown) the costs of going from state to state, how, and over which inserted role."""

    cost: np.ndarray
    action: np.ndarray
    inserted: np.ndarray
    end: np.ndarray
    tail: tuple[tuple[str, ...], ...]


def automaton(costs: Costs) -> Automaton:
    n = len(STATES)
    cost = np.full((UNKNOWN + 1, n, n), np.inf)
    action = np.zeros((UNKNOWN + 1, n, n), np.int8)
    inserted = np.full((UNKNOWN + 1, n, n), -1, np.int8)
    for r in range(UNKNOWN + 1):
        for s, last in enumerate(STATES):
            for t, role in enumerate(ROLES, 1):
                change = 0.0 if r == t - 1 else costs.relabel
                ways = []
                if role in LEGAL[last]:
                    ways.append((change, 0, -1))
                if last == role:
                    ways.append((change + costs.merge, 1, -1))
                ways += [(change + costs.insert, 2, ROLES.index(x)) for x in LEGAL[last] if role in LEGAL[x]]
                if ways:
                    cost[r, s, t], action[r, s, t], inserted[r, s, t] = min(ways)
    end, tail = np.zeros(n), []
    for s, last in enumerate(STATES):
        added, role = [], last
        while role is not None and role != LAST:
            role = LEGAL[role][0]
            added.append(role)
        end[s] = costs.insert * len(added)
        tail.append(tuple(added))
    return Automaton(cost, action, inserted, end, tuple(tail))


def _through(a: Automaton, codes: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """Least costs of reaching each state (last axis) after the turns, from the costs before them."""
    for r in codes:
        ahead = (ahead[..., :, None] + a.cost[r]).min(-2)
    return ahead


def _path(a: Automaton, codes: np.ndarray, entry: int, leave: int) -> np.ndarray:
    """States after each turn on a cheapest way from ``entry``; ``leave`` is the last state, or -1 where the conversation ends."""
    best = np.full(len(STATES), np.inf)
    best[entry] = 0
    came = np.zeros((len(codes), len(STATES)), np.int8)
    for i, r in enumerate(codes):
        ways = best[:, None] + a.cost[r]
        came[i] = ways.argmin(0)
        best = ways.min(0)
    out = np.zeros(len(codes), np.int64)
    state = int((best + a.end).argmin()) if leave < 0 else leave
    for i in range(len(codes) - 1, -1, -1):
        out[i] = state
        state = int(came[i, state])
    return out


def _fragments(a: Automaton):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Cost matrices of the first and the last conversation of a partition, which neighbours may share."""
        first = last = None
        for batch in batches:
            for conv, rows in groupby(zip(batch["conv"], batch["code"], strict=True), key=lambda x: x[0]):
                codes = np.fromiter((c for _, c in rows), np.int64)
                part = int(batch["part"].iloc[0])
                start = last[2] if last is not None and last[1] == conv else np.where(np.eye(len(STATES)) > 0, 0.0, np.inf)
                last = (part, conv, _through(a, codes, start))
                if first is None or first[1] == conv:
                    first = last
        rows = [] if first is None else [first] if first[1] == last[1] else [first, last]
        yield pd.DataFrame({"part": [r[0] for r in rows], "conv": [r[1] for r in rows], "matrix": [r[2].ravel().tolist() for r in rows]})

    return run


def _stitch(a: Automaton):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """States at the borders between the fragments of one conversation."""
        pdf = pdf.sort_values("part")
        n = len(STATES)
        matrices = [np.asarray(m, float).reshape(n, n) for m in pdf["matrix"]]
        best, came = np.where(np.arange(n) == 0, 0.0, np.inf), []
        for m in matrices:
            ways = best[:, None] + m
            came.append(ways.argmin(0))
            best = ways.min(0)
        leave = [0] * len(matrices)
        state = int((best + a.end).argmin())
        for i in range(len(matrices) - 1, -1, -1):
            leave[i] = state
            state = int(came[i][state])
        return pd.DataFrame({"part": pdf["part"], "conv": pdf["conv"], "entry": [0, *leave[:-1]], "leave": [*leave[:-1], -1]})

    return run


def _repair(a: Automaton):
    def solved(rows: pd.DataFrame) -> pd.DataFrame:
        codes = rows["code"].to_numpy()
        entry, leave = int(rows["entry"].iloc[0]), int(rows["leave"].iloc[0])
        after = _path(a, codes, entry, leave)
        before = np.concatenate([[entry], after[:-1]])
        how = a.action[codes, before, after]
        into = a.inserted[codes, before, after]
        tail = [""] * len(rows)
        if leave < 0:
            tail[-1] = ",".join(("end", *a.tail[after[-1]]))
        return pd.DataFrame(
            {
                "row": rows["row"],
                "role_out": [ROLES[s - 1] for s in after],
                "action": [ACTIONS[h] for h in how],
                "relabelled": codes != after - 1,
                "inserted": [ROLES[i] if i >= 0 else None for i in into],
                "opens": before == 0,
                "tail": tail,
                "cost": a.cost[codes, before, after] + np.where([bool(t) for t in tail], a.end[after], 0.0),
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:  # a conversation may go over several batches; only its codes are held
            key = batch["part"].astype(str) + "/" + batch["conv"]
            for name, rows in batch.groupby(key, sort=False):
                if held and held[0][0] != name:
                    yield solved(pd.concat([h[1] for h in held]))
                    held = []
                held.append((name, rows))
        if held:
            yield solved(pd.concat([h[1] for h in held]))

    return run


def repair_roles(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", costs: Costs | None = None) -> DataFrame:
    """Repair every conversation to a legal sequence at the least cost: a row per turn, and what to render for it.

    Legal is an optional system turn, then user and assistant in turn, the assistant last.  A turn is kept, given another
    role, merged into the message before it, or preceded by an empty message; empty messages may be added at the end.  The
    cheapest choice of all turns of a conversation together is found by dynamic programming over the automaton's states.

    Turns are range-partitioned in order, so a conversation of any length is spread over tasks: each task reduces its
    fragment to a matrix of costs between states, the fragments of a conversation are stitched by their matrices, and each
    is then solved between its border states.  Only role codes go through Python; texts are joined back by row.

    Returns the conversation, turn, ``position`` (order of all turns), ``role`` (repaired), ``action`` (``keep``,
    ``merge``, ``insert``), ``relabelled``, ``cost`` and ``piece``: the pieces of a conversation in order of position are
    its rendered text.  Roles are trimmed and read without case; a null or other role is unknown and is given one at the
    cost of a relabel.  Null texts are empty; turns of the same number follow their role and text, null numbers come last;
    rows of a null conversation are one conversation; repeated rows are turns of their own; an empty table gives an empty
    result; other columns are ignored.
    """
    a = automaton(costs or Costs())
    code = F.lit(UNKNOWN)
    for i, name in enumerate(ROLES):
        code = F.when(F.lower(F.trim(quoted(role).cast("string"))) == name, F.lit(i)).otherwise(code)
    conv = F.coalesce(F.concat(F.lit("c"), quoted(conversation).cast("string")), F.lit("n"))
    base = df.select(quoted(conversation).alias("conversation"), quoted(turn).alias("turn"), text_of(quoted(text)).alias("text"), conv.alias("conv"), code.alias("code"))
    order = [F.col("conv"), F.col("turn").asc_nulls_last(), F.col("code"), F.xxhash64("text"), F.col("text")]
    ensure_checkpoint_dir(df.sparkSession)
    # a checkpoint keeps partitions and their order, which a rewritten table would not
    ordered = base.repartitionByRange(*order[:4]).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id()).checkpoint()
    coded = ordered.select(F.spark_partition_id().alias("part"), "conv", "code", "row")
    edges = staged(coded.select("part", "conv", "code").mapInPandas(_fragments(a), "part int, conv string, matrix array<double>"))
    shared = edges.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv")
    borders = staged(edges.join(shared, "conv").groupBy("conv").applyInPandas(_stitch(a), "part int, conv string, entry int, leave int"))
    n = borders.count()
    joined = coded.join(small_side(borders, n, 64), ["part", "conv"], "left")
    if n * 64 > 32 << 20:  # the join was a shuffle, which lost the order
        joined = joined.repartition("part").sortWithinPartitions("part", "row")
    joined = joined.select("part", "conv", "code", "row", F.coalesce("entry", F.lit(0)).alias("entry"), F.coalesce("leave", F.lit(-1)).alias("leave"))
    solved = joined.mapInPandas(_repair(a), "row long, role_out string, action string, relabelled boolean, inserted string, opens boolean, tail string, cost double")
    rows = ordered.select("conversation", "turn", "text", "row").join(solved, "row")
    close = F.lit("<|end|>\n")
    head = F.concat(F.lit("<|"), F.col("role_out"), F.lit("|>\n"))
    empty = F.when(F.col("inserted").isNotNull(), F.concat(F.lit("<|"), F.col("inserted"), F.lit("|>\n"), close)).otherwise("")
    start = F.when(F.col("action") == "merge", F.lit("\n")).otherwise(F.concat(F.when(F.col("opens"), F.lit("")).otherwise(close), empty, head))
    ends = F.transform(F.filter(F.split("tail", ","), lambda x: (x != "") & (x != "end")), lambda x: F.concat(F.lit("<|"), x, F.lit("|>\n"), close))
    stop = F.when(F.col("tail") != "", F.concat(close, F.array_join(ends, ""))).otherwise("")
    piece = F.concat(start, F.col("text"), stop)
    return rows.select(F.col("conversation").alias(conversation), F.col("turn").alias(turn), F.col("row").alias("position"), F.col("role_out").alias("role"), "action", "relabelled", "cost", piece.alias("piece"))


def render(repaired: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """One text per conversation, for conversations whose text fits one row."""
    pieces = F.sort_array(F.collect_list(F.struct("position", "piece")))
    return repaired.groupBy(conversation).agg(F.sum("cost").alias("cost"), F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("rendered"))
