"""Iterative joins to a fixpoint (transitive closures, trails) with lineage cut.

Each round joins only the *new* rows of the previous round (semi-naive
evaluation); the accumulated frame is checkpointed to the reliable checkpoint
folder every few rounds so that neither the plan nor the lineage grows with
the number of rounds, and a lost executor recomputes at most a few rounds."""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

CHECKPOINT_EVERY = 3


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the reliable checkpoint folder and cut its lineage
    (used for the static inputs of a loop and for each round's new rows)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_cut = cut


def fixpoint(seed: DataFrame, step: Callable[[DataFrame], DataFrame], key: list[str]) -> DataFrame:
    """Least fixpoint of ``total = seed ∪ step(total)`` under set semantics on
    ``key`` columns.  ``step`` receives the last round's new rows."""
    total = cut(seed.select(*key).distinct())
    delta = total
    for i in count(1):
        new = cut(step(delta).select(*key).distinct().join(total, on=key, how="left_anti"))
        if new.isEmpty():
            return total
        total = total.unionByName(new)
        if i % CHECKPOINT_EVERY == 0:
            total = cut(total)
        delta = new


def reach(seed: DataFrame, steps: DataFrame) -> DataFrame:
    """(start, node): nodes at any number of ``steps`` (node, next) from the
    seed (start, node), by path doubling: each round follows steps twice as
    long, so a chain of n steps takes log2(n) rounds.  Made for relations that
    are (nearly) functions, such as list tails, where longer steps are no more
    than the single ones; cycles end it as well, as a round without a new node
    means that none is left at any distance."""
    total = cut(seed.select("start", "node").distinct())
    jump = cut(steps.select("node", "next").distinct())
    for i in count(1):
        new = cut(total.join(jump, "node").select("start", F.col("next").alias("node")).distinct().join(
            total, ["start", "node"], "left_anti"))
        if new.isEmpty():
            return total
        total = total.unionByName(new)
        if i % CHECKPOINT_EVERY == 0:
            total = cut(total)
        far = jump.select(F.col("node").alias("next"), F.col("next").alias("_far"))
        jump = cut(jump.join(far, "next").select("node", F.col("_far").alias("next")).distinct())


def expand(seed: DataFrame, step: Callable[[DataFrame], DataFrame], max_rounds: int | None = None) -> DataFrame:
    """Bag iteration: ``frontier_{i+1} = step(frontier_i)`` until a round is
    empty; returns the union of all rounds (used for trails, whose rows are
    distinct by construction and end because an edge is used once).
    ``max_rounds`` limits the rounds where the caller asks for short ones only."""
    out = cut(seed)
    frontier = out
    for i in count(1):
        if max_rounds is not None and i > max_rounds:
            return out
        frontier = cut(step(frontier))
        if frontier.isEmpty():
            return out
        out = out.unionByName(frontier)
        if i % CHECKPOINT_EVERY == 0:
            out = cut(out)
