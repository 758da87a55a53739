"""What a physical plan says."""

from __future__ import annotations


def text(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def has_pair_loop(frame) -> bool:
    """Whether a join looks at all pairs."""
    return "NestedLoop" in text(frame) or "Cartesian" in text(frame)


def has_one_task_exchange(frame) -> bool:
    return "SinglePartition" in text(frame)
