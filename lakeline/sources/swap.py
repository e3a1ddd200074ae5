"""Replace table partitions by rename, with a single commit point.

A writer fills ``_swap/<id>/new``; renaming that to ``ready`` commits. From
then on the swap is only rolled forward: a driver that dies in between leaves
a ``ready`` folder that ``recover`` finishes. One writer per table at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

from .fs import Folder

AREA = "_swap"
#: File in a swap that names its partitions, one in a line.
LIST = "_partitions"


def open_swap(spark: SparkSession, table: str) -> Folder:
    return Folder(spark, table).child(AREA).child(uuid.uuid4().hex)


def commit(swap: Folder, table: Folder, partitions: Iterable[str]) -> None:
    """Publish the given partitions of ``new``; one the writer left out becomes empty.

    Their list is written before the commit, so whoever finishes the swap knows what is left to
    do, whatever has been moved already.
    """
    new, partitions = swap.child("new"), sorted(partitions)
    for part in partitions:
        new.child(part).make()
    new.child(LIST).write("\n".join(partitions).encode())
    new.move_to(swap.child("ready"))
    _roll_forward(swap, table)


def recover(spark: SparkSession, path: str) -> int:
    """Finish committed swaps and drop uncommitted ones; returns how many were finished."""
    table = Folder(spark, path)
    finished = 0
    area = table.child(AREA)
    for name in area.names():
        swap = area.child(name)
        if swap.child("ready").exists():
            _roll_forward(swap, table)
            finished += 1
        else:
            swap.delete()
    return finished


def _roll_forward(swap: Folder, table: Folder) -> None:
    """Every step may be repeated: a partition's fresh folder, empty if the writer left it out,
    is there until the partition is done, and what it replaces is set aside first. What the
    moves leave of the folders above is not looked at."""
    ready, old = swap.child("ready"), swap.child("old")
    listed = ready.child(LIST)
    for part in listed.read().decode().splitlines() if listed.exists() else []:
        current, fresh = table.child(part), ready.child(part)
        if not fresh.exists():
            continue
        if current.exists():
            current.move_to(old.child(part))
        if fresh.names():
            fresh.move_to(current)
        else:
            fresh.delete()
    swap.delete()
