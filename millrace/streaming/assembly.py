"""Assembly of trajectories whose members come in any order.

A manifest names the members it refers to; once all are there the trajectory
is emitted and later members are dropped. What waits is bounded as a whole:
folders are dealt into lanes, each lane holds its share of the limit, and when
it is full its oldest folders are given up first and counted as evicted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Members: (folder, name, refs array<string>, bytes); refs is null except in the manifest.
OUTPUT = "folder string, status string, members bigint, bytes bigint"


def assembled(df: DataFrame) -> DataFrame:
    """The batch form: (folder, status, members, bytes) of every folder.

    complete when all references are there, partial when some are, and
    unparseable without a manifest or references. A reference is a member's
    name, or its name below the folder.
    """
    plain = F.when(F.col("refs").isNull(), F.struct("name", "bytes"))
    by = df.groupBy("folder").agg(F.collect_set(plain).alias("have"), F.array_distinct(F.flatten(F.collect_list("refs"))).alias("refs"), F.count_if(F.col("refs").isNotNull()).alias("manifests"))
    names = F.transform("have", lambda m: m["name"])
    met = F.filter("refs", lambda r: F.array_contains(names, r) | F.array_contains(names, F.concat_ws("/", "folder", r)))
    status = F.when((F.col("manifests") == 0) | (F.size("refs") == 0), "unparseable").when(F.size(met) == F.size("refs"), "complete").otherwise("partial")
    size = F.aggregate("have", F.lit(0).cast("long"), lambda a, m: a + m["bytes"])
    return by.select("folder", status.alias("status"), F.size("have").cast("long").alias("members"), size.alias("bytes"))


STATE = "folders array<string>, refs array<array<string>>, names array<array<string>>, sizes array<array<bigint>>, closed array<string>"


class Lane:
    """Open folders in the order of their first member, and the last closed ones."""

    def __init__(self, state: tuple | None = None):
        folders, refs, names, sizes, closed = state or ([], [], [], [], [])
        self.refs = {f: list(r) for f, r in zip(folders, refs)}
        self.have = {f: dict(zip(n, map(int, z))) for f, n, z in zip(folders, names, sizes)}
        self.closed = dict.fromkeys(closed)

    def state(self) -> tuple:
        return list(self.have), [self.refs[f] for f in self.have], [list(h) for h in self.have.values()], [list(h.values()) for h in self.have.values()], list(self.closed)

    def add(self, folder: str, name: str, named, size: int) -> None:
        if folder in self.closed:
            return
        have, refs = self.have.setdefault(folder, {}), self.refs.setdefault(folder, [])
        if named is None:
            have[name] = int(size)
        elif not refs:
            refs += dict.fromkeys(named)

    def close(self, folder: str, status: str, remember: int) -> tuple:
        have = self.have.pop(folder)
        del self.refs[folder]
        self.closed[folder] = None
        while len(self.closed) > remember:
            del self.closed[next(iter(self.closed))]
        return folder, status, len(have), sum(have.values())

    def settle(self, limit: int, remember: int, over: bool = False) -> list[tuple]:
        """Close what is complete; then, oldest first, what exceeds the limit, or all when time is over."""
        whole = [f for f, have in self.have.items() if self.refs[f] and all(r in have or f"{f}/{r}" in have for r in self.refs[f])]
        out = [self.close(f, "complete", remember) for f in whole]
        held = sum(sum(h.values()) for h in self.have.values())
        while self.have and (over or held > limit):
            out.append(self.close(next(iter(self.have)), "evicted", remember))
            held -= out[-1][3]
        return out


def assemble_stream(members: DataFrame, limit: int = 600 << 20, lanes: int = 64, remember: int = 10_000, patience_ms: int = 0) -> DataFrame:
    """Rows of ``OUTPUT`` as trajectories complete or are given up.

    All lanes together never hold more than ``limit`` bytes of members after a
    batch. A lane remembers its last ``remember`` closed folders, by which late
    members are known; a member that comes later still opens its folder anew.
    With ``patience_ms`` a lane that hears nothing for so long gives up what it
    holds.
    """

    def advance(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        lane = Lane(state.get if state.exists else None)
        over = state.hasTimedOut
        if not over:
            for part in parts:
                for row in zip(part["folder"], part["name"], part["refs"], part["bytes"]):
                    lane.add(*row)
        out = lane.settle(limit // lanes, remember, over)
        state.update(lane.state())
        if patience_ms and not over:
            state.setTimeoutDuration(patience_ms)
        if out:
            yield pd.DataFrame(out, columns=["folder", "status", "members", "bytes"])

    timeout = GroupStateTimeout.ProcessingTimeTimeout if patience_ms else GroupStateTimeout.NoTimeout
    dealt = members.select(F.pmod(F.xxhash64("folder"), F.lit(lanes)).alias("lane"), "folder", "name", "refs", "bytes")
    return dealt.groupBy("lane").applyInPandasWithState(advance, OUTPUT, STATE, "append", timeout)
