"""The best few of many offers, in a task and over all tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldpulse.llm.common import fresh_name

#: Parts that a key's rows are first ranked in, so that no key is one task's group.
PARTS = 64


class Best:
    """For each owner the ``k`` best offers so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, owners: int, k: int, lowest: np.ndarray | int = np.iinfo(np.int64).min):
        self.k = k
        #: What an offer must reach to be among the best; equal scores may win by their id.
        self.floor = np.full(owners, lowest, dtype=np.int64)
        self.owner = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.id = np.empty(0, np.int64)
        self.no_id = np.empty(0, bool)

    def offer(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray | None = None) -> None:
        wanted = score >= self.floor[owner]
        if not wanted.any():
            return
        no_id = np.zeros(len(ids), bool) if no_id is None else no_id
        owner, score, ids, no_id = (
            np.concatenate([held, new[wanted]])
            for held, new in ((self.owner, owner), (self.score, score), (self.id, ids), (self.no_id, no_id))
        )
        # ~score falls as score rises and, unlike -score, has no overflow.
        order = np.lexsort((ids, no_id, ~score, owner))
        owner = owner[order]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        place = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
        kept = order[place < self.k]
        self.owner, self.score, self.id, self.no_id = owner[place < self.k], score[kept], ids[kept], no_id[kept]
        last = place[place < self.k] == self.k - 1
        self.floor[self.owner[last]] = self.score[last]


def best_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str, spread: Column) -> DataFrame:
    """The first ``k`` rows of each key by ``order``, numbered in ``rank`` from 1.

    Rows are first ranked within parts of their key, by ``spread``; what a key's last task
    gets is then bounded by the number of parts, not by the rows.
    """
    part = fresh_name(df, "part")
    cut = df.withColumn(part, F.pmod(F.xxhash64(spread), F.lit(PARTS)))
    within = Window.partitionBy(*keys, part).orderBy(*order)
    first = cut.withColumn(rank, F.row_number().over(within)).where(F.col(rank) <= k).drop(rank, part)
    overall = Window.partitionBy(*keys).orderBy(*order)
    return first.withColumn(rank, F.row_number().over(overall)).where(F.col(rank) <= k)
