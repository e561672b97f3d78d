"""Tokens and their more frequent neighbours: components of tokens, and what each token can be a variant of inside one.

Edges go from a token to every more frequent one that it may be a variant of (equally frequent ones by id); nothing is chosen
here. Ids are unique inside the keys of the edges.
"""

from __future__ import annotations

from collections.abc import Hashable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.runtime import cut

def reaches(ids: list, counts: list[int], ups: list[list]) -> list[frozenset]:
    """For each row its token and all tokens that it can be a variant of: the more frequent neighbours, theirs, and so on.

    A row has the id of its token, its count and the more frequent neighbours of the token.
    """
    total: dict[Hashable, int] = {}
    for i, n in zip(ids, counts):
        total[i] = total.get(i, 0) + n
    near = dict(zip(ids, ups))
    out: dict[Hashable, frozenset] = {}
    for i in sorted(total, key=lambda i: (total[i], i), reverse=True):
        out[i] = frozenset((i,)).union(*(out[u] for u in near[i]))
    return [out[i] for i in ids]


class Classes:
    """Classes of one component, found by token. All members of a class are variants of one token that stays common to them."""

    def __init__(self) -> None:
        self.common: list[frozenset] = []
        self.by_token: dict[Hashable, list[int]] = {}

    def near(self, reach: frozenset) -> list[int]:
        return sorted({h for t in reach for h in self.by_token.get(t, ()) if t in self.common[h]})

    def add(self, reach: frozenset) -> int:
        self.common.append(reach)
        for t in reach:
            self.by_token.setdefault(t, []).append(len(self.common) - 1)
        return len(self.common) - 1

    def join(self, h: int, reach: frozenset) -> None:
        self.common[h] &= reach


def components(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., id, head): the least id of the component of each token that has an edge (keys..., id, up).

    Each round takes the least head of the neighbours, then that head's own head, until nothing changes.
    """
    both = cut(edges.select(*keys, "id", F.col("up").alias("other")).unionByName(edges.select(*keys, F.col("up").alias("id"), F.col("id").alias("other"))))
    now = cut(both.groupBy(*keys, "id").agg(F.least(F.col("id"), F.min("other")).alias("head")))
    while True:
        theirs = both.join(now.select(*keys, F.col("id").alias("other"), F.col("head").alias("there")), [*keys, "other"])
        least = theirs.groupBy(*keys, "id").agg(F.min("there").alias("there"))
        step = now.join(least, [*keys, "id"]).select(*keys, "id", F.col("head").alias("was"), F.least("head", "there").alias("via"))
        on = now.select(*keys, F.col("id").alias("via"), F.col("head").alias("then"))
        new = cut(step.join(on, [*keys, "via"]).select(*keys, "id", "was", F.least("via", "then").alias("head")))
        now = new.drop("was")
        if new.where("head <> was").isEmpty():
            return now
