"""Scope, candidates and their union: filters stand before the limit, and statistics before the filters."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Codes under which works are asked for.
WORK_CODES = {
    "suwen": "suwen", "lingshu": "lingshu", "shanghanlun": "shanghanlun", "jingui": "jingui", "nanjing": "nanjing", "wenbingtiaobian": "wenbingtiaobian",
    "素问": "suwen", "灵枢": "lingshu", "伤寒论": "shanghanlun", "金匮要略": "jingui", "难经": "nanjing", "温病条辨": "wenbingtiaobian",
}


@dataclass(frozen=True)
class Route:
    """What a question says about where to look."""

    target_works: tuple = ()
    canons: tuple = ()
    work_ids: tuple = ()
    title_work_ids: tuple = ()
    excluded_work_ids: tuple = ()
    author_groups: tuple = ()  # (label, (work ids))
    matched_aliases: tuple = ()
    hard_scope: bool = False
    compare_sources: bool = False

    @property
    def scoped(self) -> bool:
        return bool(self.target_works or self.canons or self.work_ids or self.title_work_ids)

    def relaxed(self) -> Route:
        """No scope, but exclusions stay."""
        return replace(self, target_works=(), canons=(), work_ids=(), title_work_ids=(), author_groups=())


@dataclass(frozen=True)
class Scope:
    """Explicit restrictions of a search."""

    canon: str = "auto"
    work: str = "auto"
    layers: tuple = ()
    author: str | None = None
    author_work_ids: tuple = field(default=())


def work_filter(route: Route, scope: Scope, columns: dict[str, str] | None = None) -> Column:
    """J2 to J8 as one predicate over works (id, canon, layer, author, targets array)."""
    c = {k: F.col((columns or {}).get(k, k)) for k in ("id", "canon", "layer", "author", "targets")}
    out: list[Column] = []
    if scope.canon != "auto":
        out.append(c["canon"] == scope.canon)
    elif route.canons:
        out.append(c["canon"].isin(*route.canons))
    code = WORK_CODES.get(scope.work, scope.work) if scope.work != "auto" else None
    targets = list(route.target_works)
    if code and code.startswith(("core-", "commentary-", "lineage-")):
        out.append(c["id"] == code)
        targets = []
    elif code:
        targets = [code]
    union = route.compare_sources and scope.work == "auto"
    if union:
        ids = [*route.title_work_ids, *(f"core-{t}" for t in targets)]
        if ids:
            out.append(c["id"].isin(*ids))
        targets = []
    if targets:
        out.append(F.arrays_overlap(c["targets"], F.array(*map(F.lit, targets))))
    if route.work_ids:
        out.append(c["id"].isin(*route.work_ids))
    if route.title_work_ids and not union:
        out.append(c["id"].isin(*route.title_work_ids))
    if route.excluded_work_ids:
        out.append(~c["id"].isin(*route.excluded_work_ids))
    if scope.layers:
        out.append(c["layer"].isin(*scope.layers))
    if scope.author:
        out.append(c["id"].isin(*scope.author_work_ids) if scope.author_work_ids else F.contains(c["author"], F.lit(scope.author)))
    return reduce(lambda a, b: a & b, out, F.lit(True))


def candidates(ranked: DataFrame, passages: DataFrame, works: DataFrame, route: Route, scope: Scope, limit_total: int = 4, candidate_limit: int = 240) -> DataFrame:
    """Ranked (id, rank) joined to passages (id, work_id, ...) and works, filtered by scope, best first."""
    k = max(candidate_limit, 20 * limit_total)
    inside = works.where(work_filter(route, scope)).withColumnRenamed("id", "work_id")
    return ranked.join(passages, "id").join(inside, "work_id").orderBy("rank", "id").limit(k)


def merged(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Left, and what right has besides."""
    return left.unionByName(right.join(left.select(key), key, "left_anti"))
