"""What callers ask of a corpus: search, passage, context, toc, and study packets with evidence.

Each channel of a search is one job over the index; what comes to the driver is its candidate pool, which the candidate limit bounds.
The cascade of channels (strict, details, per compared object, broad, relaxed) and the choice of a handful of results run on pools.
"""

from __future__ import annotations

import time
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import CJK_KEEP, normalize_query
from quire.operators import context as contexts
from quire.operators import evidence, index, packet, query, rank, retrieve
from quire.operators.query import Alias, Rules, Work
from quire.operators.retrieve import Route, Scope

PASSAGE = "id string, work_id string, sequence long, place string, speaker_type string, text string"


@dataclass(frozen=True)
class Limits:
    core: int = 2
    commentary: int = 2
    total: int = 4
    candidates: int = 240


class Corpus:
    """Citable passages (PASSAGE; quarantined ones are not in it) of works, with aliases and query rules."""

    def __init__(self, spark: SparkSession, passages: DataFrame, works: list[Work], aliases: list[Alias] | None = None, rules: Rules | None = None, canons: dict[str, str] | None = None, stored: index.Index | None = None, keep: str = CJK_KEEP):
        self.spark, self.passages, self.works = spark, passages, works
        self.aliases, self.rules, self.keep, self.stored = aliases or [], rules or Rules(), keep, stored
        titles = {w.id: w.title for w in works}
        rows = [(w.id, (canons or {}).get(w.id, ""), w.layer, w.author, titles[w.id], list(w.targets)) for w in works]
        self.work_table = spark.createDataFrame(rows, "id string, canon string, layer string, author string, title string, targets array<string>")
        self.norm = lambda s: query.normalize(s, keep == CJK_KEEP)

    def sets(self) -> DataFrame:
        titled = self.passages.join(self.work_table.select(F.col("id").alias("work_id"), "title", "author"), "work_id")
        return index.gram_sets(titled.select("id", "title", "author", "place", "text"), F.concat("title", "author", F.coalesce("place", F.lit(""))), F.col("text"), self.keep)

    def _ranked(self, terms: list[str], broad: bool, beside: list[str] | None = None) -> DataFrame:
        """(id, rank); beside: terms of which one must match too."""
        if self.stored is not None:
            wanted = index.groups(self.spark, [(0, t) for t in terms] + [(1, t) for t in beside or ()], broad)
            got = index.bm25(self.stored.hits(index.grams_of([*terms, *(beside or ())])), self.stored.totals, wanted)
        else:
            got = index.scan_bm25(self.sets(), [(0, t) for t in terms] + [(1, t) for t in beside or ()], broad)
        need = 2 if beside else 1
        return got.groupBy("id").agg(F.sum("rank").alias("rank"), F.count("*").alias("_n")).where(F.col("_n") == need).drop("_n")

    def pool(self, plan: query.Plan, route: Route, scope: Scope, limits: Limits, broad: bool = False, terms: list[str] | None = None, beside: list[str] | None = None, channel: str = "") -> list[dict]:
        """One channel's scored candidates, best first."""
        own = plan.terms if terms is None else terms
        if not own:
            return []
        got = retrieve.candidates(self._ranked(own, broad, beside), self.passages, self.work_table, route, scope, limits.total, limits.candidates)
        got = got.withColumn("place", F.concat("title", F.coalesce("place", F.lit(""))))
        out = rank.scored(got, plan.terms, plan.intent.mode, tuple(plan.preferred), tuple(plan.quoted), tuple(plan.focus), tuple(plan.topics), self.keep)
        rows = [r.asDict(recursive=True) | {"channel": channel} for r in rank.in_order(out).collect()]
        main = bool(plan.expansions and plan.terms and plan.intent.mode != "compare" and not plan.focus)
        for r in rows:
            r["matched_terms"] = [d["term"] for d in r["details"] if d["exact_body"]]
            r["n_quoted"], r["n_focus"] = len(r["quoted_matches"]), len(r["focus_matches"])
            if main and not any(d["term"] == plan.terms[0] and (d["exact_body"] or d["exact_place"]) for d in r["details"]):
                r["useful"], r["reason"] = False, "main-phrase-not-supported"
        return rows

    def _enough(self, rows: list[dict], plan: query.Plan, route: Route, scoped: bool = True) -> bool:
        if scoped and route.target_works and not (route.work_ids or route.title_work_ids):
            core = {f"core-{t}" for t in route.target_works}
            rows = [r for r in rows if r["work_id"] in core]
        good = [r for r in rows if r["useful"] and r["tier"] in "AB" and r["speaker_type"] != "quoted_core"]
        if good and plan.expansions and plan.terms and plan.intent.mode != "compare" and not plan.focus:
            return any(d["term"] == plan.terms[0] and (d["exact_body"] or d["exact_place"]) for r in rows if r["useful"] and r["speaker_type"] != "quoted_core" for d in r["details"])
        return bool(good)

    def _supported(self, fragment: str) -> bool:
        ids = index.top(self._ranked([fragment], False), 40)
        body = normalize_query(F.col("text"), self.keep)
        return not ids.join(self.passages, "id").where(F.contains(body, F.lit(fragment))).isEmpty()

    def plan(self, text: str, terms: str | None = None, author: str | None = None) -> tuple[Route, query.Plan]:
        route = query.infer_route(text, self.aliases, self.works, self.rules, self.norm)
        if author:
            own = query.infer_route(author, self.aliases, self.works, self.rules, self.norm)
            route = replace(route, work_ids=own.work_ids, author_groups=own.author_groups)
        plan = query.build_plan(text, route, self.aliases, self.rules, terms, self._supported, self.norm)
        compare = plan.intent.mode == "compare" and bool(route.title_work_ids and route.target_works) and not route.author_groups
        return replace(route, compare_sources=compare), plan

    @staticmethod
    def _channels(plan: query.Plan, route: Route, groups: list[dict]) -> list[tuple[Route, dict]]:
        """What is asked of the index within the route, in order: all terms, each detail by itself, each object of a comparison."""
        details = dict.fromkeys(x for x in [*plan.quoted, *plan.focus] if len(x) >= 2)
        objects = groups if len(groups) > 1 else []
        return [
            (route, {"channel": "all-bigrams"}),
            *((route, {"terms": [t], "beside": plan.topics if plan.focus else None, "channel": "query-detail"}) for t in details),
            *((replace(route, work_ids=tuple(g["work_ids"])), {"channel": "comparison-object"}) if g.get("work_ids") else (route, {"terms": [g["term"]], "channel": "comparison-object"}) for g in objects),
        ]

    @staticmethod
    def _gather(rows: dict[str, dict], more: list[dict]) -> None:
        """What earlier channels found stays as they found it."""
        for r in more:
            rows.setdefault(r["id"], r)

    def _widen(self, rows: dict[str, dict], plan: query.Plan, route: Route, scope: Scope, limits: Limits, scoped: bool = True) -> bool:
        """Asks for any bigram of the terms where what was found doesn't suffice; whether it did."""
        if not plan.terms or self._enough(list(rows.values()), plan, route, scoped):
            return False
        self._gather(rows, self.pool(plan, route, scope, limits, True, channel="broad-bigrams"))
        return True

    def search(self, text: str, terms: str | None = None, canon: str = "auto", work: str = "auto", layers: str = "all", author: str | None = None, limits: Limits | None = None, route_fallback: bool = True) -> dict:
        """The cascade; a dict of the query's plan and route, results, alternatives, coverage, omissions and what to clarify."""
        began, limits = time.perf_counter(), limits or Limits()
        route, plan = self.plan(text, terms, author)
        own = () if layers == "all" else tuple(x.strip() for x in layers.split(",") if x.strip())
        if not own and any(c in self.norm(text) for c in ("只看原典", "仅看原典", "只查原典")):
            own = ("core",)
        scope = Scope(canon, work, own, author, route.work_ids if author else ())
        groups = query.comparison_groups(route, plan, self.works)
        rows: dict[str, dict] = {}
        for at, asked in self._channels(plan, route, groups):
            self._gather(rows, self.pool(plan, at, scope, limits, **asked))
        broad = self._widen(rows, plan, route, scope, limits)
        rows = list(rows.values())
        enough = self._enough(rows, plan, route)

        alternatives, promoted = [], False
        explicit = canon != "auto" or work != "auto" or bool(author)
        if route_fallback and not explicit and not route.hard_scope and route.scoped and not enough:
            relaxed, wide, other = route.relaxed(), Scope(layers=own), {}
            self._gather(other, self.pool(plan, relaxed, wide, limits, channel="all-bigrams"))
            broad |= self._widen(other, plan, relaxed, wide, limits, False)
            if self._enough(list(other.values()), plan, relaxed, False):
                inside = {r["id"] for r in rows}
                alternatives = [r for r in other.values() if r["id"] not in inside]
                promoted = plan.intent.source_lookup and plan.intent.mode != "compare" and self._enough(alternatives, plan, relaxed, False)
        shown = alternatives if promoted else rows
        scoped = bool(route.author_groups or route.title_work_ids) and not promoted
        chosen, omitted = rank.choose(shown, [] if promoted else groups, limits.total, limits.core, limits.commentary, scoped or bool(author))
        beside = [] if promoted else rank.choose(alternatives, [], limits.total, limits.core, limits.commentary, bool(author))[0][:2]
        report = rank.coverage_report(groups, rows, [] if promoted else chosen)
        if plan.intent.scope_too_broad and chosen:
            chosen = [next((r for r in chosen if r["layer"] == "core"), chosen[0])]
            omitted["broad_scope_not_displayed"] = max(0, len(shown) - 1)
        return {
            "query": text, "terms": plan.terms, "query_plan": asdict(plan), "route": asdict(route),
            "route_resolution": {"mode": "relaxed-fallback" if promoted else "strict", "alternatives_available": bool(beside), "hard_scope": route.hard_scope or explicit},
            "needs_clarification": self._clarify(rows, shown, chosen, beside, enough, report, plan),
            "omitted_candidates": dict(omitted), "scope_coverage": report, "fts_fallback_used": broad,
            "results": self._decorated(chosen, plan), "alternative_results": self._decorated(beside, plan), "elapsed_ms": round((time.perf_counter() - began) * 1000, 3),
        }

    @staticmethod
    def _clarify(rows: list[dict], shown: list[dict], chosen: list[dict], beside: list[dict], enough: bool, report: list[dict], plan: query.Plan) -> dict:
        lacking = [g["label"] for g in report if g["status"] != "matched"]
        own = lambda r: r["speaker_type"] == "quoted_core"
        if not chosen:
            reason = "selection-limited" if any(r["useful"] and not own(r) for r in shown) else "quoted-core-only" if any(r["useful"] and own(r) for r in rows) else "no-direct-match"
        elif beside and not enough:
            reason = "source-not-supported"
        elif lacking and len(report) > 1:
            reason = "incomplete-comparison"
        else:
            reason = "scope-too-broad" if plan.intent.scope_too_broad else ""
        return {"required": bool(reason), "reason": reason, "lacking": lacking}

    def _decorated(self, rows: list[dict], plan: query.Plan) -> list[dict]:
        """Quotes with their place in the text, and neighbours."""
        if not rows:
            return []
        near = self.passages.join(self.work_table.select(F.col("id").alias("work_id")).where(F.col("id").isin(*{r["work_id"] for r in rows})), "work_id", "left_semi").select("id", "work_id", "sequence")
        links = {r.id: r for r in contexts.neighbours(near, "work_id", "sequence", "id").where(F.col("id").isin(*[r["id"] for r in rows])).collect()}
        out = []
        for r in rows:
            term = (r["quoted_matches"] or r["focus_matches"] or [r["best"]["term"]])[0]
            a, b = rank.excerpt(r["text"], term, tuple(plan.topics) if plan.focus and not plan.quoted else ())
            match = {k: r[k] for k in ("tier", "matched_terms", "quoted_matches", "focus_matches", "channel")} | {"coverage": round(r["best"]["coverage"], 4), "exact_phrase": r["best"]["exact_body"]}
            keep = {k: r[k] for k in ("id", "work_id", "sequence", "title", "author", "layer", "place", "speaker_type", "text")}
            n = links[r["id"]]
            out.append(keep | {"score": round(r["score"], 6), "match": match, "quote": r["text"][a:b], "quote_start": a, "quote_end": b, "previous_id": n.previous_id, "next_id": n.next_id})
        return out

    def passage(self, passage_id: str) -> dict:
        row = self.passages.where(F.col("id") == passage_id).join(self.work_table.withColumnRenamed("id", "work_id"), "work_id").first()
        return row.asDict(recursive=True) if row else {"error": "passage-not-found", "id": passage_id}

    def context(self, passage_id: str, before: int = 1, after: int = 1) -> dict:
        at = self.passages.where(F.col("id") == passage_id).select("work_id", "sequence")
        if at.isEmpty():
            return {"error": "passage-not-found", "id": passage_id, "results": []}
        rows = contexts.context(self.passages, at, "work_id", "sequence", before, after).orderBy("sequence").drop("anchor")
        return {"id": passage_id, "results": [r.asDict(recursive=True) for r in rows.join(self.work_table.withColumnRenamed("id", "work_id"), "work_id").orderBy("sequence").collect()]}

    def toc(self, work: str) -> list[dict]:
        """Entries of a work by code or full id; a code stands for the core work of that name."""
        code = retrieve.WORK_CODES.get(work, work)
        ids = [code] if code in {w.id for w in self.works} else [f"core-{code}"]
        return [r.asDict() for r in contexts.toc(self.passages.where(F.col("work_id").isin(*ids)), ["place"], "sequence").collect()]


class Evidence:
    """Topics, aliases, records, their topics and the source registry."""

    def __init__(self, topics: DataFrame, aliases: DataFrame, records: DataFrame, bridge: DataFrame, registry: DataFrame):
        self.topics, self.aliases, self.records, self.bridge, self.registry = topics, aliases, records, bridge, registry

    def classify(self, text: str) -> dict:
        """L1 to L5 of one question."""
        one = self._level(text).first().asDict(recursive=True)
        return one | {"level_label_zh": evidence.LABELS[one["level"]]}

    def _level(self, text: str) -> DataFrame:
        return evidence.classify(self.topics.sparkSession.createDataFrame([(0, text)], "query_id long, text string"), self.topics, self.aliases)

    def assess(self, text: str, as_of: str, topics: str | None = None, include_stale: bool = False) -> dict:
        """classify, lookup and the plan of an online search, for one question."""
        spark, level = self.topics.sparkSession, self._level(text)
        one = level.first().asDict(recursive=True)
        ids = list(dict.fromkeys(x.strip() for x in topics.split(",") if x.strip())) if topics else [x["id"] for x in one["topics"] or ()]
        wanted = spark.createDataFrame([(0, i) for i in ids], "query_id long, topic_id string")
        every = evidence.lookup(wanted, self.records, self.bridge, F.lit(as_of).cast("date"), True)
        need = evidence.needs_online(level, wanted, every, include_stale)
        needed = need.first().asDict()
        rows = [r.asDict(recursive=True) for r in evidence.in_order(every).collect()]
        for r in rows:
            r["labels"] = {k: evidence.DISPLAY[r[k]] for k in ("conclusion_direction", "directness", "evidence_type", "confidence") if r.get(k) in evidence.DISPLAY}
        shown = [r for r in rows if include_stale or r["fresh"]]
        plan = {"required": False, "must_not_delay_safety_message": False, "queries": [], "instructions": evidence.NO_SEARCH}
        if one["modern_layer_required"]:
            covered = spark.createDataFrame([(0, t) for r in shown for t in r["topics"]], "query_id long, topic_id string")
            queries = evidence.online_plan(evidence.planned_topics(level, self._terms(), covered, need)).orderBy("place").collect()
            plan = {
                "required": needed["needs_online"], "must_not_delay_safety_message": one["level"] == "M3", "queries": [{k: q[k] for k in ("language", "query", "priority")} for q in queries],
                "preferred_source_order": evidence.SOURCE_ORDER, "instructions": evidence.INSTRUCTIONS,
            }
        return {"classification": one | {"level_label_zh": evidence.LABELS[one["level"]]}, "topic_ids": ids, "records": shown, "lookup": needed, "online_search_plan": plan}

    def _terms(self) -> DataFrame:
        """Topics with what they are searched by; a topic without terms or title by its id."""
        has = set(self.topics.columns)
        words = lambda c: F.col(c) if c in has else F.array().cast("array<string>")
        return self.topics.select("id", (F.coalesce("title_zh", "id") if "title_zh" in has else F.col("id")).alias("title_zh"), *[words(c).alias(c) for c in ("search_terms_zh", "search_terms_en")])

    def lookup(self, text: str, as_of: str, topics: str | None = None, include_stale: bool = False) -> dict:
        got = self.assess(text, as_of, topics, include_stale)
        return {k: got[k] for k in ("topic_ids", "records", "lookup")}

    def plan(self, text: str, as_of: str, topics: str | None = None, include_stale: bool = False) -> dict:
        return self.assess(text, as_of, topics, include_stale)["online_search_plan"]

    def source_check(self, url: str) -> dict:
        got = evidence.approved(self.topics.sparkSession.createDataFrame([(url,)], "url string"), self.registry).first()
        return {"url": url, "approved": got.source_id is not None, "source_id": got.source_id}

    def status(self, as_of: str) -> dict:
        return evidence.status(self.records, F.lit(as_of).cast("date")).first().asDict()


def study(corpus: Corpus, known: Evidence, text: str, as_of: str, budget: int = packet.BUDGET, anchor_id: str | None = None, before: int = 1, after: int = 1, classics_after_safety: bool = False, topics: str | None = None, include_stale: bool = False, compact: bool = False, **options) -> dict:
    """A packet: evidence first; in an emergency no passages unless asked for; then search or anchored context, within the budget.

    compact: passages that have a quote come without their whole text.
    """
    packet.checked_budget(budget)
    found = known.assess(text, as_of, topics, include_stale)
    urgent = found["classification"]["level"] == "M3"
    got: dict = {"results": [], "alternative_results": [], "scope_coverage": [], "needs_clarification": {"required": False, "reason": "", "lacking": []}}
    if not urgent or classics_after_safety:
        got = got | (corpus.context(anchor_id, before, after) if anchor_id else corpus.search(text, **options))
        if got.get("error"):
            got["needs_clarification"] = {"required": True, "reason": "anchor-not-found", "lacking": []}
    rows = list(got["results"])
    anchor = next((r for r in rows if r["id"] == anchor_id), None)
    if anchor:
        rows.sort(key=lambda r: (r["id"] != anchor_id, abs(r["sequence"] - anchor["sequence"])))
    over = bool(anchor) and len(anchor["text"]) > budget

    def fit(items: list[dict], room: int) -> tuple[list[dict], int]:
        out, used = [], 0
        for r in items:
            if used + len(r["text"]) <= room:
                out.append(r)
                used += len(r["text"])
        return out, used

    chosen, used = fit([] if over else rows, budget)
    beside, extra = fit(got["alternative_results"], budget - used)
    for g in got["scope_coverage"]:
        if g["status"] == "matched" and not any(rank.belongs(r | {"matched_terms": r.get("match", {}).get("matched_terms", [])}, g) for r in chosen):
            g["status"] = "not-displayed-budget"
    lacking = [g["label"] for g in got["scope_coverage"] if g["status"] != "matched"]
    if over or (rows and not chosen):
        got["needs_clarification"] = {"required": True, "reason": "anchor-over-budget" if over else "budget-excluded", "lacking": []}
    elif lacking and len(got["scope_coverage"]) > 1:
        got["needs_clarification"] = {"required": True, "reason": "incomplete-comparison", "lacking": lacking}
    if anchor_id:
        chosen.sort(key=lambda r: r["sequence"])
    shown = {r["id"] for r in [*chosen, *beside]}
    left_out = [{"id": r["id"], "characters": len(r["text"])} for r in [*rows, *got["alternative_results"]] if r["id"] not in shown]
    if compact:
        chosen, beside = ([{k: v for k, v in r.items() if k != "text" or not r.get("quote")} for r in part] for part in (chosen, beside))
    return {
        "schema_version": 2, "query": text, "evidence": found, "safety_first": urgent, "safety_message": found["classification"]["safety_message"] or "",
        "classics_deferred": urgent and not classics_after_safety, "anchor_id": anchor_id or "",
        "core": [r for r in chosen if r["layer"] == "core"], "extension": [r for r in chosen if r["layer"] != "core"], "alternatives": beside,
        "character_budget": budget, "characters_used": used + extra, "budget_omitted": [x["id"] for x in left_out], "budget_omitted_sizes": left_out,
        "scope_coverage": got["scope_coverage"], "needs_clarification": got["needs_clarification"], "state_storage": "none",
    }
