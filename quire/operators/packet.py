"""Budgeted packets, and their rendering."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 2500
BUDGET_RANGE = (500, 10_000)


def checked_budget(budget: int) -> int:
    if not BUDGET_RANGE[0] <= budget <= BUDGET_RANGE[1]:
        raise ValueError("the budget must be from 500 to 10000")
    return budget


def fit_budget(items: Column, size, budget: int | Column) -> Column:
    """The items of an array that fit in order; one that does not fit is skipped and later ones are still tried. struct<used, kept>."""
    budget = F.lit(budget).cast("long") if isinstance(budget, int) else budget.cast("long")
    start = F.struct(F.lit(0).cast("long").alias("used"), F.filter(items, lambda _: F.lit(False)).alias("kept"))
    step = lambda acc, x: F.when(acc["used"] + size(x) <= budget, F.struct((acc["used"] + size(x)).cast("long").alias("used"), F.concat(acc["kept"], F.array(x)).alias("kept"))).otherwise(acc)
    return F.aggregate(items, start, step)


def packets(results: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Results (query, place, id, layer, channel, text, anchor boolean) to one row for each query.

    The anchor comes first; an anchor beyond the budget leaves nothing. Alternatives (channel 'alternative') use what the results leave.
    """
    checked_budget(budget)
    item = F.struct((~F.coalesce("anchor", F.lit(False))).cast("int").alias("later"), "place", "id", "layer", F.length("text").alias("size"), "anchor")
    per = results.groupBy("query").agg(
        F.array_sort(F.collect_list(F.when(F.col("channel") != "alternative", item))).alias("main"), F.array_sort(F.collect_list(F.when(F.col("channel") == "alternative", item))).alias("other")
    )
    over = F.exists("main", lambda x: F.coalesce(x["anchor"], F.lit(False)) & (x["size"] > budget))
    size = lambda x: x["size"].cast("long")
    per = per.withColumn("fit", fit_budget(F.when(over, F.slice("main", 1, 0)).otherwise(F.col("main")), size, budget))
    per = per.withColumn("more", fit_budget(F.when(over, F.slice("other", 1, 0)).otherwise(F.col("other")), size, F.lit(budget) - F.col("fit.used")))
    ids = lambda c, keep=None: F.transform(F.filter(c, keep) if keep else c, lambda x: x["id"])
    return per.select(
        "query",
        ids(F.col("fit.kept"), lambda x: x["layer"] == "core").alias("core"),
        ids(F.col("fit.kept"), lambda x: x["layer"] != "core").alias("extension"),
        ids(F.col("more.kept")).alias("alternatives"),
        (F.col("fit.used") + F.col("more.used")).alias("used"),
        (F.size("main") + F.size("other") - F.size("fit.kept") - F.size("more.kept")).cast("long").alias("left_out"),
        F.when(over, "anchor-over-budget").when((F.size("main") > 0) & (F.size("fit.kept") == 0), "budget-excluded").otherwise("").alias("clarification"),
    )


# Headings and notices of a rendered packet.
TITLE = "中医经典研读"
NOTICES = {
    "M2": "以下将古籍记载与现代疗效或安全证据严格分开；内容用于研读，不构成个体诊疗或用药建议。",
    "M1": "古典理论与现代医学概念通常不能直接等同；以下先列工作底本文献，再说明可核验的对应边界。",
    "M0": "以下为本次检得的材料预览，不是已完成的白话研读；主旨、逐句解释和关键词由宿主依据引文另行组织。",
}
HEADINGS = {"safety": "⚠️ 先看安全提醒", "clarify": "范围提示", "notice": "材料预览说明", "core": "🟩 A｜原典", "extension": "🟧 B｜历代医家", "alternatives": "范围外备选｜不代表指定医家的观点", "omitted": "已检得但因预算未展示", "modern": "🟦 C｜现代医学", "more": "继续研读", "limits": "使用边界"}
DEFERRED = "急症风险问题已暂缓古籍检索；处理现实安全后，才可另作纯文献研读。"
NOTHING = "本次没有可展示的指定范围材料，请补充范围或原句。"
QUOTED_CORE = "注书转引经文，不作为医家的独立观点。"
ROLES = {"before": "上文", "anchor": "本段", "after": "下文"}
NO_RECORDS = "当前没有可直接引用的有效缓存。若联网失败，本次不提供未经核验的现代疗效结论。"
SEARCH_ONLINE = "当前缓存缺失、覆盖不完整、已过期，或用户要求最新资料；需按检索计划读取完整来源页面。"
LIMITS = ("本产品使用可追溯的工作底本，不声称是无异文、无错误的唯一权威文本。", "隔离内容不会进入搜索或引文。", "不提供个体诊断、处方、剂量换算、停换药或以古方替代急救的建议。")
CLARIFY = {
    "no-direct-match": "没有检得直接支持的段落。", "quoted-core-only": "只检得注书转引的经文。", "selection-limited": "检得的段落超出展示限制。", "source-not-supported": "指定范围内没有直接支持，另列范围外备选。",
    "incomplete-comparison": "比较对象没有全部检得。", "scope-too-broad": "问题范围较大，请指定著作或医家。", "anchor-not-found": "没有这个段落。", "anchor-over-budget": "本段超出字符预算。", "budget-excluded": "检得的段落都超出字符预算。",
}


def inline(value) -> str:
    return " ".join(str(value or "").replace("\0", "").split())


def passage_facts(item: dict) -> list[tuple[str, str]]:
    """What is told of a passage beside its quote: (label, value), without empty values."""
    place = " · ".join(x for x in (inline(item.get(k)) for k in ("title", "volume", "section", "subsection", "place")) if x)
    facts = [
        ("上下文位置", ROLES.get(item.get("context_role", ""), "")), ("材料性质", QUOTED_CORE if item.get("speaker_type") == "quoted_core" else ""), ("作者/题署", inline(item.get("author"))),
        ("本段说话者", inline(item.get("speaker"))), ("出处", place), ("段落ID", item.get("id", "")),
    ]
    return [(k, v) for k, v in facts if v]


def outline(packet: dict) -> list[tuple[str, list[tuple]]]:
    """A packet as sections, (kind, parts) in reading order, which both formats write. A part is ("text", words),
    ("quote", heading, quote, facts, url), or ("list", items)."""
    found, level = packet["evidence"], packet["evidence"]["classification"]["level"]
    quote = lambda r: ("quote", inline(r.get("title")), r.get("quote") or r.get("text", ""), passage_facts(r), r.get("url", ""))
    out: list[tuple[str, list[tuple]]] = []
    if packet["safety_first"]:
        out.append(("safety", [("text", packet["safety_message"])]))
    asked = packet["needs_clarification"]
    if asked["required"]:
        lacking = "、".join(asked.get("lacking") or [])
        out.append(("clarify", [("text", CLARIFY.get(asked["reason"], asked["reason"]) + (f"（{lacking}）" if lacking else ""))]))
    out.append(("notice", [("text", packet["safety_message"] if level == "M3" else NOTICES[level])]))
    if packet["core"]:
        out.append(("core", [quote(r) for r in packet["core"]]))
    elif packet.get("classics_deferred"):
        out.append(("core", [("text", DEFERRED)]))
    elif not packet["extension"] and not asked["required"]:
        out.append(("core", [("text", NOTHING)]))
    out += [(kind, [quote(r) for r in packet[kind]]) for kind in ("extension", "alternatives") if packet[kind]]
    if packet.get("budget_omitted_sizes"):
        out.append(("omitted", [("list", [f"{x['id']}（{x['characters']}字）" for x in packet["budget_omitted_sizes"]])]))
    if level != "M0":
        parts: list[tuple] = []
        for r in found["records"]:
            labels = r.get("labels", {})
            facts = [("对应直接性", labels.get("directness", "")), ("证据类型", labels.get("evidence_type", "")), ("可信度", labels.get("confidence", "")), ("主要限制", inline(r.get("limitations_zh"))), ("缓存有效至", inline(r.get("expires_at")))]
            parts.append(("quote", labels.get("conclusion_direction", r["id"]), inline(r.get("summary_zh") or r["id"]), [x for x in facts if x[1]], r.get("url", "")))
        if found["online_search_plan"]["required"]:
            parts.append(("text", SEARCH_ONLINE))
        out.append(("modern", parts if found["records"] else [*parts, ("text", NO_RECORDS)]))
    if packet.get("anchor_id"):
        out.append(("more", [("text", f"如需全文或前后文，可继续追问并使用本次主段落ID：{packet['anchor_id']}")]))
    return [*out, ("limits", [("list", list(LIMITS))])]


def markdown(packet: dict) -> str:
    """L15 as Markdown."""
    out = [f"# {TITLE}", "", f"**问题：** {inline(packet['query'])}", ""]
    for kind, parts in outline(packet):
        out += [f"## {HEADINGS[kind]}", ""]
        for what, *part in parts:
            if what == "text":
                out += [f"**{inline(part[0])}**" if kind == "safety" else inline(part[0]), ""]
            elif what == "list":
                out += [*(f"- {inline(x)}" for x in part[0]), ""]
            else:
                heading, quote, facts, url = part
                out += [f"### {heading}", "", *(f"> {line}" for line in quote.splitlines() if line.strip()), "", *(f"**{k}：** {v}  " for k, v in facts), *([f"[{url}]({url})"] if url else []), ""]
    return "\n".join(out).rstrip() + "\n"


STYLE = "body{max-width:900px;margin:auto;padding:24px;font:18px/1.7 sans-serif}section{border:2px solid #345;padding:16px;margin:16px 0}.safety{border-color:#a11}.core{border-color:#171}.extension{border-color:#940}.modern{border-color:#159}blockquote{border-left:5px solid #345;margin:12px 0;padding:8px 16px}"


def markup(packet: dict) -> str:
    """L15 as HTML; all values are escaped."""
    e = lambda s: html.escape(str(s), quote=True)

    def shown(what: str, *part) -> str:
        if what == "text":
            return f"<p>{e(inline(part[0]))}</p>"
        if what == "list":
            return "<ul>" + "".join(f"<li>{e(inline(x))}</li>" for x in part[0]) + "</ul>"
        heading, quote, facts, url = part
        rows = "".join(f"<dt>{e(k)}</dt><dd>{e(v)}</dd>" for k, v in facts)
        return f"<article><h3>{e(heading)}</h3><blockquote>{e(quote)}</blockquote><dl>{rows}</dl>" + (f'<a href="{e(url)}">{e(url)}</a>' if url else "") + "</article>"

    body = "".join(f'<section class="{kind}"><h2>{e(HEADINGS[kind])}</h2>' + "".join(shown(*p) for p in parts) + "</section>" for kind, parts in outline(packet))
    return f'<!doctype html><html lang="zh-CN"><head><meta charset="utf-8"><title>{TITLE}</title><style>{STYLE}</style></head><body><h1>{TITLE}</h1><p>{e(inline(packet["query"]))}</p>{body}</body></html>'


def rendered(packet: dict, form: str = "markdown") -> str:
    return {"markdown": markdown, "html": markup}[form](packet)
