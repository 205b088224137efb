"""Wiki markup to blocks.

Template expansion is a fixpoint with dispatch by name and the walk over tokens keeps a stack, so both are vectorized Python
functions over whole pages; headings are then carried forward by window functions, across the pages of a source.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import CJK, nfc, plain_text, wiki_text

OPEN, CLOSE = "⟦", "⟧"
ROUNDS = 20
INNER = re.compile(r"\{\{([^{}]*)\}\}", re.S)
# Templates without text, templates that are anchors, annotations.
STRUCTURAL = {
    "header", "header2", "textquality", "skqs header", "skqs footer", "pd-old", "vtext2start", "未校訂", "未校订", "未排版", "split", "傳統漢字化", "传统汉字化", "傳統漢字",
    "传统汉字", "noteta", "wikipedia", "檢索", "检索", "醫療", "医疗", "中醫", "中医", "wjd", "s2t", "傷寒論注", "伤寒论注", "難經注", "难经注",
}
ANCHORS = {"sk anchor", "anchor"}
AUTHOR_NOTES = {"sk notes", "sk note"}
PLAIN = {"pua", "yl"}
# Who speaks, where, and under which name.
SPEAKERS = "黃帝|黄帝|帝|岐伯|歧伯|伯高|雷公|少俞|少師|少师|問|问|答|師|师|新校正|丁|呂|吕|楊|杨|虞|滑|馬|马|張|张|志|柯|方|喻|尤|徐|成|王|高|簡案|简案"
SPEAKER_AT = rf"(?:^|(?<=[。！？；：「”』]))(?=(?:{SPEAKERS})(?:氏)?(?:問|问|對|对|答)?(?:曰|云|按)[：:]?)"
SPEAKER_NAMES = {
    "帝": "黄帝", "黃帝": "黄帝", "歧伯": "岐伯", "問": "问者", "问": "问者", "答": "答者", "師": "师", "简案": "丹波元简", "簡案": "丹波元简", "志": "张志聪", "馬": "马莳", "马": "马莳",
    "張": "张介宾/张氏", "张": "张介宾/张氏", "呂": "吕广", "吕": "吕广", "楊": "杨玄操", "杨": "杨玄操", "丁": "丁德用", "虞": "虞庶", "滑": "滑寿",
}
# Works with rules of their own.
DEFAULT_SPEAKERS = {"commentary-suwen-wangbing": "经文", "commentary-neijing-leijing": "经文辑录", "commentary-jingui-xubin": "张仲景原文"}
PARENTHESES_ARE_NOTES = ("commentary-suwen-zhangzhicong", "commentary-lingshu-zhangzhicong")
LINES_ARE_PARAGRAPHS = ("commentary-neijing-leijing", "commentary-shanghan-yuchang", "commentary-jingui-xubin")
TEXT_AND_NOTE = "commentary-jingui-xubin"
QUOTES_ORIGINALS = "commentary-nanjing-jizhu"
# Lines of metadata, lines that end a quote, headings as they are printed.
METADATA = "书名|書名|作者|朝代|年份"
NUMBER = "[〇零一二三四五六七八九十百千0-9]+"
COMMENTARY_LINE = "按[、，,:：。]|案[、，,:：。]|[注註释釋解]曰|[论論]曰|[丁呂吕楊杨虞滑馬马張张王志柯方喻尤徐成高]氏?[曰云]|簡案|简案|《[^》]{1,30}》[曰云]"
LINE_KINDS = [
    ("heading", re.compile(r"(?P<marks>={2,6})\s*(?P<title>.*?)\s*(?P=marks)")),
    ("3", re.compile(r"<篇名>\s*(?P<title>.*)")),
    ("2", re.compile(r"<目[录錄]>\s*(?P<title>.*)")),
    ("4", re.compile(r":+;\s*(?P<title>.*)")),
    ("metadata", re.compile(rf"(?:{METADATA})\s*[：:].*")),
    ("quote", re.compile(r"属性\s*[：:]\s*(?P<title>.*)")),
    ("printed", re.compile(rf"(?=.{{1,42}}$)(?P<title>.*(?:篇第{NUMBER}|第{NUMBER}篇))")),
    ("commentary", re.compile(rf"(?:{COMMENTARY_LINE}).*")),
]


@dataclass
class Glyphs:
    """Characters by template (skchar, skchar2) and code, or by code alone for both; literal repairs (source, sequence, replacement)."""

    codes: dict = field(default_factory=dict)
    repairs: list = field(default_factory=list)

    def repaired(self, text: str, source: str) -> str:
        for own, sequence, replacement in self.repairs:
            if own == source:
                text = text.replace(sequence, replacement)
        return text

    def of(self, template: str, code: str) -> str | None:
        return self.codes.get((template, code)) or self.codes.get(code)


def template_name(body: str) -> str:
    return re.sub(r"\s+", " ", body.partition("|")[0].replace("_", " ")).strip().lower()


def arguments(body: str) -> list[str]:
    """Positional arguments that show: neither empty nor named."""
    return [a.strip() for a in body.split("|")[1:] if a.strip() and "=" not in a]


def short_name(author: str) -> str:
    """An author without what stands in full-width parentheses."""
    return author.partition("（")[0]


def note(text: str, speaker: str, kind: str = "commentary") -> str:
    return f"{OPEN}N:{speaker}:{kind}{CLOSE}{text}{OPEN}/N{CLOSE}" if text else ""


def expand(body: str, glyphs: Glyphs, seen: Counter, author: str = "") -> str:
    """C4a to C4e: what a template without inner templates becomes; seen counts what was met and what stayed unresolved."""
    name, args = template_name(body), arguments(body)
    shown = "".join(args)
    seen[f"template:{name}"] += 1
    if name in STRUCTURAL:
        seen["structural"] += 1
        return ""
    if name in ("skchar", "skchar2"):
        code = next((a.strip() for a in body.split("|")[1:]), "")
        found = glyphs.of(name, code)
        seen["glyph" if found else f"unresolved:{name}"] += 1
        return found or f"〔未识别字{code or '?'}〕"
    if name in ANCHORS:
        return f"\n{OPEN}H:3:{shown}{CLOSE}\n" if shown else ""
    if name in AUTHOR_NOTES:
        return note(shown, short_name(author))
    if name == "雙行註文":
        return note(shown, "新校正", "textual_collation") if "新校正" in shown else note(shown, "王冰")
    if name == "*":
        return note(shown, "校注", "textual_collation")
    if name == "**":
        return "".join(args[:1]) + note("".join(args[1:]), "校注", "textual_collation")
    if name == "?":
        seen["missing"] += 1
        return "〔原文缺字〕"
    if name not in PLAIN:
        seen["unknown"] += 1
    return shown


def expanded(text: str, source: str, glyphs: Glyphs, author: str = "") -> tuple[str, Counter]:
    """Repairs, no comments, lines marked; then innermost templates first until none is left, at most ROUNDS times,
    and repairs again. What is left of templates is counted as residual."""
    seen: Counter = Counter()
    text = glyphs.repaired(text, source)
    text = re.sub(r"<noinclude\b[^>]*>.*?</noinclude>|<!--.*?-->", "", text, flags=re.S | re.I)
    text = lines_marked(text, source, author)
    for _ in range(ROUNDS):
        text, n = INNER.subn(lambda m: expand(m[1], glyphs, seen, author), text)
        if not n:
            break
    seen["residual"] += text.count("{{") + text.count("}}")
    return glyphs.repaired(text, source), +seen


def line_kind(bare: str) -> tuple[str, str]:
    """(kind, title) of a line: a heading's level, or metadata, quote, commentary, blank, text."""
    if not bare:
        return "blank", ""
    for kind, pattern in LINE_KINDS:
        if m := pattern.fullmatch(bare):
            level = {"heading": str(len(m.groupdict().get("marks") or "")), "printed": "3"}.get(kind, kind)
            return level, (m.groupdict().get("title") or "").strip()
    return "text", bare


def lines_marked(text: str, source: str = "", author: str = "") -> str:
    """Headings and quotes of a page become marks of their own line; metadata lines go. A quote ends before a blank
    line, a heading that isn't only printed, or a line of commentary. In two works full-width parentheses are notes."""
    if source in PARENTHESES_ARE_NOTES:
        text = text.replace("（", f"{OPEN}N:{short_name(author)}:commentary{CLOSE}（").replace("）", f"）{OPEN}/N{CLOSE}")
    out, quoting = [], False
    for line in re.split(r"\r\n|\r|\n", text):
        kind, title = line_kind(line.strip())
        printed = kind == "3" and title == line.strip()
        if quoting and kind not in ("text", "metadata", "quote") and not printed:
            out.append(f"{OPEN}/Q{CLOSE}")
            quoting = False
        if kind.isdigit():
            out += ["", f"{OPEN}H:{kind}:{title}{CLOSE}", ""] if title else []
        elif kind == "quote":
            out += [f"{OPEN}Q{CLOSE}", title]
            quoting = True
        elif kind != "metadata":
            out.append(line.rstrip())
    return "\n".join([*out, f"{OPEN}/Q{CLOSE}"] if quoting else out)


MARK = re.compile(rf"{OPEN}(H:\d:[^{CLOSE}]*|N:[^{CLOSE}]*|/N|Q|/Q){CLOSE}")
TOKEN = "array<struct<kind:string,level:int,speaker:string,role:string,text:string>>"
TOKENS = pa.list_(pa.struct([("kind", pa.string()), ("level", pa.int32()), ("speaker", pa.string()), ("role", pa.string()), ("text", pa.string())]))
#: Pages that are Python objects at a time.
PAGES = 64


def tokens(text: str, source: str = "") -> list[dict]:
    """C11's walk: headings, and paragraphs with the innermost open note or quote. In some works each line is a paragraph."""
    out: list[dict] = []
    stack: list[tuple[str, str | None, str | None]] = []
    paragraphs = re.compile(r"\n+" if source in LINES_ARE_PARAGRAPHS else r"\n\s*\n")
    for k, part in enumerate(MARK.split(text)):
        if not k % 2:
            kind, speaker, role = stack[-1] if stack else ("text", None, None)
            out += [{"kind": kind, "level": 0, "speaker": speaker, "role": role, "text": p} for p in paragraphs.split(part) if p.strip()]
        elif part[0] == "H":
            _, level, title = part.split(":", 2)
            out.append({"kind": "heading", "level": int(level), "speaker": None, "role": None, "text": title.strip()})
        elif part[0] == "N":
            _, speaker, role = part.split(":", 2)
            stack.append(("note", speaker or None, role))
        elif part[0] == "Q":
            stack.append(("quote", None, None))
        elif stack:
            stack.pop()
    return out


def walked(raw: pa.Array, source: pa.Array, author: pa.Array, glyphs: Glyphs) -> pa.Array:
    """C1 to C11's tokens of pages, their texts cleaned. Only a few pages at a time become Python objects; the rest stays as it came."""
    done = []
    for k in range(0, len(raw), PAGES):
        some = zip(*(c.slice(k, PAGES).to_pylist() for c in (raw, source, author)), strict=True)
        found = (tokens(wiki_text(expanded(t or "", s or "", glyphs, a or "")[0]), s or "") for t, s, a in some)
        done.append(pa.array([[{**x, "text": plain_text(x["text"])} for x in page] for page in found], TOKENS))
    return pa.concat_arrays(done) if done else pa.array([], TOKENS)


def default_speaker(source: Column, layer: Column, author: Column) -> tuple[Column, Column]:
    """(speaker, role) of a work where nothing else is said."""
    special = F.create_map(*[F.lit(x) for kv in DEFAULT_SPEAKERS.items() for x in kv])
    own = F.try_element_at(special, source)
    name = F.when(own.isNotNull(), own).when(layer == "core", "原典").otherwise(F.substring_index(author, "（", 1))
    role = F.when(own.isNotNull(), "quoted_core").when(layer == "core", "core_text").when(layer == "commentary", "commentary").otherwise("lineage")
    return name, role


def blocks(pages: DataFrame, glyphs: Glyphs | None = None) -> DataFrame:
    """Pages to blocks (source_id, page_no, token_no, piece_no, volume, section, subsection, kind, speaker, speaker_type, text).

    pages: (source_id, page_no, raw), and where known title, parent_title, layer and author. A heading of level 2 with 卷 is a
    volume, others up to level 3 are sections, deeper ones subsections; each ends what is below it and holds until the
    next, also on later pages. A page whose title names a volume begins that volume, but ends no section.
    """
    glyphs = glyphs or Glyphs()
    for c in ("title", "parent_title", "layer", "author"):
        if c not in pages.columns:
            pages = pages.withColumn(c, F.lit(None).cast("string"))

    @F.arrow_udf(TOKEN)
    def walk(raw: pa.Array, source: pa.Array, author: pa.Array) -> pa.Array:
        return walked(raw, source, author, glyphs)

    told = pages.select("source_id", "page_no", "layer", F.coalesce("author", F.lit("")).alias("author"), volume_of(F.coalesce("parent_title", "title", F.lit(""))).alias("page_volume"), "raw")
    rows = told.select("source_id", "page_no", "layer", "author", "page_volume", F.posexplode(walk("raw", "source_id", "author")).alias("token_no", "t")).select("source_id", "page_no", "layer", "author", "page_volume", "token_no", "t.*")
    rows = rows.where("kind <> 'heading' or text <> ''")
    heading, level = F.col("kind") == "heading", F.col("level")
    is_volume = heading & (level <= 2) & F.contains("text", F.lit("卷"))
    is_section = heading & ~is_volume & (level <= 3)
    at = F.struct("page_no", "token_no")
    w = Window.partitionBy("source_id").orderBy("page_no", "token_no").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda test, title: F.last(F.when(test, F.struct(at.alias("at"), title.alias("title"))), ignorenulls=True).over(w)
    page_start = F.struct(F.col("page_no"), F.lit(-1).alias("token_no"))
    of_page = F.last(F.when(F.col("page_volume") != "", F.struct(page_start.alias("at"), F.col("page_volume").alias("title"))), ignorenulls=True).over(w)
    rows = rows.withColumns({"v": last(is_volume, F.col("text")), "p": of_page, "s": last(is_section, F.col("text")), "u": last(heading & (level >= 4), F.col("text"))})
    before = F.struct(F.lit(-1).cast("int").alias("page_no"), F.lit(-1).alias("token_no"))
    place = lambda x: F.coalesce(F.col(f"{x}.at"), before)
    rows = rows.withColumns(
        {
            "volume": F.coalesce(F.when(place("p") > place("v"), F.col("p.title")).otherwise(F.col("v.title")), F.lit("")),
            "section": F.when(place("s") > place("v"), F.col("s.title")).otherwise(""),
            "subsection": F.when((place("u") > place("v")) & (place("u") > place("s")), F.col("u.title")).otherwise(""),
        }
    )
    said = rows.where("kind <> 'heading'").drop("v", "p", "s", "u", "level", "page_volume")
    name, role = default_speaker(F.col("source_id"), F.col("layer"), F.col("author"))
    quoted = F.col("kind") == "quote"
    preface = quoted & F.contains("section", F.lit("序"))
    originals = F.col("source_id") == QUOTES_ORIGINALS
    said = said.withColumns(
        {
            "noted": F.when(preface, name).when(quoted, F.when(originals, "所引原文").otherwise("原文与注文混排")).otherwise(F.coalesce("speaker", name)),
            "role": F.when(preface, "preface").when(quoted, F.when(originals, "quoted_core").otherwise("mixed")).otherwise(F.coalesce("role", role)),
        }
    )
    return spoken(said).drop("layer", "author")


def spoken(rows: DataFrame) -> DataFrame:
    """C6 to C8 and the roles of C11: rows (text, noted, role) of cleaned text cut where a named speaker begins, as piece_no; the part before
    keeps its speaker. Original text in which another one speaks is dialogue. One work's texts are cut where its note begins."""
    cleaned = rows.where(F.col("text").rlike(rf"{CJK}|[A-Za-z0-9]"))
    mixed = F.col("source_id") == TEXT_AND_NOTE
    begins = F.when(F.col("text").rlike("^(?:論|论)曰"), F.lit(1)).otherwise(F.regexp_instr("text", F.lit("(?:註|注)曰")))
    part = lambda a, b, who, what: F.struct(F.substring(F.col("text"), a, b).alias("t"), who.alias("who"), what.alias("what"))
    whole = F.struct(F.col("text").alias("t"), F.col("noted").alias("who"), F.col("role").alias("what"))
    two = F.array(part(F.lit(1), begins - 1, F.lit("张仲景原文"), F.lit("quoted_core")), part(begins, F.length("text"), F.lit("徐彬"), F.lit("commentary")))
    roles = cleaned.withColumn("own", F.when(mixed & (begins > 0), F.filter(two, lambda x: x["t"] != "")).otherwise(F.array(whole)))
    pieces = F.flatten(F.transform("own", lambda x: F.transform(F.split(F.regexp_replace(x["t"], SPEAKER_AT, "\x01"), "\x01"), lambda y: F.struct(y.alias("t"), x["who"].alias("who"), x["what"].alias("what")))))
    cut = roles.select("*", F.posexplode(pieces).alias("piece_no", "x"))
    # A piece of cleaned text has no white space but single spaces that stay; a mark from the line after may only now meet its letter.
    cut = cut.withColumns({"text": F.trim(nfc(F.col("x.t"))), "noted": F.col("x.who"), "role": F.col("x.what")}).where("text <> ''")
    label = F.regexp_extract("text", rf"^({SPEAKERS})(?:氏)?(?:問|问|對|对|答)?(?:曰|云|按)", 1)
    names = F.create_map(*[F.lit(x) for kv in SPEAKER_NAMES.items() for x in kv])
    speaker = F.when(label != "", F.coalesce(F.try_element_at(names, label), label)).otherwise(F.col("noted"))
    other = ~speaker.eqNullSafe(F.col("noted")) & F.col("role").isin("core_text", "quoted_core")
    return cut.withColumns({"speaker": speaker, "speaker_type": F.when(other, "dialogue").otherwise(F.col("role"))}).drop("noted", "role", "own", "x")


def source_statistics(found: DataFrame) -> DataFrame:
    """(source_id, blocks, characters, speakers, speaker_types): the maps hold how many blocks each has."""
    per = lambda c: found.groupBy("source_id", F.coalesce(c, F.lit("")).alias("k")).agg(F.count("*").alias("n")).groupBy("source_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias(c + "s"))
    whole = found.groupBy("source_id").agg(F.count("*").alias("blocks"), F.sum(F.length("text")).alias("characters"))
    return whole.join(per("speaker"), "source_id").join(per("speaker_type"), "source_id")


def volume_of(title: Column) -> Column:
    """The last part of a page title if it names a volume, a preface or the like."""
    leaf = F.substring_index(title, "/", -1)
    return F.when(leaf.rlike("卷|序|目録|目錄|原病篇"), leaf).otherwise("")


def transclusions(pages: DataFrame, raw: str = "raw", most: int = 2000) -> DataFrame:
    """<pages index="..." from=a to=b> become a row for each scan number; ranges that are reversed or too long are errors."""
    found = pages.withColumn("tag", F.explode(F.regexp_extract_all(raw, F.lit(r"(?i)(<pages\b[^>]*>)"), F.lit(1))))
    get = lambda k: F.regexp_extract("tag", rf'(?i)\b{k}\s*=\s*"?([^"\s/>]+)"?', 1)
    found = found.withColumns({"file": get("index"), "first": get("from").try_cast("int"), "last": get("to").try_cast("int")})
    bad = F.col("first").isNull() | F.col("last").isNull() | (F.col("last") < F.col("first")) | (F.col("last") - F.col("first") > most)
    return found.withColumn("error", F.when(bad, F.lit("bad range"))).withColumn("scan_number", F.explode_outer(F.when(~bad, F.sequence("first", "last")))).drop("tag")


def glyph_table(lines: DataFrame, line: str = "line") -> DataFrame:
    """Rows of a module's table read as data: code, value and how it was resolved (primary, fallback or placeholder)."""
    text = F.col(line)
    code = F.regexp_extract(text, r'\[\s*"?([0-9A-Za-z]+)"?\s*\]\s*=', 1)
    one, two = F.regexp_extract(text, r'=\s*\{?\s*"([^"]*)"', 1), F.regexp_extract(text, r'=\s*\{\s*"[^"]*"\s*,\s*"([^"]*)"', 1)
    value = F.when(one != "", one).when(two != "", two)
    how = F.when(one != "", "primary").when(two != "", "fallback").otherwise("placeholder")
    return lines.where(code != "").select(code.alias("code"), F.coalesce(value, F.concat(F.lit("〔未识别字"), code, F.lit("〕"))).alias("value"), how.alias("resolution"))
