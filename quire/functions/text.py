"""Column expressions for text: normalizers, n-grams, markup, quoting. All run in the JVM except where stated."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Character tables and phrase overrides of the query and evidence normalizers.
QUERY_FROM = "問靈樞傷論匱難經溫條黃帝內陰陽氣脈證湯藥臟腑榮衛補瀉傳統醫學體會門風熱寒濕燥長與無為後發實虛歲數鬭鑄錐"
QUERY_TO = "问灵枢伤论匮难经温条黄帝内阴阳气脉证汤药脏腑荣卫补泻传统医学体会门风热寒湿燥长与无为后发实虚岁数斗铸锥"
EVIDENCE_FROM = "問靈樞傷論匱難經溫條黃帝內陰陽氣脈證湯藥臟腑榮衛補瀉傳統醫學體會門風熱寒濕燥長與無為後發實虛歲數針灸療效劑量懷孕兒童過敏嚴氣壓單側語暈覺識燒頭頸關節"
EVIDENCE_TO = "问灵枢伤论匮难经温条黄帝内阴阳气脉证汤药脏腑荣卫补泻传统医学体会门风热寒湿燥长与无为后发实虚岁数针灸疗效剂量怀孕儿童过敏严气压单侧语晕觉识烧头颈关节"
TITLE_FROM = "註畧黃內經靈樞傷論條溫熱濕時淺廣補證發類貫難釋訂輯醫"
TITLE_TO = "注略黄内经灵枢伤论条温热湿时浅广补证发类贯难释订辑医"
QUERY_OVERRIDES = (("五藏", "五脏"), ("欬", "咳"), ("痺", "痹"), ("鬬", "斗"))
INDEX_OVERRIDES = QUERY_OVERRIDES[:3]

#: What a normalizer keeps: digits, Latin letters and CJK; or every letter and digit.
CJK_KEEP = r"[^0-9a-z\x{3400}-\x{9fff}\x{20000}-\x{3134f}]+"
LETTER_KEEP = r"[^\p{L}\p{N}]+"
CJK = r"[\x{3400}-\x{9fff}\x{20000}-\x{3134f}]"


def replaced(text: Column, pairs: tuple) -> Column:
    """Literal replacements, one after another."""
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """rows with columns that are computed once, however often they are used.

    They stand behind a generator of one element, through which the optimizer doesn't copy expressions into their uses.
    """
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def lowered(text: Column, overrides: tuple) -> Column:
    """Characters simplified, lower case, phrase overrides. Tables and overrides are of CJK alone, and a text without it is spared them:
    looking each character up costs as much as the rest together."""
    return F.when(text.rlike(r"[\x{3400}-\x{9fff}]"), replaced(F.lower(F.translate(text, QUERY_FROM, QUERY_TO)), overrides)).otherwise(F.lower(text))


def normalize_query(text: Column, keep: str = CJK_KEEP) -> Column:
    """simplify characters, lower case, phrase overrides, drop the rest."""
    return F.regexp_replace(lowered(text, QUERY_OVERRIDES), keep, "")


def normalize_index(text: Column, keep: str = CJK_KEEP) -> Column:
    """as F5 with the index's own three overrides."""
    return F.regexp_replace(lowered(text, INDEX_OVERRIDES), keep, "")


def normalize_evidence(text: Column, keep: str = CJK_KEEP) -> Column:
    """the evidence layer's table, without overrides."""
    return F.regexp_replace(F.lower(F.translate(text, EVIDENCE_FROM, EVIDENCE_TO)), keep, "")


def normalize_alias(text: Column) -> Column:
    """only spaces go."""
    return F.regexp_replace(F.lower(F.translate(text, EVIDENCE_FROM, EVIDENCE_TO)), " ", "")


def composed(text: Column, compatible: bool) -> Column:
    """Unicode composition, compatibility forms too if compatible. Spark has no such function, but has ICU, whose static method is called
    in the JVM; null, which that does not take, stays null."""
    method = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(text, F.lit("")), F.lit(compatible))
    return F.when(text.isNotNull(), method)


def nfkc(text: Column) -> Column:
    return composed(text, True)


def nfc(text: Column) -> Column:
    return composed(text, False)


def normalize_corpus(text: Column, drop: tuple = (), replacements: tuple = ()) -> Column:
    """NFKC, lower case, placeholders dropped, search replacements, letters and CJK kept."""
    out = F.lower(nfkc(text))
    for pattern in drop:
        out = F.regexp_replace(out, pattern, "")
    return F.regexp_replace(replaced(out, replacements), LETTER_KEEP, "")


def normalize_title(text: Column) -> Column:
    """B1."""
    return F.regexp_replace(F.lower(F.translate(nfkc(text), TITLE_FROM, TITLE_TO)), r"[^0-9a-z\x{3400}-\x{9fff}]+", "")


def bigrams(text: Column) -> Column:
    """Overlapping pairs of characters; a single character stands for itself."""
    pairs = F.regexp_extract_all(text, F.lit("(?s)(?=(..))."), F.lit(1))
    return F.when(F.length(text) == 1, F.array(text)).otherwise(F.coalesce(pairs, F.array().cast("array<string>")))


def bigram_set(text: Column) -> Column:
    """H5: bigrams without repeats, in order of first occurrence."""
    return F.array_distinct(bigrams(text))


def jaccard(left: Column, right: Column) -> Column:
    """K1 over two sets; 0 if either is empty."""
    both = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - both
    return F.when((F.size(left) == 0) | (F.size(right) == 0), F.lit(0.0)).otherwise(both / either)


def url_quote(text: Column) -> Column:
    """Percent-encoding of everything but letters, digits and _.-~."""
    return replaced(F.url_encode(text), (("+", "%20"), ("*", "%2A"), ("%7E", "~")))


def fixed_revision_url(base: str, title: Column, revision: Column) -> Column:
    return F.concat(F.lit(f"{base}?title="), url_quote(title), F.lit("&oldid="), revision.cast("string"))


def proofread_level(text: Column) -> Column:
    """The first level of a page's proofreading mark, or null."""
    return F.regexp_extract(text, r"""(?i)<pagequality\s+level=["']?([0-9])""", 1).try_cast("int")


def split_relationship(text: Column) -> Column:
    """Comma-separated values, trimmed, empty ones dropped."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


# Entities that markup stripping decodes natively.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))


def unescape(text: Column) -> Column:
    return replaced(text, ENTITIES)


def strip_html(text: Column) -> Column:
    """Comments, scripts, styles and tags go, line breaks stay lines, common entities are decoded, white space is joined."""
    out = F.regexp_replace(text, r"(?s)<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?is)<script\b[^>]*>.*?</script>", "")
    out = F.regexp_replace(out, r"(?is)<style\b[^>]*>.*?</style>", "")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>", "\n")
    out = unescape(F.regexp_replace(out, r"<[^>]+>", " "))
    return F.regexp_replace(F.regexp_replace(out, r"[ \t\x{a0}]+", " "), r"\s*\n\s*", "\n")


# Elements whose content is no text, those that only wrap text, and link targets that show nothing.
HIDDEN = ("noinclude", "ref")
NO_LABEL = ("file", "image", "category", "文件", "檔案", "分类", "分類")
LIST_MARKS = " \t:*#;"
CLOSING = "，。；：！？、）》】"

_EVENT = re.compile(r"<!--|<(/?)([A-Za-z][A-Za-z0-9]*)([^<>]*)>|\[\[|\]\]|\[(?:https?:)?//[^\s\]]+|\]|-\{|-\}|'{2,5}|<[^<>]+>")
_IMAGE = re.compile(r"\\p[^\\\s]*?\.bmp", re.I)
_CJK = re.compile("[㐀-鿿\U00020000-\U0003134f]")


def wiki_text(markup: str) -> str:
    """The text of wiki markup, read once from left to right.

    Links and script variants are frames on a stack that say at their end what of them is shown: the label of a link, nothing
    of files and categories, the text of a variant without its language. What is hidden is skipped to its end tag. Lines
    of tables go, and marks at the beginning of lines.
    """
    out: list[list[str]] = [[]]
    kinds: list[str] = []

    def close(kind: str, literal: str) -> None:
        if not kinds or kinds[-1] != kind:
            out[-1].append(literal)
            return
        kinds.pop()
        body = "".join(out.pop())
        if kind == "[[":
            target, bar, label = body.partition("|")
            hidden = target.partition(":")[0].strip().lower() in NO_LABEL and ":" in target
            body = "" if hidden else (label if bar else target).strip()
        elif kind == "-{":
            language, colon, rest = body.partition(":")
            body = rest if colon and not set(language) & set(":{}") else body
        else:
            body = body.strip()
        out[-1].append(body)

    at = 0
    for m in _EVENT.finditer(markup):
        if m.start() < at:
            continue  # inside of what is hidden
        out[-1].append(markup[at : m.start()])
        at, token, tag = m.end(), m[0], (m[2] or "").lower()
        if token == "<!--":
            end = markup.find("-->", at)
            at = end + 3 if end >= 0 else at
        elif tag in HIDDEN and not m[1] and not m[3].rstrip().endswith("/"):
            end = re.compile(rf"</{tag}\s*>", re.I).search(markup, at)
            at = end.end() if end else at
        elif tag == "br":
            out[-1].append("\n")
        elif token in ("[[", "-{") or token.startswith("["):
            kinds.append(token if token in ("[[", "-{") else "[")
            out.append([])
        elif token in ("]]", "-}", "]"):
            close({"]]": "[[", "-}": "-{", "]": "["}[token], token)
    out[-1].append(markup[at:])
    while kinds:  # what is never closed is text
        mark, body = kinds.pop(), "".join(out.pop())
        out[-1].append(mark + body)
    lines = [line for line in "".join(out[0]).split("\n") if line.lstrip(" \t")[:1] not in ("|", "!") or not line.strip()]
    shown = html.unescape("\n".join(line.lstrip(LIST_MARKS) for line in lines))
    return _IMAGE.sub("", shown).replace("\\r", "").replace("\\x", "")


def plain_text(text: str) -> str:
    """Composed, on one line. A gap with a line break vanishes, as does one between CJK characters or before closing
    punctuation; any other is one space."""
    out: list[str] = []
    for gap, word in re.findall(r"(\s*)(\S+)", unicodedata.normalize("NFC", text)):
        tight = not out or "\n" in gap or word[0] in CLOSING or (_CJK.match(out[-1][-1]) and _CJK.match(word[0]))
        out.append(word if tight or not gap else " " + word)
    return "".join(out)


@F.pandas_udf(StringType())
def strip_wiki(s):
    return s.map(wiki_text, na_action="ignore")


@F.pandas_udf(StringType())
def clean_plain(s):
    return s.map(plain_text, na_action="ignore")


# Readings of characters in this literature, in order, and two rules by context.
DISPLAY = (
    ("五藏", "五脏"), ("藏腑", "脏腑"), ("脏府", "脏腑"), ("六府", "六腑"), ("荣卫", "营卫"), ("荣气", "营气"), ("荣血", "营血"), ("荅曰", "答曰"), ("写以", "泻以"), ("能写", "能泻"), ("二写一补", "二泻一补"),
    ("血写", "血泻"), ("如写漆", "如泻漆"),
)
DISPLAY_RULES = (
    ("([补補溢濡当當宜可欲疾微大尽盡俱易盛实實虚虛针鍼刺不])写", "$1泻"),
    ("(?<![传傳误誤抄书書])写(?=[之其而则則者也矣法热熱邪实實虚虛阳陽阴陰隂气氣血火胃五三足手无無有])", "泻"),
)


def convert_script(text: Column, table: tuple[str, str] = (EVIDENCE_FROM, EVIDENCE_TO), back: bool = False) -> Column:
    """each character by a table (from, to), composed; back: the other way, where the table says it without doubt."""
    pairs = dict(zip(*table, strict=True))
    if back:
        several = {b for b in pairs.values() if list(pairs.values()).count(b) > 1}
        pairs = {b: a for a, b in pairs.items() if b not in several}
    old, new = "".join(pairs), "".join(pairs.values())
    return F.translate(nfc(text), old, new)


def display_text(text: Column) -> Column:
    """the literal readings, then those by context."""
    return reduce(lambda c, rule: F.regexp_replace(c, *rule), DISPLAY_RULES, replaced(text, DISPLAY))


def converted(rows: DataFrame, columns: tuple[str, ...] = ("volume", "section", "subsection", "speaker"), text: str = "text", table: tuple[str, str] = (EVIDENCE_FROM, EVIDENCE_TO)) -> DataFrame:
    """F1 and F2 of blocks: text_traditional, text_simplified (with readings) and text_search of text; of the other columns
    c the simplified form, and c_source and c_traditional."""
    old = convert_script(F.col(text), table, back=True)
    new = {"text_traditional": old, "text_simplified": display_text(convert_script(old, table))}
    for c in columns:
        new |= {f"{c}_source": F.col(c), f"{c}_traditional": convert_script(F.col(c), table, back=True), c: convert_script(convert_script(F.col(c), table, back=True), table)}
    return rows.withColumns(new).withColumn("text_search", normalize_corpus(F.col("text_simplified"), tuple(ISSUES.values())[:1]))


# Numerals.
DIGITS = "〇零一二三四五六七八九"
DIGIT_VALUES = "00123456789"


def chinese_number(text: Column) -> Column:
    """Digits, positional numerals, or numerals with units up to thousands, as a long."""
    arabic = F.translate(text, DIGITS, DIGIT_VALUES)
    digit = lambda c: F.translate(c, DIGITS, DIGIT_VALUES).try_cast("long")
    unit = lambda c: F.when(c == "十", 10).when(c == "百", 100).when(c == "千", 1000)
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("now"))
    step = lambda a, c: F.struct(
        F.when(unit(c).isNotNull(), a["total"] + F.greatest(a["now"], F.lit(1)) * unit(c)).otherwise(a["total"]).cast("long").alias("total"),
        F.when(unit(c).isNotNull(), F.lit(0)).otherwise(F.coalesce(digit(c), a["now"])).cast("long").alias("now"),
    )
    parts = F.aggregate(F.split(text, ""), zero, step, lambda a: a["total"] + a["now"])
    return F.when(arabic.rlike("^[0-9]+$"), arabic.cast("long")).otherwise(parts)


def page_key(title: Column) -> Column:
    """struct<class, number, part, leaf> by which pages sort in reading order."""
    leaf = F.substring_index(title, "/", -1)
    numeral = F.regexp_extract(leaf, "(?:卷第?([〇零一二三四五六七八九十百千0-9]+)[上中下]?|第([〇零一二三四五六七八九十百千0-9]+)卷)$", 0)
    number = chinese_number(F.regexp_replace(numeral, "[^〇零一二三四五六七八九十百千0-9]", ""))
    part = F.instr(F.lit("上中下"), F.regexp_extract(numeral, "([上中下])$", 1)) * (F.regexp_extract(numeral, "([上中下])$", 1) != "").cast("int")
    kind = F.when(leaf.rlike("(?:序|提要|目録|目錄)$"), 0).when(leaf == "原病篇", 1).when(leaf == "卷首", 2).when(numeral != "", 3).otherwise(9)
    return F.struct(kind.alias("kind"), F.when(kind == 3, number).otherwise(F.lit(0)).cast("long").alias("number"), F.when(kind == 3, part).otherwise(F.lit(0)).cast("int").alias("part"), leaf.alias("leaf"))


def title_score(query: Column, title: Column, q: Column | None = None, t: Column | None = None) -> Column:
    """B2: how well a title answers a query, 0 to 100. q and t: the normalized forms, if at hand."""
    q, t = normalize_title(query) if q is None else q, normalize_title(title) if t is None else t
    a, b = F.array_distinct(F.split(q, "")), F.array_distinct(F.split(t, ""))
    base = (
        F.when(q == t, 100.0).when(F.startswith(t, q), 90.0).when(F.contains(t, q), 78.0).when(F.contains(q, t), 70.0).otherwise(60.0 * F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))
    )
    rest = F.startswith(t, q) & F.substr(t, F.length(q) + 1, F.length(t)).isin("序", "略", "校义", "集注")
    score = base - F.when(F.contains(title, F.lit("/")), 12.0).otherwise(0.0) - F.when(rest, 20.0).otherwise(0.0) - F.when(title.rlike("總目|图书集成|圖書集成|續文獻通考"), 30.0).otherwise(0.0)
    return F.when((F.length(q) == 0) | (F.length(t) == 0), F.lit(0.0)).otherwise(F.round(F.greatest(score, F.lit(0.0)), 2))


def ordered_hashes(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """(key, n, digest): sha256 over the values of each key in order, each with a newline.

    A hash over an order is sequential within its key, so a key's rows pass one task, but as a sorted stream: what is
    held is the hash state, never the group. Null counts as empty.
    """

    def run(batches):
        import hashlib

        import pyarrow as pa

        now, n, state, any_row = None, 0, hashlib.sha256(), False
        out: list[tuple] = []
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if any_row and k != now:
                    out.append((now, n, state.hexdigest()))
                    n, state = 0, hashlib.sha256()
                now, n, any_row = k, n + 1, True
                state.update((v or "").encode() + b"\n")
        if any_row:
            out.append((now, n, state.hexdigest()))
        if out:
            kind = pa.string() if isinstance(out[0][0] or "", str) else pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (kind, pa.int64(), pa.string()), strict=True)], ["key", "n", "digest"])

    kind = rows.schema[key].dataType.simpleString()
    ordered = rows.select(key, value, *order).repartition(key).sortWithinPartitions(key, *order).select(key, value)
    return ordered.mapInArrow(run, f"key {kind}, n long, digest string").withColumnRenamed("key", key)


def pages_hashes(pages: DataFrame, key: str, order: list[str]) -> DataFrame:
    """(key, n, digest) over title, revision and sha of each page, parted by null bytes, in order."""
    parts = F.concat_ws("\x00", F.col("title"), F.col("revision_id").cast("string"), F.col("raw_sha256"))
    return ordered_hashes(pages.withColumn("__line", parts), key, order, "__line")


def char_differences(left: Column, right: Column) -> Column:
    """F8: positions at which two texts differ, and the difference of their lengths."""
    a, b = F.split(left, ""), F.split(right, "")
    n = F.least(F.length(left), F.length(right))
    return F.size(F.filter(F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x != y), lambda x: x)) + F.abs(F.length(left) - F.length(right))


# What quarantines a passage.
ISSUES = {
    "explicit-missing-glyph": r"〔(?:未识别字[0-9]+|原文缺字(?::[^〕]+)?|四库缺字[0-9]+)〕",
    "legacy-glyph-placeholder-ht-kt": r"(?<![A-Za-z])(?:HT|KT)(?![A-Za-z])",
    "known-ui-text-intrusion": r"滚动条|滾動條",
    "unicode-replacement-character": r"\x{fffd}",
    "private-use-character": r"[\x{e000}-\x{f8ff}\x{f0000}-\x{ffffd}\x{100000}-\x{10fffd}]",
}


def issue_counts(text: Column, patterns: dict | None = None) -> Column:
    """Map of issue to its count, without zeros."""
    found = F.create_map(*[x for k, p in (patterns or ISSUES).items() for x in (F.lit(k), F.regexp_count(text, F.lit(p)).cast("long"))])
    return F.map_filter(found, lambda _, n: n > 0)


QUANTITY = "零〇一二三四五六七八九十百千万半两升合钱分厘枚个味斤"


def fragment_reason(text: Column, keep: str | None = CJK_KEEP) -> Column:
    """K2: why a text is no passage of its own, or null. Its reachable branches only. keep None: text is normalized already.

    Patterns that hold from the first character are asked of texts with such a character alone: to fail, each would go over the whole text."""
    clean = text if keep is None else normalize_query(text, keep)
    first = F.substring(clean, 1, 1)
    return (
        F.when(F.length(clean) < 8, "too-short")
        .when(first.isin(*QUANTITY) & clean.rlike(f"^[{QUANTITY}]+$"), "quantity-only")
        .when(first.isin(*"方见详同如一") & clean.rlike("^(?:方)?(?:见|详)(?:上|下|前|后|本篇)|^(?:同上|如上|方见上|一云.+)$"), "reference-only")
    )
