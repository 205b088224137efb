"""Secret scans: patterns, and an assignment-aware lexer for what patterns miss.

The lexer reads the parts of a text that look like source code or configuration: a name, maybe a type, an assignment
sign (= := => : ==) and a literal (quoted, quoted over lines, bare, or names and literals joined by +). Names keep their
dotted, dashed and bracketed paths, so that config["db"]["password"] and db.password are sensitive alike; names that
open braces, indented blocks or sections count, somewhat less, for what stands within. Constants are propagated: a
name assigned from names stands for the joined literals they had, of any length, so a key that is put together
from harmless names is scored where it reaches a sensitive one. A literal is scored by how sensitive its target name is
(or a name it came through), its length, its entropy and kinds of characters; placeholders score nothing. Found
literals of THRESHOLD or more are spans of kind 'lexed'.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import by_batch, table

THRESHOLD = 0.5
KINDS = ("assign", "access", "hex", "lexed")

# The base patterns, as required of the results.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so this is every run of 24 or more

#: Names and how sensitive they are: whole parts of a name, or two parts in a row.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9,
    "auth": 0.7, "authorization": 0.8, "bearer": 0.8, "private": 0.5, "signature": 0.6, "salt": 0.6, "pin": 0.5, "key": 0.4, "connection": 0.4, "dsn": 0.6,
    "api key": 1.0, "access key": 1.0, "private key": 1.0, "secret key": 1.0, "client secret": 1.0, "encryption key": 1.0, "signing key": 1.0, "account key": 0.9, "session key": 0.9, "auth token": 1.0,
}
HARMLESS = re.compile(r"(?i)^(?:true|false|null|none|nil|undefined|changeme|example|password|secret|token|your.*|xxx+|\*+|\.+|<.*>|\$\{.*\}|\$\w+|%\w+%|\{\{.*\}\})$")

# Possessive, and only begun where no name goes on, so that long runs of letters are read once.
NAME = r"""(?<![A-Za-z0-9_.-])[A-Za-z_][A-Za-z0-9_]*+(?:(?:\.|-|::|->)[A-Za-z_][A-Za-z0-9_]*+|\[["']?[A-Za-z0-9_.-]+["']?\])*+"""
QUOTED = r'''"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`'''
BARE = r"[A-Za-z0-9+/_.=~!@%^&*-]{6,}"
#: A type between a name and its sign, as in db_password: str = "..."
TYPED = r"""(?:[ \t]*:[ \t]*[A-Za-z_][A-Za-z0-9_.]*+(?:\[[^\]\n]{0,80}\])?(?:[ \t]*\|[ \t]*[A-Za-z_][A-Za-z0-9_.]*+)*+(?=[ \t]*=(?!=))|[ \t]+string(?=[ \t]*=))?"""
LONG_QUOTE = r"""\"{3}|'{3}"""
PAIR = rf"""(?P<name>{NAME})["']?{TYPED}[ \t]*(?::=|=>|==?|:)[ \t]*(?:(?P<long>{LONG_QUOTE})|(?P<value>(?:{QUOTED}|{BARE}|{NAME})(?:[ \t]*\+[ \t]*(?:{QUOTED}|{NAME}))*))"""
OPENER = rf"""(?P<opens>{NAME})["']?[ \t]*(?:(?:=>|=|:)?[ \t]*(?P<brace>\{{)|:[ \t]*(?=\n|#|$))"""
EVENT = re.compile(rf"""{OPENER}|{PAIR}|(?P<bare>[{{}}])|\n(?:\[(?P<section>[A-Za-z0-9_. "'-]{{1,80}})\][ \t]*(?=\n|$)|(?P<indent>[ \t]*)(?=[^\s]))""")
ATOM = re.compile(rf"(?P<quoted>{QUOTED})|(?P<word>[^\s+\"'`]+(?:\+[^\s+\"'`]+)*)")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
ESCAPE = re.compile(r"\\(.)")
SIGN = re.compile(r"[:=]")
#: How much the names around a name count.
AROUND = 0.8
#: Of a joined value these ends are kept as text; the longest placeholder that is told by its whole text is shorter.
ENDS = 64


@lru_cache(1 << 16)
def name_score(name: str) -> float:
    parts = [p.lower() for p in PARTS.findall(name)]
    best = max((SENSITIVE.get(p, 0.0) for p in parts), default=0.0)
    return max([best, *(SENSITIVE.get(f"{a} {b}", 0.0) for a, b in zip(parts, parts[1:], strict=False))])


@dataclass(slots=True)
class Value:
    """A literal, or literals joined: how often each character stands in it and its ends, never the joined text, so that
    repeated joining cannot make it large."""

    counts: Counter
    head: str
    tail: str
    parts: tuple
    place: tuple[int, int] | None
    through: float = 0.0
    told: float = 0.0

    @classmethod
    def literal(cls, text: str, place: tuple[int, int]) -> Value:
        return cls(Counter(text), text[:ENDS], text[-ENDS:], (), place)

    @classmethod
    def joined(cls, parts: list[Value]) -> Value:
        if len(parts) == 1:
            return parts[0]
        counts, head, tail = Counter(), "", ""
        for p in parts:
            counts.update(p.counts)
            head = (head + p.head)[:ENDS]
            tail = (tail + p.tail)[-ENDS:]
        return cls(counts, head, tail, tuple(parts), None, max((p.through for p in parts), default=0.0))

    def named(self, score: float) -> Value:
        """This value as it stands under a name."""
        return Value(self.counts, self.head, self.tail, (self,), None, max(score, self.through))


def _placeholder(v: Value, n: int) -> bool:
    if n <= ENDS:
        return bool(HARMLESS.match(v.head))
    only, word = set(v.counts), all(c.isalnum() or c == "_" for c in v.counts if c not in "$%")
    return (
        "\n" not in only and (v.head.lower().startswith("your") or (v.head[0] == "<" and v.tail[-1] == ">") or (v.head[:2] == "${" and v.tail[-1] == "}") or (v.head[:2] == "{{" and v.tail[-2:] == "}}"))
    ) or only <= {"x", "X"} or only in ({"*"}, {"."}) or (word and v.head[0] == "$" and v.counts["$"] == 1 and not v.counts["%"]) or (word and v.head[0] == v.tail[-1] == "%" and v.counts["%"] == 2 and not v.counts["$"])


def literal_score(value: str | Value) -> float:
    """0 to 1: how much a literal looks like a secret."""
    v = Value.literal(value, (0, 0)) if isinstance(value, str) else value
    n = v.counts.total()
    if n < 6 or _placeholder(v, n) or any(c.isspace() for c in v.counts):
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in v.counts.values())
    kinds = sum(any(f(c) for c in v.counts) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, entropy / 4.0) * (0.55 + 0.15 * kinds) * (1.0 if n >= 12 else 0.8)


def lexed(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, str, str, float]]:
    """(start, end, target name, literal, score) of literals assigned to sensitive names; the span is the literal without quotes."""
    if not SIGN.search(text):
        return []
    known: dict[str, Value] = {}
    found: dict[tuple[int, int], tuple[str, float]] = {}
    around: list[tuple[str, int, float]] = []  # what is open: '{', its indent for a block, or '[' for a section; and its score
    indent, pos, closes = 0, 0, dict.fromkeys(('"' * 3, "'" * 3), True)

    def score_around() -> float:
        return around[-1][2] if around else 0.0

    def tell(value: Value, name: str, score: float) -> None:
        """score for every literal of value, if it had less."""
        todo = [value]
        while todo:
            v = todo.pop()
            if v.told < score:
                v.told = score
                if v.place:
                    found[v.place] = name, score
                todo += v.parts

    while m := EVENT.search(text, pos):
        pos = m.end()
        if m["indent"] is not None:
            indent = len(m["indent"])
            while around and around[-1][0] == "block" and around[-1][1] >= indent:
                around.pop()
        elif m["section"] is not None:
            around, indent = [("[", 0, name_score(m["section"]))], 0
        elif m["bare"] == "}":
            while around and around.pop()[0] != "{":
                pass
        elif m["bare"]:
            around.append(("{", indent, score_around()))
        elif m["opens"] is not None:
            around.append(("{" if m["brace"] else "block", indent, max(score_around(), name_score(m["opens"]))))
        else:
            name, parts = m["name"], []
            if quote := m["long"]:
                end = text.find(quote, pos) if closes[quote] else -1
                closes[quote] = end >= 0
                if end < 0:
                    continue
                parts.append(Value.literal(text[pos:end], (pos, end)))
                pos = end + 3
            else:
                at = m.start("value")
                for a in ATOM.finditer(m["value"]):
                    lo, hi = at + a.start(), at + a.end()
                    if a["quoted"] is not None:
                        parts.append(Value.literal(ESCAPE.sub(r"\1", text[lo + 1 : hi - 1]), (lo + 1, hi - 1)))
                    elif a["word"] in known:
                        parts.append(known[a["word"]])
                    elif len(m["value"]) == len(a["word"]):
                        parts.append(Value.literal(a["word"], (lo, hi)))
            own = max(name_score(name), AROUND * score_around())
            value = Value.joined(parts)
            best = max(own, value.through)
            if best >= 0.5 and (score := best * literal_score(value)) >= threshold:
                tell(value, name, score)
            known[name] = value.named(own)
    return [(lo, hi, name, text[lo:hi], score) for (lo, hi), (name, score) in sorted(found.items()) if hi > lo]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches, leftmost and not overlapping within a kind, by start and then kind."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def scan(text: str, threshold: float = THRESHOLD) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans): lexed spans are added where no base span covers them already."""
    base = base_spans(text)
    starts, reach, far = [s for s, _, _ in base], [], 0
    for _, e, _ in base:
        far = max(far, e)
        reach.append(far)
    more = []
    for lo, hi, *_ in lexed(text, threshold):
        k = bisect_right(starts, lo)
        if not k or reach[k - 1] < hi:
            more.append((lo, hi, "lexed"))
    return base, sorted([*base, *more], key=lambda x: (x[0], KINDS.index(x[2]))) if more else base


def secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, found array<struct<kind,start,end,base>>) for each row of docs, by start and kind.

    Places are code points, ends exclusive. Null text counts as empty. Rows that repeat are scanned each; an
    empty table gives an empty table; other columns are not read.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for t in batch.column(1):
            base, every = scan(t.as_py() or "", threshold)
            rows.append([{"kind": k, "start": s, "end": e, "base": k != "lexed"} for s, e, k in every])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "found"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(by_batch(one), "doc_id long, found array<struct<kind:string,start:long,end:long,base:boolean>>")


def redacted(docs: DataFrame, threshold: float = THRESHOLD, mark: str = "[SECRET]") -> DataFrame:
    """docs with every found span (overlapping ones joined) replaced by mark; other columns stay."""

    @F.pandas_udf("string")
    def clean(texts):
        def one(t):
            if t is None:
                return None
            out, at = [], 0
            for s, e, _ in scan(t, threshold)[1]:
                if s >= at:
                    out += [t[at:s], mark]
                at = max(at, e)
            return "".join([*out, t[at:]])

        return texts.map(one)

    return docs.withColumn("text", clean(F.col("text").cast("string")))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))
    shown = "concat_ws(':', x.kind, cast(x.start as string), cast(x.end as string))"
    count = lambda k: F.expr(f"cast(size(filter(found, x -> x.kind = '{k}')) as long)").alias(f"n_{k}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(F.array_join(F.expr(f"transform(filter(found, x -> x.base), x -> {shown})"), ","), 256).alias("base_sha256"),
        F.array_join(F.expr(f"transform(found, x -> {shown})"), ",").alias("spans"),
        count("lexed"),
    )


def digest(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()
