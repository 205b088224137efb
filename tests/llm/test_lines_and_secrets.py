import hashlib
import random
import re

import pandas as pd
import pytest

from quire.llm import line_dedup, secrets_scan
from tests.llm.rows import docs, empty, odd


def slow_lines(rows, threshold=0.8, k=8):
    """{doc_id: removed line numbers}, comparing every pair of distinct keys."""
    first, where = {}, {}
    for d, t in sorted(rows):
        for n, line in enumerate((t or "").lower().split("\n")):
            if key := line.strip():
                first.setdefault(key, (d, n))
                where[(d, n)] = key
    keys = list(first)
    sets = [{x[i : i + k] for i in range(len(x) - k + 1)} for x in keys]
    root = list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    has = {}
    for i, s in enumerate(sets):
        seen = {}
        for g in s:
            for j in has.setdefault(g, []):
                seen[j] = seen.get(j, 0) + 1
            has[g].append(i)
        for j, both in seen.items():
            if both / (len(s) + len(sets[j]) - both) >= threshold:
                root[find(i)] = find(j)
    best = {}
    for i, key in enumerate(keys):
        best[find(i)] = min(best.get(find(i), first[key]), first[key])
    at = {key: i for i, key in enumerate(keys)}
    out = {d: [] for d, _ in rows}
    for (d, n), key in where.items():
        if (d, n) != best[find(at[key])]:
            out[d].append(n)
    return {d: sorted(x) for d, x in out.items()}


def test_lines_against_brute_force(spark, medium):
    got = line_dedup.op10_line_dedup(spark, medium).toPandas()
    d = pd.read_parquet(f"{medium}/documents.parquet")
    texts = dict(zip(d.doc_id, d.text, strict=True))
    want = slow_lines(list(texts.items()))
    assert len(got) == len(d)
    wrong = 0
    for r in got.itertuples():
        gone = [int(x) for x in r.removed_lines.split(",") if x]
        wrong += len(set(gone) ^ set(want[r.doc_id]))
        lines = texts[r.doc_id].split("\n")
        rest = "\n".join(x for n, x in enumerate(lines) if n not in set(gone))
        assert (r.n_lines, r.n_removed, r.kept_sha256) == (len(lines), len(gone), hashlib.sha256(rest.encode()).hexdigest())
    assert wrong <= 0.005 * sum(map(len, want.values()))


def test_lines_in_dense_groups(spark):
    rng = random.Random(1)
    stock = [" ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(40)) for _ in range(4)]
    texts = []
    for i in range(300):
        words = stock[i % 4].split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(40)] = f"x{rng.randrange(10**6)}"
        texts.append(f"own line {i} {rng.random()} {rng.random()}\n" + " ".join(words) + "\n\nshort")
    got = {r.doc_id: r.gone for r in line_dedup.line_dedup(docs(spark, texts)).collect()}
    want = slow_lines(list(enumerate(texts)))
    assert sum(len(set(got[d]) ^ set(want[d])) for d in got) <= 3
    assert sum(3 in g for g in got.values()) == 299 and not any(2 in g for g in got.values())


def test_lines_odd_rows(spark):
    got = line_dedup.line_dedup(odd(spark), bits=1 << 16).collect()
    assert len(got) == 11
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[7][0].text == "" and by[6][0].n_removed == 0
    assert sorted((r.text, r.n_removed) for r in by[4]) == [("", 1), ("", 1)]  # a null doc_id comes first
    assert [r.text for r in by[None]].count("one") == 1
    assert by[3][0].n_lines == 2
    assert line_dedup.line_dedup(empty(spark)).count() == 0


def slow_base(text):
    out = []
    for kind, pattern, ok in (
        ("assign", r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ):
        out += [(m.start(), ["assign", "access", "hex"].index(kind), f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if ok(m)]
    return [x[2] for x in sorted(out)]


def test_secrets_against_brute_force(spark, medium):
    got = secrets_scan.op6_secrets(spark, medium).toPandas().set_index("doc_id")
    d = pd.read_parquet(f"{medium}/documents.parquet")
    assert len(got) == len(d)
    for i, t in zip(d.doc_id, d.text, strict=True):
        want, r = slow_base(t), got.loc[i]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]
        assert set(want) <= set(r.spans.split(",")) | {""}
    assert got[["n_assign", "n_hex"]].sum().min() > 0


CODE = """
user = "admin"
part_a = "zX9!kk2QQ"
part_b = 'Qw7-77aa'
db["password"] = part_a + part_b
client_secret: ab12CD34ef56
const authToken = `k3y-VALUE-99-xyz`;
password = "changeme"
path = "/usr/local/lib/thing12"
DSN='postgres://u:p4ssW0rd@host/db'
key: value
"""


def test_lexer_propagates_constants_and_scores_names():
    hits = secrets_scan.lexed(CODE)
    assert {(name, CODE[a:b]) for a, b, name, _, _ in hits} == {
        ('db["password"]', "zX9!kk2QQ"), ('db["password"]', "Qw7-77aa"), ("client_secret", "ab12CD34ef56"), ("authToken", "k3y-VALUE-99-xyz"), ("DSN", "postgres://u:p4ssW0rd@host/db"),
    }
    base, every = secrets_scan.scan(CODE)
    assert set(base) <= set(every) and any(k == "lexed" for _, _, k in every)


@pytest.mark.parametrize("text", ["a" * 300_000 + "=", "a." * 100_000 + "=b", 'x = "' * 20_000, "password=" * 20_000, "= : " * 50_000, "é" * 1000 + " token=abcdef", "ſecret=abcdef", "toKen=abcdef"])
def test_secrets_in_hard_texts(text):
    base, every = secrets_scan.scan(text)
    assert [f"{k}:{s}:{e}" for s, e, k in base] == slow_base(text) and set(base) <= set(every)


def test_secrets_odd_rows(spark):
    got = secrets_scan.secrets(odd(spark)).collect()
    assert len(got) == 11 and not any(r.found for r in got)
    assert secrets_scan.secrets(empty(spark)).count() == 0
    clean = secrets_scan.redacted(docs(spark, ["é password=hunter22 end", None]))
    assert [r.text for r in clean.orderBy("doc_id").collect()] == ["é [SECRET] end", None] and clean.columns == odd(spark).columns


NESTED = """
{
  "database": {"user": "admin", "password": "Zx81-kkQ2-pp"},
  "auth": {
    "value": "n0t-A-word-77x"
  },
  "plain": {"value": "n0t-A-word-78x"}
}
credentials:
  first: tR4-99-qwLpZ
  - second: "tR5-99-qwLpZ"
other: tR6-99-qwLpZ
[api token]
live = sk9x8w7v6u5t
[paths]
live = /usr/lib/x9x8w7v6
db_password: str = "Ann0-tated-11"
signing_key: Optional[str] = 'Ann1-tated-11'
const clientSecret: string | null = `Ann2-tated-11`
private_key = '''line-1-Ab9
'''
"""


def test_lexer_reads_nesting_types_and_long_quotes():
    got = {(name, literal) for _, _, name, literal, _ in secrets_scan.lexed(NESTED)}
    assert {x for _, x in got} == {
        "Zx81-kkQ2-pp", "n0t-A-word-77x", "tR4-99-qwLpZ", "tR5-99-qwLpZ", "sk9x8w7v6u5t", "Ann0-tated-11", "Ann1-tated-11", "Ann2-tated-11",
    }
    assert ("db_password", "Ann0-tated-11") in got and ("clientSecret", "Ann2-tated-11") in got
    assert {x for _, _, _, x, _ in secrets_scan.lexed("a = \"\"\"q7W-e8R\n\"\"\"\npassword = \"\"\"q7W-e8R-t9Y\"\"\" + 1")} == {"q7W-e8R-t9Y"}


def test_long_constants_are_propagated():
    """A name keeps its latest value however long that is, and doubling doesn't grow what is held."""
    long = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(5_000))
    hits = secrets_scan.lexed(f'part = "shrt-1-Literal"\npart = "{long}"\npassword = part\n')
    assert [(name, x) for _, _, name, x, _ in hits] == [("password", long)]
    doubled = 'a = "xY7-seed-Q9"\n' + "a = a + a\n" * 200 + "secret = a\n"
    assert [(name, x) for _, _, name, x, _ in secrets_scan.lexed(doubled)] == [("secret", "xY7-seed-Q9")]
    chain = 'p0 = "aB3-x"\n' + "".join(f'p{i} = p{i - 1} + "k{i}-Z"\n' for i in range(1, 3000)) + "token = p2999"
    assert len(secrets_scan.lexed(chain)) == 3000


def slow_pairs(text, threshold=0.5):
    """Spans of one-line pairs of a plain name and one quoted or bare literal, told line by line without the lexer's patterns."""
    out = set()
    for m in re.finditer(r"[^\n]*\n?", text):
        line = m[0].rstrip("\n")
        hit = re.fullmatch(r"(\w+) = (?:\"([^\"\\\\]*)\"|'([^'\\\\]*)'|([A-Za-z0-9+/_.-]{6,}))", line)
        if hit:
            k = next(k for k in (2, 3, 4) if hit[k] is not None)
            if secrets_scan.name_score(hit[1]) >= 0.5 and secrets_scan.name_score(hit[1]) * secrets_scan.literal_score(hit[k]) >= threshold:
                out.add((m.start() + hit.start(k), m.start() + hit.end(k)))
    return out


def test_lexer_against_plain_lines():
    rng = random.Random(2)
    names = ["password", "user", "api_key", "color", "authToken", "size", "client_secret", "note_text"]
    make = lambda: "".join(rng.choice("abcXYZ0189-_/.") for _ in range(rng.randrange(1, 24)))
    for _ in range(300):
        lines = [f"{rng.choice(names)} = {q}{make()}{q}" for q in rng.choices(['"', "'", ""], k=6)]
        text = "\n".join(lines)
        got = {(a, b) for a, b, *_ in secrets_scan.lexed(text)}
        assert slow_pairs(text) <= got
        assert all(any(a <= x and y <= b for a, b in slow_pairs(text)) or re.search(r"= [^\"'\n]{0,5}$|= \W", "\n".join(lines), re.M) or text[x:y] in names for x, y in got)
