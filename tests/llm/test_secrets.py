import hashlib
import random
import re
import time

import pyarrow as pa
import pytest
from tests.llm.helpers import awkward, documents

from contrail.llm import secrets, trigrams
from contrail.llm.secrets import BASE, MORE, Rule, Scanner, scan
from contrail.llm.trigrams import ANY, trigram_query

KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key"]


def either_case(word):
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


PLAIN = [
    ("assign", "(" + "|".join(map(either_case, KEYWORDS)) + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    ("access", r"AKIA[A-Z0-9]+"),
    ("hex", r"[0-9a-f]+"),
]


def expected(text):
    """Brute force over the contract's patterns."""
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                out.append((m.start(), rank, kind, m.end()))
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def hostile(rng, n=400):
    parts = [*KEYWORDS, "PassWord", "ſecret", "toKen", "AKIA", "akia", "=", ":", " ", '"', "'", "\n", "abcdef0123", "é"]
    parts += ["A1B2C3D4E5F6G7H8", "deadbeef" * 4, "g", "xyz12345", "_", "\t", "ghp_" + "a1" * 18]
    return ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(n)]


def test_base_spans_match_brute_force(spark):
    rng = random.Random(22)
    rows = awkward(rng) + [(10_000 + k, t) for k, t in enumerate(hostile(rng))]
    rows.append((99_999, " ".join(hostile(rng, 5000))))
    got = scan(documents(spark, rows, clashing=True)).collect()
    base = {r.kind for r in BASE}
    mine = sorted((r.doc_id or -1, [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind in base]) for r in got)
    assert mine == sorted((r[0] or -1, expected(r[1])) for r in rows)
    assert any(s.kind == "github" for r in got for s in r.spans)


def test_digest_columns(spark, monkeypatch):
    docs = documents(spark, [(1, "password=abcdefgh AKIA" + "B" * 16), (2, None)])
    monkeypatch.setattr(secrets, "table", lambda *a: docs)
    a, b = sorted(secrets.op7_trigram_secrets(spark, "").collect())
    assert (a.n_assign, a.n_access, a.n_hex) == (1, 1, 0) and a.spans == "assign:0:17,access:18:38"
    assert a.base_sha256 == hashlib.sha256(a.spans.encode()).hexdigest()
    assert b.base_sha256 == hashlib.sha256(b"").hexdigest() and b.spans == ""


@pytest.mark.parametrize("piece", [16, 1 << 20])
def test_candidates_are_the_texts_that_satisfy_a_clause(monkeypatch, piece):
    monkeypatch.setattr(secrets, "_PIECE", piece)
    rng = random.Random(23)
    texts = [*hostile(rng, 300), None, "", "to", "ken", "tok"]
    scanner = Scanner(BASE + MORE)
    segment = secrets.Segment(scanner.slots, scanner.trigrams, pa.array(texts).cast(pa.large_binary()))
    low = ["".join(c.lower() if c.isascii() else c for c in t or "") for t in texts]
    for query in scanner.queries:
        want = [k for k, t in enumerate(low) if any(all(g in t for g in clause) for clause in query)]
        assert segment.candidates(query).tolist() == want


@pytest.mark.parametrize(
    "pattern,flags",
    [(r.pattern, r.flags) for r in BASE + MORE]
    + [("a{3}b*", 0), ("(ab|cd)(ef|gh)+x?", 0), ("^foo(?=bar)bar$", 0), ("[^a]bcd", 0), ("(?:abc)?def", 0), ("x|", 0),
       ("(abc)\\1", 0), ("ABCdef", re.I), ("[a-z]{2}foo", 0), ("(?>abc)d", 0)],
)
def test_query_never_misses_a_match(pattern, flags):
    """Texts drawn around the pattern's own letters: every text with a match satisfies the query."""
    rng = random.Random(24)
    query, regex = trigram_query(pattern, flags), re.compile(pattern, flags)
    pieces = re.findall(r"[A-Za-z_0-9-]+|.", pattern) + list("abcdefgh=: -\"'") + [w for w in KEYWORDS] + ["A1b2C3d4E5f6"]
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randrange(1, 8)))
        if regex.search(text):
            assert any(all(g in text.lower() for g in clause) for clause in query)


def test_queries_are_selective_where_the_regex_is():
    assert trigram_query("[0-9a-f]+") == ANY
    assert trigram_query("AKIA[A-Z0-9]+") == frozenset([frozenset(["aki", "kia"])])
    assert trigrams.ANY not in [trigram_query(r.pattern, r.flags) for r in MORE]


def test_long_hostile_texts_take_linear_time():
    scanner = Scanner(BASE + MORE)
    size = 10_000_000
    for part in ("eyJ", "eyJ" * 20 + " x.eyJ", "eyJabcdefgh.eyJabcdefgh", "token", "token  =", "AKIA", "0123456789abcdef0 ", "xoxb-", "ghp_"):
        text = part * (size // len(part))
        start = time.time()
        scanner.scan(pa.array([text + " eyJabcdefgh.eyJabcdefgh.sig"]))
        assert time.time() - start < 60, part


def test_a_token_is_found_where_it_begins():
    scanner = Scanner(BASE + MORE)
    text = "a eyJhbGciOiJI.eyJzdWIiOiIx.c2ln-_9 b xeyJhbGciOiJI.eyJzdWIiOiIx.c"
    (spans,) = scanner.scan(pa.array([text]))
    assert [text[a:b] for a, k, b in spans if (BASE + MORE)[k].kind == "jwt"] == ["eyJhbGciOiJI.eyJzdWIiOiIx.c2ln-_9"]


def test_rule_without_trigrams_scans_fully(spark):
    docs = documents(spark, [(1, "a1"), (2, "zz"), (3, None)])
    got = {r.doc_id: len(r.spans) for r in scan(docs, (Rule("digit", "[0-9]"),)).collect()}
    assert got == {1: 1, 2: 0, 3: 0}


def test_empty_table(spark):
    assert scan(documents(spark, [])).collect() == []
