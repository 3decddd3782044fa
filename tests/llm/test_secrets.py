import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from framewatch.llm import secret_scan as S

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def entropy(text, scan=S.SecretScan()):
    out = []
    for m in re.finditer(scan.run, text):
        limit = next(bits for p, bits in scan.classes if re.fullmatch(p, m[0]))
        if any(re.fullmatch(p, m[0]) for p in scan.allowed):
            continue
        spans = []
        for k in range(len(m[0]) - scan.window + 1):
            w = m[0][k:k + scan.window]
            h = -sum(w.count(c) / len(w) * math.log2(w.count(c) / len(w)) for c in set(w))
            if h >= limit - 1e-9:
                if spans and spans[-1][2] >= m.start() + k:
                    spans[-1] = (spans[-1][0], 3, m.start() + k + scan.window)
                else:
                    spans.append((m.start() + k, 3, m.start() + k + scan.window))
        out += spans
    return out


def joined(spans):
    return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def odd_texts():
    draw = random.Random(5)
    some = lambda chars, n: "".join(draw.choice(chars) for _ in range(n))
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = ["", "secret:token:abcdef", "Password = 'hunter22' x", "API_KEY:\"abc.def\" apikey=short ApiKey  =  123456", "token=token=abcdefgh",
             "AKIAAKIA" + "B" * 14 + " AKIAABC", "é😀 token: zzzzzz 😀 " + "a1b2" * 6, "deadbeef" * 2 + " " + "0" * 24 + "g" + "f" * 23,
             "ſecret=abcdef toKen=abcdef", "password=" + "x" * 5, "id " + "abcdefghijklmnopqrstuvwxyz" * 2, "path/to/some/long/file-name_here",
             "550e8400-e29b-41d4-a716-446655440000", "example" + some(b64, 40), "-" * 60, "x" * 500 + some(b64, 300)]
    texts += [" ".join(some(b64[:-2] if draw.random() < 0.5 else "0123456789abcdef", draw.randint(15, 70)) for _ in range(5)) for _ in range(60)]
    texts += ["".join(draw.choice(["token", "secret", "=", ":", " ", '"', "AKIA", "abc123", "é", "f00"]) for _ in range(40)) for _ in range(150)]
    return texts


def test_same_as_plain_python(make_docs):
    texts = odd_texts()
    for r in S.scan_report(make_docs(texts)).collect():
        t = texts[r["doc_id"]]
        b = base(t)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for _, k, _ in b) for n in range(3)], t
        assert r["base_sha256"] == hashlib.sha256(joined(b).encode()).hexdigest(), t
        assert r["spans"] == joined(b + entropy(t)), t


def test_redaction(make_docs):
    texts = odd_texts()
    docs = make_docs(texts).withColumn("secret_spans", F.lit(1))
    for r in S.redact(docs).collect():
        t, out, at = texts[r["doc_id"]], "", 0
        assert r["secret_spans"] == 1
        for a, _, b in sorted(base(t) + entropy(t)):
            if a < at or (a == at and at > 0):
                at = max(at, b)
                continue
            out, at = out + t[at:a] + "[SECRET]", b
        assert r["text"] == out + t[at:], t


def test_defined_cases(edge_docs):
    rows = S.scan_report(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert {r["spans"] for r in rows} == {""} and {r["base_sha256"] for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert S.scan_report(edge_docs.limit(0)).count() == 0
    assert sorted(map(repr, (r["text"] for r in S.redact(edge_docs).collect()))) == sorted(map(repr, (r["text"] for r in edge_docs.collect())))


def test_no_python_in_the_plan(make_docs):
    assert not re.search("Python|Pandas|Arrow", S.scan_report(make_docs(["a"]))._jdf.queryExecution().toString())


def test_long_runs_and_many_matches(make_docs):
    """An unbroken run of 150,000 characters, a hundred thousand matches in one text, runs around
    the length of a piece: linear work, and the spans of the plain version."""
    draw = random.Random(8)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    some = lambda chars, n: "".join(draw.choices(chars, k=n))
    texts = ["data:" + "".join(some(b64, 700) + draw.choice("xyz") * 300 for _ in range(150)), "token=abcdef " * 100_000,
             "ab/" * 300_000 + "z"]
    texts += [some(b64[:n], k) for n in (16, 62, 64) for k in (19, 20, 255, 256, 257, 274, 275, 276, 512, 531, 532, 800)]
    for r in S.scan_report(make_docs(texts)).collect():
        t = texts[r["doc_id"]]
        assert r["spans"] == joined(base(t) + entropy(t)), len(t)
