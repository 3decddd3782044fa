import hashlib
import random
import re

from pyspark.sql import functions as F

from framewatch.llm import fill_middle as M

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def brute(i, text):
    text = text or ""
    w = UNIT.findall(text)
    n = len(w)
    x = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return i, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def compare(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = sorted(((*(w := brute(*r))[:5], sha(w[5]), sha(r[1] or "")) for r in rows), key=repr)
    assert sorted((tuple(r) for r in M.middle_digests(docs).collect()), key=repr) == want
    out = M.fill_middle(docs).select("row.doc_id", "output").collect()
    assert sorted(map(tuple, out), key=repr) == sorted(((r[0], brute(*r)[5]) for r in rows), key=repr)


def test_same_as_plain_python(spark):
    compare(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_defined_cases(spark, edge_docs):
    compare(edge_docs)
    clash = edge_docs.withColumns({c: F.lit("?") for c in ("t", "n", "form", "digest", "output", "row", "a", "b")})
    compare(clash)
    assert M.fill_middle(clash).select("row.*").columns == clash.columns
    assert M.middle_digests(edge_docs.limit(0)).count() == 0


def test_marks_and_seams(spark, make_docs):
    """Texts full of parts of marks, $ and backslashes: the seams hold no mark of their own."""
    draw = random.Random(3)
    parts = ["<", ">", "P", "S", "M", "<P", "S>", "$1", "\\", "\\1", "\n", "\r\n", "é", "\U0001F600", "ab", " ", "<M", "\x00", " "]
    compare(make_docs(["".join(draw.choices(parts, k=draw.randrange(12))) for _ in range(3000)]))


def test_long_texts(spark, make_docs):
    """A million units, and one unit of a million letters: no stack, linear time."""
    compare(make_docs(["a." * 500_000, "x" * 1_000_000, "\U0001F600 " * 200_000, "word, " * 100_000] * 3))


def test_no_python_in_the_plan(make_docs):
    plan = M.middle_digests(make_docs(["a b"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
