"""Secret scans: fixed patterns, and sliding-window entropy of unbroken strings.

Base kinds are regular expressions, found leftmost and without overlap per kind;
matches that are too short are dropped after the scan.  The method adds spans of
kind ``entropy``: every unbroken run of key characters is put into a character
class and a window slides along it.  The counts of the window's characters are carried
along: one goes down by the character that leaves, one up by that which enters, and
the Shannon entropy follows from these two.  Windows at or above the limit of the class are joined to
spans; runs that match the allow-list are suppressed.  Base matches are never
suppressed.

Work is linear in the text: runs are walked in pieces of PIECE characters, each with the window - 1
characters that follow it, and places of matches are two-level running sums.

Positions are code points, ends exclusive.

Defined cases: null or empty text has no spans; a run shorter than the window
has no entropy span; equal starts are put in the order of KINDS; repeated rows
give repeated results; an empty table gives an empty table.  ``find_secrets`` replaces a column
named ``secret_spans``; ``redact`` adds none.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

PIECE = 256     # characters of a run that are walked together
KINDS = ("assign", "access", "hex", "entropy")
SPAN = "array<struct<start:int,kind:int,end:int>>"

ASSIGN = ("((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?"
          "([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]+"
# A run of hex digits is one match; shorter ones are dropped anyway, so the
# scan asks for the length at once.
HEX = "[0-9a-f]{24,}"


@dataclass(frozen=True)
class SecretScan:
    window: int = 20
    run: str = "[A-Za-z0-9+/_-]{20,}={0,2}"
    #: entropy in bits that a window must reach, by class of the run; the first
    #: class whose pattern matches the whole run counts
    classes: tuple[tuple[str, float], ...] = (
        ("[0-9_=/+-]+", 9.0),                 # numbers and rulers: never
        ("[0-9a-fA-F]+", 3.0),
        ("[A-Za-z=/_+-]+", 4.05),             # letters only: words look less random than keys
        ("[A-Za-z0-9+/_=-]+", 3.65),
    )
    #: runs that are not secrets
    allowed: tuple[str, ...] = field(default=(
        "(?i).*(?:example|sample|placeholder|changeme|dummy).*",
        "(?:[A-Za-z]{1,18}[-_/])+[A-Za-z0-9]{1,18}",       # slugs and paths of words
        "[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}",     # uuids
    ))


def _running(x: Column) -> Column:
    """total and running sums (out) of a short array of ints."""
    zero = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(x, zero, lambda a, v: F.struct(
        (a["total"] + v).alias("total"), F.concat(a["out"], F.array(a["total"] + v)).alias("out")))


def running_sums(x: Column) -> Column:
    """Running sums of an array of ints: of parts of 64, then of their totals."""
    def join(parts: Column) -> Column:
        return let(_running(F.transform(parts, lambda p: p["total"]))["out"], lambda before: F.flatten(F.transform(
            parts, lambda p, k: F.transform(p["out"], lambda v: v + F.coalesce(F.get(before, k - 1), F.lit(0))))))

    parts = lambda x: F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / 64).cast("int")),
                                  lambda k: _running(F.slice(x, 64 * k + 1, F.lit(64))))
    return let(x, lambda x: F.when(F.size(x) == 0, F.array().cast("array<int>")).otherwise(let(parts(x), join)))


def _matches(text: Column, pattern: str) -> Column:
    """All matches from left to right: array of (start, end, value)."""
    def place(gaps: Column, found: Column) -> Column:
        steps = F.transform(found, lambda m, k: F.length(F.get(gaps, k)) + F.length(m))
        return F.zip_with(running_sums(steps), found, lambda end, m: F.struct(
            (end - F.length(m)).alias("start"), end.alias("end"), m.alias("value")))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), let(F.struct(
        F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")),
        lambda s: place(s["gaps"], s["found"]))).otherwise(none)


def _spans(matches: Column, kind: int) -> Column:
    return F.transform(matches, lambda m: F.struct(
        m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def _weight(n: Column) -> Column:
    return F.when(n > 0, n * F.log2(n)).otherwise(F.lit(0.0))


def _high_windows(piece: Column, limit: Column, w: int) -> Column:
    """Starts of the windows of a piece that reach the limit, from 0."""
    def slide(c: Column, alphabet: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            """The i-th character enters and that of i - w leaves; sum is that of n log2 n."""
            def move(at: Column) -> Column:
                n_old = F.get(a["counts"], at["old"])
                after = a["sum"] + F.coalesce(_weight(n_old - 1) - _weight(n_old), F.lit(0.0))
                counts = F.when(at["old"] == at["new"], a["counts"]).otherwise(F.transform(
                    a["counts"], lambda n, k: F.when(k == at["new"], n + 1).when(k == at["old"], n - 1).otherwise(n)))
                return let(F.struct(after.alias("after"), counts.alias("counts")), lambda x: put(x, F.get(x["counts"], at["new"])))

            def put(x: Column, n: Column) -> Column:
                total = x["after"] + _weight(n) - _weight(n - 1)
                high = (i >= w - 1) & (F.log2(F.lit(float(w))) - total / w >= limit - 1e-9)
                return F.struct(total.alias("sum"), x["counts"].alias("counts"),
                                F.when(high, F.concat(a["high"], F.array(i - w + 1))).otherwise(a["high"]).alias("high"))

            return let(F.struct((F.get(c, i) - 1).alias("new"), F.when(i >= w, F.get(c, i - w) - 1).alias("old")), move)

        zero = F.struct(F.lit(0.0).alias("sum"), F.transform(alphabet, lambda x: F.lit(0)).alias("counts"),
                        F.array().cast("array<int>").alias("high"))
        return F.aggregate(F.sequence(F.lit(0), F.size(c) - 1), zero, step, lambda a: a["high"])

    letters = F.filter(F.split(piece, ""), lambda x: x != "")
    return let(letters, lambda c: let(F.array_distinct(c), lambda alphabet: let(
        F.transform(c, lambda x: F.array_position(alphabet, x).cast("int")), lambda codes: slide(codes, alphabet))))


def _entropy_windows(match: Column, scan: SecretScan) -> Column:
    """Windows of a run that reach the limit of its class, in order."""
    w = scan.window
    limit = F.lit(99.0)
    for pattern, bits in reversed(scan.classes):
        limit = F.when(match["value"].rlike(f"\\A(?:{pattern})\\z"), F.lit(bits)).otherwise(limit)

    def walk(parts: Column, limit: Column) -> Column:
        return F.flatten(F.transform(parts, lambda part, k: F.transform(
            _high_windows(F.concat(part, F.coalesce(F.substring(F.get(parts, k + 1), 1, w - 1), F.lit(""))), limit, w),
            lambda at: match["start"] + PIECE * k + at)))

    allowed = F.lit(False)
    for pattern in scan.allowed:   # groups are repeated possessively: a loop, not a stack, in long runs
        allowed = allowed | match["value"].rlike(f"\\A(?:{pattern})\\z".replace(")+", ")++"))
    none = F.array().cast("array<int>")
    return let(limit, lambda b: F.when(allowed | (b > F.log2(F.lit(float(w)))), none).otherwise(
        let(F.regexp_extract_all(match["value"], F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), lambda parts: walk(parts, b))))


def _islands(starts: Column, w: int) -> Column:
    """Windows that overlap or touch, joined to spans (windows of two runs never touch)."""
    def join(s: Column) -> Column:
        first = F.filter(s, lambda x, k: (k == 0) | (x - F.get(s, k - 1) > w))
        last = F.filter(s, lambda x, k: (k == F.size(s) - 1) | (F.get(s, k + 1) - x > w))
        return F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), F.lit(3).alias("kind"), (b + w).alias("end")))
    return let(starts, join)


def secret_spans(text: Column, scan: SecretScan = SecretScan()) -> Column:
    """Array of (start, kind number, end) in order."""
    t = F.coalesce(text, F.lit(""))
    assign = F.filter(_matches(t, ASSIGN), lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 2)) >= 6)
    access = F.filter(_matches(t, ACCESS), lambda m: F.length(m["value"]) >= 20)
    runs = _matches(t, scan.run)
    entropy = _islands(F.flatten(F.transform(runs, lambda m: _entropy_windows(m, scan))), scan.window)
    every = F.concat(_spans(assign, 0), _spans(access, 1), _spans(_matches(t, HEX), 2), entropy)
    return F.sort_array(every.cast(SPAN))


def find_secrets(documents: DataFrame, text: str = "text", scan: SecretScan = SecretScan()) -> DataFrame:
    """``documents`` with ``secret_spans``: array of (start, kind number, end) in order."""
    return documents.withColumn("secret_spans", secret_spans(F.col(text), scan))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_report(documents: DataFrame, scan: SecretScan = SecretScan()) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans."""
    rows = find_secrets(documents.select("doc_id", "text"), scan=scan)
    s = F.col("secret_spans")
    count = lambda k: F.size(F.filter(s, lambda x: x["kind"] == k)).cast("long")
    return rows.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spans_text(F.filter(s, lambda x: x["kind"] < 3)), 256).alias("base_sha256"),
        spans_text(s).alias("spans"))


def redact(documents: DataFrame, text: str = "text", mark: str = "[SECRET]",
           scan: SecretScan = SecretScan()) -> DataFrame:
    """``documents`` with every span replaced by ``mark``; touching spans get one mark."""
    def replace(t: Column, spans: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def step(a: Column, s: Column) -> Column:
            return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(
                (s["start"] < a["at"]) | ((s["start"] == a["at"]) & (a["at"] > 0)), a["out"]).otherwise(F.concat(
                    a["out"], F.substring(t, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).alias("out"))
        return F.aggregate(spans, zero, step, lambda a: F.concat(
            a["out"], F.substring(t, a["at"] + 1, F.length(t))))

    return documents.withColumn(text, let(secret_spans(F.col(text), scan), lambda s: F.when(
        F.size(s) > 0, replace(F.col(text), s)).otherwise(F.col(text))))
