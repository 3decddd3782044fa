r"""Fill-in-middle transformation by one counted-quantifier match per text.

A text is a sequence of units (runs of ASCII letters, or one other character).
``regexp_count`` gives their number n; two cut points 0 <= a <= b <= n come from a
digest of the document's id.  A pattern built for the row,

    \A(unit{a}+)(unit{b-a}+)(.*)\z

captures prefix, middle and suffix in one match, and the replacement writes them in
the order of the row's form.  Counted groups are possessive: a unit can be matched in
one way only, so nothing is lost, and the engine walks the units in a loop instead
of keeping one frame of its stack a unit; work is linear in the length of the text.

Forms: ``psm`` is <P>prefix<S>suffix<M>middle, ``spm`` is <S>suffix<P>prefix<M>middle,
``plain`` is the text itself.  A text that holds one of the marks stays plain, so the
marks of an output are where they were written (a mark begins with its only "<" and
ends with its only ">", so none can arise across a seam) and ``restored`` takes the
text back from output and form alone.

Defined cases: a null text counts as the empty one, and empty texts are plain with
n = 0; a null doc_id draws like the empty decimal; rows that repeat an id are drawn
alike; an empty table gives an empty table; all columns of the input are kept in the
struct ``row``, so no name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One unit.  Runs of letters are possessive, so a run is never cut.
UNIT = "(?:[A-Za-z]++|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class FillMiddle:
    percent: int = 90       # of texts that are transformed
    spm_percent: int = 20   # of those, in suffix-prefix-middle order
    seed: int = 1


def _draw(digest: Column, k: int) -> Column:
    """The k-th group of eight hexadecimal digits as a number."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _between(x: Column, left: str, right: str) -> Column:
    """What stands between two marks, by places: both are found once, from the left."""
    start = F.instr(x, left) + 3
    return x.substr(start, F.instr(x, right) - start)


def _after(x: Column, mark: str) -> Column:
    return x.substr(F.instr(x, mark) + 3, F.length(x))


def restored(output: Column, form: Column) -> Column:
    """The text, from output and form."""
    middle = _after(output, MIDDLE)
    psm = F.concat(_between(output, PREFIX, SUFFIX), middle, _between(output, SUFFIX, MIDDLE))
    spm = F.concat(_between(output, PREFIX, MIDDLE), middle, _between(output, SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_middle(docs: DataFrame, rule: FillMiddle = FillMiddle()) -> DataFrame:
    """row (all columns of the input), n, form, output for every row of (doc_id, text)."""
    text, digest = F.col("t"), F.col("digest")
    rows = docs.select(
        F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("t"),
        F.sha2(F.concat(F.lit(f"{rule.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256).alias("digest"))
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    rows = rows.select(
        "row", "t", "digest", F.regexp_count(text, F.lit(UNIT)).cast("long").alias("n"),
        F.when((text == "") | marked | (_draw(digest, 2) % 100 >= rule.percent), "plain")
        .when(_draw(digest, 3) % 100 < rule.spm_percent, "spm").otherwise("psm").alias("form"))
    x, y = _draw(digest, 0) % (F.col("n") + 1), _draw(digest, 1) % (F.col("n") + 1)
    rows = rows.select("row", "t", "n", "form", F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    pattern = F.format_string(rf"(?s)\A({UNIT}{{%d}}+)({UNIT}{{%d}}+)(.*)\z", F.col("a"), F.col("b") - F.col("a"))
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    output = F.when(F.col("form") == "plain", text).otherwise(F.regexp_replace(text, pattern, order))
    return rows.select("row", "n", "form", output.alias("output"))


def middle_digests(docs: DataFrame, rule: FillMiddle = FillMiddle()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    out, form = F.col("output"), F.col("form")
    ends = F.when(form == "psm", F.instr(out, SUFFIX)).when(form == "spm", F.instr(out, MIDDLE))
    starts = F.when(form == "psm", F.instr(out, PREFIX)).when(form == "spm", F.instr(out, PREFIX))
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    return fill_middle(docs.select("doc_id", "text"), rule).select(
        F.col("row.doc_id").alias("doc_id"), "n", "form", (ends - starts - 3).cast("long").alias("prefix_chars"),
        F.when(form != "plain", F.length(out) - F.instr(out, MIDDLE) - 2).cast("long").alias("middle_chars"),
        digest(out).alias("output_sha256"), digest(restored(out, form)).alias("restored_sha256"))


#: The same rows in SQL: tokens as a list, slices joined again.  The text of a row
#: comes back from its three slices.
SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w FROM documents),
h AS (
  SELECT doc_id, t, w, len(w) AS n, [CAST('0x' || substr(x, 8 * i + 1, 8) AS BIGINT) FOR i IN range(4)] AS h FROM t),
c AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
         WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, array_to_string(w[1:a], '') AS p, array_to_string(w[a + 1:b], '') AS m, array_to_string(w[b + 1:n], '') AS s FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""
