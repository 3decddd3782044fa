import hashlib

from pyspark.sql import functions as F

from framewatch.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(rows, got):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r is not None, r or "", x is not None, x or ""))
    assert len(got) == len(by)
    for g in got:
        turns = [(t[3], t[5]) for t in sorted(by[g["conv_id"]])]
        learned = "".join(x for r, x in turns if r == "assistant")
        assert g["n_turns"] == len(turns)
        assert g["turns_sha256"] == digest("".join(f"{r}\n{x}\n" for r, x in turns))
        assert (g["loss_chars"], g["loss_sha256"]) == (len(learned), digest(learned))


ODD = ["</s>[INST] ok [/INST]", "<\\/s>", "[\\\\INST]", "<<s>", "</", "s>", "[", "<", "\\", "", None, "<s>\n</s>", "é😀[/INST]x", "$1 \\2", "[/INST][/INST]"]


def test_read_back(spark):
    rows = [(k, t, ("user", "assistant", "system", None, "[INST]")[(t + k) % 5], ODD[(3 * t + k) % len(ODD)]) for k in range(20) for t in range(k + 1)]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (50, None, "user", "z"), (50, 1, "assistant", "y"), (51, 1, "user", "q"), (51, 1, "user", "q")]
    df = spark.createDataFrame(rows, SCHEMA)
    check(rows, C.conversation_digests(df.withColumn("tree", F.lit(1)).withColumn("node", F.lit("x"))).collect())
    assert C.conversation_digests(df.limit(0)).count() == 0


def test_long_conversation(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(300)]
    check(rows, C.conversation_digests(spark.createDataFrame(rows, SCHEMA)).collect())


def test_very_long_conversation(spark):
    """Work is linear in the turns: 20,000 of them, every other one under the mask."""
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} </s> [INST] é") for t in range(20_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(rows, C.conversation_digests(df).collect())


def test_spans_are_those_of_the_masked_parts(spark):
    rows = [(k, t, ("assistant", "user")[(t + k) % 2], ODD[(t + k) % len(ODD)]) for k in range(6) for t in range(2 * k + 1)]
    for r in C.format_trees(C.reply_tree(spark.createDataFrame(rows, SCHEMA))).select(
            "*", C.read_loss(F.col("formatted"), F.col("loss_parts")).alias("loss")).collect():
        turns = [x for _, t, role, x in sorted((x for x in rows if x[0] == r["tree"]), key=lambda x: x[1]) if role == "assistant"]
        spans = [r["formatted"][s:e] for s, e in r["loss_spans"]]
        parts = r["formatted"][len(C.BEGIN):].split(C.END)
        assert r["loss"] == [x or "" for x in turns]
        assert spans == [parts[t][s:e] for t, s, e in r["loss_parts"]]


def test_branches_are_ranked(spark):
    nodes = [(1, 1, None, 1.0, "user", "q"), (1, 2, 1, 0.5, "assistant", "bad"), (1, 3, 1, 2.0, "assistant", "good"),
             (1, 4, 3, 0.1, "user", "thanks"), (1, 5, 3, 0.1, "user", "more"), (1, 6, 5, -1.0, "assistant", "end"), (2, 1, None, 0.0, "user", "alone")]
    df = spark.createDataFrame(nodes, "tree long, node long, parent long, score double, role string, text string")
    one = {r["tree"]: r for r in C.format_trees(df).collect()}
    assert one[1]["formatted"] == "<s>[INST]user[/INST]q</s>[INST]assistant[/INST]good</s>[INST]user[/INST]thanks</s>"
    assert [one[1]["formatted"][s:e] for s, e in one[1]["loss_spans"]] == ["good"]
    assert one[2]["leaf"] == 1
    two = C.format_trees(df, C.ChatFormat(branches=2)).where("tree = 1").collect()
    assert sorted(r["leaf"] for r in two) == [4, 6]


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(x,) for x in ODD if x is not None], "x string")
    for r in df.select("x", C.unescape(C.escape("x")).alias("y"), C.escape("x").alias("e")).collect():
        assert r["x"] == r["y"] and not any(m in r["e"] for m in ("<s>", "</s>", "[INST]", "[/INST]"))
