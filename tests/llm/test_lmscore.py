import collections
import math
import os
import pathlib
import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from framewatch.llm import lmscore as M


def test_probabilities_sum_to_one_over_the_vocabulary():
    net = M.WindowNetwork(vocabulary=50, classes=8, single=3, width=5)
    counts = np.arange(50)[::-1] ** 2
    kind, share = M.make_classes(counts, net)
    w = M.start_weights(net)
    logits = M.forward(w, M._sides(np.arange(20), np.arange(20), net))[1]
    whole = np.exp(logits[:, kind] + share).sum(axis=1)
    assert whole == pytest.approx(np.ones(20), rel=1e-4)
    assert len(set(kind[:3])) == 3


def test_texts_are_scored_apart():
    """Scoring texts in one row is scoring each position by its own window."""
    net = M.WindowNetwork(vocabulary=50, classes=8, single=3, width=5, batch=7)
    draw = np.random.default_rng(2)
    kind, share = M.make_classes(draw.integers(0, 90, 50), net)
    w = M.start_weights(net)
    texts = [draw.integers(0, 50, n).astype(np.uint16) for n in (0, 1, 5, 0, 33, 2)]
    want = []
    for t in texts:
        at = np.arange(len(t))
        want.append((M.forward(w, M._sides(t, at, net))[1][at, kind[t]] + share[t]).sum() if len(t) else 0.0)
    assert M.score(M.by_place(w), w, kind, share, texts, net) == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_training_lowers_the_loss():
    net = M.WindowNetwork(vocabulary=20, classes=6, single=4, width=8)
    ids = np.tile(np.arange(10), 200).astype(np.uint16)
    kind, _ = M.make_classes(np.bincount(ids, minlength=20), net)
    w = M.start_weights(net)
    g = {k: np.full_like(v, 1e-4) for k, v in w.items()}
    at = np.arange(len(ids))
    loss = lambda: -M.forward(w, M._sides(ids, at, net))[1][at, kind[ids]].mean()
    before = loss()
    for _ in range(20):
        M.train(w, g, M._sides(ids, at, net), kind[ids], 0.05)
    assert loss() < 0.3 * before


def test_word_order_counts(spark):
    """Documents score higher than the same words in another order, unseen in training."""
    draw = np.random.default_rng(1)
    nouns, verbs = [f"n{i}" for i in range(30)], [f"v{i}" for i in range(30)]
    text = lambda: " ".join(x for _ in range(60) for x in ("the", draw.choice(nouns), "will", draw.choice(verbs), "a", draw.choice(nouns), "."))
    train = spark.createDataFrame([(i, text()) for i in range(200)], "doc_id long, text string")
    fresh = [text() for _ in range(20)]
    mixed = [" ".join(draw.permutation(t.split())) for t in fresh]
    rows = [(i, t) for i, t in enumerate(fresh)] + [(100 + i, t) for i, t in enumerate(mixed)]
    got = {r["doc_id"]: r["mean_log_likelihood"] for r in M.pseudo_likelihood(
        spark.createDataFrame(rows, "doc_id long, text string"), M.WindowNetwork(batch=256), training=train).collect()}
    assert all(got[i] > got[100 + i] + 0.3 for i in range(20))


def test_defined_cases(edge_docs):
    rows = M.pseudo_likelihood(edge_docs.withColumn("tokens", F.lit(1))).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        assert (r["n_tokens"] == 0) == (r["mean_log_likelihood"] is None) and (r["n_tokens"] > 0) == (r["log_likelihood"] < 0)
    same = [r["log_likelihood"] for r in rows if r["n_tokens"] == 96]
    assert len(same) == 4 and same == pytest.approx(same[:1] * 4, rel=1e-5)
    assert M.pseudo_likelihood(edge_docs.limit(0)).count() == 0


def test_every_position_is_trained_once(spark):
    """Also those of documents of few words, which no stride of eight may skip."""
    for net in (M.WindowNetwork(), M.WindowNetwork(mask=5, rounds=3)):
        for n in range(30):
            assert sorted(np.concatenate([M.hidden_in(n, k, net) for k in range(net.rounds)]).tolist()) == list(range(n))
    pairs = [f"a{i % 8} b{i % 8}" for i in range(4000)]
    train = spark.createDataFrame(list(enumerate(pairs)), "doc_id long, text string").coalesce(1)
    rows = [(i, f"a{i} b{i}") for i in range(8)] + [(100 + i, f"a{i} b{(i + 3) % 8}") for i in range(8)]
    got = {r["doc_id"]: r["mean_log_likelihood"] for r in M.pseudo_likelihood(
        spark.createDataFrame(rows, "doc_id long, text string"), M.WindowNetwork(batch=64), training=train).collect()}
    assert all(got[i] > got[100 + i] + 0.3 for i in range(8))


def test_words_of_one_class_are_told_apart(spark):
    """With many more words than classes, exchanged words of like frequency score lower."""
    draw = np.random.default_rng(4)
    text = lambda swap=0: " ".join(x for i in draw.integers(0, 600, 40) for x in (f"a{i}", f"b{(i + swap) % 600}", "."))
    train = spark.createDataFrame([(i, text()) for i in range(3000)], "doc_id long, text string").coalesce(2)
    rows = [(i, text()) for i in range(20)] + [(100 + i, text(7)) for i in range(20)]
    net = M.WindowNetwork(batch=256, classes=9, single=8)   # all but eight words are one class
    got = {r["doc_id"]: r["mean_log_likelihood"] for r in M.pseudo_likelihood(
        spark.createDataFrame(rows, "doc_id long, text string"), net, training=train).collect()}
    assert min(got[i] for i in range(20)) > max(got[100 + i] for i in range(20)) + 0.3


def test_probabilities_sum_to_one_over_all_words(spark):
    """Words are not mixed up with others of their bucket, however many there are, and
    words that the corpus does not hold score below those that it does."""
    words = [f"w{i}" for i in range(700)]
    train = spark.createDataFrame([(i, " ".join(words[i % k] for k in range(1, 701, 3))) for i in range(60)] + [(99, " ".join(words))],
                                  "doc_id long, text string")
    rows = list(enumerate(words)) + [(1000 + i, f"unheard{i}") for i in range(50)]
    got = {r["doc_id"]: r["log_likelihood"] for r in M.pseudo_likelihood(
        spark.createDataFrame(rows, "doc_id long, text string"), M.WindowNetwork(vocabulary=64, classes=16, single=8, batch=256), training=train).collect()}
    assert 0.85 < sum(np.exp(got[i]) for i in range(700)) < 1
    assert np.mean([got[1000 + i] for i in range(50)]) < np.mean([got[i] for i in range(700)])


def brute(rows, net):
    """The whole operator position by position: counts, ids, classes, rounds of Adagrad, scores."""
    texts = {i: [xxhash.xxh64_intdigest(x) for x in (t or "").encode().lower().split()] for i, t in rows}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    count = collections.Counter(signed(x) for t in texts.values() for x in t)
    own = net.vocabulary - net.vocabulary // 4
    top = sorted(count, key=lambda x: (-count[x], x))[:own]
    ident = lambda x: top.index(x) if x in top else own + x % (net.vocabulary - own)
    ids = {i: [ident(signed(x)) for x in t] for i, t in texts.items()}
    counts = collections.Counter({k: 0 for k in range(net.vocabulary)})
    counts.update(x for t in ids.values() for x in t)
    order = sorted(range(net.vocabulary), key=lambda k: (-counts[k], k))
    kind, mass = {k: n for n, k in enumerate(order[:net.single])}, 0.0
    total = sum(counts[k] + 1.0 for k in order[net.single:])
    for k in order[net.single:]:
        mass += counts[k] + 1.0
        kind[k] = net.single + min(int(mass / total * (net.classes - net.single)), net.classes - net.single - 1)
    of = collections.defaultdict(list)
    for k in range(net.vocabulary):
        of[kind[k]].append(k)
    share = {k: math.log((counts[k] + 1.0) / sum(counts[x] + 1.0 for x in of[kind[k]])) for k in range(net.vocabulary)}
    w = {n: x.astype(float) for n, x in M.start_weights(net).items()}
    slot = {k: n for n, k in enumerate(x for c in sorted(of) for x in of[c])}
    word = {k: w["word"][slot[k]] for k in slot}
    sides = lambda t, at: [t[at + o] if 0 <= at + o < len(t) else net.vocabulary for o in range(-net.window, net.window + 1) if o]

    def look(t, at):
        x = np.tanh(sum(w["embed"][s] * w["place"][o] for o, s in enumerate(sides(t, at))))
        p = np.exp(w["out"] @ x + w["bias"][:, 0])
        q = np.array([math.exp(share[k] + word[k] @ x) for k in of[kind[t[at]]]])
        return x, p / p.sum(), q / q.sum()

    deal = lambda i: signed(xxhash.xxh64_intdigest(np.array(ids[i], np.uint16).tobytes(), seed=xxhash.xxh64_intdigest(np.int64(i).tobytes(), seed=42)))
    for turn in range(net.rounds):
        g = {n: np.full_like(x, 1e-7 if n == "word" else 1e-4) for n, x in w.items()}
        gw = {k: np.full(net.width, 1e-7) for k in word}
        places = [(ids[i], at) for i in sorted(ids, key=deal) for at in range(len(ids[i])) if (at - len(ids[i])) % net.mask % net.rounds == turn]
        for start in range(0, len(places), net.batch):
            batch = places[start:start + net.batch]
            grad = {n: np.zeros_like(x) for n, x in w.items()}
            grad_word = collections.defaultdict(lambda: np.zeros(net.width))
            for t, at in batch:
                x, p, q = look(t, at)
                members, c = of[kind[t[at]]], kind[t[at]]
                p[c] -= 1
                p /= len(batch)
                back = p @ w["out"]
                grad["out"] += np.outer(p, x)
                grad["bias"] += p[:, None]
                if len(members) > 1:
                    q = (q - [k == t[at] for k in members]) / len(batch)
                    back = back + sum(d * word[k] for d, k in zip(q, members))
                    for d, k in zip(q, members):
                        grad_word[k] += d * x
                back = back * (1 - x * x)
                for o, s in enumerate(sides(t, at)):
                    grad["place"][o] += back * w["embed"][s]
                    grad["embed"][s] += back * w["place"][o]
            for n in ("out", "bias", "place", "embed"):
                g[n] += grad[n] ** 2
                w[n] -= net.rate * grad[n] / np.sqrt(g[n] + 1e-8)
            for k, x in grad_word.items():
                gw[k] += x * x
                word[k] = word[k] - net.rate * x / np.sqrt(gw[k] + 1e-8)
    out = {}
    for i, t in ids.items():
        value = 0.0
        for at, (k, x) in enumerate(zip(t, texts[i])):
            _, p, q = look(t, at)
            value += math.log(p[kind[k]]) + math.log(q[of[kind[k]].index(k)])
            value += math.log(count[signed(x)] / (counts[k] + 1)) if k >= own else 0.0
        out[i] = value
    return out


def _corpus():
    draw = random.Random(6)
    nouns = [f"n{k}" for k in range(40)]
    return [(i, " ".join(draw.choice(["the", "a", *nouns[:draw.randint(2, 40)]]) for _ in range(draw.randint(0, 30)))) for i in range(40)] + [(90, None), (91, "")]


def test_whole_operator_by_brute_force(spark):
    net = M.WindowNetwork(vocabulary=32, classes=6, single=3, width=4, batch=50, mask=4)
    rows = _corpus()
    want = brute(rows, net)
    got = {r["doc_id"]: r["log_likelihood"] for r in M.pseudo_likelihood(spark.createDataFrame(rows, "doc_id long, text string"), net).collect()}
    assert got.keys() == want.keys()
    for i in want:
        assert got[i] == pytest.approx(want[i], rel=1e-4, abs=1e-4)


def test_scores_do_not_depend_on_the_files(spark):
    net = M.WindowNetwork(vocabulary=32, classes=6, single=3, width=4, batch=50, part=150)
    df = spark.createDataFrame(_corpus(), "doc_id long, text string")
    one, other = ({r["doc_id"]: r["log_likelihood"] for r in M.pseudo_likelihood(x, net).collect()} for x in (df.coalesce(1), df.repartition(7)))
    assert one == pytest.approx(other, rel=1e-5, abs=1e-5)


def test_words_are_cut_as_bytes_are_split():
    """Also where texts are cut into slices, and at white space other than ASCII's, which parts nothing."""
    texts = [None, "", "  two\tWords \n", "\x0b\x0c\r", "a\x1cb\x85c\u2003d\u00a0e", "ÄÖ ß Z\x00z İ", " ", "x" * 50, "two words " * 9, "w"]
    want = [[xxhash.xxh64_intdigest(x) for x in (t or "").encode().lower().split()] for t in texts]
    for most in (1, 20, 1 << 20):
        for type in (pa.string(), pa.large_string()):
            batch, got = pa.RecordBatch.from_arrays([pa.array([None, *texts], type)], names=["text"]).slice(1), []
            for b in M._slices([batch, batch.slice(0, 0)], 0, most):
                assert b.num_rows == 1 or pa.compute.sum(pa.compute.binary_length(b.column(0))).as_py() <= most
                hashes, codes, ends = M.cut_words(b.column(0))
                got += [hashes[codes[x:y]].view(np.uint64).tolist() for x, y in zip(ends[:-1], ends[1:], strict=True)]
            assert got == want


def test_logits_that_would_overflow():
    """They are capped as before, and nothing becomes infinite."""
    net = M.WindowNetwork(vocabulary=20, classes=6, single=4, width=8)
    ids = np.arange(200) % 20
    kind, share = M.make_classes(np.bincount(ids, minlength=20), net)
    w = M.start_weights(net)
    for k in ("embed", "out", "word"):
        w[k] = 12 + w[k]   # hidden values of 1, logits near 96
    g = {k: np.full_like(v, 1e-4) for k, v in w.items()}
    members = M.make_members(kind, share, net)
    with np.errstate(all="raise"):
        M.train(w, g, M._sides(ids, np.arange(200), net), kind[ids], 0.05, ids, members)
        assert np.isfinite(M.score(M.by_place(w), w, kind, share, [ids.astype(np.uint16)], net, members)).all()
    assert all(np.isfinite(x).all() for x in (*w.values(), *g.values()))


STEP = """
import time
import numpy as np
from framewatch.llm import lmscore as M

M.keep_freed()   # as the workers do
net, draw = M.WindowNetwork(), np.random.default_rng(3)
counts = (1e6 / np.arange(1, net.vocabulary + 1)).astype(np.int64)
kind, share = M.make_classes(counts, net)
members = M.make_members(kind, share, net)
ids = draw.choice(net.vocabulary, 2 * net.batch, p=counts / counts.sum()).astype(np.uint16)
at = np.arange(0, len(ids), 2)
sides, target = M._sides(ids, at, net), ids[at]
w = M.start_weights(net)
g = {k: np.full_like(v, 1e-4) for k, v in w.items()}
x, v = (draw.standard_normal((n, net.width)).astype(np.float32) for n in (512, 192))

def bare():   # about what the two softmaxes of a step must reckon
    for _ in range(net.batch // len(x)):
        d = np.exp(x @ v.T)
        d @ v
        x.T @ d

def least(run):
    took = []
    for _ in range(15):
        start = time.process_time()
        run()
        took.append(time.process_time() - start)
    return min(took)

print(least(lambda: M.train(w, g, sides, kind[target], net.rate, target, members)) / least(bare))
"""


def test_a_step_takes_little_more_than_its_arithmetic():
    """About three times as long; it was five times, most of it passes over the logits, sums by token and fresh memory."""
    root = str(pathlib.Path(M.__file__).resolve().parents[2])
    env = os.environ | {"PYTHONPATH": root, "OMP_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1"}
    found = [float(subprocess.run([sys.executable, "-c", STEP], env=env, check=True, capture_output=True, timeout=120).stdout) for _ in range(3)]
    assert min(found) < 4
