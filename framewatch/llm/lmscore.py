"""Masked pseudo-likelihood of documents under a bidirectional window network.

All words of the corpus are counted by a distributed aggregation, whose table grows
with it.  The most frequent words are token ids of their own; the others share the
ids of hash buckets, in which each has the share that its count gives it, and words
that the corpus does not hold have together that of one occurrence; counts are
joined to the documents' rare words.  A small network predicts a token from the tokens
on both sides of it: their embeddings, weighted by place, are summed and passed
through tanh.  The hidden values give the probabilities of token classes, and by a
second softmax those of the tokens within a class, which start from the tokens'
shares of the corpus.  A document's score is the sum, over all its tokens,
of the log-probability of the token given both sides.

Everything comes from the corpus: word counts of all documents (which also make
the classes of tokens: frequent tokens have one each, the others are grouped to equal
shares), and the weights.  In each round every partition trains the same network
on its own documents and sends its weights, which are averaged by the number of
times they were trained.  The rounds share out the positions: over all of them
every token of every document is hidden once.  The network, with its table of
embeddings, is of fixed size; the word counts are not.  Documents are dealt to the
partitions by a hash of theirs, in its order, and the number of partitions follows the number of
tokens, so scores do not depend on the layout of the files (but for the rounding of sums).

Defined cases: null or empty text has no tokens, score 0 and a null mean;
repeated rows are trained on and scored as often as they come; an empty table
gives an empty table; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


SLOT_BITS = 18
SLOT_MASK = (1 << SLOT_BITS) - 1
TEXT_BYTES = 8 << 20   # of texts that are cut into words at a time, about
TOKEN_BYTES = 1 << 18  # of token ids that are laid out in one row at a time, about
BLOCK = 512            # positions whose class logits are held at a time: they stay in the cache


@dataclass(frozen=True)
class WindowNetwork:
    vocabulary: int = 8192    # token ids: three quarters are words, the others buckets
    classes: int = 96
    single: int = 8           # most frequent tokens with a class of their own
    width: int = 16
    window: int = 2           # tokens on each side
    mask: int = 8             # offsets of positions, dealt to the rounds
    rounds: int = 2           # at most mask
    rate: float = 0.05
    batch: int = 8192
    part: int = 2_000_000     # tokens that one network is trained on, about, or more
    parts: int = 20_000       # networks trained side by side, at most


def _slices(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``most`` bytes in the column; a longer value is a slice of its own."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy().astype(np.int64))
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, side="right")))
            yield b.slice(at, end - at)
            at = end


def cut_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words of all the texts, for every word the place of its
    hash, and the first word of every text and the end."""
    rows = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    found = rows.flatten().cast(pa.binary() if texts.type == pa.string() else pa.large_binary()).dictionary_encode()
    words, codes = found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()
    ends = np.concatenate(([0], np.cumsum(pc.list_value_length(rows).to_numpy())))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)
    if b"" in words:   # beside white space at an end of a text
        real = codes != words.index(b"")
        ends = np.concatenate(([0], np.cumsum(real)))[ends]
        codes = codes[real]
    return hashes, codes, ends


def count_words(documents: DataFrame) -> DataFrame:
    """word (its 64-bit hash) and count, of all words of the documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, 0, TEXT_BYTES):
            hashes, codes, _ = cut_words(b.column(0))
            n = np.bincount(codes, minlength=len(hashes))
            some = np.flatnonzero(n)   # not the empty word
            yield pa.RecordBatch.from_arrays([pa.array(hashes[some]), pa.array(n[some])], names=["word", "count"])

    return documents.select("text").mapInArrow(run, "word long, count long").groupBy("word").agg(F.sum("count").alias("count"))


class Vocabulary(NamedTuple):
    """Token ids: the most frequent words have one each, the others share buckets."""
    words: np.ndarray     # hashes of the words with an id of their own, sorted
    ids: np.ndarray       # and their ids
    counts: np.ndarray    # of all ids
    own: int              # ids up to here are words, those above buckets

    def table(self) -> np.ndarray:
        """By the last SLOT_BITS bits of a hash the place of the word that has them, -1: none,
        -2: several, which are searched for."""
        slots = np.full(1 << SLOT_BITS, -1, np.int16)
        at, n = np.unique(self.words & SLOT_MASK, return_counts=True)
        slots[self.words & SLOT_MASK] = np.arange(len(self.words))
        slots[at[n > 1]] = -2
        return slots

    def tokens(self, words: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
        at = (self.table() if table is None else table)[words & SLOT_MASK]
        several = np.flatnonzero(at == -2)
        if len(several):
            at[several] = np.minimum(np.searchsorted(self.words, words[several]), len(self.words) - 1)
        some = np.flatnonzero(at >= 0)
        some = some[self.words[at[some]] == words[some]]
        out = (self.own + words % (len(self.counts) - self.own)).astype(np.uint16)
        out[some] = self.ids[at[some]]
        return out

    def bucket_shares(self) -> np.ndarray:
        """By id, what is added to log(count) for a word's log-share of its id: words of a
        bucket that the corpus does not hold have together the share of one occurrence."""
        return np.where(np.arange(len(self.counts)) < self.own, 0.0, -np.log(self.counts + 1.0))


def make_vocabulary(counted: DataFrame, net: WindowNetwork) -> Vocabulary:
    """Of the table of all words the driver gets the most frequent ones and sums by bucket."""
    own = net.vocabulary - max(1, net.vocabulary // 4)
    top = counted.orderBy(F.desc("count"), "word").limit(own).toPandas()
    words, n = top["word"].to_numpy(np.int64), top["count"].to_numpy(np.int64)
    counts = np.zeros(net.vocabulary, np.int64)
    counts[:len(n)] = n
    if len(n) == own:
        rest = counted.where((F.col("count") < int(n[-1])) | ((F.col("count") == int(n[-1])) & (F.col("word") > int(words[-1]))))
        sums = rest.groupBy(F.pmod("word", F.lit(net.vocabulary - own)).alias("bucket")).agg(F.sum("count").alias("count")).toPandas()
        counts[own + sums["bucket"].to_numpy(np.int64)] = sums["count"].to_numpy(np.int64)
    order = np.argsort(words)
    return Vocabulary(words[order], order, counts, own)


def read_tokens(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows of documents: row (a number of its own), doc_id, tokens (16-bit ids), and
    rare, the hashes of the words that have no id of their own."""
    names = ["row", "doc_id", "tokens", "rare"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary.table()
        for b in _slices(batches, 2, TEXT_BYTES):
            hashes, codes, ends = cut_words(b.column(2))
            ids = vocabulary.tokens(hashes, table)[codes]
            rare = ids >= vocabulary.own
            offsets = np.concatenate(([0], np.cumsum(rare)))[ends]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1),
                pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer((2 * ends).astype(np.int32)), pa.py_buffer(ids)]),
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(hashes[codes[rare]]))], names=names)

    return documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "row long, doc_id long, tokens binary, rare array<long>")


def make_classes(counts: np.ndarray, net: WindowNetwork) -> tuple[np.ndarray, np.ndarray]:
    """The class of every token, and log of its share of the class."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    kind = np.zeros(len(counts), np.int64)
    kind[order[:net.single]] = np.arange(net.single)
    rest = order[net.single:]
    mass = np.cumsum(counts[rest] + 1.0)
    kind[rest] = net.single + np.minimum((mass / mass[-1] * (net.classes - net.single)).astype(np.int64), net.classes - net.single - 1)
    total = np.bincount(kind, counts + 1.0, minlength=net.classes)
    return kind, np.log((counts + 1.0) / total[kind]).astype(np.float32)


class Members(NamedTuple):
    """The tokens in order of their classes."""
    slot: np.ndarray      # place of every token in this order
    starts: np.ndarray    # first place of every class, and the end
    share: np.ndarray     # log of the share of the class, by place


def make_members(kind: np.ndarray, share: np.ndarray, net: WindowNetwork) -> Members:
    order = np.argsort(kind, kind="stable")
    slot = np.empty(len(order), np.int64)
    slot[order] = np.arange(len(order))
    return Members(slot, np.searchsorted(kind[order], np.arange(net.classes + 1)), share[order])


def start_weights(net: WindowNetwork) -> dict[str, np.ndarray]:
    r = np.random.default_rng(7)
    make = lambda *shape: (r.standard_normal(shape) * 0.1).astype(np.float32)
    return {"embed": make(net.vocabulary + 1, net.width), "place": 1 + make(2 * net.window, net.width),
            "out": make(net.classes, net.width), "bias": np.zeros((net.classes, 1), np.float32),
            "word": np.zeros((net.vocabulary, net.width), np.float32)}   # rows in the order of Members


def _in_row(texts: list[np.ndarray], net: WindowNetwork) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one row with padding around them, and the first place of each."""
    gap = np.full(net.window, net.vocabulary, np.uint16)
    row = np.concatenate([x for t in texts for x in (gap, t)] + [gap])
    return row, np.cumsum([net.window] + [len(t) + net.window for t in texts[:-1]])


def _sides(ids: np.ndarray, at: np.ndarray, net: WindowNetwork) -> np.ndarray:
    """Token ids around the positions ``at``; outside the text the padding id."""
    row, first = _in_row([ids], net)
    return _around(row, first + at, net)


def _around(row: np.ndarray, at: np.ndarray, net: WindowNetwork) -> np.ndarray:
    return np.stack([row[at + o] for o in range(-net.window, net.window + 1) if o], axis=1)


def by_place(w: dict[str, np.ndarray]) -> list[np.ndarray]:
    """The embeddings as they enter the sum at each place of the window."""
    return [w["embed"] * p for p in w["place"]]


def _with_ones(hidden: np.ndarray) -> np.ndarray:
    """For logits that have a constant each, in the last column of their weights."""
    return np.hstack([hidden, np.ones((len(hidden), 1), hidden.dtype)])


def _exp(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp in place, and its sum by row."""
    if logits.max() > 80:
        np.minimum(logits, 80, out=logits)
    np.exp(logits, out=logits)
    return logits, logits @ np.ones(logits.shape[1], logits.dtype)


def _hidden(w: dict[str, np.ndarray], around: np.ndarray) -> np.ndarray:
    """Hidden values, given the embeddings around the positions, by place."""
    hidden = around[0] * w["place"][0]
    for x, p in zip(around[1:], w["place"][1:], strict=True):
        hidden += x * p
    return np.tanh(hidden, out=hidden)


def forward(w: dict[str, np.ndarray], sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden values and log-probabilities of the classes."""
    hidden, out = _hidden(w, w["embed"].take(sides.T, axis=0)), np.hstack([w["out"], w["bias"]])
    logits = _with_ones(hidden) @ out.T
    return hidden, logits - np.log(_exp(logits.copy())[1])[:, None]


def _by_class(kind: np.ndarray, members: Members) -> list[tuple[int, int, int, int]]:
    """Of every class that is met and has tokens to choose from its part of the
    positions, which are sorted by class, and its places."""
    cuts = np.searchsorted(kind, np.arange(len(members.starts))).tolist()
    starts = members.starts.tolist()
    return [(cuts[c], cuts[c + 1], starts[c], starts[c + 1]) for c in range(len(starts) - 1)
            if cuts[c] < cuts[c + 1] and starts[c + 1] - starts[c] > 1]


def values(w: dict[str, np.ndarray], hidden: np.ndarray, kind: np.ndarray, token: np.ndarray, members: Members) -> np.ndarray:
    """Log-probability of each token: that of its class, and its own within the class, given the hidden values."""
    kind = kind.astype(np.uint16)   # sorted by counting
    order = np.argsort(kind, kind="stable")
    kind, h, slot = kind[order], _with_ones(hidden.take(order, axis=0)), members.slot[token[order]]
    out, word = np.hstack([w["out"], w["bias"]]), np.column_stack([w["word"], members.share])
    word[members.starts[:-1][np.diff(members.starts) == 1]] = 0   # no choice within the class
    own = np.einsum("ij,ij->i", h, out.take(kind, axis=0) + word.take(slot, axis=0))
    total, again = np.empty_like(own), np.ones_like(own)
    for at in range(0, len(h), BLOCK):
        total[at:at + BLOCK] = _exp(h[at:at + BLOCK] @ out.T)[1]
    for a, b, s, e in _by_class(kind, members):
        again[a:b] = _exp(h[a:b] @ word[s:e].T)[1]
    value = np.empty_like(own)
    value[order] = own - np.log(total) - np.log(again)
    return value


def keep_freed() -> None:
    """Lets a worker keep the memory of one step for the next: the C library keeps about as
    much as the largest array freed so far, and pages got anew cost a fourth of a step."""
    np.empty(24 << 20, np.uint8)


def _errors(x: np.ndarray, v: np.ndarray, own: np.ndarray, each: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gradient of the logits, probabilities less what is so, up to the factors by
    row, which are returned, too."""
    d, total = _exp(x @ v.T)
    d[each[:len(d)], own] -= total
    return d, (1 / total)[:, None]


def train(w: dict[str, np.ndarray], g: dict[str, np.ndarray], sides: np.ndarray, target: np.ndarray, rate: float,
          token: np.ndarray | None = None, members: Members | None = None) -> None:
    """One Adagrad step on a batch; g: sums of squared gradients.  target: classes;
    with token and members the tokens within their classes are learnt, too."""
    n, width = len(target), w["embed"].shape[1]
    target = target.astype(np.uint16)   # sorted by counting
    order = np.argsort(target, kind="stable")
    target, sides, each = target[order], sides[order].T.astype(np.int64), np.arange(n)
    around = w["embed"].take(sides, axis=0)
    hidden = _hidden(w, around)
    h, back = _with_ones(hidden), np.empty_like(hidden)
    out = np.hstack([w["out"], w["bias"]])
    total = np.zeros_like(out.T)
    for at in range(0, n, BLOCK):
        part = slice(at, at + BLOCK)
        d, scale = _errors(h[part], out, target[part], each)
        total += (h[part] * scale).T @ d
        np.multiply(d @ w["out"], scale, out=back[part])
    total /= n
    grad = {"out": total[:-1].T, "bias": total[-1:].T}
    if members is not None:
        word, slot = np.column_stack([w["word"], members.share]), members.slot[token[order]]
        grad["word"] = np.zeros_like(w["word"])
        for a, b, s, e in _by_class(target, members):
            d, scale = _errors(h[a:b], word[s:e], slot[a:b] - s, each)
            grad["word"][s:e] = ((hidden[a:b] * scale).T @ d).T
            back[a:b] += (d @ w["word"][s:e]) * scale
        grad["word"] /= n
    dh = back * (1 - hidden * hidden) / n
    grad["place"] = np.stack([np.ones(n, dh.dtype) @ (dh * x) for x in around])
    # gradients of embeddings, summed by token, a column at a time
    every, columns, place = sides.ravel(), np.ascontiguousarray(dh.T, np.float64), w["place"].astype(np.float64)
    grad["embed"], weight = np.empty_like(w["embed"]), np.empty(sides.shape)
    for c in range(width):
        np.multiply(place[:, c, None], columns[c], out=weight)
        grad["embed"][:, c] = np.bincount(every, weight.ravel(), minlength=len(w["embed"]))
    for name, x in grad.items():   # what was not met has gradient zero and stays
        root = x * x
        g[name] += root
        np.sqrt(np.add(g[name], np.float32(1e-8), out=root), out=root)
        x *= rate
        x /= root
        w[name] -= x


def score(places: list[np.ndarray], w: dict[str, np.ndarray], kind: np.ndarray, share: np.ndarray,
          texts: list[np.ndarray], net: WindowNetwork, members: Members | None = None) -> np.ndarray:
    """Summed conditional log-probabilities of every text.  The texts are laid out in
    one row with padding between them, and scored in steps of a fixed size."""
    members = members or make_members(kind, share, net)
    row, first = _in_row(texts, net)
    row = row.astype(np.int64)
    n = len(row) - 2 * net.window
    offsets = [o for o in range(2 * net.window + 1) if o != net.window]
    value = np.zeros(n)
    step = 4 * net.batch   # few calls for each class
    for at in range(0, n, step):
        end = min(at + step, n)
        here = row[at + net.window:end + net.window]
        real = np.flatnonzero(here < net.vocabulary)
        hidden = places[0].take(row[at + offsets[0] + real], axis=0)
        for p, o in zip(places[1:], offsets[1:], strict=True):
            hidden += p.take(row[at + o + real], axis=0)
        np.tanh(hidden, out=hidden)
        t = here[real]
        value[at + real] = values(w, hidden, kind[t], t, members)
    total = np.concatenate(([0.0], np.cumsum(value)))
    begin = first - net.window
    return total[begin + np.array([len(t) for t in texts], np.int64)] - total[begin]


def hidden_in(n: int, turn: int, net: WindowNetwork) -> np.ndarray:
    """Positions of a text of n tokens that are hidden in a round; the rounds share
    out the ``mask`` offsets, so each position is hidden in one of them."""
    at = np.arange(n)
    return at[(at - n) % net.mask % net.rounds == turn]


def train_round(tokens: DataFrame, weights: dict[str, np.ndarray], kind: np.ndarray, share: np.ndarray,
                net: WindowNetwork, turn: int) -> dict[str, np.ndarray]:
    """Train on every partition from the same weights, and average what they send."""
    sent = tokens.sparkSession.sparkContext.broadcast((weights, kind, make_members(kind, share, net)))   # of fixed size
    columns = [f"w{i}" for i in range(net.width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        first, kind, members = sent.value
        w = {k: v.copy() for k, v in first.items()}
        # a token's own vector is trained at few positions of a batch only
        g = {k: np.full_like(v, 1e-7 if k == "word" else 1e-4) for k, v in w.items()}
        seen = np.zeros(net.vocabulary + 1, np.int64)
        met = np.zeros(net.classes, np.int64)
        chosen, sides, targets, held, steps = [], [], [], 0, 0

        def gather(row: np.ndarray) -> None:
            if chosen:
                at = np.concatenate(chosen)
                sides.append(_around(row, at, net))
                targets.append(row[at])
                chosen.clear()

        def step() -> None:
            nonlocal held, steps
            s, t = np.concatenate(sides), np.concatenate(targets)
            for at in range(0, len(t), net.batch):
                token = t[at:at + net.batch]
                train(w, g, s[at:at + net.batch], kind[token], net.rate, token, members)
            seen[:] += np.bincount(s.ravel(), minlength=len(seen))
            met[:] += np.bincount(kind[t], minlength=len(met))
            steps += len(t)
            sides.clear()
            targets.clear()
            held = 0

        for b in _slices(batches, 0, TOKEN_BYTES):
            ids = [np.frombuffer(x, np.uint16) for x in b.column(0).to_pylist()]
            row, first = _in_row(ids, net)
            for x, begin in zip(ids, first.tolist(), strict=True):
                hidden = begin + hidden_in(len(x), turn, net)
                for k in range(0, len(hidden), 16 * net.batch):
                    at = hidden[k:k + 16 * net.batch]
                    chosen.append(at)
                    held += len(at)
                    if held >= 16 * net.batch:
                        gather(row)
                        step()
            gather(row)
        if held:
            step()
        if not steps:
            return
        rows = np.flatnonzero(seen)
        times = np.repeat(met, np.diff(members.starts))   # all tokens of a class are trained where one of them is hidden
        places = np.flatnonzero(times)
        parts = [("embed", rows, w["embed"][rows], seen[rows]), ("word", places, w["word"][places], times[places])] + [
            (n, np.arange(len(w[n])), np.pad(w[n], ((0, 0), (0, net.width - w[n].shape[1]))), np.full(len(w[n]), steps))
            for n in ("place", "out", "bias")]
        for name, index, values, weight in parts:
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(index)), pa.array(index.astype(np.int32)), pa.array(weight.astype(np.float64))]
                + [pa.array(values[:, i].astype(np.float64) * weight) for i in range(net.width)], names=["part", "row", "n", *columns])

    rows = tokens.select("tokens").mapInArrow(
        run, "part string, row int, n double, " + ", ".join(f"{c} double" for c in columns))
    # as many rows as the network has
    got = rows.groupBy("part", "row").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in columns]).toPandas()
    sent.unpersist()
    new = {k: v.copy() for k, v in weights.items()}
    for part, d in got.groupby("part"):
        mean = (d[columns].to_numpy() / d[["n"]].to_numpy())[:, :new[part].shape[1]]
        new[part][d["row"].to_numpy()] = mean.astype(np.float32)
    return new


def pseudo_likelihood(documents: DataFrame, net: WindowNetwork = WindowNetwork(), training: DataFrame | None = None) -> DataFrame:
    """doc_id, n_tokens, log_likelihood, mean_log_likelihood of every document; the
    network is trained on ``training``, by default on the documents themselves."""
    corpus = training if training is not None else documents
    counted = cut(count_words(corpus), "words")
    vocabulary = make_vocabulary(counted, net)
    kind, share = make_classes(vocabulary.counts, net)
    # documents are dealt out by a hash of theirs, so the networks do not depend on the files
    parts = min(net.parts, max(1, -(-int(vocabulary.counts.sum()) // net.part)))
    deal = F.xxhash64("doc_id", "tokens")
    tokens = cut(read_tokens(corpus, vocabulary).withColumn("deal", deal).repartition(parts, "deal")
                 .sortWithinPartitions("deal").drop("deal"), "tokens")
    weights = start_weights(net)
    for turn in range(net.rounds):
        weights = train_round(tokens, weights, kind, share, net, turn)
    scored = tokens if training is None else cut(read_tokens(documents, vocabulary), "scored-tokens")
    sent = documents.sparkSession.sparkContext.broadcast(
        (weights, kind, share, make_members(kind, share, net), vocabulary.bucket_shares()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed()
        w, kind, share, members, bucket_shares = sent.value
        places = by_place(w)
        for b in _slices(batches, 2, TOKEN_BYTES):
            ids = [np.frombuffer(x, np.uint16) for x in b.column(2).to_pylist()]
            value = score(places, w, kind, share, ids, net, members) + np.array([bucket_shares[x].sum() for x in ids])
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array([len(x) for x in ids], pa.int64()), pa.array(value, pa.float64())],
                names=["row", "doc_id", "n_tokens", "value"])

    out = scored.select("row", "doc_id", "tokens").mapInArrow(run, "row long, doc_id long, n_tokens long, value double")
    # words counted once, or not at all, add log(1)
    rare = scored.select(F.col("row").alias("_row"), F.explode("rare").alias("word")).join(
        counted.where(F.col("count") > 1), "word").groupBy("_row").agg(F.sum(F.log("count")).alias("more"))
    out = out.join(rare, F.col("row") == F.col("_row"), "left").select(
        "doc_id", "n_tokens", (F.col("value") + F.coalesce("more", F.lit(0.0))).alias("log_likelihood"))
    return out.select("*", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("mean_log_likelihood"))
