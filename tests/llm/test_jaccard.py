import random

import pytest

from framewatch.llm import jaccard as J
from framewatch.llm.components import components


def word_sets(texts, k):
    out = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        out[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    return out


def brute(texts, k, percent):
    """(size, component) by comparing every pair."""
    sets = word_sets(texts, k)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def copies(seed, groups=6, each=12):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "and"] * 40
    texts = []
    for _ in range(groups):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(20, 90))]
        for _ in range(each):
            w = list(base)
            for _ in range(draw.randint(0, 4)):
                at = draw.randrange(len(w))
                if draw.random() < 0.5:
                    w[at] = draw.choice(vocabulary)
                else:
                    del w[at]
            texts.append(" ".join(w))
    texts += [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 60))) for _ in range(60)]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("words,percent,dense,block", [(3, 90, 8, 64), (5, 80, 8, 64), (3, 80, 0, 4), (2, 70, 0.2, 2)])
def test_same_as_all_pairs(spark, make_docs, monkeypatch, words, percent, dense, block):
    monkeypatch.setattr(J, "DENSE", dense)
    monkeypatch.setattr(J, "TILE", 5)
    monkeypatch.setattr(J, "BLOCK", block)
    texts = copies(words * percent + dense)
    want = brute(list(enumerate(texts)), words, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in J.similar_documents(make_docs(texts), J.Similarity(words, percent)).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)


def test_defined_cases(edge_docs):
    rows = J.similar_documents(edge_docs, J.Similarity(3, 90)).collect()
    assert len(rows) == edge_docs.count()
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert [got[i]["n_shingles"] for i in (1, 2, 3)] == [0, 0, 0]
    assert [got[i]["component_id"] for i in (1, 2, 3, 5, 6, 7, 9)] == [1, 2, 3, 5, 5, 7, 7]
    assert all(r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert J.similar_documents(edge_docs.limit(0), J.Similarity(3, 90)).count() == 0


def test_short_text_is_not_a_window():
    assert not set(J.shingles("a b", 3)) & set(J.shingles("a b a b", 3))
    assert list(J.shingles("A b", 3)) == list(J.shingles("a\x0bB", 3))
    assert list(J.shingles("É b c", 3)) != list(J.shingles("é b c", 3))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(1, 40)] + [(7, 7), (900, 901), (901, 900)]
    got = {r["id"]: r["component_id"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in [*range(1, 40), 500]}, 900: 900, 901: 900}


def test_unlike_texts_under_one_id(spark):
    """Each text of an id keeps its links: 2 nearly repeats one text of 1, 3 the other."""
    draw = random.Random(2)
    a, b = ([draw.choice("abcdefghijklmnop") + str(draw.randrange(500)) for _ in range(60)] for _ in range(2))
    near = lambda w: " ".join([*w[:-1], "x"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (7, "else " * 9), (5, " ".join(b)), (5, " ".join(b)), (1, " ".join(a))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in J.similar_documents(df, J.Similarity(3, 90)).collect())
    assert got == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (5, 1), (5, 1), (7, 7)]
    node = {(r["doc_id"], r["h"]): r["node"] for r in J.similar_rows(df, J.Similarity(3, 90)).collect()}
    assert len(set(node.values())) == 3      # of a, of b, and the other text


@pytest.mark.parametrize("sent", [0, 10**9])
def test_both_ways_to_find_texts(spark, make_docs, monkeypatch, sent):
    """Texts looked up by a broadcast of ids, and by a join beyond its bound."""
    monkeypatch.setattr(J, "IDS_SENT", sent)
    texts = copies(3, groups=3, each=6)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.similar_documents(make_docs(texts), J.Similarity(3, 80)).collect()}
    assert got == brute(list(enumerate(texts)), 3, 80)
