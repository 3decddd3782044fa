import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewatch.llm import sentencepiece_bpe as S
from framewatch.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


def coded(library, text):
    ids = library.encode(text, add_bos=True, add_eos=True)
    return np.array(ids, "<u4").tobytes(), library.decode(ids)


def test_same_as_library_on_odd_texts(library):
    table = S.load(tokenizer_path())
    texts = ["", " ", "   a", "a  b   ", "▁x", "a▁▁b", "\x00\x01", "line\nline\r\n\ttab", "😀🏳️‍🌈é", "中文 字符", "a" * 500,
             "the" * 200, "ﬁ½　x", "�", "x" * 3000 + " " * 40]
    draw = random.Random(3)
    texts += ["".join(draw.choice("abcdethionrs ▁\n.,019éß中-_'\"😀") for _ in range(draw.randint(1, 80))) for _ in range(1500)]
    for t in texts:
        ids, back = coded(library, t)
        assert table.encode(t) == ids, t
        assert table.decode(ids) == back, t


def test_bounded_caches_do_not_change_results(library, monkeypatch):
    monkeypatch.setattr(S, "CACHED_CHUNKS", 3)
    monkeypatch.setattr(S, "CACHED_PAIRS", 5)
    table = S.PrefixTable(tokenizer_path())
    for t in ("the quick brown fox jumps over the lazy dog", "un deux trois quatre cinq"):
        assert table.encode(t) == coded(library, t)[0]


def test_rows_and_digests(edge_docs, library):
    clash = edge_docs.withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("x"))
    rows = S.encode_texts(clash, tokenizer_path()).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        assert (bytes(r["ids"]), r["decoded"]) == coded(library, r["text"] or "")
    for r in S.digests(edge_docs.where("doc_id = 8"), tokenizer_path()).collect():
        ids, back = coded(library, edge_docs.where("doc_id = 8").first()["text"])
        assert r["n_tokens"] == len(ids) // 4 and r["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
    assert S.digests(edge_docs.limit(0), tokenizer_path()).count() == 0
