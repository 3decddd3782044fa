"""SentencePiece BPE encoding and decoding with a merge-type prefix table.

For a BPE vocabulary every prefix of a text has exactly one encoding, so it has
exactly one last token.  The table of last tokens is filled from left to right:
an Aho-Corasick automaton over the pieces lists the tokens ending at each
position, and the one that may follow the last token of the prefix before it
(pair compatibility) is stored.  The ids are then recovered backwards.

Two tokens are compatible when merging the characters of both keeps them as
they are.  This is decided by undoing the merges of both in reverse order and
looking, at every moment, whether the two tokens that then touch would have
been merged first.

A text is cut where no piece can reach across (before a space, at a character
the vocabulary lacks), so equal words are encoded once per task and looked up
after that.  The cache is bounded and does not change results.

Defined cases: null or empty text has only the begin and end ids and decodes to
the empty text; characters without a piece become their UTF-8 byte pieces;
rows are handled one by one, so repeated rows, ties and further columns do not
matter, and an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
CACHED_CHUNKS = 150_000
CACHED_PAIRS = 300_000
LONGEST_CACHED = 40
ROWS_PER_BATCH = 256


class PrefixTable:
    """The vocabulary, its merge types, and encoding and decoding with them."""

    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = sp.get_piece_size()
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        raw = {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.surface = [raw.get(i, b"" if sp.is_control(i) else b" \xe2\x81\x87 " if sp.is_unknown(i)
                                else p.replace(SPACE, " ").encode()) for i, p in enumerate(self.pieces)]
        # order of merges: 0 first; single characters are there from the start
        best_first = sorted(ids.values(), key=lambda i: -sp.get_score(i))
        self.order = [-1] * size
        for k, i in enumerate(best_first):
            if len(self.pieces[i]) > 1:
                self.order[i] = k
        self.merged = {}
        for p, i in ids.items():
            for k in range(1, len(p)):
                left, right = ids.get(p[:k]), ids.get(p[k:])
                if left is not None and right is not None:
                    self.merged[left << 16 | right] = i
        self.characters = {p for p in ids if len(p) == 1}
        # the merge that makes a piece, by merging its own characters
        self.parts: dict[int, tuple[int, int]] = {}
        reachable = []
        for p, i in sorted(ids.items(), key=lambda x: len(x[0])):
            if len(p) == 1:
                reachable.append((p, i))
            elif (made := self._last_merge(p, ids)) is not None:
                self.parts[i] = made
                reachable.append((p, i))
        self.automaton = ahocorasick.Automaton()
        for p, i in reachable:
            self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.pair: dict[int, bool] = {}
        self.chunk: dict[str, bytes] = {}
        self.split = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

    def _last_merge(self, piece: str, ids: dict[str, int]) -> tuple[int, int] | None:
        """The two tokens whose merge completes ``piece``; None if it never forms."""
        now = [ids.get(c) for c in piece]
        if None in now:
            return None
        made = None
        while len(now) > 1:
            options = [(self.order[m], k) for k in range(len(now) - 1)
                       if (m := self.merged.get(now[k] << 16 | now[k + 1])) is not None]
            if not options:
                return None
            k = min(options)[1]
            made = (now[k], now[k + 1])
            now[k:k + 2] = [self.merged[now[k] << 16 | now[k + 1]]]
        return made

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``: no merge ever joins their touching ends."""
        key = left << 16 | right
        known = self.pair.get(key)
        if known is None:
            if len(self.pair) >= CACHED_PAIRS:
                self.pair.clear()
            known = self.pair[key] = self._compatible(left, right)
        return known

    def _compatible(self, x: int, y: int) -> bool:
        order, limit = self.order, 1 << 30
        while True:
            joined = self.merged.get(x << 16 | y)
            if joined is not None and order[joined] < limit:
                return False
            if order[x] < 0 and order[y] < 0:
                return True
            # go back to the moment before the later of both was made; of
            # equal merges the left one is made first
            if order[x] > order[y]:
                limit, x = order[x], self.parts[x][1]
            else:
                limit, y = order[y] + 1, self.parts[y][0]

    def _tokens(self, run: str) -> list[int]:
        """Ids of characters that all have pieces: table forwards, ids backwards."""
        last: list[int] = [-1] * (len(run) + 1)
        width = [0] * (len(run) + 1)
        for end, (token, n) in self.automaton.iter(run):
            at = end + 1
            start = at - n
            if last[at] < 0 and (not start or last[start] >= 0 and self.compatible(last[start], token)):
                last[at], width[at] = token, n
        out, at = [], len(run)
        while at:
            out.append(last[at])
            at -= width[at]
        return out[::-1]

    def _chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        run: list[str] = []
        for c in chunk:
            if c in self.characters:
                run.append(c)
                continue
            if run:
                ids += self._tokens("".join(run))
                run = []
            ids += [self.byte_ids.get(b, self.unk) for b in c.encode()] if self.byte_ids else [self.unk]
        if run:
            ids += self._tokens("".join(run))
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def encode(self, text: str | None) -> bytes:
        """All ids with begin and end id, as little-endian unsigned 32-bit integers."""
        out = [self.bos.to_bytes(4, "little")]
        if text:
            cache = self.chunk
            for c in self.split.findall(SPACE + text.replace(" ", SPACE)):
                ids = cache.get(c)
                if ids is None:
                    ids = self._chunk(c)
                    if len(c) <= LONGEST_CACHED:
                        if len(cache) >= CACHED_CHUNKS:
                            cache.clear()
                        cache[c] = ids
                out.append(ids)
        out.append(self.eos.to_bytes(4, "little"))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids; the space set before the text is taken away again."""
        surface = self.surface
        text = b"".join([surface[i] for i in memoryview(ids).cast("I")]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def load(model_path: str) -> PrefixTable:
    return PrefixTable(model_path)


def encode_texts(df: DataFrame, model_path: str, text: str = "text",
                 ids: str = "ids", decoded: str | None = "decoded") -> DataFrame:
    """``df`` with column ``ids`` (binary: little-endian unsigned 32-bit ids with
    begin and end id) and ``decoded`` (the text read back from them).

    The model file must be at ``model_path`` on every executor.  New columns
    replace columns of the same name.
    """
    source = df.drop(*[c for c in (ids, decoded) if c and c != text])
    kept = source.schema
    out = T.StructType([f for f in kept.fields if f.name not in (ids, decoded)]
                       + [T.StructField(ids, T.BinaryType())]
                       + ([T.StructField(decoded, T.StringType())] if decoded else []))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = load(model_path)
        for big in batches:
            for at in range(0, big.num_rows, ROWS_PER_BATCH):
                batch = big.slice(at, ROWS_PER_BATCH)
                texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                coded = [table.encode(t) for t in texts]
                columns = [batch.column(k) for k, n in enumerate(batch.schema.names) if n not in (ids, decoded)]
                columns.append(pa.array(coded, pa.binary()))
                if decoded:
                    columns.append(pa.array([table.decode(c) for c in coded], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return source.mapInArrow(run, out)


def digests(documents: DataFrame, model_path: str) -> DataFrame:
    """Per document: n_tokens, digest of the ids, digest of the decoded text."""
    coded = encode_texts(documents.select("doc_id", "text"), model_path)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
