"""SentencePiece merge-type encoding by backtracking, and decoding.

A text is cut where no piece can span, and each distinct cut is encoded once: an Aho-Corasick
automaton finds the longest piece at every place; pieces are taken greedily as long as each is
compatible with the one before it, which is tested by undoing their last merges in turn; where none
is, the place is marked in a bitfield of failed positions and the piece before gives way to its
next shorter prefix. The result is the one that merging in order of score gives.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: The letters of Latin script, as a class of a pattern.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
CACHE_ENTRIES = 300_000


class MergeModel:
    """Tables of a merge-type model. Pieces are numbered by rank: single characters first, then
    merged pieces from best to worst score, so a smaller rank is merged earlier."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.normalize("ﬁ a  b ") not in (f"{SPACE}ﬁ{SPACE}a{SPACE}{SPACE}b ",):
            raise ValueError("only models without normalisation rules are supported")
        pieces = {sp.id_to_piece(i): i for i in range(sp.piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.byte_id = {b: sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        chars = sorted({c for p in pieces for c in p})
        if "\n" in chars:
            raise ValueError("only models without a line break in a piece are supported")
        self.pieces = chars + sorted((p for p in pieces if len(p) > 1), key=lambda p: (-sp.get_score(pieces[p]), pieces[p]))
        self.rank = {p: r for r, p in enumerate(self.pieces)}
        self.packed = [self._pack([pieces[p]] if p in pieces else [self.byte_id[b] for b in p.encode()]) for p in self.pieces]
        self.left, self.right = list(range(len(self.pieces))), list(range(len(self.pieces)))
        self.pair: dict[tuple[int, int], int] = {}
        self.reachable = [True] * len(self.pieces)
        for r in range(len(chars), len(self.pieces)):
            parts = self._merge(self.pieces[r], r)
            if len(parts) == 2:
                self.left[r], self.right[r] = parts
            else:
                self.reachable[r] = False
        for r, p in enumerate(self.pieces):
            if self.reachable[r]:
                for k in range(1, len(p)):
                    x, y = self.rank.get(p[:k]), self.rank.get(p[k:])
                    if x is not None and y is not None:
                        self.pair[x, y] = r
        self.size = [len(p) for p in self.pieces]
        self.shorter = [next((self.rank[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.rank and self.reachable[self.rank[p[:k]]]), -1) for p in self.pieces]
        self.automaton = ahocorasick.Automaton()
        for r, p in enumerate(self.pieces):
            if self.reachable[r]:
                self.automaton.add_word(p, r)
        self.automaton.make_automaton()
        self.known = set(chars)
        self.cut = re.compile(self._cuts(chars)).findall
        self.held: dict[str, bytes] = {}
        self.valid: dict[tuple[int, int], bool] = {}

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def _cuts(self, chars: list[str]) -> str:
        """A pattern that cuts texts where no piece can span: before a space mark after anything
        else, around line breaks, and between letters and other characters if no piece has both."""
        inner = {(a, b) for p in self.pieces for a, b in zip(p, p[1:], strict=False)}
        if any(b == SPACE and a != SPACE for a, b in inner):
            return r"(?s).+"
        word = re.compile(f"[{LETTERS}]").match
        if any(a != SPACE and bool(word(a)) != bool(word(b)) for a, b in inner):
            return rf"(?s){SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"
        return rf"(?s){SPACE}*[{LETTERS}]+|{SPACE}*[^{LETTERS}{SPACE}\n]+|{SPACE}+|\n"

    def _merge(self, text: str, below: int) -> list[int]:
        """Merging in order, with ranks under ``below`` only; for building the tables."""
        parts = [self.rank[c] for c in text]
        strings = list(text)
        while len(parts) > 2:
            best, at = below, -1
            for k in range(len(parts) - 1):
                r = self.rank.get(strings[k] + strings[k + 1], below)
                if r < best:
                    best, at = r, k
            if at < 0:
                break
            parts[at : at + 2] = [best]
            strings[at : at + 2] = [strings[at] + strings[at + 1]]
        return parts

    def compatible(self, x: int, y: int) -> bool:
        """Whether x and y stay apart when their texts are merged together."""
        pair, left, right = self.pair, self.left, self.right
        limit = len(self.pieces) + 1
        while True:
            if pair.get((x, y), limit) < limit:
                return False
            if x > y:
                limit = x
                x = right[x]
                if x == limit:
                    limit = y + 1
                    y = left[y]
                    if y + 1 == limit:
                        return True
            else:
                limit = y + 1
                y = left[y]
                if y + 1 == limit:
                    limit = x
                    x = right[x]
                    if x == limit:
                        return True

    def _backtrack(self, longest: list[int], begin: int, end: int) -> list[int]:
        size, shorter, valid, compatible = self.size, self.shorter, self.valid, self.compatible
        failed = 0
        taken: list[int] = []
        pos, token = begin, longest[begin]
        while True:
            last = taken[-1] if taken else -1
            while True:
                stop = pos + size[token]
                if not failed >> (stop - begin) & 1:
                    if last < 0:
                        fits = True
                    elif (fits := valid.get((last, token))) is None:
                        fits = valid[last, token] = compatible(last, token)
                    if fits:
                        taken.append(token)
                        pos = stop
                        if pos == end:
                            return taken
                        token = longest[pos]
                        break
                token = shorter[token]
                if token < 0:
                    failed |= 1 << (pos - begin)
                    taken.pop()
                    pos -= size[last]
                    token = last
                    break

    def learn(self, cuts: list[str]) -> None:
        new = list(set(cuts).difference(self.held))
        if len(self.held) + len(new) > CACHE_ENTRIES:
            self.held.clear()
            new = list(set(cuts))
        if len(self.valid) > 2_000_000:
            self.valid.clear()
        for k in range(0, len(new), 2048):
            self._learn(new[k : k + 2048])

    def _learn(self, new: list[str]) -> None:
        joined = "\n".join(new)
        longest = [-1] * len(joined)
        size = self.size
        for last, r in self.automaton.iter(joined):
            longest[last - size[r] + 1] = r
        at, packed = 0, self.packed
        for cut in new:
            end = at + len(cut)
            out, i = [], at
            while i < end:
                if longest[i] < 0:
                    out.append(self._pack([self.byte_id[b] for b in joined[i].encode()]))
                    i += 1
                    continue
                j = i + 1
                while j < end and longest[j] >= 0:
                    j += 1
                out += [packed[r] for r in self._backtrack(longest, i, j)]
                i = j
            self.held[cut] = b"".join(out)
            at = end + 1

    def encode_packed(self, text: str) -> bytes:
        """Ids of the text as little-endian 32-bit integers, without begin and end."""
        if not text:
            return b""
        cuts = self.cut(SPACE + text.replace(" ", SPACE))
        self.learn(cuts)
        return b"".join(map(self.held.__getitem__, cuts))


@lru_cache(maxsize=2)
def merge_model(path: str) -> MergeModel:
    return MergeModel(path)


def _framed(model: MergeModel, text: str | None, begin: bytes, end: bytes) -> bytes:
    return begin + model.encode_packed(text or "") + end


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) with begin and end ids; a null or empty text has these two only. One row per
    row of ``docs``; repeated rows and null ids stay, other columns are ignored."""

    def run(batches):
        m = merge_model(model)
        begin, end = m._pack([m.library.bos_id()]), m._pack([m.library.eos_id()])
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                ids = [np.frombuffer(_framed(m, t, begin, end), "<u4").astype(np.int32) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from ids, by the library; null ids give an empty text."""

    def run(batches):
        sp = merge_model(model).library
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [sp.decode(x or []) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, text string")


def round_trip_digest(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, encoded and decoded again."""

    def run(batches):
        m = merge_model(model)
        begin, end = m._pack([m.library.bos_id()]), m._pack([m.library.eos_id()])
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                sizes, ids_sha, text_sha = [], [], []
                for text in part.column(1).to_pylist():
                    packed = _framed(m, text, begin, end)
                    sizes.append(len(packed) // 4)
                    ids_sha.append(hashlib.sha256(packed).hexdigest())
                    text_sha.append(hashlib.sha256(m.library.decode(np.frombuffer(packed, "<u4").tolist()).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
