"""Edit-aware token counting over segment trees of pre-tokens.

A document's pre-tokens are kept in leaves of about ``LEAF``; the leaves' sums of characters and
tokens stand in a segment tree. An edit finds its first leaf by descent, cuts the text anew from a
boundary that the edit cannot move to the first boundary that is one of the old ones behind the
edit, encodes those pre-tokens only and updates the sums above the leaves it replaces. Characters on
which the cutting rule may differ are cut by the library, a window at a time. Added tokens, which the
library takes out of a text before all else, are pre-tokens of their own; an edit of a text that
holds one encodes it anew.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.byte_bpe import ByteBpe, byte_bpe

LEAF = 64
#: Characters before an edit whose pre-token boundaries it may move: the longest look ahead of the
#: cutting rule behind a pre-token's end.
CONTEXT = 2


class TokenTree:
    """Token count of one text under edits; ``total`` is always the count of ``text``."""

    def __init__(self, text: str, bpe: ByteBpe):
        self.bpe, self.text, self.encoded = bpe, text, 0
        self._build(*self._whole(text))

    def _cut(self, text: str, start: int, stops: set[int], after: int) -> tuple[list[int], list[int]]:
        """Lengths and token counts of pre-tokens from ``start`` to the first boundary at or behind
        ``after`` that is in ``stops``, or to the end."""
        found, at = [], start
        for tokens in self.bpe.cuts(text, start):
            for k, token in enumerate(tokens):
                at += len(token)
                if at >= after and at in stops:
                    return self._counted(found + tokens[: k + 1])
            found += tokens
        return self._counted(found)

    def _counted(self, tokens: list[str]) -> tuple[list[int], list[int]]:
        self.bpe.learn(tokens)
        self.encoded += len(tokens)
        return list(map(len, tokens)), [len(self.bpe.held[t]) // 4 for t in tokens]

    def _whole(self, text: str) -> tuple[list[int], list[int]]:
        """Lengths and token counts of all pre-tokens, added tokens among them."""
        tokens = self.bpe.pretokens(text)
        if tokens is not None:
            return self._counted(tokens)
        lengths, counts, at = [], [], 0
        for m in [*self.bpe.added.finditer(text), None]:
            end = m.start() if m else len(text)
            if end > at:
                more = self._counted([t for tokens in self.bpe.cuts(text[at:end]) for t in tokens])
                lengths += more[0]
                counts += more[1]
            if m:
                lengths.append(len(m[0]))
                counts.append(1)
                self.encoded += 1
                at = m.end()
        return lengths, counts

    def _build(self, lengths: list[int], counts: list[int]) -> None:
        self.holds_added = self.bpe.added.search(self.text) is not None
        self.leaves = [(lengths[k : k + LEAF], counts[k : k + LEAF]) for k in range(0, len(lengths), LEAF)] or [([], [])]
        size = 1
        while size < len(self.leaves):
            size *= 2
        self.size = size
        self.chars, self.tokens = np.zeros(2 * size, np.int64), np.zeros(2 * size, np.int64)
        for k, (a, b) in enumerate(self.leaves):
            self.chars[size + k], self.tokens[size + k] = sum(a), sum(b)
        for k in range(size - 1, 0, -1):
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` and the characters before it."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if at >= before + self.chars[node]:
                before += int(self.chars[node])
                node += 1
        return min(node - self.size, len(self.leaves) - 1), before

    def _set(self, leaf: int, lengths: list[int], counts: list[int]) -> None:
        self.leaves[leaf] = (lengths, counts)
        node = self.size + leaf
        chars, tokens = sum(lengths) - self.chars[node], sum(counts) - self.tokens[node]
        while node:
            self.chars[node] += chars
            self.tokens[node] += tokens
            node //= 2

    def edit(self, start: int, end: int, new: str) -> int:
        """Replaces characters ``start`` to ``end``; returns the new count."""
        start, end = max(0, min(start, len(self.text))), max(0, min(end, len(self.text)))
        end = max(start, end)
        text = self.text[:start] + new + self.text[end:]
        near = text[max(0, start - self.bpe.added_chars) : start + len(new) + self.bpe.added_chars]
        if self.holds_added or self.bpe.added.search(near):
            self.text = text
            self._build(*self._whole(text))
            return self.total
        first, before = self._find(max(0, start - CONTEXT - 1))
        if before > max(0, start - CONTEXT) or before + 0 > start:
            first, before = 0, 0
        lengths, _ = self.leaves[first]
        keep, at = 0, before
        while keep < len(lengths) and at + lengths[keep] <= start - CONTEXT:
            at += lengths[keep]
            keep += 1
        shift = len(new) - (end - start)
        last, last_before = self._find(end)
        stop_leaf = last
        while True:
            stops, pos = {}, before
            for leaf in range(first, stop_leaf + 1):
                for k, length in enumerate(self.leaves[leaf][0]):
                    pos += length
                    if pos >= end:
                        stops[pos + shift] = (leaf, k + 1)
            found, counts = self._cut(text, at, set(stops), start + len(new))
            reached = at + sum(found)
            if reached in stops or stop_leaf == len(self.leaves) - 1:
                break
            stop_leaf = min(len(self.leaves) - 1, stop_leaf + 4)
        leaf, k = stops.get(reached, (stop_leaf, len(self.leaves[stop_leaf][0])))
        head, tail = self.leaves[first], self.leaves[leaf]
        lengths = head[0][:keep] + found + tail[0][k:]
        counts = head[1][:keep] + counts + tail[1][k:]
        self.text = text
        if len(lengths) > 4 * LEAF:
            rest = self.leaves[:first] + [(lengths, counts)] + self.leaves[leaf + 1 :]
            self._build([x for a, _ in rest for x in a], [x for _, b in rest for x in b])
        else:
            self._set(first, lengths, counts)
            for gone in range(first + 1, leaf + 1):
                self._set(gone, [], [])
        return self.total


def count_with_edits(docs: DataFrame, tokenizer: str, edits_col: str = "edits", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_edited, n_pretokens, n_reencoded of every row.

    ``edits_col`` holds array<struct<start:long, end:long, new:string>>, applied in turn, each in
    the places of the text that it finds (code points; out of range: clipped; null: no edit).
    n_reencoded counts the pre-tokens that the edits made it encode. Null texts count as empty;
    repeated rows and null ids stay; other columns are ignored.
    """

    def run(batches):
        bpe = byte_bpe(tokenizer)
        for batch in batches:
            out = []
            for text, edits in zip(batch.column(1), batch.column(2), strict=True):
                tree = TokenTree(text.as_py() or "", bpe)
                before, held, tree.encoded = tree.total, tree.encoded, 0
                for e in edits.as_py() or ():
                    if e:
                        tree.edit(e["start"] or 0, e["end"] or 0, e["new"] or "")
                out.append((before, tree.total, held, tree.encoded))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "n_tokens", "n_edited", "n_pretokens", "n_reencoded"])

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(edits_col).alias("edits"))
    return docs.mapInArrow(run, "doc_id long, n_tokens long, n_edited long, n_pretokens long, n_reencoded long")
