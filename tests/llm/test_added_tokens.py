"""Texts that hold an added token's content, against an untouched tokenizer."""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

from corpusloom.llm import byte_bpe, token_counts
from corpusloom.llm.queries import BYTE_BPE

PLAIN = Tokenizer.from_file(BYTE_BPE)


def ids(text):
    return PLAIN.encode(text, add_special_tokens=False).ids


def test_added_tokens():
    bpe = byte_bpe.ByteBpe(BYTE_BPE)
    for token in (t.content for t in PLAIN.get_added_tokens_decoder().values()):
        for text in (token, f"a {token} b", f"a{token}{token} b é", f"{token[:-1]} {token[1:]}"):
            assert np.frombuffer(bpe.encode_packed(text), "<u4").tolist() == ids(text)
        tree = token_counts.TokenTree(f"a {'word ' * 300}{token[:4]}{token[6:]} b", bpe)
        at = tree.text.index(token[:4]) + 4
        for s, e, new in ((at, at, token[4:6]), (at, at + 1, ""), (0, 1, token), (0, len(token), "x")):
            assert tree.edit(s, e, new) == len(ids(tree.text))
