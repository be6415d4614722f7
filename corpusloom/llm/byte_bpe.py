"""Byte-level BPE by the tokenizers library, with one encoding per distinct pre-token."""

from __future__ import annotations

import codecs
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import attrgetter

#: Characters other than those whose classes are the same for all versions of Unicode and rules.
_USUAL = "\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-ɏΑ-ΡΣ-ωА-я‐-‧€一-龥"
_UNUSUAL = re.compile(f"[^{_USUAL}]")


def _letters() -> str:
    """The usual letters as ranges of a character class, so that the matcher has a bitmap."""
    usual = re.compile(f"[{_USUAL}]")
    codes = [c for c in range(0x10000) if chr(c).isalpha() and usual.match(chr(c))]
    ranges, start = [], codes[0]
    for code, following in zip(codes, [*codes[1:], -1], strict=True):
        if following != code + 1:
            ranges.append(f"{chr(start)}-{chr(code)}")
            start = following
    return "".join(ranges)


#: Fixed rule of the public byte-level vocabularies: how a text is cut into pre-tokens; here for
#: texts of usual characters, and with the most frequent alternative first.
PRETOKEN = r" ?[LETTERS]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^\s0-9LETTERS]+|\s+(?!\S)|\s+".replace("LETTERS", _letters())
CACHE_ENTRIES = 600_000
#: Characters cut into pre-tokens at once where a text isn't cut whole.
WINDOW = 2048


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for
    themselves, the others for the letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + k) for k, b in enumerate(others)}


class ByteBpe:
    """Encodes texts; holds the packed ids of ``CACHE_ENTRIES`` pre-tokens at most, then starts anew."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.held: dict[str, bytes] = {}
        self.library = Tokenizer.from_file(path)
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        #: Finds the added tokens, which the library takes out of a text before all else.
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.added_chars = max(map(len, added), default=0)
        self.model = self.library.model
        if forget := getattr(self.model, "_resize_cache", None):
            forget(0)  # ``held`` stands for the library's own cache
        self.pattern = re.compile(PRETOKEN)
        self.cut = self.pattern.findall
        letters = _byte_letters()
        #: The letter of each byte in turn; byte 0 stands between pre-tokens and stays.
        self.written = "\0" + "".join(letters.get(b, chr(b)) for b in range(1, 256))
        self.zero = letters[0]

    def learn(self, tokens: list[str]) -> None:
        """Encodes the pre-tokens that are not held yet, by the library's model."""
        new = list(set(tokens).difference(self.held))
        if not new:
            return
        if len(self.held) + len(new) > CACHE_ENTRIES:
            self.held.clear()
            new = list(set(tokens))
        tokenize, token_id, held = self.model.tokenize, attrgetter("id"), self.held
        if zeros := [token for token in new if "\0" in token]:
            for token in zeros:
                letters = codecs.charmap_decode(token.encode(), "strict", self.written)[0].replace("\0", self.zero)
                held[token] = array("I", map(token_id, tokenize(letters))).tobytes()
            if not (new := [token for token in new if "\0" not in token]):
                return
        for token, letters in zip(new, codecs.charmap_decode("\0".join(new).encode(), "strict", self.written)[0].split("\0"), strict=True):
            held[token] = array("I", map(token_id, tokenize(letters))).tobytes()

    def cuts(self, text: str, start: int = 0) -> Iterator[list[str]]:
        """The pre-tokens of a text without added tokens from ``start``, a boundary, on, window by
        window: by the rule, or by the library where a window has unusual characters. The last two
        of a window are left to the next, since they may depend on what follows."""
        span = WINDOW
        while start < len(text):
            window = text[start : start + span]
            if _UNUSUAL.search(window):
                tokens = [window[s:e] for _, (s, e) in self.library.pre_tokenizer.pre_tokenize_str(window)]
            else:
                tokens = self.cut(window)
            if start + span < len(text):
                if len(tokens) < 3:
                    span *= 2
                    continue
                tokens = tokens[:-2]
            yield tokens
            start += sum(map(len, tokens))
            span = WINDOW

    def pretokens(self, text: str) -> list[str] | None:
        """None if the text has characters on which the rule's forms may differ, or an added token."""
        return None if _UNUSUAL.search(text) or self.added.search(text) else self.cut(text)

    def encode_packed(self, text: str) -> bytes:
        """The text's ids as little-endian 32-bit integers."""
        if not text:
            return b""
        tokens = self.pretokens(text)
        if tokens is None:
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        try:
            return b"".join(map(self.held.__getitem__, tokens))
        except KeyError:
            self.learn(tokens)
            return b"".join(map(self.held.__getitem__, tokens))


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)
