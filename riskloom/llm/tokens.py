"""Token ids of whole texts, remembered word by word inside a Python worker.

Both tokenizer libraries split a text by the same pattern before they merge bytes. No alternative of
that pattern runs from a character that is not white space into white space, and none that ends there
looks further. So a text may be cut before every blank that follows such a character, and the ids of
the parts, one after another, are those of the text. Words repeat, so their ids are kept.
"""

from __future__ import annotations

import base64
import json
import string
from array import array
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np

from riskloom.llm.common import LONGEST_REMEMBERED, Recent

Encode = Callable[[str], list[int]]
#: Words whose ids are made at the same time.
TOGETHER = 4096
#: The encoder of a ``tokenizers`` file remembers more words, as making one anew takes several times its look-up.
REMEMBERED_TIMES = 2
#: Letters up to here are letters in every version of Unicode that the libraries may follow.
LAST_LATIN = "\u024f"
#: Marks that end a letter's run: no alternative of the pattern goes from a letter into one of these, but for an
#: apostrophe before letters. A run of them at the end of a word is a piece of its own.
MARKS = string.punctuation


def byte_chars() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves,
    the others in order from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


BYTE_CHARS = byte_chars()
BLANK = chr(BYTE_CHARS[32])


def latin(word: str) -> bool:
    return word.isascii() or max(word) <= LAST_LATIN


class WordMemory(Recent):
    """Ids of ``lead + word`` as bytes; None for a word after which a text must not be cut."""

    def __init__(self, encode: Encode, lead: str, code: str, letters: Encode | None, start: WordMemory | None = None, times: int = 1):
        super().__init__(self._ids, times)
        self.encode, self.lead, self.code, self.letters = encode, lead, code, letters or encode
        self.start = self if start is None else start
        self.marks = Recent(lambda run: array(code, encode(run)).tobytes())

    def _ids(self, word: str) -> bytes | None:
        if word.isalpha() and latin(word):
            ids = array(self.code, self.letters(self.lead + word)).tobytes()
        elif (not word and self.lead) or word[-1:].isspace():
            ids = None
        elif (bare := word.rstrip(MARKS)) != word and bare[-1:].isalpha() and bare[-1] <= LAST_LATIN:
            # Most words are known without the marks behind them.
            ids = self[bare] + self.marks[word[len(bare) :]]
        else:
            lines, rest = [], word
            while (
                (line := rest.rfind("\n")) > 0
                and not rest[line - 1].isspace()
                and (after := rest[line + 1 : line + 2]).isalpha()
                and after <= LAST_LATIN
            ):
                # A single line end before a letter is a piece of its own.
                lines.append(rest[line + 1 :])
                rest = rest[:line]
            if lines:
                end = self.marks["\n"]
                ids = self[rest] + b"".join(end + self.start[part] for part in reversed(lines))
            else:
                ids = array(self.code, self.encode(self.lead + word)).tobytes()
        return ids


class TextEncoder:
    """Ids of texts by an encoding function, as little-endian bytes of ``kind``.

    ``letters`` may be a quicker function for a word of Latin letters, with or without a blank before it, and
    ``many`` one for a list of such words, of similar length, that gives the ids of each as bytes of ``kind``.
    Of the words after a blank, the memory holds ``times`` as many as others do.
    """

    def __init__(
        self,
        encode: Encode,
        kind: str = "<u2",
        letters: Encode | None = None,
        many: Callable[[list[str]], list[bytes]] | None = None,
        times: int = 1,
    ):
        self.encode, self.many, self.kind = encode, many, np.dtype(kind)
        code = self.kind.char
        self.first = WordMemory(encode, "", code, letters)
        self.later = WordMemory(encode, " ", code, letters, self.first, times)

    def learn(self, texts: Iterable[str]) -> None:
        """Make the ids of the texts' new words of Latin letters, many at a time; all other words are left to the moment they are met."""
        if self.many is None:
            return
        met: set[str] = set()
        for text in texts:
            met.update(text.split(" "))
        lines = [word.split("\n") for word in met if "\n" in word]
        self._learn(self.later, met.union(parts[0] for parts in lines))
        self._learn(self.first, {part for parts in lines for part in parts[1:]})

    def _learn(self, memory: WordMemory, words: set[str]) -> None:
        new = set()
        for word in words:
            if word not in memory:
                word = word.rstrip(MARKS)
                if len(word) <= LONGEST_REMEMBERED and word.isalpha() and latin(word) and not memory.knows(word):
                    new.add(word)
        ordered = sorted(new, key=len)
        for at in range(0, len(ordered), TOGETHER):
            some = ordered[at : at + TOGETHER]
            memory.learn(some, self.many([memory.lead + word for word in some]))

    def __call__(self, text: str) -> bytes:
        words = text.split(" ")
        try:
            return self.first[words[0]] + b"".join(map(self.later.__getitem__, words[1:]))
        except TypeError:  # white space before a blank somewhere: join such words to the next
            return b"".join(self._parts(words))

    def _parts(self, words: list[str]) -> list[bytes]:
        parts, held = [], None
        for at, word in enumerate(words):
            part = word if at == 0 else f" {word}"
            if held is None:
                known = self.later[word] if at else self.first[word]
                if known is not None:
                    parts.append(known)
                    continue
            held = part if held is None else held + part
            if held and not held[-1].isspace():
                parts.append(np.array(self.encode(held), dtype=self.kind).tobytes())
                held = None
        if held:
            parts.append(np.array(self.encode(held), dtype=self.kind).tobytes())
        return parts

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self(text), dtype=self.kind)


def id_kind(most: int) -> str:
    return "<u2" if most < 1 << 16 else "<u4"


@lru_cache(maxsize=4)
def json_encoder(path: str) -> TextEncoder:
    """The encoder of a ``tokenizers`` file, special strings read as ordinary text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    kind = id_kind(max(tokenizer.get_vocab().values()))

    def encode(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    settings = json.loads(tokenizer.to_str())
    before = settings["pre_tokenizer"] or {}
    usual = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    if not usual or settings["normalizer"]:
        return TextEncoder(encode, kind)
    model = tokenizer.model

    def letters(word: str) -> list[int]:
        # Such a word is one piece, so only the merges are left to do. ASCII letters stand for themselves.
        chars = word.replace(" ", BLANK) if word.isascii() else word.encode().decode("latin-1").translate(BYTE_CHARS)
        return [t.id for t in model.tokenize(chars)]

    return TextEncoder(encode, kind, letters, times=REMEMBERED_TIMES)


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
