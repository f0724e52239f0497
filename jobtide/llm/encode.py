"""Token ids of whole texts from a public tokenizer file whose words are encoded independently."""

from __future__ import annotations

import os
import sys
import types
import unicodedata
from collections.abc import Iterator

import numpy as np

from .blocks import release

DEFAULT_TOKENIZER = "word_bpe_49k.json"


def shared(key: str, make):
    """A value that all tasks of one worker process use, made by the first of them."""
    kept = sys.modules.setdefault("_jobtide_llm_shared", types.ModuleType("_jobtide_llm_shared"))
    if not hasattr(kept, key):
        setattr(kept, key, make())
    return getattr(kept, key)


def slices(texts: list[bytes], limit: int = 1 << 22) -> Iterator[slice]:
    """Consecutive runs of texts of about `limit` bytes."""
    at, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield slice(at, i)
            at, size = i, 0
        size += len(text) + 1
    if at < len(texts):
        yield slice(at, len(texts))


#: Marks that a tokenizer of this kind cuts off from the letters before them; the apostrophe is not one, as it joins endings.
MARKS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'


def _stays_letters(word: str) -> bool:
    """Whether a word is letters alone once it is composed and lower-cased."""
    return unicodedata.normalize("NFC", word).lower().isalpha()


class _Words(dict):
    """Ids by word; an unknown word is noted and gives nothing for now."""

    def __init__(self) -> None:
        super().__init__()
        self.new: set[bytes] = set()

    def __missing__(self, word: bytes) -> bytes:
        self.new.add(word)
        return b""


class Encoder:
    """Encodes texts word by word and remembers up to `memory` words.

    Made for tokenizers that lower-case, drop white space and part marks from letters: there, cutting a text at
    ASCII blanks, and a word of letters before the marks that end it, changes no id. Texts that may hold a special token or
    a combining accent are not lower-cased here, as their case matters. Tests compare with whole texts.
    """

    def __init__(self, path: str, memory: int = 700_000) -> None:
        from tokenizers import Tokenizer

        if not os.path.isabs(path):
            import public_tokenizers

            path = public_tokenizers.path(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.memory, self.known = memory, _Words()
        self.cased = [b"\xcc", b"\xcd"]  # U+0300 to U+037F
        self.cased += sorted({t.content.encode()[:2] for t in self.tokenizer.get_added_tokens_decoder().values()})
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a word
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each of some words of letters, told apart by the tokens that end a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(texts):  # some word is more than one
            return self._ids_by_place(texts)
        raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _ids_by_place(self, texts: list[str]) -> list[bytes]:
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        got = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(got.ids, "<u4").tobytes()
        cuts = (4 * np.searchsorted(np.array([a for a, _ in got.offsets], np.int64), starts)).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _learn(self, words: set[bytes]) -> None:
        letters, other, ended = set(), set(), []
        for word in words:
            text = word.decode("utf-8", "replace")
            core = text.rstrip(MARKS)
            if not (core.isascii() or _stays_letters(core)) or not core.isalpha():
                other.add(text)
            elif len(core) == len(text):
                letters.add(text)
            else:
                ended.append((word, core.encode(), text[len(core) :].encode()))
                letters.add(core)
                other.add(text[len(core) :])
        for many, ids_of in ((letters, self._ids), (other, self._ids_by_place)):
            many = [t for t in many if t.encode() not in self.known]
            for at in range(0, len(many), 4_000):
                part = many[at : at + 4_000]
                self.known.update(zip([t.encode() for t in part], ids_of(part), strict=True))
        self.known.update((word, self.known[core] + self.known[tail]) for word, core, tail in ended)

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        if len(self.known) > self.memory:
            self.known.clear()
            release()
        split = [(t if any(x in t for x in self.cased) else t.lower()).split() for t in texts]
        find = self.known.__getitem__
        got = [list(map(find, words)) for words in split]
        if self.known.new:
            self._learn(self.known.new)
            for words, ids in zip(split, got, strict=True):
                if not all(ids):
                    for at in [i for i, x in enumerate(ids) if not x]:
                        ids[at] = find(words[at])
            self.known.new = set()
        return [b"".join(ids) for ids in got]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; its memory of words serves all its tasks."""
    return shared(f"encoder_{path}", lambda: Encoder(path))
