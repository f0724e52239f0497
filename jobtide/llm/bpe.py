"""BPE encoding by forced boundaries, and decoding.

A merge only ever makes a token of the vocabulary, so two neighbouring bytes that stand beside each other in no token can never
end up in one: the place between them is a certain cut. Blanks are such bytes, most marks beside letters are, and so are the rarer
pairs of letters. The fragments between the cuts are encoded each by itself, once per worker, and a text's ids are the ids of its
fragments one after the other.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .blocks import release
from .encode import DEFAULT_TOKENIZER, shared, slices
from .words import text_bytes

BLANK, CUT = 32, 10  # neither is a letter of a byte-level vocabulary


def tokenizer_file(path: str) -> str:
    """The place of a tokenizer file; a bare name is one of the public files that are installed."""
    if os.path.isabs(path):
        return path
    import public_tokenizers

    return public_tokenizers.path(path)


class Cuts:
    """The certain cuts of a vocabulary, as a table of the byte pairs that stand side by side inside some token."""

    def __init__(self, tokens: Iterable[str], ending: str) -> None:
        pairs = {a + b for token in tokens for a, b in pairwise(token.removesuffix(ending))}
        at = np.array([[ord(c) for c in p] for p in pairs], np.int64).reshape(-1, 2)
        size = int(at.max(initial=BLANK)) + 1
        self.joined = np.zeros((size, size), bool)
        self.joined[at[:, 0], at[:, 1]] = True
        self.joined[BLANK] = self.joined[:, BLANK] = True  # between words; nothing to cut

    def fragments(self, words: list[str]) -> list[list[str]]:
        """The parts of each word between its certain cuts; words are in the vocabulary's own byte letters."""
        if not words:
            return []
        letters = np.frombuffer(" ".join(words).encode("utf-32-le"), "<u4")
        cuts = np.flatnonzero(~self.joined[letters[:-1], letters[1:]]) + 1
        marked = np.insert(letters, cuts, CUT).astype("<u4").tobytes().decode("utf-32-le")
        return [w.split("\n") for w in marked.split(" ")]


#: Texts whose characters are single, composed and known to be letters, digits or marks: their words can be told by a pattern.
PLAIN = re.compile("[!-~¡-įıĲ-ɏ]+")
#: The words of such a text in the way of `RULE`.
PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[0-9²³¹¼½¾]|(?:[^\s\w]|_)+")
#: Fixed value: how the tokenizer files of this kind tell words apart; another rule is left to the library for every text.
RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves, the others follow U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


class ForcedEncoder:
    """Encodes texts by their fragments, with the rules of one tokenizer file.

    The file says how words are told apart and which merges there are; merging itself is the library's, on one fragment at a time.
    It must be of the kind that drops white space and marks the end of words. Up to `memory` chunks between blanks and as many
    words are remembered; what is forgotten is encoded again.
    """

    def __init__(self, path: str, memory: int = 250_000) -> None:
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(tokenizer_file(path))
        rules = json.loads(whole.to_str())
        self.ending, self.memory = rules["model"]["end_of_word_suffix"], memory
        if not self.ending:
            raise ValueError("the tokenizer file must mark the end of words")
        self.normalise, self.split = whole.normalizer.normalize_str, whole.pre_tokenizer.pre_tokenize_str
        self.patterned = RULE in json.dumps(rules["pre_tokenizer"], ensure_ascii=False).replace("\\\\", "\\")
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.special = {t.content.encode(): i for i, t in whole.get_added_tokens_decoder().items()}
        self.between = re.compile(b"(" + b"|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) + b")") if self.special else None
        self.cuts = Cuts(whole.get_vocab(with_added_tokens=False), self.ending)
        rules |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False}}
        self.last = Tokenizer.from_str(json.dumps(rules))  # fragments that end a word
        rules["model"]["end_of_word_suffix"] = None
        self.inner = Tokenizer.from_str(json.dumps(rules))
        vocabulary = whole.get_vocab(with_added_tokens=False)
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for t, i in vocabulary.items() if t.endswith(self.ending)]] = True
        self.chunks: dict[bytes, bytes] = {}  # ids of what stands between blanks
        self.words: dict[str, bytes] = {}  # ids of words

    def _merge(self, fragments: list[str], ends: bool) -> dict[str, bytes]:
        """The ids of some fragments, all of which end a word or all of which are inside one."""
        out = {}
        for at in range(0, len(fragments), 4_000):
            some = fragments[at : at + 4_000]
            if ends:  # told apart by the tokens that end a word, without the cost of places
                ids = np.array(self.last.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
                cuts = [0, *(4 * (np.flatnonzero(self.closing[ids]) + 1)).tolist()]
            else:
                got = self.inner.encode(" ".join(some), add_special_tokens=False)
                ids = np.array(got.ids, "<u4")
                cuts = (4 * np.searchsorted(np.array(got.word_ids, np.int64), np.arange(len(some) + 1))).tolist()
            raw = ids.tobytes()
            out.update((f, raw[a:b]) for f, (a, b) in zip(some, pairwise(cuts), strict=True))
        return out

    def _told(self, chunk: str) -> list[str]:
        """The words of a text without blanks, in byte letters."""
        if self.patterned and PLAIN.fullmatch(chunk):
            words = PLAIN_WORDS.findall(chunk.lower())
            return words if chunk.isascii() else [w.encode().decode("latin-1").translate(self.letters) for w in words]
        return [w for w, _ in self.split(self.normalise(chunk))]

    def _learn(self, chunks: Iterable[bytes]) -> None:
        if len(self.words) > self.memory:
            self.words.clear()
            release()
        told = [(chunk, self._told(chunk.decode("utf-8", "replace"))) for chunk in chunks]
        new = list({w: None for _, words in told for w in words if w not in self.words})
        parts = self.cuts.fragments(new)
        last = self._merge(list({p[-1]: None for p in parts}), True)
        inner = self._merge(list({f: None for p in parts for f in p[:-1]}), False)
        self.words.update((w, last[p[0]] if len(p) == 1 else b"".join([inner[f] for f in p[:-1]]) + last[p[-1]]) for w, p in zip(new, parts, strict=True))
        known = self.words
        self.chunks.update((chunk, known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words])) for chunk, words in told)

    def _plain(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts that hold no special token; ASCII blanks are cuts that change nothing around them."""
        if len(self.chunks) > self.memory:
            self.chunks.clear()
            release()
        split = [t.split() for t in texts]
        self._learn(set().union(*split) - self.chunks.keys())
        find = self.chunks.__getitem__
        return [b"".join(map(find, words)) for words in split]

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        cut = [self.between.split(t) if self.between else [t] for t in texts]
        ids = iter(self._plain([p for parts in cut for p in parts[::2]]))  # what stands between special tokens
        return [b"".join([next(ids) if at % 2 == 0 else self.special[p].to_bytes(4, "little") for at, p in enumerate(parts)]) for parts in cut]


def encode(docs: DataFrame, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """The ids of every whole text: (doc_id, n_tokens, ids), ids as little-endian unsigned 32-bit numbers.

    Needs `doc_id` and `text`; other columns are ignored, whatever their names. A null, empty or blank text has no ids; a null id
    stays null; repeated rows are encoded each; an empty table gives no rows. Nothing is shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared(f"forced_{tokenizer}", lambda: ForcedEncoder(tokenizer))
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for part in slices(texts, 1 << 21):
                ids = encoder.texts(texts[part])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.start, len(ids)), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n_tokens", "ids"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Decoder:
    """Texts of ids as the tokenizers library gives them, special tokens included."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(tokenizer_file(path))
        self.whole = whole if whole.decoder else None  # without a decoder in the file, tokens are joined by blanks
        self.token = {i: t for t, i in whole.get_vocab().items()}

    def text(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        if self.whole:
            return self.whole.decode(numbers, skip_special_tokens=False)
        return " ".join([t for t in map(self.token.get, numbers) if t is not None])


def decode(encoded: DataFrame, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """The text of every row's ids: (doc_id, n_tokens, ids, decoded).

    Takes what `encode` returns. Null or no ids give the empty text; ids that the vocabulary lacks are left out, as the library does.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = shared(f"decoder_{tokenizer}", lambda: Decoder(tokenizer))
        for batch in batches:
            ids = [x or b"" for x in batch.column(2).to_pylist()]
            for part in slices(ids, 1 << 21):
                texts = [decoder.text(x) for x in ids[part]]
                kept = [c.slice(part.start, len(texts)) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    rows = encoded.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("decoded", T.StringType())]))
