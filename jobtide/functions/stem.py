"""English suffix stripping after Porter (1980), made for the distinct words of some texts."""

from __future__ import annotations

import re
from functools import lru_cache


# Suffix rules of steps 2, 3 and 4.
STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
         "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
         "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
         "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
         "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


def _shape(word: str) -> str:
    """The word as vowels (v) and consonants (c); y is a vowel after a consonant."""
    out = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(word: str) -> int:
    return len(re.findall("v+c", _shape(word)))


def _short_end(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    hits = [s for s in suffixes if word.endswith(s)]
    return max(hits, key=len) if hits else None


def stem(word: str) -> str:
    """Stem of a lower-case word."""
    if len(word) <= 2 or not word.isascii() or not word.isalpha():
        return word
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        end = _longest(word, ["ed", "ing"])
        if end and "v" in _shape(word[:-len(end)]):
            word = word[:-len(end)]
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif _shape(word)[-2:] == "cc" and word[-1] == word[-2] and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _short_end(word):
                word += "e"
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    for table in (STEP2, STEP3):
        end = _longest(word, table)
        if end and _measure(word[:-len(end)]) > 0:
            word = word[:-len(end)] + table[end]
    end = _longest(word, STEP4)
    if end and _measure(word[:-len(end)]) > 1 and (end != "ion" or word[:-3].endswith(("s", "t"))):
        word = word[:-len(end)]
    if word.endswith("e"):
        body = word[:-1]
        if _measure(body) > 1 or (_measure(body) == 1 and not _short_end(body)):
            word = body
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


@lru_cache(1 << 18)
def known_stem(word: str) -> str:
    """The stem of a word; a task remembers those of frequent words."""
    return stem(word)
