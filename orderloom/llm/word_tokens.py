"""Token ids of whole texts, with the ids of words met before kept at hand."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: Words whose ids a worker keeps; the store starts anew when it is full.
KNOWN_WORDS = 400_000
#: Longer words go to the tokenizer itself and are not kept.
LONG_WORD = 100
#: Words of these characters are composed and lower-cased alike by Python and the tokenizer.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch
ENDING = b"\xff"
ENDS = frozenset(".,;:!?")


class WordIds(dict):
    """Word to its ids, as little-endian unsigned 32-bit numbers; fills itself."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.special = [t["content"] for t in settings["added_tokens"]]
        pieces = settings["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pieces).findall
        self.merge, ids = merging(settings["model"], pieces)
        self.octets = [number.tobytes() for number in ids]

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(word) > LONG_WORD:
            return self.whole(word)
        if not PLAIN(word) or ("<" in word and any(s in word for s in self.special)):
            found = self.whole(word)
        elif (low := word.lower()) != word:
            found = self[low]
        elif word[-1] in ENDS and word[:-1].isalpha():
            # Letters and marks are never merged, so the parts may be known already.
            found = self[word[:-1]] + self[word[-1]]
        else:
            octets = self.octets
            found = b"".join(
                [
                    octets[rank]
                    for piece in ((word,) if word.isalpha() else self.pieces(word))
                    for rank in self.merge(piece.encode() + ENDING)
                ]
            )
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def merging(model: dict, pattern: str):
    """A byte-pair merger for words that end in ``ENDING``, and the id of each of its ranks.

    The model's last symbol of a word carries a suffix. Here the suffix is a byte of its own that
    merges with the one before it ahead of all other merges, which comes to the same.
    """
    suffix, letters = model["end_of_word_suffix"], byte_letters()

    def octets(token: str) -> bytes:
        body = token.removesuffix(suffix)
        return bytes(letters[c] for c in body) + (ENDING if body != token else b"")

    ranks = {bytes([b]): b for b in range(256)}
    for b in range(255):
        ranks[bytes([b]) + ENDING] = len(ranks)
    for rule in model["merges"]:
        left, right = rule if isinstance(rule, list) else rule.split(" ")
        ranks.setdefault(octets(left + right), len(ranks))
    ids = np.zeros(len(ranks), "<u4")
    for token, number in model["vocab"].items():
        if all(c in letters for c in token.removesuffix(suffix)) and octets(token) in ranks:
            ids[ranks[octets(token)]] = number
    merger = tiktoken.Encoding(
        "words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )
    return merger._core_bpe.encode_single_piece, ids


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand for
    themselves, the others follow from code point 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TextIds:
    """Ids of any tokenizer file, text by text."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> WordIds | TextIds:
    """The encoder of a tokenizer file, one for each worker process. Vocabularies with word ends
    that drop white space are encoded word by word, others as a whole."""
    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    split = (settings.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    by_word = (
        settings["model"].get("end_of_word_suffix")
        and split[0].get("invert")
        and split[0].get("behavior") == "Removed"
        and [n["type"] for n in (settings.get("normalizer") or {}).get("normalizers", [])]
        == ["NFC", "Replace", "Lowercase"]
    )
    return WordIds(path) if by_word else TextIds(path)
