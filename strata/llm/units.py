"""Pre-token units of a tokenizer and their ids, cached in the worker.

A text is cut only where a character that the tokenizer's pattern counts
as white space follows one that it doesn't.  The pre-tokenizers handled
here always end a pre-token there, so the ids of a text are the ids of its
units in order.  Each unit is encoded by the tokenizers library once per
worker.  Other tokenizer files are encoded text by text.
"""

from __future__ import annotations

import json
import os
import re

from strata.llm.worker import kept

# The characters with the Unicode property White_Space.
WHITE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000")
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
WORD = re.compile(f"[^{WHITE}]+")
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
LATIN = frozenset(chr(c) for c in range(256) if re.match(f"[{LETTERS}]", chr(c)))
PLAIN = re.compile(f"( ?)([{LETTERS}]+)")
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"        # ASCII without letters, digits and the apostrophe
CONTROL = re.compile("[\x1c-\x1f]")

CACHE_ENTRIES = 300_000       # per worker (about 70 MB); a full cache starts again from the broadcast tier


def byte_letters() -> list[str]:
    """The printable letter that byte-level tokenizers write for each byte:
    printable Latin-1 bytes stand for themselves, the rest follow from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class Encoder:
    """ids(unit) through the library, with a short way for plain words.

    ``kind`` is "spaced" (byte-level, a space belongs to the next word, no
    normalizer), "words" (white space dropped, lower case, NFC) or "whole"
    (any other file: no units).
    """

    def __init__(self, spec: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(spec)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.model = self.lib.model
        self.kind = _kind(json.loads(spec))
        self.letters = dict(enumerate(byte_letters()))
        self.specials = [t.content for t in self.lib.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> list[int]:
        return self.lib.encode(text, add_special_tokens=False).ids

    def word(self, text: str) -> list[int]:
        """Ids of one pre-token made of Latin letters (and a space before)."""
        if not (text.isascii() and text.isalpha()):
            text = text.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(text)]

    def unit(self, unit: str) -> list[int]:
        if unit.isascii() and unit.isalpha() and self.kind != "whole":
            return [t.id for t in self.model.tokenize(unit.lower() if self.kind == "words" else unit)]
        if PLAIN.fullmatch(unit):
            if self.kind == "spaced":
                return self.word(unit)
            if self.kind == "words":
                return self.word(unit.lower())
        return self.encode(unit)

    def units(self, text: str) -> list[str]:
        if self.kind == "words":
            return WORD.findall(text) if CONTROL.search(text) else text.split()
        return UNIT.findall(text)

    def segments(self, text: str) -> list[str]:
        """The text cut at special strings, these as segments of their own.
        The library looks for them before anything else."""
        if not any(s in text for s in self.specials):
            return [text]
        return [p for p in re.split("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")", text) if p]


def _kind(spec: dict) -> str:
    pre, norm, model = spec.get("pre_tokenizer") or {}, spec.get("normalizer"), spec["model"]
    plain = (model["type"] == "BPE" and not model.get("dropout") and not spec.get("post_processor")
             and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                         for t in spec.get("added_tokens", [])))
    if not plain:
        return "whole"
    if (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
            and not norm):
        return "spaced"
    steps = [s["type"] for s in pre.get("pretokenizers", [])]
    norms = [s["type"] for s in (norm or {}).get("normalizers", [])]
    if (steps == ["Split", "ByteLevel"] and norms == ["NFC", "Replace", "Lowercase"]
            and pre["pretokenizers"][0]["behavior"] == "Removed"
            and pre["pretokenizers"][0]["pattern"].get("Regex", "").endswith("[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+")
            and not pre["pretokenizers"][1]["add_prefix_space"]):
        return "words"
    return "whole"


class UnitCache(dict):
    """unit -> value(ids); misses are encoded, long units are not kept.

    A run of punctuation after a letter and a line break before one always
    start a new pre-token, so such a unit is put together from its parts.
    """

    def __init__(self, encoder: Encoder, value, add, frequent: dict | None = None):
        super().__init__(frequent or {})
        self.encoder, self.value, self.add, self.frequent = encoder, value, add, frequent or {}

    def __missing__(self, unit: str):
        word = unit.rstrip(MARKS)
        if word and len(word) < len(unit) and word[-1] in LATIN and unit not in self.encoder.specials:
            v = self.add(self[word], self[unit[len(word):]])
        elif self.encoder.kind == "spaced" and len(unit) > 1 and unit[0] == "\n" and unit[1] in LATIN:
            v = self.add(self["\n"], self[unit[1:]])
        elif self.encoder.kind == "words" and unit.isascii() and unit.isalpha() and not unit.islower():
            v = self[unit.lower()]
        else:
            v = self.value(self.encoder.unit(unit))
        if len(unit) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
                self.update(self.frequent)
            self[unit] = v
        return v


def encoder(operator: str, spec: str, key: str) -> Encoder:
    """The worker's encoder for a tokenizer file (key: a hash of the file)."""
    return kept(operator, ("encoder", key), lambda: Encoder(spec))
