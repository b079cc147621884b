"""Token ids and counts of a byte-level BPE file through the tokenizers
library, one call per distinct piece of text.

A text may be cut before any space that a non-space follows: the pre-token
pattern takes such a space with what follows, and the tokens of the parts
are those of the whole.  So a text is a list of such parts, few of them
distinct, and each distinct part is tokenised once.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

#: Fixed value: the pre-token pattern of byte-level BPE.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Marks that the pattern takes as one pre-token when they follow a word; the
#: apostrophe isn't one, as it may start a pre-token with letters.
_MARKS = ".,;:!?)"

_CUT = re.compile(r" (?=\S)")


class ByteBpe:
    """One tokenizer file, opened once per Python process (:func:`opened`)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        pre = said.get("pre_tokenizer") or {}
        if said.get("normalizer") or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space"):
            raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in said["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take in their surroundings")
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.at_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        whole = Tokenizer.from_file(path)
        self.model = whole.model
        self.highest = max(whole.get_vocab(with_added_tokens=True).values())
        self.pretokens = regex.compile(PRETOKENS).findall
        self.table = _byte_letters()
        self.space = chr(self.table[32])
        self.known = _Known(self)
        self.id4 = [i.to_bytes(4, sys.byteorder) for i in range(self.highest + 1)]

    def ids(self, pretoken: str) -> list[int]:
        """Token ids of one pre-token."""
        return [t.id for t in self.model.tokenize(self._letters(pretoken))]

    def ids_of(self, part: str) -> bytes:
        """Token ids of a part of :func:`parts`, 4 bytes each.  A part that comes
        for the first time is mostly a word of its own, perhaps with marks: its
        word is tokenised without being remembered; other pre-tokens that were
        seen in other parts aren't tokenised again."""
        known = self.known
        word = part if part.isalpha() else part.rstrip(_MARKS)
        if word.isalpha():
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.table)
            id4 = self.id4
            out = b"".join([id4[t.id] for t in self.model.tokenize(self.space + letters)])
            return out if len(word) == len(part) else out + known[part[len(word) :]]
        out = b"".join([known[t] for t in self.pretokens_of(part)])
        if len(known) > KNOWN:
            known.clear()
        return out

    def count(self, pretoken: str) -> int:
        if pretoken in self.special:
            return 1
        return len(self.model.tokenize(self._letters(pretoken)))

    def _letters(self, pretoken: str) -> str:
        if pretoken[0] == " " and pretoken.isascii() and pretoken[1:].isalpha():
            return self.space + pretoken[1:]  # letters of ASCII stand for themselves
        return pretoken.encode().decode("latin-1").translate(self.table)

    def pretokens_of(self, part: str) -> list[str]:
        """Pre-tokens of a part of :func:`parts`."""
        if part[0] != " ":  # mostly a word, perhaps with a mark behind
            word = part.rstrip(_MARKS)
            if word.isalpha():
                return [" " + word] if len(word) == len(part) else [" " + word, part[len(word) :]]
            if "\n" in part:  # a word, perhaps marks, a line break, a word, ...
                out = []
                for k, line in enumerate(part.split("\n")):
                    word = line.rstrip(_MARKS)
                    if not word.isalpha():
                        return self.pretokens(spelled(part))
                    out.append("\n" if k else "")
                    out += [word if k else " " + word, line[len(word) :]]
                return list(filter(None, out))
        return self.pretokens(spelled(part))

    def runs(self, text: str) -> list[tuple[bool, str]]:
        """The text cut at special strings: (is special, string)."""
        if self.at_special is None or not any(s in text for s in self.special):
            return [(False, text)]
        out, at = [], 0
        for m in self.at_special.finditer(text):
            out += [(False, text[at : m.start()]), (True, m.group())]
            at = m.end()
        return [*out, (False, text[at:])]


#: Pre-tokens whose ids one Python process remembers.
KNOWN = 100_000


class _Known(dict):
    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe

    def __missing__(self, pretoken: str) -> bytes:
        out = array("I", self.bpe.ids(pretoken)).tobytes()
        if len(pretoken) <= 64:
            self[pretoken] = out
        return out


def _byte_letters() -> dict[int, int]:
    """Byte-level BPE spells each byte as one printable letter: a byte that is
    printable in Latin-1 as itself, the others as 256, 257, ... in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(rest)}


_OPEN: dict[str, ByteBpe] = {}


def opened(path: str) -> ByteBpe:
    if path not in _OPEN:
        _OPEN[path] = ByteBpe(path)
    return _OPEN[path]


def parts(text: str) -> list[str]:
    """``text`` cut before every space that a non-space follows.  The first
    part is marked by a space in front, the others have theirs removed; as
    they start with a non-space, no part can be taken for a first one."""
    out = _CUT.split(text)
    out[0] = " " + out[0]
    return out


def cut_at_spaces(text: str) -> list[str]:
    """Cheaper than :func:`parts`, and the same unless a part is :func:`odd`."""
    out = text.split(" ")
    out[0] = " " + out[0]
    return out


def odd(part: str) -> bool:
    """A cut before this part of :func:`cut_at_spaces` isn't one of :func:`parts`."""
    return not part or part[0] != " " and part[0].isspace()


def spelled(part: str) -> str:
    """The text that a part of :func:`parts` stands for."""
    return part[1:] if part[0] == " " else " " + part
