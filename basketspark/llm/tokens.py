"""Token ids of whole texts from a public tokenizer file, with a memory of pieces already encoded.

A text is cut at single spaces and line feeds between two non-space characters. For both kinds of vocabulary
such a cut is also a border for the tokenizer itself, so the ids of the parts, joined, are the ids of the whole
text; each new part is encoded once by the ``tokenizers`` library, and repeated parts are looked up. New parts go
to a byte-level vocabulary several at a time, with line feeds between them; where the ids hold another number of
line feeds than were set, and for other vocabularies, the parts are encoded one by one. The memory has two
generations of ``limit`` entries (about 250 bytes each), so a worker's memory stays bounded.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import chain

MARK = "\n"
BORDER = re.compile(r"(?<=\S) (?=\S)")
RARE = re.compile("[\0\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def evenly_spaced(text: str) -> bool:
    """Only single spaces and line feeds, none beside another and none at an end."""
    return not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n" or RARE.search(text))


class Encoder:
    """``ids(texts)``: little-endian unsigned 32-bit ids of each text as bytes; a null text has none.

    ``space_is_word_start``: a space belongs to the word after it (byte-level vocabularies); otherwise white
    space only separates words, and letters are lower-cased.
    """

    def __init__(self, path: str, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already has a worker for each core
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        one = [t.encode(x, add_special_tokens=False).ids for x in ("a", "b", "a b")]
        self.space_is_word_start = one[2] != one[0] + one[1]
        self.tokenizer, self.limit, self.known, self.old = t, limit, {}, {}
        added = t.get_added_tokens_decoder().values()
        self.marks = [a.content for a in added if not a.normalized]
        self.marks_any_case = [a.content.lower() for a in added if a.normalized]
        mark = t.encode(MARK, add_special_tokens=False).ids
        self.mark_id = mark[0] if self.space_is_word_start and len(mark) == 1 else None  # elsewhere a line feed has no id

    def joins(self, part: str) -> bool:
        """Whether a part may stand between marks: no white space at its ends but one space before a word."""
        if self.mark_id is None or not part or part[-1].isspace():
            return False
        return not part[0].isspace() or (part[0] == " " and not part[1].isspace())

    def _learn(self, new: list[str], at_once: int = 16) -> None:
        """Encode new parts into the memory."""
        known, alone, joined = self.known, [], []
        for part in new:
            (joined if self.joins(part) else alone).append(part)
        groups = [joined[i : i + at_once] for i in range(0, len(joined), at_once)]
        for own, e in zip(groups, self.tokenizer.encode_batch_fast([MARK.join(g) for g in groups], add_special_tokens=False)):
            ids = e.ids
            if ids.count(self.mark_id) != len(own) - 1:
                alone += own
                continue
            raw, lo = array("I", ids).tobytes(), 0
            for part in own[:-1]:
                hi = ids.index(self.mark_id, lo)
                known[part] = raw[4 * lo : 4 * hi]
                lo = hi + 1
            known[own[-1]] = raw[4 * lo :]
        for part, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            known[part] = array("I", e.ids).tobytes()

    def holds_mark(self, text: str) -> bool:
        """Whether a text holds the string of an added token; such a text is not cut."""
        if any(m in text for m in self.marks):
            return True
        return bool(self.marks_any_case) and any(m in text.lower() for m in self.marks_any_case)

    def parts(self, text: str) -> list[str]:
        if not self.space_is_word_start:
            return (text.lower() if text.isascii() else text).replace("\n", " ").split(" ")
        if evenly_spaced(text):
            return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        head, *rest = BORDER.split(text)
        return [head, *[" " + p for p in rest]]

    def ids(self, texts: list[str | None], chars: int = 1_500_000) -> list[bytes]:
        out, own, size = [], [], 0
        for t in texts:  # a bounded amount of text is cut into parts at a time
            own.append(t)
            size += len(t) if t else 0
            if size > chars:
                out += self._ids(own)
                own, size = [], 0
        return out + self._ids(own)

    def _ids(self, texts: list[str | None]) -> list[bytes]:
        cut = {t: [t] if self.holds_mark(t) else self.parts(t) for t in set(texts) if t}
        known, old = self.known, self.old
        new = []
        for part in set(chain.from_iterable(cut.values())).difference(known):
            if part in old:
                known[part] = old[part]
            else:
                new.append(part)
        self._learn(new)
        whole = {t: b"".join(map(known.__getitem__, parts)) for t, parts in cut.items()}
        if len(known) > self.limit:
            self.old, self.known = known, {}
        return [whole[t] if t else b"" for t in texts]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
