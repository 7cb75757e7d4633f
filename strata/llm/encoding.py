"""Token ids of texts by a public tokenizer, with the ids of frequent words kept.

The tokenizers cut a text in front of white space that follows a character which is none, so a
text cut at its blanks is the sequence of its parts, and equal parts have equal ids. Each worker
keeps the ids of the parts it has met lately. Texts in which a part ends in white space (several
blanks in a row, say) are encoded whole.

New parts are encoded many at a time, joined by blanks, which costs less than a text each. The
ids are cut where a token begins with the vocabulary's mark of a blank or, in vocabularies that
mark the ends of words, after such an end; that only for parts of letters, which are one word.
Where the number of pieces is not that of the parts, each part is encoded by itself.

A part that ends in one or two ASCII marks ("word," say) is the part without them and the marks,
if the tokenizer cuts between a letter and these marks; so it needs no encoding of its own.

Where the tokenizer itself makes blanks of white space or small letters of capitals before all
else, texts get blanks for line breaks and small letters first, which leaves fewer kinds of parts.
"""

from __future__ import annotations

import json
import os
import re
import string
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

# Parts in each of the two generations that a worker remembers.
KEPT = 500_000
_BLOCK = 1 << 20
_UNSAFE = b"?"  # Stands for a part after which a text may not be cut.
_JOINED = 500  # Parts encoded as one text.
# How vocabularies mark a blank in front of a word, and the end of a word.
_BLANK, _WORD_END = "\u0120", "</w>"
# Fixed value: a capital that becomes a letter and a mark in lower case, two words for a tokenizer.
_TWO_LETTERS = "\u0130"
# Latin, Greek and Cyrillic letters, which all tables of characters know, and one or two marks;
# more are left alone, which bounds the kinds of endings.
_WITH_MARKS = re.compile(rf"([^\W\d_{_TWO_LETTERS}\u0530-\U0010FFFF]+)([{re.escape(string.punctuation)}]{{1,2}})")
# Steps of a normalizer that come to the same after line breaks are blanks and A-Z are a-z.
_TO_BLANK = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
_LOWER, _LEVELLING = {"type": "Lowercase"}, [{"type": "NFC"}, {"type": "Lowercase"}, _TO_BLANK]
_LINES = re.compile(r"[ \n]+")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker for a tokenizer file."""
    return Encoder(path)


def id_bytes(ids: Iterable[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    numbers = array("I", ids)
    return numbers.tobytes()


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes | None] = {}
        tokens = self.tokenizer.get_vocab(with_added_tokens=True)
        size = 1 + max(tokens.values(), default=0)
        self.begins, self.ends = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        for token, at in tokens.items():
            self.begins[at] = token.startswith(_BLANK)
            self.ends[at] = token.endswith(_WORD_END)
        # Either mark may also be a letter of the other kind of vocabulary.
        self.by_ends = bool(self.ends.sum() > self.begins.sum())
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        normalizer = made.get("normalizer") or {}
        steps = normalizer.get("normalizers", [normalizer])
        known = all(step in _LEVELLING for step in steps)
        self.blanks, self.lowers = known and _TO_BLANK in steps, known and _LOWER in steps
        # Found in a text before it is normalised, so levelling must not make or break one.
        self.added = {self._levelled(token["content"]) for token in made.get("added_tokens") or ()} - {""}

    def __call__(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers; NULL is empty."""
        block, size = [], 0
        for text in texts:
            block.append(self._plain(text or ""))
            size += len(block[-1])
            if size >= _BLOCK:
                yield from self._block(block)
                block, size = [], 0
        yield from self._block(block)

    def _plain(self, text: str) -> str:
        """A text with the same ids and fewer kinds of parts."""
        levelled = self._levelled(text)
        return text if any(token in levelled for token in self.added) else levelled

    def _levelled(self, text: str) -> str:
        if self.blanks and "\n" in text:
            text = _LINES.sub(" ", text) if "\n\n" in text or " \n" in text or "\n " in text else text.replace("\n", " ")
        if self.lowers:
            try:
                # Bytes have small letters for A-Z alone. Beyond Latin-1 there are marks that join
                # the letter before them, small letters other than capitals.
                text = text.encode("latin-1").lower().decode("latin-1")
            except UnicodeEncodeError:
                pass
        return text

    def _block(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > KEPT:
            self.known, self.older = {}, self.known
        # The first part of a text has no blank in front of it, all others have.
        heads = self._encoded([text.partition(" ")[0] for text in texts])
        cut = [text.split(" ")[1:] for text in texts]
        missing: set[str] = set()
        for parts in cut:
            missing.update(parts)
        # Looks each of the few up among the many, not the other way round.
        self._learn(missing.difference(self.known))
        ids, done = self.known.__getitem__, []
        for text, head, parts in zip(texts, heads, cut):
            found = list(map(ids, parts))
            unsafe = _UNSAFE in found or (parts and text[text.index(" ") - 1 : -1][:1].isspace())
            done.append(self._encoded([text])[0] if unsafe else head + b"".join(found))
        return done

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [id_bytes(one.ids) for one in found]

    def _learn(self, parts: set[str]) -> None:
        new = self._not_recalled(parts)
        stems = self._stems(new)
        unmet = self._not_recalled(set(stems.values()).difference(self.known))
        self._encode_parts(new.difference(stems).union(unmet))
        known, tails = self.known, self.tails
        known.update([(p, known[s] + tails[p[len(s) :]]) for p, s in stems.items()])

    def _not_recalled(self, parts: set[str]) -> set[str]:
        """Those of the parts that the older generation does not have either."""
        again = {p: self.older[p] for p in parts if p in self.older}
        self.known.update(again)
        return parts.difference(again)

    def _stems(self, parts: set[str]) -> dict[str, str]:
        """Parts of letters with marks at their end, and what is left without the marks."""
        found, read = {}, _WITH_MARKS.fullmatch
        for part in parts:
            if not part.isalpha() and (match := read(part)) is not None:
                stem, marks = match.groups()
                if stem.isalpha() and self._tail(marks) is not None:
                    found[part] = stem
        return found

    def _tail(self, marks: str) -> bytes | None:
        """The ids of marks behind a letter; None if they may belong to the letter's piece."""
        if marks not in self.tails:
            text, cut = "a" + marks, self.tokenizer.pre_tokenizer
            pieces = cut.pre_tokenize_str(text) if cut else []
            normal = self.tokenizer.normalizer
            same = normal is None or normal.normalize_str(text) == text
            apart = same and any(end == 1 for _, (_, end) in pieces)
            self.tails[marks] = self._encoded([marks])[0] if apart else None
        return self.tails[marks]

    def _encode_parts(self, new: set[str]) -> None:
        unsafe = {p for p in new if not p or p[-1].isspace()}
        self.known.update((p, _UNSAFE) for p in unsafe)
        joined = [p for p in new.difference(unsafe) if self._is_one_piece(p)]
        alone = list(new.difference(unsafe).difference(joined))
        for at in range(0, len(joined), _JOINED * 16):
            block = joined[at : at + _JOINED * 16]
            chunks = [block[k : k + _JOINED] for k in range(0, len(block), _JOINED)]
            texts = ["".join([" " + p for p in chunk]) for chunk in chunks]
            for chunk, ids in zip(chunks, self._encoded(texts)):
                if (cut := self._cut(ids, len(chunk))) is None:
                    alone += chunk
                else:
                    self.known.update(zip(chunk, cut))
        self.known.update(zip(alone, self._encoded([" " + p for p in alone])))

    def _is_one_piece(self, part: str) -> bool:
        if not self.by_ends:
            return bool(self.begins.any())
        return part.isalpha() and _TWO_LETTERS not in part

    def _cut(self, ids: bytes, parts: int) -> list[bytes] | None:
        """The ids of each part of a joined text; None if the marks do not tell the parts."""
        numbers = np.frombuffer(ids, dtype="<u4")
        if self.by_ends:
            edges = np.append(0, np.flatnonzero(self.ends[numbers]) + 1)
            whole = len(edges) == parts + 1 and edges[-1] == len(numbers)
        else:
            edges = np.flatnonzero(self.begins[numbers])
            whole = len(edges) == parts and edges[0] == 0
            edges = np.append(edges, len(numbers))
        if not whole:
            return None
        places = (4 * edges).tolist()
        return [ids[a:b] for a, b in zip(places, places[1:])]
