"""Token ids of whole texts by a vocabulary file of the tokenizers library.

A text in which every white space is a single space or line feed between other signs is cut before
these; each distinct piece is encoded once and remembered by the worker. A cut there never changes
the ids: the patterns of both vocabularies start a new unit at such a place. Every other text, and
one that holds an added token such as `<|endoftext|>`, is encoded whole.
"""
from __future__ import annotations

import os
import re
import unicodedata

import numpy as np

#: Pieces that a worker remembers before it drops the rare ones.
CACHE_ENTRIES = 600_000
#: Pieces that are encoded as one text.
JOINED = 256
#: The sign that stands for each byte in byte-level vocabularies: itself if it prints, else the
#: next one from U+0100 on.
_PRINTS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SIGNS = {b: chr(b) for b in _PRINTS} | {b: chr(0x100 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PRINTS)))}
_ODD = re.compile(r"[^\S \n]")
_loaded: dict[tuple[str, bool], "Encoder"] = {}


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Numbered(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = at = len(self)
        self.new.append(key)
        return at


class Encoder:
    def __init__(self, path: str, keeps_spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # a plain search for the signs that all begin with spares most texts the pattern
        self.added_start = re.match(r"[^A-Za-z]*", os.path.commonprefix(added)).group()
        self.added_token = re.compile("|".join(map(re.escape, added)) or "(?!)", re.IGNORECASE)
        self.keeps_spaces = keeps_spaces
        self.mark = "\0" if keeps_spaces else " \0 "
        self.mark_id = self.tokenizer.encode("\0", add_special_tokens=False).ids[0]
        if not keeps_spaces:
            self.units = Tokenizer.from_file(path)
            self.units.normalizer, self.units.pre_tokenizer = None, WhitespaceSplit()
        self.forget()

    def forget(self) -> None:
        self.known, self.done = Numbered(), 0
        self.begin, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.uses = np.zeros(1 << 12, np.int64)
        self.ids, self.used = np.zeros(1 << 14, np.uint32), 0

    def trim(self) -> None:
        """Keep the pieces met most often, at most half of what is remembered, and drop the rest."""
        keep = np.flatnonzero(self.uses[: self.done] > 1)
        if len(keep) > CACHE_ENTRIES // 2:
            keep = np.sort(keep[np.argsort(-self.uses[keep], kind="stable")[: CACHE_ENTRIES // 2]])
        names, ids, size, uses = list(self.known), self.gather(keep), self.size[keep], self.uses[keep]
        self.forget()
        self.known.update(zip([names[i] for i in keep], range(len(keep))))
        self.room(len(keep))
        self.keep(np.arange(len(keep)), ids, size)
        self.uses[: len(keep)], self.done = uses // 2, len(keep)

    def room(self, n: int) -> None:
        while n > len(self.begin):
            self.begin, self.size, self.uses = (np.concatenate((x, np.zeros_like(x))) for x in (self.begin, self.size, self.uses))

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces that were numbered anew, many in one text with a mark between them."""
        self.room(len(self.known))
        letters = [] if self.keeps_spaces else [i for i, p in enumerate(pieces) if p.isalpha() or p[-1:] in ".," and p[:-1].isalpha()]
        chosen = set(letters)
        for numbers, f in ((letters, self.encode_letters), ([i for i in range(len(pieces)) if i not in chosen], self.encode_marked)):
            for i in range(0, len(numbers), JOINED * 32):
                part = numbers[i : i + JOINED * 32]
                joins = [[pieces[k] for k in part[j : j + JOINED]] for j in range(0, len(part), JOINED)]
                for j, (ids, sizes) in enumerate(f(joins)):
                    self.keep(self.done + np.array(part[j * JOINED : j * JOINED + len(sizes)]), ids, sizes)
        self.done = len(self.known)

    def keep(self, numbers: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        used = self.used + len(ids)
        while used > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(len(self.ids), np.uint32)))
        self.begin[numbers] = self.used + np.cumsum(sizes) - sizes
        self.size[numbers] = sizes
        self.ids[self.used : used] = ids
        self.used = used

    def encode_marked(self, joins: list[list[str]]):
        """Ids and sizes of the pieces of each join."""
        found = self.tokenizer.encode_batch_fast([self.mark.join(p) for p in joins], add_special_tokens=False)
        return [self.divide(p, e.ids) for p, e in zip(joins, found)]

    def encode_letters(self, joins: list[list[str]]):
        """The same for words of letters, which need no pattern to be cut: given as the signs that
        stand for their bytes, normalised and in lower case already, units between spaces."""
        texts = ["\0".join(p) for p in joins]
        if not all(t.isascii() or unicodedata.is_normalized("NFC", t) and t == t.lower() for t in texts):
            return self.encode_marked(joins)
        signs = [t.encode().decode("latin-1").translate(_SIGNS) for t in texts]
        found = self.units.encode_batch_fast([t.replace(_SIGNS[0], f" {_SIGNS[0]} ").replace(".", " .").replace(",", " ,") for t in signs], add_special_tokens=False)
        return [self.divide(p, e.ids) for p, e in zip(joins, found)]

    def divide(self, pieces: list[str], ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(ids, np.uint32)
        cuts = np.flatnonzero(ids == self.mark_id)
        if len(cuts) == len(pieces) - 1:
            ids = np.delete(ids, cuts)
            return ids, np.diff(np.concatenate(([0], cuts - np.arange(len(cuts)), [len(ids)])))
        each = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]  # a piece holds the mark
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter((x for ids in each for x in ids), np.uint32, int(sizes.sum())), sizes

    def cut(self, text: str) -> list[str] | None:
        """Pieces that are encoded by themselves; None if the text must be encoded whole."""
        if _ODD.search(text) or "\0" in text:
            return None
        if self.added_start in text and self.added_token.search(text):
            return None
        if not self.keeps_spaces:
            return (text if "\u03a3" in text else text.lower()).replace("\n", " ").split(" ")
        if not text[0].isalnum() or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return None
        return text.replace("\n", "\0\n").replace(" ", "\0 ").split("\0")

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; null and empty texts have none."""
        if len(self.known) > CACHE_ENTRIES:
            self.trim()
        cut = [self.cut(t) if t else [] for t in texts]
        number = self.known.__getitem__
        at = [None if c is None else np.fromiter(map(number, c), np.int64, len(c)) for c in cut]
        if self.known.new:
            self.learn(self.known.new)
            self.known.new = []
        for a in at:
            if a is not None:
                np.add.at(self.uses, a, 1)
        whole = [i for i, c in enumerate(cut) if c is None]
        direct = dict(zip(whole, self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)))
        return [np.array(direct[i].ids, np.uint32) if a is None else self.gather(a) for i, a in enumerate(at)]

    def gather(self, at: np.ndarray) -> np.ndarray:
        if not len(at):
            return np.zeros(0, np.uint32)
        size = self.size[at]
        stop = np.cumsum(size)
        return self.ids[np.arange(stop[-1]) + np.repeat(self.begin[at] - (stop - size), size)]


def encoder(path: str, keeps_spaces: bool) -> Encoder:
    """The worker's encoder of this file, loaded once. keeps_spaces: white space has ids of its own."""
    if (path, keeps_spaces) not in _loaded:
        _loaded[path, keeps_spaces] = Encoder(path, keeps_spaces)
    return _loaded[path, keeps_spaces]


def release() -> None:
    """Drop what a reused worker remembers of encoders: other work needs the memory."""
    _loaded.clear()
