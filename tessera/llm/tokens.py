"""Whole-text tokenisation that encodes each distinct chunk once per worker.

A text is cut only where the tokenizer's own pre-tokenizer always cuts, so the
concatenated chunk ids equal the ids of the whole text. Chunk ids are kept as
little-endian uint32 bytes in a two-generation cache of bounded size.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

CACHE_CHUNKS = 150_000
#: Texts are worked on in groups of about so many characters.
GROUP_CHARS = 1_000_000
#: White space other than blank, tab, CR and LF: such texts are encoded whole.
ODD_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]").search
#: Marks behind a word: with the letters before them they are two pre-tokens.
MARKS = ".,;:!?*$%&#|"
#: Letters are told from marks only below this code point, where all versions of
#: Unicode agree on them; other chunks are encoded whole.
LATIN = "\u0250"
CHUNKS = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+").findall


class ChunkIds:
    """chunk -> ids as bytes in `now`, for all chunks given to `fill` last. Those
    seen before come from one of two generations; the rest are encoded together."""

    def __init__(self, encode, fold: bool):
        self.encode, self.fold = encode, fold
        self.now, self.old = {"": b""}, {}

    def _parts(self, chunk: str) -> tuple[str, str]:
        """A word (with one blank before it, if there is one) and its marks."""
        letters = chunk.rstrip(MARKS)
        folded = letters.lower() if self.fold else letters
        # a letter that folds to a letter and a combining mark joins what follows
        if len(folded) != len(letters) or not (letters.isalpha() or (letters[:1] == " " and letters[1:].isalpha())) or not (letters.isascii() or max(letters) < LATIN):
            return chunk, ""
        return folded, chunk[len(letters) :]

    def fill(self, chunks: set[str]) -> None:
        if len(self.now) + len(chunks) > CACHE_CHUNKS:
            self.now, self.old = {"": b""}, self.now
        now, old = self.now, self.old
        new = chunks.difference(now)  # a plain dict: looked up, not walked through
        now.update((c, old[c]) for c in new if c in old)
        new = new.difference(now)
        parts = {c: self._parts(c) for c in new}
        need = {x for pair in parts.values() for x in pair}.difference(now)
        now.update(zip(need, self.encode(list(need))))
        for c, (letters, marks) in parts.items():
            if c != letters:
                now[c] = now[letters] + now[marks]


class TextEncoder:
    """Ids of texts by the tokenizers library, without special tokens added.

    Byte-level files without a normalizer are cut at the start of each run of
    white space. Word-end files that drop white space (end_of_word_suffix) are
    cut at blanks and line feeds. Any other file is encoded text by text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        pre = kind.get("pre_tokenizer") or {}
        self.by_words = kind["model"].get("end_of_word_suffix") == "</w>" and pre.get("type") == "Sequence"
        self.by_spaces = not kind.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex")
        self.ends = None
        if self.by_words:
            self.ends = np.zeros(self.lib.get_vocab_size() + 1, "bool")
            self.ends[[i for t, i in kind["model"]["vocab"].items() if t.endswith("</w>")]] = True
        self.cache = ChunkIds(self._encode, fold=self.by_words)

    def _encode(self, texts: list[str]) -> list[bytes]:
        """Words whose tokens end in a mark of their own are encoded in one text
        and cut there; anything else is encoded one by one."""
        if self.ends is None:
            return self._each(texts)
        words = [t for t in texts if t.isalpha()]
        found = dict(zip(words, self._joined(words)))
        rest = [t for t in texts if t not in found]
        found.update(zip(rest, self._each(rest)))
        return [found[t] for t in texts]

    def _each(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, words: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(words), 1000):
            own = words[at : at + 1000]
            [found] = self.lib.encode_batch_fast([" ".join(own)], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            cuts = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(cuts) == len(own):  # each word has one end at least, so one each
                flat, cuts = ids.tobytes(), cuts.tolist()
                out += [flat[a:b] for a, b in zip([0, *cuts], cuts)]
            else:
                out += self._each(own)
        return out

    def _chunks(self, text: str) -> list[str] | None:
        """None: the text has to be encoded whole."""
        if self.by_words:
            return text.replace("\n", " ").split(" ")
        return CHUNKS(text) if self.by_spaces and not ODD_SPACE(text) else None

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text, four bytes each."""
        out, group, size = [], [], 0
        for k, text in enumerate(texts):
            group.append(text)
            size += len(text)
            if size >= GROUP_CHARS or k == len(texts) - 1:
                split = [self._chunks(t) for t in group]
                self.cache.fill(set().union(*(s for s in split if s is not None)))
                get = self.cache.now.__getitem__
                out += [b"".join(map(get, s)) if s is not None else self._each([t])[0] for s, t in zip(split, group)]
                group, size = [], 0
        return out


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder a Python worker."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = TextEncoder(path)
    return _encoders[path]
