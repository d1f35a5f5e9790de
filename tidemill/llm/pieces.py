"""Splitting texts into the pieces that a byte-level BPE vocabulary encodes one by one."""

from __future__ import annotations

import json
import os
import re

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: The splitting pattern of the byte-level vocabulary, for texts without any character of OTHER.
PIECES = re.compile(r" ?[^\W\d_]+| ?\d+|'(?:s|t|re|ve|m|ll|d)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Any character on which Unicode versions or engines may differ; texts with one are split by the library itself.
OTHER = re.compile(r"[^\t\n\x0b\x0c\r\x20-\x7e¡-±´-¸º»¿-ɏ‐-‧€]")


class TwoGenerations(dict):
    """Dictionary of at most twice ``limit`` entries: when full it becomes the older half, hits move back."""

    def __init__(self, make, limit: int = 250_000):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        return self.put(key, self.make(key) if value is None else value)

    def put(self, key, value):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Splitter:
    """A tokenizers file whose pieces are encoded alone: a text's ids are those of its pieces in order."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        pre = self.spec["pre_tokenizer"]
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or self.spec["normalizer"]:
            raise ValueError("only byte-level vocabularies without normalizer and prefix space")
        self.library = Tokenizer.from_file(path)
        self.special_ids = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        by_length = sorted(self.special_ids, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, by_length))) if by_length else None

    def split(self, text: str) -> list[str | bytes]:
        """Pieces of the text in order; special tokens are bytes."""
        if self.special is None or self.special.search(text) is None:
            return self._ordinary(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [*self._ordinary(text[at : m.start()]), m.group().encode()]
            at = m.end()
        return out + self._ordinary(text[at:])

    def _ordinary(self, text: str) -> list[str]:
        if OTHER.search(text) is None:
            return PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
