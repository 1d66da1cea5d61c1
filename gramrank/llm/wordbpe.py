"""Ids of whole texts under a word-level BPE tokenizer, one call per task batch.

The tokenizer library splits every text anew. In a corpus most words repeat, so a
word's ids are kept and a text becomes a join of kept byte strings. That shortcut
holds for texts of Latin-1 characters, where the normaliser is lower-casing alone,
and only for a tokenizer file with the split rule named below. Any other text or
file goes through the library as it is.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Fixed value: the split rule of the tokenizer files the shortcut is written for.
SPLIT_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same over lower-cased Latin-1 text without white space.
LATIN1_RULE = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d"
    "|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+"
    "|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    "|[^a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+"
)
#: Characters at which Python splits words and the tokenizer does not.
OTHER_SPACE = re.compile("[\x1c-\x1f]")
#: Words kept by a worker before it starts over; some 200 bytes each.
KEPT_WORDS = 400_000


class _KeptWords(dict):
    """Bytes of the ids of a blank-free chunk of lower-cased Latin-1 text."""

    def __init__(self, tokenizer, dtype: str):
        from tokenizers import pre_tokenizers

        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        blank = {9, 10, 11, 12, 13, 32, 133, 160}
        self.alphabet = {
            code: as_bytes.pre_tokenize_str(chr(code))[0][0]
            for code in range(256)
            if code not in blank
        }
        self.model, self.dtype = tokenizer.model, dtype

    def __missing__(self, chunk: str) -> bytes:
        ids = [
            token.id
            for word in LATIN1_RULE.findall(chunk)
            for token in self.model.tokenize(word.translate(self.alphabet))
        ]
        self[chunk] = packed = np.array(ids, dtype=self.dtype).tobytes()
        return packed


class WordBpe:
    """``encode`` gives a text's ids as little-endian bytes of ``dtype``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 65_536 else "<u4"
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        self.special = [token["content"] for token in layout["added_tokens"]]
        self.known = _has_split_rule(layout)
        self.kept = _KeptWords(self.tokenizer, self.dtype) if self.known else None

    def encode(self, text: str) -> bytes:
        if self.known and self._plain(text):
            if len(self.kept) > KEPT_WORDS:
                self.kept.clear()
            return b"".join(map(self.kept.__getitem__, text.lower().split()))
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=self.dtype).tobytes()

    def _plain(self, text: str) -> bool:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return False
        return not OTHER_SPACE.search(text) and not any(s in text for s in self.special)


def _has_split_rule(layout: dict) -> bool:
    steps = (layout.get("normalizer") or {}).get("normalizers") or []
    splits = (layout.get("pre_tokenizer") or {}).get("pretokenizers") or []
    return (
        [s.get("type") for s in steps] == ["NFC", "Replace", "Lowercase"]
        and steps[1].get("pattern") == {"Regex": "\\s+"}
        and steps[1].get("content") == " "
        and [s.get("type") for s in splits] == ["Split", "ByteLevel"]
        and splits[0].get("pattern") == {"Regex": SPLIT_RULE}
        and splits[0].get("behavior") == "Removed"
        and bool(splits[0].get("invert"))
        and not splits[1].get("add_prefix_space")
        and not splits[1].get("use_regex")
        and layout.get("post_processor") is None
        and all(not token.get("normalized") for token in layout["added_tokens"])
        and all(not token.get("lstrip") for token in layout["added_tokens"])
        and all(not token.get("rstrip") for token in layout["added_tokens"])
    )


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The worker's tokenizer for a file, read once."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]
