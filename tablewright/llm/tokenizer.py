"""Pre-tokens and ids of a word-level BPE file, as its library gives them."""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from collections.abc import Iterator

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The normaliser and the split pattern of the tokenizer files that these operators read.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

#: Texts of these characters alone need no normaliser but str.lower: printable ASCII and Latin letters up to U+017F.
_PLAIN = re.compile("[^\t\n\r -~¡-įı-ſ]")
_PIECE = 1 << 20


def _character_class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x180) if unicodedata.category(chr(c))[0] == kind)


class WordTokenizer:
    """One tokenizer file. Pre-tokens never cross white space, and the model looks at one pre-token at a time."""

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if kinds != NORMALIZERS or splits[:1] != [PATTERN]:
            raise ValueError(f"{path} doesn't normalise and split as these operators do")
        self.whole = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self._split = pre_tokenizers.Split(Regex(PATTERN), "removed", invert=True)
        # The model alone: a pre-token is not normalised or split again.
        self.model = Tokenizer.from_str(json.dumps({**spec, "normalizer": None, "added_tokens": [], "pre_tokenizer": spec["pre_tokenizer"]["pretokenizers"][-1]}))
        letters, digits = _character_class("L"), _character_class("N")
        self._pieces = re.compile(f"[{letters}]+|'(?:[stmd]|re|ve|ll)|[{digits}]|[^\\s{letters}{digits}]+")

    def plain(self, text: str) -> bool:
        return "<|" not in text and (text.isascii() and text.isprintable() or _PLAIN.search(text) is None)

    def pretokens(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, in lists of bounded length; a special string is a pre-token of its own."""
        for part in [text] if self.plain(text) else self._cut.split(text):
            if part in self.special:
                yield [part]
            elif self.plain(part):
                for piece in _pieces(part):
                    yield self._pieces.findall(piece.lower())
            else:
                for piece in _pieces(part):
                    yield [p for p, _ in self._split.pre_tokenize_str(self.whole.normalizer.normalize_str(piece))]

    def pieces(self, lowered: str) -> list[str]:
        """The pre-tokens of a plain text in lower case."""
        return self._pieces.findall(lowered)

    def counts(self, pretokens: list[str]) -> list[int]:
        """How many ids each pre-token has."""
        out = []
        for i in range(0, len(pretokens), 4096):
            out += [len(e) for e in self.model.encode_batch_fast(pretokens[i : i + 4096], add_special_tokens=False)]
        return [1 if p in self.special else n for p, n in zip(pretokens, out)]


def _pieces(text: str) -> Iterator[str]:
    """A very long text in pieces, cut at ASCII spaces or line ends; a run without any is one piece."""
    start = 0
    while len(text) - start > 2 * _PIECE:
        space = re.compile("[ \n]").search(text, start + _PIECE)
        if space is None:
            break
        yield text[start : space.start()]
        start = space.start()
    yield text[start:] if start else text


@functools.lru_cache(maxsize=4)
def load(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
