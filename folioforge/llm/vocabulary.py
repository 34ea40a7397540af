"""A byte-level vocabulary file of the tokenizers library, read for use inside tasks."""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import regex
from tokenizers import Tokenizer


def default_path(name: str) -> str:
    """Place of a vocabulary in the installed package of public vocabularies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    tokenizer: Tokenizer
    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    word_end: str
    special: dict[str, int]
    pieces: Callable[[str], list[str]]
    normalise: Callable[[str], str]
    symbols: list[str]

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """The text in order, cut at special strings: (is special, string)."""
        if not self._special_pattern or not any(s in text for s in self.special):
            yield False, text
            return
        for i, part in enumerate(self._special_pattern.split(text)):
            if part:
                yield i % 2 == 1, part

    def __post_init__(self):
        names = sorted(self.special, key=len, reverse=True)
        self._special_pattern = re.compile(f"({'|'.join(map(re.escape, names))})") if names else None

    def in_symbols(self, piece: str) -> str:
        return "".join(map(self.symbols.__getitem__, piece.encode("utf-8", "surrogatepass")))


def _splitter(settings: dict, split_pattern: str) -> Callable[[str], list[str]]:
    """How the file's pre-tokenizer cuts a text."""
    steps = settings["pretokenizers"] if settings["type"] == "Sequence" else [settings]
    for step in steps:
        if step["type"] == "Split" and step["behavior"] == "Removed" and step["invert"]:
            return regex.compile(step["pattern"]["Regex"]).findall
        if step["type"] == "ByteLevel" and step["use_regex"] and not step["add_prefix_space"]:
            return regex.compile(split_pattern).findall
    raise ValueError("the vocabulary splits texts in a way that is not known here")


def _normaliser(settings: dict | None, tokenizer: Tokenizer) -> Callable[[str], str]:
    if settings is None:
        return lambda text: text
    #: Above these, Python's and the library's tables of cases are of different age.
    late = re.compile("[\uA7CB-\U0010FFFF]")

    def nfc_lower(text: str) -> str:
        """NFC, then each character's own lower case."""
        if text.isascii():
            return text.lower()
        if late.search(text):
            return tokenizer.normalizer.normalize_str(text)
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    kinds = [step["type"] for step in settings.get("normalizers", [settings])]
    if kinds == ["NFC", "Replace", "Lowercase"]:  # the replacement only folds white space, which is dropped
        return nfc_lower
    raise ValueError("the vocabulary normalises texts in a way that is not known here")


@functools.lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    """Read once per process."""
    import public_tokenizers

    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    model = settings["model"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    tokenizer = Tokenizer.from_file(path)
    return Vocabulary(
        tokenizer=tokenizer,
        ids=model["vocab"],
        ranks={pair: rank for rank, pair in enumerate(pairs)},
        word_end=model["end_of_word_suffix"] or "",
        special={t["content"]: t["id"] for t in settings["added_tokens"]},
        pieces=_splitter(settings["pre_tokenizer"], public_tokenizers.PATTERN),
        normalise=_normaliser(settings["normalizer"], tokenizer),
        symbols=byte_characters(),
    )
