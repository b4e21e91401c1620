"""Public tokenizers on whole texts, through a memory of the pieces already seen.

The vocabulary files are read where they lie; ``public_tokenizers.path(name)`` names the place, or a path is given. New
pieces of plain Latin text are merged by tiktoken over the vocabulary of the same file, which gives the same ids several
times faster; all others, and any with a special string, are given to the file's own library.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable

import numpy as np
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives each worker one core

#: White space, for the tokenizers, beyond blank and 0x09-0x0D; and control characters that some libraries add to it.
RARE_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: Runs of all of these; white space for every library is what isn't among ``UNCERTAIN``.
MIXED_SPACE = re.compile(rb"(?:[ \t-\r]|" + RARE_SPACE.pattern + rb")+")
UNCERTAIN = re.compile(rb"[\x1c-\x1f]|\xc2\x85")
UNIT = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: Visible ASCII and the letters of Latin-1, after white space: no library differs on their case, class or composition.
PLAIN = re.compile(rb"[ \t-\r]*(?:[!-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
REMEMBERED = 600_000
LONGEST_REMEMBERED = 64
#: The patterns by which the two kinds of vocabulary cut a text before merging.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
WORD_END = "\x01"


def load(name: str):
    """The tokenizer of a vocabulary file: a path, or a name among the public ones."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(_place(name))


def _place(name: str) -> str:
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _visible_bytes() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: visible Latin-1 as it is, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


def plain_encoder(name: str) -> Callable[[str], list[int]] | None:
    """Ids of a plain piece, if the file is of a kind whose merges can be written as ranks; else None."""
    import tiktoken

    with open(_place(name), encoding="utf-8") as file:
        content = json.load(file)
    model, suffix = content["model"], content["model"].get("end_of_word_suffix")
    if model["type"] != "BPE" or model.get("ignore_merges") or suffix not in (None, "", "</w>"):
        return None
    added, visible = {x["content"] for x in content["added_tokens"]}, _visible_bytes()
    ranks = {}
    for token, rank in model["vocab"].items():
        if token not in added:
            ends = bool(suffix) and token.endswith(suffix)
            written = bytes(visible[c] for c in (token.removesuffix(suffix) if ends else token))
            ranks[written + (WORD_END.encode() if ends else b"")] = rank
    if not suffix:
        return tiktoken.Encoding("plain", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    # A word's last byte and the end mark have the lowest ranks of all pairs, so they are merged before anything else.
    merge = tiktoken.Encoding("plain", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def words(piece: str) -> list[int]:
        if piece.isalpha():
            return merge(piece.lower() + WORD_END)
        ids = []
        for word in WORD_PATTERN.findall(piece.lower()):
            ids += merge(word + WORD_END)
        return ids

    return words


class Memory:
    """What the tokenizer makes of each piece of text, kept for at most ``REMEMBERED`` short pieces."""

    def __init__(self, name: str, value: Callable):
        self.tokenizer, self.plain, self.value, self.seen = load(name), plain_encoder(name), value, {}

    def of(self, pieces: list[bytes]) -> Iterable:
        missing = set(pieces).difference(self.seen)
        if not missing:
            return map(self.seen.__getitem__, pieces)
        if len(self.seen) + len(missing) > REMEMBERED:
            self.seen.clear()
            missing = set(pieces)
        new, others = {}, []
        for x in missing:
            if self.plain and PLAIN.fullmatch(x) and b"<|" not in x:
                new[x] = self.value(self.plain(x.decode()))
            else:
                others.append(x)
        if others:
            encoded = self.tokenizer.encode_batch([x.decode("utf-8", "replace") for x in others], add_special_tokens=False)
            new.update((x, self.value(e.ids)) for x, e in zip(others, encoded, strict=True))
        self.seen.update(new)
        result = list(map(self.seen.__getitem__, pieces))
        for x in new:
            if len(x) > LONGEST_REMEMBERED:
                del self.seen[x]
        return result


_memories: dict[tuple[str, str], Memory] = {}


def memory(name: str, kind: str, value: Callable) -> Memory:
    """One memory per worker process, tokenizer and kind of value."""
    if (name, kind) not in _memories:
        _memories[name, kind] = Memory(name, value)
    return _memories[name, kind]


def units(text: bytes) -> list[bytes]:
    """Pieces that byte-level tokenizers treat independently: white space with the word after it.

    No pattern of theirs reaches over the end of a word into white space. Rare white space belongs to the run that it
    stands in; a run that begins with a character that isn't white space to every library doesn't end a word.
    """
    if not RARE_SPACE.search(text):
        return UNIT.findall(text)
    cuts = [m.start() for m in MIXED_SPACE.finditer(text) if m.start() and not UNCERTAIN.match(text, m.start())]
    return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]


_byte_level: dict[str, bool] = {}


def is_byte_level(name: str) -> bool:
    """A vocabulary of plain byte pairs: a token's text has one character per byte, and a text's first tokens are those of
    the text cut after them, as no merge crosses the end of a token."""
    if name not in _byte_level:
        with open(_place(name), encoding="utf-8") as file:
            content = json.load(file)
        model, cut = content["model"], content["pre_tokenizer"] or {}
        odd = any(model.get(x) for x in ("ignore_merges", "end_of_word_suffix", "continuing_subword_prefix", "dropout")) or content["normalizer"] or cut.get("add_prefix_space")
        _byte_level[name] = model["type"] == "BPE" and cut.get("type") == "ByteLevel" and not odd
    return _byte_level[name]


def token_ends(piece: bytes, tokenizer, count: int) -> tuple[list[int], list[int]]:
    """Places in a piece where it can be cut, and the tokens up to each: ends of tokens and characters, the piece's included.

    Left out are places after white space and apostrophes, where the library's patterns look at what follows.
    """
    places = np.cumsum([len(x) for x in tokenizer.encode(piece.decode("utf-8", "replace"), add_special_tokens=False).tokens]).tolist()
    if len(places) != count or places[-1] != len(piece):  # not UTF-8
        return [len(piece)], [count]
    in_space = np.zeros(len(piece), dtype=bool)
    for m in MIXED_SPACE.finditer(piece):
        in_space[m.start() : m.end()] = True
    inner = [(x, i + 1) for i, x in enumerate(places[:-1]) if piece[x] & 0xC0 != 0x80 and not in_space[x - 1] and b"'" not in piece[max(x - 3, 0) : x]]
    return [x for x, _ in inner] + [len(piece)], [n for _, n in inner] + [count]
