"""Encoders of whole texts by public vocabulary files, one of each per Python worker."""

from __future__ import annotations

import json
import re

import numpy as np

#: How a byte-level tokenizer cuts a text into pieces (fixed value).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs of white space from this length on go to the tokenizers library: the fast encoder's pattern backtracks on them.
LONG_RUN = 2000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, by the scheme's rule:
    printable Latin letters stand for themselves, the other bytes for letters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


class ByteBpe:
    """Ids of texts by a byte-level BPE file of the tokenizers library, without special tokens around them.

    ``plain_special`` takes the strings of special tokens inside texts as ordinary text.
    The file's own description decides how texts are encoded: a plain byte-level BPE
    whose merges stand in the order of their ids is run by tiktoken over the same
    entries, which gives the same ids; every other kind, and texts with special tokens
    or very long runs of white space, go through the tokenizers library."""

    def __init__(self, path: str, plain_special: bool):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain_special
        told = json.loads(self.library.to_str())
        vocab, added = told["model"]["vocab"], {x["content"] for x in told["added_tokens"]}
        letters = byte_letters()
        self.bytes_of = [b""] * (max([*vocab.values(), *(x["id"] for x in told["added_tokens"])]) + 1)
        ranks = {}
        for entry, i in vocab.items():
            if entry not in added and all(c in letters for c in entry):
                ranks[bytes(letters[c] for c in entry)] = i
                self.bytes_of[i] = bytes(letters[c] for c in entry)
        special = () if plain_special else sorted(added)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.long_run = re.compile(rf"\s{{{LONG_RUN}}}")
        self.fast = self._fast(told, ranks, len(vocab) - len(added & set(vocab)))

    @staticmethod
    def _fast(told: dict, ranks: dict, entries: int):
        """The tiktoken encoder, if the description is that of a plain byte-level BPE."""
        import tiktoken
        model, cut = told["model"], told["pre_tokenizer"] or {}
        odd = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                      "fuse_unk", "byte_fallback", "ignore_merges")]
        merged = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        order = [model["vocab"][a + b] for a, b in merged]
        plain = (model.get("type") == "BPE" and not any(odd) and told["normalizer"] is None and len(ranks) == entries
                 and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
                 and all(x < y for x, y in zip(order, order[1:])))
        return tiktoken.Encoding("file", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}) if plain else None

    def ids(self, text: str) -> list[int]:
        if (self.fast is None or self.special is not None and self.special.search(text)
                or len(text) >= LONG_RUN and self.long_run.search(text)):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceBpe:
    """Ids of texts by a sentencepiece file; ``bytes_of`` holds each id's bytes (U+2581 is a space)."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.library = SentencePieceProcessor(model_file=path)
        self.bytes_of = [self._bytes(i) for i in range(self.library.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.library.id_to_piece(i)
        if self.library.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return b"" if self.library.is_control(i) or self.library.is_unknown(i) else piece.replace("▁", " ").encode()

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, num_threads=1)


_HELD: dict[tuple, object] = {}


def byte_bpe(path: str, plain_special: bool = False) -> ByteBpe:
    """One encoder per Python worker."""
    key = ("byte", path, plain_special)
    if key not in _HELD:
        _HELD[key] = ByteBpe(path, plain_special)
    return _HELD[key]


def piece_bpe(path: str) -> PieceBpe:
    """One encoder per Python worker."""
    if ("piece", path) not in _HELD:
        _HELD["piece", path] = PieceBpe(path)
    return _HELD["piece", path]


def lengths(bytes_of: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, bytes_of), np.int64, len(bytes_of))
