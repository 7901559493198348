"""Pre-tokens of a byte-level BPE vocabulary and the whole-token proof.

A byte-level BPE splits a text into pre-tokens and merges each on its own.
``prove_whole`` tells, once and offline, which strings of the vocabulary are a
single pre-token whose merges end in exactly their own entry: such a
pre-token is one known token wherever it occurs, without merging.
"""

from __future__ import annotations

import public_tokenizers
import regex
from tokenizers import Tokenizer
from tokenizers.decoders import ByteLevel as ByteLevelDecoder
from tokenizers.pre_tokenizers import ByteLevel

#: Characters that the pattern below and the library put into the same class
#: (a test compares them one by one); texts with others are split by the
#: library itself.
AGREED = regex.compile("[\x00-ɏ‐-‧]*+")
#: Merged pre-tokens kept per worker, and the longest that is kept.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 64


def byte_strings(tokenizer: Tokenizer) -> dict[int, bytes]:
    """The bytes of every entry of the vocabulary (bounded by its size)."""
    shown = {c: bytes([b]) for b, c in enumerate(_byte_characters())}
    return {i: b"".join(shown.get(c, c.encode()) for c in w) for w, i in tokenizer.get_vocab().items()}


def _byte_characters() -> list[str]:
    """The character that stands for each byte value in the vocabulary:
    printable Latin-1 bytes stand for themselves, the others follow from 256."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    table = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [table[b] for b in range(256)]


def is_byte_level(tokenizer: Tokenizer) -> bool:
    """Whether pre-tokens can be taken as this module does: the byte-level
    split without a prefix space and without a normaliser."""
    pre = tokenizer.pre_tokenizer
    if tokenizer.normalizer is not None or not isinstance(pre, ByteLevel) or pre.add_prefix_space or not pre.use_regex:
        return False
    return all(not (t.lstrip or t.rstrip or t.single_word or t.normalized) for t in tokenizer.get_added_tokens_decoder().values())


class Pretokens:
    """Splits texts into pre-tokens and merges single ones."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.model = tokenizer.model
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.shown = str.maketrans({b: c for b, c in enumerate(_byte_characters())})

    def of(self, text: str) -> list[str]:
        if text.isascii() or AGREED.fullmatch(text):
            return self.split(text)
        return self.by_library(text)

    def by_library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def merge(self, piece: str) -> list:
        """The tokens (with ``id``) of one pre-token."""
        return self.model.tokenize(piece.encode().decode("latin-1").translate(self.shown))


def prove_whole(path: str) -> dict[str, int]:
    """Vocabulary strings that encode alone as one token, with its id: the
    library finds one pre-token in them and merges it into that entry.

    Added special tokens are no pre-tokens and are left out; so are entries
    that are no whole UTF-8 text."""
    tokenizer = Tokenizer.from_file(path)
    pre, decode = Pretokens(tokenizer), ByteLevelDecoder()
    added = tokenizer.get_added_tokens_decoder()
    whole = {}
    for word, i in tokenizer.get_vocab().items():
        if i in added:
            continue
        text = decode.decode([word])
        if "�" not in text and pre.by_library(text) == [text] and [t.id for t in pre.merge(text)] == [i]:
            whole[text] = i
    return whole
