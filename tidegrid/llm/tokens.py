"""Token ids of texts by a public vocabulary file; the file's path is a parameter, nothing is trained here."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np

#: the split of byte-level BPE vocabularies of this family, a fixed value
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes: printable Latin-1 for itself, the rest from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


def _ranks(whole: dict) -> dict[bytes, int] | None:
    """The vocabulary by bytes, if its ids are merge ranks of a plain byte-level BPE; else None."""
    model, split = whole["model"], whole.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or whole.get("normalizer"):
        return None
    if not split.get("use_regex", True) or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    vocab = model["vocab"]
    for rank, merge in enumerate(model["merges"]):
        if vocab.get("".join(merge.split(" ") if isinstance(merge, str) else merge)) != 256 + rank:
            return None
    letters = byte_letters()
    return {bytes(letters[c] for c in token): i for token, i in vocab.items()}


def _added(whole: dict) -> dict[str, int] | None:
    """The file's added tokens, if they are cut out of texts as they stand; else None."""
    added = whole.get("added_tokens") or []
    if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        return None
    return {t["content"]: t["id"] for t in added}


@lru_cache(maxsize=4)
def encoder(path: str, literal: bool = False) -> Callable[[Iterable[str]], Iterable[np.ndarray]]:
    """A function from texts to uint32 arrays of ids, those of ``tokenizers`` without special tokens around a text.

    A string of an added token inside a text is that token, as the file says; with ``literal`` special ones count as ordinary text.  Plain
    byte-level BPE is run by tiktoken on the ranks read from the file (the same ids at a fifth of the time); any other file by tokenizers.
    """
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    ranks, added = _ranks(whole), _added(whole)
    plain = all(t.get("special") for t in whole.get("added_tokens") or [])
    if ranks is not None and added is not None and (plain or not literal):
        import tiktoken

        words = {token: i for token, i in ranks.items() if i not in added.values()}
        coder = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=words, special_tokens=added)
        known = set() if literal else set(added)
        return lambda texts: (coder.encode_to_numpy(t, allowed_special=known, disallowed_special=()) for t in texts)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = literal
    return lambda texts: (np.array(tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts)
