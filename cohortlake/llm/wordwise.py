"""Ids of many new words with one call of a tokenizer, for the caches of token counting and packing."""

from __future__ import annotations

from collections.abc import Sequence


def encode_words(tokenizer, words: Sequence[str], lead: str) -> list[list[int]]:
    """Ids of ``lead + word`` for every word; words are runs of letters, which the tokenizer never joins or cuts.

    The words go through as one text, and the tokenizer's own word numbers say whose each id is; should the numbers
    not be one per word, each is encoded for itself.
    """
    if not words:
        return []
    encoding = tokenizer.encode(lead + " ".join(words), add_special_tokens=False)
    out: list[list[int]] = [[] for _ in words]
    try:
        for i, w in zip(encoding.ids, encoding.word_ids):
            out[w].append(i)
        if all(out):
            return out
    except (IndexError, TypeError):
        pass
    return [tokenizer.encode(lead + w, add_special_tokens=False).ids for w in words]
