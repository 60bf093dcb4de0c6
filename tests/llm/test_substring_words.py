"""Words numbered by verified hashes: equal numbers for equal words only, also where hashes collide."""

from __future__ import annotations

import random

import numpy as np
import pytest

from cohortlake.llm import substrings
from cohortlake.llm.common import words_of
from cohortlake.llm.decontamination import word_places


@pytest.mark.parametrize("modulus", [1 << 63, 5])
def test_numbers_are_one_to_one_with_words(modulus):
    random.seed(3)
    text = " ".join(random.choices(["a", "bé", "中", "A", "a.", " x", "\x1c"], k=500)) + "\n\t  end\x0b"
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, hashes = word_places(data, np.zeros(1, np.int64), slab=17, lower=substrings._AS_IS, letters=substrings._LETTERS)
    ids, first = substrings.numbered(data, starts, ends, hashes % np.uint64(modulus))
    words = words_of(text)
    assert [text.encode()[s:e].decode() for s, e in zip(starts, ends)] == words
    of = {}
    for w, i in zip(words, ids.tolist()):
        assert of.setdefault(w, i) == i and words[first[i]] == w
    assert len(set(of.values())) == len(of)


def test_spans_do_not_depend_on_batches(spark):
    random.seed(9)
    say = lambda n: " ".join(random.choices("abcdefgh", k=n))
    shared = say(60)
    docs = spark.createDataFrame([(i, f"{say(25)} {shared} {say(30)}" if i % 3 else say(40)) for i in range(90)] + [(91, None), (92, "")], "doc_id long, text string").repartition(2)
    real = substrings.send
    want = None
    for size in (200, 5000, 26_000_000):
        def small(batches, *a, size=size):
            return real(batches, *a, batch_bytes=size)

        substrings.send = small
        try:
            got = sorted(map(tuple, substrings.removal_digest(docs, words_per_bucket=300).collect()))
        finally:
            substrings.send = real
        want = want or got
        assert got == want and any(r[2] for r in got)
