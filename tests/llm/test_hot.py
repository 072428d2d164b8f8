"""Frequent triggers and minimizers are found by their true counts, and their strings travel one by one."""

import random
import re

import numpy as np
import pytest

from heirloom.llm import debruijn, exchange, suffix_dedup


def asked(sizes):
    """What the census says of one value that chunks with ``sizes`` distinct phrases ask about, beside a rare one."""
    values = np.array([5, 1 << 40], np.uint64)
    blobs = [exchange.ask_census(values, np.array([False, False]), np.array([n, 1]), c, 1)[0][2] for c, n in enumerate(sizes)]
    return [exchange.read_census(values, {0: a}, 1) for a in exchange.census(blobs, 4096)]


@pytest.mark.parametrize(("sizes", "hot"), [([5000] * 16, True), ([5000] * 3, True), ([300] * 14, True), ([5000], True), ([1 << 20], True), ([4096], False), ([255] * 16, False), ([256] * 16 + [1], True)])
def test_census_counts_beyond_a_byte(sizes, hot):
    for _, many in asked(sizes):
        assert many.tolist() == [hot, False]


def surrounded(n, words):
    """One passage in ``n`` surroundings."""
    r = random.Random(5)
    own = lambda k: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(k))
    passage = own(words)
    return [(i, f"{own(1)} {i}left {passage} {i}right {own(1)}") for i in range(n)]


@pytest.mark.parametrize("each", [1 << 30, 1 << 16])
def test_more_than_4096_surroundings_of_one_passage(spark, each):
    rows = surrounded(4500, 6)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(d, each=each).collect()}
    first, blobs = {}, {k: t.encode() for k, t in rows}
    for k, b in blobs.items():
        for i in range(len(b) - 49):
            first.setdefault(b[i : i + 50], k)
    for k, b in blobs.items():
        mask = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < k:
                mask[i : i + 50] = b"\1" * 50
        assert bytes(got[k].kept) == bytes(x for x, m in zip(b, mask, strict=True) if not m)


def test_more_than_4096_surroundings_of_one_path(spark):
    rows = surrounded(4500, 21)
    got = {r.doc_id: r for r in debruijn.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), each=1 << 30).collect()}
    for k, t in rows:
        w = re.findall(r"\S+", t)
        assert (got[k].n_words, got[k].n_removed) == (25, 21 if k else 0) and bytes(got[k].kept).decode() == " ".join(w if not k else w[:2] + w[-2:])


def test_a_hot_passage_is_told_from_phrases():
    """The passage's trigger has more than 4096 distinct phrases in one chunk, and the census calls it hot."""
    p = suffix_dedup.Phrases([t.encode() for _, t in surrounded(4500, 6)], 50, 16)
    found, _, counts = suffix_dedup._triggers(p)
    blob = exchange.ask_census(found, np.zeros(len(found), bool), counts, 0, 1)[0][2]
    _, hot = exchange.read_census(found, {0: exchange.census([blob], 4096)[0]}, 1)
    assert counts.max() > 4096 and hot.tolist() == (counts > 4096).tolist()
