"""Stupid backoff at order 3 against a count of every n-gram by hand."""

import math
from collections import Counter

from heirloom.llm import queries

TEXTS = ["a b c d", "a b c e", "x b c d", "a b c d", "c", "", None, "q a b c", "b c a a b"]


def by_hand(words, i):
    own, total = Counter(), Counter()
    for j, ws in enumerate(words):
        for n in (1, 2, 3):
            for k in range(len(ws) - n + 1):
                total[tuple(ws[k : k + n])] += 1
                own[tuple(ws[k : k + n])] += j == i
    others = lambda g: total[g] - own[g]
    every, ws, logs, seen = sum(map(len, words)), words[i], 0.0, 0
    for k in range(len(ws)):
        longest = min(k + 1, 3)
        for n in range(longest, 0, -1):
            g = tuple(ws[k - n + 1 : k + 1])
            left = every - len(ws) if n == 1 else others(g[:-1])
            if others(g) and left:
                value = others(g) / left * 0.4 ** (longest - n)
                seen += n == longest
                break
        else:
            value = 0.4 / (every + 1) * 0.4 ** (longest - 1)
        logs += math.log10(value)
    return (len(ws), seen, round(logs / len(ws), 6) if ws else None)


def test_trigrams_count_every_word(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    words = [(t or "").split() for t in TEXTS]
    got = {r.doc_id: (r.n_words, r.n_seen, r.log_score) for r in queries.QUERIES["op8_lm_scores"](spark, str(tmp_path)).collect()}
    assert got == {i: by_hand(words, i) for i in range(len(TEXTS))}
