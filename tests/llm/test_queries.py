"""The registered queries whose rows SQL cannot give, against brute force on a small corpus."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from heirloom.llm import fingerprints, pieces, quality, queries

WORD = r"[^\x20\x09-\x0D]+"


def corpus():
    r = random.Random(8)
    vocab = {k: ["".join(r.choice(k) for _ in range(r.randint(2, 7))) for _ in range(60)] for k in ("abcdeé", "klmnoß")}
    say = lambda n, k="abcdeé": " ".join(r.choice(vocab[k]) for _ in range(n))
    base, passage = say(90), say(50)
    texts = [base, base, say(40) + " " + passage, passage + "\n" + say(25), None, "", " \t ", "one two", "aa " * 70, say(2500), "x" * 1300, "x" * 700]
    texts += [say(30, "klmnoß" if i % 2 else "abcdeé") for i in range(60)]
    return [(3 * i, t, [None, "k", "a"][0 if i == 9 else 1 + (i > 11 and i % 2 == 0)], r.choice(["s1", "s2", None])) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, i % 2, int(i % 5 == 0)) for i, (k, *_) in enumerate(corpus())], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def run(spark, sf, name):
    return {r.doc_id: r for r in queries.QUERIES[name](spark, sf).collect()}


TEXTS = {k: t or "" for k, t, *_ in corpus()}


def test_op2(spark, sf):
    got, keys = run(spark, sf, "op2_fingerprints"), sorted(TEXTS)
    for k, after in zip(keys, keys[1:] + keys[:1], strict=True):
        t, half = TEXTS[k], len(TEXTS[k]) // 2
        edited = t[: len(t) - half] + TEXTS[after][:half]
        r = got[k]
        mine, theirs = fingerprints.fingerprints([t, edited])
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.next_id) == (len(t), hashlib.sha256(edited.encode()).hexdigest(), mine, theirs, after)
        head = next((i for i, (x, y) in enumerate(zip(t, edited, strict=False)) if x != y), min(len(t), len(edited)))
        assert r.common_prefix == head and r.near_edited == fingerprints.likeness(mine, theirs)
        if t:
            assert r.near_edited >= min(0.999, head / max(len(t), len(edited)) - 2 / 64) and (r.near_edited == 1) == (t == edited)
    assert got[0].near_next == 1.0


def test_extensions_against_characters():
    r = random.Random(1)
    for _ in range(200):
        a = "".join(r.choice("abé") for _ in range(r.randint(0, 200)))
        i = r.randint(0, len(a))
        b = a[:i] + r.choice(["", "x", "yy"]) + a[i + r.randint(0, 2) :]
        n = next((j for j, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        m = next((j for j in range(min(len(a), len(b)) - n) if a[-1 - j] != b[-1 - j]), min(len(a), len(b)) - n)
        assert fingerprints.extensions([(a, b)]) == [(n, m)]


def test_op3(spark, sf):
    for k, r in run(spark, sf, "op3_media_gif").items():
        b = TEXTS[k].encode()
        payload = b + b"\xff" * (-len(b) % 576 if b else 576)
        n = len(payload) // 576
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(b), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert r.feature.startswith(f"24x24;{n};{4 * n};") and r.media_bytes > 0


def test_frames_against_samples(spark):
    from heirloom.llm import media_gif

    d = spark.createDataFrame([(1, "aab" * 500 + "é\n"), (2, None)], "doc_id long, text string")
    for r in media_gif.decode_media(media_gif.to_media(d)).collect():
        for i, f in enumerate(r.frames):
            part = np.frombuffer(r.samples, np.uint8)[576 * i : 576 * i + 576]
            assert f.hist == np.bincount(part >> 5, minlength=8).tolist() * 3 and (f.start_cs, f.delay_cs, f.disposal) == (4 * i, 4, 1)


def test_op4(spark, sf):
    got, first = run(spark, sf, "op4_suffix_dedup"), {}
    texts = {k: t.encode() for k, t in TEXTS.items()}
    for k in sorted(texts):
        for i in range(len(texts[k]) - 49):
            first.setdefault(texts[k][i : i + 50], k)
    for k, b in texts.items():
        mask = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < k:
                mask[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, m in zip(b, mask, strict=True) if not m)
        spans = len(re.findall(b"\1+", bytes(mask)))
        assert tuple(got[k][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) == (len(b), sum(mask), spans, hashlib.sha256(kept).hexdigest()), k


def test_op6(spark, sf):
    got, first = run(spark, sf, "op6_debruijn"), {}
    words = {k: re.findall(WORD, t) for k, t in TEXTS.items()}
    for k in sorted(words):
        for i in range(len(words[k]) - 19):
            first.setdefault(tuple(words[k][i : i + 20]), (k, i))
    for k, w in words.items():
        mask = bytearray(len(w))
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] != (k, i):
                mask[i : i + 20] = b"\1" * 20
        kept = " ".join(x for x, m in zip(w, mask, strict=True) if not m)
        assert (got[k].n_words, got[k].n_removed, got[k].kept_sha256) == (len(w), sum(mask), hashlib.sha256(kept.encode()).hexdigest()), k


def test_op7_against_word_first_backoff(spark, sf):
    """Scores by dictionaries of words and n-grams, learned as the operator's docstring says."""
    rows = corpus()
    learn = [(t, lang) for k, t, lang, _ in rows if t is not None and lang is not None and zlib.crc32(str(k).encode()) % 4 != 2]
    langs, tables = sorted({lang for _, lang in learn}), {}
    grams = lambda w, n: [c[i : i + n] for c in [f"#{w}#"] for i in range(len(c) - n + 1)]
    split = lambda t: ["".join(x.lower()[0] for x in w) for w in re.findall(r"[^\W\d_]+", t or "")]
    for n in range(6):
        by = {lang: Counter() for lang in langs}
        for t, lang in learn:
            for w in split(t):
                by[lang].update([w] if n == 0 else grams(w, n)[0 if n > 1 else 1 :])
        total = sum(by.values(), Counter())
        known = [g for g, c in total.items() if c >= 2 or n == 1]
        size = {lang: sum(by[lang][g] for g in known) + 0.5 * (len(known) + 1) for lang in langs}
        tables[n] = {g: np.array([math.log((by[lang][g] + 0.5) / size[lang]) for lang in langs]) for g in known}

    def score(w):
        if w in tables[0]:
            return tables[0][w]
        c, out = f"#{w}#", []
        for end in range(2, len(c) + 1):
            hit = next((tables[n][c[end - n : end]] for n in range(5, 0, -1) if n <= end and c[end - n : end] in tables[n]), np.full(len(langs), math.log(1e-6)))
            out.append(hit)
        return sum(out) / len(out)

    got = run(spark, sf, "op7_language_id")
    for k, t, _, _ in rows:
        ws = split(t)
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 4 == 2)
        if not ws:
            assert (got[k].lang_pred, got[k].score) == ("und", 0.0)
            continue
        total = sum(map(score, ws))
        z = np.exp((total - total.max()) / math.sqrt(len(ws)))
        assert got[k].lang_pred == langs[int(total.argmax())] and abs(got[k].score - 1 / z.sum()) < 1e-4, k


def test_op9_round_trip_and_lattice(spark, sf):
    for k, r in run(spark, sf, "op9_sentencepiece").items():
        assert (r.n_chars, r.decoded_sha256) == (len(TEXTS[k]), hashlib.sha256(TEXTS[k].encode()).hexdigest())
    # Every spelling of a word by pieces, and how often each is drawn.
    v = pieces.load_vocabulary()
    weight = {v.pieces[i].decode(): math.exp(x) for i, x in zip(v.ids.tolist(), v.logs.tolist(), strict=True)}
    spell = lambda t: [[]] if not t else [[t[:n], *rest] for n in range(1, len(t) + 1) if t[:n] in weight for rest in spell(t[n:])]
    every = {tuple(s): math.prod(weight[p] for p in s) for s in spell(" sand")}
    total, n = sum(every.values()), 20_000
    found = Counter(tuple(v.pieces[i].decode() for i in x) for x in pieces.sample_pieces(v, ["sand"] * n, list(range(n))))
    assert set(found) <= set(every)
    for s, w in every.items():
        p = w / total
        assert abs(found[s] - n * p) <= 5 * math.sqrt(n * p * (1 - p)) + 1


def test_op10_against_grouped_sums(spark, sf):
    rows = quality.with_site_priors(spark.createDataFrame([(i, (i * 37 % 100) / 100 if i % 3 else 0.9, f"h{i % 3}" if i % 7 else None, f"p{i % 2}") for i in range(90)], "doc_id long, p_doc double, source string, lang string")).collect()
    p = {r.doc_id: r.p_doc for r in rows}
    host = {r.doc_id: r.source for r in rows}
    cell = {r.doc_id: (r.source, r.lang) for r in rows}
    mean = sum(p.values()) / len(p)
    avg = lambda ids: sum(p[i] for i in ids) / len(ids)
    of = lambda group: {g: [i for i in p if group[i] == g] for g in set(group.values())}
    hosts, cells = of(host), of(cell)
    within = sum((p[i] - avg(ids)) ** 2 for ids in cells.values() for i in ids) / (len(p) - len(cells))
    spread_h = sum(len(ids) * (avg(ids) - mean) ** 2 for ids in hosts.values())
    spread_p = sum(len(ids) * (avg(ids) - avg(hosts[g[0]])) ** 2 for g, ids in cells.items())
    strength = lambda spread, groups: min(1e6, max(1.0, mean * (1 - mean) / max(1e-6, (spread - groups * within) / len(p)) - 1))
    kh, kp = strength(spread_h, len(hosts) - 1), strength(spread_p, len(cells) - len(hosts))
    for r in rows:
        mine = lambda ids: [p[i] for i in ids if i != r.doc_id]  # noqa: E731, B023
        hs, cs = mine(hosts[r.source]), mine(cells[r.source, r.lang])
        prior = (sum(hs) + kh * mean) / (len(hs) + kh)
        site = (sum(cs) + kp * prior) / (len(cs) + kp)
        odds = p[r.doc_id] / (1 - p[r.doc_id]) * site / (1 - site) * (1 - mean) / mean
        assert abs(r.site_quality - site) < 1e-9 and abs(r.posterior - odds / (1 + odds)) < 1e-9
    assert len(run(spark, sf, "op10_quality")) == len(TEXTS)
