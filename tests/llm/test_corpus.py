import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from heirloom.llm import debruijn, fingerprints, langid, lm, media_gif, minhash, mixing, pieces, quality, suffix_dedup

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string"


def corpus():
    r = random.Random(5)
    vocab = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6))) for _ in range(60)]
    say = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    base, passage = say(80), say(40)
    texts = [base, base, base + " x", say(30) + " " + passage, passage + "\n" + say(25), None, "", "  \t", "one two", "aa " * 60, say(3000), say(60), "▁ ▁x  y", "x" * 300, "x" * 260]
    words = base.split()
    words[7] = "changed"
    texts.append(" ".join(words))
    return [(i, t, r.choice(["en", "de", None]), r.choice(["a", "b", None]), 1, "k", "s") for i, t in enumerate(texts)] + [(None, base, "en", "a", 1, "k", "s"), (3, texts[3], "en", "a", 1, "k", "s")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect() if r[key] is not None}


def known():
    return {r[0]: r[1] or "" for r in corpus() if r[0] is not None}


def test_suffix_dedup_against_brute_force(docs):
    got, first = rows(suffix_dedup.remove_repeats(docs)), {}
    texts = {k: t.encode() for k, t in known().items()}
    for k in sorted(texts):
        for i in range(len(texts[k]) - 49):
            first.setdefault(texts[k][i : i + 50], k)
    for k, b in texts.items():
        mask = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < k:
                mask[i : i + 50] = b"\1" * 50
        assert bytes(got[k].kept) == bytes(x for x, m in zip(b, mask, strict=True) if not m), k
        assert sum(got[k].span_len) == sum(mask)


def test_debruijn_against_brute_force(docs):
    got, first = rows(debruijn.remove_repeats(docs)), {}
    words = {k: re.findall(WORD, t) for k, t in known().items()}
    for k in sorted(words):
        for i in range(len(words[k]) - 19):
            first.setdefault(tuple(words[k][i : i + 20]), (k, i))
    for k, w in words.items():
        mask = bytearray(len(w))
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] != (k, i):
                mask[i : i + 20] = b"\1" * 20
        assert bytes(got[k].kept).decode() == " ".join(x for x, m in zip(w, mask, strict=True) if not m), k
        for s in got[k].spans:
            src = words[s.src_key]
            assert w[s.word : s.word + s.edges + 19] == src[s.src_word : s.src_word + s.edges + 19]


def test_unitigs(spark):
    d = spark.createDataFrame([(1, "a b c d e f"), (2, "z b c d e q"), (3, None)], "doc_id long, text string")
    got = debruijn.unitigs(d, k=2).collect()
    assert [(r.words, r.edges, r.occurrences, r.src_key, r.src_word) for r in got] == [(["b", "c", "d", "e"], 3, 2, 1, 1)]


def test_near_duplicates_against_brute_force(docs):
    sets = {}
    for k, t in known().items():
        w = re.findall(WORD, t)
        sets[k] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set()
    up = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((up[a], up[b]))
                up = {k: lo if v == hi else v for k, v in up.items()}
    got = rows(minhash.near_duplicates(docs, words=4))
    assert {k: (len(sets[k]), up[k], up[k] == k) for k in sets} == {k: (r.n_shingles, r.component_id, r.kept) for k, r in got.items()}


def test_estimates_are_corrected():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 2**63, 2000, dtype=np.uint64))
    b = np.unique(np.concatenate((a[:1600], r.integers(0, 2**63, 400, dtype=np.uint64))))
    x, y = minhash.registers([a, b])
    assert abs(minhash.estimate(x, y[None], len(a), len(b))[0] - 1600 / 2400) < 0.15


def test_mixing_targets(spark):
    r = random.Random(1)
    d = spark.createDataFrame([(i, r.choice(["a", "b", "c", None]), r.randint(0, 50)) for i in range(400)], "doc_id long, source string, size long")
    one, two = (mixing.mix_to_targets(d).collect() for _ in range(2))
    assert sorted(map(repr, one)) == sorted(map(repr, two)) and all(x.taken <= 2 * x["size"] for x in one)
    by = Counter()
    for x in one:
        by[x.source] += x.taken
    goal = {x.source: x.target for x in one}
    assert all(abs(by[s] - goal[s]) <= 50 for s in goal) and abs(sum(goal.values()) - 1.5 * sum(x["size"] for x in one)) < 1e-6
    assert mixing.emit_copies(mixing.mix_to_targets(d)).count() == sum(x.copies for x in one)


def test_fingerprints(docs):
    got, texts = rows(fingerprints.fingerprint_documents(docs)), known()
    assert got[0].fingerprint == got[1].fingerprint and got[0].near_next == 1.0
    n = len(texts[10])
    edited = texts[10][: n - n // 2] + texts[11][: n // 2]
    assert got[10].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[10].near_edited > 0.4
    assert sum(r.doc_id is None for r in fingerprints.fingerprint_documents(docs).collect()) == 1


def test_gif_round_trip(docs):
    for r in media_gif.decode_media(media_gif.to_media(docs)).collect():
        b = known().get(r.doc_id, corpus()[0][1]).encode()
        assert bytes(r.samples) == b + b"\xff" * (-len(b) % 576 if b else 576)


def test_gif_rules():
    pal = np.array([[0, 0, 0], [255, 0, 0], [0, 255, 0], [0, 0, 255]], np.uint8)
    f = [media_gif.Frame(0, 0, 4, 4, np.ones(16, np.uint8), delay_cs=5, disposal=1), media_gif.Frame(1, 1, 2, 2, np.array([2, 3, 3, 2], np.uint8), disposal=3, transparent=3, delay_cs=7), media_gif.Frame(0, 0, 1, 1, np.array([2], np.uint8))]
    w, h, p, frames = media_gif.decode_frames([media_gif.encode(4, 4, pal, f)])[0]
    shown = list(media_gif.composite(w, h, p, frames))
    assert [x.delay_cs for x in frames] == [5, 7, 0]
    assert shown[1][1, 1].tolist() == [0, 255, 0, 255] and shown[1][1, 2].tolist() == [255, 0, 0, 255] and shown[2][1, 1].tolist() == [255, 0, 0, 255]
    data = bytes(random.Random(2).choices(range(7), k=30000))
    assert media_gif.lzw_decode(media_gif.lzw_encode([data], 3), 3, 30000)[0].tobytes() == data
    other = bytes(random.Random(3).choices(range(256), k=9000))
    both = media_gif.lzw_decode(media_gif.lzw_encode([other, other[::-1]]), 8, 9000)
    assert [x.tobytes() for x in both] == [other, other[::-1]]
    broken = media_gif.lzw_encode([other])[0][:40]
    assert media_gif.lzw_decode([broken, b"", b"\xff\xff"], 8, 50)[:, :20].tolist() == [list(other[:20]), [0] * 20, [0] * 20]


def test_language(spark):
    r = random.Random(3)
    en, de = ["the", "of", "and", "thing", "water"], ["der", "und", "nicht", "über", "straße"]
    d = spark.createDataFrame([(i, " ".join(r.choices(en if i % 2 else de, k=30)), "en" if i % 2 else "de") for i in range(80)] + [(900, None, "en"), (901, "12 !!", None)], "doc_id long, text string, lang string")
    got = rows(langid.identify(d.withColumn("score", F.lit("x")), langid.train(d)))
    assert all(x.lang_pred == x.lang and 0.5 < x.score <= 1 for k, x in got.items() if k < 900) and got[900].lang_pred == got[901].lang_pred == "und"
    assert {x.lang_pred for x in langid.identify(d, langid.train(d.where("false"))).collect()} == {"und"}


def test_lm_prefers_what_others_say(docs):
    got = rows(lm.score_documents(docs))
    assert got[5].log_score is None and got[0].log_score > got[11].log_score and got[0].n_seen == 80


def test_pieces_round_trip(docs):
    v = pieces.load_vocabulary()
    got = pieces.decode_documents(pieces.encode_documents(docs, v), v).collect()
    again = pieces.encode_documents(docs.repartition(1), v).collect()
    assert all(r.decoded == known().get(r.doc_id, corpus()[0][1]) for r in got)
    assert sorted((str(r.doc_id), r.pieces) for r in got) == sorted((str(r.doc_id), r.pieces) for r in again)


def test_samples_follow_the_weights():
    v = pieces.load_vocabulary()
    found = Counter(tuple(x.tolist()) for x in pieces.sample_pieces(v, ["the"] * 4000, list(range(4000))))
    weight = dict(zip(v.ids.tolist(), np.exp(v.logs).tolist(), strict=True))
    every = {k: np.prod([weight[i] for i in k]) for k in found}
    total = sum(every.values())
    assert all(abs(n / 4000 - every[k] / total) < 0.03 for k, n in found.items()) and len(found) > 1


def test_quality(spark):
    r = random.Random(4)
    text = lambda i: " ".join(r.choices(["%%% $$$ ###", "@@@"] if i % 3 == 0 else ["good", "plain", "words"], k=40)) + (" vile" if i % 5 == 0 else "")
    d = spark.createDataFrame([(i, text(i), "en", "s%d" % (i % 2)) for i in range(400)] + [(999, None, None, None)], "doc_id long, text string, lang string, source string")
    lab = spark.createDataFrame([(i, int(i % 3 != 0), int(i % 5 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    got = rows(quality.classify(d, quality.train(d, lab)))
    assert all(got[i].kept == (i % 3 != 0 and i % 5 != 0) for i in range(400)) and 999 in got
    assert quality.classify(d, quality.train(d, lab.where("false"))).count() == 401


def test_pipeline_stages(spark, docs):
    import corpus_pipeline as c

    rows_ = docs.select("doc_id", "text", F.coalesce("lang", F.lit("en")).alias("lang"), "source", "n_chars")
    for name, stage in c.STAGES:
        out = stage(spark, rows_, "")
        if name != c.STAGES[-1][0]:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows_ = spark.createDataFrame([tuple(r) for r in out.collect()], out.schema)
    assert rows_.count() > 0


def test_round_trip_is_encoding_and_decoding(docs):
    v = pieces.load_vocabulary()
    rows = lambda df: sorted((str(r.doc_id), list(r.pieces), r.decoded) for r in df.collect())
    assert rows(pieces.round_trip(docs, v)) == rows(pieces.decode_documents(pieces.encode_documents(docs, v), v))
