"""Empty tables, nulls, repeated rows, hot keys, very long texts and clashing column names, for every corpus operator and stage."""

import random
import re

import pytest
from pyspark.sql import functions as F

from heirloom.llm import debruijn, fingerprints, langid, lm, media_gif, minhash, mixing, pieces, quality, suffix_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["_chunk", "chunk", "key", "bucket", "blob", "c0", "_src", "_n", "_cell", "_place", "_start", "_offset", "_copy", "_h", "_p", "_s", "_hn", "_hs", "slot", "guest", "a.b", "size"]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    r = random.Random(11)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(300)]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    line = say(30)
    rows = [(i, say(8) + " " + line + " " + say(8), "en", "hot", 1) for i in range(60)]  # one line in many surroundings
    rows += [(None, say(40), None, None, None) for _ in range(20)] + [(7, say(40), "de", "", 0)] * 3
    rows += [(100, say(20_000), "en", "hot", 1), (101, None, None, None, None), (102, "", "", "", 0), (103, "x" * 70_000, "en", "a", 1)]
    d = spark.createDataFrame(rows, DOCS)
    for i, c in enumerate(CLASH):
        d = d.withColumn(c, F.lit(f"v{i}"))
    return d.repartition(5)


def operators(docs, labels):
    """Every operator on ``docs``; those that carry columns carry them all."""
    every, v = tuple(docs.columns), pieces.load_vocabulary()
    found = {
        1: mixing.emit_copies(mixing.mix_to_targets(mixing.with_size(docs, size="words"), size="words")),
        2: fingerprints.fingerprint_documents(docs, each=5),
        3: media_gif.decode_media(media_gif.to_media(docs)),
        4: suffix_dedup.remove_repeats(docs, carry=every),
        5: minhash.near_duplicates(docs),
        6: debruijn.remove_repeats(docs, carry=every),
        7: langid.identify(docs, langid.train(docs)),
        8: lm.score_documents(docs, carry=every),
        9: pieces.round_trip(docs, v),
        10: quality.classify(docs, quality.train(docs, labels)),
    }
    return found


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for n, df in operators(empty, labels).items():
        assert df.count() == 0, n


def test_odd_rows_and_clashing_names(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 1), (5, None, 0)], "doc_id long, quality int, toxic int")
    n_rows = odd.count()
    for n, df in operators(odd, labels).items():
        rows = df.collect()
        assert n == 1 or len(rows) == n_rows, n
        if n in (1, 4, 6, 7, 8, 10):
            assert all(r[c] == f"v{i}" for r in rows for i, c in enumerate(CLASH)), n


def test_hot_triggers_and_minimizers_change_nothing(odd):
    for f, columns in ((suffix_dedup.remove_repeats, ("kept", "span_start", "span_len")), (debruijn.remove_repeats, ("kept", "n_removed"))):
        rows = [sorted(repr([r[c] for c in ("doc_id", *columns)]) for r in f(odd, hot=hot).collect()) for hot in (10**9, 3, 0)]
        assert rows[0] == rows[1] == rows[2]


def test_strings_of_hot_triggers_spread(odd):
    """The largest group of one bucket does not grow with the surroundings of one line."""
    texts = [r.text.encode() for r in odd.where("doc_id < 60").select("text").collect() if r.text]

    def largest(blobs, hot):
        import numpy as np

        p = suffix_dedup.Phrases(blobs, 50, 16)
        found, _, counts = suffix_dedup._triggers(p)
        single = (counts > hot)[np.searchsorted(found, p.trigger)]
        strings = suffix_dedup._Strings(p, single, blobs, np.arange(len(blobs)), 50)
        per_hash = np.unique(strings.h1, return_counts=True)[1].max(initial=0)
        return counts[counts <= hot].max(initial=0), per_hash

    few, many = (largest(texts[: len(texts) // k], 10) for k in (3, 1))
    assert few[0] <= 10 and many[0] <= 10 and many[1] <= 1


def test_rows_without_key_spread(spark):
    d = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    from heirloom.llm import exchange

    chunks, n = exchange.chunked(d, "doc_id", "text", (), each=1000)
    sizes = [r["count"] for r in chunks.groupBy("chunk").count().collect()]
    assert len(sizes) == n > 10 and max(sizes) < 3 * 2000 / n


def test_ties_and_missing_keys_of_languages(spark):
    d = spark.createDataFrame([(i, "same words", "bb" if i % 2 else "aa") for i in range(40)] + [(None, "same words", "aa")] * 2, "doc_id long, text string, lang string")
    model = langid.train(d.where("doc_id is not null"))
    model.tables = {n: langid._Table(t.hashes, t.scores * 0) for n, t in model.tables.items()}
    assert {r.lang_pred for r in langid.identify(d, model).collect()} == {"aa"}


def test_pipeline_stages_on_empty_and_odd_rows(spark, empty, odd):
    import corpus_pipeline as c

    for docs in (empty, odd.select("doc_id", "text", "lang", "source", "n_chars")):
        for name, stage in c.STAGES:
            out = stage(spark, docs, "")
            if name != c.STAGES[-1][0]:
                assert out.columns == empty.columns
            assert out.count() >= 0
            docs = spark.createDataFrame(out.collect(), out.schema)


def test_words_of_any_kind_of_space():
    assert re.findall(mixing.WORD, "a\x0bb\x0cc d") == ["a", "b", "c d"]
