"""Every stage of the pipeline against a plain version of it, row by row."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from heirloom.llm import pieces

WORD = r"[^\x20\x09-\x0D]+"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    r = random.Random(21)
    vocab = {k: ["".join(r.choice(k) for _ in range(r.randint(2, 7))) for _ in range(80)] for k in ("abcdeé", "klmnoß")}
    say = lambda n, k="abcdeé": " ".join(r.choice(vocab[k]) for _ in range(n))
    base, passage, line = say(120), say(60), "é" * 30 + say(12)
    near = base.split()
    near[50] = "other"
    texts = [base, base.upper(), " ".join(near), say(40) + " " + passage, passage + "\n" + say(25), None, "", "12 34 !!", "ab", "abc abc " * 60, say(900)]
    texts += [line + " " + say(r.randint(5, 60), "klmnoß" if i % 2 else "abcdeé") for i in range(40)]
    lang = lambda i: None if i % 9 == 0 else "k" if i > 10 and i % 2 == 0 else "a"
    return [{"doc_id": 7 * i, "text": t, "lang": lang(i), "source": r.choice(["s1", "s2", "s3", None]), "n_chars": len(t or "")} for i, t in enumerate(texts)]


def language_id(rows):
    import zlib

    split = lambda t: ["".join(x.lower()[0] for x in w) for w in re.findall(r"[^\W\d_]+", t or "")]
    learn = [(d["text"], d["lang"]) for d in rows if d["text"] is not None and d["lang"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 4 != 2]
    langs, tables = sorted({x for _, x in learn}), {}
    for n in range(6):
        by = {x: Counter() for x in langs}
        for t, x in learn:
            for w in split(t):
                c = f"#{w}#"
                by[x].update([w] if n == 0 else [c[i : i + n] for i in range(1 if n == 1 else 0, len(c) - n + 1)])
        total = sum(by.values(), Counter())
        known = [g for g, c in total.items() if c >= 2 or n == 1]
        size = {x: sum(by[x][g] for g in known) + 0.5 * (len(known) + 1) for x in langs}
        tables[n] = {g: np.array([math.log((by[x][g] + 0.5) / size[x]) for x in langs]) for g in known}

    def score(w):
        if w in tables[0]:
            return tables[0][w]
        c = f"#{w}#"
        ends = [next((tables[n][c[e - n : e]] for n in range(5, 0, -1) if n <= e and c[e - n : e] in tables[n]), np.full(len(langs), math.log(1e-6))) for e in range(2, len(c) + 1)]
        return sum(ends) / len(ends)

    out = []
    for d in rows:
        ws = split(d["text"])
        if ws:
            total = sum(map(score, ws))
            share = 1 / np.exp((total - total.max()) / math.sqrt(len(ws))).sum()
            if share >= 0.5:
                out.append(d | {"lang": d["lang"] or langs[int(total.argmax())]})
    return out


def near_dedup(rows):
    sets = {}
    for d in rows:
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in re.findall(WORD, d["text"] or "")]
        sets[d["doc_id"]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    up = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((up[a], up[b]))
                up = {k: lo if v == hi else v for k, v in up.items()}
    return [d for d in rows if up[d["doc_id"]] == d["doc_id"]]


def suffix_repeats(rows):
    first, out = {}, []
    blobs = {d["doc_id"]: (d["text"] or "").encode() for d in rows}
    for k in sorted(blobs):
        for i in range(len(blobs[k]) - 49):
            first.setdefault(blobs[k][i : i + 50], k)
    for d in rows:
        b = blobs[d["doc_id"]]
        mask = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < d["doc_id"]:
                mask[i : i + 50] = b"\1" * 50
        text = bytes(x for x, m in zip(b, mask, strict=True) if not m).decode(errors="ignore")
        out.append(d | {"text": text, "n_chars": len(text)})
    return out


def mix_sources(rows):
    size = {d["doc_id"]: len(re.findall(WORD, d["text"] or "")) for d in rows}
    groups = defaultdict(list)
    for d in rows:
        groups[d["source"]].append(d)
    names = sorted(groups, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    whole = {s: sum(size[d["doc_id"]] for d in groups[s]) for s in names}
    # Water filling by hand: give by weight, stop at twice a source's size, share the rest again.
    target, open_, left = dict.fromkeys(names, 0.0), set(names), 1.5 * sum(whole.values())
    while open_ and left > 1e-9:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        given = {s: min(share[s], 2.0 * whole[s] - target[s]) for s in open_}
        for s in given:
            target[s] += given[s]
        left -= sum(given.values())
        open_ = {s for s in open_ if 2.0 * whole[s] - target[s] > 1e-9}
    out = []
    for s in names:
        if not whole[s]:
            continue
        u = int(hashlib.md5(f"17:{s if s is not None else chr(0) + 'null'}".encode()).hexdigest()[:8], 16) / 2**32
        rate = target[s] / whole[s]
        for place, d in enumerate(sorted(groups[s], key=lambda d: (size[d["doc_id"]], d["doc_id"])), 1):
            # One copy for each whole number that the stretch of the sum crosses.
            crossed = math.floor(u + rate * place + 1e-9) - math.floor(u + rate * (place - 1) + 1e-9)
            out += [d] * crossed
    return out


PLAIN = {"language_id": language_id, "near_dedup": near_dedup, "suffix_repeats": suffix_repeats, "mix_sources": mix_sources}


@pytest.fixture(scope="module")
def stages(spark):
    """By stage, what it was given and what it made."""
    import corpus_pipeline as c

    rows, found = corpus(), {}
    for name, stage in c.STAGES:
        docs = spark.createDataFrame([tuple(d[x] for x in COLUMNS) for d in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        made = [r.asDict() for r in stage(spark, docs, "").collect()]
        found[name] = (rows, made)
        rows = made
    return found


def in_order(rows):
    return sorted(repr([d[c] for c in COLUMNS]) for d in rows)


@pytest.mark.parametrize("name", list(PLAIN))
def test_stage(stages, name):
    given, made = stages[name]
    assert in_order(made) == in_order(PLAIN[name](given))


def test_stages_do_something(stages):
    sizes = {name: (len(given), len(made)) for name, (given, made) in stages.items()}
    assert sizes["language_id"][1] < sizes["language_id"][0] and sizes["near_dedup"][1] < sizes["near_dedup"][0]
    given, made = stages["suffix_repeats"]
    assert sum(d["n_chars"] for d in made) < sum(d["n_chars"] for d in given) and len(made) == len(given)


def test_pieces_of_the_last_stage(stages):
    v = pieces.load_vocabulary()
    given, made = stages["sample_pieces"]
    text = {d["doc_id"]: d["text"] or "" for d in given}
    assert Counter(d["doc_id"] for d in made) == Counter(d["doc_id"] for d in given)
    for d in made:
        spelled = b"".join(v.pieces[i] for i in d["pieces"])[1:].decode()
        assert spelled == text[d["doc_id"]] and d["n_pieces"] == len(d["pieces"]) and d["decoded_sha256"] == hashlib.sha256(spelled.encode()).hexdigest()


#: Names that operators and stages use for results or on the way.
CLASHING = ["kept", "n_bytes", "score", "lang_pred", "size", "target", "copies", "taken", "source_size", "_place", "_user7", "component_id", "span_start", "chunk", "key", "a.b", "_size", "_copy"]


@pytest.mark.parametrize("name", list(PLAIN))
def test_stages_leave_clashing_columns_alone(spark, name):
    import corpus_pipeline as c

    rows = corpus() + [corpus()[0], corpus()[3] | {"text": "another text of the same key " + corpus()[3]["text"]}, corpus()[12] | {"doc_id": None}]
    # A stage that removes rows by key or text must bring each row back with its own values.
    mark = lambda i: [f"{x}-{i}" for x in CLASHING]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{x}` string" for x in CLASHING)
    docs = spark.createDataFrame([(*[d[x] for x in COLUMNS], *mark(i)) for i, d in enumerate(rows)], schema).repartition(3)
    bare = docs.select(*COLUMNS)
    stage = dict(c.STAGES)[name]
    made = stage(spark, docs, "")
    assert made.columns == docs.columns
    got = [r.asDict() for r in made.collect()]
    assert got and all([d[x] for x in CLASHING] == mark(d["kept"].split("-")[1]) for d in got)
    assert all((rows[int(d["kept"].split("-")[1])]["doc_id"], rows[int(d["kept"].split("-")[1])]["source"]) == (d["doc_id"], d["source"]) for d in got)
    plain = [r.asDict() for r in stage(spark, bare, "").collect()]
    if name != "mix_sources":  # there, rows that agree in source, size and key share their copies in any order
        assert in_order(got) == in_order(plain)
    assert len(got) == len(plain)
    if name == "near_dedup":
        assert Counter(d["doc_id"] for d in got if d["doc_id"] is not None).most_common(1)[0][1] == 1


def test_run_gives_the_rows_of_the_stages(spark, stages, tmp_path):
    import corpus_pipeline as c

    docs = spark.createDataFrame([tuple(d[x] for x in COLUMNS) for d in corpus()], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows = lambda ds: sorted(repr((d["doc_id"], list(d["pieces"]), d["decoded_sha256"])) for d in ds)
    assert rows(r.asDict() for r in c.run(spark, str(tmp_path)).collect()) == rows(stages["sample_pieces"][1])
