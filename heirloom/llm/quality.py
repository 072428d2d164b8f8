"""Quality by hierarchical empirical Bayes over sites.

A classifier of the document alone gives its evidence: logistic regression on
the shape of the text and on words that labelled documents show to be telling,
fitted on a bounded sample of labelled rows.  Hosts and the paths on them get
posteriors of their mean quality from grouped sums over all documents: a path
is shrunk toward its host and a host toward the global prior, the more the
fewer documents it has; the strength of the shrinkage comes from the spread of
hosts around the global mean and of paths around their host's.  A document's
posterior odds are its own, moved by the odds of its path against the global
prior; its own evidence is taken off the sums of its path and host first, so that
it counts once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heirloom.cut import cut
from heirloom.llm import kernels as K
from heirloom.llm.common import add_columns, as_bytes, column, small_batches, spare, trimmed
from heirloom.llm.langid import _points, _Words, held_out

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#$%&*+/<=>@\\^_`{|}~")] = True
LOUD = np.zeros(256, bool)
LOUD[list(b"!?")] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
BREAK = np.zeros(256, bool)
BREAK[10] = True
N_SHAPE = 10


def shape(blobs: list[bytes]) -> np.ndarray:
    """Of each text: length, word length, shares of symbols, loud marks, digits, capitals and line breaks, and repetition."""
    words, counts = K.word_hashes(blobs, lower=True)
    out = np.zeros((len(blobs), N_SHAPE))
    at = 0
    for i, (b, n) in enumerate(zip(blobs, counts.tolist(), strict=True)):
        c, w = np.frombuffer(b, np.uint8), words[at : at + n]
        at += n
        size = max(1, len(c))
        many = np.bincount(c, minlength=256)
        distinct = np.unique(w, return_counts=True)[1] if n else np.zeros(1)
        out[i] = (
            np.log1p(n),
            np.log1p(size / max(1, n)),
            *(np.sqrt(many[k].sum() / size) for k in (SYMBOLS, LOUD, DIGIT, UPPER, BREAK)),
            len(distinct) / max(1, n),
            distinct.max() / max(1, n),
            (w[1:] == w[:-1]).mean() if n > 1 else 0.0,
        )
    return out


@dataclass
class Telling:
    """Words that speak for a label: sorted hashes."""

    hashes: np.ndarray

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Occurrences in each text, and their share of its words."""
        out = np.zeros((len(texts), 2))
        index = K.HashIndex(self.hashes)
        for lo, hi, points in _points(texts):
            w = _Words(points)
            doc = np.repeat(np.arange(hi - lo), w.counts)
            hits = np.bincount(doc[index.find(w.hash) >= 0], minlength=hi - lo)
            out[lo:hi, 0], out[lo:hi, 1] = np.log1p(hits), np.sqrt(hits / np.maximum(1, w.counts))
        return out


@dataclass
class Logistic:
    """Standardised logistic regression with squares; a constant where the labels agree."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @staticmethod
    def _wide(x: np.ndarray) -> np.ndarray:
        return np.hstack([np.ones((len(x), 1)), x, x**2])

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Logistic:
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = cls._wide(np.clip((x - mean) / scale, -8, 8))
        w = np.zeros(z.shape[1])
        w[0] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        if 0 < y.sum() < len(y):
            penalty = np.full(len(w), ridge)
            penalty[0] = 1e-6
            for _ in range(50):
                p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
                h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
                step = np.linalg.solve(h, z.T @ (y - p) - penalty * w)
                w += step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
                if np.abs(step).max() < 1e-6:
                    break
        return cls(mean, scale, w)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._wide(np.clip((x - self.mean) / self.scale, -8, 8)) @ self.weights, -30, 30)))


@dataclass
class Model:
    telling: dict[str, Telling]
    heads: dict[str, Logistic]

    def features(self, texts: list[str | None], blobs: list[bytes]) -> np.ndarray:
        return np.hstack([shape(blobs), *(self.telling[k].count(texts) for k in sorted(self.telling))])

    def predict(self, texts: list[str | None], blobs: list[bytes]) -> dict[str, np.ndarray]:
        x = self.features(texts, blobs)
        return {k: h.predict(x) for k, h in self.heads.items()}


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = 8000) -> Model:
    """Fit heads for ``quality`` and ``toxic`` on about ``sample`` labelled documents that are not held out.

    Telling words are those whose documents carry the rarer label far more often
    than chance (at least 5 of them, 6 deviations); the sample bounds their number.
    Unlabelled rows and null keys are left out; without labels the heads are 1/2.
    """
    lab = labels.select(F.col(key).alias("k"), "quality", "toxic").where("k is not null and quality is not null and toxic is not null")
    lab = lab.where(~held_out("k"))
    n = lab.count()
    luck = F.pmod(F.xxhash64("k", F.lit("labels")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = lab.where(luck < min(1.0, sample / max(1, n)))
    # Bounded by ``sample``.
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(chosen), "k")
    rows = cut(rows.select("text", F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            texts = batch.column("text").to_pylist()
            bad, toxic = 1 - batch.column("quality").to_numpy(), batch.column("toxic").to_numpy()
            for lo, hi, points in _points(texts):
                w = _Words(points)
                doc = np.repeat(np.arange(lo, hi), w.counts)
                order = np.lexsort((doc, w.hash))
                h, d = w.hash[order], doc[order]
                at = K.group_starts(h, d)
                yield pa.RecordBatch.from_pydict(
                    {"h": pa.array(h[at].view(np.int64)), "bad": pa.array(bad[d[at]], pa.int64()), "toxic": pa.array(toxic[d[at]], pa.int64()), "n": pa.array(np.ones(len(at)), pa.int64())}
                )

    totals = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(1 - F.col("quality")), F.lit(0)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    seen = rows.mapInArrow(trimmed(count), "h long, bad long, toxic long, n long").groupBy("h").agg(*[F.sum(c).alias(c) for c in ("bad", "toxic", "n")])
    telling = {}
    for name, total in (("bad", totals[1]), ("toxic", totals[2])):
        due = F.col("n") * F.lit(total / max(1, totals[0]))
        z = (F.col(name) - due) / F.sqrt(due + F.lit(1e-9))
        found = seen.where((F.col(name) >= 5) & (z > 6)).select("h").toPandas()
        telling[name] = Telling(np.sort(found.h.to_numpy(np.int64).view(np.uint64)))
    model = Model(telling, {})

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            x = model.features(batch.column("text").to_pylist(), as_bytes(batch.column("text")))
            yield pa.RecordBatch.from_pydict({"x": pa.array(x.tolist(), pa.list_(pa.float64())), "quality": batch.column("quality"), "toxic": batch.column("toxic")})

    data = rows.mapInArrow(trimmed(measure), "x array<double>, quality int, toxic int").toPandas()
    x = np.array(data.x.tolist()).reshape(len(data), N_SHAPE + 2 * len(telling))
    if len(x) == 0:
        x = np.zeros((1, N_SHAPE + 2 * len(telling)))
        return Model(telling, {k: Logistic(x[0], x[0] + 1, np.zeros(1 + 2 * x.shape[1])) for k in ("quality", "toxic")})
    return Model(telling, {k: Logistic.fit(x, data[k].to_numpy(float)) for k in ("quality", "toxic")})


def with_evidence(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``p_doc`` (quality) and ``p_toxic``, from the text alone; a null text counts as empty."""

    def compute(texts: pa.Array) -> list[pa.Array]:
        p = model.predict(texts.to_pylist(), as_bytes(texts))
        return [pa.array(p["quality"], pa.float64()), pa.array(p["toxic"], pa.float64())]

    return add_columns(docs, text, {"p_doc": T.DoubleType(), "p_toxic": T.DoubleType()}, compute)


def _strength(mean: float, groups: int, rows: float, spread: float, within: float) -> float:
    """How many documents a prior is worth: from the squared distances of group means (weighted by rows), beyond what their sizes explain."""
    between = max(1e-6, (spread - groups * within) / max(1.0, rows))
    return float(np.clip(mean * (1 - mean) / between - 1, 1.0, 1e6))


def with_site_priors(scored: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """Add ``site_quality``, the shrunk mean of the other rows of the row's path, and ``posterior``, the document's quality given its site.

    ``scored`` has ``p_doc``.  Groups are (host) and (host, path), nulls being
    groups of their own; sums are aggregated before any shuffle, so a host that
    holds most rows costs one sum per task.  Only a few sums reach the driver.
    Columns of the input with these two names are replaced, all others pass
    through.  A row alone in its path has the host's mean of other rows, one alone
    in its host the global mean.  An empty input gives an empty result.
    """
    passed = [c for c in scored.columns if c.lower() not in ("site_quality", "posterior")]
    h, p = spare(passed, "_h", "_p")
    names = spare(passed, "_n", "_s", "_hn", "_hs")
    s = scored.select(*map(column, passed)).withColumns(
        {h: F.coalesce(F.concat(F.lit("h"), column(host).cast("string")), F.lit("n")), p: F.coalesce(F.concat(F.lit("p"), column(path).cast("string")), F.lit("n"))}
    )
    cells = cut(s.groupBy(h, p).agg(F.count(F.lit(1)).alias("n"), F.sum("p_doc").alias("s"), F.sum(F.col("p_doc") ** 2).alias("ss")))
    hosts = cells.groupBy(h).agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.count(F.lit(1)).alias("paths"), F.sum("ss").alias("ss"), F.sum(F.col("s") ** 2 / F.col("n")).alias("square"))
    zero = F.lit(0.0)
    add = lambda c: F.coalesce(F.sum(c), zero).cast("double")
    n, total, of_hosts, n_hosts, n_paths, squares, inner = hosts.agg(
        add("hn"), add("hs"), add(F.col("hs") ** 2 / F.col("hn")), F.count(F.lit(1)), add("paths"), add("ss"), add("square")
    ).first()
    mean = float(np.clip(total / n if n else 0.5, 1e-4, 1 - 1e-4))
    # Sums of squares: of hosts around the mean, of paths around their host, of documents around their path.
    within = max(1e-6, (squares - inner) / (n - n_paths)) if n > n_paths else max(1e-6, mean * (1 - mean))
    k_host = _strength(mean, n_hosts - 1, n, of_hosts - n * (total / n if n else 0.0) ** 2, within)
    k_path = _strength(mean, n_paths - n_hosts, n, inner - of_hosts, within)
    sums = cells.join(hosts.select(h, "hn", "hs"), h).select(h, p, *[F.col(c).alias(name) for c, name in zip(("n", "s", "hn", "hs"), names, strict=True)])
    own = F.col("p_doc")
    n_p, s_p, n_h, s_h = map(F.col, names)
    host_mean = (s_h - own + F.lit(k_host * mean)) / (n_h - 1 + F.lit(k_host))
    site = (s_p - own + F.lit(k_path) * host_mean) / (n_p - 1 + F.lit(k_path))
    bounded = lambda x: F.least(F.greatest(x, F.lit(1e-9)), F.lit(1 - 1e-9))
    logit = lambda x: F.log(x / (1 - x))
    z = logit(bounded(own)) + logit(bounded(site)) - F.lit(float(np.log(mean / (1 - mean))))
    return s.join(sums, [h, p]).select(*map(column, passed), bounded(site).alias("site_quality"), (1 / (1 + F.exp(-z))).alias("posterior"))


def classify(docs: DataFrame, model: Model, host: str = "source", path: str = "lang", text: str = "text") -> DataFrame:
    """Add ``p_doc, p_toxic, site_quality, posterior, kept`` to every row: kept if likely good and likely not toxic."""
    out = with_site_priors(with_evidence(docs, model, text), host, path)
    return out.withColumn("kept", (F.col("posterior") >= 0.5) & (F.col("p_toxic") < 0.5))
