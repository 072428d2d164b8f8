"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heirloom.cut import cut
from heirloom.llm import codes, debruijn, fingerprints, langid, line_dedup, lloyd, lm, media_gif, minhash, mixing, pieces, quality, suffix_dedup, vectors
from heirloom.llm.common import documents


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = cut(mixing.with_size(documents(spark, sf_dir).select("doc_id", "source", "text")).drop("text"))
    return mixing.mix_to_targets(sized).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(documents(spark, sf_dir))


def op3_media_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = media_gif.decode_media(media_gif.to_media(documents(spark, sf_dir)))
    return m.select(
        "doc_id",
        "n_bytes",
        F.octet_length("samples").cast("long").alias("payload_bytes"),
        F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.substring("samples", -32, 32)).alias("tail_crc32"),
        F.octet_length("gif").cast("long").alias("media_bytes"),
        F.sha2("gif", 256).alias("media_sha256"),
        F.concat_ws(";", F.concat_ws("x", "width", "height"), F.size("frames"), F.aggregate("frames", F.lit(0).cast("long"), lambda a, f: a + f["delay_cs"]), F.xxhash64("frames")).alias("feature"),
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return r.select(
        "doc_id",
        "n_bytes",
        F.aggregate("span_len", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("span_len").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), words=4, percent=80)


def op6_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = debruijn.remove_repeats(documents(spark, sf_dir))
    return r.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.size("spans").cast("long").alias("n_spans"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(docs)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(documents(spark, sf_dir)).withColumn("log_score", F.round("log_score", 6))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = pieces.load_vocabulary()
    found = pieces.decode_documents(pieces.encode_documents(documents(spark, sf_dir), v), v)
    return found.select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        F.length("decoded").cast("long").alias("n_chars"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = cut(quality.with_evidence(docs.select("doc_id", "text", "source", "lang"), model).drop("text"))
    found = quality.with_site_priors(scored)
    return found.select(
        "doc_id", langid.held_out().alias("held_out"), "p_doc", "site_quality", "posterior", "p_toxic", ((F.col("posterior") >= 0.5) & (F.col("p_toxic") < 0.5)).alias("kept")
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    found, books = codes.compress(rows)
    coded = cut(found.select("vec_id", "code", "error", "label"))
    summed = vectors.with_group_sum(coded, "label", "error", "label_error")
    return summed.select("vec_id", "code", "error", "label_error", F.lit(codes.books_sha256(books)).alias("codebooks_sha256"))


def op12_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = lloyd.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    placed = cut(found.select("vec_id", "cluster", "distance"))
    # One row a cluster.
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(lloyd.centroid_digests(spark, centroids), "cluster")
    every = placed.agg(F.sum("distance")).first()[0]
    return placed.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(every).cast("long").alias("inertia"), "centroid_sha256")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    kept = line_dedup.kept_text(F.col("text"), F.col("keep"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(kept, 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_fingerprints": op2_fingerprints,
    "op3_media_gif": op3_media_gif,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_minhash": op5_minhash,
    "op6_debruijn": op6_debruijn,
    "op7_language_id": op7_language_id,
    "op8_lm_scores": op8_lm_scores,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_quality": op10_quality,
    "op11_vector_codes": op11_vector_codes,
    "op12_lloyd": op12_lloyd,
    "op13_line_dedup": op13_line_dedup,
}
_WORDS = "regexp_extract_all(coalesce({}, ''), '[^\\x20\\x09-\\x0D]+')"
_TOKENS = f"t as (select doc_id, w, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from (select doc_id, {_WORDS.format('text')} as w from documents))"
_AHEAD = "(order by cap / w, source rows between unbounded preceding and 1 preceding)"

_FINITE = "embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Rounds of assignment written out one after another, a row for each component."""
    steps = [
        f"""k as materialized (select *, row_number() over (order by vec_id) as r from (select vec_id, label, list_transform(embedding, lambda x: cast(floor(cast(x as double) * 4096) as bigint)) as v from embeddings where {_FINITE})),
c as materialized (select vec_id, r, label, (i - 1) // (len(v) // {parts}) as p, (i - 1) % (len(v) // {parts}) as j, v[i] as x from (select *, unnest(range(1, len(v) + 1)) as i from k)),
b0 as materialized (select p, r - 1 as e, j, x as m from c where r <= {entries})"""
    ]
    for t in range(rounds + 1):
        steps.append(f"""d{t} as (select r, c.p, e, sum((x - m) * (x - m)) as d from c join b{t} b on c.p = b.p and c.j = b.j group by 1, 2, 3),
a{t} as materialized (select r, p, arg_min(e, (d, e)) as e, min(d) as d from d{t} group by 1, 2)""")
        if t < rounds:
            steps.append(f"""n{t} as (select c.p, a.e, c.j, sum(x) as s, count(*) as n from c join a{t} a on a.r = c.r and a.p = c.p group by 1, 2, 3),
b{t + 1} as materialized (select b.p, b.e, b.j, coalesce(n.s // n.n - case when n.s % n.n < 0 then 1 else 0 end, b.m) as m from b{t} b left join n{t} n on n.p = b.p and n.e = b.e and n.j = b.j)""")
    return "with " + ",\n".join(steps) + f""", f as (select r, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' order by p) as code, cast(sum(d) as bigint) as error from a{rounds} group by 1)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, (select sha256(string_agg(cast(m as varchar), ',' order by p, e, j)) from b{rounds}) as codebooks_sha256 from k join f using (r)"""


def _lloyd_sql(clusters: int = 8, width: int = 64, rounds: int = 10) -> str:
    steps = [
        f"""k as materialized (select *, row_number() over (order by sha256(concat('3:', vec_id))) as r from (select vec_id, list_transform(embedding, lambda x: cast(floor(cast(x as double) * 1024) as bigint)) as v from embeddings where {_FINITE} and len(embedding) = {width})),
c as materialized (select r, j, v[j] as x from (select *, unnest(range(1, len(v) + 1)) as j from k)),
b0 as materialized (select r - 1 as e, j, x as m from c where r <= {clusters})"""
    ]
    for t in range(rounds + 1):
        steps.append(f"""d{t} as (select r, e, sum((x - m) * (x - m)) as d from c join b{t} b using (j) group by 1, 2),
a{t} as materialized (select r, arg_min(e, (d, e)) as e, min(d) as d from d{t} group by 1)""")
        if t < rounds:
            steps.append(f"""n{t} as (select a.e, c.j, sum(x) as s, count(*) as n from c join a{t} a using (r) group by 1, 2),
b{t + 1} as materialized (select b.e, b.j, coalesce(n.s // n.n - case when n.s % n.n < 0 then 1 else 0 end, b.m) as m from b{t} b left join n{t} n on n.e = b.e and n.j = b.j)""")
    return "with " + ",\n".join(steps) + f""", h as (select e, sha256(string_agg(cast(m as varchar), ',' order by j)) as centroid_sha256 from b{rounds} group by 1)
select vec_id, cast(e as integer) as cluster, cast(d as bigint) as distance, cast(sum(d) over (partition by e) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia, centroid_sha256 from k join a{rounds} using (r) join h using (e)"""


_BLANK = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
_LINES = f"""l as (select doc_id, i, list[i] as line, translate(trim(list[i], {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from (select doc_id, list, unnest(range(1, len(list) + 1)) as i from (select doc_id, string_split(coalesce(text, ''), chr(10)) as list from documents))),
f as (select key, min(doc_id) as first from l where length(key) >= 10 group by 1 having count(distinct doc_id) > 1),
m as (select l.*, coalesce(l.doc_id > f.first, false) as lost from l left join f using (key))"""

ORACLE: dict[str, str] = {
    "op1_mix_sources": f"""with s as (select doc_id, source, cast(len({_WORDS.format('text')}) as bigint) as size from documents),
t as (select source, cast(sum(size) as bigint) as ss from s group by 1),
w as (select *, cast(case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as double) as w, cast(2 * ss as double) as cap from t),
o as (select *, cast(sum(ss) over () as double) * cast(1.5 as double) as every, coalesce(sum(cap) over {_AHEAD}, 0) as used, sum(w) over () - coalesce(sum(w) over {_AHEAD}, 0) as rest from w),
f as (select *, (every - used) >= cap / w * rest as is_full from o),
g as (select *, sum(case when is_full then cap else 0 end) over () as fc, sum(case when is_full then 0 else w end) over () as ow from f),
r as (select source, ss, case when is_full then cap else least(cap, (every - fc) / nullif(ow, 0) * w) end as target, cast(cast('0x' || substr(md5('17:' || coalesce(source, chr(0) || 'null')), 1, 8) as bigint) as double) / cast(4294967296 as double) as u from g),
p as (select s.doc_id, s.size, r.ss, r.target, r.u, case when r.ss > 0 then r.target / r.ss else 0 end as rate, row_number() over (partition by s.source order by s.size, cast('0x' || substr(md5(cast(s.doc_id as varchar)), 1, 8) as bigint) % greatest(1, (select count(*) from s) // 50000), s.doc_id) as place from s join r on s.source is not distinct from r.source),
c as (select *, cast(least(floor(u + rate * place) - floor(u + rate * (place - 1)), ceil(rate)) as bigint) as copies from p)
select doc_id, size, ss as source_size, target, copies * size as taken, copies from c""",
    "op5_minhash": f"""with recursive d as (select doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i+3], ' ') as g from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, case when len(w) > 0 then 2 else 1 end))) as i from d)),
n as (select doc_id, count(*) as n from s group by 1),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as both_ from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e0 as (select p.a, p.b from pairs p join n x on x.doc_id = p.a join n y on y.doc_id = p.b where 100 * p.both_ >= 80 * (x.n + y.n - p.both_)),
e as (select a, b from e0 union all select b, a from e0),
r(id, c) as (select doc_id, doc_id from d union select e.b, r.c from r join e on e.a = r.id where r.c < e.b)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.c as component_id, d.doc_id = m.c as kept from d left join n using (doc_id) join (select id, min(c) as c from r group by 1) m on m.id = d.doc_id""",
    "op8_lm_scores": f"""with {_TOKENS}, c as (select doc_id, i, word, lag(word) over (partition by doc_id order by i) as p1, lag(word, 2) over (partition by doc_id order by i) as p2 from t),
n as (select *, count(*) over () as total, count(*) over (partition by doc_id) as mine, count(*) over (partition by word) - count(*) over (partition by doc_id, word) as c1,
case when p1 is null then 0 else count(*) over (partition by p1, word) - count(*) over (partition by doc_id, p1, word) end as c2,
case when p2 is null then 0 else count(*) over (partition by p2, p1, word) - count(*) over (partition by doc_id, p2, p1, word) end as c3 from c),
x as (select *, lag(c1) over (partition by doc_id order by i) as x1, lag(c2) over (partition by doc_id order by i) as x2, case when c1 > 0 then cast(c1 as double) / (total - mine) else cast(0.4 as double) / (total + 1) end as v1 from n),
y2 as (select *, case when p1 is null then v1 when c2 > 0 and x1 > 0 then cast(c2 as double) / x1 else cast(0.4 as double) * v1 end as v2 from x),
y3 as (select doc_id, case when p2 is null then v2 when c3 > 0 and x2 > 0 then cast(c3 as double) / x2 else cast(0.4 as double) * v2 end as v,
case when p1 is null then c1 > 0 when p2 is null then c2 > 0 and x1 > 0 else c3 > 0 and x2 > 0 end as seen from y2),
z as (select doc_id, count(*) as n, count(case when seen then 1 end) as s, round(sum(log10(v)) / count(*), 6) as l from y3 group by 1)
select d.doc_id, coalesce(z.n, 0) as n_words, coalesce(z.s, 0) as n_seen, z.l as log_score from documents d left join z using (doc_id)""",
    "op11_vector_codes": _codes_sql(),
    "op12_lloyd": _lloyd_sql(),
    "op13_line_dedup": f"with {_LINES} select doc_id, count(*) as n_lines, count(case when lost then 1 end) as n_dropped, sha256(coalesce(string_agg(case when not lost then line end, chr(10) order by i), '')) as kept_sha256 from m group by 1",
}
