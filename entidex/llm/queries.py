"""The operators as queries over the given tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entidex.llm import bpe, clusters, codes, decontamination, html, jaccard, pii, pitman_yor, quality, rules, secrets, shards, urls
from entidex.llm.common import scratch, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer files lie on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every document; kept if it is likely good."""
    docs = table(spark, sf_dir, "documents")
    ratings = table(spark, sf_dir, "labels").withColumn("grade", quality.grade_of(F.col("quality"), F.col("toxic")))
    scored = quality.selected(quality.score(docs, quality.train(docs, ratings)))
    return scored.select("doc_id", "score", "expected_grade", F.get("tails", F.lit(0)).alias("p_not_toxic"), F.get("tails", F.lit(1)).alias("p_good"), "kept")


@query
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under Jaccard links of 5-word shingles."""
    return jaccard.join_texts(table(spark, sf_dir, "documents"))


SQL["op2_jaccard_join"] = """
with docs as (
  select row_number() over () as r, doc_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
  from documents
), shingles as (
  select distinct r, array_to_string(w[p:p + 4], ' ') as s
  from (select r, w, unnest(range(1, greatest(2, len(w) - 3))) as p from docs where len(w) > 0)
), sizes as (
  select r, count(*) as n from shingles group by r
), links as (
  select x.r as a, y.r as b from shingles x join shingles y on x.s = y.s and x.r < y.r
    join sizes m on m.r = x.r join sizes n on n.r = y.r
  group by x.r, y.r, m.n, n.n having 100 * count(*) >= 80 * (m.n + n.n - count(*))
), both_ways as (
  select a, b from links union all select b, a from links
), reach as (
  with recursive go(a, b) as (
    select r, r from docs union select g.a, l.b from go g join both_ways l on g.b = l.a
  ) select * from go
)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id from docs d left join sizes using (r)
  join (select a as r, min(e.doc_id) as component_id from reach join docs e on e.r = b group by a) using (r)
"""


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets.digests(secrets.find_secrets(table(spark, sf_dir, "documents")))


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path()))


@query
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and revealing terms in every document."""
    return pii.digests(pii.find_personal_data(table(spark, sf_dir, "documents")))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    return decontamination.digests(decontamination.phrase_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


SQL["op6_decontamination"] = """
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
), items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark
), windows as (
  select distinct item_id, least(10, len(w)) as n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') as v
  from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as p from items where len(w) > 0)
), spans as (
  select r, p, n, array_to_string(w[p:p + n - 1], ' ') as v
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as p from docs, (select distinct n from windows) where len(w) >= n)
), found as (
  select r, p, n, item_id from spans join windows using (n, v)
), hits as (
  select r, count(distinct q) as n_hit from (select r, unnest(range(p, p + n)) as q from found) group by r
), named as (
  select r, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as names from found group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (r) left join named using (r)
"""


@query
def op7_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document."""
    return pitman_yor.score_texts(table(spark, sf_dir, "documents"))


@query
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.with_url(table(spark, sf_dir, "pages"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every document; cutoffs are learnt from `labels`, per language."""
    verdicts = rules.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL["op9_quality_rules"] = """
with docs as (
  select row_number() over () as r, doc_id, lang, coalesce(text, '') as t from documents
), words as (
  select r, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines
  from docs
), windows as (
  select r, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] || ' ' || w[p + 4] as v
  from (select r, w, unnest(range(1, len(w) - 3)) as p from words where len(w) >= 5)
), again as (
  select r, p from (select r, p, count(*) over (partition by r, v) as n from windows) where n > 1
), covered as (
  select r, sum(least(5, p - coalesce(prev, p - 5))) as n
  from (select r, p, lag(p) over (partition by r order by p) as prev from again) group by r
), counted as (
  select d.doc_id, d.lang, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(t) - length(translate(t, '#*$%%&|<>', '')))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(c.n, 0)::bigint as n_repeat_words, len(lines)::bigint as n_lines,
    (length(t) - length(translate(t, '!', '')))::bigint as n_shouts,
    (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')))::bigint as n_capitals
  from docs d join words using (r) left join covered c using (r)
), based as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counted
), good as (
  select doc_id as label_of, min(quality) >= 1 as good from labels where quality is not null group by 1
), held as (
  select lang, good, unnest([
    {'m': 'symbols', 'a': n_symbols, 'b': word_chars}, {'m': 'shouts', 'a': n_shouts, 'b': n_words},
    {'m': 'capitals', 'a': n_capitals, 'b': word_chars}, {'m': 'dup_lines', 'a': n_dup_lines, 'b': n_lines},
    {'m': 'repeats', 'a': n_repeat_words, 'b': n_words}]) as x
  from based join good on doc_id = label_of where not base_failed
), tests as (
  select lang, x.m as metric, c as cutoff, count(*) filter (good) as n, count(*) filter (not good) as n_bad,
    count(*) filter (good and 100 * x.a > c * x.b) as k, count(*) filter (not good and 100 * x.a > c * x.b) as k_bad
  from held, (select unnest(%(cutoffs)s) as c) group by all
), terms as (
  select lang, metric, cutoff, n * ln(1 - %(rate)r) + sum(coalesce(ln((n - j + 1) / j) + ln(%(rate)r / (1 - %(rate)r)), 0))
    over (partition by lang, metric, cutoff order by j) as term
  from (select *, unnest(range(0, k + 1)) as j0, nullif(j0, 0) as j from tests where k < %(rate)r * n)
), passes as (
  select t.*, coalesce(k < %(rate)r * n and ln(s.p) <= ln(%(delta)r / ((select count(*) from (select distinct lang from held)) * %(metrics)d)), false) as passed
  from tests t left join (select lang, metric, cutoff, sum(exp(term)) as p from terms group by all) s
    on t.lang is not distinct from s.lang and t.metric = s.metric and t.cutoff = s.cutoff
), sound as (
  select *, bool_and(passed) over (partition by lang, metric order by cutoff desc) as sound,
    k_bad * n - %(penalty)d * k * n_bad as gain
  from passes
), chosen as (
  select lang, metric, cutoff from sound where sound and gain > 0
  qualify row_number() over (partition by lang, metric order by gain desc, cutoff desc) = 1
), limits as (
  select lang as lang_of, max(cutoff) filter (metric = 'symbols') as symbols, max(cutoff) filter (metric = 'shouts') as shouts,
    max(cutoff) filter (metric = 'capitals') as capitals, max(cutoff) filter (metric = 'dup_lines') as dup_lines,
    max(cutoff) filter (metric = 'repeats') as repeats
  from chosen group by lang
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or coalesce(100 * n_symbols > symbols * word_chars, false) or coalesce(100 * n_shouts > shouts * n_words, false)
    or coalesce(100 * n_capitals > capitals * word_chars, false) or coalesce(100 * n_dup_lines > dup_lines * n_lines, false)
    or coalesce(100 * n_repeat_words > repeats * n_words, false)) as kept
from based left join limits on lang is not distinct from lang_of
""" % {
    "cutoffs": list(rules.CUTOFFS),
    "rate": rules.ALPHA / len(rules.METRICS),
    "delta": rules.DELTA,
    "metrics": len(rules.METRICS),
    "penalty": rules.PENALTY,
}

SHARDS = 40


@query
def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards that all hold the sources in proportion."""
    placed = shards.interleave(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(shards.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source"
    )


SQL["op10_shards"] = """
with table_of as (
  select list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda c, i:
    case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc
), docs as (
  select doc_id, source, coalesce(text, '') as t, md5('%(seed)s:' || coalesce(doc_id::varchar, 'null')) as key from documents
), sized as (
  select doc_id, source, key, octet_length(encode(t)) + %(extra)d as size,
    xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::bigint)),
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) as text_crc32
  from docs, table_of
), fractions as (
  select *, (2 * (row_number() over (partition by source order by key, doc_id, text_crc32, size) - 1) + 1)
    / (2 * count(*) over (partition by source)) as fraction
  from sized
), placed as (
  select *, row_number() over (order by fraction, source nulls first, key, doc_id, text_crc32, size) - 1 as place, count(*) over () as total
  from fractions
), cut as (
  select *, (place * %(shards)d // total)::int as shard from placed
)
select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'rows' as law, shard,
  (place - (shard * total + %(shards)d - 1) // %(shards)d)::bigint as slot, null::int as grown_shard, source
from cut
""" % {"seed": shards.SEED, "extra": shards.ROW_BYTES, "shards": SHARDS}

#: The rules of op11 (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    rules_of = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages"), rules_of)


SQL["op11_url_filter"] = """
with rules(rule_host, rule_path, rule_verdict) as (values %(rules)s
), pages_of as (
  select row_number() over () as r, page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), parts as (
  select r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from pages_of
), fits as (
  select * from parts join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  qualify row_number() over (partition by r order by length(rule_host) + length(rule_path) desc, length(rule_host) desc, rule_verdict desc) = 1
)
select p.page_id, p.host, p.path, rule_host || rule_path as rule, coalesce(rule_verdict, '%(default)s') as verdict
from parts p left join fits f using (r)
""" % {"rules": ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES), "default": urls.DEFAULT}


@query
def op12_lloyd_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector, with the sums of the distances and the digest of its centroid."""
    return clusters.with_inertia(*clusters.cluster(table(spark, sf_dir, "embeddings")))


#: A vector's integers; whole vectors only; and the floor of a quotient in SQL.
_INTEGERS = "list_transform(embedding, lambda x: greatest(-134217728, least(134217728, floor(%d * x::double)))::bigint)"
_WHOLE = "embedding is not null and len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"
_FLOOR = "((sum(x) - ((sum(x) %% count(*)) + count(*)) %% count(*)) / count(*))::bigint"
_SQUARED = "list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"

SQL["op12_lloyd_clusters"] = (
    f"""
with kept as materialized (
  select row_number() over () as r, vec_id, embedding, {_INTEGERS % clusters.SCALE} as v from embeddings where {_WHOLE}
), c0 as materialized (
  select (row_number() over (order by key, embedding) - 1)::int as c, v
  from (select *, sha256('{clusters.SEED}:' || coalesce(vec_id::varchar, '')) as key from kept) qualify row_number() over (order by key, embedding) <= {clusters.CLUSTERS}
)"""
    + "".join(
        f""", a{t} as materialized (
  select r, c, d from (select p.r, c.c, {_SQUARED} as d from kept p, c{t} c) qualify row_number() over (partition by r order by d, c) = 1
), m{t} as materialized (
  select c, i, {_FLOOR.replace('%%', '%')} as x from (select c, unnest(v) as x, unnest(range(64)) as i from a{t} join kept using (r)) group by c, i
), c{t + 1} as materialized (
  select c, list(x order by i) as v from m{t} group by c union all select c, v from c{t} where c not in (select c from m{t})
)"""
        for t in range(clusters.ROUNDS)
    )
    + f""", a as materialized (
  select r, c, d from (select p.r, c.c, {_SQUARED} as d from kept p, c{clusters.ROUNDS} c) qualify row_number() over (partition by r order by d, c) = 1
)
select vec_id, c as cluster, d as distance, (sum(d) over (partition by c))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia,
  sha256(array_to_string(cc.v, ',')) as centroid_sha256
from a join kept using (r) join c{clusters.ROUNDS} cc using (c)
"""
)


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every vector, its error, and the error of all vectors of its label."""
    vectors = table(spark, sf_dir, "embeddings")
    codebooks = codes.train(vectors)
    coded = written(codes.encode(vectors, codebooks), scratch(spark), "coded")
    text = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return codes.with_label_error(coded).select("vec_id", text.alias("code"), "error", "label_error", F.lit(codes.codebook_digest(codebooks)).alias("codebooks_sha256"))


SQL["op13_vector_codes"] = (
    f"""
with kept as materialized (
  select row_number() over () as r, vec_id, label, embedding, {_INTEGERS % codes.SCALE} as w from embeddings where {_WHOLE}
), parts as materialized (
  select r, q, w[16 * q + 1:16 * q + 16] as v from (select r, w, unnest(range({codes.PARTS})) as q from kept)
), c0 as materialized (
  select q, e, v from parts join (
    select r, row_number() over (order by vec_id, embedding) - 1 as e from kept qualify row_number() over (order by vec_id, embedding) <= {codes.ENTRIES}) using (r)
)"""
    + "".join(
        f""", a{t} as materialized (
  select r, q, (least_of).e as e, (least_of).d as d from (
    select r, p.q, min({{'d': {_SQUARED}, 'e': c.e}}) as least_of from parts p join c{t} c on p.q = c.q group by r, p.q)
)"""
        + (
            f""", m{t} as materialized (
  select q, e, i, {_FLOOR.replace('%%', '%')} as x from (select q, e, unnest(v) as x, unnest(range(16)) as i from a{t} join parts using (r, q)) group by q, e, i
), c{t + 1} as materialized (
  select q, e, list(x order by i) as v from m{t} group by q, e union all select q, e, v from c{t} where (q, e) not in (select (q, e) from m{t})
)"""
            if t < codes.ROUNDS
            else ""
        )
        for t in range(codes.ROUNDS + 1)
    )
    + f""", coded as (
  select r, string_agg(lpad(lower(hex(e)), 2, '0'), '' order by q) as code, sum(d)::bigint as error from a{codes.ROUNDS} group by r
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
  (select sha256(string_agg(array_to_string(v, ','), ',' order by q, e)) from c{codes.ROUNDS}) as codebooks_sha256
from coded join kept using (r)
"""
)
