"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogspark.llm import (
    bin_completion, bottomk_dedup, bpe_stream, katz_lm, label_shards, length_histogram, licence_scan, norm_topk, ordinal_toxicity, phrase_trees, subspace_join, temperature_mix, vector_codes,
)
from catalogspark.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query("""
with recursive n as (select vec_id, [x::double for x in embedding] v from embeddings
  where embedding is not null and vec_id is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
u as (select vec_id, v, sqrt(list_sum([x * x for x in v])) l from n where list_sum([x * x for x in v]) > 0),
p as (select a.vec_id a, b.vec_id b from u a join u b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_dot_product(a.v, b.v) / (a.l * b.l) >= 0.95),
r as (select a node, b other from p union select r.node, p.b from r join p on r.other = p.a),
c as (select node, least(node, min(other)) component from r group by node),
d as (select a, count(*) n from p group by a)
select e.vec_id, coalesce(d.n, 0)::bigint n_links, coalesce(c.component, e.vec_id) component_id, coalesce(c.component, e.vec_id) = e.vec_id kept
from embeddings e left join d on d.a = e.vec_id left join c on c.node = e.vec_id
""")
def op1_subspace_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_join.link_vectors(table(spark, sf_dir, "embeddings"))


@query()
def op2_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = ordinal_toxicity.score(docs, ordinal_toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "toxicity.probability", F.col("toxicity.severity").alias("expected_severity"), "toxicity.grade", "toxicity.toxic")


@query("""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') w from documents),
g as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w[1]] else [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] end) s from w),
n as (select doc_id, count(*) n from g group by doc_id),
i as (select a.doc_id a, b.doc_id b, count(*) k from g a join g b on a.s = b.s and a.doc_id <> b.doc_id group by all),
p as (select a, b from i join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
r as (select a node, b other from p union select r.node, p.b from r join p on r.other = p.a),
c as (select node, least(node, min(other)) component from r group by node)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, coalesce(c.component, d.doc_id) component_id, coalesce(c.component, d.doc_id) = d.doc_id kept
from documents d left join n on n.doc_id = d.doc_id left join c on c.node = d.doc_id
""")
def op3_bottomk_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk_dedup.deduplicate(table(spark, sf_dir, "documents"), width=2)


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_completion.pack(table(spark, sf_dir, "documents"))


@query()
def op5_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = label_shards.shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "group_size", "cut_before", "cut_after")


@query()
def op6_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return katz_lm.score_documents(table(spark, sf_dir, "documents"), held_out)


@query("""
with n as (select vec_id, [floor(1024 * x::double)::bigint for x in embedding] v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
p as (select q.vec_id query_id, c.vec_id, list_dot_product(q.v::double[], c.v::double[])::bigint score
  from n q join n c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(q.v) = len(c.v)),
r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int "rank", vec_id, score from p)
select query_id, "rank", vec_id, score from r where "rank" <= 10
""")
def op7_norm_sorted_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_topk.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+'))::bigint n_tokens from documents),
s as (select source, sum(n_tokens)::bigint n, sum(n_tokens)::double / (select sum(n_tokens) from d) share from d group by source),
a as (select case when max(share) = min(share) then 0 else greatest(0, 1 - ln(2.0) / ln(max(share) / min(share))) end alpha from s where share > 0),
w as (select source, n, exp(alpha * ln(share)) / sum(exp(alpha * ln(share))) over () weight from s, a where share > 0),
q as (select *, round(weight * (select max(n / weight) from w))::bigint quota from w),
p as (select *, (quota // n)::int epochs, quota % n rest from q),
e as (select d.*, p.weight, p.epochs, p.rest, unnest(range(0, p.epochs + 1))::int epoch from d join p on d.source is not distinct from p.source),
h as (select *, md5(doc_id || '-' || epoch) place from e),
r as (select *, sum(n_tokens) over (partition by source, epoch order by place, doc_id, n_tokens) upto from h)
select doc_id, source, n_tokens, round(weight, 9) weight, epoch, substr(place, 1, 3) block, place
from r where epoch < epochs or (rest > 0 and upto <= rest)
""")
def op8_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = temperature_mix.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "mix.n_tokens", F.round("mix.weight", 9).alias("weight"), "mix.epoch", "mix.block", "mix.place")


@query()
def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licence_scan.scan_licences(table(spark, sf_dir, "documents"))
    families = F.array_join(F.array_sort(F.array_distinct(F.col("licences.family"))), ",")
    return found.select("doc_id", F.size("licences").alias("n_notices"), families.alias("families"), F.array_max(F.col("licences.probability")).alias("probability"),
                        F.array_max(F.col("licences.template_share")).alias("template_share"), F.col("licences"),
                        F.array_join(F.array_sort(F.array_distinct(F.col("suspected.family"))), ",").alias("suspected_families"), F.col("suspected"))


@query()
def op10_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.length_report(table(spark, sf_dir, "documents"), limits=[2**k for k in range(7, 18)])


@query("""
with t as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) p from t),
w as (select lang, regexp_extract_all(p, '[^\\x20\\x09]+') w from p),
s as (select lang, w, unnest(range(1, len(w) + 1)) i from w),
g as (select lang, w[i : i + m - 1] x from s, range(1, 5) r(m) where i + m - 1 <= len(w)),
f as materialized (select lang, x, len(x) m, count(*) n from g group by all),
u as (select lang, sum(n)::bigint n from f where m = 1 group by lang),
c as materialized (select * from f where m > 1 and n >= 30),
h as materialized (select lang, x, m, n a, k, x[1 : k] head, x[k + 1 : m] tail from (select *, unnest(range(1, m)) k from c)),
k as (select h.*, l.n l, r.n r, ((2000000::hugeint * a) // (l.n + r.n))::bigint score
  from h join f l on l.lang = h.lang and l.x = h.head join f r on r.lang = h.lang and r.x = h.tail),
b as (select lang, x, any_value(m) m, any_value(a) a, min(struct_pack(score := score, k := k, l := l, r := r)) best from k group by lang, x),
i as (select lang, x[o : o + e - 1] x, max(n) n from c, range(1, 4) j(o), range(2, 4) v(e) where e < m and o + e - 1 <= m group by all),
d as (select b.* from b left join i on i.lang = b.lang and i.x = b.x where i.n is null or 100 * i.n < 80 * b.a),
o as (select lang, array_to_string(x, ' ') phrase, a, best.l l, best.r r, best.score score from d),
z as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) "rank" from o)
select z.lang, "rank", phrase, a, l, r, u.n, score from z join u on u.lang = z.lang where "rank" <= 2000
""")
def op11_phrase_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_trees.collocations(table(spark, sf_dir, "documents"))


@query()
def op12_streaming_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.digests(table(spark, sf_dir, "documents"))


def _rounds_sql(rounds: int) -> str:
    """Assignments and moves of the codebooks, one pair of views per round, and the last assignment."""
    out = []
    for i in range(rounds + 1):
        out.append(f"""a{i} as (select vec_id, part, min(struct_pack(d := d, entry := entry)) best from (select p.vec_id, p.part, c.entry,
  (list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, c.x) + list_dot_product(c.x, c.x))::bigint d from p join c{i} c using (part)) group by all)""")
        if i < rounds:
            out.append(f"""c{i + 1} as (select c.part, c.entry, coalesce(m.x, c.x) x from c{i} c left join (
  select part, entry, list(y order by pos) x from (select part, best.entry entry, pos, floor(sum(y) / count(*)) y
    from (select a.part, a.best, unnest(p.x) y, generate_subscripts(p.x, 1) pos from a{i} a join p using (vec_id, part)) group by all) group by all) m
  on m.part = c.part and m.entry = c.entry)""")
    return ",\n".join(out)


@query(f"""
with k as (select vec_id, label, [floor(1024 * x::double) for x in embedding] v from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
p as (select vec_id, part, v[part * (len(v) // 4) + 1 : (part + 1) * (len(v) // 4)] x from k, range(4) r(part)),
c0 as (select part, row_number() over (partition by part order by vec_id) - 1 entry, x from p where vec_id in (select vec_id from k order by vec_id limit 256)),
{_rounds_sql(4)},
s as (select sha256(string_agg(y::bigint, ',' order by part, entry, pos)) digest from (select part, entry, unnest(x) y, generate_subscripts(x, 1) pos from c4)),
e as (select vec_id, string_agg(printf('%02x', best.entry), '' order by part) code, sum(best.d)::bigint error from a4 group by vec_id)
select k.vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, digest codebooks_sha256 from k join e using (vec_id), s
""")
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(table(spark, sf_dir, "embeddings"))
