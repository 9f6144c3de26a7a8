"""Pages, binary contents, written bundles, hand-off documents: everything that crosses a file boundary."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogspark.functions.canon import canonical_json
from catalogspark.operators import media as M
from catalogspark.plans.derived import table, texts
from catalogspark.plans.registry import query
from catalogspark.scale import spread, with_scalars, work_dir
from catalogspark.sinks import handoff as H
from catalogspark.sinks import manifest as K
from catalogspark.sources import blobs as B
from catalogspark.sources import pages as P
from catalogspark.sources import readers as R

LIMBS = ", ".join(f"sum(('0x' || substr(h,{a},15))::bigint)::varchar" for a in (1, 16, 31, 46))
#: Order-free digest of rows hashed as ``h``, worked out apart from the library.
DIGEST_SQL = f"sha256(concat_ws(':', count(*)::varchar, {LIMBS}))"


def _pages(spark, sf):
    return spread(table(spark, sf, "pages"))


@query("S10 F14 P2", r"""select page_id, len(regexp_extract_all(html, '(?is)<script[^>]*>(.*?)</script>', 1))::int as scripts,
 regexp_extract(html, 'track\(([0-9]+)\)', 1) as track_id, nullif(regexp_extract(html, 'var t="([^"]*)"', 1), '') as t, null::varchar as problem,
 trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) as title from pages""")
def page_state_extract(spark, sf):
    p = _pages(spark, sf)
    state = P.page_state(p, "page_id", "html", {"track_id": r"track\((\d+)\)", "t": r'var t="([^"]*)"'})
    return state.join(p.select("page_id", P.page_title(F.col("html")).alias("title")), "page_id")


@query("F14 S10", r"""select page_id, sha256(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'),
 '(?s)<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) as text_sha from pages""")
def page_visible_text(spark, sf):
    return _pages(spark, sf).select("page_id", F.sha2(P.visible_text(F.col("html")), 256).alias("text_sha"))


@query("F39", """with x as (select page_id, regexp_extract_all(html, 'href="(/[^"]*)"', 1) items from pages)
select page_id, unnest(range(len(items)))::int as slot, unnest(items) as item, len(items) > 5 as over_full from x""")
def list_page_items(spark, sf):
    return P.list_items(_pages(spark, sf), "page_id", "html", 'href="(/[^"]*)"', 5)


BLOB_SQL = "unhex(case p_type when 'PROMO' then '00' when 'ECONOMY' then '89504E470D0A1A0A' when 'STANDARD' then '47494638' else 'FFD8FF' end) || encode(repeat(p_name, p_size::int))"


def _images(spark, sf):
    head = F.when(F.col("p_type") == "PROMO", "00").when(F.col("p_type") == "ECONOMY", B.MAGIC["png"]).when(F.col("p_type") == "STANDARD", B.MAGIC["gif"]).otherwise(B.MAGIC["jpg"])
    body = F.encode(F.repeat("p_name", F.col("p_size")), "UTF-8")
    return table(spark, sf, "part").select(
        "p_partkey", F.concat(F.unhex(head), body).alias("content"), F.when(F.col("p_size") > 45, "image/png").otherwise("image/jpeg").alias("mime"), "p_size", "p_type")


@query("S9", f"""with b as (select p_partkey, {BLOB_SQL} c, p_size, p_type from part)
select p_partkey, octet_length(c)::bigint as bytes, sha256(c) as sha256, case p_type when 'PROMO' then null when 'ECONOMY' then 'png' when 'STANDARD' then 'gif' else 'jpg' end as detected,
 case when octet_length(c) > 400 then 'too-large' when p_type = 'PROMO' then 'unknown-type' when (p_type = 'ECONOMY') <> (p_size > 45) or p_type = 'STANDARD' then 'type-mismatch' end as problem from b""")
def image_facts(spark, sf):
    images = _images(spark, sf).withColumn("mime", F.regexp_replace("mime", "^image/", ""))
    return B.image_facts(images, "p_partkey", "content", "mime", max_bytes=400)


@query("S16 J12", """select l_partkey as path, 'file-missing' as problem from (select distinct l_partkey from lineitem where l_returnflag = 'A' except select p_partkey from part where p_size > 5)
union all select p_partkey, 'orphan-file' from (select p_partkey from part where p_size > 5 except select l_partkey from lineitem where l_returnflag = 'A')""")
def media_cross_check(spark, sf):
    records = table(spark, sf, "lineitem").where("l_returnflag = 'A'").select(F.col("l_partkey").alias("path"))
    return B.cross_check(records, table(spark, sf, "part").where("p_size > 5").select(F.col("p_partkey").alias("path")), "path")


@query("S16", """with t as (select unnest(regexp_extract_all(html, 'href="/([^"]*)"', 1)) token, url from pages), k as (select distinct token from t where url like '%/en/%')
select token, count(*) as uses from t where token not in (select token from k) group by 1""")
def unknown_inline_tokens(spark, sf):
    p = _pages(spark, sf)
    known = p.where("url like '%/en/%'").select(F.explode(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1))).alias("token"))
    return B.token_check(p, "html", 'href="/([^"]*)"', known, "token")


@query("W8", """select l_partkey, l_suppkey, count(*) as variants, case when count(*) filter (where l_linestatus = 'O') = 1 then min(l_orderkey) filter (where l_linestatus = 'O') end as l_orderkey,
 case when count(*) filter (where l_linestatus = 'O') = 0 then 'no-original' when count(*) filter (where l_linestatus = 'O') > 1 then 'several-originals' end as problem from lineitem group by 1, 2""")
def original_per_path(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_linestatus", "l_orderkey")
    return M.original_per_path(li, ["l_partkey", "l_suppkey"], F.col("l_linestatus") == "O", "l_orderkey")


MEDIA_SQL = """m as (select l_partkey owner, sha256((l_quantity)::int::varchar) sha, l_orderkey * 10 + l_linenumber as "name", l_returnflag = 'R' and l_quantity > 45 cover, l_quantity::int bytes from lineitem)"""


def _media(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("owner"), F.sha2(F.col("l_quantity").cast("int").cast("string"), 256).alias("sha"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("name"), ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).alias("cover"),
        F.col("l_quantity").cast("int").alias("bytes"))


@query("W8 W12 K10", f"""with {MEDIA_SQL}, b as (select owner, sha, min((case when cover then 0 else 1 end, "name")) k, count(*) copies from m group by 1, 2)
select owner, sha, k[2] as "name", copies, row_number() over (partition by owner order by k, sha) as media_order, row_number() over (partition by owner order by k, sha) = 1 as is_cover from b""")
def ordered_media(spark, sf):
    return M.ordered_media(_media(spark, sf), "owner", "sha", ["name"], F.col("cover"))


@query("A22", f"""with {MEDIA_SQL}, p as (select owner, sha, count(*) n, max(bytes) b from m group by 1, 2), s as (select sha, max(b) b, sum(n) n, count(*) links from p group by 1)
select count(*) as blobs, sum(b)::bigint as bytes, sum(links)::bigint as links, sum(n - links)::bigint as copies_omitted from s""")
def media_rollup(spark, sf):
    return M.media_summary(_media(spark, sf), "owner", "sha", "bytes")


@query("J23", "select distinct l_suppkey from lineitem where l_quantity > 30 and l_suppkey not in (select s_suppkey from supplier where s_acctbal > 2000)")
def media_left_to_fetch(spark, sf):
    prior = table(spark, sf, "supplier").where("s_acctbal > 2000").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return M.reuse_split(table(spark, sf, "lineitem").where("l_quantity > 30"), prior, "l_suppkey")[1]


@query("K1 S18 U2", f"""with t as (select sha256(cast(json_object('p_name', p_name, 'p_partkey', p_partkey, 'p_type', p_type, 'price', cast(p_retailprice as decimal(20,2))::varchar) as varchar)) h from part)
select count(*) as written, count(*) as stored, 0::bigint as lost_or_gained, (select count(distinct p_type) from part) as folders, {DIGEST_SQL} as stored_sha256 from t""")
def sink_readback(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", F.col("p_retailprice").cast("decimal(20,2)").cast("string").alias("price"))
    path = work_dir(spark, "records")
    K.write_records(p, path, "p_type")
    stored = spark.read.schema("p_partkey long, p_name string, p_type string, price string, category_folder string").json(path)
    lost = K.read_back_diff(p, stored).agg(F.coalesce(F.sum(F.col("added") + F.col("removed")), F.lit(0)).alias("lost_or_gained"))
    found = stored.agg(F.count(F.lit(1)).alias("stored"), F.count_distinct("category_folder").alias("folders"))
    digest = K.data_digest(stored, p.columns).select(F.col("set_sha256").alias("stored_sha256"))
    return with_scalars(p.agg(F.count(F.lit(1)).alias("written")), found, lost, digest)


@query("K2 S19 V20", f"""with t as (select sha256(cast(json_object('c_custkey', c_custkey, 'c_mktsegment', c_mktsegment) as varchar)) h from customer)
select 0::bigint as problems_before, 2::bigint as problems_after, true as has_files, {DIGEST_SQL} as stored_sha256 from t""")
def manifest_verify(spark, sf):
    """A manifest holds for what was written; a file that comes later and one that is gone are found."""
    path = work_dir(spark, "bundle")
    table(spark, sf, "customer").write.option("maxRecordsPerFile", 1_000_000).parquet(f"{path}/data")
    stored_at = work_dir(spark, "manifest")
    K.file_manifest(spark, path).write.parquet(stored_at)
    stored = spark.read.parquet(stored_at)
    before = K.manifest_problems(stored, K.file_manifest(spark, path)).agg(F.count(F.lit(1)).alias("problems_before"))
    before_at = work_dir(spark, "before")
    before.write.parquet(before_at)
    table(spark, sf, "region").coalesce(1).write.parquet(f"{path}/late")
    gone = stored.limit(1).withColumn("file", F.lit("/data/gone.parquet"))
    after = K.manifest_problems(stored.unionByName(gone), K.file_manifest(spark, path)).where("file like '%.parquet'").agg(F.count(F.lit(1)).alias("problems_after"))
    digest = K.data_digest(spark.read.parquet(f"{path}/data"), ["c_custkey", "c_mktsegment"]).select(F.col("set_sha256").alias("stored_sha256"))
    return with_scalars(spark.read.parquet(before_at), after, stored.agg((F.count(F.lit(1)) > 0).alias("has_files")), digest)


@query("K3 A12", f"""with t as (select sha256(cast(json_object('o_custkey', o_custkey, 'o_orderkey', o_orderkey, 'o_orderstatus', o_orderstatus) as varchar)) h from orders)
select count(*) as rows, true as same_folder, {DIGEST_SQL} as folder_sha256 from t""")
def addressed_write(spark, sf):
    """The same rows in another order and partitioning land in the same folder and are stored once."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    root = work_dir(spark, "addressed")
    first = K.write_addressed(o, root, "orders")
    second = K.write_addressed(o.repartition(7, "o_custkey"), root, "orders")
    stored = K.data_digest(spark.read.parquet(first)).select(F.col("row_count").alias("rows"), F.col("set_sha256").alias("folder_sha256"))
    return stored.withColumn("same_folder", F.lit(first == second and first.endswith(stored.first()["folder_sha256"])))




@query("K13 K14 S14", f"""with t as (select sha256(cast(json_object('c_custkey', c_custkey, 'c_mktsegment', c_mktsegment) as varchar)) h from customer)
select count(*) as stored_rows, true as intact, 'false' as deletions, sha256(concat_ws(':', count(*)::varchar, {LIMBS})) as set_sha256 from t""")
def snapshot_verify(spark, sf):
    root = work_dir(spark, "snapshot")
    K.write_snapshot(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), root, {"deletions": "false"})
    v = K.verify_snapshot(spark, root).select("stored_rows", "intact", "set_sha256")
    flags = spark.read.schema("deletions string").json(f"{root}/manifest")
    return with_scalars(v, flags)


@query("K9 V20", f"""with n as (select sha256(cast(json_object('n_name', n_name, 'n_nationkey', n_nationkey) as varchar)) h from nation), c as (select sha256(cast(json_object('c_custkey', c_custkey, 'c_name', c_name) as varchar)) h from customer),
p as (select 'customers' part, count(*) row_count, sha256(concat_ws(':', count(*)::varchar, {LIMBS})) set_sha256 from c union all select 'nations', count(*), sha256(concat_ws(':', count(*)::varchar, {LIMBS})) from n)
select part, row_count, set_sha256, (select sha256(string_agg(part || '=' || set_sha256, chr(10) order by part)) from p) as identity from p""")
def bundle_identity(spark, sf):
    return K.bundle_identity({"nations": table(spark, sf, "nation").select("n_nationkey", "n_name"), "customers": table(spark, sf, "customer").select("c_custkey", "c_name")})


@query("J19", """select 'items' as fact, 2::bigint as distinct_values, least(a, b)::varchar as lowest, greatest(a, b)::varchar as highest from (select (select count(*) from customer) a, (select count(distinct o_custkey) from orders where o_orderstatus = 'P') b) where a <> b""")
def stage_disagreements(spark, sf):
    customers = table(spark, sf, "customer").agg(F.count(F.lit(1)).alias("items")).withColumn("snapshot", F.lit("run-1"))
    buyers = table(spark, sf, "orders").where("o_orderstatus = 'P'").agg(F.count_distinct("o_custkey").alias("items")).withColumn("snapshot", F.lit("run-1"))
    return K.stage_disagreements(customers.unionByName(buyers), ["snapshot", "items"])


def _wide_sql(width: int) -> str:
    cells = ", ".join(f"""coalesce(max(case when l_linenumber - 1 = {i} then {c}::varchar end), '') as "lines/{i}/{c}" """ for i in range(width) for c in ("l_partkey", "l_returnflag"))
    return f"select l_orderkey, {cells} from lineitem group by 1"


@query("K5", _wide_sql(7))
def wide_rows(spark, sf):
    """Every position that occurs gets its columns."""
    li = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("pos"), "l_partkey", "l_returnflag")
    return H.wide_rows(li, "l_orderkey", "pos", "lines", ["l_partkey", "l_returnflag"])


@query("K5", "select l_orderkey, (max(l_linenumber) - 1)::int as highest_position from lineitem where l_linenumber - 1 >= 5 group by 1")
def wide_row_overflow(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).cast("int").alias("pos"))
    return H.too_wide(li, "l_orderkey", "pos", 5)


@query("K5", "select n_nationkey::varchar as key, n_name as name, '' as balance from nation union all select s_suppkey::varchar, s_name, cast(s_acctbal as decimal(20,2))::varchar from supplier")
def shared_headers(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("name"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").cast("decimal(20,2)").cast("string").alias("balance"))
    return H.union_headers([n, s])


DOC_SQL = """('---' || chr(10) || 'code: ' || doc_id || chr(10) || 'lang: ' || lang || chr(10) || 'source_sha256: ' || sha256(text) || chr(10) || '---' || chr(10) || case when lang <> 'es' then '- size: ' || length(text) || chr(10) else '' end
 || '<!-- edit:name -->' || chr(10) || {name} || chr(10) || '<!-- end:name -->' || chr(10) || '<!-- edit:description -->' || chr(10) || {body} || chr(10) || '<!-- end:description -->')"""


def _documents(d, name, body):
    return H.handoff_document(
        {"code": F.col("doc_id"), "lang": F.col("lang"), "source_sha256": F.sha2("text", 256)}, {"name": name, "description": body},
        [("size", F.when(F.col("lang") != "es", F.length("text")))])


@query("K6 K15", f"select doc_id, sha256({DOC_SQL.format(name='source', body='text')}) as document_sha256 from documents")
def handoff_docs(spark, sf):
    d = texts(spark, sf)
    return d.select("doc_id", F.sha2(_documents(d, F.col("source"), F.col("text")), 256).alias("document_sha256"))


@query("S20", f"""select doc_id, doc_id::varchar as code, lang, sha256(text) as source_sha256, source as name, sha256(text) as body_sha256, sha256({DOC_SQL.format(name="''", body="''")}) as skeleton_sha256 from documents""")
def handoff_parsed(spark, sf):
    d = texts(spark, sf)
    docs = d.select("doc_id", _documents(d, F.col("source"), F.col("text")).alias("document"))
    parsed = H.parse_handoff(docs, "document", ["code", "lang", "source_sha256"])
    return parsed.withColumn("body_sha256", F.sha2("description", 256)).drop("description")


@query("V17 J25", """select doc_id, case when lang = 'de' then 'missing' when source = 'src1' then 'other-source' when lang = 'es' then 'structure-changed' when lang = 'fr' then 'not-translated' end as problem
from documents where lang in ('de', 'es', 'fr') or source = 'src1'""")
def translation_round_trip(spark, sf):
    """German documents do not come back, one source has moved on, Spanish ones lost their context line, French ones are untouched."""
    d = texts(spark, sf)
    sent = H.parse_handoff(d.select("doc_id", _documents(d, F.col("source"), F.col("text")).alias("doc")), "doc", ["source_sha256"])
    name = F.when(F.col("lang") == "fr", F.col("source")).otherwise(F.upper("source"))
    edited = _documents(d, name, F.col("text"))
    edited = F.when(F.col("lang") == "es", F.concat(edited, F.lit("\nextra"))).otherwise(edited)
    edited = F.when(F.col("source") == "src1", F.regexp_replace(edited, "source_sha256: ", "source_sha256: 0")).otherwise(edited)
    back = H.parse_handoff(d.where("lang <> 'de'").select("doc_id", edited.alias("doc")), "doc", ["source_sha256"])
    return H.translation_problems(sent, back, ["doc_id"])


@query("K7", """select p_partkey, 0 as line, 'facts' as section, '## facts' as text from part union all select p_partkey, 1, 'facts', '- brand: ' || p_brand from part
union all select p_partkey, 2, 'facts', '- size: ' || p_size from part where p_size > 10 union all select p_partkey, 3, 'prices', '## prices' from part
union all select p_partkey, 4, 'prices', '- retail: ' || cast(p_retailprice as decimal(20,2)) from part""")
def fact_sheet_lines(spark, sf):
    return H.fact_lines(table(spark, sf, "part"), "p_partkey", {
        "facts": [("brand", F.col("p_brand")), ("size", F.when(F.col("p_size") > 10, F.col("p_size")))],
        "prices": [("retail", F.col("p_retailprice").cast("decimal(20,2)"))]})


@query("J27", """with m as (select p_partkey code, case when p_size > 10 then p_size::bigint end obs from part), o as (select s_suppkey obs, s_name observed from supplier), f as (select l_suppkey obs, count(*) media_files from lineitem where l_quantity > 40 group by 1)
select m.code, m.obs, o.observed, coalesce(f.media_files, 0) as media_files, p_name as name from part join m on code = p_partkey left join o using (obs) left join f using (obs)""")
def context_join(spark, sf):
    p = table(spark, sf, "part")
    mapping = p.select(F.col("p_partkey").alias("code"), F.when(F.col("p_size") > 10, F.col("p_size").cast("long")).alias("obs"))
    observed = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("obs"), F.col("s_name").alias("observed"))
    media = table(spark, sf, "lineitem").where("l_quantity > 40").select(F.col("l_suppkey").alias("obs"))
    return H.context_join(p.select(F.col("p_partkey").alias("code"), F.col("p_name").alias("name")), mapping, observed, media, "code", "obs")


@query("S1 S21", """select case when lang = 'es' then null when lang = 'de' then '../' || doc_id else 'd' || doc_id end as slug, case when lang = 'es' then null when lang = 'fr' then '' else lang end as lang,
 case lang when 'es' then 'malformed' when 'de' then 'unsafe slug' when 'fr' then 'missing lang' end as reason, count(*) as n from documents where lang in ('es', 'de', 'fr') group by 1, 2, 3""")
def dump_bad_rows(spark, sf):
    """An NDJSON.gz dump with broken lines, unsafe keys and blank languages is read back without losing a line."""
    d = table(spark, sf, "documents")
    row = F.to_json(F.struct(
        F.when(F.col("lang") == "de", F.concat(F.lit("../"), F.col("doc_id").cast("string"))).otherwise(F.concat(F.lit("d"), F.col("doc_id").cast("string"))).alias("slug"),
        F.when(F.col("lang") == "fr", "").otherwise(F.col("lang")).alias("lang"), F.length("text").alias("size")))
    line = F.when(F.col("lang") == "es", F.concat(F.lit("{broken "), F.col("doc_id").cast("string"))).otherwise(row)
    path = work_dir(spark, "dump")
    d.select(line.alias("value")).write.option("compression", "gzip").text(path)
    dump = R.read_dump(spark, path, "slug string, lang string, size string")
    return R.bad_rows(dump, ["slug", "lang"]).groupBy("slug", "lang", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("S1", """select 'documents' as table_name, (select count(*) from documents) as rows, (select count(*) from documents) + 1 as expected_rows union all select 'extra', null, 7""")
def dump_row_counts(spark, sf):
    d = table(spark, sf, "documents")
    manifest = d.agg((F.count(F.lit(1)) + 1).alias("expected_rows")).select(F.lit("documents").alias("table_name"), "expected_rows").unionByName(
        table(spark, sf, "region").agg(F.count(F.lit(1)).alias("expected_rows")).select(F.lit("region").alias("table_name"), "expected_rows")).unionByName(
        table(spark, sf, "region").agg(F.max("r_regionkey").cast("long").alias("m")).select(F.lit("extra").alias("table_name"), (F.col("m") + 3).alias("expected_rows")))
    return R.row_count_check({"documents": d, "region": table(spark, sf, "region")}, manifest)


@query("S5 M17", "select sha256(cast(json_object('n_name', n_name, 'n_nationkey', n_nationkey, 'n_regionkey', n_regionkey) as varchar)) as payload_sha256 from nation")
def stored_payloads(spark, sf):
    """Payloads written as text files and read back whole are the payloads that were written."""
    n = table(spark, sf, "nation")
    path = work_dir(spark, "payloads")
    n.select(canonical_json(n, n.columns).alias("value")).repartition(5).write.text(path)
    whole = R.read_texts(spark, path)
    return whole.select(F.explode(F.split(F.trim("text"), "\n")).alias("payload")).where("payload <> ''").select(F.sha2("payload", 256).alias("payload_sha256"))
