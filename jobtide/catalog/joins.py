"""Joins, duplicates and text similarity."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import normalize_url
from ..operators import dedup, joins, similarity
from ..operators.filters import with_source
from ..plans.ingest import NEAR
from . import base
from .base import companies, docs, jobs, query, sources, table, vacancies, views
from .texts import URL_BASE, URL_QUERY, sql_list

STOP_SQL = sql_list(fixed.STOP_WORDS)


@query("j1_jobs_with_source", needs="jobs sources", sql="""
select j.id, s.name as source_name, s.scraper_type as source_type from jobs j join sources s on j.source_id = s.id
""")
def j1(spark, folder):
    return with_source(jobs(spark, folder), sources(spark, folder)).select("id", "source_name", "source_type")


@query("j2_company_name_override", needs="jobs companies", sql="""
select j.id, coalesce(c.name, j.company) as company from jobs j left join (select * from companies where active) c on j.company_id = c.id
""")
def j2(spark, folder):
    return joins.jobs_with_company(jobs(spark, folder), companies(spark, folder).filter("active")).select("id", "company")


@query("j3_jobs_of_known_companies", needs="jobs companies", sql="""
select j.id, c.name as company from jobs j join companies c on j.company_id = c.id where c.active
""")
def j3(spark, folder):
    return joins.jobs_with_company(jobs(spark, folder), companies(spark, folder).filter("active"), "inner").select("id", "company")


@query("j4_hits_with_rows", needs="docs", sql="""
select d.id as doc_id, d.title, b.quality from docs d join labels b on d.id = b.doc_id
""")
def j4(spark, folder):
    hits = table(spark, folder, "labels").select("doc_id", "quality")
    return joins.matched_rows(hits, docs(spark, folder).select("id", "title")).select("doc_id", "title", "quality")


@query("j5_present_keys", needs="jobs", sql="""
select id, link from jobs where link in (select 'https://jobs.example/' || cast(l_orderkey as string) from lineitem where l_discount > 0.09)
""")
def j5(spark, folder):
    keys = table(spark, folder, "lineitem").filter("l_discount > 0.09").selectExpr(
        "'https://jobs.example/' || cast(l_orderkey as string) as link")
    return joins.present(jobs(spark, folder).select("id", "link"), keys, "link").select("id", "link")


@query("j5_absent_keys", needs="jobs", sql="""
select id, link from jobs where link not in (select 'https://jobs.example/' || cast(l_orderkey as string) from lineitem where l_quantity > 5)
""")
def j5b(spark, folder):
    keys = table(spark, folder, "lineitem").filter("l_quantity > 5").selectExpr(
        "'https://jobs.example/' || cast(l_orderkey as string) as link")
    return joins.absent(jobs(spark, folder).select("id", "link"), keys, "link").select("id", "link")


@query("j6_codes_by_alias", needs="vacancies codes", sql="""
select v.url, v.alias, k.id as code from vacancies v join codes k on v.alias = k.alias
""")
def j6(spark, folder):
    known = base.codes(spark, folder).withColumnRenamed("id", "code")
    return joins.coded(vacancies(spark, folder).select("url", "alias"), known, "alias").select("url", "alias", "code")


@query("j7_alias_resolution", needs="companies", sql="""
with asked as (select distinct old_alias as alias from companies union select alias from companies union select 'nobody'),
p as (select asked.alias, (select min(c.alias) from companies c where c.old_alias = asked.alias) as former,
  (select max(c.alias) from companies c where c.alias = asked.alias) as current from asked)
select alias, coalesce(current, former) as company_alias, case when current is null then former end as moved_to from p where current is not null or former is not null
""")
def j7(spark, folder):
    known = companies(spark, folder).withColumn("previous_aliases", F.array("old_alias"))
    asked = known.select(F.col("old_alias").alias("alias")).union(known.select("alias")).union(
        known.select(F.lit("nobody").alias("alias"))).distinct()
    return joins.resolve_aliases(asked, known)


@query("j9_followed_companies", needs="views companies", sql="""
with b as (select user_id, entity as company_id, arg_max(event_type not in ('error', 'purchase'), (ts, event_id)) as active, max(ts) as updated_at from views group by 1, 2)
select b.user_id, b.company_id, c.name, b.updated_at from b join companies c on b.company_id = c.id where b.active
""")
def j9(spark, folder):
    bridge = views(spark, folder).groupBy("user_id", F.col("entity").alias("company_id")).agg(
        F.max_by(~F.col("event_type").isin("error", "purchase"), F.struct("ts", "event_id")).alias("active"),
        F.max("ts").alias("updated_at"))
    names = companies(spark, folder).select(F.col("id").alias("company_id"), "name")
    return joins.followed_companies(bridge, names).select("user_id", "company_id", "name", "updated_at")


@query("j10_vacancy_enrichment", needs="vacancies views", sql="""
with fav as (select distinct entity from views where event_type = 'signup' and user_id = 7),
v as (select entity, count(*) as n from views where event_type in ('view', 'click') and cast(ts as date) >= date '2024-01-15' group by 1)
select w.id, f.entity is not null as favorite, coalesce(v.n, 0) as monthly_views from vacancies w
left join fav f on f.entity = w.id left join v on v.entity = w.id
""")
def j10(spark, folder):
    seen = views(spark, folder)
    favorites = seen.filter("event_type = 'signup' and user_id = 7").select(
        F.col("entity").alias("vacancy_id"), F.lit(True).alias("favorite"))
    daily = seen.filter("event_type in ('view', 'click')").groupBy(
        F.col("entity").alias("vacancy_id"), F.to_date("ts").alias("day")).agg(F.count("*").alias("views"))
    rows = vacancies(spark, folder).withColumnRenamed("id", "vacancy_id")
    out = joins.enrich_vacancies(rows, favorites, daily, date(2024, 1, 15))
    return out.select(F.col("vacancy_id").alias("id"), "favorite", "monthly_views")


# Near copies among job descriptions; equal texts count once.

CLEAN_SQL = "replace(replace(replace(replace(regexp_replace(coalesce(description, ''), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>')"
NEAR_JOBS_SQL = f"""
near_e as (select text, min(id) as id, count(*) as copies from (select id, {CLEAN_SQL} as text from ({{existing}})) where length(text) > 50 group by 1),
near_n as (select id, {CLEAN_SQL} as text from ({{new}})),
near_texts as (select 'e' as side, text, copies from near_e union all select distinct 'n', text, 0 from near_n where length(text) >= 50),
near_words as (select side, text, copies, list_filter(regexp_extract_all(strip_accents(lower(text)), '[\\p{{{{L}}}}\\p{{{{N}}}}_]{{{{2,}}}}'), lambda w: w not in ({sql_list(fixed.STOP_WORDS)})) as ws from near_texts),
near_tf as (select side, text, copies, term, count(*) as tf from (select side, text, copies, unnest(ws || list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) as term from near_words) group by all),
near_total as (select sum(copies) as n from near_e),
near_vocab as (select term, sum(copies) as df, sum(tf * copies) as uses from near_tf where side = 'e' group by 1 order by uses desc, term limit 5000),
near_raw as (select side, text, t.term, tf * (ln((1 + n) / (1 + df)) + 1) as x from near_tf t join near_vocab v on t.term = v.term, near_total),
near_vec as (select side, text, term, x / sqrt(sum(x * x) over (partition by side, text)) as w from near_raw),
near_hits as (select a.text, round(sum(a.w * b.w), 9) as s from near_vec a join near_vec b on a.term = b.term and a.side = 'n' and b.side = 'e' group by a.text, b.text),
near as (select id as duplicate_id from near_n where text in (select text from near_hits where s >= 0.75) and (select n from near_total) >= 25)
"""


# Duplicates. New rows: the later half of the jobs by date.

SPLIT = datetime(1998, 1, 1)


def _halves(spark, folder):
    rows = jobs(spark, folder)
    return rows.filter(F.col("posted_date") >= F.lit(SPLIT)), rows.filter(F.col("posted_date") < F.lit(SPLIT))


@query("d4_exact_duplicates", needs="jobs", sql=f"""
with n as (select *, {URL_BASE} || '?' || {URL_QUERY} as u from jobs where posted_date >= timestamp '1998-01-01'),
e as (select *, {URL_BASE} || '?' || {URL_QUERY} as u from jobs where posted_date < timestamp '1998-01-01'),
h as (select content_hash, max(id) as oid from e group by 1), x as (select source_id, external_id, max(id) as oid from e group by 1, 2), u as (select u, max(id) as oid from e group by 1)
select n.id as duplicate_id, coalesce(h.oid, x.oid, u.oid) as original_id, case when h.oid is not null then 'hash' when x.oid is not null then 'external_id' else 'url' end as match_type
from n left join h on n.content_hash = h.content_hash left join x on n.source_id = x.source_id and n.external_id = x.external_id left join u on n.u = u.u
where coalesce(h.oid, x.oid, u.oid) is not null
""")
def d4(spark, folder):
    new, existing = _halves(spark, folder)
    return dedup.find_exact_duplicates(new, existing).select("duplicate_id", "original_id", "match_type")


@query("d5_unique_rows", needs="jobs", sql=f"""
with n as (select *, {URL_BASE} || '?' || {URL_QUERY} as u from jobs where posted_date >= timestamp '1998-01-01'),
e as (select *, {URL_BASE} || '?' || {URL_QUERY} as u from jobs where posted_date < timestamp '1998-01-01'),
r as (select * from n where content_hash not in (select content_hash from e) and (source_id, external_id) not in (select source_id, external_id from e)
  and u not in (select u from e)), {NEAR_JOBS_SQL.format(new='select id, description from r', existing='select id, description from e').strip()}
select id, title from r where id not in (select duplicate_id from near)
""")
def d5(spark, folder):
    new, existing = _halves(spark, folder)
    unique, _ = dedup.find_all_duplicates(new, existing, **NEAR)
    return unique.select("id", "title")


@query("d8_first_per_key", needs="jobs", sql="select external_id, min(id) as id from jobs group by 1")
def d8(spark, folder):
    return dedup.first_per_key(jobs(spark, folder).select("external_id", "id"), "external_id", "id")


@query("d8_provider_clashes", needs="jobs", sql="""
select external_id, count(distinct source_id) as providers from jobs group by 1 having count(distinct source_id) > 1
""")
def d8b(spark, folder):
    return dedup.provider_clashes(jobs(spark, folder), "external_id", "source_id")


@query("d9_distinct_links", needs="vacancies", sql="select url, min(id) as id from vacancies where trim(url) <> '' group by 1")
def d9(spark, folder):
    return dedup.distinct_links(vacancies(spark, folder).select("url", "id"), "url", "id")


@query("d10_new_postings", needs="vacancies", sql="""
with recursive b as (select id, alias || '-' || language as key, url from vacancies where date >= date '1998-01-01' and alias <> ''),
s as (select distinct alias || '-' || language as key from vacancies where date < date '1998-01-01'),
r as (
  select id, key, url, false as taken from b where key not in (select key from s)
  union all
  select id, key, url, taken from (
    select id, key, url, taken, max(taken) over (partition by key) as key_taken, max(taken) over (partition by url) as url_taken
    from (select id, key, url, id = min(id) over (partition by key) and id = min(id) over (partition by url) as taken from r where not taken))
  where taken or not (key_taken or url_taken))
select id, key, url from r where taken
""")
def d10(spark, folder):
    rows = vacancies(spark, folder).select("id", F.concat_ws("-", "alias", "language").alias("key"), "url", "date")
    batch, seen = rows.filter("date >= date '1998-01-01'").drop("date"), rows.filter("date < date '1998-01-01'")
    return dedup.new_postings(batch, seen, order="id")


@query("d12_index_statistics", needs="jobs", sql=f"""
select count(distinct content_hash) as hashes, count(distinct (source_id, external_id)) as external_ids, count(distinct {URL_BASE} || '?' || {URL_QUERY}) as urls from jobs
""")
def d12(spark, folder):
    return dedup.index_statistics(jobs(spark, folder))


@query("d13_url_reuse", needs="vacancies", sql="""
with u as (select url, alias, language, count(*) as n from vacancies group by all)
select url, count(distinct alias) as companies, max(n) as most_uses, case when count(distinct alias) > 1 then 'several companies' else 'repeated' end as problem
from u group by url having count(distinct alias) > 1 or max(n) > 1
""")
def d13(spark, folder):
    return dedup.url_reuse(vacancies(spark, folder))


@query("d14_alias_agreement", needs="companies", sql="""
select case when second_alias = '' then 'empty' when id % 6 = 4 then 'different' else 'same' end as verdict, count(*) as companies
from companies where not ignore group by 1
""")
def d14(spark, folder):
    told = dedup.alias_agreement(companies(spark, folder), "alias", "second_alias")
    return told.groupBy("verdict").agg(F.count("*").alias("companies"))


@query("d15_first_per_site", sql="""
select lang, source, min(doc_id) as doc_id from documents group by 1, 2
""")
def d15(spark, folder):
    rows = table(spark, folder, "documents").select("lang", "source", "doc_id")
    return dedup.first_per_site(rows, "lang", "source", "doc_id")


@query("d15_first_page_per_url", sql=f"""
select min(page_id) as page_id, u as normal_url from (select page_id, {URL_BASE} || case when {URL_QUERY} = '' then '' else '?' || {URL_QUERY} end as u from pages) group by 2
""")
def d15b(spark, folder):
    rows = table(spark, folder, "pages").select("page_id", normalize_url("url").alias("normal_url"))
    return dedup.first_per_key(rows, "normal_url", "page_id")


# Near duplicates. New texts: documents of three sources; existing: the others.

NEW_DOCS = "source_id % 4 = 0"

TFIDF_SQL = """
with e as (select id, text from ({clean}) where not ({new}) and length(text) > {least}),
n as (select id, text from ({clean}) where {new} and length(text) >= greatest({least}, 1)),
tokens as (select 'e' as side, id, list_filter(regexp_extract_all(strip_accents(lower(text)), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda w: w not in ({stop})) as ws from e
  union all select 'n', id, list_filter(regexp_extract_all(strip_accents(lower(text)), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda w: w not in ({stop})) from n),
grams as (select side, id, unnest({grams}) as term from tokens),
tf as (select side, id, term, count(*) as tf from grams group by all),
total as (select count(*) as n from ({corpus})),
vocab as (select term, count(*) as df, sum(tf) as uses from tf where {fitted} group by term {top}),
raw as (select side, id, tf.term, tf * (ln((1 + n) / (1 + df)) + 1) as x from tf join vocab on tf.term = vocab.term, total),
vec as (select side, id, term, x / sqrt(sum(x * x) over (partition by side, id)) as w from raw),
score as (select a.id as duplicate_id, b.id as original_id, round(sum(a.w * b.w), 9) as s from vec a join vec b on a.term = b.term and a.side = 'n' and b.side = 'e' group by 1, 2)
select duplicate_id, original_id, round(s, 6) as similarity from (select *, row_number() over (partition by duplicate_id order by s desc, original_id) as rn from score) where rn = 1 and s >= {threshold}
"""


@query("d6_near_duplicates", needs="docs", sql=TFIDF_SQL.format(
    clean="select id, source_id, description as text from docs", new=NEW_DOCS, least=50, stop=STOP_SQL,
    grams="ws || list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])", corpus="select * from e",
    fitted="side = 'e'", top="order by uses desc, term limit 5000", threshold=0.75))
def d6(spark, folder):
    rows = docs(spark, folder).select("id", "source_id", "description")
    found = similarity.find_near_duplicates(rows.filter(NEW_DOCS), rows.filter(f"not ({NEW_DOCS})"),
                                            max_features=5000, min_corpus=25, min_length=50, stop_words=fixed.STOP_WORDS, strip_tags=False)
    return found.select("duplicate_id", "original_id", F.round("similarity", 6).alias("similarity"))


@query("d7_match_incoming", needs="docs", sql="with hits as (" + TFIDF_SQL.format(
    clean="select id, source_id, description as text from docs where source_id % 4 <> 0 or id not in (select doc_id from labels where toxic = 1)", new=NEW_DOCS, least=0, stop="''",
    grams="ws", corpus="select * from e union all select * from n", fitted="true", top="", threshold=0.75).strip() + """)
select duplicate_id, original_id, 'NEW_TFIDF' as match_type, similarity from hits
union all select id, null, 'EXISTING_TFIDF', 1.0 from docs where source_id % 4 = 0 and id in (select doc_id from labels where toxic = 1)
union all select id, id, 'KEY_ID', 1.0 from docs where source_id % 4 <> 0 and id in (select doc_id from labels where toxic = 1)
""")
def d7(spark, folder):
    rows = docs(spark, folder).select("id", "key_id", "source_id", "description")
    toxic = table(spark, folder, "labels").filter("toxic = 1").select(F.col("doc_id").alias("id"))
    marked = rows.join(toxic, "id", "left_semi")
    rest = rows.join(toxic, "id", "left_anti")
    again = marked.filter(f"not ({NEW_DOCS})")
    # The marked rows of the master list come again with the same key.
    master = rest.filter(f"not ({NEW_DOCS})").unionByName(again)
    incoming = rest.filter(NEW_DOCS).unionByName(again).unionByName(marked.filter(NEW_DOCS))
    found = similarity.match_incoming(master, incoming, marked.filter(NEW_DOCS).select("key_id"))
    return found.select("duplicate_id", "original_id", "match_type", F.round("similarity", 6).alias("similarity"))


@query("j11_similarity_join", sql=TFIDF_SQL.format(
    clean="select doc_id as id, 'd' as k, text from documents union all select item_id, 'b', text from benchmark", new="k = 'b'", least=0, stop="''",
    grams="ws", corpus="select * from e", fitted="side = 'e'", top="", threshold=0.3))
def j11(spark, folder):
    """Each benchmark passage with the closest document, at a low threshold."""
    items = table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")
    rows = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    found = similarity.find_near_duplicates(items, rows, threshold=0.3, max_features=None, bigrams=False, min_length=0,
                                            text="text", strip_tags=False)
    return found.select("duplicate_id", "original_id", F.round("similarity", 6).alias("similarity"))
