"""Full-text search over the documents, by an index that is stored once per session and folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stem
from ..operators import search, text_index
from ..operators.text_index import FIELDS, TextIndex
from ..session import work_path
from . import base
from .base import heavy_docs as docs
from .base import pick, query

COMPANY = pick("id", "Engineering Data Co", "Zürich Works", "The Analyst Group", None, "Ère Labs")
LOCATION = pick("id", "Paris, France", "Für Elise 1, Köln", "Remote - US, the and the")
POSTED_SQL = "cast(date '2001-01-01' + cast(id % 300 as int) as timestamp)"
base.TABLES["corpus"] = (f"select *, {COMPANY} as company, {LOCATION} as location, {POSTED_SQL} as posted_date from "
                         f"(select {', '.join(f'{e} as {n}' for n, e in base.DOCS.items())} from documents)")
TOKENS = "regexp_extract_all(strip_accents(lower(coalesce({0}, ''))), '[\\p{{L}}\\p{{N}}]+')"
ALL_TOKENS = " || ".join(TOKENS.format(f) for f in FIELDS)
FIELD_TOKENS = " union all ".join(f"select id, '{f}' as field, {TOKENS.format(f)} as ws from corpus" for f in FIELDS)


def corpus(spark, folder):
    posted = "cast(date_add(date '2001-01-01', cast(id % 300 as int)) as timestamp)"
    return docs(spark, folder).select("id", "title", "description", "lang", F.expr(COMPANY).alias("company"), F.expr(LOCATION).alias("location"),
                                      F.expr(posted).alias("posted_date"))


_STORED: dict[tuple[str, str, bool], str] = {}


def stored_index(spark, folder: str, stemmed: bool = False) -> TextIndex:
    """The index over all four fields; queries of one session share it, as searches of one site do."""
    key = (spark.sparkContext.applicationId, folder, stemmed)
    if key not in _STORED:
        path = work_path(spark, "index")
        text_index.create(corpus(spark, folder), path, stemmed=stemmed, stamp="posted_date")
        _STORED[key] = path
    return TextIndex(spark, _STORED[key])


@query("x1_index", needs="corpus", sql=f"""
with t as ({FIELD_TOKENS}), p as (select id, field, unnest(ws) as term, generate_subscripts(ws, 1) - 1 as pos from t)
select id as doc_id, field, term, count(*) as tf, min(pos)::int as first, max(pos)::int as last from p group by 1, 2, 3
""")
def x1(spark, folder):
    return search.field_postings(stored_index(spark, folder).rows()).select(
        "doc_id", "field", "term", "tf", F.array_min("positions").alias("first"), F.array_max("positions").alias("last"))


V, C = "[aeiouy]", "[^aeiouy]"  # a y that counts as a consonant is written Y below


def stems_sql(terms: str) -> str:
    """CTEs from `terms` (a table with a column `term`) to `stems` (term, stem), after the published description of the rules."""
    some = lambda w: f"regexp_matches({w}, '{V}{C}')"
    two = lambda w: f"regexp_matches({w}, '{V}{C}.*{V}{C}')"
    short = lambda w: f"regexp_matches({w}, '{C}{V}[^aeiouywxY]$')"
    cut = lambda n, w="w": f"left({w}, length({w}) - {n})"
    ends = lambda suffix, w="w": f"ends_with({w}, '{suffix}')"

    def table(rules: dict[str, str]) -> str:
        arms = [f"when {ends(x)} then case when {some(cut(len(x)))} then {cut(len(x))} || '{y}' else w end" for x, y in sorted(rules.items(), key=lambda r: -len(r[0]))]
        return f"case {' '.join(arms)} else w end"

    fourth = [f"when {ends(x)} then case when {two(cut(len(x)))}{' and right(' + cut(3) + ', 1) in (chr(115), chr(116))' if x == 'ion' else ''} then {cut(len(x))} else w end"
              for x in sorted(stem.STEP4, key=lambda x: -len(x))]
    left = "case when ends_with(w, 'ed') then left(w, length(w) - 2) when ends_with(w, 'ing') then left(w, length(w) - 3) end"
    steps = [
        f"case when {ends('sses')} or {ends('ies')} then {cut(2)} when {ends('s')} and not {ends('ss')} then {cut(1)} else w end",
        f"case when {ends('eed')} then case when {some(cut(3))} then {cut(1)} else w end when regexp_matches({left}, '{V}') then {left} || '>' else w end",
        f"""case when not {ends('>')} then w when regexp_matches(w, '(at|bl|iz)>$') then {cut(1)} || 'e'
          when length(w) > 2 and substr(w, length(w) - 1, 1) = substr(w, length(w) - 2, 1) and regexp_matches(w, '{C}{C}>$') and not regexp_matches(w, '[lsz]>$') then {cut(2)}
          when {some(cut(1))} and not {two(cut(1))} and {short(cut(1))} then {cut(1)} || 'e' else {cut(1)} end""",
        f"case when lower(right(w, 1)) = 'y' and regexp_matches({cut(1)}, '{V}') then {cut(1)} || 'i' else w end",
        table(stem.STEP2), table(stem.STEP3), f"case {' '.join(fourth)} else w end",
        f"case when {ends('e')} and ({two(cut(1))} or ({some(cut(1))} and not {short(cut(1))})) then {cut(1)} else w end",
        f"case when {ends('ll')} and {two(cut(1))} then {cut(1)} else w end"]
    marked = f"regexp_replace(regexp_replace(term, '(^|[aeiou])y', '\\1Y', 'g'), '([^aeiouy]y)y', '\\1Y', 'g')"
    ctes = [f"stem0 as (select distinct term, {marked} as w from {terms} where regexp_matches(term, '^[a-z]{{3,}}$'))"]
    ctes += [f"stem{i} as (select term, {step} as w from stem{i - 1})" for i, step in enumerate(steps, 1)]
    ctes += [f"stems as (select term, lower(w) as stem from stem{len(steps)} union all select distinct term, term from {terms} where not regexp_matches(term, '^[a-z]{{3,}}$'))"]
    return ", ".join(ctes)


@query("x1_stemmed_index", needs="corpus", sql=f"""
with t as ({FIELD_TOKENS}), p as (select id, field, unnest(ws) as term from t), {stems_sql('p')}
select id as doc_id, field, stem as term, count(*) as tf from p join stems on p.term = stems.term group by 1, 2, 3
""")
def x1b(spark, folder):
    return search.field_postings(stored_index(spark, folder, stemmed=True).rows()).select("doc_id", "field", "term", "tf")


@query("x1_document_lengths", needs="corpus", sql=f"select id as doc_id, cast(len({ALL_TOKENS}) as bigint) as length from corpus where len({ALL_TOKENS}) > 0")
def x1c(spark, folder):
    return stored_index(spark, folder).lengths().select("doc_id", "length")


def bm25_sql(rows: str, where: str, words: tuple[str, str]) -> str:
    """Score of the rows that hold two words, by the definition."""
    return f"""
w as (select *, {ALL_TOKENS} as ws from ({rows})),
d as (select *, len(ws) as dl, len(list_filter(ws, lambda w: w = '{words[0]}')) as t0, len(list_filter(ws, lambda w: w = '{words[1]}')) as t1 from w),
s as (select count(*) as n, avg(dl) as avgdl, count(*) filter (t0 > 0) as n0, count(*) filter (t1 > 0) as n1 from d),
r as (select id as doc_id, posted_date, -(greatest(ln((n - n0 + 0.5) / (n0 + 0.5)), 1e-6) * (t0 * 2.2) / (t0 + 1.2 * (0.25 + 0.75 * dl / avgdl))
  + greatest(ln((n - n1 + 0.5) / (n1 + 0.5)), 1e-6) * (t1 * 2.2) / (t1 + 1.2 * (0.25 + 0.75 * dl / avgdl))) as rank from d, s where t0 > 0 and t1 > 0 {where})
"""


BEST_SQL = "select doc_id, round(rank, 6) as rank from r order by r.rank, posted_date desc, doc_id limit 50"


@query("x2_ranked_search", needs="corpus", sql=f"with {bm25_sql('select * from corpus', '', ('data', 'the')).strip()} {BEST_SQL}")
def x2(spark, folder):
    return stored_index(spark, folder).best("data the", 50).select("doc_id", F.round("rank", 6).alias("rank"))


@query("x7_filtered_search", needs="corpus", sql=f"""with {bm25_sql('select * from corpus', "and lang = 'en'", ('data', 'the')).strip()} {BEST_SQL}""")
def x7(spark, folder):
    inside = corpus(spark, folder).filter("lang = 'en'")
    return stored_index(spark, folder).best("data the", 50, inside=inside).select("doc_id", F.round("rank", 6).alias("rank"))


@query("x3_boolean_search", needs="corpus", sql=f"""
select id as doc_id from (select id, {ALL_TOKENS} as ws from corpus) where list_contains(ws, 'data') and (list_contains(ws, 'the') or list_contains(ws, 'der')) and not list_contains(ws, 'analyst')
""")
def x3(spark, folder):
    return stored_index(spark, folder).having(every=["data"], some=["the", "der"], none=["analyst"])


@query("x3_grouped_search", needs="corpus", sql=f"""
select id as doc_id from (select id, {ALL_TOKENS} as ws from corpus) where list_has_any(ws, ['data', 'platform']) and list_has_any(ws, ['senior', 'intern']) and not list_contains(ws, 'works')
""")
def x3b(spark, folder):
    return stored_index(spark, folder).having(groups=[["data", "platform"], ["senior", "intern"]], none=["works"])


@query("x4_phrase_search", needs="corpus", sql=f"""
select distinct id as doc_id from ({FIELD_TOKENS}) where contains(' ' || array_to_string(ws, ' ') || ' ', ' data engineer ')
""")
def x4(spark, folder):
    return stored_index(spark, folder).phrase("Data Engineer")


@query("x4_repeating_phrase", needs="corpus", sql=f"""
select distinct id as doc_id from ({FIELD_TOKENS}) where contains(' ' || array_to_string(ws, ' ') || ' ', ' the and the ')
""")
def x4c(spark, folder):
    return stored_index(spark, folder).phrase("the and the")


@query("x4_near_search", needs="corpus", sql=f"""
with p as (select id, field, unnest(ws) as term, generate_subscripts(ws, 1) as pos from ({FIELD_TOKENS})),
a as (select * from p where term = 'the'), b as (select * from p where term = 'and')
select distinct a.id as doc_id from a join b on a.id = b.id and a.field = b.field and abs(a.pos - b.pos) between 1 and 4
""")
def x4b(spark, folder):
    return stored_index(spark, folder).near("the", "and", distance=3)


@query("x5_field_search", needs="corpus", sql="select id as doc_id from corpus where title like '%Engineer%'")
def x5(spark, folder):
    return stored_index(spark, folder).in_field("title", "engineer")


@query("x5_accents_and_case", needs="corpus", sql=f"""
select id as doc_id from (select id, {ALL_TOKENS} as ws from corpus) where list_contains(ws, 'fur') or list_contains(ws, 'ere')
""")
def x5b(spark, folder):
    return stored_index(spark, folder).having(some=["FÜR", "ÈRE"])


@query("x6_substring_search", needs="docs", sql="""
select id from docs where (title ilike '%data%' or description ilike '%data%') and (title ilike '%eng%' or description ilike '%eng%')
""")
def x6(spark, folder):
    return search.substring_search(corpus(spark, folder), "data eng", ("title", "description")).select("id")


@query("x8_stemmed_all_terms", needs="corpus", sql=f"""
select id, title from corpus where list_has_any({ALL_TOKENS}, ['engine', 'engines', 'engineer', 'engineers', 'engineered', 'engineering'])
  and list_has_any({ALL_TOKENS}, ['data', 'datas']) order by posted_date desc, id desc limit 100
""")
def x8(spark, folder):
    index = stored_index(spark, folder, stemmed=True)
    rows = corpus(spark, folder).withColumnRenamed("posted_date", "last_seen_at")
    return search.all_terms_search(index.rows(index.terms("engineers data")), rows, index.terms("engineers data"), 100).select("id", "title")


# A stored index that follows its table.

CHANGED_SQL = "select id, case when id % 3 = 0 then 'Platform Data Engineer' else title end as title, description, company, location, posted_date from corpus where id % 30 <> 2"


def _followed(spark, folder) -> TextIndex:
    """An index of two thirds of the rows that then takes in the others, new titles of a third and removals."""
    rows = corpus(spark, folder).select("id", "posted_date", *FIELDS)
    index = text_index.create(rows.filter("id % 3 <> 1"), work_path(spark, "index"), stemmed=False, stamp="posted_date")
    changed = rows.filter("id % 3 = 0").withColumn("title", F.lit("Platform Data Engineer"))
    index = text_index.update(index, rows.filter("id % 3 = 1"))
    return text_index.update(index, changed.filter("id % 30 <> 2"), removed=rows.filter("id % 30 = 2").select("id"))


@query("x1_changed_rows", needs="corpus", sql=f"with {bm25_sql(CHANGED_SQL, '', ('platform', 'data')).strip()} select doc_id, round(rank, 6) + 0.0 as rank from r")
def x1d(spark, folder):
    return _followed(spark, folder).ranked("platform data").select("doc_id", (F.round("rank", 6) + 0.0).alias("rank"))


@query("x1_merged_segments", needs="corpus", sql=f"""
with t as (select id, unnest({ALL_TOKENS}) as term from ({CHANGED_SQL})), p as (select id, term, count(*) as tf from t group by 1, 2)
select term, count(*) as docs, cast(sum(tf) as bigint) as uses from p group by 1
""")
def x1e(spark, folder):
    merged = text_index.merge(_followed(spark, folder))
    return merged.rows().groupBy("term").agg(F.count("*").alias("docs"), F.sum("tf").alias("uses"))
