"""A query for each group of operators, over the driver's tables, and the same in ANSI SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import markup as M
from .functions import text as T
from .operators import catalog, corpus
from .sources.tables import table


def broken_lines(text):
    """Line ends as context breaks."""
    return F.replace(text, F.lit("\n"), F.lit(f" {T.BREAK} "))


STOPWORDS = {"de": "der, die, das, und, in, zu, den, ist, von, mit, auf, für", "en": "the, of, and, to, in, a, is", "fr": "de, la, le, et, les, des, en", "es": "de, la, que, el, en, y, a"}

# --- SQL building blocks -----------------------------------------------------------------------------------------------

_A, _X = r"[0-9\p{L}\p{Nl}]", r"[0-9\p{L}\p{Nl}''`‚‘’\-]"
_WS, _P, _E = T.WS, T.P, T.E
_BROKEN = "replace(text, chr(10), ' ' || chr(7) || ' ')"


def _tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[{_WS}]+'), lambda w: w <> '')"


def _clean(w: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({w}, '{_P}+$', ''), '{_E}+$', ''), '^{_E}+', ''), '{_P}+$', '')"


def _keeps(w: str) -> str:
    return f"(regexp_matches({w}, '^{_A}{_X}*{_A}{_X}*$') or (regexp_matches({w}, '^{_A}$') and octet_length(encode({w})) <= 2))"


def _words(text: str, stop: str = "") -> str:
    cleaned = f"list_transform({_tokens(text)}, lambda w: case when w = chr(7) then chr(10) else {_clean('w')} end)"
    kept = f"list_filter({cleaned}, lambda w: w = chr(10) or ({_keeps('w')} {stop}))"
    joined = f"regexp_replace(coalesce(array_to_string({kept}, ' '), ''), ' ?\\n ?', chr(10), 'g')"
    return f"(select case when j = '' or ends_with(j, chr(10)) then j else j || chr(10) end from (select {joined} as j))"


# --- queries -----------------------------------------------------------------------------------------------------------

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"select doc_id, {_words(_BROKEN)} as words from documents")
def text2words(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.text2words(broken_lines(F.col("text"))).alias("words"))


_STOP = "and not (" + " or ".join("coalesce(lang, '') = '%s' and w in (%s)" % (lang, ", ".join(f"'{w}'" for w in T.parse_stopwords(some))) for lang, some in STOPWORDS.items()) + ")"


@query(f"select doc_id, {_words(_BROKEN, _STOP)} as words from documents")
def text2words_stopwords(spark, sf_dir):
    text = broken_lines(F.col("text"))
    words = T.text2words(text)
    for lang, some in STOPWORDS.items():
        words = F.when(F.col("lang") == lang, T.text2words(text, T.parse_stopwords(some))).otherwise(words)
    return table(spark, sf_dir, "documents").select("doc_id", words.alias("words"))


@query(f"""
    with w as (select doc_id, {_words(_BROKEN)} as words from documents),
    l as (select doc_id, string_split(regexp_replace(words, '\\n$', ''), chr(10)) as ls from w where words <> '')
    select doc_id, cast(i - 1 as integer) as line_no, ls[i] as line, cast(case when ls[i] = '' then 0 else len(string_split(ls[i], ' ')) end as bigint) as n_tokens
    from l, unnest(range(1, len(ls) + 1)) as u(i)""")
def contexts(spark, sf_dir):
    out = corpus.to_contexts(text2words(spark, sf_dir), "doc_id")
    return out.select("doc_id", "line_no", "line", F.size("tokens").cast("long").alias("n_tokens"))


@query(f"""
    with t as (select lang, unnest({_tokens("text")}) as w from documents), c as (select lang, {_clean("w")} as w from t)
    select lang, count(*) as n_tokens, count(*) filter (where {_keeps("w")}) as n_kept from c group by lang""")
def token_keep_stats(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("lang", F.explode(T.tokens(F.col("text"))).alias("w"))
    counted = words.groupBy("lang", "w").agg(F.count("*").alias("n"))  # each distinct token is cleaned once
    kept = F.when(T.keeps(T.clean_word(F.col("w"))), F.col("n")).otherwise(0)
    return counted.groupBy("lang").agg(F.sum("n").alias("n_tokens"), F.sum(kept).alias("n_kept"))


@query(f"""
    with t as (select unnest({_tokens("text")}) as token from documents)
    select token, {_clean("token")} as cleaned, {_keeps(_clean("token"))} as kept, count(*) as n from t group by token""")
def strip_edges(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(T.tokens(F.col("text"))).alias("token"))
    counted = words.groupBy("token").agg(F.count("*").alias("n"))
    return counted.withColumn("cleaned", T.clean_word(F.col("token"))).withColumn("kept", T.keeps(F.col("cleaned"))).select("token", "cleaned", "kept", "n")


@query(f"""
    select lang, source, entity_id, words from (
      select lang, source, 'd' || doc_id as entity_id, {_words(_BROKEN)} as words from documents
      union all select 'und', role, 'c' || conv_id || '.' || turn, {_words(_BROKEN)} from conversations) where words <> ''""")
def corpus_union(spark, sf_dir):
    none = F.lit(None).cast("struct<kind string, message string, lang string>").alias("error")
    docs = table(spark, sf_dir, "documents").select("lang", "source", F.concat(F.lit("d"), "doc_id").alias("entity_id"), broken_lines(F.col("text")).alias("content"), none)
    talk = table(spark, sf_dir, "conversations").select(
        F.lit("und").alias("lang"), F.col("role").alias("source"), F.concat(F.lit("c"), "conv_id", F.lit("."), "turn").alias("entity_id"), broken_lines(F.col("text")).alias("content"), none
    )
    return corpus.to_corpus(corpus.union_all([docs, talk]))


_BOOK = "case doc_id % 4 when 0 then text || chr(10) when 1 then '*** START OF x' || chr(10) || replace(text, chr(10), chr(10) || chr(10)) when 2 then '*** START OF x -- y' || chr(10) || chr(10) || replace(replace(text, chr(10), chr(10) || chr(10)), ' the ', ' -- ') || chr(10) || 'End of the Project Gutenberg EBook' else 'a' || chr(10) || '*** START x' || chr(10) || text || chr(10) || '*** END OF it' || chr(10) end"


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumn("book", F.expr(_BOOK.replace("chr(10)", "'\\n'")))


_BODY = f"""
    b as (select *, {_BOOK} as book from documents),
    s as (select *, instr(book, '*** START') as st from b),
    r as (select *, case when st > 0 then substr(book, st) end as rest from s),
    z as (select *, instr(rest, chr(10)) as nl, substr(rest, instr(rest, chr(10))) as z0 from r),
    e as (select *, regexp_extract_all(z0, '\\n+|[^\\n]+') as parts from z),
    k as (select *, list_filter(range(1, len(parts)), lambda i: starts_with(parts[i], chr(10)) and length(parts[i]) % 2 = 0) as evens from e),
    y as (select *, case when nl > 0 then case when len(evens) >= 10 then array_to_string(parts[evens[10] + 1:], '') else z0 end end as body from k),
    p as (select *, list_min(list_filter([instr(body, chr(10) || 'End of the Project Gutenberg'), instr(body, chr(10) || 'End of this Project Gutenberg'),
      instr(body, chr(10) || 'End of the project Gutenberg'), instr(body, chr(10) || 'End of this project Gutenberg'), instr(body, chr(10) || '***END OF '), instr(body, chr(10) || '*** END OF ')], lambda q: q > 0)) as en from y)"""


@query(f"""
    with {_BODY}
    select doc_id, case when en is not null then replace(substr(body, 1, en - 1), '--', ' ') end as content,
      case when st = 0 then 'no start delimiter found' when nl = 0 then 'no newline after the start delimiter' when en is null then 'no end delimiter found' end as error from p""")
def book_bounds(spark, sf_dir):
    return _books(spark, sf_dir).select("doc_id", T.book_text(F.col("book")).alias("r")).select("doc_id", "r.content", "r.error")


@query("""
    with z as (select doc_id, chr(10) || chr(10) || replace(text, chr(10), chr(10) || chr(10)) as z from documents), p as (select *, string_split(z, chr(10) || chr(10)) as p from z)
    select doc_id, case when len(p) > 10 then array_to_string(p[11:], chr(10) || chr(10)) else z end as body from p""")
def book_skip_paragraphs(spark, sf_dir):
    body = F.concat(F.lit("\n\n"), F.replace("text", F.lit("\n"), F.lit("\n\n")))
    return table(spark, sf_dir, "documents").select("doc_id", T.skip_paragraphs(body).alias("body"))


@query(f"""
    with {_BODY}
    select lang, source, count(*) as entities_read, count(*) filter (where en is null) as erroneous from p group by lang, source""")
def run_stats(spark, sf_dir):
    books = _books(spark, sf_dir)
    return corpus.run_stats(books.select("lang", "source", T.book_text(F.col("book"))["error"].alias("error")))


@query("""
    with c as (select doc_id, case when doc_id % 7 = 0 then '#REDIRECT [[' || text || ']]' when doc_id % 11 = 0 then '' else text end as content from documents)
    select doc_id, content from c where length(content) > 0 and not starts_with(content, '#REDIRECT')""")
def redirect_filter(spark, sf_dir):
    content = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("#REDIRECT [["), "text", F.lit("]]"))).when(F.col("doc_id") % 11 == 0, "").otherwise(F.col("text"))
    pages = table(spark, sf_dir, "documents").select("doc_id", content.alias("content"))
    return pages.where((F.length("content") > 0) & ~T.is_redirect(F.col("content")))


@query("select conv_id, string_agg(text, '' order by turn) as content from conversations group by conv_id")
def newspaper_join(spark, sf_dir):
    from .sources.newspaper import page_text

    pages = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("p"))
    data = F.to_json(F.struct(F.transform("p", lambda x: x["text"]).alias("contentAsText")))
    return pages.select("conv_id", page_text(data).alias("content"))


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


_HREF = r"<a\s[^>]*href=\"([^\"]*)\"".replace('\\"', '"')


@query(f"""
    with l as (select page_id, regexp_extract_all(html, '{_HREF}', 1) as ls from pages)
    select page_id, cast(i - 1 as integer) as pos, ls[i] as link from l, unnest(range(1, len(ls) + 1)) as u(i)""")
def links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(T.links(F.col("html"))).alias("pos", "link"))


@query(f"""
    with l as (select page_id, regexp_extract_all(html, '{_HREF}', 1) as ls from pages),
    x as (select page_id, i, ls[i] as link, list_extract(string_split(ls[i], '/'), -1) as name from l, unnest(range(1, len(ls) + 1)) as u(i))
    select name, count(*) as n, count(distinct page_id) as n_pages, min(link) as least, max(link) as most, bool_or(ends_with(lower(link), '.zip')) as is_zip from x group by name""")
def link_catalog(spark, sf_dir):
    found = links(spark, sf_dir).withColumn("name", T.base_name(F.col("link")))
    zipped = F.bool_or(F.lower("link").endswith(".zip"))
    return found.groupBy("name").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("n_pages"), F.min("link").alias("least"), F.max("link").alias("most"), zipped.alias("is_zip"))


@query("""
    with c as (select doc_id, case doc_id % 5 when 0 then text || ' COPYRIGHT PROTECTED' when 1 then 'This is a' || chr(13) || ' COPYRIGHTED project ' || text when 2 then 'this' || chr(10) || 'COPYRIGHTED Project' || text else text end as content from documents)
    select doc_id, length(content) as n from c where not regexp_matches(content, 'COPYRIGHT PROTECTED') and not regexp_matches(content, '[tT]his[^\\n]*COPYRIGHTED [Pp]roject')""")
def rights_filter(spark, sf_dir):
    rest = F.col("doc_id") % 5
    content = (
        F.when(rest == 0, F.concat("text", F.lit(" COPYRIGHT PROTECTED")))
        .when(rest == 1, F.concat(F.lit("This is a\r COPYRIGHTED project "), "text"))
        .when(rest == 2, F.concat(F.lit("this\nCOPYRIGHTED Project"), "text"))
        .otherwise(F.col("text"))
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", content.alias("content"))
    return docs.where(~T.is_protected(F.col("content"))).select("doc_id", F.length("content").cast("long").alias("n"))


_CODES = "('deu'), ('eng'), ('fra'), ('spa'), ('epo'), ('xxx')"


@query(f"""
    with c(code) as (values {_CODES}), m as (select code, case code when 'deu' then 'DE' when 'eng' then 'EN' when 'fra' then 'FR' when 'spa' then 'ES' when 'epo' then 'EO' end as prefix from c),
    d as (select upper(lang) || '-' || upper(source) as lang from documents)
    select code, prefix, count(d.lang) as n from m left join d on starts_with(d.lang, m.prefix) group by code, prefix""")
def lang_prefix(spark, sf_dir):
    codes = spark.sql(f"select * from values {_CODES} as t(code)").withColumn("prefix", T.two_letter(F.col("code")))
    langs = table(spark, sf_dir, "documents").groupBy(F.concat_ws("-", F.upper("lang"), F.upper("source")).alias("lang")).agg(F.count("*").alias("c"))
    # codes is a fixed list; the counted languages are few
    hit = langs.join(F.broadcast(codes), T.speaks(F.col("lang"), F.col("prefix"))).groupBy("code").agg(F.sum("c").alias("c"))
    return codes.join(hit, "code", "left").select("code", "prefix", F.coalesce("c", F.lit(0)).cast("long").alias("n"))


_N = "text"
for _pattern, _by in ((r"[!-&(-/:-@\[-`{-~]", "''"), (r"[^\s]*[^\s\p{L}''’]", "''"), (r"(^|[^\p{L}''’])[''’]+", r"'\1'"), (r"^\s+", "''"), (r"\n\s+", "chr(10)"), (r"[ \t]+", "' '")):
    _N = f"regexp_replace({_N}, '{_pattern}', {_by}, 'g')"


@query(rf"""
    with c as (select doc_id, string_split({_N}, chr(10)) as ps from documents)
    select doc_id, array_to_string(list_transform(ps, lambda p, i: case when i < len(ps) and regexp_matches(p, '\S$') then regexp_replace(p, '\S+$', '') || lower(left(regexp_extract(p, '\S+$'), 1)) || substr(regexp_extract(p, '\S+$'), 2) else p end), chr(10)) as normalized from c""")
def normalize_parliament(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize_parliament(F.col("text")).alias("normalized"))


@query("""
    select conv_id, turn, text from (
      select *, coalesce(sum(octet_length(encode(text))) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) as before from conversations) where before < 600""")
def tmx_cap(spark, sf_dir):
    return corpus.capped(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "text", 600).select("conv_id", "turn", "text")


@query("select conv_id, turn, text from (select *, coalesce(sum(octet_length(encode(text))) over (order by conv_id * 64 + turn rows between unbounded preceding and 1 preceding), 0) as before from conversations) where before < 100000")
def one_member_cap(spark, sf_dir):
    """All turns as one member: its sizes are summed by blocks."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.lit("m").alias("member"), F.expr("conv_id * 64 + turn").alias("seg_no"))
    return corpus.capped(turns, ["member"], "seg_no", "text", 100_000).select("conv_id", "turn", "text")


@query("""
    with c as (select doc_id, source, coalesce(text, '') as t from documents), e as (select *, length(t) - length(replace(t, chr(10), '')) as ends from c),
    o as (select *, coalesce(sum(ends) over w, 0) as row, coalesce(sum(length(t)) over w, 0) as begins from e window w as (partition by source order by doc_id rows between unbounded preceding and 1 preceding)),
    l as (select *, max(case when ends > 0 then begins + length(t) - instr(reverse(t), chr(10)) + 1 end) over (partition by source order by doc_id rows between unbounded preceding and 1 preceding) as line from o)
    select doc_id, cast(row as bigint) as row, cast(begins - coalesce(line, 0) as bigint) as col from l""")
def text_positions(spark, sf_dir):
    """The texts of a source, one after the other, as one file: where each of them begins."""
    from .operators.positions import text_positions as placed

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return placed(docs, ["source"], "doc_id", "text").select("doc_id", "row", "col")


#: Lines of indexes of books, made of the documents: thirteen files, each with words before its table and after it.
_INDEX = """
    select 'i' || (10 + doc_id % 13) as path, cast(floor(doc_id / 13) as bigint) * 4 + 1 as lnum, case when doc_id % 3 = 0 then '' else ' [Subtitle: of ' || doc_id || ']' end as line from documents
    union all select 'i' || (10 + doc_id % 13), cast(floor(doc_id / 13) as bigint) * 4 + 2, case doc_id % 7 when 0 then 'no number here' when 1 then 'Title (' || source || ')' || doc_id || 'B' when 2 then doc_id || ' alone' else 'Title of ' || source || ', by N      ' || doc_id end from documents
    union all select 'i' || (10 + doc_id % 13), cast(floor(doc_id / 13) as bigint) * 4 + 3, case doc_id % 5 when 0 then 'Next of it, by M ' || (doc_id + 1000000) when 1 then ' [Subtitle: x]' when 2 then ''
      else ' [Language: ' || case lang when 'de' then 'German' when 'fr' then 'French' when 'es' then 'Spanish' else 'English' end || ']' end from documents
    union all select 'i' || (10 + doc_id % 13), cast(floor(doc_id / 13) as bigint) * 4 + 4, case doc_id % 4 when 0 then '[Language: Dutch]' when 1 then '  ' else 'Twice, by O ' || cast(floor(doc_id / 2) as bigint) || '   ' end from documents
    union all select 'i' || (10 + doc_id % 13), lnum, line from documents, (select -2 as lnum, 'After nothing, by P 99' as line union all select -1, 'TITLE and AUTHOR    ETEXT NO.' union all select 4000000000, '<==End of GUTINDEX.ALL==>' union all select 4000000001, 'Later, by Q 98') as marks where doc_id < 13"""

#: Recursive listings of folders, likewise.
_LISTING = """
    select 'l' || (10 + doc_id % 13) as path, cast(floor(doc_id / 13) as bigint) * 5 + 1 as lnum, case when doc_id % 17 = 0 then 'a.txt' else '' end as line from documents
    union all select 'l' || (10 + doc_id % 13), cast(floor(doc_id / 13) as bigint) * 5 + 2, './' || doc_id % 10 || '/' || doc_id || case when doc_id % 11 = 0 then '/old' else '' end || ':' from documents
    union all select 'l' || (10 + doc_id % 13), cast(floor(doc_id / 13) as bigint) * 5 + 3, doc_id || '.txt' from documents
    union all select 'l' || (10 + doc_id % 13), cast(floor(doc_id / 13) as bigint) * 5 + 4, case doc_id % 4 when 0 then doc_id || '-8.txt' when 1 then doc_id || '-0.txt' when 2 then 'x' || doc_id || '.txt' else doc_id || '.zip' end from documents
    union all select 'l' || (10 + doc_id % 13), cast(floor(doc_id / 13) as bigint) * 5 + 5, case when doc_id % 6 = 0 then cast(floor(doc_id / 2) as bigint) || '-8.txt' else (doc_id + 1) || '.txt  ' end from documents"""


def _lines(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace("from documents", "from {documents}"), documents=table(spark, sf_dir, "documents").select("doc_id", "lang", "source"))


_TITLE = r"^(.*?)(\s+|\)|\])(\d+)[A-Z]?$"


@query(rf"""
    with i as (select path, lnum, regexp_replace(line, '\s+$', '') as line from ({_INDEX})),
    b as (select * from i where lnum >= (select min(j.lnum) from i j where j.path = i.path and j.line like 'TITLE and AUTHOR%ETEXT NO.') and lnum < (select min(j.lnum) from i j where j.path = i.path and j.line like '<==End of GUTINDEX.ALL%')),
    g as (select *, sum(case when trim(line) = '' then 1 else 0 end) over (partition by path order by lnum) as grp, regexp_matches(line, '^[\s\[]') as attr from b),
    t as (select *, case when attr then nullif(regexp_extract(line, '\[Language: (\w+?)\]', 1), '') end as lang, not attr and regexp_matches(line, '{_TITLE}') as is_title from g where trim(line) <> ''),
    n as (select *, lead(lnum) over w as nl, lead(lang) over w as ng from t where is_title or lang is not null window w as (partition by path, grp order by lnum)),
    k as (select cast(regexp_extract(line, '{_TITLE}', 3) as bigint) as book_no, regexp_extract(line, '{_TITLE}', 1) as title, coalesce(ng, 'English') as lang, path || (10000000000 + nl) as place from n where is_title and nl is not null)
    select book_no, max_by(lang, place) as lang, max_by(title, place) as title from k where title <> '' group by book_no""")
def book_catalog(spark, sf_dir):
    return catalog.book_catalog(_lines(spark, sf_dir, _INDEX))


_FILE = r"^(\d+)(-[0-9]|-[a-z])?(\.[a-z]+)$"


@query(rf"""
    with i as (select path, lnum, regexp_replace(line, '\s+$', '') as line from ({_LISTING})),
    g as (select *, sum(case when line = '' then 1 else 0 end) over (partition by path order by lnum) as grp, case when line like './%:' then substr(line, 3, length(line) - 3) end as folder from i),
    o as (select *, sum(case when ends_with(folder, 'old') then 1 else 0 end) over (partition by path, grp order by lnum) as old from g),
    d as (select *, last_value(folder ignore nulls) over (partition by path order by lnum rows between unbounded preceding and current row) as dir from o where old = 0 and line <> ''),
    f as (select cast(regexp_extract(line, '{_FILE}', 1) as bigint) as book_no, dir || '/' || line as file, regexp_extract(line, '{_FILE}', 2) as suffix, path || (10000000000 + lnum) as place
      from d where folder is null and ends_with(line, '.txt') and regexp_matches(line, '{_FILE}'))
    select * from (select book_no, coalesce(max_by(file, place) filter (where suffix = '-8'), min_by(file, place) filter (where file is not null)) as path from f group by book_no) where path is not null""")
def file_catalog(spark, sf_dir):
    return catalog.file_catalog(_lines(spark, sf_dir, _LISTING))


@query("""
    select lang, count(*) filter (where l.doc_id is not null) as found, count(*) filter (where l.doc_id is null) as missed
    from documents d left join (select distinct doc_id from labels) l using (doc_id) group by lang""")
def availability(spark, sf_dir):
    return catalog.availability(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", "lang")


@query("select d.doc_id, lang from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def not_present(spark, sf_dir):
    have = table(spark, sf_dir, "labels").select("doc_id")
    return table(spark, sf_dir, "documents").join(have, "doc_id", "left_anti").select("doc_id", "lang")


@query(f"""
    with t as (select lang, unnest({_tokens("text")}) as word from documents)
    select lang, word, count(*) as n from t where word not in (select unnest(['the', 'of', 'de', 'la', 'und', 'en'])) group by lang, word""")
def stopword_anti_join(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("lang", F.explode(T.tokens(F.col("text"))).alias("word"))
    counted = words.groupBy("lang", "word").agg(F.count("*").alias("n"))  # before the join: fewer rows meet
    stop = spark.sql("select explode(array('the', 'of', 'de', 'la', 'und', 'en')) as word")
    return corpus.without_stopwords(counted, stop)


@query("""
    with p as (select doc_id, case doc_id % 3 when 0 then 'f/' || doc_id || ': ' || doc_id % 90 || ':' || doc_id % 7 when 1 then 'd/' || doc_id else '' end as place, case doc_id % 4 when 0 then 'IoError' when 1 then 'EncodingError' when 2 then 'InvalidLanguageError' else 'XmlParserError' end as kind from documents)
    select doc_id, place, case when kind in ('EncodingError', 'XmlParserError') then 'bad ' || kind || ': ' || place when kind = 'InvalidLanguageError' then place || ' [xx]: bad ' || kind else place || ': bad ' || kind end as shown from p""")
def error_messages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    place = F.struct(
        F.expr("case doc_id % 3 when 0 then 'file' when 1 then 'directory' else 'none' end").alias("kind"),
        F.expr("case doc_id % 3 when 0 then 'f/' when 1 then 'd/' end || doc_id").alias("path"),
        (F.col("doc_id") % 90).alias("row"), (F.col("doc_id") % 7).alias("col"),
    )
    kind = F.expr("case doc_id % 4 when 0 then 'IoError' when 1 then 'EncodingError' when 2 then 'InvalidLanguageError' else 'XmlParserError' end")
    error = F.struct(kind.alias("kind"), F.concat(F.lit("bad "), kind).alias("message"), F.lit("xx").alias("lang"))
    return docs.select("doc_id", T.position_text(place).alias("place"), T.error_text(error, place).alias("shown"))


@query("""
    with x as (select doc_id, replace(text, chr(10), chr(13) || chr(10)) as t from documents)
    select doc_id, md5(replace(t, chr(13), '')) as digest from x""")
def recode(spark, sf_dir):
    # every second document is stored as ISO-8859-1 if that holds all of its characters
    text = F.replace("text", F.lit("\n"), F.lit("\r\n"))
    fits = ~F.col("text").rlike(r"[^\x00-\x{FF}]") & (F.col("doc_id") % 2 == 1)
    data = F.when(fits, F.encode(text, "ISO-8859-1")).otherwise(F.encode(text, "UTF-8"))
    docs = table(spark, sf_dir, "documents").select("doc_id", data.alias("data"))
    return docs.select("doc_id", F.md5(F.encode(T.recoded(F.col("data")), "UTF-8")).alias("digest"))


@query()
def wiki_preprocess(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", M.wikitext(F.col("html")).alias("r")).select("page_id", "r.content", "r.error")


@query("""
    with l as (select doc_id, list_filter(string_split(text, chr(10)), lambda x: length(x) > 2) as ls from documents)
    select doc_id, coalesce(array_to_string(list_transform(ls, lambda x: x || ' ' || chr(7) || ' '), ''), '') as content from l""")
def ast_text(spark, sf_dir):
    paras = F.transform(F.filter(F.split("text", "\n", -1), lambda x: F.length(x) > 2), lambda x: F.struct(F.lit("Para").alias("t"), F.array(F.struct(F.lit("Str").alias("t"), x.alias("c"))).alias("c")))
    tree = F.to_json(F.struct(paras.alias("blocks")))
    return table(spark, sf_dir, "documents").select("doc_id", M.plain_text(tree)["content"].alias("content"))


@query()
def markdown_words(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("md", F.concat(F.lit("# Title\n\n"), F.replace("text", F.lit("\n"), F.lit("\n\n"))))
    plain = docs.select("doc_id", M.unformatted(F.col("md"), "markdown").alias("r"))
    return plain.select("doc_id", T.text2words(F.col("r.content")).alias("words"), "r.error")


_PLAIN = r"regexp_replace(text, '[<>{}|]', '', 'g')"


@query(f"""
    with t as (select doc_id, {_PLAIN} as t from documents)
    select doc_id, case doc_id % 8 when 0 then t || ' tail' when 1 then 'k ' || t || ' l' when 2 then t || chr(10) || 'after' when 5 then t || chr(10) || 'x </table> y'
      when 4 then null when 6 then 'm' || t || ' {{|n|}}' when 7 then t else t || ' 3 < 4 and 5 > 4' end as content,
      case when doc_id % 8 = 4 then 'text after opening <: ref ' || t end as error from t""")
def wiki_notes(spark, sf_dir):
    """Notes, quotations, tables at the beginning of a line and within one, signs, unclosed tags, put around every text."""
    t, nl = F.regexp_replace("text", "[<>{}|]", ""), F.lit("\n")
    forms = [
        F.concat(t, F.lit('<ref name="k">'), t, F.lit("</ref> tail")),
        F.concat(F.lit('k <blockquote class="c">'), t, F.lit("</blockquote> l")),
        F.concat(t, nl, F.lit("{| class=w"), nl, t, nl, F.lit("|}after")),
        F.concat(t, F.lit(" 3 < 4 and 5 > 4")),
        F.concat(F.lit("<ref "), t),
        F.concat(t, nl, F.lit("x </table> y")),
        F.concat(F.lit("m"), t, F.lit(" {|n|}")),
        F.concat(F.lit("<references/></references>"), t),
    ]
    markup = F.element_at(F.array(*forms), (F.col("doc_id") % 8 + 1).cast("int"))
    docs = table(spark, sf_dir, "documents").select("doc_id", markup.alias("markup"))
    return docs.select("doc_id", M.wikitext(F.col("markup")).alias("r")).select("doc_id", "r.content", "r.error")


_LETTERS = r"list_filter(list_transform(string_split(regexp_replace(text, '[^a-zA-Z\n ]', '', 'g'), chr(10)), lambda x: trim(regexp_replace(x, ' +', ' ', 'g'))), lambda x: x <> '')"
_SHOWN = f"'Title ' || chr(7) || ' ' || coalesce(array_to_string(list_transform({_LETTERS}, lambda x: x || ' ' || chr(7) || ' '), ''), '')"


def _marked(spark, sf_dir, marks, title):
    """Every line of letters in the marks of one kind of block or span, kinds in turn."""
    lines = F.filter(F.transform(F.split(F.regexp_replace("text", "[^a-zA-Z\n ]", ""), "\n", -1), lambda x: F.trim(F.regexp_replace(x, " +", " "))), lambda x: x != "")

    def mark(x, i):
        return F.concat(F.element_at(F.array(*(F.lit(a) for a, _ in marks)), (i % len(marks) + 1).cast("int")), x, F.element_at(F.array(*(F.lit(b) for _, b in marks)), (i % len(marks) + 1).cast("int")))

    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit(f"{title}\n\n"), F.array_join(F.transform(lines, mark), "\n\n")).alias("markup"))


@query(f"select doc_id, {_words(_SHOWN)} as words from documents")
def markdown_blocks(spark, sf_dir):
    marks = [("", ""), ("**", "**"), ("> ", ""), ("_", "_"), ("- ", ""), ("[", "](http://u.v/w)"), ("### ", " ###"), ("~~", "~~"), ("7. ", ""), ("", "\n\n---"), ("<b>", "</b>"), ("", " `code`"), ("", "\n\n```\ncode\n```"), ("", "\n===")]
    docs = _marked(spark, sf_dir, marks, "# Title")
    return docs.select("doc_id", M.unformatted(F.col("markup"), "markdown").alias("r")).select("doc_id", T.text2words(F.col("r.content")).alias("words"))


@query(f"select doc_id, {_words(_SHOWN)} as words from documents")
def wiki_blocks(spark, sf_dir):
    marks = [("", ""), ("'''", "'''"), ("* ", ""), ("''", "''"), ("# ", ""), ("[[target|", "]]"), ("=== ", " ==="), ("[http://u.v/w ", "]"), ("", "\n\n----"), ("{{template|x}}", ""), ("", "<ref>note</ref>"), ("<blockquote>", "</blockquote>"), ("", "[[Category:K]]"), ("", "\n\n{|\n|cell\n|}")]
    docs = _marked(spark, sf_dir, marks, "== Title ==")
    return docs.select("doc_id", M.unformatted(F.col("markup"), "mediawiki").alias("r")).select("doc_id", T.text2words(F.col("r.content")).alias("words"))


#: Trees around a string: JSON before and after it, and what is read before and after it (none: an error).
_ATTR = '["",[],[]]'
_TREES = [
    ('{"t":"Header","c":[1,%s,["ab",' % _ATTR, "]]}", "ab ", " \x07 "),
    ('{"t":"BulletList","c":[[{"t":"Plain","c":["ab"]}],[{"t":"Plain","c":["cd",', "]}]]}", "ab \x07 cd ", " \x07 "),
    ('{"t":"OrderedList","c":[[1,"",""],[[{"t":"Para","c":["ab",', "]}]]]}", "ab ", " \x07 "),
    ('{"t":"Div","c":[%s,[{"t":"Para","c":[{"t":"Emph","c":["ab"]},{"t":"Space"},' % _ATTR, "]}]]}", "ab ", " \x07 "),
    ('{"t":"Para","c":["ab",{"t":"Link","c":[%s,["cd",' % _ATTR, '],["",""]]}]}', "ab cd ", " \x07 "),
    ('{"t":"Para","c":["ab",{"t":"Image","c":[%s,["three more words",' % _ATTR, '],["",""]]},"yz"]}', "ab three more words ", " yz \x07 "),
    ('{"t":"Para","c":["ab",{"t":"Code","c":[%s,' % _ATTR, ']},"yz"]}', None, "ab yz \x07 "),
    ('{"t":"CodeBlock","c":[%s,' % _ATTR, "]}", None, ""),
    ('{"t":"Para","c":["ab",{"t":"Quoted","c":[{"t":"DoubleQuote"},["cd",', ']]},"yz"]}', "ab cd ", " \x07 yz \x07 "),
    ('{"t":"BlockQuote","c":[{"t":"Para","c":[{"t":"Strong","c":["ab"]},{"t":"SoftBreak"},', "]}]}", "ab ", " \x07 "),
    ('{"t":"Para","c":["ab",{"t":"Span","c":[%s,["cd",' % _ATTR, "]]}]}", "ab cd ", " \x07 "),
    ('{"t":"Nothing","c":[', "]}", None, None),
]


def _quoted(x: str) -> str:
    return "'" + x.replace("\x07", "' || chr(7) || '") + "'"


_TREE_TEXT = " ".join(f"when {k} then {'null' if last is None else _quoted(last) if first is None else _quoted(first) + ' || s || ' + _quoted(last)}" for k, (_, _, first, last) in enumerate(_TREES))


@query(f"""
    with t as (select doc_id, 'x' || text || 'xyz' as s from documents)
    select doc_id, case doc_id % {len(_TREES)} {_TREE_TEXT} end as content, case when doc_id % {len(_TREES)} = {len(_TREES) - 1} then 'ErroneousStructure: unknown node type: Nothing' end as error from t""")
def tree_kinds(spark, sf_dir):
    """Every text within a node of another kind."""
    whole = F.to_json(F.struct(F.concat(F.lit("x"), "text", F.lit("xyz")).alias("s")))
    text = F.expr("substring(s, 6, length(s) - 6)")  # the string of {"s":"..."}
    at = (F.col("doc_id") % len(_TREES) + 1).cast("int")
    pick = lambda n: F.element_at(F.array(*(F.lit(x[n]) for x in _TREES)), at)
    docs = table(spark, sf_dir, "documents").select("doc_id", whole.alias("s"))
    docs = docs.select("doc_id", F.concat(F.lit('{"blocks":['), pick(0), text, pick(1), F.lit("]}")).alias("tree"))
    return docs.select("doc_id", M.plain_text(F.col("tree")).alias("r")).select("doc_id", "r.content", "r.error")


#: Markup around a page, and the links that a browser finds in it ({i}: the page's number).
_FORMS = [
    ('<!-- <a href="hidden/{i}"> -->', []),
    ('<script>f("<a href=js/{i}>")</script><style><a href=css></style>', []),
    ('<a href="x{i}?a=1&amp;b=2&#38;c=&#x26;&eacute;&copy=1">', ["x{i}?a=1&b=2&c=&é&copy=1"]),
    ('<a title=it"s HREF=u/{i}&lt;>', ["u/{i}<"]),
    ('<img alt="<a href=no>"><textarea><a href=t></textarea><a/href="v {i}" title="a > b">', ["v {i}"]),
    ('<a href=one/{i} href=two/{i}></ <a href=no><p x=">"><a\thref=&NotEqualTilde;{i}&nosuch;>', ["one/{i}", "two/{i}", "\u2242\u0338{i}&nosuch;"]),
]


def _of_page(texts: list[str], shift: int) -> str:
    """SQL for the text that a page's number picks."""
    some = " ".join(f"when {k} then replace('{text}', '{{i}}', cast(page_id as varchar))" for k, text in enumerate(texts))
    return f"case (page_id + {shift}) % {len(texts)} {some} end"


def _linked(shift: int) -> str:
    """SQL for the list of a form's links, none of which has the sign that parts them."""
    joined = _of_page(["|".join(found) for _, found in _FORMS], shift)
    return f"list_filter(string_split({joined}, '|'), lambda x: x <> '')"


@query(f"""
    with l as (select page_id, {_linked(0)} || regexp_extract_all(html, '{_HREF}', 1) || {_linked(1)} as ls from pages)
    select page_id, cast(i - 1 as integer) as pos, ls[i] as link from l, unnest(range(1, len(ls) + 1)) as u(i)""")
def browser_links(spark, sf_dir):
    """Pages with comments, scripts, character references and odd quotes put around them."""
    around = [F.expr(_of_page([markup for markup, _ in _FORMS], shift).replace("varchar", "string")) for shift in (0, 1)]
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(around[0], "html", around[1]).alias("html"))
    return pages.select("page_id", F.posexplode(T.links(F.col("html"))).alias("pos", "link"))


@query("""
    with recursive n as (select page_id, regexp_replace(url, '#.*', '') as url from pages),
    e as (select distinct a.url as src, b.url as dst from n a join n b on a.page_id % 7 <> 3 and b.page_id in (2 * a.page_id + 1, 2 * a.page_id + 2, a.page_id // 3) and (b.page_id <> a.page_id // 3 or a.page_id % 5 = 0)),
    r as (select url, 0 as depth from n where page_id = 0 union select e.dst, depth + 1 from r join e on e.src = r.url where depth < 40)
    select url, cast(min(depth) as integer) as depth from r group by url""")
def reachable_pages(spark, sf_dir):
    """Pages that link to three others, by an address without a scheme, by a path with dots, and in full."""
    from .operators.crawl import link_graph, reachable

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    to = F.expr("case when page_id % 7 <> 3 then array(struct(2 * page_id + 1 as id, 1 as kind), struct(2 * page_id + 2 as id, 2 as kind), struct(if(page_id % 5 = 0, page_id div 3, -1) as id, 3 as kind)) end")
    asked = pages.select("page_id", F.explode(to).alias("to")).select("page_id", "to.*")
    target = pages.select(F.col("page_id").alias("id"), F.col("url").alias("there"))
    scheme, host, path = (F.regexp_extract("there", "^([^:]*)://([^/]*)(.*)", i) for i in (1, 2, 3))
    href = F.when(F.col("kind") == 2, F.concat(scheme, F.lit("://"), host, F.lit("/x/./../y/.."), path)).when(F.col("kind") == 1, F.concat(scheme, F.lit("://"), host, path)).otherwise(F.col("there"))
    anchor = F.concat(F.lit("<a href='"), F.replace(href, F.lit("&"), F.lit("&amp;")), F.lit("'>"))
    linked = asked.join(target, "id").groupBy("page_id").agg(F.array_join(F.collect_list(anchor), " ").alias("html"))
    made = pages.join(linked, "page_id", "left")
    return reachable(link_graph(made), pages.where("page_id = 0").select(F.regexp_replace("url", "#.*", "").alias("url")))


_UTF16 = """case doc_id % 7 when 0 then 'an odd number of bytes is no UTF-16' when 1 then 'a surrogate stands alone' when 2 then 'a surrogate stands alone' end"""


def _in_utf16(text):
    """Texts in both orders, with a mark or without; some with a byte too many or a surrogate that stands alone."""
    little, big, binary = F.encode(text, "UTF-16LE"), F.encode(text, "UTF-16BE"), lambda x: F.unhex(F.lit(x))
    kinds = [
        F.concat(little, binary("41")), F.concat(binary("FFFE"), little, binary("3DD8"), little), F.concat(binary("FEFF"), big, binary("DE00")), F.concat(binary("FFFE"), little),
        F.concat(binary("FEFF"), big), little, F.concat(binary("FFFE"), little, binary("3DD800DE")),
    ]
    return F.element_at(F.array(*kinds), (F.col("doc_id") % 7 + 1).cast("int"))


@query(f"""
    with t as (select doc_id, {_UTF16} as error, case when doc_id % 7 = 6 then text || chr(128512) else text end as text from documents)
    select doc_id, case when error is null then md5(text) end as digest, error from t""")
def utf16_texts(spark, sf_dir):
    from .functions.encoding import utf16_text

    docs = table(spark, sf_dir, "documents").select("doc_id", _in_utf16(F.col("text")).alias("data"))
    return docs.select("doc_id", utf16_text(F.col("data")).alias("u")).select("doc_id", F.md5(F.encode("u.text", "UTF-8")).alias("digest"), "u.error")


_LINES = r"list_filter(string_split(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\r]', '', 'g'), chr(10)), lambda x: x <> '')"


@query(f"""
    with t as (select doc_id, lang, {_UTF16} as error, {_LINES} as ls from documents)
    select doc_id || '.tmx' as member, cast(i - 1 as bigint) as seg_no, upper(lang) || '-01' as lang, ls[i] as text, cast(null as varchar) as error from t, unnest(range(1, len(ls) + 1)) as u(i) where error is null
    union all select doc_id || '.tmx', 0, null, null, error from t where error is not null""")
def memory_archives(spark, sf_dir):
    """Every document as a translation memory in UTF-16, in archives that are read by ranges of members."""
    from .sources.archives import memory_segments
    from .sources.scratch import new_path
    from .sources.zipped import written_archives

    docs = table(spark, sf_dir, "documents")
    escaped = F.replace(F.replace(F.regexp_replace("text", r"[\x00-\x08\x0B\x0C\x0E-\x1F\r]", ""), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    unit = lambda x: F.concat(F.lit('<tu><tuv lang="QQ-01"><seg>other</seg></tuv><tuv xml:lang="'), F.upper("lang"), F.lit('-01"><seg>'), x, F.lit("</seg></tuv></tu>"))
    units = F.array_join(F.transform(F.filter(F.split(escaped, "\n", -1), lambda x: x != ""), unit), "")
    memory = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><tmx><body>'), units, F.lit("</body></tmx>"))
    # a column of its own is made once, however often it is encoded
    rows = docs.select("doc_id", memory.alias("memory")).select(F.concat("doc_id", F.lit(".tmx")).alias("member"), _in_utf16(F.col("memory")).alias("data"))
    folder = new_path(spark, "memories")
    written_archives(rows, folder).write.format("noop").mode("overwrite").save()
    found = memory_segments(spark, folder, None).where("lang <> 'QQ-01' or error is not null")
    # a text with other signs after its end is no XML, and what comes before them is read
    return found.where("error_kind is null or error_kind <> 'XmlParserError'").select("member", F.when(F.col("error").isNull(), F.floor((F.col("seg_no") - 1) / 2)).otherwise(0).alias("seg_no"), "lang", "text", "error")


@query(f"""
    with {_BODY}
    select lang, source, count(*) as entities_read, count(*) filter (where en is null) as erroneous from p group by lang, source""")
def stream_counts(spark, sf_dir):
    """The books as a stream of several batches, some of which bring entities that were there before."""
    from . import schema
    from .sources.scratch import new_path
    from .streaming.stream import counted_stream, counts_so_far, told_apart

    read = T.book_text(F.col("book"))
    failed = F.when(read["error"].isNotNull(), F.struct(F.lit(schema.STRUCTURE).alias("kind"), read["error"].alias("message"), F.lit(None).cast("string").alias("lang")))
    rows = _books(spark, sf_dir).select("lang", "source", F.col("doc_id").cast("string").alias("entity_id"), F.lit(None).cast(schema.POSITION).alias("position"), read["content"].alias("content"), failed.alias("error"), (F.col("doc_id") % 3).alias("part"))
    folder = new_path(spark, "stream")
    for part in (0, 1, 1, 2):
        rows.where(F.col("part") == part).drop("part").write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(schema.ENTITIES).option("maxFilesPerTrigger", 2 * spark.sparkContext.defaultParallelism).parquet(f"{folder}/in")
    counted_stream(told_apart(stream), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return counts_so_far(spark, f"{folder}/out")


_LATER = "case when doc_id % 11 = 0 then text || '!' else text end"


@query(f"""
    with o as (select doc_id, md5(text) as h from documents where doc_id % 10 <> 0), n as (select doc_id, md5({_LATER}) as h from documents where doc_id % 7 <> 0)
    select coalesce(n.doc_id, o.doc_id) as doc_id, case when o.doc_id is null then 'new' when n.doc_id is null then 'removed' when o.h = n.h then 'same' else 'changed' end as status from o full join n on o.doc_id = n.doc_id""")
def snapshot_difference(spark, sf_dir):
    """Two states of the documents: some were removed, some came, some have other texts."""
    from .operators.manifest import difference, row_manifest

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    old, new = docs.where("doc_id % 10 <> 0"), docs.where("doc_id % 7 <> 0").withColumn("text", F.expr(_LATER))
    return difference(row_manifest(old, "doc_id", "text"), row_manifest(new, "doc_id", "text")).select(F.col("path").cast("long").alias("doc_id"), "status")


@query(f"""
    with r as (select doc_id, 'built: ' || text as t from documents where not (doc_id % 5 = 0 and doc_id % 3 = 0))
    select doc_id, md5(case when doc_id % 4 = 0 then t || '?' else t end) as digest from r""")
def incremental_build(spark, sf_dir):
    """A table that is built, and brought up to date after inputs came, went and changed."""
    from .operators.manifest import rebuilt, row_manifest
    from .sources.scratch import new_path

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    first = docs.where("doc_id % 5 <> 0 or doc_id % 2 = 0")
    second = docs.where("not (doc_id % 5 = 0 and doc_id % 3 = 0)").withColumn("text", F.expr("case when doc_id % 4 = 0 then text || '?' else text end"))
    folder = new_path(spark, "incremental")
    for state in (first, second):
        inputs = state.withColumn("path", F.col("doc_id").cast("string"))
        build = lambda asked, inputs=inputs: inputs.join(asked, "path", "left_semi").select("path", "doc_id", F.md5(F.encode(F.concat(F.lit("built: "), "text"), "UTF-8")).alias("digest"))
        rebuilt(spark, f"{folder}/table", f"{folder}/manifest", row_manifest(state, "doc_id", "text"), build)
    return spark.read.parquet(f"{folder}/table").select("doc_id", "digest")


_LISTED = f"(select lang, list(distinct w) as stops from (select lang, unnest({_tokens('text')}) as w from documents where doc_id % 50 = 0) where length(w) <= 5 group by lang)"


@query(f"select doc_id, {_words(_BROKEN, 'and not coalesce(list_contains(stops, w), false)')} as words from documents d left join {_LISTED} s on s.lang = d.lang")
def stopwords_as_data(spark, sf_dir):
    """Stop words of each language from a table: the short words of some documents."""
    docs = table(spark, sf_dir, "documents")
    stop = docs.where("doc_id % 50 = 0").select("lang", F.explode(T.tokens(F.col("text"))).alias("word")).where("length(word) <= 5").distinct()
    rows = docs.select("doc_id", "lang", broken_lines(F.col("text")).alias("content"))
    return corpus.stopped_words(rows, stop).select("doc_id", F.col("__words").alias("words"))


_THREE = {"de": "deu", "en": "eng", "fr": "fra", "es": "spa"}
_KINDS = ("gutenberg", "codecivil", "wikipedia", "europeana", "dgt")


@query(f"""
    with t as (select doc_id, lang, doc_id % 5 as kind, doc_id % 35 in (0, 1, 3, 4) as bad, doc_id % 35 = 2 as redirect, {_LETTERS} as ls from documents where lang in ('de', 'en', 'fr', 'es')),
    u as (select *, case when kind = 0 and len(ls) > 10 then ls[11:] else ls end as used from t where not bad and not redirect),
    s as (select lang, coalesce(array_to_string(list_transform(used, lambda x: x || ' ' || chr(7) || ' '), ''), '') as text from u),
    w as (select {_words("text", _STOP)} as words from s),
    l as (select unnest(string_split(regexp_replace(words, '\n$', ''), chr(10))) as line from w where words <> '')
    select line, count(*) as n from l group by line
    union all select 'quarantine: ' || case kind when 0 then 'gutenberg' when 1 then 'codecivil' when 3 then 'europeana' else 'dgt' end, count(*) from t where bad group by kind""")
def corpus_from_sources(spark, sf_dir):
    """The documents as books, Markdown, a dump, newspapers and translation memories of four languages, some of them broken,
    and the corpus that is built of these files by its configuration."""
    from .plans.config import LanguageConfig
    from .plans.pipeline import build
    from .sources.export import written_files
    from .sources.scratch import new_path
    from .sources.zipped import written_archives

    lines = F.filter(F.transform(F.split(F.regexp_replace("text", "[^a-zA-Z\n ]", ""), "\n", -1), lambda x: F.trim(F.regexp_replace(x, " +", " "))), lambda x: x != "")
    three = F.create_map(*(F.lit(x) for pair in _THREE.items() for x in pair))[F.col("lang")]
    docs = table(spark, sf_dir, "documents").where(F.col("lang").isin(*_THREE)).select("doc_id", three.alias("code"), F.upper("lang").alias("short"), (F.col("doc_id") % 5).alias("kind"), (F.col("doc_id") % 35).isin(0, 1, 3, 4).alias("bad"), lines.alias("ls"))
    paragraphs, raw = F.array_join("ls", "\n\n"), F.unhex(F.lit("FF"))
    utf8 = lambda x: F.encode(x, "UTF-8")
    folder = new_path(spark, "sources")
    named = lambda kind, ending: F.concat("code", F.lit(f"/{kind}/"), "doc_id", F.lit(f".{ending}"))
    book = F.concat(F.lit("*** START OF it\n"), paragraphs, F.lit("\n*** END OF it\n"))
    news = F.to_json(F.struct(F.transform("ls", lambda x: F.concat(x, F.lit(f" {T.BREAK} "))).alias("contentAsText")))
    files = docs.where("kind in (0, 1, 3)").select(
        F.when(F.col("kind") == 0, named("gutenberg", "txt")).when(F.col("kind") == 1, named("codecivil", "md")).otherwise(named("europeana", "json")).alias("name"),
        F.when(F.col("bad"), F.when(F.col("kind") == 0, utf8(paragraphs)).when(F.col("kind") == 1, raw).otherwise(utf8(F.lit("{")))).when(F.col("kind") == 0, utf8(book)).when(F.col("kind") == 1, utf8(paragraphs)).otherwise(utf8(news)).alias("data"),
    )
    written_files(files, folder).write.format("noop").mode("overwrite").save()
    text = F.concat(F.when(F.col("doc_id") % 35 == 2, "#REDIRECT [[it]]\n").otherwise(""), paragraphs)
    page = F.concat(F.lit("  <page>\n    <id>"), "doc_id", F.lit("</id>\n    <revision>\n      <text>"), text, F.lit("</text>\n    </revision>\n  </page>"))
    docs.where("kind = 2").select("code", page.alias("value")).write.partitionBy("code").text(f"{folder}/dumps")
    units = F.array_join(F.transform("ls", lambda x: F.concat(F.lit('<tu><tuv lang="'), "short", F.lit('-01"><seg>'), x, F.lit("</seg></tuv></tu>"))), "")
    memory = F.concat(F.encode(F.concat(F.lit("<tmx><body>"), units, F.lit("</body></tmx>")), "UTF-16LE"), F.when(F.col("bad"), raw).otherwise(F.unhex(F.lit(""))))
    # a folder for each language: a broken member is an error of every language that is read from its folder
    for code in _THREE.values():
        written_archives(docs.where((F.col("kind") == 4) & (F.col("code") == code)).select(F.concat("doc_id", F.lit(".tmx")).alias("member"), memory.alias("data")), f"{folder}/{code}/dgt").write.format("noop").mode("overwrite").save()
    config = {code: LanguageConfig({k: f"{folder}/dumps/code={code}" if k == "wikipedia" else f"{folder}/{code}/{k}" for k in _KINDS}, T.parse_stopwords(STOPWORDS[lang])) for lang, code in _THREE.items()}
    # strict: the exact rule runs a first paragraph of one character into the next one
    counts = build(spark, config, f"{folder}/out", strict=True)
    found = spark.read.schema("line string").text(f"{folder}/out").groupBy("line").agg(F.count("*").alias("n"))
    failed = counts.where("erroneous > 0").groupBy(F.concat(F.lit("quarantine: "), "source").alias("line")).agg(F.sum("erroneous").alias("n"))
    return found.unionByName(failed)


_ARCHIVES = "select doc_id, 'a/' || lang || '-en' || case when doc_id % 3 = 0 then '.txt' else '.tgz' end as link from documents"


@query(rf"""
    with l as ({_ARCHIVES})
    select lang, (select case when lang = 'en' then max_by(link, doc_id) else min_by(link, doc_id) end from l where case when lang = 'en' then ends_with(link, '.tgz') else contains(link, lang || '-') end) as link
    from (select distinct regexp_extract(link, '(\w\w)-\w\w\.tgz', 1) as lang from l where ends_with(link, '.tgz') union select 'en') where lang <> ''""")
def archive_links(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), F.expr("'a/' || lang || '-en' || case when doc_id % 3 = 0 then '.txt' else '.tgz' end").alias("link"))
    return catalog.archive_links(found)


@query("""
    select doc_id as book_no, lang, 'd/' || doc_id % 10 || '/' || doc_id || '.txt' as path from documents d
    where doc_id % 3 <> 0 and not exists (select 1 from labels l where l.doc_id = d.doc_id)""")
def to_fetch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    books = docs.select(F.col("doc_id").alias("book_no"), "lang")
    files = docs.where("doc_id % 3 <> 0").select(F.col("doc_id").alias("book_no"), F.expr("'d/' || doc_id % 10 || '/' || doc_id || '.txt'").alias("path"))
    present = table(spark, sf_dir, "labels").select(F.expr("doc_id || '.txt'").alias("name"))
    return catalog.to_fetch(books, files, None, present).select("book_no", "lang", "path")


@query("""
    with l as (select doc_id, case doc_id % 4 when 0 then upper(lang) || 'X/' when 1 then lang || 'x/' when 2 then 'v/' || doc_id || '.ZIP' else upper(lang) || 'Y.zip/' end as link from documents)
    select link, case when regexp_matches(link, '^[A-Z]{3}/?$') then 'folder' else 'archive' end as kind, count(*) as n from l
    where regexp_matches(link, '^[A-Z]{3}/?$') or ends_with(lower(link), '.zip') group by link""")
def crawled_links(spark, sf_dir):
    link = "case doc_id % 4 when 0 then upper(lang) || 'X/' when 1 then lang || 'x/' when 2 then 'v/' || doc_id || '.ZIP' else upper(lang) || 'Y.zip/' end"
    found = table(spark, sf_dir, "documents").select(F.expr(link).alias("link"))
    both = catalog.language_folders(found).withColumn("kind", F.lit("folder")).unionByName(catalog.zip_links(found).withColumn("kind", F.lit("archive")))
    return both.groupBy("link", "kind").agg(F.count("*").alias("n"))
