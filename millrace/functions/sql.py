"""The functions for SQL text: native ones as SQL functions, markup as Arrow-batched ones."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .html import ATTRIBUTE, C1, COMMON, HREF, HREF_VALUE, NAMES, REFERENCE, TOKEN
from .markup import RESULT, strip_wikitext, tree_text, unformat
from .text import word_steps


def register(spark: SparkSession) -> None:
    """text2words(text), is_redirect(text), links(html), html_references(value), base_name(path), strip_wikitext(text), tree_text(json) and
    unformat(text, markup), for this session."""
    words = reduce(lambda e, step: f"regexp_replace({e}, r'{step[0]}', '{step[1]}')".replace("\n", "\\n"), word_steps(), "t")
    quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    common = " ".join(f"when x = {quoted(name)} then {quoted(text)}" for name, text in COMMON.items())
    # a function of SQL text can't be called with a variable of a lambda, so its text is put in
    code = "case when lower(left(x, 3)) = '&#x' then if(length(ltrim('0', replace(substring(x, 4), ';'))) <= 8, cast(conv(replace(substring(x, 4), ';'), 16, 10) as long), 1114112) else if(length(ltrim('0', replace(substring(x, 3), ';'))) <= 9, cast(replace(substring(x, 3), ';') as long), 1114112) end"
    number = f"""transform(array({code}), n -> case when n = 0 or n > 1114111 or n between 55296 and 57343 then '\ufffd' when n between 128 and 159 then substring({quoted(C1)}, cast(n - 127 as int), 1)
      else decode(to_binary(lpad(hex(n), 8, '0'), 'hex'), 'UTF-32') end)[0]"""
    reference = f"case when x = '&' or not startswith(x, '&') then x {common} when left(x, 2) = '&#' then {number} else coalesce(try_element_at(str_to_map({quoted(NAMES)}, '\x02', '\x01'), x), x) end"
    decoded = lambda v: f"if(contains({v}, '&'), array_join(transform(regexp_extract_all({v}, r'{REFERENCE}', 0), x -> {reference}), ''), {v})"
    native = {
        "html_references(v string) returns string": decoded("v"),
        "text2words(t string) returns string": f"regexp_replace(trim({words}), r'([^\\n])\\z', '$1\\n')",
        "is_redirect(t string) returns boolean": "startswith(t, '#REDIRECT')",
        "links(t string) returns array<string>": f"""flatten(transform(filter(regexp_extract_all(t, r'{TOKEN}', 2), a -> a <> ''), a ->
          transform(filter(regexp_extract_all(a, r'{ATTRIBUTE}', 0), w -> w rlike r'{HREF}'), w -> transform(array(regexp_replace(w, r'{HREF_VALUE}', '$1$2$3')), v -> {decoded("v")})[0])))""",
        "base_name(t string) returns string": "element_at(split(t, '/'), -1)",
    }
    for name, body in native.items():
        spark.sql(f"create or replace temporary function {name} return {body}")

    def each(function, *columns):
        return pd.DataFrame([(None, None) if row[0] is None else function(*row) for row in zip(*columns)], columns=["content", "error"], dtype=object)

    @F.pandas_udf(RESULT)
    def wiki(texts: pd.Series) -> pd.DataFrame:
        return each(strip_wikitext, texts)

    @F.pandas_udf(RESULT)
    def tree(trees: pd.Series) -> pd.DataFrame:
        return each(tree_text, trees)

    @F.pandas_udf(RESULT)
    def plain(texts: pd.Series, markups: pd.Series) -> pd.DataFrame:
        return each(lambda t, m: unformat(t, m, False), texts, markups)

    for name, function in (("strip_wikitext", wiki), ("tree_text", tree), ("unformat", plain)):
        spark.udf.register(name, function)
