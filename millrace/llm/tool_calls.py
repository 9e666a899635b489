r"""Tool calls of conversations: linked to their results, ordered, validated and serialised. DataFrame operations only.

Method: calls and results meet in a shuffled hash join on conversation and identifier. Every call has its place in a
topological order of what the calls of its conversation depend on: its level, the length of the longest chain of
dependencies below it. Levels come from pointer doubling: a call that waits for one other takes over what that one waits
for, so a chain is half as long after each round, and a call that waits for several has its level once these do. What
never resolves is in a cycle, or waits for one. Arguments are parsed to variants and held against the tool's fields, row
by row, nested ones too. Every record becomes canonical JSON: sorted keys, no spaces, no nulls.

Texts are written once and shuffled once; links, levels and all that decides about them are narrow. A row is one call or
one stray result, so no conversation meets in one task; of an identifier that more than HOT rows share, those that can't
link are set apart before the join.

Tables: calls (conv, id, turn, name, arguments, depends: array of ids), results (conv, id, turn, content), schemas (name,
field, type: string, integer, number, boolean, object, array or any; required; choices: an array of strings, if there are
any). A field is a path: `a.b` is in the object `a`, `a[]` is each element of the array `a`, `a[].b` a field of each; four
levels of objects are looked at, and no arrays directly within arrays. A required inner field is missing where an object that could hold it has none. Objects of which some
field is declared, and the arguments themselves, have no others. Choices hold for values of the right type.

Defined cases: a null conversation or identifier links with nothing; of several calls, or results, of one identifier
the one of the least turn links (ties: by content), the others have the status `repeated`; arguments that are no JSON
object are invalid (problem `json`); a tool without schema is invalid (`tool`); dependencies on unknown calls are left
out of the order; empty tables give no rows; other columns are ignored, whatever their names; texts are kept whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written

#: Levels of objects that are held against schemas, the arguments the first, and the innermost part of a path.
DEPTH, INNERMOST = 4, r"(?:\.[^.\[\]]+|\[\])$"
#: Rows of one identifier, above which those that can't link are set apart.
HOT = 10_000
CALLS = "conv string, id string, turn long, name string, arguments string, depends array<string>"
KIND = {"STRING": "string", "BIGINT": "integer", "DOUBLE": "number", "BOOLEAN": "boolean", "VOID": "null"}


def kind_of(value: Column) -> Column:
    """The JSON type of a variant."""
    kinds = {"OBJECT": "object", "ARRAY": "array", "DECIMAL": "number", **KIND}
    table = F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)), F.lit("null"))


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64(*edges.columns).cast("decimal(38,0)"))).first())


def levels(calls: DataFrame) -> DataFrame:
    """(conv, id, level) of calls (conv, id, depends), identifiers distinct in each conversation; null: in a cycle, or after one.

    A round touches only calls that still wait, and what was resolved in the round before: most leave after the first ones.
    """
    node = calls.select("conv", "id")
    edges = calls.select("conv", "id", F.explode(F.array_distinct("depends")).alias("on")).join(node.withColumnRenamed("id", "on"), ["conv", "on"])
    edges = written(edges.select("conv", "id", "on", F.lit(1).cast("long").alias("w")), "edges")
    waiting = edges.select("conv", "id").distinct()
    start = lambda rows: written(rows.select("conv", "id", F.lit(0).cast("long").alias("level"), F.lit(False).alias("stuck")), "levels")
    done, live = [start(node.join(waiting, ["conv", "id"], "left_anti"))], start(waiting)
    sign = _sign(edges)
    most = sign[0]  # a longer chain goes in circles
    both = [F.max("level").alias("level"), F.bool_or("stuck").alias("stuck")]
    while live.head(1):
        # what the calls resolved last add to those that wait for them
        told = done[-1].select("conv", F.col("id").alias("on"), F.col("level").alias("below"), F.col("stuck").alias("is_stuck"))
        seen = written(edges.join(told, ["conv", "on"], "left"), "folded")
        added = seen.filter("is_stuck is not null").select("conv", "id", (F.col("below") + F.col("w")).alias("level"), F.col("is_stuck").alias("stuck"))
        left = seen.filter("is_stuck is null").select("conv", "id", "on", "w")
        # for how many others each call waits now, and for which one if it is one
        waits = left.groupBy("conv", "id").agg(F.count("*").alias("n"), F.min("on").alias("next"), F.min("w").alias("more"))
        state = live.unionByName(added).unionByName(waits, allowMissingColumns=True).groupBy("conv", "id").agg(*both, F.max("n").alias("n"), F.min("next").alias("next"), F.min("more").alias("more"))
        state = written(state, "state")
        drop_written(live, edges)
        done.append(written(state.filter("n is null").select("conv", "id", "level", "stuck"), "levels"))
        # a call that waits for one which waits for one: it waits for the latter, by a longer way
        one = state.filter("n = 1").select("conv", F.col("id").alias("on"), F.col("level").alias("below"), "next", "more")
        far = F.col("w") + F.col("more")
        jumps = F.col("next").isNotNull()
        circle = (F.col("on") == F.col("id")) | jumps & ((F.col("next") == F.col("id")) | (far > most))
        moved = left.join(one, ["conv", "on"], "left").select(
            "conv", "id", F.when(circle, None).otherwise(F.coalesce("next", "on")).alias("on"), F.coalesce(far, F.col("w")).alias("w"),
            F.when(jumps, F.col("below") + F.col("w")).alias("level"), circle.alias("stuck"),
        )
        moved = written(moved, "jumps")
        edges = written(moved.filter("on is not null").groupBy("conv", "id", "on").agg(F.max("w").alias("w")), "edges")
        rest = state.filter("n is not null").select("conv", "id", "level", "stuck").unionByName(moved.filter("level is not null or stuck").select("conv", "id", "level", "stuck"))
        live = written(rest.groupBy("conv", "id").agg(*both), "levels")
        drop_written(seen, state, moved)
        last, sign = sign, _sign(edges)
        if sign == last and not done[-1].head(1):
            break  # all that is left waits for several calls in cycles
    every = live.select("conv", "id", F.lit(None).cast("int").alias("level"))
    for part in done:
        every = every.unionByName(part.select("conv", "id", F.when(~F.col("stuck"), F.col("level")).cast("int").alias("level")))
    return every


def flattened(v: Column, path: Column | None = None, depth: int = DEPTH) -> Column:
    """array<struct<path, kind, text>> of the fields of an object, and of the objects in it down to a depth: `a.b` for a
    field's field, `a[]` for each element of an array, `a[].b` for its fields. Null for what is no object."""

    def entry(x: Column, here: Column) -> Column:
        return F.array(F.struct(here.alias("path"), kind_of(x).alias("kind"), F.try_variant_get(x, "$", "string").alias("text")))

    def field(e: Column) -> Column:
        here = e["key"] if path is None else F.concat(path, F.lit("."), e["key"])
        own = entry(e["value"], here)
        if depth == 1:
            return own
        # the value itself, or the elements of an array: what may have fields
        holder = lambda at, x, inner: F.struct(at.alias("at"), x.alias("x"), F.lit(inner).alias("inner"))
        elements = F.transform(F.try_variant_get(e["value"], "$", "array<variant>"), lambda x: holder(F.concat(here, F.lit("[]")), x, True))
        holders = F.coalesce(elements, F.array(holder(here, e["value"], False)))
        none = F.array().cast("array<struct<path string, kind string, text string>>")
        deeper = lambda h: F.concat(F.when(h["inner"], entry(h["x"], h["at"])).otherwise(none), F.coalesce(flattened(h["x"], h["at"], depth - 1), none))
        return F.concat(own, F.flatten(F.transform(holders, deeper)))

    return F.flatten(F.transform(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")), field))


def problems(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """calls with problems: what is wrong with their arguments, sorted. A map over the calls, where the tools are few enough
    for Spark to broadcast them."""
    v = F.try_parse_json("text")
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    choices = F.col("choices") if "choices" in schemas.columns else F.lit(None).cast("array<string>")
    above = F.regexp_replace("field", INNERMOST, "")
    field = F.struct("field", F.when(above != F.col("field"), above).otherwise("").alias("above"), F.col("type").alias("want"), F.col("required").alias("must"), choices.alias("choices"))
    tools = schemas.groupBy("name").agg(F.collect_set(field).alias("__fields"))
    rows = calls.withColumn("__flat", F.when(is_object, flattened(v))).join(tools, "name", "left")
    at = lambda f: F.filter("__flat", lambda e: (e["path"] == f["field"]) & (e["kind"] != "null"))
    # a field of the arguments themselves has them above it, an inner one each object, or array, that can hold it
    holders = lambda f: F.when(f["above"] == "", 1).otherwise(F.size(F.filter("__flat", lambda e: (e["path"] == f["above"]) & e["kind"].isin("object", "array"))))
    lacking = lambda f: F.when(f["field"].endswith("[]"), (F.size(at(f)) == 0) & (holders(f) > 0)).otherwise(F.size(at(f)) < holders(f))
    fits = lambda f, e: (f["want"] == "any") | (f["want"] == e["kind"]) | ((f["want"] == "number") & (e["kind"] == "integer"))
    told = lambda what, fields: F.transform(fields, lambda f: F.concat(F.lit(what), f))
    names = lambda fields: F.transform(fields, lambda f: f["field"])
    # what is not declared is wrong in the arguments, and in objects of which some field is declared
    strange = F.filter(
        F.transform("__flat", lambda e: e["path"]),
        lambda p: ~p.endswith("[]") & ~F.array_contains(names(F.col("__fields")), p) & F.exists("__fields", lambda f: f["above"] == F.when(p.rlike(INNERMOST), F.regexp_replace(p, INNERMOST, "")).otherwise("")),
    )
    none_declared = ~F.exists("__fields", lambda f: f["above"] == "")
    found = F.concat(
        told("missing ", names(F.filter("__fields", lambda f: F.coalesce(f["must"], F.lit(False)) & lacking(f)))),
        told("type ", names(F.filter("__fields", lambda f: F.exists(at(f), lambda e: ~fits(f, e))))),
        told("choice ", names(F.filter("__fields", lambda f: f["choices"].isNotNull() & F.exists(at(f), lambda e: fits(f, e) & ~F.coalesce(F.array_contains(f["choices"], e["text"]), F.lit(False)))))),
        told("unknown ", F.when(none_declared, F.filter(F.transform("__flat", lambda e: e["path"]), lambda p: ~p.rlike(INNERMOST))).otherwise(strange)),
    )
    what = F.when(F.col("__fields").isNull(), F.array(F.lit("tool"))).when(F.col("__flat").isNull(), F.array(F.lit("json"))).otherwise(F.array_sort(F.array_distinct(found)))
    return rows.withColumn("problems", F.when(F.col("is_call"), what)).drop("__flat", "__fields")


def linked(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call or stray result: conv, id, turn, name, result_turn, level, status, valid, problems, json."""
    none = F.lit(None).cast("array<string>")
    c = calls.select(F.lit(True).alias("is_call"), "conv", "id", "turn", "name", F.col("arguments").alias("text"), "depends")
    r = results.select(F.lit(False).alias("is_call"), "conv", "id", "turn", F.lit(None).cast("string").alias("name"), F.col("content").alias("text"), none.alias("depends"))
    rows = problems(c, schemas).unionByName(r.withColumn("problems", none)).withColumn("tie", F.xxhash64("text"))
    # written: each row keeps its number
    rows = written(rows.withColumn("rid", F.monotonically_increasing_id()), "calls")
    has_key = rows.filter("conv is not null and id is not null")

    least = lambda of: F.min(F.when(of, F.struct("turn", "tie", "rid", "depends")))
    first = has_key.groupBy("conv", "id").agg(least(F.col("is_call")).alias("c"), least(~F.col("is_call")).alias("r"), F.count("*").alias("n"))
    first = written(first.select("conv", "id", F.col("c.rid").alias("call_rid"), F.col("c.depends").alias("depends"), F.col("r.rid").alias("result_rid"), "n"), "first")
    placed = levels(first.filter("call_rid is not null"))
    first_level = first.drop("depends", "n").join(placed, ["conv", "id"], "left")

    # at most 1 << 20 of them, whatever the table
    hot = first.filter(F.col("n") > F.lit(max(HOT, rows.count() >> 20))).select("conv", "id", F.col("call_rid").alias("hot_call"), F.col("result_rid").alias("hot_result"), F.lit(True).alias("hot"))
    marked = has_key.join(F.broadcast(hot), ["conv", "id"], "left")
    apart = F.col("hot").isNotNull() & ~F.coalesce(F.col("rid").isin(F.col("hot_call"), F.col("hot_result")), F.lit(False))
    near = marked.filter(~apart).drop("hot", "hot_call", "hot_result").join(first_level.hint("shuffle_hash"), ["conv", "id"])
    links = F.col("rid") == F.when(F.col("is_call"), F.col("call_rid")).otherwise(F.col("result_rid"))
    near = near.withColumn("links", F.coalesce(links, F.lit(False)))

    asked = lambda some: some.select("conv", "id", "turn", "name", F.col("text").alias("arguments"), "problems", F.lit(True).alias("is_call"))
    told = lambda some: some.select("conv", "id", F.col("turn").alias("result_turn"), F.col("text").alias("result"), F.lit(True).alias("is_result"))
    with_level = near.filter("links and is_call").select("conv", "id", "turn", "name", F.col("text").alias("arguments"), "problems", F.lit(True).alias("is_call"), "level")
    met = with_level.join(told(near.filter("links and not is_call")).hint("shuffle_hash"), ["conv", "id"], "full_outer").withColumn("repeated", F.lit(False))
    late = [marked.filter(apart), near.filter("not links")]
    alone = rows.filter("conv is null or id is null")
    parts = [met]
    for some, repeated in ((late[0], True), (late[1], True), (alone, False)):
        level = F.lit(None if repeated else 0).cast("int").alias("level")
        parts += [x.withColumn("repeated", F.lit(repeated)) for x in (asked(some.filter("is_call")).select("*", level), told(some.filter("not is_call")))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)

    status = (
        F.when(F.col("repeated"), "repeated").when(F.col("is_call").isNull(), "no call").when(F.col("level").isNull(), "cycle")
        .when(F.col("is_result").isNull(), "no result").otherwise("linked")
    )
    out = out.withColumn("status", status).withColumn("valid", F.when(F.col("is_call"), F.size("problems") == 0))
    given = F.when(F.col("is_call"), F.coalesce(F.try_parse_json("arguments"), F.to_variant_object(F.struct(F.col("arguments").alias("text")))))
    record = F.struct(given.alias("arguments"), F.col("conv").alias("conversation"), "id", "level", "name", "problems", "result", "result_turn", "status", "turn", "valid")
    return out.select("conv", "id", "turn", "name", "result_turn", "level", "status", "valid", "problems", F.to_json(record).alias("json"))


def embedded(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that stand as JSON in the texts of (conv, turn, role, text): {"tool_calls": [{id, name, arguments,
    depends_on}]} of an assistant, {"tool_call_id", "content"} of a tool."""
    call = "struct<id string, name string, arguments variant, depends_on array<string>>"
    asked = messages.filter("role = 'assistant'").select("conv", "turn", F.explode(F.from_json("text", f"tool_calls array<{call}>")["tool_calls"]).alias("c"))
    asked = asked.select("conv", "c.id", "turn", "c.name", F.to_json("c.arguments").alias("arguments"), F.col("c.depends_on").alias("depends"))
    told = messages.filter("role = 'tool'").select("conv", "turn", F.from_json("text", "tool_call_id string, content string").alias("r")).filter("r.tool_call_id is not null")
    return asked, told.select("conv", F.col("r.tool_call_id").alias("id"), "turn", F.col("r.content").alias("content"))


def turns_as_calls(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls, results, schemas) of plain conversations (conv, turn, role, text), which have no calls of their own.

    A user's turn calls for a reply, the assistant's next turn is the result; a system turn sets the context. So that order
    and validation have something to do, conversations are of three kinds by their number: a user's turn depends on the
    user's turn before; or on the one after; or turns wait for each other in pairs. Arguments are right or, by
    numbers of conversation and turn, lack a field, have one too many, one of another type, or are no JSON; a third of them have
an object within, with an array of objects, of which some are wrong likewise.
    """
    ident = lambda ahead: F.concat_ws(":", F.col("conv"), (F.col("turn") + ahead).cast("string"))
    number = F.try_to_number("conv", F.lit("999999999999999999")).cast("long")
    turn, kind, nth = F.col("turn"), F.pmod(number, F.lit(3)), number + F.col("turn")
    known = F.col("conv").isNotNull() & turn.isNotNull()
    on = F.when(kind == 1, ident(2)).when(kind == 2, F.when(F.pmod(turn, F.lit(4)) < 2, ident(2)).otherwise(ident(-2))).otherwise(ident(-2))
    text = F.when(F.pmod(nth, F.lit(7)) == 0, None).otherwise(F.col("text")).alias("text")
    mood = F.when(F.pmod(nth, F.lit(11)) == 0, "odd").alias("mood")
    right, other = F.to_json(F.struct(mood, text, turn)), F.to_json(F.struct(mood, text, turn.cast("string").alias("turn")))
    every = lambda n: F.pmod(nth, F.lit(n)) == 0
    lang = F.when(every(9), "5").when(every(15), '"xx"').otherwise('"en"')
    meta = F.concat(F.lit('{"meta":{'), F.when(every(21), '"extra":true,').otherwise(""), F.lit('"lang":'), lang, F.lit(',"tags":[{"k":"a","n":1},{'), F.when(every(12), "").otherwise('"k":"b",'), F.lit('"n":2}]},'))
    nested = lambda x: F.when(every(3) & (x != "{}"), F.concat(meta, F.substring(x, F.lit(2), F.length(x)))).otherwise(x)
    right, other = nested(right), nested(other)
    arguments = F.when(F.pmod(nth, F.lit(13)) == 0, F.concat(F.lit("no json: "), F.coalesce("text", F.lit("")))).when(F.pmod(nth, F.lit(5)) == 0, other).otherwise(right)
    calls = messages.filter("role in ('user', 'system')").select(
        "conv", F.when(known, ident(0)).alias("id"), "turn", F.when(F.col("role") == "user", "reply").otherwise("set_context").alias("name"),
        arguments.alias("arguments"), F.when(known & (F.col("role") == "user"), F.array(on)).alias("depends"),
    )
    results = messages.filter("role not in ('user', 'system') or role is null").select("conv", F.when(known, ident(-1)).alias("id"), "turn", F.col("text").alias("content"))
    spark = messages.sparkSession
    fields = [("text", "string", True, None), ("turn", "integer", True, None), ("meta", "object", False, None), ("meta.lang", "string", True, ["en", "de"]), ("meta.tags", "array", False, None), ("meta.tags[].k", "string", True, None), ("meta.tags[].n", "integer", False, None)]
    rows = ", ".join(f"('{tool}', '{f}', '{kind}', {str(must).lower()}, {'null' if some is None else 'array(' + ', '.join(map(repr, some)) + ')'})" for tool in ("reply", "set_context") for f, kind, must, some in fields)
    schemas = spark.sql(f"select name, field, type, required, cast(choices as array<string>) as choices from values {rows} as t(name, field, type, required, choices)")
    return calls, results, schemas


def conversation_calls(messages: DataFrame) -> DataFrame:
    """linked() over a table (conv_id, turn, role, text): its turns as calls, and the calls that stand in its texts."""
    plain = messages.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"), "role", "text")
    calls, results, schemas = turns_as_calls(plain)
    more_calls, more_results = embedded(plain.filter(F.ltrim("text").startswith("{")))
    return linked(calls.unionByName(more_calls), results.unionByName(more_results), schemas)
