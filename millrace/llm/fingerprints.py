r"""SimHash fingerprints, with DataFrame operations only.

Method: terms are pairs of neighbouring words of the lower-cased text, with what stands between them; a text of fewer
words is one term. Every occurrence of
a term votes with a weight of 1 to 4, by its length, on each of 64 bits, for or against as its hash has it; a fingerprint
has the bits with a majority. Two counters share a long, so 32 sums hold all votes, summed up by task before they are
shuffled. The search puts each fingerprint into a table for every choice of blocks that an error of the given radius
leaves alone, under these blocks' bits; fingerprints within the radius meet in one of the tables at least. It joins
distinct fingerprints, so copies do not multiply.

The next document, in descending order of ids, is found in slices of that order: a slice also gets the first document of
the next slice. Slices follow quantiles of the ids and have some thousand rows each; an id that many rows share, such as
null, has several, by text.

Defined cases: null text counts as empty; a null id counts as the least; of equal ids the larger text hash comes first;
repeated rows follow each other (rows alike in id and text stay together); one row is its own next; an empty table gives no rows; other columns are ignored,
whatever their names; texts are read whole.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BITS, LANES = 64, 32
SLICE_ROWS, QUANTILES = 4096, 256
#: Up to so many slices, their first documents are broadcast; beyond, Spark joins as it sees fit.
BROADCAST_SLICES = 1 << 20
RADIUS, BLOCKS, MOST_BLOCKS = 3, 5, 12
LEAST = -(1 << 63)


#: Two words in a row; the lookbehind keeps a long text without spaces from being tried at every place.
PAIR = r"(?<!\S)\S++\s++\S++"


def terms(text: Column) -> Column:
    low = F.lower(text)
    shifted = F.regexp_replace(low, r"\A\s*+\S++", "")
    pairs = F.concat(F.regexp_extract_all(low, F.lit(PAIR), F.lit(0)), F.regexp_extract_all(shifted, F.lit(PAIR), F.lit(0)))
    # through a lambda, so that the pairs are found once
    return F.transform(F.array(pairs), lambda p: F.when(F.size(p) > 0, p).otherwise(F.array(low)))[0]


def votes(rows: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """keys and fp, the fingerprint of the text of each row; keys tell rows apart."""
    each = rows.select(*keys, F.explode(terms(text)).alias("__t")).select(*keys, F.xxhash64("__t").alias("__h"), F.least(F.lit(4), 1 + F.floor(F.octet_length("__t") / 6)).cast("long").alias("__w"))
    pair = F.lit((1 << LANES) | 1)
    sums = [F.sum(F.shiftrightunsigned("__h", k).bitwiseAND(pair) * F.col("__w")).alias(f"__s{k}") for k in range(LANES)]
    total = each.groupBy(*keys).agg(F.sum("__w").alias("__n"), *sums)
    # a bit is set if more than half of the weight is for it
    bits = [F.when(2 * F.col(f"__s{k}").bitwiseAND(F.lit((1 << LANES) - 1)) > F.col("__n"), F.lit(1 << k)).otherwise(F.lit(0)) for k in range(LANES)]
    bits += [F.when(2 * F.shiftrightunsigned(f"__s{k}", LANES) > F.col("__n"), F.lit((1 << (k + LANES)) - (1 << 64 if k + LANES == 63 else 0))).otherwise(F.lit(0)) for k in range(LANES)]
    fp = bits[0].cast("long")
    for b in bits[1:]:
        fp = fp.bitwiseOR(b.cast("long"))
    return total.select(*keys, fp.alias("fp"))


def shown(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / BITS


def tables(fp: Column, radius: int = RADIUS, blocks: int = BLOCKS) -> Column:
    """The fingerprint's keys: (table, its bits in the blocks of that table)."""
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    out = []
    for nth, kept in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum((1 << edges[b + 1]) - (1 << edges[b]) for b in kept)
        out.append(F.struct(F.lit(nth).alias("table"), fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("bits")))
    return F.array(*out)


def blocks_for(rows: int, radius: int = RADIUS) -> int:
    """The least number of blocks whose tables have keys with a bit for each doubling of the rows: as an index grows, its
    buckets stay small and its tables become more."""
    return next((b for b in range(radius + 2, MOST_BLOCKS) if 1 << (BITS * (b - radius) // b) >= rows), MOST_BLOCKS)


def within_radius(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fp, documents) of every distinct fingerprint of the index within the radius of a distinct query; both have a column fp."""
    some = queries.select(F.col("fp").alias("query")).distinct().select("query", F.explode(tables(F.col("query"), radius, blocks)).alias("key"))
    every = index.groupBy("fp").agg(F.count("*").alias("documents")).select("fp", "documents", F.explode(tables(F.col("fp"), radius, blocks)).alias("key"))
    near = some.join(every, "key").filter(F.bit_count(F.col("query").bitwiseXOR(F.col("fp"))) <= radius)
    return near.select("query", "fp", "documents").distinct()


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, sid, tie, slice, ghost, text, next): next is the text of the next document; ghosts are copies that only serve as next."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("sid"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    marks = [k / QUANTILES for k in range(1, QUANTILES)]
    n, low, high, marked = rows.agg(F.count("*"), F.min("sid"), F.max("sid"), F.percentile_approx("sid", marks)).first()
    edges = [low or 0, *sorted(set(marked or []) - {low}), (high or 0) + 1]
    per = max(1, -(-n // (SLICE_ROWS * (len(edges) - 1))))
    if n <= SLICE_ROWS * QUANTILES:  # then fewer quantiles are enough
        step = max(1, len(edges) * SLICE_ROWS // max(n, 1))
        edges = [edges[0], *edges[1:-1:step], edges[-1]]
    # an id that is several quantiles, such as null, has slices of its own, by text: 2**parts of them
    often = {sid: n * (times + 1) // QUANTILES // SLICE_ROWS for sid, times in Counter(marked or []).items() if times > 1}
    parts = {sid: slices.bit_length() for sid, slices in often.items() if slices}
    edges = sorted({*edges, *parts, *(min(sid + 1, edges[-1]) for sid in parts)})
    most = max(per, 1 << max(parts.values(), default=0))
    starts = F.array(*(F.lit(str(e)).cast("decimal(20,0)") for e in edges[:-1]))
    widths = F.array(*(F.lit(str(max(1, -(-(b - a) // per)))).cast("decimal(20,0)") for a, b in zip(edges, edges[1:])))
    shifts = F.array(*(F.lit(BITS - parts[e] if parts.get(e) else 0) for e in edges[:-1]))
    wide = F.col("sid").cast("decimal(20,0)")
    coarse = F.size(F.filter(starts, lambda e: e <= wide))
    # within a range: by id, or by text, whose order is that of its hash without sign
    by_id = F.floor((wide - F.element_at(starts, F.col("coarse"))) / F.element_at(widths, F.col("coarse"))).cast("long")
    by_text = F.call_function("shiftrightunsigned", F.col("tie").bitwiseXOR(F.lit(LEAST)), F.col("shift"))
    fine = F.when(F.col("shift") > 0, by_text).otherwise(by_id)
    rows = rows.withColumn("coarse", coarse).withColumn("shift", F.element_at(shifts, F.col("coarse"))).withColumn("slice", F.col("coarse") * F.lit(most).cast("long") + fine).drop("coarse", "shift")
    heads = rows.groupBy("slice").agg(F.max(F.struct("sid", "tie")).alias("head"))
    up = Window.orderBy("slice")  # a row for each slice
    all_ = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(F.coalesce(F.lead("slice").over(up), F.first("slice").over(all_)).alias("to"), "head.sid", "head.tie")
    if n // SLICE_ROWS + len(edges) * most <= BROADCAST_SLICES:
        heads = F.broadcast(heads)  # a row of three numbers for each slice
    ghosts = rows.drop("slice").join(heads, ["sid", "tie"]).select("id", "sid", "text", F.col("to").alias("slice"), "tie", F.lit(True).alias("ghost"))
    both = rows.withColumn("ghost", F.lit(False)).unionByName(ghosts)
    return both.withColumn("next", F.lead("text").over(order()))


def order() -> Window:
    return Window.partitionBy("slice").orderBy("ghost", F.desc("sid"), F.desc("tie"))


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """Fingerprints of every text and its edited text, their likeness, and for ids divisible by 50 the number of other
    documents within the radius."""
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", F.length("text").cast("long")).withColumn("cut", F.floor(F.col("n_chars") / 3).cast("int"))
    kept = (F.col("n_chars") - F.col("cut")).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), kept), F.substring(F.coalesce("next", F.lit("")), F.lit(1), F.col("cut")))
    rows = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).withColumn("rid", F.monotonically_increasing_id())
    keys = ["rid", "id", "sid", "tie", "slice", "ghost", "n_chars", "edited_sha256"]
    two = rows.select(*keys, F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("text").alias("t")), F.struct(F.lit(1).alias("k"), F.col("edited").alias("t")))).alias("v")).select(*keys, "v.k", "v.t")
    voted = votes(two, [*keys, "k"], F.col("t"))
    # both fingerprints of a row in one: the votes are summed by rid already
    one = voted.groupBy(*keys).agg(F.max(F.when(F.col("k") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("k") == 1, F.col("fp"))).alias("efp"))
    # written: the search reads it three times
    out = written(one.withColumn("nfp", F.lead("fp").over(order())).filter("not ghost"), "fingerprints")
    asked = F.col("id") % 50 == 0
    near = within_radius(out.filter(asked), out, radius, blocks_for(out.count(), radius)).groupBy("query").agg((F.sum("documents") - 1).alias("n_near"))
    out = out.join(near, asked & (out["fp"] == near["query"]), "left")
    return out.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", shown(F.col("fp")).alias("fingerprint"), shown(F.col("efp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("efp")).alias("near_edited"), likeness(F.col("fp"), F.coalesce("nfp", "fp")).alias("near_next"), "n_near",
    )
