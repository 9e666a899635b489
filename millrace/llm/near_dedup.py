r"""Near-duplicate documents by MinHash.

Words are `[^\x20\x09-\x0D]+` with A-Z lower-cased; a document's set holds its distinct five-word shingles, or its whole
word sequence if it has fewer words. Two documents are linked if their sets' Jaccard similarity is 0.75 or more.

Method: documents with the same set make a class (128-bit digest of the set). Each class has 128 universal hash minima,
banded 32 by 4; a pair at 0.75 shares a band with a chance of 1 - 5e-6. In every band bucket one class, the center, is compared
with all others. (The center is the class that meets most others in all its buckets,
so the text that a group's copies come from, if it is there.) Components come from alternating large-star and small-star. What
these stars leave open, members of one bucket in different components, is then compared in blocks of bounded size
against all others of its bucket, so a star's miss loses no link and no task holds a whole bucket.

Verification: candidates are taken by how many minima of their signatures agree, most first, so that links are found
early; every one is then decided on the full sets, unless its components are joined by then. `agree` may be raised to
pass over pairs whose signatures agree less; by default none is.

Buckets and stars have any size: their narrow rows meet in joins against written tables, which Spark splits where a key
is skewed, and sets meet in blocks of BLOCK by BLOCK.

Defined cases: a null, empty or blank text has no set, links with nothing and is kept; a null id takes no part
(component null, kept); rows that share an id are one node; repeated rows give repeated rows; an empty table gives no
rows; other columns are ignored, whatever their names; texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import chunks, drop_written, written
from .components import components

SHINGLE = 5
BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
#: Pairs whose minima agree less are not compared: 0 compares all.
AGREE = 0.0
#: Members of a bucket that one task compares with as many others.
BLOCK = 256
#: Bytes of a shingle's hash in the sets that are moved and compared. Two of 300 shingles share a wrong one with a chance
#: of 3e-10, which changes an answer only where the similarity is within one shingle of the threshold.
WIDTH = 6
#: What a member of a group does: asks, answers, or both.
ASKS, ANSWERS = 1, 2
#: Ids that are broadcast at once, some 64 bytes each, and passes over the documents for as many each.
IDS_AT_ONCE, PASSES = 1 << 21, 4

_a = W.stream(11, MINIMA) | np.uint64(1)
_b = W.stream(12, MINIMA)
_join = W.stream(13, ROWS) | np.uint64(1)


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text."""
    hashes, offsets, *_ = W.words(texts, W.NOT_SPACE)
    grams = W.grams(hashes, SHINGLE)
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        n = end - begin
        yield np.unique(grams[begin : end - SHINGLE + 1]) if n >= SHINGLE else W.grams(hashes[begin:end], n) if n else grams[:0]


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each universal hash (a x + b mod 2**64) >> 32."""
    out = np.full(MINIMA, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(shingles), 1024):
        x = shingles[None, k : k + 1024] * _a[:, None]
        x += _b[:, None]
        np.minimum(out, (x.min(1) >> np.uint64(32)).astype(np.uint32), out=out)
    return out


def bands(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS).astype(np.uint64) * _join
    return W.mix(rows.sum(1) + W.mix(np.arange(1, BANDS + 1, dtype=np.uint64))).view(np.int64)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in chunks(batches, "text"):
        rows = []
        for s in shingle_sets(texts):
            d = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
            rows.append((len(s), int(d[0]), int(d[1]), bands(minima(s)) if len(s) else []))
        n, d0, d1, keys = zip(*rows)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(d0, pa.int64()), pa.array(d1, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "d0", "d1", "bands"])


def packed(shingles: np.ndarray) -> bytes:
    """The highest 48 bits of each hash, in six bytes."""
    return np.unique(shingles >> np.uint64(64 - 8 * WIDTH)).view(np.uint8).reshape(-1, 8)[:, :WIDTH].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // WIDTH, 8), np.uint8)
    out[:, :WIDTH] = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    return out.view(np.uint64)[:, 0]


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in chunks(batches, "text"):
        data = [packed(s) for s in shingle_sets(texts)]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(data, pa.binary())], names=["id", "data"])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach 0.75."""
    least, most = sorted((len(a), len(b)))
    if 100 * least < 75 * most:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)


def _compare(group: pa.Table) -> pa.Table:
    """Links that join different components, each component pair at most once, of asking with answering members."""
    ids, comps = (group.column(c).to_pylist() for c in ("rep", "comp"))
    role = group.column("role").to_numpy()
    sets = [unpacked(x) for x in group.column("data").to_pylist()]
    # made here again: moved with the sets, they would be a fifth of what is shuffled
    least = np.stack([minima(x) for x in sets])
    root = {c: c for c in comps}

    def find(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    left, right = [], []
    others = np.flatnonzero(role & ANSWERS)
    for q in np.flatnonzero(role & ASKS).tolist():
        agree = (least[others] == least[q]).mean(1)
        by = np.argsort(-agree, kind="stable")
        for o in others[by[agree[by] >= AGREE]].tolist():
            a, b = find(comps[q]), find(comps[o])
            if a != b and similar(sets[q], sets[o]):
                root[max(a, b)] = min(a, b)
                left.append(ids[q])
                right.append(ids[o])
    return pa.table({"u": pa.array(left, pa.int64()), "v": pa.array(right, pa.int64())})


def _blocks(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of rows (grp, role, rep, comp): those that ask and those that answer in a group meet in blocks of about
    BLOCK by BLOCK. One that does both has one row in the block where it meets itself, so a small group moves each set once."""
    plays = lambda x: F.col("role").bitwiseAND(F.lit(x)) > 0
    count = pairs.groupBy("grp").agg(*(F.ceil(F.count_if(plays(x)) / BLOCK).cast("int").alias(n) for x, n in ((ASKS, "qs"), (ANSWERS, "os"))))
    # written: at most a row for each BLOCK members, so the join is a broadcast or, by shuffled files on both sides, split where skewed
    large = written(count.filter("qs > 1 or os > 1"), "large")
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    place = lambda q, o, role: F.struct(q.alias("q"), o.alias("o"), role.alias("role"))
    none = F.array().cast("array<struct<q: int, o: int, role: int>>")
    asks = F.transform(every("os"), lambda o: place(own("qs"), o, F.when(o == own("os"), F.col("role")).otherwise(F.lit(ASKS))))
    answers = F.transform(every("qs"), lambda q: place(q, own("os"), F.lit(ANSWERS)))
    answers = F.filter(answers, lambda x: ~plays(ASKS) | (x["q"] != own("qs")))
    dealt = (
        pairs.join(large, "grp", "left").fillna(1, ["qs", "os"])
        .withColumn("at", F.explode(F.concat(F.when(plays(ASKS), asks).otherwise(none), F.when(plays(ANSWERS), answers).otherwise(none))))
        .select("grp", "at.q", "at.o", "at.role", "rep", "comp")
    )
    full = dealt.join(sets, dealt["rep"] == sets["id"]).select("grp", "q", "o", "role", "rep", "comp", "data")
    return full.groupBy("grp", "q", "o").applyInArrow(_compare, "u long, v long")


def _parts(ids: DataFrame, column: str) -> list[DataFrame]:
    """Written ids in parts of about IDS_AT_ONCE, each to be broadcast in a pass of its own; none if PASSES do not hold them."""
    n = max(1, -(-ids.count() // IDS_AT_ONCE))
    if n > PASSES:
        return []
    return [F.broadcast(ids.filter(F.pmod(F.xxhash64(column), F.lit(n)) == k) if n > 1 else ids) for k in range(n)]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; ids are whole numbers."""
    asked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    seen = written(asked.mapInArrow(_describe, "id long, n long, d0 long, d1 long, bands array<long>"), "minima")
    has_set = seen.filter("n > 0 and id is not null")
    classes = has_set.groupBy("d0", "d1").agg(F.min("id").alias("rep"))
    of_class = written(has_set.select("id", "d0", "d1").distinct().join(classes, ["d0", "d1"]).select("id", "rep"), "classes")
    sizes = written(seen.select("id", "n"), "sizes")

    first = has_set.join(classes, ["d0", "d1"]).filter("id = rep").select("rep", "n", F.explode("bands").alias("key"))
    shared = first.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most"), F.count("*").alias("size"))
    shared = written(shared.filter("least <> most").select("key", "size"), "shared")
    met = written(first.join(shared, "key").select("key", "rep", "n", "size"), "met")
    drop_written(seen, shared)
    degree = met.groupBy("rep").agg(F.sum("size").alias("degree"))
    center = met.join(degree, "rep").groupBy("key").agg(F.max(F.struct("degree", (-F.col("rep")).alias("rep"), "n")).alias("c")).select("key", (-F.col("c.rep")).alias("center"), F.col("c.n").alias("center_n"))
    center = written(center, "centers")
    member = written(met.join(center, "key").select("key", "rep", "n", "center", "center_n", "size"), "buckets")
    drop_written(met, center)

    # sizes that differ by more than 0.75 rule a link out, whatever the sets hold
    star = member.filter("rep <> center and 100 * least(n, center_n) >= 75 * greatest(n, center_n)").select("center", "rep").distinct()
    wanted = member.select(F.col("rep").alias("id")).distinct()
    wanted = written(wanted, "wanted")
    # only rows that share an id can repeat a set, so no other set is shuffled to be made distinct
    repeated = written(sizes.filter("n > 0 and id is not null").groupBy("id").agg(F.count("*").alias("rows")).filter("rows > 1").select("id"), "repeated")

    def sets_of(ids: DataFrame, repeat: bool) -> list[DataFrame]:
        found = (asked.filter("id is not null").join(some, "id", "left_semi").mapInArrow(_full_sets, "id long, data binary") for some in _parts(ids, "id") or [ids])
        return [written(x.dropDuplicates(["id", "data"]) if repeat else x, "sets") for x in found]

    if repeated.isEmpty():
        held = sets_of(wanted, False)
    else:
        once, twice = (written(wanted.join(repeated, "id", how), "wanted") for how in ("left_anti", "left_semi"))
        held = sets_of(once, False) + sets_of(twice, True)
        drop_written(once, twice)
    sets = reduce(DataFrame.unionByName, held)
    asking = star.select("center").distinct().select(F.col("center").alias("grp"), F.lit(ASKS).alias("role"), F.col("center").alias("rep"), F.col("center").alias("comp"))
    pairs = asking.unionByName(star.select(F.col("center").alias("grp"), F.lit(ANSWERS).alias("role"), "rep", F.col("rep").alias("comp")))
    links = written(_blocks(pairs, sets), "links")
    linked = components(links)

    # what the stars left open: members that are not in the component of their bucket's center
    placed = member.filter("size > 2").join(linked, F.col("rep") == F.col("node"), "left").select("key", "rep", "center", F.coalesce("component", "rep").alias("comp"))
    state = placed.groupBy("key").agg(F.max(F.when(F.col("rep") == F.col("center"), F.col("comp"))).alias("ccomp"), F.count("*").alias("n"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("sign"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    open_ = state.filter("lo <> hi").groupBy("n", "sign").agg(F.min(F.struct("key", "ccomp")).alias("k")).select("k.key", "k.ccomp")
    rest = placed.filter("rep <> center").join(open_, "key")
    rest = written(rest.select(F.col("key").alias("grp"), F.when(F.col("comp") != F.col("ccomp"), ASKS + ANSWERS).otherwise(ANSWERS).alias("role"), "rep", "comp"), "open")
    more = written(_blocks(rest, sets), "more")
    of = lambda n: linked.select(F.col("node").alias(n), F.col("component").alias(f"{n}c"))
    over = more.join(of("u"), "u", "left").join(of("v"), "v", "left").select(F.coalesce("uc", "u").alias("u"), F.coalesce("vc", "v").alias("v"))
    joined = components(over)
    top = joined.select(F.col("node").alias("comp"), F.col("component").alias("top"))

    final = of_class.join(linked, F.col("rep") == F.col("node"), "left").select("id", F.coalesce("component", "rep").alias("comp"))
    final = final.join(top, "comp", "left").groupBy("id").agg(F.min(F.coalesce("top", "comp")).alias("component"))
    out = sizes.join(final, "id", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    out = written(out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))), "near-duplicates")
    drop_written(of_class, sizes, member, wanted, repeated, *held, links, linked, rest, more, joined)
    return out


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those that near_duplicates does not keep.

    The dropped ids are broadcast, in several passes if there are many, so that no text is shuffled. Beyond PASSES, where
    that would read and write more than a shuffle does, ids and rows meet in a shuffled anti join; ids spread evenly.
    """
    found = near_duplicates(docs, id_col, text_col)
    gone = written(found.filter("not kept").select(F.col(id_col).alias("__gone")).distinct(), "dropped")
    drop_written(found)
    parts = _parts(gone, "__gone")
    if not parts:
        return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
    for k, some in enumerate(parts):
        docs = written(docs, "left") if k else docs
        docs = docs.join(some, docs[id_col] == some["__gone"], "left_anti")
    return docs
