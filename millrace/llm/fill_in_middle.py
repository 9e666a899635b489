r"""Fill-in-middle examples: a text is cut in three at token bounds, and its middle goes to the end.

Method: parallel automaton scan. A token is white space and the word after it, or white space at the end. Blocks of
bytes emit the transition function of an automaton that knows white space, words and the three marks, with what each
state of entry counts; functions compose to those of texts, whose entry states they resolve, and the two cuts are
selected from the counts. Texts above `giant` bytes are dealt to tasks in slices: each slice emits its function, the
functions of a text (some numbers for each slice) compose in order, and only the slices that hold a cut are asked for
its place. Everything else is column expressions; only those texts are shuffled.

Defined cases: null text counts as empty, and that is plain; a null id is hashed as an empty string; rows with equal id
and text have equal results, and there are no ties; an empty table gives no rows; other columns pass through untouched,
but those called like the added ones are replaced; texts are cut whole, however long. A text that holds a mark
stays plain, so that every output can be undone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .automaton import WIDTH, Automaton

MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
SEED = 42
#: Bytes of a text that one task scans by itself, of a slice of a longer one, and of the texts that are scanned at once.
GIANT, SLICE, AT_ONCE = 1 << 23, 1 << 22, 1 << 20
#: A mark counts this much, a token one.
MARK = 1 << 32

_START, _SPACE, _WORD, _OPEN, _NAMED = range(5)


def tokens_and_marks() -> Automaton:
    classes = np.full(256, 4)
    classes[[0x20, *range(0x09, 0x0E)]] = 0
    classes[ord("<")] = 1
    classes[[ord(m[1]) for m in MARKS.values()]] = 2
    classes[ord(">")] = 3
    step = np.full((5, 5), _WORD)
    step[:, 0], step[:, 1] = _SPACE, _OPEN
    step[_OPEN, 2] = _NAMED
    emit = np.zeros((5, 5), np.int64)
    emit[_START] = 1
    emit[[_WORD, _OPEN, _NAMED], 0] = 1
    emit[_NAMED, 3] = MARK
    return Automaton(classes, step, emit)


AUTOMATON = tokens_and_marks()


def _characters(data: np.ndarray) -> np.ndarray:
    """How many code points begin before each byte, and in all."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def cuts(texts: list[bytes], first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, marks, code points of the prefix, of the middle) of each text; first and second: its two random numbers."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    blocks, many = AUTOMATON.blocks(data, lengths)
    begin = np.cumsum(many) - many
    left, counted = AUTOMATON.composed(*AUTOMATON.functions(blocks), np.repeat(begin, many))
    some = many > 0
    total = np.zeros(len(texts), np.int64)
    total[some] = counted[(begin + many - 1)[some], 0]
    tokens, marks = total % MARK, total // MARK
    at = np.sort(np.stack([first % (tokens + 1), second % (tokens + 1)]), 0)
    starts = np.cumsum(lengths) - lengths
    place = np.where(at == tokens, lengths, 0)  # a cut before the first token is at 0, after the last at the end
    which, text = np.nonzero((at > 0) & (at < tokens))
    if len(text):
        # counts go on from text to text, so one search finds the block of every cut
        upto = np.cumsum(tokens) - tokens
        running = counted[:, 0] % MARK + np.repeat(upto, many)
        wanted = at[which, text] + 1
        block = np.searchsorted(running, wanted + upto[text])
        inner = block > begin[text]
        entered = np.where(inner, left[block - 1, 0], _START)
        before = np.where(inner, counted[block - 1, 0] % MARK, 0)
        place[which, text] = (block - begin[text]) * WIDTH + AUTOMATON.places(blocks[block], entered, wanted - before, MARK - 1)
    upto = _characters(data)
    prefix, end = upto[place + starts] - upto[starts]
    return tokens, marks, prefix, end - prefix


CUT = T.StructType([T.StructField(c, T.LongType()) for c in ("n", "marks", "prefix_chars", "middle_chars")])
SCANNED = T.StructType([T.StructField("leaves", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("chars", T.LongType())])


def _struct(kind: T.StructType, *arrays) -> pa.Array:
    return pa.StructArray.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in arrays], kind.names)


def _bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


@F.arrow_udf(CUT)
def cut_of(text: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    texts, first, second = _bytes(text), first.to_numpy(zero_copy_only=False), second.to_numpy(zero_copy_only=False)
    parts, begin, size = [], 0, 0
    for i, x in enumerate([*texts, None]):
        if x is None or i > begin and size + len(x) > AT_ONCE:
            parts.append(cuts(texts[begin:i], first[begin:i], second[begin:i]))
            begin, size = i, 0
        size += len(x or b"")
    return _struct(CUT, *(np.concatenate(x) for x in zip(*parts)))


@F.arrow_udf(SCANNED)
def scan_of(slices: pa.Array) -> pa.Array:
    """The function of each slice by state of entry, and its code points."""
    leaves, counts, chars = [], [], []
    for data in _bytes(slices):
        data = np.frombuffer(data, np.uint8)
        blocks, many = AUTOMATON.blocks(data, np.array([len(data)]))
        left, counted = AUTOMATON.composed(*AUTOMATON.functions(blocks), np.zeros(int(many[0]), np.int64))
        leaves.append(left[-1].tolist())
        counts.append(counted[-1].tolist())
        chars.append(int(np.count_nonzero((data & 0xC0) != 0x80)))
    return _struct(SCANNED, pa.array(leaves, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64())), chars)


@F.arrow_udf(T.LongType())
def place_of(slices: pa.Array, entered: pa.Array, wanted: pa.Array) -> pa.Array:
    """The code points before the wanted-th token of a slice that is entered in that state."""
    out = []
    for data, state, nth in zip(_bytes(slices), entered.to_pylist(), wanted.to_pylist()):
        data = np.frombuffer(data, np.uint8)
        blocks, many = AUTOMATON.blocks(data, np.array([len(data)]))
        left, counted = AUTOMATON.composed(*AUTOMATON.functions(blocks), np.zeros(int(many[0]), np.int64))
        running = counted[:, state] % MARK
        block = int(np.searchsorted(running, nth))
        before, state = (running[block - 1], left[block - 1, state]) if block else (0, state)
        place = block * WIDTH + int(AUTOMATON.places(blocks[block : block + 1], np.array([state]), np.array([nth - before]), MARK - 1)[0])
        out.append(int(np.count_nonzero((data[:place] & 0xC0) != 0x80)))
    return pa.array(out, pa.int64())


def _giant_cuts(giants: DataFrame) -> DataFrame:
    """(__key, __cut) of rows (__key, __bytes, __first, __second)."""
    slices = F.transform(F.sequence(F.lit(0), F.floor((F.octet_length("__bytes") - 1) / SLICE).cast("int")), lambda i: F.substring(F.col("__bytes"), i * SLICE + 1, F.lit(SLICE)))
    dealt = giants.select("__key", "__first", "__second", F.posexplode(slices).alias("__no", "__slice")).dropDuplicates(["__key", "__no"])
    scanned = dealt.select("__key", "__first", "__second", "__no", scan_of("__slice").alias("s"))
    # some numbers for each slice, and a cell holds less than 2**31 bytes, so at most 512 slices
    of_text = scanned.groupBy("__key").agg(F.any_value("__first").alias("a"), F.any_value("__second").alias("b"), F.array_sort(F.collect_list(F.struct("__no", "s"))).alias("all"))
    zero = F.expr("struct(0L as state, 0L as counted, 0L as chars, cast(array() as array<struct<no int, state bigint, counted bigint, chars bigint, after bigint>>) as entered)")

    def onward(so_far: Column, x: Column) -> Column:
        counted = so_far["counted"] + F.get(x["s"]["counts"], so_far["state"])
        here = F.struct(x["__no"].alias("no"), so_far["state"].alias("state"), so_far["counted"].alias("counted"), so_far["chars"].alias("chars"), (counted % MARK).alias("after"))
        return F.struct(F.get(x["s"]["leaves"], so_far["state"]).alias("state"), counted.alias("counted"), (so_far["chars"] + x["s"]["chars"]).alias("chars"), F.array_append(so_far["entered"], here).alias("entered"))

    composed = of_text.select("__key", "a", "b", F.aggregate("all", zero, onward).alias("t")).withColumn("n", F.col("t.counted") % MARK)
    x, y = F.col("a") % (F.col("n") + 1), F.col("b") % (F.col("n") + 1)
    composed = composed.select("__key", "n", (F.col("t.counted") / MARK).cast("long").alias("marks"), F.col("t.chars").alias("chars"), "t.entered", F.array(F.least(x, y), F.greatest(x, y)).alias("at"))
    asked = composed.select("__key", "n", "marks", "chars", "entered", F.posexplode("at").alias("which", "at"))
    holds = F.filter("entered", lambda e: (e["counted"] % MARK <= F.col("at")) & (e["after"] > F.col("at")))
    asked = asked.select("__key", "n", "marks", "chars", "which", "at", F.get(holds, F.lit(0)).alias("e"))  # none: the end of the text
    found = (
        asked.where("e is not null")
        .select("__key", "which", F.col("e.no").alias("__no"), F.col("e.state").alias("state"), F.col("e.chars").alias("before"), (F.col("at") - F.col("e.counted") % MARK + 1).alias("wanted"))
        .join(dealt.select("__key", "__no", "__slice"), ["__key", "__no"])
        .select("__key", "which", (F.col("before") + place_of("__slice", "state", "wanted")).alias("place"))
    )
    placed = asked.join(found, ["__key", "which"], "left").withColumn("place", F.coalesce("place", "chars"))
    both = placed.groupBy("__key").agg(F.any_value("n").alias("n"), F.any_value("marks").alias("marks"), F.min("place").alias("x"), F.max("place").alias("y"))
    return both.select("__key", F.struct("n", "marks", F.col("x").alias("prefix_chars"), (F.col("y") - F.col("x")).alias("middle_chars")).alias("__cut"))


def random_numbers(id_col: str, seed: int = SEED) -> list[Column]:
    """Four numbers of 32 bits from the SHA-256 of `seed:id`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = 50, spm_rate: int = 80, giant: int = GIANT) -> DataFrame:
    """docs with n (tokens), form, prefix_chars, middle_chars (null if plain) and output.

    rate: per cent of the texts that are transformed; spm_rate: per cent of these with the suffix before the prefix.
    """
    added = {"n", "form", "prefix_chars", "middle_chars", "output"}
    asked = {c: F.col(c) for c in docs.columns if c not in added or c in (id_col, text_col)}
    first, second, third, fourth = random_numbers(id_col, seed)
    rows = docs.select(*asked.values(), F.coalesce(F.col(text_col), F.lit("")).alias("__text"), first.alias("__first"), second.alias("__second"), third.alias("__third"), fourth.alias("__fourth"))
    long = F.octet_length("__text") > giant
    small = rows.where(~long).withColumn("__cut", cut_of("__text", "__first", "__second"))
    giants = rows.where(long).withColumn("__key", F.sha2(F.concat_ws(":", F.sha2("__text", 256), "__first", "__second"), 256))
    of_giants = _giant_cuts(giants.select("__key", F.col("__text").cast("binary").alias("__bytes"), "__first", "__second"))
    every = small.unionByName(giants.join(of_giants, "__key").drop("__key"))
    cut, text = F.col("__cut"), F.col("__text")
    plain = (text == "") | (cut["marks"] > 0) | (F.col("__third") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("__fourth") % 100 < spm_rate, "spm").otherwise("psm")
    prefix = F.substring(text, F.lit(1), cut["prefix_chars"].cast("int"))
    middle = F.substring(text, (cut["prefix_chars"] + 1).cast("int"), cut["middle_chars"].cast("int"))
    suffix = F.substring(text, (cut["prefix_chars"] + cut["middle_chars"] + 1).cast("int"), F.length(text))
    p, s, m = (F.lit(x) for x in MARKS.values())
    out = F.when(F.col("form") == "plain", text).when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    kept = [F.col(c) for c in asked]
    hidden = lambda c: F.when(F.col("form") != "plain", cut[c]).alias(c)
    return every.withColumn("form", form).select(*kept, cut["n"].alias("n"), "form", hidden("prefix_chars"), hidden("middle_chars"), out.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text, from an output and its form."""
    p, s, m = MARKS.values()
    after = lambda mark: F.substring_index(output, mark, -1)
    within = lambda begin, end: F.substring_index(F.substring_index(output, begin, -1), end, 1)
    psm, spm = F.concat(within(p, s), after(m), within(s, m)), F.concat(within(p, m), after(m), within(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)."""
    out = fill_in_middle(docs.select(id_col, text_col), id_col, text_col, **options)
    digest = lambda c: F.sha2(c, 256)
    return out.select(id_col, "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
