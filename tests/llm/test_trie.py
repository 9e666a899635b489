"""The trie of conversations against a dictionary of beginnings."""

import collections
import hashlib
import random
import zlib
from functools import partial

import pytest
from pyspark.sql import functions as F

from millrace.llm import conversation_trie as C

SCHEMA = "conv_id long, turn long, role string, text string"


def plainly(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn, role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rest = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = tuple(own.get(rest, [])[:h] + own[c][h:])
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        own_saved = (len(m) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += own_saved
            leaves[k[:d]] += children[k] == 0
    ends = {k: ",".join(map(str, sorted(c for c in m if built[c] == k))) for k, m in members.items()}
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends[k].encode()).hexdigest()) for k, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def check(spark, rows, parts=3):
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    out = C.trie_report(table)
    assert out.columns == COLUMNS and {t for c, t in out.dtypes if c != "ends_sha256"} == {"bigint"}
    assert sorted(map(tuple, out.collect())) == plainly(rows)


def random_rows(seed, convs, turns, kinds):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"][: 1 + kinds % 2]), f"t{r.randrange(kinds)}é") for c in convs for t in range(r.randrange(1, turns))]


@pytest.mark.parametrize("seed, convs, turns, kinds", [(1, range(60), 14, 2), (2, range(-30, 30), 12, 1), (3, [0, 7, 8, 9, 14, 10**12], 20, 3)])
def test_random_conversations(spark, seed, convs, turns, kinds):
    check(spark, random_rows(seed, convs, turns, kinds))


def test_nulls_repeats_and_empty_texts(spark):
    rows = [(None, 0, "user", "x"), (5, None, None, None), (5, 0, "user", ""), (5, 0, "user", ""), (6, 3, "a", "b"), (6, None, "", ""), (7, 1, "a", "b"), (11, 1, None, "c"), (11, 1, "b", "a")]
    check(spark, rows)
    assert C.trie_report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert C.trie_report(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    clash = spark.createDataFrame(rows, SCHEMA).withColumn("conv", F.lit("x")).withColumn("nth", F.lit("y")).withColumn("depth", F.lit(0))
    assert sorted(map(tuple, C.trie_report(clash).collect())) == plainly(rows)


def test_many_equal_conversations_and_a_long_one(spark, monkeypatch):
    """Blocks of ends and of turns that are much smaller than their groups."""
    monkeypatch.setattr(C, "ENDS", 4)
    monkeypatch.setattr(C, "running_sums", partial(C.running_sums, width=5))
    rows = [(c, t, "user", "same " * 50) for c in range(100) for t in range(3)] + [(500, t, "user", f"turn {t % 7}") for t in range(150)] + [(501, t, "user", "x" * 100_000) for t in range(12)]
    check(spark, rows)


def test_chains_that_hang_on_chains(spark):
    """Conversation c leaves c - 1 after c turns: rounds grow with the logarithm of the depth."""
    rows = [(5 * c, t, "user", f"{min(c, t)}") for c in range(20) for t in range(c + 9)]
    check(spark, rows)


def test_only_the_trie_stays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("millrace.llm.common.shared_dir", lambda session: str(tmp_path))
    C.trie_report(spark.createDataFrame(random_rows(9, range(8), 5, 2), SCHEMA)).collect()
    assert [p.name.split("-")[0] for p in (tmp_path / "millrace").iterdir()] == ["trie"]


def test_report_of_the_table(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    assert sorted(map(tuple, C.trie_report(table).collect())) == plainly([(r.conv_id, r.turn, r.role, r.text) for r in table.collect()])
