"""Archives by ranges of members, and texts in UTF-16."""

import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.functions.encoding import utf16_text
from millrace.sources.zipped import ZipReader, archives, member_bytes, ranges, written_archives, zip_members


def archive(path, members, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as z:
        for name, data in members.items():
            z.writestr(name, data)


@pytest.fixture
def folder(tmp_path):
    r = random.Random(1)
    archive(tmp_path / "a.zip", {f"m{k:03d}.tmx": bytes(r.randrange(256) for _ in range(2000)) for k in range(60)} | {"sub/": b"", "note.txt": b"x"})
    archive(tmp_path / "b.zip", {"one.TMX": b"plain", "empty.tmx": b""}, zipfile.ZIP_STORED)
    archive(tmp_path / "c.zip", {"packed.tmx": b"y" * 1000}, zipfile.ZIP_LZMA)
    archive(tmp_path / "none.zip", {})
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    (tmp_path / "other.tgz").write_bytes(b"")
    return tmp_path


def test_a_task_for_each_range(spark, folder):
    assert [p.rsplit("/", 1)[1] for p in archives(str(folder))] == ["a.zip", "b.zip", "bad.zip", "c.zip", "none.zip"]
    assert [len(x.members) for x in ranges(str(folder / "a.zip"), ".tmx", 40_000)] == [20, 20, 20]
    df = zip_members(spark, str(folder), ".tmx", 40_000)
    assert len(ZipReader({"path": str(folder), "suffix": ".tmx", "rangebytes": "40000"}).partitions()) == 3 + 1 + 1 + 1
    rows = df.withColumn("part", F.spark_partition_id()).collect()
    with zipfile.ZipFile(folder / "a.zip") as z:
        mine = [r for r in rows if r.path.endswith("a.zip")]
        assert len(mine) == 60 and all(bytes(r.data) == z.read(r.member) for r in mine) and len({r.part for r in mine}) == 3
        assert sorted(r.nth for r in mine) == list(range(60))
    rest = {(r.path.rsplit("/", 1)[1], r.member): (None if r.data is None else bytes(r.data), bool(r.error)) for r in rows if not r.path.endswith("a.zip")}
    assert rest == {("b.zip", "one.TMX"): (b"plain", False), ("b.zip", "empty.tmx"): (b"", False), ("c.zip", "packed.tmx"): (None, True), ("bad.zip", None): (None, True)}
    assert zip_members(spark, str(folder / "b.zip"), ".tmx").count() == 2 and zip_members(spark, "file:" + str(folder / "none.zip")).count() == 0


def test_broken_members(spark, folder):
    data = bytearray((folder / "b.zip").read_bytes())
    at = data.index(b"plain")
    data[at : at + 5] = b"PLAIN"
    (folder / "b.zip").write_bytes(data)
    whole = bytearray((folder / "a.zip").read_bytes())
    first, second = ranges(str(folder / "a.zip"), ".tmx", 1)[:2]
    whole[first.members[0].begin] = 0  # no member begins here any more
    whole[second.members[0].begin + 60] ^= 0xFF  # and this one's bytes differ
    (folder / "a.zip").write_bytes(whole)
    rows = [r for r in zip_members(spark, str(folder), ".tmx").collect() if r.error]
    assert sorted(r.member or "" for r in rows) == ["", "m000.tmx", "m001.tmx", "one.TMX", "packed.tmx"] and all(r.data is None for r in rows)
    member = ranges(str(folder / "b.zip"), "empty.tmx", 1)[0].members[0]
    member.secret = True
    with pytest.raises(ValueError, match="encrypted"):
        member_bytes(io.BytesIO(b""), member)


def test_a_member_that_unpacks_to_more(folder):
    archive(folder / "bomb.zip", {"x": b"0" * 10_000_000})
    member = ranges(str(folder / "bomb.zip"), "", 1)[0].members[0]
    member.size = 10
    with open(folder / "bomb.zip", "rb") as f, pytest.raises(ValueError, match="size"):
        member_bytes(f, member)


def test_written_archives_read_back(spark, tmp_path):
    rows = spark.range(100).select(F.concat("id", F.lit(".bin")).alias("member"), F.encode(F.repeat(F.lit("ab"), F.col("id").cast("int")), "UTF-8").alias("data")).repartition(3)
    made = written_archives(rows, str(tmp_path / "z")).collect()
    assert sum(r.members for r in made) == 100 and len(made) == 3
    back = zip_members(spark, str(tmp_path / "z"))
    assert back.join(rows.withColumnRenamed("data", "d"), "member").where("data = d and error is null").count() == 100


def test_utf16(spark):
    r = random.Random(2)
    values = [None, b"", b"\xff\xfe", b"\xfe\xff", b"a", b"\xff", "aé中😀".encode("utf-16"), "aé中😀".encode("utf-16-le"), b"\xfe\xff" + "aé中😀".encode("utf-16-be"), b"\x00\xd8", b"\x00\xdc", b"\x00\xd8\x00\xd8\x00\xdc", b"\xfe\xff\xd8\x00a\x00", ("x😀\n" * 50_000).encode("utf-16")]
    values += [bytes(r.choice([0, 0, 65, 0xD8, 0xDC, 0xDF, 0xFF, 0xFE]) for _ in range(r.randrange(12))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, b binary").select("i", utf16_text(F.col("b")).alias("u")).orderBy("i").collect()
    for value, row in zip(values, rows):
        if value is None:
            assert row.u is None
            continue
        order, body = ("utf-16-be", value[2:]) if value[:2] == b"\xfe\xff" else ("utf-16-le", value[2:] if value[:2] == b"\xff\xfe" else value)
        try:
            want = body.decode(order) if len(value) % 2 == 0 else None
        except UnicodeDecodeError:
            want = None
        assert row.u.text == want and (row.u.error is None) == (want is not None), value
