import base64
import hashlib
import os

import pytest

import sheetloom.llm.warc as warc

SCHEMA = "page_id long, url string, html string"


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def archive(folder):
    return {n: open(os.path.join(folder, n), "rb").read() for n in os.listdir(folder) if n.endswith(".warc.gz")}


def rows():
    return ([(i, f"http://x/{i}", f"page {i % 7} é" * (i % 5)) for i in range(60)]
            + [(100, None, None), (101, "bad\r\nInjected: header", ""), (-5, "http://n", "\r\n\r\n</html>"),
               (10 ** 15, "http://far", "x" * 200_000)])


def test_round_trip(spark, tmp_path):
    folder = f"file://{tmp_path}/a"
    warc.write(spark.createDataFrame([(*r, 1) for r in rows()], SCHEMA + ", shard int"), folder)
    got = {r.page_id: r for r in warc.read(spark, folder).collect()}
    assert len(got) == len(rows())
    last = {}
    for i, _, html in rows():
        key = html or ""
        last[key] = max(i, last.get(key, i))
    for i, _, html in rows():
        payload, r = (html or "").encode(), got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), sha(payload))
        if i == last[html or ""]:
            assert r.record_type == "response" and r.refers_to is None and r.payload == payload
        else:
            assert r.record_type == "revisit" and r.refers_to == last[html or ""] and r.payload is None


def test_same_bytes_whatever_the_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 300)
    df = spark.createDataFrame(rows(), SCHEMA)
    for name, n in (("a", 1), ("b", 7)):
        warc.write(df.repartition(n), f"file://{tmp_path}/{name}")
    a, b = archive(tmp_path / "a"), archive(tmp_path / "b")
    assert a == b and len(a) > 3
    manifest = {r.file: r for r in spark.read.parquet(f"file://{tmp_path}/a/manifest").collect()}
    assert set(manifest) == set(a)
    for name, data in a.items():
        assert manifest[name].sha256 == hashlib.sha256(data).hexdigest() and manifest[name].bytes == len(data)
    spans = sorted((r.first_id, r.last_id) for r in manifest.values())
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_files_roll_and_strangers_are_not_read(spark, tmp_path):
    roller = warc._Roller(f"file://{tmp_path}", 3, "0-0")
    whole, warc.FILE_BYTES = warc.FILE_BYTES, 400
    try:
        done = [roller.write(warc.record(i, "u", b"x%d" % i, sha(b"x%d" % i), None), i) for i in range(9)] + [roller.close()]
    finally:
        warc.FILE_BYTES = whole
    done = [d for d in done if d]
    assert len(done) > 2 and sum(d["records"] for d in done) == 9
    folder = f"file://{tmp_path}/z"
    warc.write(spark.createDataFrame(rows()[:3], SCHEMA), folder)
    (tmp_path / "z" / "_temporary-9-9-part-000000-00000.warc.gz").write_bytes(b"half a record")
    assert warc.read(spark, folder).count() == 3


def test_damage_is_noticed(spark, tmp_path):
    folder = f"file://{tmp_path}/d"
    warc.write(spark.createDataFrame(rows()[:5], SCHEMA), folder)
    name = next(iter(archive(tmp_path / "d")))
    path = tmp_path / "d" / name
    path.write_bytes(path.read_bytes()[:-30])
    with pytest.raises(Exception):
        warc.read(spark, folder).collect()


def test_empty_repeated_and_null_ids(spark, tmp_path):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
    twice = spark.createDataFrame([(1, "u", "x"), (1, "u", "x")], SCHEMA)
    assert [r.record_type for r in warc.round_trip(twice).collect()] == ["response"] * 2
    nulls = [(None, "u", "x"), (None, "v", "x"), (None, "w", "y"), (4, "z", "y"), (None, "w", None)]
    got = sorted((str(r.page_id), r.url, r.record_type, r.refers_to)
                 for r in warc.round_trip(spark.createDataFrame(nulls, SCHEMA)).collect())
    assert got == [("4", "z", "response", None), ("None", "u", "response", None), ("None", "v", "response", None),
                   ("None", "w", "response", None), ("None", "w", "revisit", 4)]


def test_payloads_of_one_id_are_all_kept(spark, tmp_path):
    folder = f"file://{tmp_path}/p"
    warc.write(spark.createDataFrame([(1, "u", "A"), (1, "u", "B"), (2, "u", "A"), (1, "u", "C"), (0, "u", "C")], SCHEMA), folder)
    got = {(r.page_id, r.payload_digest): (r.record_type, r.refers_to, r.payload) for r in warc.read(spark, folder).collect()}
    assert got == {(1, sha(b"A")): ("revisit", 2, None), (1, sha(b"B")): ("response", None, b"B"),
                   (2, sha(b"A")): ("response", None, b"A"), (1, sha(b"C")): ("response", None, b"C"),
                   (0, sha(b"C")): ("revisit", 1, None)}


def jobs_of(spark, name, run) -> int:
    spark.sparkContext.setJobGroup(name, name)
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_shards_are_found_in_a_fixed_number_of_jobs(spark, tmp_path, monkeypatch):
    sizes = spark.range(10_000).selectExpr("id * id * 1000 as id", "id % 70 as bytes").repartition(4)
    few = jobs_of(spark, "few", lambda: warc._bounds(sizes.where("id < 1000000")))
    monkeypatch.setattr(warc, "SHARD_BYTES", 2000)
    found = []
    many = jobs_of(spark, "many", lambda: found.append(warc._bounds(sizes)))
    (cuts, size), = found
    assert few == many <= 12    # adaptive execution counts every shuffle as a job
    assert size == 2000 and 3000 < len(cuts) < 4000
    # every cut is where the running size passes a multiple, whatever the ranges
    running, expected = 0, []
    for i in range(10_000):
        if running // size != (running - (i and (i - 1) % 70 + warc.HEADER_BYTES)) // size and i:
            expected.append(i * i * 1000)
        running += i % 70 + warc.HEADER_BYTES
    assert cuts == expected


def test_a_run_of_the_writer_rolls(spark, tmp_path, monkeypatch):
    import random
    monkeypatch.setattr(warc, "SHARD_BYTES", 40_000)
    rng = random.Random(0)
    text = ["".join(rng.choice("abcdefgh ") for _ in range(3000)) for _ in range(60)]
    manifest = warc.write(spark.createDataFrame([(i, "u", t) for i, t in enumerate(text)], SCHEMA), f"file://{tmp_path}/r")
    files = sorted(r.file for r in manifest.collect())
    shards = {f[:11] for f in files}
    assert len(shards) > 3 and len(files) >= 3 * len(shards)
    assert warc.read(spark, f"file://{tmp_path}/r").count() == 60


def test_base32_in_columns(spark):
    from pyspark.sql import functions as F
    texts = [(f"t{i}",) for i in range(50)]
    df = spark.createDataFrame(texts, "t string").select("t", warc._base32(F.sha1("t")).alias("d"))
    assert all(r.d == sha(r.t.encode()) for r in df.collect())
