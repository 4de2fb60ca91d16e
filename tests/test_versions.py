import json
import random

import pytest

from corpusloom.sources import byte_ranges as Y, versions as V

SCHEMA = "k long, seq long, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plain(state, batch):
    """A dictionary of key to row takes a batch in: the last of equal keys wins."""
    new = {}
    for r in batch:
        if r[0] not in new or r[1] > new[r[0]][1]:
            new[r[0]] = r
    return state | new


def files(spark, table):
    return {f.split("/data/")[1] for f in table.read().inputFiles()}


def test_upserts_rewrite_only_their_buckets(spark, tmp_path):
    r = random.Random(4)
    table = V.BucketTable(spark, f"file://{tmp_path}/t", ["k"], buckets=16)
    state = {}
    for step, n in enumerate((400, 4, 60, 1)):
        batch = [(r.choice([r.randrange(600), None]) if n > 50 else r.randrange(600), 100 * step + i, f"{step} {i}") for i in range(n)]
        before = files(spark, table) if step else set()
        old = rows(table.read()) if step else None
        touched = table.upsert(spark.createDataFrame(batch, SCHEMA))
        state = plain(state, batch)
        assert rows(table.read()) == sorted(state.values(), key=str)
        own = {row["b"] for row in spark.createDataFrame(batch, SCHEMA).select(V.bucket_of(["k"], 16).alias("b")).distinct().collect()}
        assert touched == sorted(own)
        after = files(spark, table)
        assert {f for f in before & after} == {f for f in before if int(f.split("bucket_=")[1].split("/")[0]) not in own}
        assert step == 0 or rows(table.read(version=step - 1)) == old
    assert table.version() == 3 and table.upsert(spark.createDataFrame([], SCHEMA)) == [] and table.version() == 3
    named = files(spark, table)
    table.vacuum()
    assert rows(table.read()) == sorted(state.values(), key=str) and files(spark, table) == named
    on_disk = {str(p).split("/data/")[1] for p in (tmp_path / "t/data").rglob("*.parquet")}
    assert on_disk == named and table.manifests.numbers() == [3]


@pytest.mark.parametrize("step", ["winners", "merged", "manifest"])
def test_a_lost_upsert_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch, step):
    table = V.BucketTable(spark, f"file://{tmp_path}/t", ["k"], buckets=4)
    first = [(i, 1, "old") for i in range(20)]
    table.upsert(spark.createDataFrame(first, SCHEMA))
    batch = [(i, 2, "new") for i in range(5, 25)]

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        if step == "winners":
            m.setattr(V.BucketTable, "_rows", lost)
        elif step == "merged":
            m.setattr(V, "delete", lost)
        else:
            m.setattr(V.Manifests, "put", lost)
        with pytest.raises(OSError):
            table.upsert(spark.createDataFrame(batch, SCHEMA))
    assert rows(table.read()) == sorted(first, key=str) and table.version() == 0
    table.upsert(spark.createDataFrame(batch, SCHEMA))
    want = sorted(plain({r[0]: r for r in first}, batch).values(), key=str)
    table.vacuum()
    assert rows(table.read()) == want and len(list((tmp_path / "t/data").iterdir())) <= 2


def test_second_writer_and_other_keys_fail(spark, tmp_path, monkeypatch):
    table = V.BucketTable(spark, f"file://{tmp_path}/t", ["k"], buckets=2)
    one = spark.createDataFrame([(1, 1, "a")], SCHEMA)
    table.upsert(one)
    monkeypatch.setattr(V.BucketTable, "version", lambda self: None)
    with pytest.raises(V.Conflict):
        table.upsert(one)
    monkeypatch.undo()
    assert rows(table.read()) == [(1, 1, "a")]
    with pytest.raises(ValueError):
        V.BucketTable(spark, table.path, ["v"], buckets=2).read()
    with pytest.raises(FileNotFoundError):
        V.BucketTable(spark, f"{tmp_path}/none", ["k"]).read()


@pytest.mark.parametrize("step", ["data", "commit"])
def test_killed_append_resumes_without_lost_or_doubled_rows(spark, tmp_path, monkeypatch, step):
    log = V.AppendLog(spark, f"file://{tmp_path}/log", "k")
    batches = [[(1, 1, "a"), (2, 1, "a"), (2, 2, "b"), (None, 1, "n")], [(2, 9, "again"), (3, 1, "c"), (None, 2, "n2")], [], [(4, 1, "d")]]
    frames = [spark.createDataFrame(b, SCHEMA) for b in batches]
    assert log.read() is None and log.append(0, frames[0]) == 3

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(V.Manifests, "put", lost) if step == "commit" else m.setattr(V.uuid, "uuid4", lost)
        with pytest.raises(OSError):
            log.append(1, frames[1])
    assert [log.append(i, f) for i, f in enumerate(frames)] == [0, 1, 0, 1]
    assert [log.append(i, f) for i, f in enumerate(frames)] == [0, 0, 0, 0] and log.committed() == [0, 1, 2, 3]
    assert rows(log.read()) == sorted([(1, 1, "a", 0), (2, 2, "b", 0), (None, 1, "n", 0), (3, 1, "c", 1), (4, 1, "d", 3)], key=str)


def test_spaced_ranges():
    assert Y.spaced(100, 5, 7) == [(0, 7), (20, 27), (40, 47), (60, 67), (80, 87)]
    assert Y.spaced(10, 5, 7) == [(0, 10)] and Y.spaced(0, 5, 7) == [] and Y.spaced(3, 5, 1) == [(0, 3)]


@pytest.mark.parametrize("width", [1, 7, 30, 64, 500, 10_000])
def test_lines_of_ranges_against_a_plain_loop(spark, tmp_path, width):
    r = random.Random(width)
    (tmp_path / "d").mkdir()
    for name in ("a.jsonl", "b.jsonl"):
        lines = [json.dumps({"k": r.randrange(60), "v": "é" * r.randrange(20)}, ensure_ascii=False) for _ in range(80)]
        (tmp_path / "d" / name).write_bytes(("\n".join(lines) + ("\n" if name == "a.jsonl" else "")).encode())
    (tmp_path / "d/_SUCCESS").write_bytes(b"x")
    want = []
    for name in ("a.jsonl", "b.jsonl"):
        data = (tmp_path / "d" / name).read_bytes()
        at = 0
        for line in data.split(b"\n")[: -1 if data.endswith(b"\n") else None]:
            end = at + len(line)
            if any(a <= at and (end < b or end == b == len(data)) for a, b in Y.spaced(len(data), 4, width)):
                want.append((name, at, line.decode()))
            at = end + 1
    got = sorted((x.file.split("/")[-1], x.start, x.line) for x in Y.sample_lines(spark, f"file://{tmp_path}/d", 4, width).collect())
    assert got == sorted(want)
    keyed = {x.k: x.v for x in Y.sample_records(spark, f"{tmp_path}/d", "k long, v string", "k", 4, width).collect()}
    first = {}
    for _, _, line in sorted(want):
        first.setdefault(json.loads(line)["k"], json.loads(line)["v"])
    assert keyed == first


def test_only_the_ranges_are_read(tmp_path, monkeypatch):
    (tmp_path / "big").write_bytes(b"line\n" * 20_000)
    read = []

    class Counted:
        def __init__(self, file):
            self.file = file

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

        def size(self):
            return self.file.size()

        def read_at(self, n, at):
            read.append((at, n))
            return self.file.read_at(n, at)

    class Store:
        def open_input_file(self, path):
            return Counted(Y.fs.LocalFileSystem().open_input_file(path))

    reader = Y.Reader({"path": f"file://{tmp_path}/big", "ranges": "3", "bytes": "100"})
    parts = reader.partitions()
    monkeypatch.setattr(Y, "open_path", lambda p: (Store(), f"{tmp_path}/big"))
    lines = [b for p in parts for b in reader.read(p)]
    assert read == [(0, 100), (33_332, 101), (66_665, 101)] and sum(b.num_rows for b in lines) <= 60


def test_killed_stream_resumes(spark, tmp_path):
    """The first run is lost after its batch's rows are committed but before the stream knows; the second takes nothing twice."""
    from corpusloom.streaming.incremental import process_log

    class Lossy(V.AppendLog):
        lost = False

        def append(self, batch_id, rows, seq="seq"):
            n = super().append(batch_id, rows, seq)
            if self.lost:
                raise OSError("lost")
            return n

    log = Lossy(spark, f"file://{tmp_path}/log", "k")
    schema = spark.createDataFrame([], SCHEMA).schema
    args = (spark, f"{tmp_path}/in", schema, lambda d: d, log, f"{tmp_path}/check")
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], SCHEMA).write.parquet(f"{tmp_path}/in")
    log.lost = True
    with pytest.raises(Exception, match="lost"):
        process_log(*args)
    log.lost = False
    process_log(*args)
    assert rows(log.read()) == [(1, 1, "a", 0), (2, 1, "b", 0)]
    spark.createDataFrame([(2, 2, "again"), (3, 1, "c")], SCHEMA).write.mode("append").parquet(f"{tmp_path}/in")
    process_log(*args)
    assert [r[:3] for r in rows(log.read())] == [(1, 1, "a"), (2, 1, "b"), (3, 1, "c")]
