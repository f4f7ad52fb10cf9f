import os
import random

import pytest
from pyspark.errors import StreamingQueryException

from eventflow.plans.flow import Flow
from eventflow.sources import spool_stream as S
from eventflow.streaming.delivery import batch_writer


def put(folder, name, data: bytes, at=None):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(data)
    if at is not None:
        os.utime(folder / name, (at, at))


def drain(spark, tmp_path, folder="in", **options):
    """All that is there now, as (batch, file, body)."""
    got = []

    def keep(df, batch_id):
        got.extend((batch_id, r.headers["f"], bytes(r.body)) for r in df.collect())

    events = S.stream_spool_files(
        spark, str(tmp_path / folder), str(tmp_path / "files"), basename_header="f", **options
    )
    query = events.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "state")).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return got


@pytest.mark.parametrize("order", ["oldest", "youngest", "random"])
def test_files_come_in_order(spark, tmp_path, order):
    inbox = tmp_path / "in"
    for i, name in enumerate(["c", "a", "e", "b", "d"]):
        put(inbox, name, f"{name}1\n{name}2\n".encode(), 1_000 + 10 * (i // 2))
    got = drain(spark, tmp_path, order=order, seed=4, max_files_per_trigger=2)
    files = list(dict.fromkeys(f for _, f, _ in got))
    want = {"oldest": ["a", "c", "b", "e", "d"], "youngest": ["d", "b", "e", "a", "c"]}.get(order)
    assert files == want if want else sorted(files) == ["a", "b", "c", "d", "e"]
    assert [b for _, _, b in got] == [x for f in files for x in (f"{f}1".encode(), f"{f}2".encode())]
    assert [len({f for n, f, _ in got if n == b}) for b in (0, 1, 2)] == [2, 2, 1]


def test_empty_files_restarts_and_reused_names(spark, tmp_path):
    inbox = tmp_path / "in"
    put(inbox, "a", b"", 10)
    put(inbox, "b", b"x\n\ny", 20)
    put(inbox, "no.tmp", b"z", 30)
    put(inbox, ".hidden", b"z", 30)
    assert [g[1:] for g in drain(spark, tmp_path, ignore=r".*\.tmp")] == [("a", b""), ("b", b"x"), ("b", b""), ("b", b"y")]
    assert drain(spark, tmp_path, ignore=r".*\.tmp") == []
    put(inbox, "early", b"late arrival\n", 5)  # older than all that was read
    put(inbox, "a", b"again\n", 40)
    assert [g[1:] for g in drain(spark, tmp_path, ignore=r".*\.tmp")] == [("early", b"late arrival"), ("a", b"again")]


@pytest.mark.parametrize("policy", ["immediate", "rename", "archive"])
def test_delivered_files(spark, tmp_path, policy):
    inbox = tmp_path / "in"
    put(inbox, "a", b"1\n", 10)
    put(inbox, "b", b"", 20)
    options = dict(delete_policy=policy, archive_dir=str(tmp_path / "old"), max_files_per_trigger=1)
    assert len(drain(spark, tmp_path, **options)) == 2
    put(inbox, "c", b"3\n", 30)  # the next batch commits the one before it
    assert [g[1:] for g in drain(spark, tmp_path, **options)] == [("c", b"3")]
    assert not (inbox / "a").exists() and (inbox / "a.COMPLETED").exists() == (policy == "rename")
    if policy == "archive":
        assert (tmp_path / "old" / "a").read_bytes() == b"1\n"


def reader(tmp_path, **more):
    options = {"path": f"file://{tmp_path / 'in'}", "statepath": f"file://{tmp_path / 'files'}", "include": ".*", "ignore": "^$",
               "suffix": ".COMPLETED", "recursive": "true", "order": "oldest", "seed": "0", "maxfiles": "10",
               "deletepolicy": "never", "rangebytes": "7", "blob": "0"}
    return S.SpoolFilesReader({**options, **more})


def test_a_changed_file_fails_its_batch(tmp_path):
    inbox, own = tmp_path / "in", reader(tmp_path)
    put(inbox, "a", b"one\ntwo\n", 10)
    end = own.latestOffset()
    put(inbox, "a", b"one\ntwo\nmore\n", 10)
    with pytest.raises(S.FileChanged):
        own.partitions(own.initialOffset(), end)
    put(inbox, "a", b"one\ntwo\n", 10)
    parts = own.partitions(own.initialOffset(), end)
    os.utime(inbox / "a", (99, 99))
    with pytest.raises(S.FileChanged):
        [list(own.read(p)) for p in parts]
    (inbox / "a").unlink()
    with pytest.raises(S.FileChanged):
        own.partitions(own.initialOffset(), end)


def test_a_stream_stops_at_a_changed_file(spark, tmp_path):
    inbox = tmp_path / "in"
    put(inbox, "a", b"one\n", 10)
    events = S.stream_spool_files(spark, str(inbox), str(tmp_path / "files"))
    flow = Flow(events).to("store", batch_writer(str(tmp_path / "out")))
    running = flow.start(str(tmp_path / "state"))
    running.processAllAvailable()
    running.stop()
    (tmp_path / "state" / "commits" / "0").unlink()  # the batch is to be repeated
    for crc in (tmp_path / "state" / "commits").glob(".0*"):
        crc.unlink()
    put(inbox, "a", b"other\n", 50)
    running = flow.start(str(tmp_path / "state"))
    with pytest.raises(StreamingQueryException, match="changed"):
        running.processAllAvailable()


def test_a_planned_batch_is_not_planned_again(tmp_path):
    """The driver ended after planning: the next one repeats that batch and goes on after it."""
    inbox, own = tmp_path / "in", reader(tmp_path, maxfiles="1")
    put(inbox, "a", b"1", 10)
    put(inbox, "b", b"2", 20)
    first = own.latestOffset()
    own.partitions(own.initialOffset(), first)
    anew = reader(tmp_path, maxfiles="1")
    assert [p.path[-1] for p in anew.partitions(anew.initialOffset(), first)] == ["a"]
    second = anew.latestOffset()
    assert second["batch"] == 2 and second["files"][0][0].endswith("b")
    assert anew.latestOffset() == second
    again = reader(tmp_path, maxfiles="1")
    again.partitions(first, second)
    assert again.latestOffset() == second


def test_lines_of_ranges(tmp_path):
    """Every line once, whatever the ranges; a long line is read by its owner alone."""
    rng = random.Random(1)
    for _ in range(60):
        data = bytes(rng.choices(b"ab\n", weights=[5, 5, rng.choice([0.2, 1, 5])], k=rng.randint(1, 60)))
        put(tmp_path / "in", "a", data, 10)
        own = reader(tmp_path, rangebytes=str(rng.randint(1, 30)), statepath=f"file://{tmp_path}/s{rng.random()}")
        parts = own.partitions(own.initialOffset(), own.latestOffset())
        got = [v for p in parts for b in own.read(p) for v in b.column("value").to_pylist()]
        want = data.split(b"\n")
        assert got == (want[:-1] if want[-1] == b"" else want)
