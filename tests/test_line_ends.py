"""Growing files read by sizes alone, with a budget for each batch."""

import json
import random

import pytest

from eventflow.sources import tail




def stream(tmp_path, **more):
    options = dict(group_headers=None, positions=None, skip_to_end=False, byte_offset=True, file_header="f", idle_seconds=None,
                   range_bytes=1 << 20, state_path=str(tmp_path / "state" / "pos"), log_gone=False)
    (tmp_path / "state").mkdir(exist_ok=True)
    options.update(more)
    return tail.GrowingFilesStreamReader(tail._options({"g": ((tmp_path / "in").as_uri(), r".*\.log")}, **options))


def batch(own, start, end, sizes=None):
    """(file, byte offset, line) of one batch."""
    out = []
    for part in own.partitions(start, end):
        if sizes is not None and part.path:
            sizes.append(part.stop - part.start)
        for b in own.read(part):
            for headers, body in zip(b.column("headers").to_pylist(), b.column("body").to_pylist()):
                h = dict(headers)
                out.append((h["f"].rsplit("/", 1)[-1], int(h[tail.BYTE_OFFSET_HEADER]), body))
    return out


def drain(own, start, **kw):
    got, batches = [], []
    while (end := own.latestOffset()) != start:
        end = json.loads(json.dumps(end))
        batches.append(batch(own, start, end, **kw))
        got += batches[-1]
        own.commit(end)
        start = end
    return got, start, batches


@pytest.fixture(autouse=True)
def no_content_on_the_driver(monkeypatch):
    def fail(*_):
        raise AssertionError("the driver read file contents")

    monkeypatch.setattr(tail, "_last_line_end", fail)
    monkeypatch.setattr(tail, "_next_line_end", fail)


def lines_of(data):
    out, at = [], 0
    for line in data.split(b"\n")[:-1]:
        out.append((at, line.removesuffix(b"\r")))
        at += len(line) + 1
    return out


@pytest.mark.parametrize("seed", range(12))
def test_files_that_grow_anyhow(tmp_path, seed):
    """Bytes are added in pieces that respect no line, over restarts; every line comes once."""
    rng = random.Random(seed)
    (tmp_path / "in").mkdir()
    own = stream(tmp_path, range_bytes=rng.randint(1, 20), max_bytes=rng.choice([None, 7, 25]))
    start, got, data = own.initialOffset(), [], {"a.log": b"", "b.log": b""}
    for _ in range(14):
        name = rng.choice(list(data))
        piece = bytes(rng.choices(b"xy\r\n", weights=[6, 6, 1, rng.choice([0.3, 2])], k=rng.randint(0, 30)))
        data[name] += piece
        with (tmp_path / "in" / name).open("ab") as out:
            out.write(piece)
        if rng.random() < 0.3:  # the driver starts anew
            own = stream(tmp_path, range_bytes=rng.randint(1, 20), max_bytes=own.settings.budget or None)
        new, start, _ = drain(own, start)
        got += new
    want = [(n, at, line) for n, d in data.items() for at, line in lines_of(d)]
    assert sorted(got) == sorted(want)


def test_budget_and_turns(tmp_path):
    (tmp_path / "in").mkdir()
    data = {"hot.log": b"".join(b"line %d\n" % i for i in range(400)), "long.log": b"L" * 900 + b"\nend\n", "s.log": b"a\nb\n"}
    for name, d in data.items():
        (tmp_path / "in" / name).write_bytes(d)
    own = stream(tmp_path, max_bytes=200, range_bytes=64)
    start, got, per_batch = own.initialOffset(), [], []
    while (end := own.latestOffset()) != start:
        sizes = []
        got += batch(own, start, end, sizes)
        per_batch.append(sum(sizes))
        grown = {p.rsplit("/", 1)[-1] for p, e in end["files"].items() if e[1] > start["files"].get(p, [0, 0, 0])[1]}
        left = {n for n, d in data.items() if start["files"].get(str(tmp_path / "in" / n), [0, 0, 0])[1] < len(d)}
        assert grown == left  # none waits
        own.commit(end)
        start = end
    assert max(per_batch) <= 200 and len(per_batch) >= 18
    assert sorted(got) == sorted((n, at, x) for n, d in data.items() for at, x in lines_of(d))


def test_share():
    assert tail.share({"a": 10, "b": 100, "c": 100}, 90) == {"a": 10, "b": 40, "c": 40}
    assert tail.share({"a": 5, "b": 5, "c": 5}, 2) == {"a": 1, "b": 1, "c": 0}
    assert tail.share({"a": 5}, 100) == {"a": 5} and tail.share({}, 9) == {}


def test_a_line_over_many_ranges_is_read_once(tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_bytes(b"x" * 5000 + b"\nshort\n")
    own = stream(tmp_path, range_bytes=100)
    start, end = own.initialOffset(), own.latestOffset()
    parts = own.partitions(start, end)
    assert len(parts) == 51
    read = []
    plain = tail._filesystem

    class Counted:
        def __init__(self, handle):
            self.handle = handle

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.handle.close()

        def seek(self, at):
            self.handle.seek(at)

        def read(self, n):
            data = self.handle.read(n)
            read.append(len(data))
            return data

    def counted(uri):
        fs, at = plain(uri)

        class Fs:
            def open_input_file(self, path):
                return Counted(fs.open_input_file(path))

        return (Fs(), at) if "state" not in uri else (fs, at)

    monkeypatch.setattr(tail, "_filesystem", counted)
    got = [x for p in parts for b in own.read(p) for x in b.column("body").to_pylist()]
    assert got == [b"x" * 5000, b"short"]
    assert sum(read) <= 2 * 5007  # each byte by its range, the line once more by its owner


def test_idle_lines_come_once(tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    log = tmp_path / "in" / "a.log"
    log.write_bytes(b"one\ntwo")
    own = stream(tmp_path, idle_seconds=0)
    got, start, batches = drain(own, own.initialOffset())
    assert [x[2] for x in got] == [b"one", b"two"] and len(batches) == 2
    again = stream(tmp_path, idle_seconds=0)
    assert again.latestOffset() == start  # a restart does not deliver it again
    with log.open("ab") as out:
        out.write(b"more\nopen")
    got, start, _ = drain(again, start)
    assert [x[1:] for x in got] == [(7, b"more"), (12, b"open")]
    waiting = stream(tmp_path, idle_seconds=3600)
    with log.open("ab") as out:
        out.write(b"!")
    assert drain(waiting, start)[0] == []


def test_cut_and_rotated_files(tmp_path):
    (tmp_path / "in").mkdir()
    log = tmp_path / "in" / "a.log"
    log.write_bytes(b"one\nhal")
    own = stream(tmp_path)
    got, start, _ = drain(own, own.initialOffset())
    assert [x[2] for x in got] == [b"one"]
    log.rename(tmp_path / "in" / "a.log.1")  # rotated with an unfinished line
    with (tmp_path / "in" / "a.log.1").open("ab") as out:
        out.write(b"f\n")
    log.write_bytes(b"new\n")
    got, start, _ = drain(own, start)
    assert sorted(x[2] for x in got) == [b"half", b"new"]
    log.write_bytes(b"n\n")  # cut: it begins again
    got, start, _ = drain(own, start)
    assert [x[2] for x in got] == [b"n"]
    with log.open("ab") as out:
        out.write(b"lost lines\n")
    end = own.latestOffset()
    log.write_bytes(b"")
    with pytest.raises(OSError, match="gone"):
        own.partitions(start, end)
    assert stream(tmp_path, log_gone=True).partitions(start, end) == [tail.NO_RANGE]


def test_batch_reads_leave_contents_to_tasks(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_bytes(b"one\ntwo\nopen")
    for idle, want in ((None, [b"one", b"two"]), (0, [b"one", b"two", b"open"])):
        options = tail._options({"g": ((tmp_path / "in").as_uri(), ".*")}, None, None, False, False, None, idle, 5, None)
        own = tail.GrowingFilesReader(options)
        parts = own.partitions()
        assert [x for p in parts for b in own.read(p) for x in b.column("body").to_pylist()] == want
