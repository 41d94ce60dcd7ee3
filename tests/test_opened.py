"""Reading in tasks: quotes over split borders, charsets, entries by offset, listings."""

import io
import random
import re
import zipfile

import pytest
from hypothesis import given, settings, strategies as st

from gaugeline.sources import opened as op

FIELD = re.compile(rb'"[^"]*+(?:""[^"]*+)*+"(?=[,\n]|\Z)|[^,\n]*+')


def whole_records(data: bytes):
    """Records of a whole text by one regular expression per field, and whether a quote stays open at the end."""
    at, out, begin = 0, [], 0
    while at < len(data):
        m = FIELD.match(data, at)
        at = m.end()
        if at < len(data) and data[at : at + 1] == b",":
            at += 1
            if at < len(data):
                continue
        out.append((begin, data[begin:at]))
        at += 1
        begin = at
    return out


def left_open(data: bytes) -> bool:
    state = op.NONE
    for line in data.split(b"\n"):
        state = op.after(line, state)
    return state == op.OPEN


class Memory:
    """Stands for an opened file."""

    def __init__(self, data, size):
        self.data, self.size = data, size

    def blocks(self, start=0, size=None):
        for at in range(start, len(self.data), self.size):
            yield self.data[at : at + self.size]


TEXT = st.lists(st.sampled_from([b'"', b'""', b",", b"\n", b"a", b"bc", b'",', b',"', b"\n\n", b'x"y']), max_size=60).map(b"".join)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.integers(2, 9), st.integers(1, 7))
def test_records_of_splits_are_those_of_the_whole(data, split, block):
    """Any split size, any block size: states composed from all splits give the records of one regular expression."""
    if left_open(data):
        return
    want = whole_records(data)
    state, got = op.NONE, []
    for start in range(0, max(1, len(data)), split):
        end = start + split if start + split < len(data) else None
        f = Memory(data, block)
        for at, places, records in op.Records(f, start, end, state, size=block).blocks():
            if places is None:
                places = [at]
                for r in records[:-1]:
                    places.append(places[-1] + len(r) + 1)
            got += zip(places, records)
        state = op.split_states(f, start, end, op.BYTES, False)[state]
    assert state == op.NONE
    assert [r for r in got if r[1]] == [r for r in want if r[1]]


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 20))
def test_a_split_is_a_function_of_two_states(data, block):
    for state in (op.NONE, op.OPEN):
        want = state
        for line in data.split(b"\n") if data else []:
            if line or data:
                want = op.after(line, want)
        if data.endswith(b"\n"):
            want = state
            for line in data.split(b"\n")[:-1]:
                want = op.after(line, want)
        assert op.split_states(Memory(data, block), 0, None, op.BYTES, False)[state] == want


@pytest.mark.parametrize("form, codec", [(op.UTF16_LE, "utf-16-le"), (op.UTF16_BE, "utf-16-be"), (op.UTF32_BE, "utf-32-be"), (op.ISO_2022_JP, "iso2022_jp"), (op.BYTES, "utf-8")])
def test_lines_of_other_charsets(form, codec):
    lines = [",温度ソ,表", 'x,"能\n力",ਊ' if codec.startswith("utf") else 'x,"能\n力",y', "", "a,b"] + [f"能{i},{i}" for i in range(50)]
    data = "\n".join(lines).encode(codec)
    for split in (8, 16, 64, 10_000):
        state, got = op.NONE, []
        for start in range(0, len(data), split):
            end = start + split if start + split < len(data) else None
            f = Memory(data, 6)
            got += [r for _, _, records in op.Records(f, start, end, state, form, True).blocks() for r in records if r]
            state = op.split_states(f, start, end, form, True)[state]
        assert [r.decode() for r in got] == [x for x in lines if x]


def zipped(entries, method=zipfile.ZIP_DEFLATED):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", method) as z:
        for name, data in entries.items():
            z.writestr(name, data)
    return buffer.getvalue()


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2])
def test_entries_are_read_from_their_place_alone(method):
    rng = random.Random(1)
    entries = {f"d/t{i}.csv": bytes(rng.randrange(256) for _ in range(rng.randrange(0, 3000))) + b"ab" * rng.randrange(0, 40_000) for i in range(8)}
    data = b"in front of the archive" + zipped(entries, method)
    for row in op.directory("z", io.BytesIO(data), lambda n: True):
        _, name, _, length, offset, packed, m, crc, error = row
        for size in (7, 1000, 1 << 20):
            entry = op.Entry(io.BytesIO(data), length, offset, packed, m, crc)
            assert b"".join(iter(lambda: entry.read(size), b"")) == entries[name] and error is None


def test_damaged_entries_are_errors():
    data = zipped({"a.csv": b"some text " * 500})
    row = next(op.directory("z", io.BytesIO(data), lambda n: True))
    length, offset, packed, method, crc = row[3:8]

    def read(data, crc=crc, length=length):
        entry = op.Entry(io.BytesIO(data), length, offset, packed, method, crc)
        return b"".join(iter(lambda: entry.read(100), b""))

    assert read(data) == b"some text " * 500
    for broken in (lambda: read(data, crc=1), lambda: read(data, length=3), lambda: read(b"?" * len(data)), lambda: read(data[:40])):
        with pytest.raises(Exception):
            broken()
    assert [r[1] for r in op.directory("z", io.BytesIO(b"no archive"), lambda n: True)] == [None]


def test_walk_sees_hidden_and_empty_files_and_many_folders(spark, folder, monkeypatch):
    import os

    monkeypatch.setattr(op, "FOLDERS_AT_ONCE", 2)
    names = ["_a.csv", ".b.csv", "_d/c.csv", ".e/f.csv", "x/y/z/deep 100%+.csv", "日本/é.csv", "empty.csv", "[q]{r}*.csv"]
    names += [f"many/{i}/f.csv" for i in range(9)]
    for name in names:
        folder.put(name, b"" if name == "empty.csv" else b"x")
    os.symlink(folder.path, folder.path + "/loop")
    os.symlink(folder.path + "/gone", folder.path + "/dangling.csv")
    rows = op.walk(spark, folder.path).collect()
    assert sorted(r.path for r in rows) == sorted(f"{folder.path}/{n}" for n in names)
    assert {r.path.rsplit("/", 1)[1]: r.length for r in rows}["empty.csv"] == 0
    assert op.walk(spark, folder.path + "/nothing").count() == 0
    assert op.walk(spark, "file://" + folder.path).count() == len(names)


def test_errors_are_rows(spark, folder):
    import hashlib
    import os

    here = folder.put("a.csv", b"abc" * 5_000_000)
    gone = folder.put("b.csv", b"x")
    rows = [(p, "", os.path.getsize(p), None, None, None, None) for p in (here, gone)] + [(here + "0", "", 1, None, None, None, None), (gone, "", 7, None, None, None, None)]
    work = spark.createDataFrame(rows, op.WORK)
    os.remove(gone)
    got = sorted((r.path, r.file_hash, r.error) for r in op.digests(work).collect())
    assert got == sorted([(here, hashlib.sha256(b"abc" * 5_000_000).hexdigest(), None), (gone, None, "missing file"), (here + "0", None, "missing file"), (gone, None, "missing file")], key=lambda r: (r[0], r[1] or ""))
    assert sorted((r.path, len(r.content or b""), r.error) for r in op.contents(work).collect())[0] == (here, 15_000_000, None)


def test_a_split_is_read_for_its_own_lines(tmp_path):
    """Blocks end at the split's border: what lies behind it is looked at only as far as an open quote goes."""
    text = "".join(f'{i},"a\n{i}",b\n' if i % 3 else f"{i},plain\n" for i in range(3000)).encode()
    (tmp_path / "t.csv").write_bytes(text)
    row = {"path": str(tmp_path / "t.csv"), "source_zip": "", "length": len(text)}
    with op.Opened(row) as f:
        (whole,) = [r for _, _, r in op.Records(f, 0, None, op.NONE).blocks(slow_until=1 << 62)]
    found, state, blocks, seen = [], op.NONE, 0, 0
    for start in range(0, len(text), 1000):
        end = start + 1000 if start + 1000 < len(text) else None
        with op.Opened(row) as f:
            for _, _, records in op.Records(f, start, end, state).blocks():
                found, blocks = found + records, blocks + 1
            seen += sum(len(data) for at, data in op.whole_lines(f, start, op.BYTES, border=end) if end is None or at < end)
            state = op.split_states(f, start, end, op.BYTES, False)[state]
    assert [r for r in found if r] == [r for r in whole if r] and seen == len(text)
    assert blocks <= -(-len(text) // 1000) + 1


def test_regular_quotes_are_not_looked_at_line_by_line(tmp_path, monkeypatch):
    """Behind the header rows, quoted line ends cost no call per line, in an archive's entry neither; odd quotes still do."""
    head = b', a\n,"b\nc"\n, d\n'
    regular = b"".join(b'%d,"x ""%d""\r\ny",""\n\n' % (i, i) if i % 2 else b"%d,plain,z\r\n" % i for i in range(2000))
    calls, opens = [0], op.opens
    monkeypatch.setattr(op, "opens", lambda *a: calls.__setitem__(0, calls[0] + 1) or opens(*a))

    def records(data, slow_until):
        (tmp_path / "t.csv").write_bytes(data)
        calls[0] = 0
        with op.Opened({"path": str(tmp_path / "t.csv"), "source_zip": "", "length": len(data)}) as f:
            found = [r for _, _, rs in op.Records(f, 0, None, op.NONE).blocks(slow_until) for r in rs]
            n = calls[0]
            states = [op.split_states(f, 0, None, op.BYTES, False, known) for known in (False, True)]
        return [r.removesuffix(b"\r") for r in found if r not in (b"", b"\r")], n, calls[0] - n, states

    for data in (head + regular, head + regular + b'last,"open\nended"', head + regular + b'last,"open\nended,'):
        slow, n, _, _ = records(data, 1 << 62)
        fast, few, of_states, states = records(data, len(head) - 2)
        assert fast == slow and n > 2000 and few < 10 and of_states < 10
        assert states[0][0] == states[1][0] == states[1][1] == (op.OPEN if data.endswith(b",") else op.NONE)
    odd = head + regular + b'3" pipe,"a\nb"\n'
    assert records(odd, len(head) - 2)[:2] == records(odd, 1 << 62)[:2]


@settings(max_examples=400, deadline=None)
@given(TEXT, st.sampled_from([op.NONE, op.OPEN]))
def test_states_by_counting_quotes(data, state):
    """Where quotes are regular, counting them tells what looking at every line tells."""
    found = op.quote_states(data, state)
    if found is None:
        return
    newlines, states, last = found
    at = state
    lines = data.split(b"\n")
    for line, want in zip(lines, states):
        at = op.after(line, at)
        assert at == want
    assert len(newlines) == len(states) == len(lines) - 1
    assert (op.after(lines[-1], at) if lines[-1] else at) == last
