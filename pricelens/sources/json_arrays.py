"""JSON array files split into their elements, by byte ranges.

A file holds one array of any size.  Its bytes are cut into ranges and every
range is one row of a DataFrame, so a single file is read by many tasks:

1. *summaries*: what a range does to the state (escape pending, inside a
   string, bracket depth) as a function of the state it starts with, found
   for all start states in one vectorised pass.  A depth never falls under
   that of the array, so a range maps depth d to max(d + rise, least).
2. *composition*: per file, the ranges' functions are applied in order (one
   small row a range), which gives each range the state it starts with and
   the number of elements before it.
3. *elements*: a range yields the elements that start in it, reading past
   its end for the last one.

Commas outside strings at the array's depth separate elements.  The scan
depends on no element being well formed, so one that is not costs itself only:
surplus closing brackets don't leave the array, and a raw line break, illegal
inside a JSON string, ends a string that was never closed.  (A bracket that is
opened and never closed takes what follows into its element: where it should
have ended cannot be told.)

A gzip file (.gz) can only be read from its start, so its ranges, places in
the bytes it holds, are read one after the other by one task, which unpacks it
once a pass; many such files are still read by many tasks.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE = 32 << 20        # bytes of a range
READ = 4 << 20          # bytes read at a time
PAST = 1 << 16          # bytes read at first past a range's end
LONGEST = 256 << 20     # bytes of the longest element that is loaded
REJECT_TEXT = 8192      # characters of a rejected element that are kept

_QUOTE, _BACK, _COMMA, _LINE = b'"'[0], b"\\"[0], b","[0], b"\n"[0]
_KIND = np.zeros(256, np.int8)
for _c, _k in ((b"{", 1), (b"[", 1), (b"}", -1), (b"]", -1)):
    _KIND[_c[0]] = _k
_MARK = _KIND != 0
_MARK[_COMMA] = True
_KNOWN = _MARK.copy()   # bytes that a scan looks at
_KNOWN[[_QUOTE, _BACK, _LINE]] = True
_BLANK = b" \t\r\n"


# ---------------------------------------------------------------- automaton
class Scan:
    """The marks of a piece of a file, given whether its first byte is escaped."""

    def __init__(self, data: bytes, escaped: bool):
        raw = np.frombuffer(data, np.uint8)
        known = np.flatnonzero(_KNOWN[raw])
        kinds = raw[known]
        back = known[kinds == _BACK]
        ends_escaped, skip = False, np.empty(0, np.int64)
        if len(back) or escaped:
            # in a run of backslashes every second one is escaped, and so is what follows an odd run
            first = np.concatenate([[True], np.diff(back) != 1]) if len(back) else np.empty(0, bool)
            start = back[first][np.cumsum(first) - 1] if len(back) else back
            nth = back - start
            if escaped and len(back):
                nth = nth + (start == 0)  # the piece's first byte is escaped already
            live = back[nth % 2 == 0]
            skip = live + 1
            if escaped:
                skip = np.concatenate([[0], skip])
            ends_escaped = bool(len(skip) and skip[-1] == len(raw))
            skip = skip[skip < len(raw)]
        quote = known[kinds == _QUOTE]
        if len(skip):
            escapes = np.zeros(len(raw), bool)
            escapes[skip] = True
            quote = quote[~escapes[quote]]
        self.ends_escaped = ends_escaped
        line = known[kinds == _LINE]
        mark = known[_MARK[kinds]]
        # quotes since the last line break, or since the piece began
        breaks = np.searchsorted(line, mark)
        before = np.concatenate([[0], np.searchsorted(quote, line)])
        count = np.searchsorted(quote, mark) - before[breaks]
        self.first_line = breaks == 0
        self.odd = count % 2 == 1
        self.mark, self.kind = mark, _KIND[raw[mark]]
        tail = len(quote) - (np.searchsorted(quote, line[-1]) if len(line) else 0)
        self.tail_odd, self.has_line = tail % 2 == 1, bool(len(line))

    def outside(self, in_string: bool) -> np.ndarray:
        """Which marks lie outside strings."""
        return ~(self.odd ^ (self.first_line & in_string))

    def ends_in_string(self, in_string: bool) -> bool:
        return bool(self.tail_odd if self.has_line else self.tail_odd ^ in_string)


def summaries(pieces: Iterator[bytes]) -> list[dict]:
    """What a range does, for each start state (escaped, in string), as a
    function of the depth d it starts at: it ends at max(d + rise, least), and
    separates sum(count where level <= 1 - d) elements.  ``level`` is a running
    minimum of the relative depth."""
    runs = [{"escaped": e, "in_string": s, "rise": 0, "low": 0, "tally": {}} for e in (False, True) for s in (False, True)]
    for data in pieces:
        scans, marks = {}, {}
        told = data[0] in (_QUOTE, _BACK)  # whether an escape before the piece changes what it does
        for run in runs:
            escaped = run["escaped"] and told
            scan = scans.get(escaped) or scans.setdefault(escaped, Scan(data, escaped))
            key = escaped, run["in_string"]
            if key not in marks:
                kind = scan.kind[scan.outside(run["in_string"])].astype(np.int64)
                marks[key] = kind, np.cumsum(kind)
            kind, depth = marks[key]
            if len(kind):
                lowest = np.minimum(run["low"] - run["rise"], np.minimum.accumulate(depth))
                levels, counts = np.unique(lowest[(kind == 0) & (depth == lowest)] + run["rise"], return_counts=True)
                for level, n in zip(levels.tolist(), counts.tolist(), strict=True):
                    run["tally"][level] = run["tally"].get(level, 0) + n
                run["low"], run["rise"] = run["rise"] + int(lowest[-1]), run["rise"] + int(depth[-1])
            run["escaped"], run["in_string"] = scan.ends_escaped, scan.ends_in_string(run["in_string"])
    # depth after mark i = S_i + max(d, 1 - min S): closing brackets that would leave the array don't count
    return [{"escaped": r["escaped"], "in_string": r["in_string"], "rise": r["rise"], "least": 1 + r["rise"] - r["low"],
             "levels": list(r["tally"]), "counts": list(r["tally"].values())} for r in runs]


def follow(state: tuple[bool, bool, int, int], by: dict) -> tuple[bool, bool, int, int]:
    """(escaped, in string, depth, elements separated so far) after a range."""
    _, _, depth, n = state
    found = sum(c for level, c in zip(by["levels"], by["counts"], strict=True) if level <= 1 - depth)
    return by["escaped"], by["in_string"], max(depth + by["rise"], by["least"]), n + found


# ------------------------------------------------------------------ reading
class Unpacked:
    """The bytes that a gzip file holds, read forwards.  The last RANGE bytes
    stay at hand; a place before them is reached from the file's start."""

    def __init__(self, path: str):
        self.path, self.raw = path, None
        self.start()

    def start(self) -> None:
        self.close()
        self.raw = open_raw(self.path)
        self.stream, self.parts, self.head, self.tail = pa.CompressedInputStream(self.raw, "gzip"), deque(), 0, 0

    def more(self) -> bool:
        data = self.stream.read(READ)
        self.parts.append(data)
        self.tail += len(data)
        while self.tail - self.head - len(self.parts[0]) > RANGE:
            self.head += len(self.parts.popleft())
        return bool(data)

    def read_at(self, n: int, at: int) -> bytes:
        if at < self.head:
            self.start()
        found = []
        while self.tail <= at and self.more():
            pass
        place = self.head
        for part in self.parts:
            found.append(part[max(0, at - place):max(0, at + n - place)])
            place += len(part)
        while self.tail < at + n and self.more():
            found.append(self.parts[-1][:at + n - self.tail + len(self.parts[-1])])
        return b"".join(found)

    def size(self) -> int:
        while self.more():
            pass
        return self.tail

    def close(self) -> None:
        if self.raw is not None:
            self.raw.close()

    def __enter__(self) -> Unpacked:
        return self

    def __exit__(self, *error) -> None:
        self.close()


def open_raw(path: str):
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    if "://" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def open_file(path: str):
    return Unpacked(path) if path.endswith(".gz") else open_raw(path)


class LastOpened:
    """Keeps the file that was read last open: a task's ranges come file by file."""

    def __init__(self):
        self.path = self.stream = None

    def __call__(self, path: str):
        if path != self.path:
            self.close()
            self.path, self.stream = path, open_file(path)
        return self.stream

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()


def _pieces(stream, at: int, end: int, most: int | None = None) -> Iterator[bytes]:
    """Pieces of READ bytes; ``most`` bytes at first, if given, then twice as many each time."""
    while at < end:
        data = stream.read_at(min(most or READ, READ, end - at), at)
        if not data:
            return
        yield data
        at += len(data)
        most = 2 * most if most else None


def array_start(stream, size: int) -> int:
    """Place of the first element, or -1 where the file is no array."""
    at = 0
    for data in _pieces(stream, 0, size):
        if at == 0 and data.startswith(b"\xef\xbb\xbf"):
            data = data[3:]
            at = 3
        rest = data.lstrip(_BLANK)
        if rest:
            return at + len(data) - len(rest) + 1 if rest[:1] == b"[" else -1
        at += len(data)
    return -1


def judged(text: bytes) -> tuple[str, str | None]:
    """(text, reason) of an element: reason is None for an object."""
    try:
        whole = text.decode()
    except UnicodeDecodeError:
        return text.decode(errors="replace")[:REJECT_TEXT], "not_utf8"
    if not whole:
        return whole, "empty_element"
    try:
        value = json.loads(whole)
    except (ValueError, RecursionError):
        return whole[:REJECT_TEXT], "malformed"
    return (whole, None) if isinstance(value, dict) else (whole[:REJECT_TEXT], "not_an_object")


class Element:
    """Bytes of the element being read; of one that is too long only the head is held."""

    def __init__(self, nth: int, at: int, longest: int):
        self.nth, self.at, self.longest, self.size, self.parts = nth, at, longest, 0, []

    def add(self, data: bytes) -> None:
        self.size += len(data)
        if not self.too_long:
            self.parts.append(data)
        elif len(self.parts) != 1 or len(self.parts[0]) != 4 * REJECT_TEXT:
            self.parts = [b"".join([*self.parts, data])[:4 * REJECT_TEXT]]

    @property
    def too_long(self) -> bool:
        return self.size > self.longest

    def row(self) -> tuple[int, int, str, str | None]:
        text = b"".join(self.parts)
        if self.too_long:
            return self.nth, self.at, text.lstrip(_BLANK).decode(errors="ignore")[:REJECT_TEXT], "element_too_long"
        return self.nth, self.at, *judged(text.strip(_BLANK))


def elements(stream, size: int, start: int, end: int, state: tuple[bool, bool, int, int], first: bool, longest: int = LONGEST) -> Iterator[tuple]:
    """(position, byte, text, reason) of the elements that start in [start, end);
    ``first``: the array's first element starts at ``start``."""
    escaped, in_string, depth, nth = state
    at, held = start, Element(nth, start, longest) if first else None
    closed = None  # after the last separator: place of the array's own closing bracket, in the element's bytes
    # past the range only what its last element takes
    for data in chain(_pieces(stream, start, end), _pieces(stream, end, size, PAST)):
        scan = Scan(data, escaped)
        out = scan.outside(in_string)
        mark, kind = scan.mark[out], scan.kind[out].astype(np.int64)
        rel = np.cumsum(kind)
        deep = rel + np.maximum(depth, 1 - np.minimum.accumulate(rel)) if len(rel) else rel
        before = np.concatenate([[depth], deep[:-1]])
        done = 0
        for m, closing in zip(mark[(deep == 1) & (before == 1)].tolist(), (kind[(deep == 1) & (before == 1)] < 0).tolist(), strict=True):
            if closing:
                if held and closed is None and data[m:m + 1] == b"]":
                    closed = held.size + m - done
                continue
            if held:
                held.add(data[done:m])
                yield held.row()
            nth, done, held, closed = nth + 1, m + 1, None, None
            if at + m >= end:  # the next element starts in a later range
                return
            held = Element(nth, at + m + 1, longest)
        if held:
            held.add(data[done:])
        depth = int(deep[-1]) if len(deep) else depth
        escaped, in_string, at = scan.ends_escaped, scan.ends_in_string(in_string), at + len(data)
        if at >= end and not held:
            return
    if held is None:
        return
    # the last element: up to the array's closing bracket
    if held.too_long:
        yield held.row()
    elif closed is None:
        text, reason = judged(b"".join(held.parts).strip(_BLANK))
        if reason is None:
            yield held.nth, held.at, text, None
            yield held.nth + 1, size, None, "array_not_closed"
        else:
            yield held.nth, held.at, text, "array_not_closed"
    else:
        whole = b"".join(held.parts)
        last, rest = whole[:closed].strip(_BLANK), whole[closed + 1:].strip(_BLANK)
        if last or held.nth:
            yield held.nth, held.at, *judged(last)
        if rest:
            yield held.nth + 1, held.at + closed + 1, rest.decode(errors="replace")[:REJECT_TEXT], "text_after_array"


# -------------------------------------------------------------------- Spark
_SUMMARY = "path string, nth int, start long, stop long, size long, first boolean, ends string"
_ROW = "file_path string, position long, byte long, text string, reason string"


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def split_files(files: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """(path, ...) -> one row per byte range: path, nth, start, stop, size.  A
    file that is no array has one range that starts at -1."""
    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                with open_file(path) as stream:
                    rows.append((path, stream.size(), array_start(stream, stream.size())))
            yield _batch(rows, ["path", "size", "head"], [pa.string(), pa.int64(), pa.int64()])

    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = files.select("path").repartition(tasks, "path").mapInArrow(heads, "path string, size long, head long")
    starts = F.when((F.col("head") < 0) | (F.col("head") >= F.col("size")), F.array("head")).otherwise(
        F.sequence("head", F.col("size") - 1, F.lit(range_bytes).cast("long")))
    return (found.select("path", "size", F.posexplode(starts).alias("nth", "start"))
            .withColumn("stop", F.least(F.col("start") + range_bytes, "size")))


def array_rows(files: DataFrame, range_bytes: int = RANGE, longest: int = LONGEST) -> DataFrame:
    """file_path, position (the element's number), byte (its place), text,
    reason (null for an object) of every element of the files in ``path``."""
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    names = ["path", "nth", "start", "stop", "size", "first", "ends"]
    by = [F.col("path"), F.when(F.col("path").endswith(".gz"), 0).otherwise(F.col("nth"))]
    # as many tasks as the session's shuffles have: the rows are small, what they stand for is not
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = split_files(files, range_bytes).repartition(tasks, *by).sortWithinPartitions("path", "nth")

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = LastOpened()
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                ends = "[]"
                if r["start"] >= 0:
                    ends = json.dumps(summaries(_pieces(opened(r["path"]), r["start"], r["stop"])))
                rows.append((r["path"], r["nth"], r["start"], r["stop"], r["size"], r["nth"] == 0, ends))
            yield _batch(rows, names, types)
        opened.close()

    def compose(part: pa.Table) -> pa.Table:
        state, rows = (False, False, 1, 0), []
        for r in sorted(part.to_pylist(), key=lambda r: r["nth"]):
            rows.append((r["path"], r["nth"], r["start"], r["stop"], r["size"], r["first"], json.dumps(state)))
            if r["start"] >= 0:
                state = follow(state, json.loads(r["ends"])[2 * state[0] + state[1]])
        return pa.Table.from_batches([_batch(rows, names, types)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = lambda rows: _batch(rows, ["file_path", "position", "byte", "text", "reason"], [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()])
        opened = LastOpened()
        for batch in batches:
            for r in batch.to_pylist():
                if r["start"] < 0:
                    yield pack([(r["path"], 0, 0, None, "not_an_array")])
                    continue
                rows, held = [], 0
                for row in elements(opened(r["path"]), r["size"], r["start"], r["stop"], tuple(json.loads(r["ends"])), r["first"], longest):
                    rows.append((r["path"], *row))
                    held += len(row[2] or "")
                    if held > READ:
                        yield pack(rows)
                        rows, held = [], 0
                yield pack(rows)
        opened.close()

    started = ranges.mapInArrow(summarise, _SUMMARY).groupBy("path").applyInArrow(compose, _SUMMARY)
    return started.repartition(tasks, *by).sortWithinPartitions("path", "nth").mapInArrow(read, _ROW)
