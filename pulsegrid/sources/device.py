"""A Spark data source for text exports of devices: ``spark.read.format("device_csv")``.

Files of one folder differ in headings, their order, delimiter, encoding and in lines before the heading. Each file is read
by its own heading, in ranges of bytes, so that one large file is many tasks; a task reads the file's head again to learn
its layout. Nothing is read by the driver but the listing.
"""

from __future__ import annotations

import csv
import fnmatch
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Delimiters and encodings of exports, those that win ties first.
DELIMITERS = (";", ",", "\t", "|")
ENCODINGS = ("utf-8", "cp1252", "latin-1")
#: A heading is among the first lines of a file's head.
HEAD_BYTES, HEAD_LINES = 256 << 10, 20
RANGE_BYTES = 64 << 20
BATCH_ROWS = 8192
_CHUNK = 4 << 20
#: What opening a file counts as where files are dealt to tasks, and ranges of a task at most.
OPEN_BYTES, TASK_RANGES = 4 << 10, 10_000

SCHEMA = "path string, offset long, time string, cells array<struct<heading:string,variable:string,value:string>>, error string"
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("offset", pa.int64()),
        ("time", pa.string()),
        ("cells", pa.list_(pa.struct([(k, pa.string()) for k in ("heading", "variable", "value")]))),
        ("error", pa.string()),
    ]
)


def headings(fields: list[str]) -> list[str]:
    """Column names without quotes and blanks; repeated ones get .1, .2 as suffix."""
    out: list[str] = []
    for raw in fields:
        name = raw.strip().strip("\"'").strip() or "unnamed"
        k = sum(1 for o in out if o == name or re.fullmatch(re.escape(name) + r"\.\d+", o))
        out.append(f"{name}.{k}" if k else name)
    return out


def name_key(name: str) -> str:
    """What names are compared as: case, quotes and repeated blanks don't count."""
    return re.sub(r"\s+", " ", name.replace('"', "").replace("'", "")).strip().lower()


def resolve(names: list[str], aliases: dict[str, str]) -> dict[str, str]:
    """Heading to standard name; matching ignores case, quotes, repeated spaces, units and copy suffixes; the first
    heading of a standard name wins and unknown headings keep theirs."""
    index = {name_key(k): v for k, v in aliases.items()}
    out, taken = {}, set()
    for name in names:
        plain = re.sub(r"(\.\d+)+$", "", name)
        found = next((index[k] for k in (name_key(name), name_key(plain), name_key(re.sub(r"\s*\(.*$", "", plain))) if k in index), None)
        target = found if found and found not in taken else name
        taken.add(target)
        out[name] = target
    return out


def fields(line: str, delimiter: str) -> list[str]:
    """The fields of one line; a quoted field may hold delimiters but no line break."""
    return next(csv.reader([line], delimiter=delimiter)) if '"' in line else line.split(delimiter)


def decoded(raw: bytes, first: str) -> str:
    """A line by the encoding of the head, or by the first that takes it where a later part of the file has others."""
    for encoding in (first, *ENCODINGS):
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    return raw.decode("latin-1")


@dataclass(frozen=True)
class Layout:
    """How one file is read: data begin at byte ``begin``; ``times`` are the places of its time columns."""

    encoding: str
    delimiter: str
    begin: int
    names: tuple[str, ...]
    times: tuple[int, ...]


def layout(head: bytes, time_heading: str | None = None, time_pattern: str | None = None) -> Layout | str:
    """The layout that a file's first bytes show, or why there is none.

    The heading is the first of the first lines in which, cut by a delimiter into two fields or more, a field is the time
    heading (or up to two match the pattern; without either the first such line is taken). Delimiters are tried by how
    often the line has them. A byte order mark names the encoding, else it is the first that the head decodes by.
    """
    if not head.strip():
        return "empty file"
    marked = next((e for mark, e in ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")) if head.startswith(mark)), None)
    mark = {"utf-8": 3, None: 0}.get(marked, 2)
    if marked and marked != "utf-8":
        wide = head[mark : mark + (len(head) - mark) // 2 * 2].decode(marked, "replace")
        lines, encoding = wide.split("\n"), marked
    else:
        end = head.rfind(b"\n") + 1 or len(head)  # a character may be cut at the end
        encoding = next(e for e in ENCODINGS if e == ENCODINGS[-1] or _takes(head[mark:end], e))
        lines = [decoded(x, encoding) for x in head[mark:].split(b"\n", HEAD_LINES)]
    at, why = mark, "no heading"
    for line in lines[:HEAD_LINES]:
        size = len(line.encode(encoding, "replace")) + len("\n".encode(encoding))
        text = line.rstrip("\r")
        for delimiter in sorted(DELIMITERS, key=lambda d: -text.count(d)):
            names = headings(fields(text, delimiter)) if delimiter in text else []
            if len(names) < 2:
                continue
            if time_heading is not None:
                times = [i for i, n in enumerate(names) if name_key(n) == name_key(time_heading)][:1]
            elif time_pattern is not None:
                times = [i for i, n in enumerate(names) if re.search(time_pattern, n.lower())][:2]
            else:
                return Layout(encoding, delimiter, at + size, tuple(names), ())
            if times:
                return Layout(encoding, delimiter, at + size, tuple(names), tuple(times))
            why = "no time column"
        at += size
    return why


def _takes(raw: bytes, encoding: str) -> bool:
    try:
        raw.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


def lines_between(file, begin: int, end: int, newline: bytes = b"\n") -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that start in [begin, end); ``begin`` must be where a line starts."""
    file.seek(begin)
    at, rest = begin, b""
    while at < end:
        # A short range ends within its next line, mostly.
        chunk = file.read(min(_CHUNK, max(end - at, 0) + (64 << 10)))
        if not chunk:
            if rest:
                yield at, rest
            return
        parts = (rest + chunk).split(newline) if len(newline) == 1 else _split_wide(rest + chunk, newline)
        rest = parts.pop()
        for line in parts:
            if at >= end:
                return
            yield at, line
            at += len(line) + len(newline)


def _split_wide(raw: bytes, newline: bytes) -> list[bytes]:
    """Lines of two-byte characters; a match at an odd place is none."""
    out, begin, at = [], 0, raw.find(newline)
    while at >= 0:
        if (at - begin) % 2 == 0:
            out.append(raw[begin:at])
            begin, at = at + 2, raw.find(newline, at + 2)
        else:
            at = raw.find(newline, at + 1)
    return [*out, raw[begin:]]


@dataclass(frozen=True)
class Range:
    path: str
    begin: int
    end: int


@dataclass
class Ranges(InputPartition):
    """What one task reads: ranges of a large file, or several small files."""

    ranges: tuple[Range, ...]


def dealt(ranges: list[Range], tasks: int, most_bytes: int = RANGE_BYTES) -> list[Ranges]:
    """Ranges in their order in about so many tasks, or in more that stay under so many bytes each: however short ranges
    are, the number of tasks doesn't grow with theirs."""
    weights = [r.end - r.begin + OPEN_BYTES for r in ranges]
    share = min(most_bytes, sum(weights) / max(1, tasks))
    out: list[list[Range]] = []
    held = 0
    for r, weight in zip(ranges, weights):
        if not out or held + weight > share or len(out[-1]) == TASK_RANGES:
            out.append([])
            held = 0
        out[-1].append(r)
        held += weight
    return [Ranges(tuple(x)) for x in out]


def _store(path: str):
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub(r"^file:", "", path)


class _Rows:
    """Rows of one file after another, until they make a batch."""

    def __init__(self):
        self._clear()

    def _clear(self) -> None:
        self.paths, self.offsets, self.times, self.errors = [], [], [], []
        self.begins, self.names, self.variables, self.values = [], [], [], []

    def add(self, path: str, offset: int, time: str | None, names: list[str], variables: list[str], values: list[str | None]) -> None:
        self.paths.append(path)
        self.offsets.append(offset)
        self.times.append(time)
        self.errors.append(None)
        self.begins.append(len(self.values))
        self.names += names
        self.variables += variables
        self.values += values

    def add_error(self, path: str, why: str) -> None:
        self.paths.append(path)
        self.offsets.append(None)
        self.times.append(None)
        self.errors.append(why)
        self.begins.append(None)  # a null list

    def drain(self) -> pa.RecordBatch:
        cells = pa.StructArray.from_arrays([pa.array(x, pa.string()) for x in (self.names, self.variables, self.values)], names=["heading", "variable", "value"])
        cells = pa.ListArray.from_arrays(pa.array([*self.begins, len(self.values)], pa.int32()), cells)
        flat = [pa.array(x, t) for x, t in ((self.paths, pa.string()), (self.offsets, pa.int64()), (self.times, pa.string()), (self.errors, pa.string()))]
        self._clear()
        return pa.RecordBatch.from_arrays([*flat[:3], cells, flat[3]], schema=_ARROW)


class DeviceReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.time_heading = options.get("timeheading")
        self.time_pattern = options.get("timepattern")
        self.aliases = json.loads(options.get("aliases", "{}"))
        self.only = options.get("pathglobfilter", "*")
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.tasks = int(options.get("tasks", 1))
        self.first_rows = options.get("firstrows", "false").lower() == "true"

    def partitions(self) -> list[Ranges]:
        from pyarrow import fs

        store, at = _store(self.path)
        info = store.get_file_info(at)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(at, recursive=True))
        files = sorted((f for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._" and fnmatch.fnmatch(f.base_name, self.only)), key=lambda f: f.path)
        prefix = re.match(r"^\w+://", self.path)
        name = lambda f: (prefix[0] if prefix and prefix[0] != "file://" else "file://") + f.path
        if self.first_rows:
            return dealt([Range(name(f), 0, f.size) for f in files], self.tasks)
        return dealt([Range(name(f), b, min(f.size, b + self.range_bytes)) for f in files for b in range(0, max(1, f.size), self.range_bytes)], self.tasks)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        rows = _Rows()
        for path, ranges in groupby(partition.ranges, key=lambda r: r.path):
            for _ in self._rows(path, list(ranges), rows):
                if len(rows.paths) == BATCH_ROWS:
                    yield rows.drain()
        if rows.paths:
            yield rows.drain()

    def _rows(self, path: str, ranges: list[Range], rows: _Rows) -> Iterator[None]:
        """Adds the rows of a file's ranges, one at a time; its layout is learnt once."""
        store, at = _store(path)
        with store.open_input_file(at) as file:
            found = layout(file.read(HEAD_BYTES), self.time_heading, self.time_pattern)
            if isinstance(found, str):
                if ranges[0].begin == 0:  # once a file
                    rows.add_error(path, found)
                    yield
                return
            places = [i for i in range(len(found.names)) if i not in found.times]
            names = [found.names[i] for i in places]
            resolved = resolve(names, self.aliases)
            variables = [resolved[n] for n in names]
            for partition in ranges:
                for offset, raw in self._lines(file, partition, found):
                    text = decoded(raw, found.encoding).rstrip("\r")
                    if not text.strip():
                        continue
                    cut = fields(text, found.delimiter)
                    width = len(cut)
                    time = " ".join([cut[i].strip() for i in found.times if i < width]) if found.times else None
                    rows.add(path, offset, time, names, variables, [cut[i] if i < width else None for i in places])
                    yield
                    if self.first_rows:
                        return

    @staticmethod
    def _lines(file, partition: Range, found: Layout) -> Iterator[tuple[int, bytes]]:
        newline = {"utf-16-le": b"\n\x00", "utf-16-be": b"\x00\n"}.get(found.encoding, b"\n")
        if partition.begin <= found.begin:
            yield from lines_between(file, found.begin, partition.end, newline)
            return
        # The line that starts before the range is the range before's.
        back = partition.begin - len(newline)
        back -= (back - found.begin) % len(newline)
        first = True
        for offset, line in lines_between(file, back, partition.end, newline):
            if not first and offset >= partition.begin:
                yield offset, line
            first = False


class DeviceCsv(DataSource):
    """Options: timeHeading or timePattern, aliases (JSON of heading to variable), pathGlobFilter, rangeBytes, tasks (how many
    to make at least, where there are as many ranges), firstRows (true: of each file its first row alone).

    A row for each line below the heading: path, offset (its first byte), time (the text of the time columns, joined by a
    space), cells (heading, variable and text of the other columns in their order; null where the line is too short). A
    file without a heading or time column is one row with its error. Empty lines are left out.
    """

    @classmethod
    def name(cls) -> str:
        return "device_csv"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DeviceReader:
        return DeviceReader({k.lower(): v for k, v in self.options.items()})


def device_csv(spark: SparkSession, path: str, time_heading: str | None = None, time_pattern: str | None = None, aliases: dict[str, str] | None = None, range_bytes: int = RANGE_BYTES, first_rows: bool = False) -> DataFrame:
    spark.dataSource.register(DeviceCsv)
    reader = spark.read.format("device_csv").option("rangeBytes", range_bytes).option("aliases", json.dumps(aliases or {}))
    reader = reader.option("tasks", 4 * spark.sparkContext.defaultParallelism).option("firstRows", first_rows)
    if time_heading is not None:
        reader = reader.option("timeHeading", time_heading)
    if time_pattern is not None:
        reader = reader.option("timePattern", time_pattern)
    return reader.load(path)
