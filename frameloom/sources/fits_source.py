"""FITS folders as a Spark data source: `spark.read.format("fits").options(table=..., ...).load(folder)`.

table=headers (the default): path, hdu, naxis, shape (NAXIS1 first), cards (a map; the first of equal keys), history (HISTORY lines in order).
table=pixels: path, hdu, unit ("adu" where none is given), plane, y, row (array<double>), a row for every row of pixels of every image; BSCALE and
BZERO are applied, and BLANK and NaN are null. table=refused: path, hdu, reason, for what can't be read.

Files are split by bytes: a task gets small files together, or a range of rows of a large file's images, and reads the header blocks
and its own rows only. Of headers and refused files, the driver lists the folder's own files and the names of its subfolders only; the
subfolders are dealt to tasks (DEALT at most), which list them one after another, so millions of files belong in subfolders, and small ones in
archives there: the files in an archive (.tar, .tar.gz, .tgz) are read one after another by one task, each whole, and have the archive's path before their
own; one that breaks off is refused itself, after the files before that. Pixels need all sizes first. The option `keys` (comma-separated) adds those cards as text columns. Filters by equality or IN on path, hdu and these
columns, and comparisons with y, are pushed down: a file whose path doesn't match is not opened, pixels of an image whose header doesn't match
are not read, and rows of pixels beyond the bounds aren't either.

Defined cases: a file that isn't FITS, has no END card, a number that can't be read, an unknown BITPIX or fewer bytes than its header says
is refused with the reason, from that unit on; the units before it are kept, and no file ends a job. NAXIS = 0 has a header and no pixels; one
axis is one row; axes beyond the second count planes; tables (XTENSION other than IMAGE) have a header only. An empty folder gives empty
results.
"""

from __future__ import annotations

import fnmatch
import io
import tarfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

BLOCK, CARD, DEALT = 2880, 80, 256
ARCHIVES = (".tar", ".tar.gz", ".tgz")
#: FITS numbers of bits per pixel, and what they stand for.
KINDS = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
SCHEMAS = {
    "headers": "path string, hdu int, naxis int, shape array<bigint>, cards map<string, string>, history array<string>",
    "pixels": "path string, hdu int, unit string, plane int, y int, row array<double>",
    "refused": "path string, hdu int, reason string",
}
ARROW = {
    "headers": [("path", pa.string()), ("hdu", pa.int32()), ("naxis", pa.int32()), ("shape", pa.list_(pa.int64())), ("cards", pa.map_(pa.string(), pa.string())), ("history", pa.list_(pa.string()))],
    "pixels": [("path", pa.string()), ("hdu", pa.int32()), ("unit", pa.string()), ("plane", pa.int32()), ("y", pa.int32()), ("row", pa.list_(pa.float64()))],
    "refused": [("path", pa.string()), ("hdu", pa.int32()), ("reason", pa.string())],
}


class Refused(ValueError):
    """Why a unit of a file can't be read."""


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def value_of(card: str) -> str:
    """The value of a card as text: a string without its quotes and trailing blanks, else what stands before the comment."""
    body = card[10:].strip()
    if not body.startswith("'"):
        return body.split("/", 1)[0].strip()
    end = 1
    while (end := body.find("'", end)) >= 0 and body[end + 1 : end + 2] == "'":
        end += 2
    return body[1 : end if end >= 0 else None].replace("''", "'").rstrip()


def number(cards: dict[str, str], key: str, default: float | None = None) -> float:
    """A real number; exponents may be written with D."""
    text = cards.get(key)
    if text is None and default is not None:
        return default
    try:
        return float(text.replace("D", "E").replace("d", "e"))
    except (AttributeError, ValueError):
        raise Refused(f"{key} = {text}") from None


def whole(cards: dict[str, str], key: str, default: int | None = None, least: int = 0) -> int:
    text = cards.get(key)
    if text is None and default is not None:
        return default
    try:
        if (n := int(text)) >= least:
            return n
    except (TypeError, ValueError):
        pass
    raise Refused(f"{key} = {text}")


@dataclass
class Unit:
    """A header and where its data are."""

    hdu: int
    cards: dict[str, str]
    history: list[str]
    start: int
    size: int
    shape: list[int]

    @property
    def image(self) -> bool:
        return bool(self.shape) and all(self.shape) and self.cards.get("XTENSION", "IMAGE") == "IMAGE"


def header(f, at: int, size: int, hdu: int) -> Unit:
    """The header that begins at byte `at`: its blocks are read, up to the one with the END card, and nothing else."""
    cards: dict[str, str] = {}
    history: list[str] = []
    f.seek(at)
    first = True
    while True:
        block = f.read(BLOCK)
        if first and not block.startswith(b"XTENSION=" if hdu else b"SIMPLE  ="):
            raise Refused("no FITS header" if block else "empty file")
        first = False
        text = block.decode("latin-1")
        for i in range(0, len(text) - CARD + 1, CARD):
            card = text[i : i + CARD]
            key = card[:8].rstrip()
            if key == "END":
                break
            if key == "HISTORY":
                history.append(card[8:].strip())
            elif card[8:10] == "= ":
                cards.setdefault(key, value_of(card))
        else:
            if len(block) < BLOCK:
                raise Refused("no END card")
            continue
        break
    start = min(f.tell(), size) if len(block) == BLOCK else f.tell()
    naxis = whole(cards, "NAXIS", 0)
    if naxis > 999:
        raise Refused(f"NAXIS = {naxis}")
    shape = [whole(cards, f"NAXIS{k}") for k in range(1, naxis + 1)]
    bits = whole(cards, "BITPIX", least=-64)
    if bits not in KINDS:
        raise Refused(f"BITPIX = {bits}")
    pixels = 1 if shape else 0
    for n in shape:
        pixels *= n
    total = abs(bits) // 8 * whole(cards, "GCOUNT", 1) * (whole(cards, "PCOUNT", 0) + pixels) if shape else 0
    if start + total > size:
        raise Refused(f"{size - start} bytes of data in place of {total}")
    return Unit(hdu, cards, history, start, total, shape)


def units(f, size: int) -> Iterator[Unit]:
    """All units of a file, one after another."""
    at, hdu = 0, 0
    while at < size or not hdu:
        unit = header(f, at, size, hdu)
        yield unit
        at, hdu = unit.start + -(-unit.size // BLOCK) * BLOCK, hdu + 1
        if at < size:  # what follows may be filling
            f.seek(at)
            if not f.read(9).strip(b"\0 "):
                return


def image_rows(f, unit: Unit, low: int, high: int, most: int = 4 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, values and which are null, of the unit's rows low to high (over all planes), about `most` bytes at a time."""
    kind = np.dtype(KINDS[int(unit.cards["BITPIX"])])
    width = unit.shape[0]
    scale, zero = number(unit.cards, "BSCALE", 1.0), number(unit.cards, "BZERO", 0.0)
    blank = whole(unit.cards, "BLANK", least=-(1 << 63)) if "BLANK" in unit.cards and kind.kind in "iu" else None
    step = max(1, most // (width * kind.itemsize))
    for at in range(low, high, step):
        n = min(step, high - at)
        f.seek(unit.start + at * width * kind.itemsize)
        raw = np.frombuffer(f.read(n * width * kind.itemsize), kind).reshape(n, width)
        value = raw.astype(float)
        none = np.isnan(value) if blank is None else raw == blank
        yield at, value * scale + zero, none


@dataclass
class Piece(InputPartition):
    """Files, each with which part of how many of its rows, and folders whose files are listed by the task."""

    files: list[tuple[str, int, int, int]] = field(default_factory=list)
    folders: list[str] = field(default_factory=list)


class FitsReader(DataSourceReader):
    def __init__(self, options: dict):
        self.table = options.get("table", "headers")
        if self.table not in SCHEMAS:
            raise ValueError(f"table must be one of {', '.join(SCHEMAS)}")
        self.path, self.glob = options["path"], options.get("pathglobfilter", "*")
        self.keys = [k for k in options.get("keys", "").split(",") if k]
        self.split = int(options.get("splitbytes", 32 << 20))
        self.equal: dict[str, set] = {}
        self.low, self.high = 0, 1 << 40

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name in ("path", "hdu", *self.keys) and isinstance(f, EqualTo | In):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.equal[name] = self.equal.get(name, values) & values
            elif name == "y" and self.table == "pixels" and isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
                if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                    self.low = max(self.low, f.value + isinstance(f, GreaterThan))
                if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                    self.high = min(self.high, f.value + 1 - isinstance(f, LessThan))
            else:
                yield f

    def named(self, path: str) -> bool:
        """Whether the name pattern and the path filter let a file through."""
        name = path.rsplit("/", 1)[-1]
        return fnmatch.fnmatch(name, self.glob) and not name.startswith(("_", ".")) and ("path" not in self.equal or path in self.equal["path"])

    def wanted(self, x: pafs.FileInfo) -> bool:
        """Whether it is a file to be read: an archive may hold such files."""
        if x.is_file and x.path.endswith(ARCHIVES):
            return not x.base_name.startswith(("_", ".")) and ("path" not in self.equal or any(p == x.path or p.startswith(f"{x.path}/") for p in self.equal["path"]))
        return x.is_file and self.named(x.path)

    def opened(self, fs: pafs.FileSystem, name: str, size: int) -> Iterator[tuple[str, int, object]]:
        """Path, size and open file of a file, or of those of an archive."""
        if not name.endswith(ARCHIVES):
            with fs.open_input_file(name) as f:
                yield name, size, f
            return
        with fs.open_input_stream(name, compression=None if name.endswith(".tar") else "gzip") as f, tarfile.open(fileobj=f, mode="r|") as tar:
            for member in tar:
                if member.isfile() and self.named(f"{name}/{member.name}"):
                    data = tar.extractfile(member).read()
                    yield f"{name}/{member.name}", len(data), io.BytesIO(data)
                tar.members.clear()  # it would remember all

    def listed(self, path: str, recursive: bool) -> tuple[list[tuple[str, int]], list[str]]:
        """Path and size of the files that the path filter lets through, and the folders."""
        fs, root = file_system(path)
        info = fs.get_file_info(root)
        found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(root, recursive=recursive, allow_not_found=True))
        return sorted((x.path, x.size) for x in found if self.wanted(x)), sorted(x.path for x in found if x.type == pafs.FileType.Directory)

    def partitions(self) -> list[Piece]:
        out, room = [], 0
        files, folders = self.listed(self.path, self.table == "pixels")
        for name, size in files:
            packed = name.endswith(ARCHIVES)
            parts = max(1, -(-size // self.split)) if self.table == "pixels" and not packed else 1
            cost = max(size // parts, BLOCK) if self.table == "pixels" or packed else 4 * BLOCK
            for part in range(parts):
                if room < cost:
                    out.append(Piece())
                    room = self.split
                out[-1].files.append((name, size, part, parts))
                room -= cost
        if self.table != "pixels" and folders:
            out += [Piece(folders=folders[k::DEALT]) for k in range(min(DEALT, len(folders)))]
        return out

    def files_of(self, piece: Piece) -> Iterator[tuple[str, int, int, int]]:
        yield from piece.files
        fs, _ = file_system(self.path)
        for folder in piece.folders:
            found = fs.get_file_info(pafs.FileSelector(folder, recursive=True))
            for x in found:
                if self.wanted(x):
                    yield x.path, x.size, 0, 1

    def fits(self, unit: Unit) -> bool:
        """Whether the filters on hdu and keys let the unit through."""
        return all((unit.hdu if name == "hdu" else unit.cards.get(name)) in values for name, values in self.equal.items() if name != "path")

    def rows_of(self, f, name: str, unit: Unit, part: int, parts: int) -> Iterator[dict]:
        keys = {k: unit.cards.get(k) for k in self.keys}
        if self.table == "headers":
            yield {"path": name, "hdu": unit.hdu, "naxis": len(unit.shape), "shape": unit.shape, "cards": list(unit.cards.items()), "history": unit.history} | keys
            return
        if self.table != "pixels" or not unit.image:
            return
        height = unit.shape[1] if len(unit.shape) > 1 else 1
        total = height * int(np.prod(unit.shape[2:], dtype=np.int64)) if len(unit.shape) > 2 else height
        spans = [(part * total // parts, (part + 1) * total // parts)]
        if self.low > 0 or self.high < height:
            spans = [(max(a, p * height + self.low), min(b, p * height + min(self.high, height))) for a, b in spans for p in range(a // height, -(-b // height))]
        unit_text = unit.cards.get("BUNIT") or "adu"
        for low, high in spans:
            for at, value, none in image_rows(f, unit, low, high) if high > low else ():
                for k in range(len(value)):
                    row = pa.array(value[k], mask=none[k]) if none[k].any() else pa.array(value[k])
                    yield {"path": name, "hdu": unit.hdu, "unit": unit_text, "plane": (at + k) // height, "y": (at + k) % height, "row": row} | keys

    def checked(self, f, unit: Unit) -> None:
        """Refuses an image whose pixels couldn't be read."""
        if unit.image:
            for _ in image_rows(f, unit, 0, 0):
                pass
            number(unit.cards, "BSCALE", 1.0), number(unit.cards, "BZERO", 0.0)
            if "BLANK" in unit.cards and int(unit.cards["BITPIX"]) > 0:
                whole(unit.cards, "BLANK", least=-(1 << 63))

    def read(self, partition: Piece | None) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        schema = pa.schema([*ARROW[self.table], *((k, pa.string()) for k in self.keys if self.table != "refused")])
        rows, size = [], 0
        for place, size_, part, parts in self.files_of(partition) if partition else ():
            files = self.opened(fs, place, size_)
            while True:
                name, hdu = place, -1
                try:
                    found = next(files, None)
                    if found is None:
                        break
                    name, total, f = found
                    for unit in units(f, total):
                        hdu = unit.hdu
                        self.checked(f, unit)
                        for row in self.rows_of(f, name, unit, part, parts) if self.fits(unit) else ():
                            rows.append(row)
                            size += 8 * len(row.get("row", ())) + 500
                            if size >= 8 << 20:
                                yield self.batch(rows, schema)
                                rows, size = [], 0
                    hdu += 1
                except (Refused, OSError, EOFError, tarfile.TarError) as e:
                    if self.table == "refused":
                        rows.append({"path": name, "hdu": hdu + (hdu < 0 or not str(e).startswith(("BSCALE", "BZERO", "BLANK"))), "reason": str(e)})
                        size += 500
        if rows:
            yield self.batch(rows, schema)

    def batch(self, rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
        if self.table != "pixels":
            return pa.RecordBatch.from_pylist(rows, schema)
        lists = [r.pop("row") for r in rows]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        plain = pa.RecordBatch.from_pylist(rows, pa.schema([f for f in schema if f.name != "row"]))
        column = pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays([x.cast(pa.float64()) for x in lists]))
        return pa.RecordBatch.from_arrays([column if f.name == "row" else plain.column(f.name) for f in schema], schema=schema)


class FitsSource(DataSource):
    """Options: path (a folder or a file), table, keys, pathGlobFilter, splitBytes (of a task)."""

    @classmethod
    def name(cls) -> str:
        return "fits"

    def schema(self) -> str:
        table = self.options.get("table", "headers")
        keys = [k for k in self.options.get("keys", "").split(",") if k] if table != "refused" else []
        return ", ".join([SCHEMAS.get(table, SCHEMAS["headers"]), *(f"`{k}` string" for k in keys)])

    def reader(self, schema) -> FitsReader:
        return FitsReader(self.options)


def read_fits(spark: SparkSession, path: str, table: str = "headers", keys: tuple[str, ...] = (), **options) -> DataFrame:
    spark.dataSource.register(FitsSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("fits").options(table=table, keys=",".join(keys), **options).load(path)
