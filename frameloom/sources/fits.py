"""FITS files as rows of bytes, for stores that only Spark's readers can open: headers by SQL functions over the files' bytes, pixels
decoded row of pixels by row. Folders that all machines can open are read by fits_source.py.

Files are rows (path, content), as `spark.read.format("binaryFile")` gives them. A file is damaged if it doesn't begin with
SIMPLE, has no END card, or holds fewer bytes than its header says; such files have no header and no pixels here, and
`damaged` lists them. Null contents are damaged; an empty table gives an empty result.
"""

from __future__ import annotations

import gzip
import io
import tarfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .fits_source import BLOCK, CARD, KINDS, file_system


def read_files(spark: SparkSession, pattern: str) -> DataFrame:
    """path, content of the files that match."""
    return spark.read.format("binaryFile").load(pattern).select("path", "content")


FOLDERS = 1024


def save_files(files: DataFrame, folder: str) -> int:
    """Write the files (path, content) into a folder that all machines share, each under its name in one of FOLDERS folders (by the name's
    CRC-32), which can be listed by many tasks; how many there were. A task that is run again writes the same files again."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        made = set()
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                place = f"{root}/{zlib.crc32(path.encode()) % FOLDERS:04d}"
                if place not in made:
                    fs.create_dir(place, recursive=True)
                    made.add(place)
                with fs.open_output_stream(f"{place}/{path}") as out:
                    out.write(content)
            yield pd.DataFrame({"n": [len(batch)]})

    return files.select("path", "content").mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def save_archives(files: DataFrame, folder: str, most: int = 4096) -> int:
    """Write the files (path, content) as members of compressed archives of at most `most` files, in FOLDERS folders as save_files does; how many
    files there were. Small files by the million would take a block and an inode of the disk each. A task that is run again writes the same
    archives again."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = file_system(folder)
        part, n, tar, packed, out = TaskContext.get().partitionId(), 0, None, None, None
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                if n % most == 0:
                    if tar:
                        tar.close(), packed.close(), out.close()
                    name = f"{part:06d}-{n // most:06d}.tar.gz"
                    place = f"{root}/{zlib.crc32(name.encode()) % FOLDERS:04d}"
                    fs.create_dir(place, recursive=True)
                    out = fs.open_output_stream(f"{place}/{name}", compression=None)
                    packed = gzip.GzipFile(fileobj=out, mode="wb", compresslevel=1, mtime=0)
                    tar = tarfile.open(fileobj=packed, mode="w|", format=tarfile.GNU_FORMAT)
                member = tarfile.TarInfo(path)
                member.size = len(content)
                tar.addfile(member, io.BytesIO(content))
                tar.members.clear()  # it would remember all
                n += 1
            yield pd.DataFrame({"n": [len(batch)]})
        if tar:
            tar.close(), packed.close(), out.close()

    return files.select("path", "content").mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def header_bytes(cards: Column) -> Column:
    """The header block of an array of cards, as text."""
    body = F.concat(F.array_join(F.transform(cards, lambda c: F.rpad(c, CARD, " ")), ""), F.rpad(F.lit("END"), CARD, " "))
    return F.rpad(body, F.ceil(F.length(body) / BLOCK).cast("int") * BLOCK, F.lit(" "))


def card(key: str, value: Column) -> Column:
    """A card of a number or a logical value."""
    return F.concat(F.rpad(F.lit(key), 8, " "), F.lit("= "), F.lpad(value.cast("string"), 20, " "))


def text_card(key: str, value: Column) -> Column:
    return F.concat(F.rpad(F.lit(key), 8, " "), F.lit("= '"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))


#: A header of at most so many bytes is looked for.
MOST = 100 * BLOCK


def parsed(files: DataFrame) -> DataFrame:
    """path, content, cards (a map of text; the first of equal keys), start (of the data, in bytes), good."""
    # one character for each byte, so that places in the text are places in the file; the END card ends a run of whole cards
    text = F.decode(F.substr("content", F.lit(1), F.lit(MOST)), "ISO-8859-1")
    cards = F.regexp_extract("text", r"(?s)^SIMPLE  =.{71}(?:(?!END {77}).{80})*END {77}", 0)
    rows = files.withColumn("text", text).withColumn("end", F.greatest(F.length(cards) - CARD + 1, F.lit(0)))
    lines = F.transform(F.sequence(F.lit(0), (F.col("end") / CARD).cast("int") - 1), lambda i: F.substr("text", i * CARD + 1, F.lit(CARD)))
    lines = F.filter(F.when(F.col("end") > CARD, lines).otherwise(F.array().cast("array<string>")), lambda c: F.substr(c, F.lit(9), F.lit(2)) == "= ")
    raw = lambda c: F.substr(c, F.lit(11))
    quoted = lambda c: F.rtrim(F.replace(F.regexp_extract(raw(c), r"^ *'((?:[^']|'')*)'", 1), F.lit("''"), F.lit("'")))
    value = lambda c: F.when(F.ltrim(raw(c)).startswith("'"), quoted(c)).otherwise(F.trim(F.split_part(raw(c), F.lit("/"), F.lit(1))))
    entries = F.transform(lines, lambda c: F.struct(F.trim(F.substr(c, F.lit(1), F.lit(8))).alias("key"), value(c).alias("value")))
    first = F.filter(entries, lambda e, i: F.array_position(F.transform(entries, lambda x: x["key"]), e["key"]) == i + 1)
    rows = rows.withColumn("cards", F.map_from_entries(first)).withColumn("start", (F.ceil((F.col("end") + CARD - 1) / BLOCK) * BLOCK).cast("long"))
    number = lambda k: F.coalesce(F.try_element_at("cards", F.lit(k)).try_cast("long"), F.lit(0).cast("long"))
    size = F.when(number("NAXIS") == 0, 0).otherwise(F.abs(number("BITPIX")) / 8 * number("NAXIS1") * F.greatest(number("NAXIS2"), F.lit(1)))
    card_ = lambda k: F.try_element_at("cards", F.lit(k))
    real = lambda k: card_(k).isNull() | F.translate(card_(k), "Dd", "EE").try_cast("double").isNotNull()
    axis = lambda k: card_(k).try_cast("long") >= 0
    # of the images only those of two axes are decoded here, so others are as good as damaged
    readable = F.when(number("NAXIS") == 0, True).otherwise((number("NAXIS") == 2) & number("BITPIX").isin(*KINDS) & axis("NAXIS1") & axis("NAXIS2") & real("BSCALE") & real("BZERO"))
    return rows.withColumn("good", F.coalesce((F.col("end") > 0) & readable & (F.length("content") >= F.col("start") + size), F.lit(False))).drop("text", "end")


def scan_headers(files: DataFrame) -> DataFrame:
    """path, cards of the files that can be read."""
    return parsed(files).where("good").select("path", "cards")


def damaged(files: DataFrame) -> DataFrame:
    """path of the files that can't be read."""
    return parsed(files).where("NOT good").select("path")


def scan_pixels(files: DataFrame) -> DataFrame:
    """path, unit ("adu" where none is given), y, row (array<double>) of every two-dimensional image; BZERO and BSCALE are applied."""
    rows = parsed(files).where("good AND try_element_at(cards, 'NAXIS') = '2'").select("path", "content", "cards", "start")

    real = lambda text: float(text.replace("D", "E").replace("d", "e"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content, cards, start in batch.itertuples(index=False):
                cards = dict(cards)
                nx, ny = int(cards["NAXIS1"]), int(cards["NAXIS2"])
                data = np.frombuffer(content, KINDS[int(cards["BITPIX"])], nx * ny, int(start)).reshape(ny, nx)
                data = data.astype(float) * real(cards.get("BSCALE", "1")) + real(cards.get("BZERO", "0"))
                yield pd.DataFrame({"path": path, "unit": cards.get("BUNIT") or "adu", "y": np.arange(ny, dtype=np.int32), "row": list(data)})

    return rows.mapInPandas(decode, "path string, unit string, y int, row array<double>")


def images(pixels: DataFrame, path: Column) -> DataFrame:
    """Files (path, content) of the images in pixels (frame_id, y, x, v), as 32-bit numbers; each frame is one file. Pixels that a frame
    lacks, and null ones, are NaN."""
    at = F.struct("y", "x", F.col("v").cast("float").alias("v"))
    rows = pixels.groupBy("frame_id").agg(F.sort_array(F.collect_list(at)).alias("p"), (F.max("x") + 1).alias("nx"), (F.max("y") + 1).alias("ny"))
    cards = F.array(card("SIMPLE", F.lit("T")), card("BITPIX", F.lit(-32)), card("NAXIS", F.lit(2)), card("NAXIS1", F.col("nx")), card("NAXIS2", F.col("ny")))
    place = F.transform("p", lambda p: p["y"].cast("long") * F.col("nx") + p["x"])
    rows = rows.select(path.alias("path"), header_bytes(cards).alias("head"), place.alias("at"), F.transform("p", lambda p: p["v"]).alias("v"), (F.col("nx") * F.col("ny")).cast("long").alias("n"))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            body = []
            for at, v, n in zip(batch["at"], batch["v"], batch["n"], strict=True):
                image = np.full(n, np.nan, ">f4")
                image[np.asarray(at, np.int64)] = np.asarray(v, float)
                body.append(image.tobytes())
            yield pd.DataFrame({"path": batch["path"], "content": [h.encode() + b + b"\0" * (-len(b) % BLOCK) for h, b in zip(batch["head"], body, strict=True)]})

    return rows.mapInPandas(join, "path string, content binary")
