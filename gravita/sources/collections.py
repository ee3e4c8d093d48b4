"""Single JSON documents of any size, read and written by many tasks, on any path that Spark reads.

Reading. A file is read as text whose lines end at closing braces, so Spark splits it by bytes as it splits
any text, wherever its line breaks are. What a line means depends on what came before: whether it begins inside
a string, and which braces and brackets are open. A first pass sums each split up for both cases (the brackets
it closes, those it leaves open, whether it ends in a string); the driver puts those sums together, one short
record a split, and so knows how each split begins. A second pass then cuts out features split by split. Only a
feature that crosses a border of splits is put together by a shuffle, and what stands outside of features
(names, the reference system) is gathered by file.

Writing. Tasks write their part of a document as text; the parts, with what stands before, between and behind
them, become one file beside the target, which then takes the target's name. No row passes the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import kept, shared_folder

_TOKEN = re.compile(r'("(?:[^"\\]|\\.)*")|("(?:[^"\\]|\\.)*\Z)|([{}])|[\[\]][-+.0-9eE,\s\[\]]*', re.S)
_REST = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_NOT_BRACKETS = re.compile(r"[^\[\]]+")
FEATURE = "file string, first long, at long, text string, whole boolean"


def tokens(text: str, inside: bool) -> Iterator[tuple[str, int, int]]:
    """Braces and brackets with their places, and a quote where the text ends inside a string. Of brackets around
    numbers only those are told that don't match one another."""
    begin = 0
    if inside:
        end = _REST.match(text)
        if not end:
            yield '"', 0, len(text)
            return
        begin = end.end()
    for m in _TOKEN.finditer(text, begin):
        if m.lastindex == 3:
            yield m.group(), m.start(), m.end()
        elif m.lastindex == 2:
            yield '"', m.start(), m.end()
        elif not m.lastindex:
            rest = _NOT_BRACKETS.sub("", m.group())
            while "[]" in rest:
                rest = rest.replace("[]", "")
            for t in rest:
                yield t, m.start(), m.end()


def summed(text: str, state: tuple[int, str, bool]) -> tuple[int, str, bool]:
    """(brackets closed of those before, brackets left open, inside a string), a further text taken into account."""
    closed, opened, inside = state
    ends = False
    for t, _, _ in tokens(text, inside):
        if t == '"':
            ends = True
        elif t in "[{":
            opened += t
        elif opened:
            opened = opened[:-1]
        else:
            closed += 1
    return closed, opened, ends


def _lines(batches) -> Iterator[tuple[tuple[str, int], str]]:
    """((file, split), text) of the rows of a partition, with the brace that ended each."""
    for b in batches:
        for file, at, text in zip(b.column("file").to_pylist(), b.column("at").to_pylist(), b.column("value").to_pylist(), strict=True):
            yield (file, at), text + "}"


def _sums(batches):
    for (file, at), rows in groupby(_lines(batches), key=lambda x: x[0]):
        outside, inside = (0, "", False), (0, "", True)
        for _, text in rows:
            same = outside == inside
            outside = summed(text, outside)
            inside = outside if same else summed(text, inside)
        yield pa.RecordBatch.from_pylist([{"file": file, "at": at, **{f"{n}{i}": v for i, s in enumerate((outside, inside)) for n, v in zip(("closed", "opened", "inside"), s, strict=True)}}])


def _beginnings(sums: Iterable) -> dict[tuple[str, int], tuple[str, bool, int]]:
    """By split, what is open where it begins, whether that is inside a string, and the split of the feature it begins in."""
    out = {}
    for file, splits in groupby(sorted(sums, key=lambda r: (r["file"], r["at"])), key=lambda r: r["file"]):
        opened, inside, first = "", False, -1
        for s in splits:
            out[file, s["at"]] = opened, inside, first
            i = int(inside)
            held = max(0, len(opened) - s[f"closed{i}"])
            if held < 3 or first < 0:
                first = s["at"]
            opened, inside = opened[:held] + s[f"opened{i}"], s[f"inside{i}"]
            first = first if opened.startswith("{[{") else -1
    return out


def _cut(beginnings: dict):
    schema = pa.schema([("file", pa.string()), ("first", pa.int64()), ("at", pa.int64()), ("text", pa.string()), ("whole", pa.bool_())])

    def rows_of(file: str, at: int, texts: Iterator[str]):
        """Features, parts of features that cross a border, and, under first -1, what stands outside."""
        opened, inside, first = beginnings[file, at]
        held, outside = [], []
        crossing = opened.startswith("{[{")

        def around(piece: str) -> None:
            if opened != "{[" or piece.strip(" \t\r\n,"):  # what separates features goes with them
                outside.append(piece)

        for text in texts:
            begin, ends = 0, False
            for t, start, end in tokens(text, inside):
                if t == '"':
                    ends = True
                elif t in "[{":
                    if t == "{" and opened == "{[":
                        around(text[begin:start])
                        begin = start
                    opened += t
                elif opened:
                    if opened == "{[{":
                        held.append(text[begin:end])
                        begin = end
                        yield file, first if crossing else at, at, "".join(held), not crossing
                        held, crossing = [], False
                    opened = opened[:-1]
                else:  # the brace given to a last line that had none
                    outside.append(text[begin:start])
                    begin = end
            inside = ends
            if opened.startswith("{[{"):
                held.append(text[begin:])
            else:
                around(text[begin:])
        if held:
            yield file, first if crossing else at, at, "".join(held), False
        yield file, -1, at, "".join(outside), False

    def run(batches):
        for (file, at), rows in groupby(_lines(batches), key=lambda x: x[0]):
            out, size = [], 0
            for row in rows_of(file, at, (text for _, text in rows)):
                out.append(row)
                size += len(row[3])
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def read_features(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(features, outside): file, place, text of each feature of the collections under a path, in order of place, and
    file, text of what stands around them. A feature is an object in an array of the document's top level."""
    lines = spark.read.text(path, lineSep="}").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    state = ", ".join(f"closed{i} long, opened{i} string, inside{i} boolean" for i in (0, 1))
    sums = lines.mapInArrow(_sums, f"file string, at long, {state}").collect()  # one row a split
    found = kept(lines.mapInArrow(_cut(_beginnings(sums)), FEATURE).withColumn("place", F.monotonically_increasing_id()))
    joined = lambda rows, *by: rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("at", "place", "text"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text")
    crossing = joined(found.filter("NOT whole AND first >= 0"), "file", "first").select("file", F.col("parts")[0]["at"].alias("at"), F.col("parts")[0]["place"].alias("place"), text)
    features = found.filter("whole").select("file", "at", "place", "text").unionByName(crossing)
    return features, joined(found.filter("first < 0"), "file").select("file", text)


# Writing


def _lined(last: str, between: str):
    """Rows as lines of one text: each but a partition's last ends as ``between`` says."""

    def run(batches):
        held = None
        for b in batches:
            rows = b.column(0).to_pylist()
            if held is not None and rows:
                rows.insert(0, held)
            if rows:
                held = rows.pop()
                yield pa.RecordBatch.from_arrays([pa.array([r + between for r in rows], pa.string())], names=["value"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held + last], pa.string())], names=["value"])

    return run


class Folder:
    """Files of any file system that Spark's own configuration reaches."""

    def __init__(self, spark: SparkSession):
        self.spark, self.conf, self.hadoop = spark, spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop

    def at(self, path: str):
        found = self.hadoop.fs.Path(path)
        return found.getFileSystem(self.conf), found

    def exists(self, path: str) -> bool:
        fs, p = self.at(path)
        return fs.exists(p)

    def text(self, path: str) -> str | None:
        fs, p = self.at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def parts(self, folder: str) -> list:
        """Files of a folder that hold anything, in order of their names."""
        fs, p = self.at(folder)
        return sorted((s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("part-") and s.getLen() > 0), key=lambda f: f.getName())

    def put(self, path: str, pieces: Iterable) -> None:
        """One file of texts and files, one after the other, in place whole or not at all."""
        fs, target = self.at(path)
        beside = self.hadoop.fs.Path(f"{path}.part")
        try:
            out = fs.create(beside, True)
            try:
                for piece in pieces:
                    if isinstance(piece, str):
                        out.write(bytearray(piece.encode()))
                    else:
                        own = piece.getFileSystem(self.conf).open(piece)
                        try:
                            self.hadoop.io.IOUtils.copyBytes(own, out, 1 << 20, False)
                        finally:
                            own.close()
            finally:
                out.close()
            context = self.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf)
            to = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
            to[0] = getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
            context.rename(fs.makeQualified(beside), fs.makeQualified(target), to)
        except BaseException:
            fs.delete(beside, False)
            raise

    def drop(self, path: str) -> None:
        fs, p = self.at(path)
        fs.delete(p, True)


def write_document(spark: SparkSession, path: str, sections: list[tuple[str, DataFrame]], end: str, between: str = ",") -> None:
    """One text file: for each section what stands before it and its rows (one text column), joined by ``between``
    and a line break, and the end. Tasks write the rows; the file appears whole, and a failure leaves the old one."""
    folder, places = Folder(spark), []
    try:
        for _, rows in sections:
            places.append(shared_folder(spark))
            rows.mapInArrow(_lined("", between), "value string").write.text(places[-1])

        def pieces():
            for (before, _), place in zip(sections, places, strict=True):
                yield before
                for i, part in enumerate(folder.parts(place)):
                    yield from ((f"{between}\n", part) if i else (part,))
            yield end

        folder.put(path, pieces())
    finally:
        for place in places:
            folder.drop(place)

