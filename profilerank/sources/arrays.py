"""Objects of JSON arrays, cut out of their files by many tasks.

A split that starts inside a file cannot know whether it starts inside a string, and how deep. So there are two passes
over the text, which Spark's reader cuts at opening braces. The first gives one small row per split: what the split does to
depth and strings, for both cases. From these the driver knows where each split starts. The second pass cuts the objects;
one that reaches over the end of a split is put together from its pieces, of which there is one per split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize

_STRING = re.compile(r'"(?:[^"\\]|\\.)*+"', re.S)
_REST_OF_STRING = re.compile(r'(?:[^"\\]|\\.)*+"', re.S)
_BRACKETS = re.compile(r"[\[\]{}]")
_PLACES = re.compile(r'"(?:[^"\\]|\\.)*+"|[\[\]{}]', re.S)
_BETWEEN = "\ufeff \t\r\n,[]"


def _walk(text: str, inside: bool) -> tuple[int, int, bool]:
    """(change of depth, lowest depth on the way, ends inside a string) of text up to the next opening brace."""
    if inside:
        end = _REST_OF_STRING.match(text)
        if not end:
            return 0, 0, True
        text = text[end.end():]
    bare = _STRING.sub("", text)
    quote = bare.find('"')
    depth = lowest = 0
    for bracket in _BRACKETS.findall(bare if quote < 0 else bare[:quote]):
        depth += 1 if bracket in "[{" else -1
        lowest = min(lowest, depth)
    return depth, lowest, quote >= 0


def _close(text: str, inside: bool, depth: int, floor: int) -> int:
    """The place after the bracket that brings the depth to the floor."""
    start = _REST_OF_STRING.match(text).end() if inside else 0
    for place in _PLACES.finditer(text, start):
        if place[0][0] != '"':
            depth += 1 if place[0] in "[{" else -1
            if depth == floor:
                return place.end()
    raise ValueError("no closing bracket")


def _segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "{").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, int, bool]]:
    """(text, file, split, whether an opening brace stands before it); the splits of a task follow one another."""
    now = None
    for batch in batches:
        for text, file, block in zip(*(column.to_pylist() for column in batch.columns)):
            yield text, file, block, (file, block) == now or block > 0
            now = file, block


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple, list] = {}
    for text, file, block, brace in _rows(batches):
        one = found.get((file, block))
        if one is None:
            # Depth, lowest depth and string for a start outside and one inside a string; the depth before the first brace.
            one = found[file, block] = [[0, 0, False], [0, 0, True], None]
        for state in one[:2]:
            opened = brace and not state[2]
            depth, lowest, inside = _walk(text, state[2])
            state[:] = state[0] + opened + depth, min(state[1], state[0] + opened + lowest), inside
        if not brace:
            one[2] = one[0][0]
    for (file, block), (out, inn, first) in found.items():
        yield pa.RecordBatch.from_pylist([{
            "file": file, "block": block, "out_depth": out[0], "out_low": out[1], "out_string": out[2],
            "in_depth": inn[0], "in_low": inn[1], "in_string": inn[2], "first": first}], _SUMMARY)


_SUMMARY = pa.schema([("file", pa.string()), ("block", pa.int64()), ("out_depth", pa.int64()), ("out_low", pa.int64()), ("out_string", pa.bool_()),
                      ("in_depth", pa.int64()), ("in_low", pa.int64()), ("in_string", pa.bool_()), ("first", pa.int64())])
_PIECES = pa.schema([("file", pa.string()), ("owner", pa.int64()), ("block", pa.int64()), ("value", pa.string())])


def _starts(summaries: list, check: bool) -> dict[tuple[str, int], tuple[int, bool, int, int]]:
    """(file, split) to the depth and string it starts with, the depth of the file's objects, and the split that the open object is from."""
    starts, now = {}, None
    for row in sorted(summaries, key=lambda r: (r["file"], r["block"])):
        if row["file"] != now:
            if check and now is not None and (depth or inside):
                raise ValueError(f"not JSON, in {now}: it ends inside a value")
            now, depth, inside, base, owner = row["file"], 0, False, row["first"] or 0, row["block"]
        starts[row["file"], row["block"]] = depth, inside, base, owner
        side = "in" if inside else "out"
        if depth <= base or depth + row[f"{side}_low"] <= base:
            owner = row["block"]
        depth, inside = depth + row[f"{side}_depth"], row[f"{side}_string"]
    if check and now is not None and (depth or inside):
        raise ValueError(f"not JSON, in {now}: it ends inside a value")
    return starts


def _cut(starts: dict):
    def run(batches):
        made: list[tuple] = []

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*made), _PIECES.types)], schema=_PIECES)
            made.clear()
            return out

        now, size, parts = None, 0, []
        depth = inside = base = owner = None
        for text, file, block, brace in _rows(batches):
            if (file, block) != now:
                if parts:
                    made.append((now[0], owner, now[1], "".join(parts)))
                if (file, block) not in starts:
                    raise ValueError(f"splits of {file} have changed since they were looked at")
                now, parts = (file, block), []
                depth, inside, base, owner = starts[now]
                begun = depth > base  # the open object is from an earlier split
            if brace:
                if not inside:
                    if depth <= base:
                        owner, begun = block, False
                    depth += 1
                parts.append("{")
            change, low, ends = _walk(text, inside)
            if depth > base and depth + low > base:
                parts.append(text)
            elif depth > base:
                end = _close(text, inside, depth, base)
                parts.append(text[:end])
                value = "".join(parts)
                made.append((file, owner, block, value) if begun else (None, None, None, value))
                size += len(value)
                parts, begun = [], False
                if text[end:].strip(_BETWEEN):
                    made.append((None, None, None, text[end:].strip(_BETWEEN)))
            else:
                # Text outside of any object: what is no separator is handed on, and refused where it is parsed.
                value = "".join([*parts, text]).strip(_BETWEEN)
                parts = []
                if value:
                    made.append((None, None, None, value))
            depth, inside = depth + change, ends
            if size > 4 << 20 or len(made) > 10_000:
                yield flush()
                size = 0
        if parts:
            made.append((now[0], owner, now[1], "".join(parts)))
        if made:
            yield flush()

    return run


def array_objects(spark: SparkSession, path: str, check: bool = True, attempts: int = 3) -> DataFrame:
    """(value): the text of each object of one or more JSON arrays, also of bare objects, stored for repeated reading.

    Objects lie side by side at the depth of the file's first one. Empty files and arrays have no rows. A file that ends
    inside a value is an error with ``check``. Splits depend on settings and on the cores that are there; when they change
    between the passes, both are done again.
    """
    for attempt in range(attempts):
        summaries = _segments(spark, path).mapInArrow(_summaries, ", ".join(
            f"{f.name} {'string' if f.type == pa.string() else 'boolean' if f.type == pa.bool_() else 'bigint'}" for f in _SUMMARY)).collect()
        starts = _starts(summaries, check)
        try:
            pieces = materialize(_segments(spark, path).mapInArrow(_cut(starts), "file string, owner bigint, block bigint, value string"), "pieces")
            break
        except Exception as error:
            if "have changed since" not in str(error) or attempt == attempts - 1:
                raise
    parts = F.array_sort(F.collect_list(F.struct("block", "value")))
    over = pieces.filter("owner IS NOT NULL").groupBy("file", "owner").agg(parts.alias("parts"))
    return pieces.filter("owner IS NULL").select("value").unionByName(over.select(F.array_join("parts.value", "").alias("value")))
