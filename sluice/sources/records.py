"""Records that span lines, put together where the lines lie.

A line that holds quotes may end inside a quoted value. What it does to the reader's state is a
function of two states (outside, inside): each line gives its state at the end for
both. The functions are composed per block of a file (``fold``), then over the
blocks (``block_states``), so that each block knows whether it starts inside
quotes and how many records start before it. ``assemble`` then goes through a block's
lines once; a record that crosses blocks leaves a piece in each.

What travels between the steps is one row a block; lines are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A line's code: whether it ends inside quotes if it starts outside, if it starts
#: inside; whether it is blank; whether its bytes are no UTF-8.
ENDS_IN, STAYS_IN, BLANK, BAD = 1, 2, 4, 8


def line_states(code: np.ndarray, start: int) -> np.ndarray:
    """State before each line and after the last one, from a first state (1: inside quotes)."""
    out, kept = (code & ENDS_IN).astype(np.int64), (code & STAYS_IN) // STAYS_IN
    fixed = out == kept
    turns = np.cumsum(~fixed & (out == 1))  # lines that change either state to the other
    at = np.maximum.accumulate(np.where(fixed, np.arange(len(code)), -1))
    since = np.where(at >= 0, out[at] ^ ((turns - turns[at]) & 1), start ^ (turns & 1))
    return np.concatenate(([start], since))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Ranges of rows of one block (columns 0: file id, 1: block)."""
    a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    cuts = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
    edges = [0, *cuts.tolist(), len(a)]
    return zip(edges[:-1], edges[1:])


FOLDED = "file_id long, block long, uri string, out int, kept int, n_out long, n_kept long, bad boolean"


def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file_id, block, uri, code) in order -> a row a block: its function and the records that start in it, for both states."""
    now, found = None, []

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([now], schema=pa.schema([
            ("file_id", pa.int64()), ("block", pa.int64()), ("uri", pa.string()), ("out", pa.int32()), ("kept", pa.int32()),
            ("n_out", pa.int64()), ("n_kept", pa.int64()), ("bad", pa.bool_()),
        ]))

    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column(3).to_numpy()
        for i, j in _runs(batch):
            file_id, block = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            if now is None or (now["file_id"], now["block"]) != (file_id, block):
                if now is not None:
                    yield done()
                now = {"file_id": file_id, "block": block, "uri": batch.column(2)[i].as_py(), "out": 0, "kept": 1, "n_out": 0, "n_kept": 0, "bad": False}
            code = codes[i:j]
            solid = (code & BLANK) == 0
            for state, count in (("out", "n_out"), ("kept", "n_kept")):
                states = line_states(code, now[state])
                now[count] += int(((states[:-1] == 0) & solid).sum())
                now[state] = int(states[-1])
            now["bad"] = now["bad"] or bool((code & BAD).any())
    if now is not None:
        yield done()


def block_states(folded: DataFrame) -> DataFrame:
    """Adds, to each block: ``entry`` (starts inside quotes), ``offset`` (records that start before it in its
    file), ``n`` (in it), and ``file_open`` (its file ends inside quotes)."""
    upto = Window.partitionBy("file_id").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("file_id").orderBy("block")
    fixed = F.col("out") == F.col("kept")
    df = folded.withColumn("turns", F.sum(F.when(~fixed & (F.col("out") == 1), 1).otherwise(0)).over(upto))
    df = df.withColumn("at", F.last(F.when(fixed, F.struct("out", "turns")), ignorenulls=True).over(upto))
    since = F.when(F.col("at").isNull(), F.col("turns") % 2).otherwise((F.col("at.out") + F.col("turns") - F.col("at.turns")) % 2)
    df = df.withColumn("after", since).withColumn("entry", F.coalesce(F.lag("after").over(before), F.lit(0)) == 1)
    df = df.withColumn("n", F.when(F.col("entry"), F.col("n_kept")).otherwise(F.col("n_out")))
    whole = Window.partitionBy("file_id").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select(
        "file_id", "block", "uri", "entry", "n", (F.sum("n").over(upto) - F.col("n")).alias("offset"), "bad",
        (F.last("after").over(whole) == 1).alias("file_open"),
    )


ASSEMBLED = "file_id long, uri string, ordinal long, raw string, bad boolean, piece long"
_ASSEMBLED = pa.schema([
    ("file_id", pa.int64()), ("uri", pa.string()), ("ordinal", pa.int64()), ("raw", pa.string()), ("bad", pa.bool_()), ("piece", pa.int64()),
])


def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file_id, block, uri, code, value, entry, offset) in order -> records by number in their file.

    ``piece`` is null for a whole record, else the block that the piece lies in."""
    at = None  # the block that the last batch ended in
    state, count = 0, 0
    held: dict | None = None  # a record, or the end of one, that has not ended yet
    rows: list[dict] = []  # what spans lines

    def let_go() -> None:
        nonlocal held
        if held is not None:
            begun, lines, ended = held.pop("begun"), held.pop("lines"), held.pop("ended")
            rows.append({**held, "raw": "\n".join(lines), "piece": None if begun and ended else held["piece"]})
        held = None

    for batch in batches:
        if not batch.num_rows:
            continue
        ids, codes = batch.column(0).to_numpy(), batch.column(3).to_numpy()
        single, ordinals = [], []
        for i, j in _runs(batch):
            block = batch.column(1)[i].as_py()
            if at != (ids[i], block):
                let_go()
                at, state, count = (ids[i], block), int(batch.column(5)[i].as_py()), batch.column(6)[i].as_py()
            code = codes[i:j]
            states = line_states(code, state)
            start = (states[:-1] == 0) & ((code & BLANK) == 0)
            ordinal = count + np.cumsum(start) - 1
            lone = np.flatnonzero(start & (states[1:] == 0))
            if held is not None and states[0] == 0:
                let_go()
            single.append(i + lone)
            ordinals.append(ordinal[lone])
            inside = states[:-1] == 1
            for k in np.flatnonzero(inside | (start & (states[1:] == 1))).tolist():
                if not inside[k]:
                    let_go()
                if held is None:
                    held = {
                        "file_id": int(ids[i]), "uri": batch.column(2)[i].as_py(), "ordinal": int(ordinal[k]), "bad": False, "piece": block,
                        "begun": not inside[k], "lines": [], "ended": False,
                    }
                held["lines"].append(batch.column(4)[i + k].as_py())
                held["bad"] = held["bad"] or bool(code[k] & BAD)
                if states[k + 1] == 0:
                    held["ended"] = True
                    let_go()
            state, count = int(states[-1]), count + int(start.sum())
        take = pa.array(np.concatenate(single))
        if len(take):
            part = batch.take(take)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(2), pa.array(np.concatenate(ordinals)), part.column(4),
                    pa.array((codes[take.to_numpy()] & BAD) > 0), pa.nulls(len(take), pa.int64()),
                ],
                schema=_ASSEMBLED,
            )
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ASSEMBLED)
            rows = []
    let_go()
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_ASSEMBLED)


def whole_records(assembled: DataFrame, join: str) -> DataFrame:
    """The records, those in pieces put together: at most one a block."""
    pieces = assembled.where("piece IS NOT NULL").groupBy("file_id", "uri", "ordinal").agg(
        F.array_sort(F.collect_list(F.struct("piece", "raw"))).alias("parts"), F.bool_or("bad").alias("bad")
    )
    joined = pieces.select("file_id", "uri", "ordinal", F.array_join("parts.raw", join).alias("raw"), "bad")
    return assembled.where("piece IS NULL").drop("piece").unionByName(joined)


# --- JSON arrays: segments that end with a closing brace ------------------------------------

SEGMENTS = "file_id long, block long, uri string, flip int, d_out long, d_in long, at_out map<long,long>, at_in map<long,long>, bad boolean"


def fold_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file_id, block, uri, flip, d_out, d_in, bad) in order -> a row a block: whether it turns the state (inside a
    string or not), how deep it goes, and how many segments end outside strings at each depth, for both states."""
    now, keys = None, None
    types = pa.schema([
        ("file_id", pa.int64()), ("block", pa.int64()), ("uri", pa.string()), ("flip", pa.int32()), ("d_out", pa.int64()), ("d_in", pa.int64()),
        ("at_out", pa.map_(pa.int64(), pa.int64())), ("at_in", pa.map_(pa.int64(), pa.int64())), ("bad", pa.bool_()),
    ])

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{**now, "at_out": list(now["at_out"].items()), "at_in": list(now["at_in"].items())}], schema=types)

    for batch in batches:
        if not batch.num_rows:
            continue
        flip, d_out, d_in, bad = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 5, 6))
        for i, j in _runs(batch):
            key = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            if key != keys:
                if now is not None:
                    yield done()
                keys = key
                now = {"file_id": key[0], "block": key[1], "uri": batch.column(2)[i].as_py(), "flip": 0, "d_out": 0, "d_in": 0, "at_out": {}, "at_in": {}, "bad": False}
            for first, depth, at in ((0, "d_out", "at_out"), (1, "d_in", "at_in")):
                states, after = segment_states(flip[i:j], d_out[i:j], d_in[i:j], first ^ now["flip"], now[depth])
                places, n = np.unique(after[states[1:] == 0], return_counts=True)
                for p, k in zip(places.tolist(), n.tolist()):
                    now[at][p] = now[at].get(p, 0) + k
                now[depth] = int(after[-1])
            now["flip"] ^= int(flip[i:j].sum() & 1)
            now["bad"] = now["bad"] or bool(bad[i:j].any())
    if now is not None:
        yield done()


def segment_states(flip: np.ndarray, d_out: np.ndarray, d_in: np.ndarray, state: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """State before each segment and after the last one, and the depth after each."""
    states = np.concatenate(([state], state ^ (np.cumsum(flip) & 1)))
    return states, depth + np.cumsum(np.where(states[:-1] == 0, d_out, d_in))


def segment_blocks(folded: DataFrame) -> DataFrame:
    """Adds, to each block: ``entry`` (starts inside a string), ``depth`` at its start, ``offset`` (records that end before
    it), ``n`` (in it); and of its file ``total`` (records), ``last_depth`` and ``open`` (ends inside a string)."""
    upto = Window.partitionBy("file_id").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("file_id")
    df = folded.withColumn("entry", (F.sum("flip").over(upto) - F.col("flip")) % 2 == 1)
    df = df.withColumn("d", F.when(F.col("entry"), F.col("d_in")).otherwise(F.col("d_out"))).withColumn("depth", F.sum("d").over(upto) - F.col("d"))
    at = F.when(F.col("entry"), F.col("at_in")).otherwise(F.col("at_out"))
    df = df.withColumn("n", F.coalesce(F.try_element_at(at, 1 - F.col("depth")), F.lit(0)))
    return df.select(
        "file_id", "block", "uri", "entry", "depth", "n", "bad", (F.sum("n").over(upto) - F.col("n")).alias("offset"), F.sum("n").over(whole).alias("total"),
        F.sum("d").over(whole).alias("last_depth"), (F.sum("flip").over(whole) % 2 == 1).alias("open"),
    )


def assemble_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file_id, block, uri, flip, d_out, d_in, value, entry, depth, offset) in order -> members of the array by
    number, each with the comma or bracket before it; the last number of a file is what follows its members.
    ``piece`` is null for a whole member, else the block that the piece lies in."""
    at, state, depth, count = None, 0, 0, 0
    held: dict | None = None
    rows: list[dict] = []

    def let_go(ended: bool) -> None:
        nonlocal held
        if held is not None:
            begun, parts = held.pop("begun"), held.pop("parts")
            rows.append({**held, "raw": "}".join(parts) + "}" * ended, "bad": False, "piece": None if begun and ended else held["piece"]})
        held = None

    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_numpy()
        flip, d_out, d_in = (batch.column(k).to_numpy() for k in (3, 4, 5))
        single, ordinals = [], []
        for i, j in _runs(batch):
            block = batch.column(1)[i].as_py()
            if at != (ids[i], block):
                let_go(False)
                at, state, depth, count = (ids[i], block), int(batch.column(7)[i].as_py()), batch.column(8)[i].as_py(), batch.column(9)[i].as_py()
            before = depth
            states, after = segment_states(flip[i:j], d_out[i:j], d_in[i:j], state, depth)
            ends = (after == 1) & (states[1:] == 0)
            fresh = np.concatenate(([held is None and state == 0 and before <= 1], ends[:-1]))  # a member starts with the segment
            ordinal = count + np.cumsum(ends) - ends
            lone = np.flatnonzero(fresh & ends)
            single.append(i + lone)
            ordinals.append(ordinal[lone])
            for k in np.flatnonzero(~(fresh & ends)).tolist():
                if held is None:
                    held = {"file_id": int(ids[i]), "uri": batch.column(2)[i].as_py(), "ordinal": int(ordinal[k]), "piece": block, "begun": bool(fresh[k]), "parts": []}
                held["parts"].append(batch.column(6)[i + k].as_py())
                if ends[k]:
                    let_go(True)
            state, depth, count = int(states[-1]), int(after[-1]), count + int(ends.sum())
        take = pa.array(np.concatenate(single))
        if len(take):
            part = batch.take(take)
            raw = pc.binary_join_element_wise(part.column(6), "}", "")
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(np.concatenate(ordinals)), raw, pa.array(np.zeros(len(take), bool)), pa.nulls(len(take), pa.int64())],
                schema=_ASSEMBLED,
            )
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ASSEMBLED)
            rows = []
    let_go(False)
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_ASSEMBLED)


def line_code(value: Column, ends_in: Column, stays_in: Column, blank: Column, bad: Column) -> Column:
    """A line's code; the quote tests only run on lines with a quote."""
    quiet = F.instr(value, '"') == 0
    states = F.when(quiet, F.lit(STAYS_IN)).otherwise(ends_in.cast("int") * ENDS_IN + stays_in.cast("int") * STAYS_IN)
    return (states + blank.cast("int") * BLANK + bad.cast("int") * BAD).cast("int")
