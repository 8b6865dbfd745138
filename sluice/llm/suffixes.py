"""Exact repeats of SIZE bytes by sorting suffixes, and their removal.

A byte goes if it lies in a SIZE-byte string of its document that also starts
earlier: in a document of smaller id, or earlier in the same one. Strings are
judged on the input and found at every byte position, never across documents.

A suffix for each byte would make a hundred times the input. Instead each
SIZE-byte string names one of its own positions as its anchor: the one whose
next LEAD bytes have the least hash. Equal strings name the same position, so
only suffixes at anchors (about one of 35 bytes) need sorting, and only those
whose LEAD bytes occur twice at all:

1. Anchors travel as numbers; sorting them by the hash of their LEAD bytes shows
   which occur twice. A hash that a batch holds often travels once from there.
2. The suffixes at those anchors, with the bytes before them that strings of
   theirs may start in, are range-partitioned by sampled splitters on their
   leading bytes (then document and place, so that a hot string spreads over many
   buckets). A bucket of some BUCKET suffixes is sorted by multikey quicksort on
   eight bytes at a time.
3. In a bucket, suffixes of equal leading bytes lie together; each of their
   strings is compared with the earlier ones. A bucket's first and last group may
   go on in its neighbours: their strings are compared across the boundaries.

Strings are compared by 64-bit hashes among those with the same LEAD bytes at the
same place, not byte by byte.

Defined results: a null text is empty; a text under SIZE bytes keeps all; rows
with the same id and text are one document and get the same result; rows that
share an id but not the text are told apart and ordered by a 64-bit hash of the text; a null doc_id
comes before all others; an empty table gives no row; extra columns play no part.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordhash
from .common import discard, only, ship, staged, whole_text

SIZE = 100
LEAD = 32
REACH = SIZE - LEAD + 1  # positions of a string that can be its anchor
_PLACE_BITS = 22
#: Bytes that are searched for anchors in one go.
_PIECE = 500_000
#: Suffixes of a bucket that one task sorts in memory, and splitters drawn for each bucket.
BUCKET, DRAWN = 32_000, 50
#: Buckets at most: splitters of some 60 bytes each go to every worker.
MOST_BUCKETS = 500_000
#: Suffixes whose strings are compared in one go, if a group of equal leads is not larger.
_COMPARED = 4_000
_U = np.uint64
FIRST_ID = -(1 << 63)

#: How an anchor travels beside its document's id and the text's hash: its place,
#: and how far before it its strings start (most and least), 7 bits each.
_AT, _MOST = 14, 7


def _rolling(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on."""
    power, inverse = wordhash.powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTES[data] * power[:len(data)], out=sums[1:])
    n = len(data) - size + 1
    return wordhash.mix((sums[size:] - sums[:n]) * inverse[:n])


_BYTES = wordhash.mix(np.arange(1001, 1257, dtype=_U))


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first start, last start) of each anchor of the texts in ``data``."""
    empty = np.empty(0, np.int64)
    if len(data) < SIZE:
        return np.empty(0, _U), empty, empty, empty
    hashes = _rolling(data, LEAD)
    key = (hashes >> _U(_PLACE_BITS) << _U(_PLACE_BITS)) | np.arange(len(hashes), dtype=_U)
    least, width = key, 1
    while 2 * width <= REACH:  # least key of 2, 4, ... places
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    n = len(key) - REACH + 1
    least = np.minimum(least[:n], least[REACH - width:REACH - width + n])
    inside = np.zeros(len(data) + 2, np.int64)
    ends = np.maximum(offsets[1:] - SIZE + 1, offsets[:-1])
    np.add.at(inside, offsets[:-1], 1)
    np.add.at(inside, ends, -1)
    starts = np.flatnonzero(np.cumsum(inside)[:n] > 0)
    if not len(starts):
        return np.empty(0, _U), empty, empty, empty
    place = (least[starts] & _U((1 << _PLACE_BITS) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1))))
    last = np.concatenate((new[1:], [len(starts)])) - 1
    return hashes[place[new]], place[new], starts[new], starts[last]


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, bytes, offsets, place in a long text) of chunks; a long text in pieces that overlap by SIZE - 1."""
    for i, j in wordhash.chunks(offsets, _PIECE):
        begin, end = int(offsets[i]), int(offsets[j])
        if end - begin <= _PIECE:
            yield i, data[begin:end], offsets[i:j + 1] - begin, 0
        else:
            for at in range(begin, end - SIZE + 1, _PIECE - SIZE + 1):
                part = data[at:min(end, at + _PIECE)]
                yield i, part, np.array([0, len(part)]), at - begin


def _announce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, tag, text) -> (hash, route, doc, tag, at, known): anchors, and whether the batch holds the hash twice."""
    for batch in batches:
        data, offsets = wordhash.texts(batch.column(2))
        docs, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)
        for first, part, marks, shift in _pieces(data, offsets):
            hashes, place, start, last = anchors(part, marks)
            if not len(hashes):
                continue
            row = np.searchsorted(marks, place, "right") - 1
            at = ((place - marks[row] + shift) << _AT) | ((place - start) << _MOST) | (place - last)
            doc, tag = docs[first + row], tags[first + row]
            order = np.argsort(hashes, kind="stable")
            hashes, doc, tag, at = hashes[order], doc[order], tag[order], at[order]
            same = hashes[1:] == hashes[:-1]
            known = np.concatenate(([False], same)) | np.concatenate((same, [False]))
            again = np.concatenate(([False], same))  # met in the batch already: need not ask
            route = np.where(again, wordhash.mix(at.astype(_U) + doc.astype(_U) + tag.astype(_U)), hashes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (hashes.astype(np.int64), route.astype(np.int64), doc, tag, at)] + [pa.array(known)],
                names=["hash", "route", "doc", "tag", "at", "known"],
            )


def _twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (route, doc, tag, at, known) by route: those whose route occurs again, or that are known."""
    route, doc, tag, at, known = (np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, bool))

    def out(n: int) -> pa.RecordBatch:
        same = route[1:] == route[:-1]
        keep = (known | np.concatenate(([False], same)) | np.concatenate((same, [False])))[:n]
        return pa.RecordBatch.from_arrays([pa.array(x[:n][keep]) for x in (doc, tag, at)], names=["doc", "tag", "at"])

    for batch in batches:
        new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
        route, doc, tag, at, known = (np.concatenate(x) for x in zip((route, doc, tag, at, known), new))
        if len(route) > 2:
            n = len(route) - 1
            yield out(n)
            # the last row of what was judged tells the next one whether it is the same
            known[n] |= route[n] == route[n - 1]
            keep_back = slice(n, None)
            route, doc, tag, at, known = (x[keep_back] for x in (route, doc, tag, at, known))
    if len(route):
        yield out(len(route))


def _suffixes(splitters: list[tuple] | None):
    """(doc, tag, text, ats) -> (bucket, lead, doc, tag, at, body): the suffixes that travel, or
    without splitters (lead, doc, tag, at) alone."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, tag, text, ats in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                raw = text.as_buffer().to_pybytes() if hasattr(text, "as_buffer") and text.as_buffer() is not None else b""
                every = np.asarray(ats.values)
                for i in range(0, len(every), 20_000):
                    at = every[i:i + 20_000]
                    place, most, least = at >> _AT, (at >> _MOST) & 127, at & 127
                    leads = [raw[p:p + LEAD] for p in place.tolist()]
                    keys = [pa.array(leads, pa.binary()), *[pa.array(np.full(len(at), x, np.int64)) for x in (doc, tag)], pa.array(at)]
                    if splitters is None:
                        yield pa.RecordBatch.from_arrays(keys, names=["lead", "doc", "tag", "at"])
                        continue
                    bucket = [bisect_right(splitters, (lead, doc, tag, a)) for lead, a in zip(leads, at.tolist())]
                    bodies = [raw[p - a:p - b + SIZE] for p, a, b in zip(place.tolist(), most.tolist(), least.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket, pa.int32()), *keys, pa.array(bodies, pa.binary())], names=["bucket", "lead", "doc", "tag", "at", "body"]
                    )

    return found


def multikey_quicksort(words: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Rows of ``order`` by their words, first to last; equal rows keep their order.

    A pivot parts the rows by one word into lower, equal and higher ones; the equal go on
    with the next word. Few rows are sorted at once."""
    done, todo = [], [(order, 0)]
    while todo:
        rows, k = todo.pop()
        if len(rows) < 2 or k == words.shape[1]:
            done.append(rows)
        elif len(rows) <= 512:
            done.append(rows[np.lexsort(words[rows, k:].T[::-1])])
        else:
            key = words[rows, k]
            pivot = np.sort(key[[0, len(rows) // 4, len(rows) // 2, 3 * len(rows) // 4, -1]])[2]
            todo += [(rows[key > pivot], k), (rows[key == pivot], k + 1), (rows[key < pivot], k)]
    return np.concatenate(done) if done else order


def _expand(bodies: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each string of the suffixes: its row, how far before the anchor it starts, its hash."""
    data, offsets = wordhash.texts(bodies)
    begin = offsets[0]
    data, offsets = data[begin:offsets[-1]], offsets - begin
    most, least = (at >> _MOST) & 127, at & 127
    n = most - least + 1
    row = np.repeat(np.arange(len(at)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    power, inverse = wordhash.powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTES[data] * power[:len(data)], out=sums[1:])
    start = offsets[row] + step
    return row, most[row] - step, wordhash.mix((sums[start + SIZE] - sums[start]) * inverse[start])


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each bucket; a bucket's rows come one after the other."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        bucket = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
        for i, j in zip(cuts[:-1], cuts[1:]):
            if i == j:
                continue
            if held and bucket[i] != now:
                yield pa.Table.from_batches(held)
                held = []
            now = bucket[i]
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _sort_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of suffixes -> (doc, tag, start, stop, string): repeated stretches
    (string null), and the strings of the first and last group that have no
    earlier one in their bucket (with their hash), for the boundaries."""

    def rows(doc, tag, start, stop, string=None) -> pa.RecordBatch:
        string = pa.nulls(len(doc), pa.int64()) if string is None else pa.array(string.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(tag), pa.array(start), pa.array(stop), string], names=["doc", "tag", "start", "stop", "string"])

    for bucket in _buckets(batches):
        docs, tags, ats = (bucket[c].to_numpy() for c in ("doc", "tag", "at"))
        raw, marks = wordhash.texts(bucket["lead"].combine_chunks())
        leads = raw[marks[0]:marks[-1]].reshape(-1, LEAD)
        order = multikey_quicksort(leads.copy().view(">u8"), np.lexsort((ats, tags, docs)))
        words = leads[order]
        new = np.flatnonzero(np.concatenate(([True], (words[1:] != words[:-1]).any(axis=1))))
        edges = np.append(new, len(order))
        i = 0
        while i < len(new):  # some whole groups at a time
            j = max(i + 1, int(np.searchsorted(edges, edges[i] + _COMPARED, "right")) - 1)
            part = order[edges[i]:edges[j]]
            number = np.repeat(np.arange(i, j), np.diff(edges[i:j + 1]))
            doc, tag, at = docs[part], tags[part], ats[part]
            # one number per lead, whatever the bucket
            lead_hash = wordhash.mix((leads[part].view(_U).reshape(-1, LEAD // 8) * _LEADS).sum(axis=1, dtype=_U))
            row, before, string = _expand(bucket["body"].take(pa.array(part)).combine_chunks(), at)
            string = wordhash.mix(string + lead_hash[row] + before.astype(_U) * _U(0xA24BAED4963EE407))
            place = at >> _AT
            start = place[row] - before
            # rows are in the order of document and place: the first of equal strings is the earliest
            _, index, inverse = np.unique(string, return_index=True, return_inverse=True)
            o = row[index[inverse]]
            repeat = (doc[o] != doc[row]) | (tag[o] != tag[row]) | (place[o] != place[row])
            # repeated strings of a suffix that touch make one stretch
            r, s = row[repeat], start[repeat]
            if len(r):
                cut = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (s[1:] > s[:-1] + SIZE))))
                to = np.concatenate((cut[1:], [len(r)])) - 1
                yield rows(doc[r[cut]], tag[r[cut]], s[cut], s[to] + SIZE)
            edge = ~repeat & ((number[row] == 0) | (number[row] == len(new) - 1))
            if edge.any():
                q = row[edge]
                yield rows(doc[q], tag[q], start[edge], start[edge] + SIZE, string[edge])
            i = j


_LEADS = wordhash.mix(np.arange(2001, 2001 + LEAD // 8, dtype=_U)) | _U(1)


def _merged(spans: list[dict] | None) -> list[list[int]]:
    """Maximal runs under the spans; spans that touch are one run."""
    runs: list[list[int]] = []
    for a, b in sorted((x["start"], x["stop"]) for x in spans or ()):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return runs


def _kept(raw: bytes, runs: list) -> bytes:
    parts, at = [], 0
    for a, b in runs:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_RUNS_SQL = "array<struct<start:bigint,stop:bigint>>"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, doc, tag, text, spans) -> (doc_id, doc, tag, n_bytes, runs, kept_sha256)."""
    for batch in batches:
        size, runs_out, digest = [], [], []
        for text, spans in zip(batch.column(3).cast(pa.large_binary()), batch.column(4).to_pylist()):
            raw, runs = text.as_py(), _merged(spans)
            size.append(len(raw))
            runs_out.append([{"start": a, "stop": b} for a, b in runs])
            digest.append(hashlib.sha256(_kept(raw, runs)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(size, pa.int64()), pa.array(runs_out, _RUNS), pa.array(digest, pa.string())],
            names=["doc_id", "doc", "tag", "n_bytes", "runs", "kept_sha256"],
        )


def _own(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    t = whole_text("text")
    return only(docs, doc_id=doc_id, text=text).select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_ID)).alias("doc"), F.xxhash64(t).alias("tag"), t.alias("text")
    )


def _named(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({"doc": f"{prefix}_doc", "tag": f"{prefix}_tag"})


def _same(prefix: str):
    return (F.col("doc") == F.col(f"{prefix}_doc")) & (F.col("tag") == F.col(f"{prefix}_tag"))


def _splitters(travelling: DataFrame, n: int) -> list[tuple]:
    """Where buckets of about BUCKET of the ``n`` suffixes begin, by a sample of them."""
    count = min(MOST_BUCKETS, -(-n // BUCKET))
    if count < 2:
        return []
    every = max(1, n // (count * DRAWN))
    drawn = F.filter("ats", lambda x: F.pmod(F.xxhash64(x, "doc", "tag"), F.lit(every)) == 0)
    some = travelling.select("doc", "tag", "text", drawn.alias("ats")).where(F.size("ats") > 0)
    rows = some.mapInArrow(_suffixes(None), "lead binary, doc long, tag long, at long").toArrow().to_pydict()
    sample = sorted(zip(rows["lead"], rows["doc"], rows["tag"], rows["at"]))
    return [sample[len(sample) * k // count] for k in range(1, count)] if sample else []


def repeats(docs: DataFrame, *, doc_id="doc_id", text="text") -> DataFrame:
    """One row per document: (doc_id, doc, tag, n_bytes, runs, kept_sha256).

    runs: the maximal runs of removed bytes; kept_sha256: digest of what is left."""
    ship(docs.sparkSession)
    own = _own(docs, doc_id, text)
    long = own.where(F.octet_length("text") >= SIZE)
    asked = long.select("doc", "tag", "text").mapInArrow(_announce, "hash long, route long, doc long, tag long, at long, known boolean")
    dealt = asked.select("route", "doc", "tag", "at", "known").repartition("route").sortWithinPartitions("route")
    twice = dealt.mapInArrow(_twice, "doc long, tag long, at long")
    ats = staged(twice.groupBy("doc", "tag").agg(F.collect_set("at").alias("ats")), "suffix-anchors")
    # texts without a string that could be a repeat are judged here and travel no further
    clean = F.col("ats").isNull()
    joined = staged(
        own.join(_named(ats, "a"), _same("a"), "left").select(
            "doc_id", "doc", "tag", F.octet_length("text").cast("long").alias("n_bytes"),
            F.when(clean, F.sha2("text", 256)).alias("sha"), F.when(~clean, F.col("text")).alias("text"), "ats",
        ),
        "suffix-documents",
    )
    discard(ats)
    some = joined.where("ats IS NOT NULL")
    travelling = some.select("doc", "tag", "text", F.array_sort("ats").alias("ats"))
    n = some.agg(F.sum(F.size("ats"))).first()[0] or 0
    dealt = travelling.mapInArrow(_suffixes(_splitters(travelling, n)), "bucket int, lead binary, doc long, tag long, at long, body binary")
    buckets = dealt.repartition("bucket").sortWithinPartitions("bucket")
    found = staged(buckets.mapInArrow(_sort_bucket, "doc long, tag long, start long, stop long, string long"), "suffix-repeats")
    edge = found.where("string IS NOT NULL")
    earliest = edge.groupBy(F.col("string").alias("e_string")).agg(F.min(F.struct("doc", "tag", "start")).alias("earliest"))
    across = edge.join(earliest, F.col("string") == F.col("e_string")).where(F.struct("doc", "tag", "start") > F.col("earliest"))
    stretches = found.where("string IS NULL").select("doc", "tag", "start", "stop").unionByName(across.select("doc", "tag", "start", "stop"))
    spans = stretches.groupBy("doc", "tag").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    kind = own.schema["doc_id"].dataType.simpleString()
    judged = some.join(_named(spans, "s"), _same("s"), "left").select("doc_id", "doc", "tag", "text", "spans").mapInArrow(
        _judge, f"doc_id {kind}, doc long, tag long, n_bytes long, runs {_RUNS_SQL}, kept_sha256 string"
    )
    whole = joined.where("ats IS NULL").select("doc_id", "doc", "tag", "n_bytes", F.array().cast(_RUNS_SQL).alias("runs"), F.col("sha").alias("kept_sha256"))
    return judged.unionByName(whole)


def removed(docs: DataFrame, *, doc_id="doc_id", text="text") -> DataFrame:
    """One row per document: (doc_id, kept): the bytes that are left, which may end inside a character."""
    runs = repeats(docs, doc_id=doc_id, text=text).where(F.size("runs") > 0).select("doc", "tag", "runs").dropDuplicates(["doc", "tag"])
    raw = F.col("text").cast("binary")
    # between two runs lies what starts where the one ends
    starts = F.concat(F.array(F.lit(0).cast("long")), F.col("runs.stop"))
    stops = F.concat(F.col("runs.start"), F.array(F.octet_length("text").cast("long")))
    parts = F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda x: F.substring(raw, (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")))
    left = F.aggregate(parts, F.lit(b""), lambda acc, x: F.concat(acc, x))
    return _own(docs, doc_id, text).join(_named(runs, "r"), _same("r"), "left").select("doc_id", F.coalesce(left, raw).alias("kept"))


def query(docs: DataFrame) -> DataFrame:
    n_removed = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["stop"] - r["start"])
    return repeats(docs).select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("runs").cast("long").alias("n_spans"), "kept_sha256"
    )
