"""Periodic runs of words by Lyndon arrays, and texts with their runs collapsed.

A run is a stretch of words with smallest period p that is LEAST words long or
more and POWER periods or more, and that no neighbouring word extends.

1. Words become numbers. A word met fewer than POWER times in a stretch lies in
   no run, since a run holds each of its words that often: the text is cut at
   such words until none is left, and pieces under LEAST words go.
2. Baier's grouping, phase one of a linear suffix sorter, sorts the places of a
   piece into groups by ever longer contexts, from the highest group down: each
   place of a group hands the group's context to the nearest place before it in a
   lower group. The context that a place has when its group is taken is the
   longest Lyndon word that starts there, so the Lyndon array comes directly,
   without the suffix array, once under the order of the numbers and once under
   the reversed order.
3. Under the order in which the word after a run is below the one a period before,
   each Lyndon root in the run is the longest Lyndon word at its place. Three periods
   hold two roots in a row: where a Lyndon word is followed by an equally long one,
   the longest common extensions to both sides give the run.

Each text is one row and is worked on where it lies; nothing is shuffled. The
Lyndon array takes time and memory in proportion to the piece.

Defined results: null and empty texts, and texts without words, have no run and
an empty collapsed text; texts of any length are taken whole, some hundred bytes of
memory a word of the longest piece; of the words of overlapping runs one goes if
any run drops it; runs of equal exponent are all returned; repeated rows are judged alike; an
empty table gives no row; extra columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only, ship, whole_text

LEAST = 24
POWER = 3

Words = list[bytes]


def lyndon_array(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place, by Baier's grouping.

    ``ranks``: numbers from 0 on, all of them used; a text's end is below them all."""
    n, top = len(ranks), max(ranks, default=-1) + 1
    group = ranks[:]  # the group of each place
    members: list[list[int]] = [[] for _ in range(top)]  # in rising order; places that moved on are skipped
    for i, r in enumerate(ranks):
        members[r].append(i)
    size = [len(m) for m in members]  # without those that moved on
    context = [1] * top  # length of each group's context
    below, above = list(range(-1, top - 1)), list(range(1, top + 1))  # the next lower group, the next higher one
    before: list[int] = [-2] * n  # nearest place before in a lower group, once its own group is taken
    lengths = [0] * n
    g = top - 1
    while g >= 0:
        width = context[g]
        handed: list[int] = []  # places that get this context, in rising order
        times: list[int] = []  # how often each
        last = -2
        for s in members[g]:
            if group[s] != g:
                continue
            lengths[s] = width
            p = s - 1
            while p >= 0 and before[p] != -2 and group[p] != g:  # in a higher group: taken already
                p = before[p]
            if p >= 0 and group[p] == g:  # the place before is one of this group: so many contexts in a row
                p = before[p]
            before[s] = p
            if p >= 0:
                if p == last:
                    times[-1] += 1
                else:
                    handed.append(p)
                    times.append(1)
                    last = p
        if len(handed) == 1 and size[group[handed[0]]] == 1:
            context[group[handed[0]]] += times[0] * width  # a group of one place only grows
        elif handed:
            moves: dict[tuple[int, int], list[int]] = {}
            for p, k in zip(handed, times):
                moves.setdefault((group[p], k), []).append(p)
            # the more contexts, the higher above the old group
            over: dict[int, int] = {}
            for h, k in sorted(moves, key=lambda m: m[1]):
                places = moves[h, k]
                if h not in over and size[h] == len(places):
                    context[h] += k * width
                    continue
                new = len(members)
                members.append(places)
                size.append(len(places))
                context.append(context[h] + k * width)
                size[h] -= len(places)
                for p in places:
                    group[p] = new
                    # right above h, or above the group that left h before it
                under = over.get(h, h)
                up = above[under]
                below.append(under)
                above.append(up)
                above[under] = below[up] = new
                over[h] = new
        g = below[g]
    return lengths


def _common(w: np.ndarray, a: int, b: int) -> int:
    """How many words from ``a`` and from ``b`` > ``a`` on are equal."""
    got, step = 0, 32
    while b + got < len(w):
        x, y = w[a + got:a + got + step], w[b + got:b + got + step]
        differ = np.flatnonzero(x[:len(y)] != y)
        if len(differ):
            return got + int(differ[0])
        got, step = got + len(y), 2 * step
    return got


def _of_piece(w: np.ndarray, least: int, power: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of the runs of a piece, those that both orders show twice."""
    n, back = len(w), w[::-1]
    _, ranks = np.unique(w, return_inverse=True)
    for order in (ranks, ranks.max() - ranks):
        period = np.array(lyndon_array(order.tolist()))
        place = np.flatnonzero(np.arange(n) + 2 * period <= n)
        p = period[place]
        # a root is followed by another: as long, with the same first and last word
        place = place[(period[place + p] == p) & (w[place] == w[place + p]) & (w[place + p - 1] == w[place + 2 * p - 1])]
        ends: dict[int, int] = {}  # of the last run of each period
        for i in place.tolist():
            p = int(period[i])
            if i + p <= ends.get(p, 0):
                continue  # inside that run
            end = i + p + _common(w, i, i + p)
            if end < i + 2 * p:
                continue
            start = i - _common(back, n - i - p, n - i) if i else 0
            ends[p] = end
            if end - start >= max(least, power * p):
                yield start, end - start, p


def runs_of(words: Words, least: int = LEAST, power: int = POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    if len(words) < least:
        return []
    names: dict[bytes, int] = {}
    codes = np.array([names.setdefault(w, len(names)) for w in words])
    found: set[tuple[int, int, int]] = set()
    pieces = [(0, codes)]
    while pieces:
        shift, w = pieces.pop()
        _, name, often = np.unique(w, return_inverse=True, return_counts=True)
        rare = np.flatnonzero(often[name] < power)
        if len(rare):
            edges = np.concatenate(([-1], rare, [len(w)]))
            long = np.flatnonzero(np.diff(edges) > least)
            pieces += [(shift + int(edges[k]) + 1, w[edges[k] + 1:edges[k + 1]]) for k in long.tolist()]
        else:
            found.update((shift + start, length, period) for start, length, period in _of_piece(w, least, power))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: Words, runs: list[tuple[int, int, int]]) -> Words:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


RUNS_SQL = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(
    docs: DataFrame, *, doc_id="doc_id", text="text", least=LEAST, power=POWER, reword: Callable[[object, Words], Words] | None = None
) -> DataFrame:
    """One row per document: (doc_id, n_words, runs, collapsed).

    runs: (start, length, period) by start, then period, in words; collapsed: the text
    without what its runs repeat, its words joined by a space. ``power`` must be 3 or more.
    ``reword`` changes a document's words before (its id, its words)."""
    if power < 3:
        raise ValueError("a run needs three periods to hold two roots in a row")
    ship(docs.sparkSession)
    own = only(docs, doc_id=doc_id, text=text).select("doc_id", whole_text("text").alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found, left = [], [], []
            for who, said in zip(batch.column(0), batch.column(1)):
                words = said.as_py().encode("utf-8", "surrogatepass").split()  # at ASCII white space
                if reword is not None:
                    words = reword(who.as_py(), words)
                runs = runs_of(words, least, power)
                sizes.append(len(words))
                found.append([{"start": a, "length": b, "period": c} for a, b, c in runs])
                left.append(b" ".join(collapsed(words, runs)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, _RUNS), pa.array(left, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return own.mapInArrow(judged, f"doc_id {kind}, n_words long, runs {RUNS_SQL}, collapsed string")


def looped(doc_id: object, words: Words) -> Words:
    """The contract's change of a tenth of the documents: from a word on, the first few
    repeat to the end. A null id changes nothing."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    turn = words[a:a + p]
    return words[:a] + (turn * (1 + (n - a) // p))[:n - a]


def query(docs: DataFrame) -> DataFrame:
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")

    def more(a: Column, b: Column) -> Column:  # the exact greater exponent; the earlier run (start, then period) at ties
        return F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)

    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return periodic_runs(docs, reword=looped).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.aggregate("runs", none, more).alias("best"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
