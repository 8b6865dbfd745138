"""Near copies of embeddings by product quantisation.

Two vectors of one label are linked if their cosine is COSINE or more. On unit
vectors that is a distance of at most ``reach`` = sqrt(2 - 2 * COSINE).

1. Equal vectors of a label are one, with a count, from the start.
2. The index is fitted on a sample of about SAMPLE vectors: centroids of coarse
   lists, and a codebook for each of SUBSPACES parts of what is left of a vector
   after its centroid is taken off (the residual). Every vector is then indexed: its nearest
   list, its codes, and how far it lies from what its codes stand for (its error).
3. A vector asks its own list, and of the lists of higher number those that may hold a
   vector within reach: the plane between the two centroids is within reach, and so is
   the list's ball. Of two lists' vectors the lower list's ask, so a pair meets once.
4. In a list, table look-ups give the asymmetric distance from the asker to each
   member's codes. By the triangle inequality a member within reach is nearer by this
   distance than reach plus its error; all others are ruled out for certain, and the
   cosines of the rest are computed exactly. So no link is lost: recall is 1.
5. Members are dealt over blocks of BLOCK and askers over parts of ASKERS, each block and
   part a task's work; a task returns each vector's number of links and one member of its
   component there, never the pairs. The components are then joined across tasks.

Defined results: a vector that is null, empty, zero, or holds nulls or numbers that
are not finite, and a vector without a label, links with nothing and is kept; vectors of different
lengths link with nothing in each other; repeated rows are vectors of their own, linked
with each other; a row without an id takes part by its content, and is kept if its
component has no id at all; cosines at the threshold link; extra columns play no part; an empty table
gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_budget
from .common import discard, only, ship, staged, uniform
from .components import components

COSINE = 0.93
SAMPLE = 20_000
SUBSPACES, CODES = 8, 256
#: Coarse lists. A vector asks up to all of them: where vectors have no clusters, no list
#: can be ruled out at this reach, so more lists would only copy each vector more often.
LISTS = 16
BLOCK, ASKERS = 16_384, 16_384
#: Distances of askers to members that are held at once.
CELLS = 500_000
#: Memory of a list's row in a broadcast.
LIST_BYTES = 128
_ROUNDS = 10
_SLACK = 1e-6  # far above the rounding of a distance


def units(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows scaled by a power of two to near 1, their norms, unit rows), in double precision."""
    raw = raw.astype(np.float64)
    scaled = np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1))[1][:, None])
    norms = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
    return scaled, norms, scaled / norms[:, None]


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1), 0)


def _means(x: np.ndarray, k: int) -> np.ndarray:
    """k means of the rows, from evenly spaced rows on."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(_ROUNDS):
        own = _apart(x, centres).argmin(1)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


class Index:
    """Coarse centroids and residual codebooks for unit vectors of one length."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES):
        self.size = sample.shape[1]
        self.centres = _means(sample, lists)
        self.cuts = np.array_split(np.arange(self.size), min(subspaces, self.size))
        left = sample - self.centres[_apart(sample, self.centres).argmin(1)]
        self.books = [_means(left[:, c], codes) for c in self.cuts]
        self.between = np.sqrt(_apart(self.centres, self.centres))

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, error, squared distances to all centroids) of each row."""
        far = _apart(x, self.centres)
        own = far.argmin(1)
        left = x - self.centres[own]
        codes = np.stack([_apart(left[:, c], book).argmin(1) for c, book in zip(self.cuts, self.books)], 1)
        error = np.sqrt(((left - self.spoken(codes)) ** 2).sum(1))
        return own, codes.astype(np.uint8), error, far

    def spoken(self, codes: np.ndarray) -> np.ndarray:
        """What codes stand for."""
        return np.concatenate([book[codes[:, m]] for m, book in enumerate(self.books)], 1)

    def distances(self, asker: np.ndarray, own: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of askers to members of a list, by table look-ups."""
        left = asker - self.centres[own]
        total = np.zeros((len(asker), len(codes)))
        for m, (c, book) in enumerate(zip(self.cuts, self.books)):
            total += _apart(left[:, c], book)[:, codes[:, m]]
        return np.sqrt(total)

    def probes(self, far: np.ndarray, own: int, reach: float) -> np.ndarray:
        """Its own list, and those of higher number that may hold a vector within reach."""
        later = np.arange(own + 1, len(self.centres))
        gap = self.between[own, later]
        plane = (far[later] - far[own]) / np.where(gap > 0, 2 * gap, 1)
        return np.concatenate(([own], later[(plane <= reach + _SLACK) | (gap == 0)]))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def fit(vectors: DataFrame, lists: int, *, sample=SAMPLE, subspaces=SUBSPACES, codes=CODES) -> dict[int, Index]:
    """An index for each length of vector in a sample of about ``sample`` rows of (row, v)."""
    n = vectors.count()
    chosen = vectors.where(uniform(F.col("row"), "vectors") < F.lit(sample / max(n, 1))) if n > sample else vectors
    rows = chosen.orderBy("row").select("v").toArrow()["v"].combine_chunks()
    lengths = rows.value_lengths().to_numpy(zero_copy_only=False)
    return {int(d): Index(units(_matrix(rows.filter(pa.array(lengths == d))))[2], lists, subspaces, codes) for d in np.unique(lengths)}


def _index_of(indexes: dict[int, Index], size: int) -> Index:
    """The length's index; a length that no sampled row had gets one list around zero."""
    if size not in indexes:
        indexes[size] = Index(np.zeros((1, size)), 1)
    return indexes[size]


_PROBES = pa.list_(pa.struct([("probe", pa.int32()), ("distance", pa.float64())]))


def _clean(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _compared(indexes: dict[int, Index], cosine: float, reach: float):
    """A block of members of a list and a part of its askers -> (row, links, other) of each that is linked there."""

    def compared(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy(zero_copy_only=False)
        rows, copies, error = (table[c].to_numpy() for c in ("row", "copies", "error"))
        scaled, norms, unit = units(_matrix(table["v"].combine_chunks()))
        own = table["list"][0].as_py()
        index = _index_of(indexes, unit.shape[1])
        m, q = np.flatnonzero(~asks), np.flatnonzero(asks)
        links, root = np.zeros(len(rows), np.int64), np.arange(len(rows))
        if len(m) and len(q):
            codes = np.frombuffer(b"".join(table["codes"].filter(pa.array(~asks)).to_pylist()), np.uint8).reshape(len(m), -1)
            home = table["home"].to_numpy(zero_copy_only=False)
            place = {r: i for i, r in enumerate(rows[m].tolist())}
            step = max(1, CELLS // len(m))
            for at in range(0, len(q), step):
                part = q[at:at + step]
                near = index.distances(unit[part], own, codes) <= reach + error[m] + _SLACK
                a, b = np.nonzero(near)
                a, b = part[a], m[b]
                once = ~home[a] | (rows[a] < rows[b])  # askers of the list itself meet each member twice
                a, b = a[once], b[once]
                for i in range(0, len(a), 50_000):
                    x, y = a[i:i + 50_000], b[i:i + 50_000]
                    alike = np.einsum("ij,ij->i", scaled[x], scaled[y]) / (norms[x] * norms[y]) >= cosine
                    x, y = x[alike], y[alike]
                    np.add.at(links, x, copies[y])
                    np.add.at(links, y, copies[x])
                    _unite(root, x, y)
            for i in q[home[q]].tolist():  # a row that is there as member and as asker
                j = place.get(int(rows[i]))
                if j is not None:
                    _unite(root, np.array([i]), np.array([j]))
        some = np.flatnonzero(links)
        return pa.table({"row": rows[some], "links": links[some], "other": rows[root[some]]})

    return compared


def _unite(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join the components of x and y; each place points to its component's first one."""
    while len(x):
        a, b = root[x], root[y]
        apart = a != b
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def near_copies(
    vectors: DataFrame, *, vec_id="vec_id", embedding="embedding", label="label", cosine=COSINE, sample=SAMPLE, lists=LISTS,
    subspaces=SUBSPACES, codes=CODES, block=BLOCK, askers=ASKERS, broadcast_bytes: int | None = None,
) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept)."""
    if not 0 < cosine <= 1 or not 1 <= codes <= 256:
        raise ValueError("cosine must lie in (0, 1], codes in 1 to 256")
    spark = vectors.sparkSession
    ship(spark)
    reach = math.sqrt(2 - 2 * cosine)
    few = (broadcast_budget(spark) if broadcast_bytes is None else broadcast_bytes) // LIST_BYTES
    own = only(vectors, vec_id=vec_id, v=embedding, label=label)
    if not (isinstance(own.schema["v"].dataType, T.ArrayType) and isinstance(own.schema["v"].dataType.elementType, T.FloatType)):
        own = own.withColumn("v", F.col("v").cast("array<double>"))
    kind = own.schema["v"].dataType.simpleString()
    known = F.col("label").isNotNull() & _clean(F.col("v"))
    classes = own.where(known).groupBy("label", "v").agg(F.min(F.col("vec_id").cast("long")).alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = staged(classes.withColumn("row", F.monotonically_increasing_id()), "vector-classes")

    indexes = fit(classes.select("row", "v"), lists, sample=sample, subspaces=subspaces, codes=codes)
    label_kind = own.schema["label"].dataType.simpleString()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                some = batch.slice(at, 2000)
                lengths = some.column(2).value_lengths().to_numpy(zero_copy_only=False)
                for size in np.unique(lengths):
                    part = some.filter(pa.array(lengths == size))
                    index = _index_of(indexes, int(size))
                    home, code, error, far = index.place(units(_matrix(part.column(2)))[2])
                    away = np.sqrt(far)
                    asked = [index.probes(f, c, reach) for f, c in zip(far, home)]
                    probes = [[{"probe": int(p), "distance": float(f[p])} for p in ps] for f, ps in zip(away, asked)]
                    more = [
                        pa.array(np.full(len(home), size, np.int32)), pa.array(home.astype(np.int32)), pa.array(away[np.arange(len(home)), home]),
                        pa.array(error), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(probes, _PROBES),
                    ]
                    yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, "size", "list", "away", "error", "codes", "probes"])

    indexed = classes.select("row", "copies", "v", "label").mapInArrow(
        placed,
        f"row long, copies long, v {kind}, label {label_kind}, size int, list int, away double, error double, codes binary, "
        "probes array<struct<probe:int,distance:double>>",
    )
    indexed = staged(indexed, "vector-index")
    where = ["label", "size", "list"]
    sizes = staged(indexed.groupBy(*where).agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")), "vector-lists")
    small = sizes.count() <= few

    def with_lists(df: DataFrame, lists: DataFrame) -> DataFrame:
        lists = lists.withColumnsRenamed({c: f"l_{c}" for c in where})
        same = (F.col("label") == F.col("l_label")) & (F.col("size") == F.col("l_size")) & (F.col("list") == F.col("l_list"))
        return df.join(F.broadcast(lists) if small else lists, same).drop("l_label", "l_size", "l_list")

    blocks = sizes.select(*where, "radius", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    vector = ["row", "copies", "v", "error"]
    asking = indexed.select("label", "size", *vector, F.col("list").alias("own_list"), F.explode("probes").alias("p"))
    asking = asking.select("label", "size", *vector, "own_list", F.col("p.probe").alias("list"), F.col("p.distance").alias("distance"))
    asking = with_lists(asking, blocks).where(F.col("distance") <= F.col("radius") + reach + _SLACK)
    asked = staged(asking.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / askers).cast("int").alias("parts")), "vector-asked")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    spread = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    cell = [*where, "block", "part"]
    members = with_lists(with_lists(indexed.select(*where, *vector, "codes"), blocks.drop("radius")), asked)
    members = members.select(*where, *vector, "codes", F.lit(False).alias("asks"), F.lit(False).alias("home"), spread("blocks").alias("block"), F.explode(every("parts")).alias("part"))
    asking = with_lists(asking, asked).select(
        *where, *vector, F.lit(None).cast("binary").alias("codes"), F.lit(True).alias("asks"), (F.col("own_list") == F.col("list")).alias("home"),
        F.explode(every("blocks")).alias("block"), spread("parts").alias("part"),
    )
    found = members.unionByName(asking).groupBy(*cell).applyInArrow(_compared(indexes, cosine, reach), "row long, links long, other long")
    found = staged(found, "vector-links")
    counts = found.groupBy(F.col("row").alias("c_row")).agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("row").alias("a"), F.col("other").alias("b")).where("a <> b"))
    labels = labels.select(F.col("id").alias("l_row"), F.col("label").alias("joined"))
    linked = classes.join(counts, F.col("row") == F.col("c_row"), "left").join(labels, F.col("row") == F.col("l_row"), "left").select(
        F.col("label").alias("k_label"), F.col("v").alias("k_v"), "least", F.coalesce("joined", "row").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    first = linked.groupBy(F.col("component").alias("f_component")).agg(F.min("least").alias("component_id"))
    linked = staged(linked.join(first, F.col("component") == F.col("f_component")).select("k_label", "k_v", "n_links", "component_id"), "vector-classes")
    discard(classes, indexed, sizes, asked, found)
    alone = own.where(~known).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    same = (F.col("label") == F.col("k_label")) & (F.col("v") == F.col("k_v"))
    rows = own.where(known).join(linked, same).select("vec_id", "n_links", "component_id").unionByName(alone)
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def query(embeddings: DataFrame) -> DataFrame:
    return near_copies(embeddings)
