"""Language identification by rank-order profiles.

A language's profile is the list of its PROFILE most frequent n-grams (one to
three letters, word edges as spaces). A document's own list is compared with
each: an n-gram is out of place by the difference of its ranks, or by PROFILE
if the language lacks it. The language with the least sum wins (ties: the first
by name); the score is 1 minus that sum over the largest possible one.

Profiles are fitted on a bounded sample: at most about SAMPLE whole texts of
each language, chosen by a hash of the id, so that fitting costs the same at any
size. Every document is then judged over its whole text where it lies; only the
profiles (PROFILE n-grams a language) are sent out.

Defined results: a null text or one without letters is ``und`` with score 0, and
so is every text if there is nothing to learn from; null languages are not
learnt; repeated rows are judged alike; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import only, ship, staged, uniform, whole_text

PROFILE = 400
SAMPLE = 1500
#: Languages whose sample shares are broadcast; more are joined by shuffle.
MANY = 100_000
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams as integers (21 bits a letter) and their counts."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    points = np.where(_letters()[points], points, 32)
    points = np.concatenate(([32], points, [32]))
    points = points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]
    if len(points) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    one = points[points != 32]
    two = (points[:-1] << 21) | points[1:]
    three = (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]
    return np.unique(np.concatenate((one, two, three[points[1:-1] != 32])), return_counts=True)


def top(text: str, size: int) -> np.ndarray:
    """The most frequent n-grams, ties by their letters."""
    grams, counts = ngrams(text)
    return grams[np.argsort(-counts, kind="stable")[:size]]


def fit(docs: DataFrame, trains: Column, *, doc_id="doc_id", text="text", lang="lang", size=PROFILE, sample=SAMPLE) -> dict[str, list[int]]:
    """Profiles by language; ``trains``: a condition over ``doc_id`` saying who may be learnt from."""
    ship(docs.sparkSession)
    own = only(docs, doc_id=doc_id, text=text, lang=lang).where(trains & F.col("text").isNotNull() & F.col("lang").isNotNull())
    share = own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).select(F.col("lang").alias("of"), (F.lit(float(sample)) / F.col("n")).alias("share"))
    share = staged(share, "language-shares")
    share = F.broadcast(share) if share.count() <= MANY else share  # a row per language: texts stay where they are
    chosen = own.join(share, F.col("lang") == F.col("of")).where(uniform(F.col("doc_id"), "langid") < F.col("share")).select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                grams, counts = ngrams(text.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang.as_py()] * len(grams), pa.string()), pa.array(grams), pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"]
                )

    total = chosen.mapInArrow(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    rows = total.select("lang", "gram", place.alias("place")).where(F.col("place") <= size).collect()  # size rows a language
    profiles: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["place"])):
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


class Ranks:
    """The profiles as one matrix: rank of each known n-gram in each language."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.langs, self.size = sorted(profiles), size
        self.grams = np.unique(np.concatenate([np.array(profiles[x], np.int64) for x in self.langs])) if profiles else np.empty(0, np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), size, np.int32)
        for j, x in enumerate(self.langs):
            self.ranks[np.searchsorted(self.grams, np.array(profiles[x], np.int64)), j] = np.arange(len(profiles[x]))

    def judge(self, text: str) -> tuple[str, float]:
        own = top(text, self.size)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, own)
        at[self.grams[np.minimum(at, len(self.grams) - 1)] != own] = len(self.grams)
        there = self.ranks[at]
        away = np.where(there == self.size, self.size, np.abs(there - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(away.argmin())
        return self.langs[best], 1.0 - float(away[best]) / (self.size * len(own))


def predict(docs: DataFrame, profiles: dict[str, list[int]], *, doc_id="doc_id", text="text", size=PROFILE) -> DataFrame:
    """One row per document: (doc_id, lang_pred, score)."""
    ship(docs.sparkSession)
    own = only(docs, doc_id=doc_id, text=text).select("doc_id", whole_text("text").alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    ranks = Ranks(profiles, size)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [ranks.judge(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in said], pa.string()), pa.array([x for _, x in said], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return own.mapInArrow(judged, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def query(docs: DataFrame) -> DataFrame:
    profiles = fit(docs, ~held_out(F.col("doc_id")))
    return predict(docs, profiles).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
