"""Benchmark decontamination by a broadcast set of word n-grams (DataFrame only).

Words are runs of digits, a-z (A-Z folded) and non-ASCII characters. A window
is SIZE consecutive words of a benchmark item, or all words of a shorter item.
Each document's windows of every length that the benchmark has are hashed and
looked up in the set of benchmark windows; a hit is verified on its words. All
words under a hit are marked. Work grows with the number of document words, and
only hits are shuffled.

Defined results: null and empty texts have no words and are clean; an item
without words has no window; repeated items count once per item_id, and a null
item_id counts as no item; rows with the same doc_id and text get the same
result; extra columns of any name are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, only, staged, whole_text, window_hashes

SIZE = 13
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words in a text whose A-Z are not folded yet, and what lies between.
PIECES = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The set of windows is broadcast up to this size; beyond, Spark joins by shuffle.
BROADCAST_BYTES = 64 << 20
WINDOW_BYTES = 256


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), NOT_WORD), "")


def _place(n_words: Column, sizes: list[int], index: Column) -> tuple[Column, Column]:
    """(first word, size) of the window at ``index`` (from 0) of a text's windows of all sizes, one size after the other."""
    at, size, before = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(0)
    spans = []
    for n in sizes:
        count = F.greatest(n_words - (n - 1), F.lit(0))
        spans.append((n, before, before + count))
        before = before + count
    for n, begin, end in reversed(spans):
        at, size = F.when(index < end, index - begin + 1).otherwise(at), F.when(index < end, F.lit(n)).otherwise(size)
    return at, size


def _hash_of(gram: Column) -> Column:
    """The hash of a whole window, by its size."""
    out = F.lit(None).cast("bigint")
    for size in range(1, SIZE + 1):
        out = F.when(F.size(gram) == size, F.element_at(window_hashes(gram, size), 1)).otherwise(out)
    return out


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per distinct window: its words, their hash, and the items that hold it."""
    items = only(benchmark, item_id=item_id, text=text).select("item_id", words(whole_text("text")).alias("w")).where("size(w) > 0")
    at = F.sequence(F.lit(1), F.greatest(F.size("w") - (SIZE - 1), F.lit(1)))
    grams = items.select("item_id", F.explode(F.transform(at, lambda i: F.slice("w", i, F.lit(SIZE)))).alias("gram"))
    return grams.groupBy("gram").agg(F.collect_set("item_id").alias("items")).select(
        F.size("gram").alias("size"), _hash_of(F.col("gram")).alias("hash"), "gram", "items"
    )


def _by_shuffle(own: DataFrame, each: Column, probe: DataFrame) -> DataFrame:
    """Document windows in a set too large to broadcast: hashes alone are shuffled
    (no words), then each document with a hit is read once more."""
    light = own.select("doc_id", "text_hash", each).join(probe.hint("merge"), F.col("hash") == F.col("g_hash"))
    per_doc = light.groupBy(F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash")).agg(
        F.collect_set(F.struct("index", "gram", "items")).alias("found")
    )
    again = own.join(per_doc.hint("merge"), F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_hash") == F.col("h_hash")))
    return again.select("doc_id", "text_hash", "w", F.inline("found"))


def hits(docs: DataFrame, benchmark: DataFrame, *, doc_id="doc_id", text="text", item_id="item_id", item_text="text") -> DataFrame:
    """(doc_id, text_hash, spans, items) of each document that has a hit.

    spans: (first word, number of words) of each verified window, by first word."""
    grams = staged(benchmark_windows(benchmark, item_id, item_text), "benchmark-windows")
    known = {r["size"]: r["n"] for r in grams.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # SIZE rows at most
    own = only(docs, doc_id=doc_id, text=text).select("doc_id", whole_text("text").alias("t"))
    own = own.select("doc_id", F.xxhash64("t").alias("text_hash"), words(F.col("t")).alias("w"))
    sizes = sorted(known, reverse=True) or [SIZE]
    each = F.posexplode(let(F.col("w"), lambda w: F.concat(*[window_hashes(w, n) for n in sizes]))).alias("index", "hash")
    probe = grams.select(F.col("hash").alias("g_hash"), "gram", "items")
    if sum(known.values()) * WINDOW_BYTES <= BROADCAST_BYTES:
        found = own.select("doc_id", "text_hash", "w", each).join(F.broadcast(probe), F.col("hash") == F.col("g_hash"))
    else:
        found = _by_shuffle(own, each, probe)
    at, size = _place(F.size("w"), sizes, F.col("index"))
    verified = found.select("doc_id", "text_hash", "w", "gram", "items", at.alias("at"), size.alias("size")).where(
        F.slice("w", F.col("at"), F.col("size")) == F.col("gram")
    )
    per_doc = verified.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("at", "size")).alias("spans"),
        F.collect_set("items").alias("items"),
    )
    return per_doc.select("doc_id", "text_hash", F.array_sort("spans").alias("spans"), F.array_distinct(F.flatten("items")).alias("items"))


def _covered(spans: Column) -> Column:
    """Number of words under the spans, which are ordered by their first word."""
    def step(a: Column, s: Column) -> Column:
        end = s["at"] + s["size"]
        return F.struct(
            (a["n"] + F.greatest(F.lit(0), end - F.greatest(s["at"], a["end"]))).alias("n"),
            F.greatest(a["end"], end).alias("end"),
        )
    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), step, lambda a: a["n"])


def report(docs: DataFrame, benchmark: DataFrame, *, doc_id="doc_id", text="text", **names) -> DataFrame:
    """One row per document: (doc_id, n_words, n_hit, items, spans, contaminated, text_hash)."""
    found = hits(docs, benchmark, doc_id=doc_id, text=text, **names)
    own = only(docs, doc_id=doc_id, text=text).select("doc_id", whole_text("text").alias("t")).select(
        F.col("doc_id").alias("id"), F.xxhash64("t").alias("h"), F.size(words(F.col("t"))).cast("long").alias("n_words")
    )
    n_hit = F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("long")
    return own.join(found, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("text_hash")), "left").select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), "items", "spans", F.col("h").alias("text_hash"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def _joined(docs: DataFrame, other: DataFrame, doc_id: str, text: str, how: str) -> DataFrame:
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    key = F.coalesce(F.col(f"row.`{text}`").cast("string"), F.lit(""))
    other = other.withColumnsRenamed({"doc_id": "o_id", "text_hash": "o_hash"})
    # one plan at every size: a merge join
    return row.join(other.hint("merge"), F.col(f"row.`{doc_id}`").eqNullSafe(F.col("o_id")) & (F.xxhash64(key) == F.col("o_hash")), how)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, doc_id="doc_id", text="text", **names) -> DataFrame:
    """The documents of ``docs`` that are not contaminated, with their own columns."""
    found = hits(docs, benchmark, doc_id=doc_id, text=text, **names).select("doc_id", "text_hash", _covered(F.col("spans")).alias("n_hit"))
    row = _joined(docs, found, doc_id, text, "left")
    n_words = F.size(words(F.coalesce(F.col(f"row.`{text}`").cast("string"), F.lit(""))))
    bad = F.when(F.col("n_hit").isNotNull(), F.col("n_hit") * 20 >= n_words).otherwise(F.lit(False))
    return row.where(~bad).select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, doc_id="doc_id", text="text", **names) -> DataFrame:
    """``docs`` with the words under hits cut out of the text; what lies between
    words stays as it is. Texts without a hit, null too, stay untouched."""
    found = hits(docs, benchmark, doc_id=doc_id, text=text, **names).select("doc_id", "text_hash", "spans")
    row = _joined(docs, found, doc_id, text, "left")
    whole = F.coalesce(F.col(f"row.`{text}`").cast("string"), F.lit(""))

    def cut(pieces: Column) -> Column:
        # pieces alternate between words and gaps; piece j is word (j + first) / 2 + 1 if it is a word
        first = F.when(F.regexp_like(F.element_at(pieces, 1), F.lit(r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")), 1).otherwise(0)
        marked = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["size"] - 1))))
        gone = F.transform(marked, lambda w: 2 * (w - 1) + first + 1)
        keep = F.array_except(F.sequence(F.lit(1), F.size(pieces)), gone)
        return F.array_join(F.transform(keep, lambda j: F.element_at(pieces, j)), "")

    clean = F.when(F.col("spans").isNull(), F.col(f"row.`{text}`")).otherwise(
        let(F.regexp_extract_all(whole, F.lit(PIECES), F.lit(0)), cut)
    )
    return row.select(*[(clean if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    items = F.array_sort(F.transform(F.coalesce(F.col("items"), F.array().cast("array<bigint>")), lambda x: x.cast("string")))
    return report(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "contaminated",
    )
