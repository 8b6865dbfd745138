"""Phrase collocations by SON partitioning: mined in shards, then counted exactly.

A phrase is 2 to LONGEST words in a row inside a piece of text, frequent in its
language from SUPPORT occurrences on. It is scored by the weakest of its cuts:
how often the phrase occurs against what its two parts would give by chance.

1. Documents are dealt to SHARDS logical shards by a hash of the id. A phrase that
   reaches the support in a language reaches, in one shard at least, the part of the
   support that is the shard's share of the language's bytes. Each shard is mined
   completely at that lowered support: its pairs first, then the longer phrases
   all of whose pairs are frequent in the shard. A shard is no task: its phrases are
   counted where the documents lie, by 64-bit hashes, and the counts are added by a
   shuffle, so a shard of any size is mined in bounded memory.
2. The union of what is frequent in any shard are the candidates. They go out as
   a bit table of bounded size; what it lets through by chance costs time only.
3. The candidates and all single words are counted over all documents, by their
   words, exactly; what reaches the support stays.
4. Parts and longer phrases are looked up among the frequent phrases (a part occurs
   at least as often as the whole). A phrase inside a longer one that occurs as often
   is also inside one of a single word more: the counts between are the same.

Shards of a fixed number keep the lowered support above one occurrence, whatever
the corpus; a shard a task would need ever more of them.

Defined results: a null text has no words; a null language is ``und``; a text of any
length is taken whole, in stretches; ties are ordered by count, then by the phrase's
bytes; repeated rows count each; rows with a null id share a shard; an empty table
gives no row; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import broadcast_budget
from . import wordhash
from .common import ASCII_UPPER, discard, only, ship, staged, whole_text

LONGEST = 5
SUPPORT = 100
SHARDS = 8
TOP = 2000
#: Parts of a language whose phrases are ranked by tasks of their own first.
PARTS = 64
UNKNOWN = "und"
#: Bytes of text that are worked on in one go, and counted phrases held back before they are sent on.
CHUNK, HELD = 1_000_000, 400_000
#: Texts that a task gathers over all its groups, in chunks: each of the languages' shards should fill one.
GATHERED = 40
#: Bytes of a bit table: 16 bits a frequent phrase, at most so many.
MOST_BYTES = 64 * 1024 * 1024
#: Memory of a frequent phrase in a broadcast; rows (a language, or one in a shard) that are broadcast.
PHRASE_BYTES, SHARES = 256, 100_000

#: Exact where products pass 64 bits.
SCORE = "(CAST(1000 * a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0))) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"

_U = np.uint64
_END = b"\xff"  # between pieces: in no UTF-8 text
_TABLE = bytearray(range(256))
_TABLE[65:91] = _TABLE[97:123]
_TABLE[9] = 32
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = 255
_TABLE = bytes(_TABLE)
_STEPS = wordhash.mix(np.arange(501, 601, dtype=_U)) | _U(1)


def stretches(text: bytes, longest: int, chunk: int) -> Iterator[tuple[bytes, int]]:
    """Text in lower case, pieces ended by _END, in parts of about ``chunk`` bytes that end
    between pieces, or else between words; such a part's last words come first in the
    next one, which says how many they are."""
    text = text.translate(_TABLE)
    at, tail, skip = 0, b"", 0
    while at < len(text):
        end, cut = len(text), False
        if end - at > chunk:
            end = text.find(_END, at + chunk, at + 2 * chunk)
            if end < 0:
                end = text.find(b" ", at + chunk)
                cut = end >= 0
            end = len(text) if end < 0 else end
        part = tail + text[at:end]
        yield part, skip
        last = part[part.rfind(_END) + 1:].split()[1 - longest:] if cut and longest > 1 else []
        tail, skip, at = b" ".join(last), len(last), end


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, piece) of each word."""
    data = np.frombuffer(text, np.uint8)
    mark = data == 255
    solid = ~(mark | (data == 32))
    edges = np.diff(solid.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    power, inverse = wordhash.powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(wordhash.BYTES[data] * power[:len(data)], out=sums[1:])
    found = wordhash.mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U))
    return found, np.searchsorted(np.flatnonzero(mark), starts)


def phrase_hashes(found: np.ndarray, size: int, lang: str) -> np.ndarray:
    """Hash of the ``size`` words from each place on, in a language."""
    n = max(0, len(found) - size + 1)
    out = np.full(n, xxhash.xxh3_64_intdigest(lang.encode(), size), _U)
    for k in range(size if n else 0):
        out += found[k:k + n] * _STEPS[k]
    return wordhash.mix(out)


def phrases_at(piece: np.ndarray, size: int, skip: int) -> np.ndarray:
    """Whether the ``size`` words from each place on are in one piece and not all among the first ``skip``."""
    n = max(0, len(piece) - size + 1)
    return (piece[:n] == piece[size - 1:]) & (np.arange(n) + size > skip)


class Bits:
    """A table of bits, one for each hash in it (and by chance for some others)."""

    def __init__(self, words: np.ndarray):
        self.words, self.last = words, _U(64 * len(words) - 1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        spot = hashes & self.last
        return (self.words[spot >> _U(6)] >> (spot & _U(63)) & _U(1)).astype(bool)


def in_shard(hashes: np.ndarray, shard: int | np.ndarray) -> np.ndarray:
    return wordhash.mix(hashes + (np.asarray([shard], _U) if isinstance(shard, int) else shard) * _STEPS[99])


def _gathered(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[tuple[tuple, bytes]]:
    """Rows (..., text) as (the row without its text, texts of equal such rows joined), of ``chunk`` bytes or more but for the last ones."""
    held: dict[tuple, list[bytes]] = {}
    size: dict[tuple, int] = {}
    total = 0
    for batch in batches:
        keys = list(zip(*[c.to_pylist() for c in batch.columns[:-1]]))
        for key, text in zip(keys, batch.column(batch.num_columns - 1)):
            raw = text.as_buffer()
            if raw is None or not raw.size:
                continue
            held.setdefault(key, []).append(raw.to_pybytes())
            size[key] = size.get(key, 0) + raw.size
            total += raw.size
            if size[key] >= chunk:
                total -= size.pop(key)
                yield key, _END.join(held.pop(key))
            elif total >= GATHERED * chunk:  # many keys: the fullest goes
                most = max(size, key=size.__getitem__)
                total -= size.pop(most)
                yield most, _END.join(held.pop(most))
    for key in list(held):
        yield key, _END.join(held.pop(key))


_MINED = "phrase long, tag long, n long"


def _mine(longest: int, pairs=None, chunk: int = CHUNK) -> Callable:
    """(lang, shard, tag, text) -> (phrase, tag, n): counts of hashed phrases, of pairs, or of
    longer phrases whose pairs are all in the broadcast table ``pairs``."""

    def mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if pairs is None else Bits(np.frombuffer(pairs.value, _U))
        for (lang, shard, tag), text in _gathered(batches, chunk):
            for part, skip in stretches(text, longest, chunk):
                found, piece = word_hashes(part)
                wanted = []
                pair = phrase_hashes(found, 2, lang)
                if table is None:
                    wanted.append(pair[phrases_at(piece, 2, skip)])
                else:
                    frequent = all_frequent = table.holds(in_shard(pair, shard))
                    for size in range(3, longest + 1):
                        all_frequent = all_frequent[:-1] & frequent[size - 2:]
                        wanted.append(phrase_hashes(found, size, lang)[phrases_at(piece, size, skip) & all_frequent])
                phrases, n = np.unique(np.concatenate([np.empty(0, _U), *wanted]), return_counts=True)
                if len(phrases):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(phrases.view(np.int64)), pa.array(np.full(len(n), tag)), pa.array(n)], names=["phrase", "tag", "n"]
                    )

    return mined


def _reaching(shards: int) -> Callable:
    """(phrase, tag, n) in order -> (shard, phrase) of those that reach the support in their tag."""

    def reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrase, tag, n = (np.empty(0, np.int64) for _ in range(3))

        def out(ends: int) -> pa.RecordBatch:
            """Of the rows before ``ends``, whose counts are all there."""
            first = np.flatnonzero(np.concatenate(([True], (phrase[1:ends] != phrase[:ends - 1]) | (tag[1:ends] != tag[:ends - 1]))))
            enough = first[np.add.reduceat(n[:ends], first) >= tag[first] // shards]
            return pa.RecordBatch.from_arrays([pa.array((tag[enough] % shards).astype(np.int32)), pa.array(phrase[enough])], names=["shard", "phrase"])

        for batch in batches:
            phrase, tag, n = (np.concatenate((old, batch.column(k).to_numpy())) for k, old in enumerate((phrase, tag, n)))
            new = np.flatnonzero((phrase[1:] != phrase[:-1]) | (tag[1:] != tag[:-1]))
            if len(new):
                ends = int(new[-1]) + 1
                yield out(ends)
                phrase, tag, n = phrase[ends:], tag[ends:], n[ends:]
            elif len(n):  # one phrase so far
                phrase, tag, n = phrase[:1], tag[:1], n.sum(keepdims=True)
        if len(n):
            yield out(len(n))

    return reaching


class _Names(dict):
    """Word -> number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _count(longest: int, candidates, chunk: int = CHUNK) -> Callable:
    """(lang, text) -> (lang, size, phrase, n): all words (size 0), single words, phrases among the candidates."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Bits(np.frombuffer(candidates.value, _U))
        held: dict[str, dict[tuple[int, bytes], int]] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for lang in list(held):
                found = held.pop(lang)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(found), pa.string()), pa.array([s for s, _ in found], pa.int32()),
                        pa.array([p for _, p in found], pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64()),
                    ],
                    names=["lang", "size", "phrase", "n"],
                )

        for (lang,), text in _gathered(batches, chunk):
            for part, skip in stretches(text, longest, chunk):
                words = part.replace(_END, b" ").split()
                if not words:
                    continue
                own = held.setdefault(lang, {})
                found, piece = word_hashes(part)
                names = _Names()
                codes = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
                own[0, b""] = own.get((0, b""), 0) + len(words) - skip
                often = np.bincount(codes[skip:], minlength=len(names))
                for word, k in zip(names, often.tolist()):
                    own[1, word] = own.get((1, word), 0) + k
                for size in range(2, longest + 1):
                    hashes = phrase_hashes(found, size, lang)
                    places = np.flatnonzero(phrases_at(piece, size, skip) & table.holds(hashes))
                    if not len(places):
                        continue
                    _, first, which, n = np.unique(hashes[places], return_index=True, return_inverse=True, return_counts=True)
                    rows = codes[places[:, None] + np.arange(size)]
                    if (rows != rows[first[which]]).any():  # two phrases of one hash
                        _, first, n = np.unique(rows, axis=0, return_index=True, return_counts=True)
                    for p, k in zip(places[first].tolist(), n.tolist()):
                        phrase = size, b" ".join(words[p:p + size])
                        own[phrase] = own.get(phrase, 0) + k
                if sum(len(x) for x in held.values()) > HELD:
                    yield from sent()
        yield from sent()

    return counted


def _bit_table(hashes: DataFrame, n: int, most_bytes: int):
    """A broadcast table with the bits of ``n`` hashes (column ``phrase``), 16 bits for each or ``most_bytes`` in all."""
    words = 1 << max(10, min(n // 4, most_bytes // 8).bit_length() - 1)
    spot = hashes.select(F.col("phrase").bitwiseAND(64 * words - 1).alias("spot"))
    rows = spot.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(spot & 63 AS INT))")).alias("bits")).toArrow()
    table = np.zeros(words, _U)
    table[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(_U)
    return hashes.sparkSession.sparkContext.broadcast(table.tobytes())


def _own_spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, phrase) -> (phrase): the hash that stands for the phrase in its shard."""
    for batch in batches:
        phrase, shard = batch.column(1).to_numpy().view(_U), batch.column(0).to_numpy().astype(_U)
        yield pa.RecordBatch.from_arrays([pa.array(in_shard(phrase, shard).view(np.int64))], names=["phrase"])


def _frequent(parted: DataFrame, mine: Callable, shards: int) -> DataFrame:
    """(shard, phrase) of what reaches its shard's part of the support. Few phrases come
    twice from one task: their counts are added once, in order, which Spark's sort spills."""
    dealt = parted.mapInArrow(mine, _MINED).repartition("phrase", "tag").sortWithinPartitions("phrase", "tag")
    return dealt.mapInArrow(_reaching(shards), "shard int, phrase long")


def _sent_out(df: DataFrame, most_rows: int) -> DataFrame:
    """Broadcast if it is a small table, else joined as Spark sees fit."""
    return F.broadcast(df) if df.count() <= most_rows else df


def frequent_phrases(
    docs: DataFrame, *, doc_id="doc_id", text="text", lang="lang", longest=LONGEST, support=SUPPORT, shards=SHARDS,
    chunk=CHUNK, most_bytes=MOST_BYTES,
) -> DataFrame:
    """(lang, size, phrase, n): phrases and words with ``support`` occurrences or more, and all
    words of a language together (size 0, an empty phrase)."""
    ship(docs.sparkSession)
    own = only(docs, doc_id=doc_id, text=text, lang=lang).select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(shards)).cast("int").alias("shard"), whole_text("text").alias("text"),
    )
    sizes = own.groupBy("lang", "shard").agg(F.sum(F.octet_length("text")).alias("in_shard"))
    sizes = sizes.withColumn("in_lang", F.greatest(F.sum("in_shard").over(Window.partitionBy("lang")), F.lit(1)))
    # a shard's part of the support, rounded up, and the shard in one number
    least = F.expr(f"({int(support)}L * in_shard + in_lang - 1) div in_lang")
    sizes = staged(sizes.select(F.col("lang").alias("s_lang"), F.col("shard").alias("s_shard"), (least * shards + F.col("shard")).alias("tag")), "colloc-shares")
    same = (F.col("lang") == F.col("s_lang")) & (F.col("shard") == F.col("s_shard"))
    parted = own.join(_sent_out(sizes, SHARES), same).select("lang", "shard", "tag", "text")
    pairs = staged(_frequent(parted, _mine(longest, None, chunk), shards), "colloc-pairs")
    table = _bit_table(pairs.mapInArrow(_own_spots, "phrase long"), pairs.count(), most_bytes)
    longer = staged(_frequent(parted, _mine(longest, table, chunk), shards), "colloc-longer")
    candidates = staged(pairs.unionByName(longer).select("phrase").distinct(), "colloc-candidates")
    table = _bit_table(candidates, candidates.count(), most_bytes)
    counts = own.select("lang", "text").mapInArrow(_count(longest, table, chunk), "lang string, size int, phrase string, n long")
    total = counts.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    found = staged(total.where((F.col("n") >= support) | (F.col("size") == 0)), "colloc-counts")
    discard(sizes, pairs, longer, candidates)
    return found


def _words(c: str) -> Column:
    return F.split(F.col(c), " ", -1)


def collocations(
    docs: DataFrame, *, doc_id="doc_id", text="text", lang="lang", longest=LONGEST, support=SUPPORT, shards=SHARDS, top=TOP,
    chunk=CHUNK, most_bytes=MOST_BYTES, broadcast_bytes: int | None = None,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases.

    a, l, r: occurrences of the phrase and of the two parts of its weakest cut; n: words
    of the language; score: 1000 * a * n / (l * r), floored."""
    found = frequent_phrases(
        docs, doc_id=doc_id, text=text, lang=lang, longest=longest, support=support, shards=shards, chunk=chunk, most_bytes=most_bytes
    )
    budget = broadcast_budget(docs.sparkSession) if broadcast_bytes is None else broadcast_bytes
    few = budget // PHRASE_BYTES
    parts = found.where("size > 0")
    whole = found.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"))
    # a phrase is inside a longer one that occurs as often: inside one of a single word more
    inner = F.array(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1))
    longer = whole.where("size > 2").withColumn("w", _words("phrase")).select(F.col("lang").alias("o_lang"), "a", F.explode(inner).alias("w"))
    longer = longer.groupBy("o_lang", F.array_join("w", " ").alias("o_phrase")).agg(F.max("a").alias("outer_a"))
    own = (F.col("lang") == F.col("o_lang")) & (F.col("phrase") == F.col("o_phrase"))
    left = whole.join(longer, own, "left").where("outer_a IS NULL OR outer_a < a").select("lang", "size", "phrase", "a")
    cuts = left.withColumn("w", _words("phrase")).select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"),
    )
    looked_up = _sent_out(parts.select(F.col("lang").alias("p_lang"), F.col("phrase").alias("p_phrase"), F.col("n").alias("p_n")), few)
    for part, name in (("head", "l"), ("rest", "r")):
        same = (F.col("lang") == F.col("p_lang")) & (F.col(part) == F.col("p_phrase"))
        cuts = cuts.join(looked_up, same).drop("p_lang", "p_phrase").withColumnRenamed("p_n", name)
    words = _sent_out(found.where("size = 0").select(F.col("lang").alias("n_lang"), F.col("n").alias("n")), SHARES)
    scored = cuts.join(words, F.col("lang") == F.col("n_lang")).withColumn("score", F.expr(SCORE))
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    # the best of parts of a language first: at most ``top`` rows of each part come together in the end
    best = [F.desc("cut.score"), F.desc("cut.a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = weakest.withColumn("in_part", F.row_number().over(Window.partitionBy("lang", part).orderBy(*best))).where(F.col("in_part") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def query(docs: DataFrame) -> DataFrame:
    return collocations(docs)


ORACLE = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), phrases AS (
  SELECT lang, m AS size, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase
  FROM words, range(1, 6) AS sizes(m)
), counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY ALL
), totals AS (
  SELECT lang AS n_lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang
), frequent AS (
  SELECT * FROM counts WHERE f >= 100
), inner_phrases AS (
  SELECT lang, size, array_to_string(string_split(phrase, ' ')[i:j], ' ') AS phrase, f
  FROM frequent, range(1, 6) AS starts(i), range(1, 6) AS stops(j) WHERE i <= j AND j <= size
), outer_most AS (
  SELECT i.lang, i.phrase, max(i.f) AS f FROM inner_phrases i JOIN frequent o ON i.lang = o.lang AND i.phrase = o.phrase AND i.size > o.size GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k,
         array_to_string(string_split(c.phrase, ' ')[1:k], ' ') AS head, array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ') AS rest
  FROM frequent c LEFT JOIN outer_most o ON c.lang = o.lang AND c.phrase = o.phrase, range(1, 5) AS ks(k)
  WHERE c.size > 1 AND k < c.size AND (o.f IS NULL OR 100 * o.f < 100 * c.f)
), scored AS (
  SELECT c.lang, c.phrase, c.a, h.f AS l, r.f AS r, t.n, k, (1000::HUGEINT * c.a * t.n) // (h.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN frequent h ON h.lang = c.lang AND h.phrase = c.head JOIN frequent r ON r.lang = c.lang AND r.phrase = c.rest
  JOIN totals t ON t.n_lang = c.lang
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
WHERE rank <= 2000
"""
