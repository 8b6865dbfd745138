"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

Ordinary words are few tokens of a byte-pair vocabulary; random strings fall
apart into many. A run of key characters is cut at + / _ = -, and each maximal
stretch of its parts that has MIN_CHARS characters and at most MAX_RATIO characters
per token is reported as ``random`` (stretches that overlap as one span), so words
that are joined to a random string do not hide it. Known digests (hex of a usual
digest length) and UUIDs end a stretch; numbers alone are not reported. The fixed
patterns (assign, access, hex) are reported whatever the test says; their spans
end a stretch too.

The vocabulary's file is a parameter; each worker loads it once. Texts are
scanned whole, each by itself: nothing is shuffled.

Defined results: a null or empty text has no span; repeated rows are scanned
alike; extra columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, takewhile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, ship, whole_text

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MIN_CHARS = 20
MAX_RATIO = 1.9

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: The failing matches of these two patterns can be left out of the search itself:
#: a run that is too short hides no longer one.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_CHARS)
DIGESTS = {32, 40, 48, 56, 64, 96, 128}
IDENTIFIER = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9+/_=-]+", re.A)
HEX_WORD = re.compile(r"[0-9a-f]+|[0-9A-F]+")
PART = re.compile(r"[A-Za-z0-9]+|[+/_=-]+")
UUID = re.compile(r"(?<![A-Za-z0-9])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![A-Za-z0-9])")
KINDS = ("assign", "access", "hex", "random")
#: Splits a run into letters, digits and the rest before the vocabulary's merges.
PATTERN = r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]+"


@lru_cache(maxsize=2)
def _encoding(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as fh:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in fh if line.strip())}
    return tiktoken.Encoding("secrets", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by start and then kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def stretches(parts: list[tuple[int, int]], scores: list[int]) -> list[tuple[int, int]]:
    """(start, end) of the maximal stretches of adjoining parts whose scores sum to
    0 or more and that have MIN_CHARS characters, by start; those that overlap as one."""
    sums = list(accumulate(scores, initial=0))
    best = list(accumulate(reversed(sums), max))[::-1]  # the greatest sum from each place on
    out: list[tuple[int, int]] = []
    least, j = float("inf"), 0
    for i, total in enumerate(sums[:-1]):
        if total >= least:  # an earlier start reaches as far
            continue
        least = total
        reach = j
        while j + 1 < len(sums) and best[j + 1] >= total:
            j += 1
        if j > max(reach, i) and parts[j - 1][1] - parts[i][0] >= MIN_CHARS:
            start, end = parts[i][0], parts[j - 1][1]
            if out and start < out[-1][1]:
                start = out.pop()[0]
            out.append((start, end))
    return out


def random_spans(text: str, known: list[tuple[int, int, int]], path: str, max_ratio: float) -> list[tuple[int, int, int]]:
    out, encode = [], None
    fixed, i = sorted((s, e) for s, _, e in known), 0
    for m in RUN.finditer(text):
        run, first = m[0], m.start()
        if IDENTIFIER.fullmatch(run):
            continue
        while i < len(fixed) and fixed[i][1] <= first:
            i += 1
        walls = [(max(s, first), e) for s, e in takewhile(lambda x: x[0] < m.end(), fixed[i:]) if e > first]
        walls += [(first + u.start(), first + u.end()) for u in UUID.finditer(run)]
        walls += [(first + h.start(), first + h.end()) for h in PART.finditer(run) if len(h[0]) in DIGESTS and HEX_WORD.fullmatch(h[0])]
        at = first
        for s, e in [*sorted(walls), (m.end(), m.end())]:
            if s - at >= MIN_CHARS:
                encode = encode or _encoding(path).encode_ordinary
                parts = [(p.start(), p.end()) for p in PART.finditer(text, at, s)]
                # the vocabulary's merges stay within letters, digits or the rest, so a stretch has its parts' tokens
                scores = [round(max_ratio * 1e6) * len(encode(text[a:b])) - 1_000_000 * (b - a) for a, b in parts]
                out += [(a, 3, b) for a, b in stretches(parts, scores) if not IDENTIFIER.fullmatch(text, a, b)]
            at = max(at, e)
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, vocabulary: str = VOCABULARY, max_ratio: float = MAX_RATIO, *, doc_id="doc_id", text="text") -> DataFrame:
    """One row per document: (doc_id, n_assign, n_access, n_hex, n_random, base_spans, spans)."""
    ship(docs.sparkSession)
    own = only(docs, doc_id=doc_id, text=text).select("doc_id", whole_text("text").alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base_out, all_out = ([], [], [], []), [], []
            for value in batch.column(1):
                text = value.as_py()
                base = base_spans(text)
                spans = sorted(base + random_spans(text, base, vocabulary, max_ratio))
                for k, n in enumerate(counts):
                    n.append(sum(1 for s in spans if s[1] == k))
                base_out.append(joined(base))
                all_out.append(joined(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(n, pa.int64()) for n in counts], pa.array(base_out, pa.string()), pa.array(all_out, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_spans", "spans"],
            )

    return own.mapInArrow(
        scanned, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_random long, base_spans string, spans string"
    )


def query(docs: DataFrame) -> DataFrame:
    return scan(docs).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_random",
    )
