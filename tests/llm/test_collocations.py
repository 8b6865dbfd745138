"""Phrases and their scores against brute force, at several shard counts and table sizes."""

import re
from collections import Counter

import pytest

from sluice.llm import collocations

from llm_cases import documents, prose, rnd

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, support, longest, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    found = {}
    often = {p: a for p, a in f.items() if a >= support and len(p) > 2}
    covered = set()
    for p, a in often.items():
        w = p[1:]
        for m in range(2, len(w)):
            covered.update((p[0], *w[i:i + m]) for i in range(len(w) - m + 1) if f[(p[0], *w[i:i + m])] <= a)
    for p, a in often.items():
        if p in covered:
            continue
        cuts = []
        for k in range(2, len(p)):
            l, r = f[p[:k]], f[(p[0], *p[k:])]
            cuts.append((1000 * a * n[p[0]] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        found.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), l, r))
    return Counter(
        (lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
        for lang, rows in found.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])
    )


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.fixture(scope="module")
def docs(spark):
    r = rnd(5)
    fixed = ["New York City", "in Spite of the", "é è ê", "\x0b tab\tbed\tend", "A-b c"]
    texts = [None, "", " ,;\n\t", "one", "same words " * 40, "no stop " * 3000, "a, b, a. b! a? b; a b"]
    for _ in range(80):
        texts.append("".join(r.choice([prose(r, r.randint(1, 4), "abc"), r.choice(fixed)]) + r.choice([" ", "  ", ". ", "\n", ",", ": "]) for _ in range(30)))
    return documents(spark, texts, langs=("en", "de", None, "en", "und", "fr "))


@pytest.mark.parametrize("options", [
    {}, {"shards": 1}, {"shards": 7, "chunk": 300}, {"most_bytes": 8}, {"broadcast_bytes": 0}, {"shards": 40, "top": 5}, {"longest": 3, "support": 30},
])
def test_against_brute_force(docs, options):
    options = {"support": 12, "shards": 4, "longest": 5, "top": 2000} | options
    got = collocations.collocations(docs, **options)
    rows = [(x["lang"], x["text"]) for x in docs.select("lang", "text").collect()]
    assert Counter(tuple(x) for x in got.select(*COLUMNS).collect()) == brute(rows, options["support"], options["longest"], options["top"])
    assert got.count() >= 15


def test_query(docs):
    rows = [(x["lang"], x["text"]) for x in docs.select("lang", "text").collect()]
    got = collocations.query(docs)
    assert Counter(tuple(x) for x in got.select(*COLUMNS).collect()) == brute(rows, 100, 5, 2000)
    assert got.count() and collocations.query(docs.limit(0)).count() == 0


def test_wide_products(spark):
    """A score whose products pass 64 bits is exact."""
    a, n, l, r = 9_876_543_210, 98_765_432_109_876, 123_456_789_012, 9_876_543_219
    row = spark.sql(f"SELECT {collocations.SCORE} AS s FROM (SELECT {a}L AS a, {n}L AS n, {l}L AS l, {r}L AS r)").first()
    assert row["s"] == 1000 * a * n // (l * r)


def test_cut_stretches():
    """Stretches without a mark between pieces are cut between words and lose or repeat no phrase."""
    text = ("x y z " * 50).encode()
    whole, cut = Counter(), Counter()
    for chunk, into in ((10_000, whole), (20, cut)):
        for part, skip in collocations.stretches(text, 5, chunk):
            words, (_, piece) = part.split(), collocations.word_hashes(part)
            for size in range(1, 6):
                into.update((*words[i:i + size],) for i in collocations.phrases_at(piece, size, skip).nonzero()[0].tolist())
    assert whole == cut and len(whole) == 15
