"""Lyndon arrays, runs and collapsed texts against brute force."""

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest

from sluice.llm import periodic

from llm_cases import documents, prose, rnd


def brute_lyndon(ranks):
    out = []
    for i in range(len(ranks)):
        j = i + 1
        while j < len(ranks) and ranks[j:] > ranks[i:]:
            j += 1
        out.append(j - i)
    return out


def brute_runs(w, least, power):
    out = set()
    for p in range(1, len(w) // power + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            x = w[i:j + p]
            if len(x) >= max(least, power * p) and not any(x[q:] == x[:-q] for q in range(1, p)):
                out.add((i, len(x), p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_lyndon_array():
    r = rnd(1)
    for _ in range(1500):
        w = [r.randrange(r.randint(1, 4)) for _ in range(r.randint(1, 40))]
        if r.random() < 0.3:
            w = (w[:r.randint(1, 6)] * 40)[:len(w)]
        w = [sorted(set(w)).index(x) for x in w]
        assert periodic.lyndon_array(w) == brute_lyndon(w)
    assert periodic.lyndon_array([]) == []
    assert periodic.lyndon_array([0] * 50_000) == [1] * 50_000
    assert periodic.lyndon_array(list(range(50_000)))[0] == 50_000


@pytest.mark.parametrize("least, power", [(24, 3), (3, 3), (6, 4)])
def test_runs(least, power):
    r = rnd(2)
    some = 0
    for _ in range(1000):
        n = r.randint(1, 120)
        w = [b"%d" % r.randrange(r.randint(1, 4)) for _ in range(n)]
        for _ in range(r.randint(0, 3)):
            a, p = r.randrange(n), r.randint(1, 9)
            w[a:] = [w[min(a + i % p, n - 1)] for i in range(n - a)]
        want = brute_runs(w, least, power)
        assert periodic.runs_of(w, least, power) == want
        some += len(want)
    assert some > 200


def brute(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w, 24, 3) if n < 3000 else periodic.runs_of([x.encode() for x in w])
    keep = [x for i, x in enumerate(w) if not any(s + p <= i < s + length for s, length, p in runs)]
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None, sha(lines), sha(" ".join(keep)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query(spark):
    r = rnd(3)
    turn = prose(r, 11)
    texts = [
        None, "", " \n\t", "a", "na " * 23, "na " * 24, "na " * 2000, f"{turn} " * 3, f"{prose(r, 30)} {turn}  {turn}\n{turn} {turn} {prose(r, 9)}",
        "a b " * 20 + "c d e " * 15 + "a b " * 20, "é ü\x0b" * 30, "x " + "a a b " * 12 + "a a", prose(r, 60_000) + f" {turn}" * 9,
        ("a b a b a b a b c " * 5 + "d ") * 4,
    ] + [prose(r, r.randint(1, 150)) for _ in range(60)]
    docs = documents(spark, texts, ids=[10**10 + i if i % 7 == 0 else -i for i in range(len(texts))])
    got = periodic.query(docs)
    assert set(COLUMNS) <= set(got.columns)
    rows = [(x["doc_id"], x["text"]) for x in docs.select("doc_id", "text").collect()]
    assert Counter(tuple(x) for x in got.select(*COLUMNS).collect()) == Counter(brute(*x) for x in rows)
    assert any(x["n_runs"] > 1 for x in got.collect())
    assert periodic.query(docs.limit(0)).count() == 0


def test_operator(spark):
    docs = documents(spark, ["go on " * 20 + "stop", "once only"])
    got = {x["doc_id"]: x for x in periodic.periodic_runs(docs).collect()}
    assert got[0]["runs"] == [(0, 40, 2)] and got[0]["collapsed"] == "go on stop" and got[0]["n_words"] == 41
    assert got[1]["runs"] == [] and got[1]["collapsed"] == "once only"
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, power=2)
