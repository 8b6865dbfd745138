"""Each operator against brute force over edge cases: nulls, empty and long texts,
ties, repeated rows, empty tables, extra columns whose names clash."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.llm import chat, decontam, langid, mixing, neardup, quality, resharding, secrets, suffixes, urlfilter

SPACE = r"[^\x20\x09-\x0D]+"
CLASHES = ["text_hash", "size", "shard", "class_id", "row", "kept", "spans", "key", "band", "label", "doc", "tag", "m", "s", "id", "t"]


def _texts():
    rnd = random.Random(7)
    words = ["w%s" % "".join(rnd.choices("abcdefghij", k=rnd.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rnd.choices(words, k=n))
    base, passage = prose(120), prose(60)
    edited = base.split()
    edited[60] = "changed"
    bench = prose(40)
    long = prose(20_000) + " " + base
    texts = [
        None, "", " \n\t", "a", "same few words", "same few words", base, base, " ".join(edited), base + " tail",
        prose(30) + "\n" + passage + "\n" + prose(30), prose(50) + " " + passage, passage, long, "line one\nline one\n \nline two\nline one",
        prose(12) + " " + bench + " " + prose(8), " ".join(prose(9) for _ in range(1)) + " ### $$$ |||", "é" * 150, "é" * 150 + "x", "ab" * 300,
        'password = "hunter22abc" key AKIA' + "Q7" * 10 + " " + "0f" * 16, "token: ab secret=ghijkl zq8Kp2Xv9Lm4Tr7Wn3Yb6", (prose(8) + " ") * 6,
    ]
    return texts, bench


@pytest.fixture(scope="module")
def docs(spark):
    texts, _ = _texts()
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "a", "b", "a"][i % 4]) for i, t in enumerate(texts)]
    rows += [rows[6], rows[13], (None, texts[6], "en", "a"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES]).repartition(3)


def rows_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def test_secrets(docs):
    enc = secrets._encoding(secrets.VOCABULARY)
    got = Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"], r["spans"]) for r in secrets.query(docs).collect())
    want = Counter()
    for i, t in rows_of(docs):
        base = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN.pattern, t, re.I | re.A) if len(m[2]) >= 6]
        base += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        base += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
        base.sort()
        more = [
            (m.start(), 3, m.end()) for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", t)
            if not secrets.IDENTIFIER.fullmatch(m[0]) and not any(s < m.end() and m.start() < e for s, _, e in base)
            and not (re.fullmatch("[0-9a-f]+|[0-9A-F]+", m[0]) and len(m[0]) in secrets.DIGESTS)
            and len(m[0]) <= secrets.MAX_RATIO * len(enc.encode_ordinary(m[0]))
        ]
        kinds = [sum(1 for s in base if s[1] == k) for k in range(3)]
        want[(i, *kinds, hashlib.sha256(secrets.joined(base).encode()).hexdigest(), secrets.joined(sorted(base + more)))] += 1
    assert got == want
    assert any("random:" in r[5] for r in got)


def spans_of(text):
    return secrets.random_spans(text, secrets.base_spans(text), secrets.VOCABULARY, secrets.MAX_RATIO)


def test_secrets_of_letters_only():
    rnd = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    keys = ["".join(rnd.choices(letters, k=k)) for k in (20, 32, 40) for _ in range(100)]
    assert sum(spans_of(f"see {k} there") == [(4, 3, 4 + len(k))] for k in keys) >= 297
    for plain in ("getUserNameFromDatabase", "InternalServerErrorException", "client_authorization_header", "-" * 40, "1234567890" * 3, "2024-11-05/2024-11-06/17", "550e8400-e29b-41d4-a716-446655440000"):
        assert not spans_of(plain), plain


def test_secrets_inside_runs():
    rnd = random.Random(4)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for before, after in (("documents/archive/downloads/reports/", ""), ("client_authorization_header=", "/documents/archive"), ("hooks/services/incoming/", "_production_environment")):
        keys = ["".join(rnd.choices(chars, k=k)) for k in (20, 32, 40) for _ in range(100)]
        found = [spans_of(f"see {before}{k}{after} there") for k in keys]
        assert sum(len(f) == 1 and f[0][0] <= 4 + len(before) and f[0][2] >= 4 + len(before) + len(k) for f, k in zip(found, keys)) >= 295
    digest, uuid = "0F" * 16, "550e8400-e29b-41d4-a716-446655440000"
    for plain in ("documents/archive/downloads/reports/production", f"documents/archive/{uuid}/reports", f"archive/{digest}/reports", f"archive={'0f' * 20}_reports"):
        assert not spans_of(plain), plain
    key = "zq8Kp2Xv9Lm4Tr7Wn3Yb6"
    assert len(spans_of(f"{key}/{uuid}/documents/archive/downloads/reports/{key}")) == 2
    # beside a span of a fixed pattern
    assert [s[0] for s in spans_of(f"{key}/archive/api_key=hunter22abc")] == [0]


def test_secret_stretches():
    """Against every stretch: those at or over 0 that no longer one holds, joined where they overlap."""
    rnd = random.Random(5)
    for _ in range(300):
        ends = [0]
        for _ in range(rnd.randint(0, 12)):
            ends.append(ends[-1] + rnd.randint(1, 15))
        parts, scores = list(zip(ends, ends[1:])), [rnd.randint(-6, 5) for _ in ends[1:]]
        good = [(i, j) for i in range(len(parts)) for j in range(i + 1, len(parts) + 1) if sum(scores[i:j]) >= 0]
        longest = [(i, j) for i, j in good if not any((a, b) != (i, j) and a <= i and j <= b for a, b in good)]
        want = []
        for i, j in sorted(longest):
            a, b = parts[i][0], parts[j - 1][1]
            if b - a >= secrets.MIN_CHARS:
                want.append((want.pop()[0] if want and a < want[-1][1] else a, b))
        assert secrets.stretches(parts, scores) == want


def shingle_bag(t):
    w = re.findall(SPACE, t.translate({c: c + 32 for c in range(65, 91)}))
    return Counter(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def test_near_duplicates(docs):
    got = {r["doc_id"]: r["class_id"] for r in neardup.query(docs).collect() if r["doc_id"] is not None}
    bags = {i: shingle_bag(t) for i, t in rows_of(docs) if i is not None}
    label = {i: i for i in bags}
    for _ in bags:
        for i, a in bags.items():
            for j, b in bags.items():
                both = sum((a & b).values())
                if both and both / (sum(a.values()) + sum(b.values()) - both) >= 0.8:
                    label[i] = min(label[i], label[j])
    assert got == label
    nulls = Counter(r["class_id"] for r in neardup.query(docs).where("doc_id IS NULL").collect())
    assert nulls == Counter([6, None])  # a null id joins the class of an equal text
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(i for i, _ in rows_of(kept)) == Counter([i for i in label if label[i] == i] + [None])


def test_near_duplicates_of_one_hot_bucket(spark):
    """A third of all texts are near copies of one text: one class, however the bucket is spread."""
    rnd = random.Random(3)
    base = [f"b{i}" for i in range(400)]
    rows = [(k, " ".join(base[:k] + ["x%d" % k] + base[k + 1:])) for k in range(200)]
    rows += [(1000 + k, " ".join(f"r{rnd.random()}" for _ in range(30))) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in neardup.query(df).collect()}
    assert got == {i: 0 if i < 1000 else i for i, _ in rows}


def test_bagminhash_is_unbiased():
    import numpy as np

    rnd = np.random.default_rng(3)
    a = {i: int(rnd.integers(1, 9)) for i in range(60)}
    b = {i: max(1, v + int(rnd.integers(-2, 3))) for i, v in a.items() if i > 5} | {i: 2 for i in range(100, 104)}
    keys = set(a) | set(b)
    true = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    sign = lambda bag: neardup.signatures(
        np.array(list(bag.values())), neardup.wordhash.mix(np.array(list(bag), np.uint64)), np.zeros(len(bag), int), 1, 4000)[0]
    assert abs((sign(a) == sign(b)).mean() - true) < 0.03


def test_cells_find_the_same_links(spark, monkeypatch):
    """A chain of texts, each alike only to the next: blocks of any size connect it."""
    words = [f"w{i}" for i in range(260)]
    chain = [" ".join(words[5 * k:5 * k + 120]) for k in range(20)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(chain)], "doc_id long, text string")
    for cell in (2000, 3):
        monkeypatch.setattr(neardup, "CELL", cell)
        assert {r["class_id"] for r in neardup.query(df).collect()} == {0}


def test_chat(spark):
    text = "</s>[INST] ok [/INST] <\\|im_end|> <<SYS>> a\\b"
    rows = [(1, 1, "assistant", text), (1, 0, "user", None), (1, 1, "assistant", text), (2, None, None, ""), (None, 0, "we%ird\nrole", "x" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["conv_id"]: r for r in chat.format_conversations(df).withColumn("back", chat.read_back(F.col("formatted"))).collect()}
    said = lambda k: [(t["role"], t["text"]) for t in out[k]["back"]]
    assert said(1) == [("user", ""), ("assistant", text), ("assistant", text)]
    assert said(2) == [("", "")] and said(None) == [("we%ird\nrole", "x" * 50_000)]
    for r in out.values():
        for c in chat.CONTROL:
            assert not any(c in s["text"] for s in r["segments"] if s["loss"])
    assert chat.format_conversations(df.limit(0)).count() == 0
    one = {r["conv_id"]: r for r in chat.query(df).collect()}
    assert one[-1]["n_turns"] == 2 and one[-1]["loss_chars"] == len("</s>[INST] ok [/INST]")


def test_chat_layouts(spark):
    rows = [
        (1, "p", "r", None, None, None, None), (2, None, None, "i", None, "o", None), (3, None, None, "i", "c", "o", None),
        (4, None, None, None, None, None, [("user", "hi"), ("assistant", None)]), (5, "p", None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id long, prompt string, response string, instruction string, input string, output string, messages array<struct<role:string,content:string>>")
    got = {r["id"]: (r["layout"], [(t["role"], t["text"]) for t in r["turns"]]) for r in chat.canonical(df, ["id"]).collect()}
    assert got == {
        1: ("prompt_response", [("user", "p"), ("assistant", "r")]), 2: ("instruction", [("user", "i"), ("assistant", "o")]),
        3: ("instruction_input", [("user", "i\n\nc"), ("assistant", "o")]), 4: ("messages", [("user", "hi"), ("assistant", "")]), 5: (None, []),
    }


def test_mixing(docs, spark):
    df = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.lit("w"), (F.col("id") % 7).cast("int"))).alias("text"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
        F.when(F.col("id") % 11 > 0, F.element_at(F.array(F.lit("en"), F.lit("de")), (F.col("id") % 2 + 1).cast("int"))).alias("lang"),
    )
    targets = {"source": 0.5, "lang": {"en": 0.5, "de": 0.3}}
    cells = df.groupBy("source", "lang").agg(F.sum(mixing.tokens(F.col("text"))).alias("tokens"))
    raked = mixing.probabilities(mixing.rake(cells, targets), 0.6).collect()
    by_lang, total = defaultdict(float), sum(r["tokens"] for r in raked)
    for r in raked:
        by_lang[r["lang"]] += r["weight"]
    assert by_lang == pytest.approx({"en": 0.5, "de": 0.3, None: 0.2}, abs=1e-6)
    assert sum(r["tokens"] * r["probability"] for r in raked) == pytest.approx(0.6 * total, rel=1e-6)
    weight = {(r["source"], r["lang"]): float(r["tokens"]) for r in raked}
    now = {m: Counter() for m in range(2)}
    for k, v in weight.items():
        for m in range(2):
            now[m][k[m]] += v
    flat = sum(v ** 0.5 for v in now[0].values())
    goals = [{k: v ** 0.5 / flat for k, v in now[0].items()}, {"en": 0.5, "de": 0.3, None: 0.2}]
    for _ in range(200):
        for m in range(2):
            sums = Counter()
            for k, v in weight.items():
                sums[k[m]] += v
            weight = {k: v * goals[m][k[m]] / sums[k[m]] for k, v in weight.items()}
    for r in raked:
        assert r["weight"] == pytest.approx(weight[r["source"], r["lang"]], abs=1e-6)
    assert mixing.query(docs).count() == docs.count()
    assert mixing.sample(docs).columns == docs.columns
    assert mixing.query(docs.limit(0)).count() == 0


def test_resharding(docs, spark, tmp_path):
    sizes = {0: 100, 1: 10, 2: 90, 5: 40}
    flow = resharding.cheapest_flow(sizes, [60, 60, 60, 60])
    assert sum(v for (a, b), v in flow.items() if a != b) == 40 + 30 + 40  # what is over the capacity, and a shard that goes
    got = resharding.query(docs).collect()
    want = Counter((i, len(t.encode()) + 16) for i, t in rows_of(docs))
    assert Counter((r["doc_id"], r["size"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert resharding.query(docs.limit(0)).count() == 0
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.array_repeat(F.lit("abc"), (F.col("id") * 37 % 101).cast("int"))).alias("text"))
    moves = resharding.assign(many, F.col("doc_id") % 6, 8).cache()
    per = [r["b"] for r in moves.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(per) == 8 and max(per) - min(per) < 500
    path = str(tmp_path / "shards")
    many.withColumn("shard", F.col("doc_id") % 6).write.partitionBy("shard").parquet(path)
    resharding.rewrite(many, moves, path)
    new = spark.read.parquet(path)
    assert Counter((r[0], r[1]) for r in new.select("doc_id", "shard").collect()) == Counter((r[0], r[1]) for r in moves.select("doc_id", "shard").collect())


def test_reshard_writes_files(docs, spark, tmp_path, monkeypatch):
    """The query's result is what the shards' files hold: every row whole, also repeated and null-id ones that a cut parts."""
    monkeypatch.setattr(resharding, "BLOCK_ROWS", 20)
    path = str(tmp_path / "shards")
    monkeypatch.setattr(resharding, "new_scratch_path", lambda s, name: path)
    many = spark.range(600).select(F.when(F.col("id") > 150, F.col("id")).alias("doc_id"), F.concat(F.lit("é"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int"))).alias("text"))
    every = docs.select("doc_id", "text", "shard", "size", "band").unionByName(many.select("*", *[F.lit("clash").alias(c) for c in ("shard", "size", "band")]))
    got = resharding.query(every).collect()
    files = spark.read.parquet(path).select("doc_id", "text", "size", "band", "shard").collect()
    assert Counter((r["doc_id"], r["text"], r["size"], r["band"]) for r in files) == Counter((r["doc_id"], r["text"], "clash", "clash") for r in every.collect())
    measure = lambda t: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in got) == Counter((r["doc_id"], *measure(r["text"]), r["shard"]) for r in files)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert max(slots) >= resharding.OLD_SHARDS and all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert any(r["old_shard"] != r["shard"] for r in got) and all(r["old_shard"] == zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 32 for r in got)


def brute_suffixes(rows):
    seen, out = {}, {}
    for i, t in sorted(set(rows), key=lambda x: (x[0] is not None, x[0] or 0)):
        b = t.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s:s + 100]
            if w in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.setdefault(w, 1)
        runs = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out[i, t] = (len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("parts", [1, 40])
def test_suffixes(docs, spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = rows_of(docs)
        # the two null-id rows differ in text: their order is defined by a hash, so only known ids are compared
        want = brute_suffixes([r for r in rows if r[0] is not None])
        got = suffixes.query(docs.where("doc_id IS NOT NULL")).collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == Counter((i, *want[i, t]) for i, t in rows if i is not None)
        assert suffixes.query(docs).count() == docs.count()
        left = {r["doc_id"]: bytes(r["kept"]) for r in suffixes.removed(docs.where("doc_id IS NOT NULL")).collect()}
        assert all(hashlib.sha256(left[i]).hexdigest() == want[i, t][3] for i, t in rows if i is not None)
        assert suffixes.query(docs.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_suffixes_of_many_texts_without_an_id(spark):
    """Null ids, and one id for many texts: each text is its own document, in the order of its hash."""
    rnd = random.Random(11)
    word = lambda n: "".join(rnd.choices("abcdefghij ", k=n))
    passages = [word(rnd.randint(100, 180)) for _ in range(60)]
    texts = {word(rnd.randint(0, 300)) + rnd.choice(passages) + word(rnd.randint(0, 90)) for _ in range(3000)}
    rows = [(None if i % 2 else 7, t) for i, t in enumerate(sorted(texts))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashes = {r["text"]: r["h"] for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    seen, want = set(), Counter()
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, hashes[r[1]])):
        b, gone = t.encode(), bytearray(len(t))
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(b[s:s + 100])
        want[i, len(b), sum(gone), hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()] += 1
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in suffixes.query(df).collect())
    assert got == want
    left = Counter((r["doc_id"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in suffixes.removed(df).collect())
    assert left == Counter({(i, d): n for (i, _, _, d), n in want.items()})


def test_quality_counts(docs, spark):
    labels = spark.createDataFrame([(6, 1, 0), (7, None, None), (None, 1, 0), (999, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    got = Counter(tuple(r)[:8] for r in quality.query(docs, labels).collect())
    want = Counter()
    for i, t in rows_of(docs):
        w = re.findall(SPACE, t)
        at = defaultdict(list)
        for k in range(len(w) - 7):
            at[tuple(w[k:k + 8])].append(k)
        rep = len({p + o for v in at.values() if len(v) > 1 for p in v for o in range(8)})
        lines = [x for x in t.split("\n") if re.search(SPACE, x)]
        bad = len(w) < 20 or 100 * rep > 30 * len(w)
        want[(i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), rep, bad, not bad)] += 1
    assert got == want  # too few labels to prove a cutoff: the base rule alone rejects
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.query(docs.limit(0), labels).count() == 0
    assert quality.query(docs, labels.limit(0)).count() == docs.count()


def test_quality_cutoffs(spark):
    from math import comb

    tail = lambda k, n, p: sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    df = spark.createDataFrame([(k, n) for n in (50, 400, 1000) for k in (0, 1, 3, 9)], "k long, n long")
    for r in df.select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), 0.05).alias("p")).collect():
        if r["k"] < r["n"] * 0.05:
            assert r["p"] == pytest.approx(tail(r["k"], r["n"], 0.05), rel=1e-9)
    good = spark.range(5000).select(F.lit("en").alias("s"), F.struct(*[
        (F.when(F.col("id") % 500 == 0, 0.25).otherwise(0.01) if r == "symbol_share" else F.lit(-9.0)).cast("double").alias(r) for r in quality.GRID
    ]).alias("rules"))
    chosen = quality.cutoffs(good, "s", "rules").first()["cutoffs"]
    assert chosen["symbol_share"] == 0.02  # 10 of 5000 are above: proven under the risk
    few = quality.cutoffs(good.limit(50), "s", "rules")
    assert few.count() == 0


def test_quality_small_strata(spark):
    """A few hundred good labels prove cutoffs: together the rules reject at most the risk, and one step more would fail."""
    sizes = {"en": 300, "de": 120, None: 90, "fr": 80}
    rules = {r: F.lit(-9.0) for r in quality.GRID}
    # of the 300 English ones 3 have many symbols, 3 others long words
    rules["symbol_share"] = F.when((F.col("s") == "en") & (F.col("i") < 3), 0.12).otherwise(0.0)
    rules["long_words"] = F.when((F.col("s") == "en") & F.col("i").between(3, 5), 11.5).otherwise(4.0)
    rows = [(s, i) for s, n in sizes.items() for i in range(n)]
    good = spark.createDataFrame(rows, "s string, i int").select("s", F.struct(*[c.cast("double").alias(r) for r, c in rules.items()]).alias("rules"))
    got = {r["stratum"]: r["cutoffs"].asDict() for r in quality.cutoffs(good, "s", "rules").collect()}
    strict = {r: cuts[0] for r, cuts in quality.GRID.items()}
    assert got["de"] == strict and got[None] == strict
    assert "fr" not in got  # 0.95 ** 80 is over 0.05 / 4
    # P(Binomial(300, 0.05) <= 6) is 0.0065, so both groups together are proven
    assert got["en"] == strict
    more = good.where("s = 'en'").unionByName(good.where("s = 'en' AND (rules.symbol_share > 0 OR rules.long_words > 10)"))
    # 6 + 6 of 306: the step that rejects the second group too (long words over 11) fails, so the path ends there
    stopped = quality.cutoffs(more, "s", "rules", delta=0.01).first()["cutoffs"]
    level = lambda r: quality.GRID[r].index(stopped[r])
    assert stopped["symbol_share"] == 0.06 and stopped["long_words"] == 12.0
    assert {level(r) for r in quality.GRID} <= {2, 3}


def test_url_cascade(spark):
    urls = ["http://a.b.org/x", "https://M.Example.org/es/1?q#f", "https://x.example.org/en/12", "http://s.com/fr/9", "http://s.com/de/", "nothing", None, "http://", "ftp://h.net", "http://s.com/de/"]
    urls += [f"http://h{i % 700}.d{i % 90}.net/p{i}" for i in range(2000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    universe = urlfilter.keys_of(pages)
    listed = universe.where(F.pmod(F.xxhash64("key"), F.lit(9)) == 0)
    member = urlfilter.build(universe, listed, rate=0.3)
    assert len(member.parts[0].levels) > 2
    for m in (member, urlfilter.build(universe, listed, max_listed=40)):
        wrong = universe.withColumn("said", m.listed(F.col("key"))).withColumn("want", F.pmod(F.xxhash64("key"), F.lit(9)) == 0).where("said <> want")
        assert wrong.count() == 0
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(pages, urlfilter.RULES, urlfilter.build(universe, listed.limit(0))).collect()}
    assert [got[i] for i in range(10)] == [
        ("a.b.org", "/x", "org/", "allow"), ("m.example.org", "/es/1", "example.org/es/", "block"), ("x.example.org", "/en/12", "example.org/en/1", "block"),
        ("s.com", "/fr/9", "com/fr/", "allow"), ("s.com", "/de/", "com/de/", "block"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("h.net", "", None, "allow"), ("s.com", "/de/", "com/de/", "block"),
    ]
    assert urlfilter.query(pages.limit(0)).count() == 0


def test_language_id(docs, spark):
    got = langid.query(docs).collect()
    assert len(got) == docs.count()
    assert all((r["lang_pred"] == "und") == (not any(c.isalpha() for c in t or "")) for r in got for t in [dict(rows_of(docs)).get(r["doc_id"])] if r["doc_id"] is not None)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in langid.query(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.query(docs.limit(0)).count() == 0


def test_language_id_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = langid.query(df).where("held_out").join(df.where("lang IS NOT NULL").select("doc_id", "lang"), "doc_id")
    assert judged.where("lang = lang_pred").count() >= 0.95 * judged.count()


@pytest.mark.parametrize("limit", [decontam.BROADCAST_BYTES, -1])
def test_decontamination(docs, spark, monkeypatch, limit):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", limit)  # -1: a set of windows too large to broadcast
    _, bench = _texts()
    items = [(1, bench), (2, bench), (3, "Same, FEW words"), (4, None), (5, "!!"), (None, "a"), (1, bench)]
    bm = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            grams[tuple(w[k:k + 13])] |= {i} - {None}
    want = Counter()
    for i, t in rows_of(docs):
        w, hit, found = words(t), set(), set()
        for g, ids in grams.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit |= set(range(k, k + len(g)))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        want[(i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w))] += 1
    assert Counter(map(tuple, decontam.query(docs, bm).collect())) == want
    clean = decontam.drop_contaminated(docs, bm)
    assert clean.columns == docs.columns
    assert Counter(i for i, _ in rows_of(clean)) == Counter(k[0] for k, v in want.items() for _ in range(v) if not k[5])
    cut = decontam.remove_spans(docs, bm)
    assert decontam.query(cut, bm).where("n_hit > 0").count() == 0
    assert decontam.query(docs, bm.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.query(docs.limit(0), bm).count() == 0


def test_suffixes_in_many_buckets(spark, monkeypatch):
    """A hot passage, ties and long texts over buckets of a few suffixes: brute force of every 100-byte string."""
    import numpy as np

    monkeypatch.setattr(suffixes, "BUCKET", 7)
    monkeypatch.setattr(suffixes, "_COMPARED", 5)
    monkeypatch.setattr(suffixes, "_PIECE", 700)
    rnd = random.Random(11)
    text = lambda n: "".join(rnd.choices("abcdefgh ", k=n))
    hot, other = text(260), text(140)
    texts = [text(rnd.randint(0, 300)) + hot + text(rnd.randint(0, 90)) for _ in range(25)] + [other * 9, text(2500) + hot[:130] + text(900) + other, "ab" * 400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    seen, want = set(), {}
    for i, t in enumerate(texts):
        raw = t.encode()
        gone = np.zeros(len(raw) + 1, int)
        for k in range(len(raw) - 99):
            if raw[k:k + 100] in seen:
                gone[k] += 1
                gone[k + 100] -= 1
            seen.add(raw[k:k + 100])
        keep = np.cumsum(gone)[:len(raw)] == 0
        want[i] = (len(raw), int((~keep).sum()), hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[keep])).hexdigest())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in suffixes.query(docs).collect()}
    assert got == want
    order = suffixes.multikey_quicksort(np.array([[rnd.randrange(4), rnd.randrange(9)] for _ in range(5000)], ">u8"), np.arange(5000))
    assert sorted(order.tolist()) == list(range(5000))
    words = np.array([[rnd.randrange(4), rnd.randrange(9), rnd.randrange(2)] for _ in range(5000)], ">u8")
    assert suffixes.multikey_quicksort(words, np.arange(5000)).tolist() == sorted(range(5000), key=lambda k: words[k].tolist())
