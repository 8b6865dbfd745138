"""Quality rules with risk-controlled cutoffs (DataFrame expressions only).

Every rule compares one measure of a text with a cutoff. The cutoffs of a
stratum (a language) lie on one path that is fixed beforehand: it starts without
any rule, and each step makes one rule one cutoff of its grid stricter, all rules
in turn, lenient to strict. A step is proven if labelled good documents show, by
an exact binomial bound, that all rules as they are then reject together at most
``risk`` of the good documents there. Steps are tested in order up to the first
failure, so they need no correction among themselves (fixed sequence); strata
share ``delta`` equally. A stratum with too few labels proves nothing, so no rule
applies in it: without any good document rejected it takes
ln(strata / delta) / -ln(1 - risk) good ones (86 with four strata).

Defined results: a null or empty text has no words and fails the base rule; a
null language is a stratum of its own; labels of an unknown document, null
labels and repeated labels (a document counts as good if all of its labels are
good) change nothing else; without any good label only the base rule rejects.
Repeated rows are judged alike; extra columns of any name are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import let, staged, window_hashes

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Rule -> cutoffs from strict to lenient; a text is rejected above the cutoff.
GRID: dict[str, tuple[float, ...]] = {
    "symbol_share": (0.02, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3),
    "repeat_share": (0.02, 0.05, 0.08, 0.12, 0.16, 0.2, 0.25, 0.3),
    "dup_line_share": (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5),
    "upper_share": (0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8),
    "long_words": (9.0, 10.0, 11.0, 12.0, 14.0, 16.0, 20.0, 30.0),
    "short_words": (-4.0, -3.75, -3.5, -3.25, -3.0, -2.75, -2.5, -2.0),
}
#: Strata whose cutoffs are broadcast; more are joined by shuffle.
MANY = 100_000
RISK = 0.05
DELTA = 0.05


def _repeated_words(words: Column) -> Column:
    """Words inside a window of WINDOW words that the text holds twice or more.

    Windows are compared by 64-bit hashes within one text; hash and position
    are sorted, so the work is n log n for any number of repeats."""
    hashes = window_hashes(words, WINDOW)

    def covered(h: Column) -> Column:
        order = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def positions(p: Column) -> Column:
            twice = lambda e, j: e["h"].eqNullSafe(F.get(p, j - 1)["h"]) | e["h"].eqNullSafe(F.get(p, j + 1)["h"])
            return F.array_sort(F.transform(F.filter(p, twice), lambda e: e["i"]))

        def total(q: Column) -> Column:
            steps = F.transform(q, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(q, j + 1) - x, F.lit(WINDOW))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(let(order, positions), total)

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def measures(text: Column) -> Column:
    """The struct of base counts and rule measures of one whole text."""

    def of_text(t: Column) -> Column:
        words = F.array_remove(F.split(t, SPACE + "+"), "")
        lines = F.filter(F.split(t, "\n"), lambda x: F.regexp_like(x, F.lit(NOT_SPACE)))
        return F.struct(
            let(words, lambda w: F.struct(
                F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), _repeated_words(w).alias("rep")
            )).alias("w"),
            let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("l"),
            F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).alias("symbols"),
            F.length(F.regexp_replace(t, r"\P{Lu}+", "")).alias("upper"),
        )

    def of_counts(c: Column) -> Column:
        share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
        n, rep, chars = c["w"]["n"].cast("long"), c["w"]["rep"].cast("long"), c["w"]["chars"]
        return F.struct(
            n.alias("n_words"), chars.cast("long").alias("word_chars"), c["symbols"].cast("long").alias("n_symbols"),
            c["l"]["dup"].cast("long").alias("n_dup_lines"), rep.alias("n_repeat_words"),
            ((n < 20) | (rep * 100 > n * 30)).alias("base_failed"),
            F.struct(
                share(c["symbols"], chars).alias("symbol_share"), share(rep, n).alias("repeat_share"),
                share(c["l"]["dup"], c["l"]["n"]).alias("dup_line_share"), share(c["upper"], chars).alias("upper_share"),
                share(chars, n).alias("long_words"), (-share(chars, n)).alias("short_words"),
            ).alias("rules"),
        )

    return let(let(text, of_text), of_counts)


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """P(Binomial(n, risk) <= k), exact: the top term by logarithms, the terms
    below it by their ratios. 1 where k is not under n * risk."""
    top = (
        F.aggregate(F.sequence(F.lit(1).cast("long"), k), F.lit(0.0), lambda a, i: a + F.log((n - k + i) / i))
    )
    log_top = F.when(k > 0, top).otherwise(F.lit(0.0)) + k * F.log(F.lit(risk)) + (n - k) * F.log(F.lit(1.0 - risk))
    below = F.aggregate(
        F.sequence(F.lit(0).cast("long"), k),
        F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum")),
        lambda a, t: F.struct(
            (a["term"] * ((k - t) * (1.0 - risk)) / ((n - k + t + 1) * risk)).alias("term"),
            (a["sum"] + a["term"]).alias("sum"),
        ),
        lambda a: a["sum"],
    )
    return F.when(k < n * risk, F.exp(log_top) * below).otherwise(F.lit(1.0))


def path(grid=GRID) -> list[tuple[str, float]]:
    """(rule, cutoff) of each step: every rule's most lenient cutoff, then the next ones."""
    lenient = {rule: sorted(cuts, reverse=True) for rule, cuts in grid.items()}
    return [(rule, cuts[i]) for i in range(max(map(len, lenient.values()))) for rule, cuts in lenient.items() if i < len(cuts)]


def cutoffs(good: DataFrame, stratum: str, rules: str, grid=GRID, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum with a proven step: the cutoff of each rule there (null: none yet).

    ``good``: labelled good documents with their stratum and the struct of
    measures. One aggregate counts all steps by the first that rejects a document;
    what follows has one row per (stratum, step), whatever the number of labels."""
    steps = path(grid)
    # steps only get stricter: from the first one that rejects a document all others do
    first = F.coalesce(*[F.when(F.col(rules)[rule] > cut, i) for i, (rule, cut) in enumerate(steps)], F.lit(len(steps)))
    counts = good.select(F.col(stratum).alias("stratum"), first.alias("first")).groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col("first") <= i, 1)).alias(f"k{i}") for i in range(len(steps))],
    )
    tested = counts.withColumn("strata", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))).select(
        "stratum", "n", "strata",
        F.posexplode(F.array(*[F.col(f"k{i}") for i in range(len(steps))])).alias("step", "k"),
    )
    failed = binomial_tail(F.col("k"), F.col("n"), risk) > F.lit(delta) / F.col("strata")
    proven = tested.groupBy("stratum").agg(
        F.coalesce(F.min(F.when(failed, F.col("step"))), F.lit(len(steps))).alias("proven")
    ).where("proven > 0")
    chosen = [F.array_min(F.array(*[F.when(F.col("proven") > i, F.lit(cut)) for i, (r, cut) in enumerate(steps) if r == rule])).alias(rule) for rule in grid]
    return proven.select("stratum", F.struct(*chosen).alias("cutoffs"))


def judge(docs: DataFrame, labels: DataFrame, *, doc_id="doc_id", text="text", stratum="lang", carry=None, grid=GRID, risk=RISK, delta=DELTA) -> DataFrame:
    """(``row``: the columns ``carry`` as a struct, ``m``: the measures, ``rejected_by``, ``kept``).

    Texts are measured once, to a table that the labels are then joined with and
    the verdicts are read from; it holds the columns to carry (all, by default)."""
    carry = docs.columns if carry is None else carry
    at = lambda c: F.col(f"`{c}`")
    measured = staged(docs.select(
        F.struct(*[at(c) for c in carry]).alias("row"), at(doc_id).alias("id"), at(stratum).alias("s"),
        measures(F.coalesce(at(text).cast("string"), F.lit(""))).alias("m"),
    ), "quality-measures")
    good_ids = (
        labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.min("quality").alias("quality")).where("quality = 1")
    )
    good = measured.select("id", "s", "m.rules").join(good_ids, F.col("id") == F.col("label_id"), "left_semi")
    chosen = staged(cutoffs(good, "s", "rules", grid, risk, delta), "quality-cutoffs")
    joined = measured.join(F.broadcast(chosen), F.col("s").eqNullSafe(F.col("stratum")), "left") if chosen.count() <= MANY else (
        measured.join(chosen, F.col("s").eqNullSafe(F.col("stratum")), "left"))
    broken = F.array_compact(F.array(*[
        F.when(F.col("m.rules")[rule] > F.col("cutoffs")[rule], F.lit(rule)) for rule in grid
    ]))
    return joined.select("row", "m", broken.alias("rejected_by")).select(
        "row", "m", "rejected_by", (~F.col("m.base_failed") & (F.size("rejected_by") == 0)).alias("kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns."""
    return judge(docs, labels, **options).where("kept").select("row.*")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, labels, carry=["doc_id"]).select(
        "row.doc_id",
        *[F.col(f"m.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")],
        "kept", F.concat_ws(",", "rejected_by").alias("rejected_by"),
    )
