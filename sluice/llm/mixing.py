"""Mixing sources to target weights by iterative proportional fitting (DataFrame only).

Documents are counted into cells of the margins (source, language, topic) by
their tokens. The cells' weights are raked: each margin in turn is scaled to
its targets, until all fit at once. A document's probability is its cell's
weight against the cell's tokens, scaled so that the expected tokens are the
wanted share of all tokens; where that would exceed 1 the cell is taken whole
and the others take up the rest. The draw of a document depends on its id alone.

Only the count into cells reads the documents; raking works on the cells, whose
number is the product of the categories met, not of the documents.

Defined results: a null category is a category of its own; a null or empty text
counts one token (its end mark); an empty table has no cell and keeps nothing;
targets of absent categories are left out and the others scaled up; repeated
rows and rows with the same id are drawn alike; extra columns of any name are
carried along.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged, uniform

#: Cells up to this number are raked in one task, more by shuffles; the result is the same.
ONE_TASK_CELLS = 200_000
BLOCK, MAX_BLOCKS, TOLERANCE = 5, 12, 1e-9

#: A margin's targets: shares by category (unlisted ones split what is left as
#: they are now), or an exponent for the shares of today (under 1 flattens them).
Targets = Mapping[str, float] | float

#: Targets of the registered query and the pipeline.
TARGETS: dict[str, Targets] = {"source": 0.7, "lang": {"en": 0.45, "de": 0.15, "fr": 0.15, "es": 0.1}, "topic": 0.9}
BUDGET = 0.8


def tokens(text: Column) -> Column:
    """Words of the text and its end mark."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return (F.size(F.array_remove(F.split(t, r"\s+"), "")) + 1).cast("long")


def topic(text: Column) -> Column:
    """A coarse topic from the form of the whole text."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    n = F.length(t)
    many = lambda chars, share: F.length(F.regexp_replace(t, f"[^{chars}]+", "")) > n * share
    return (
        F.when(n == 0, "empty").when(many("|", 0.03), "table").when(many("#*$%&", 0.05), "symbols")
        .when(many("0-9", 0.1), "numbers").when(many("A-Z", 0.3), "headline").otherwise("prose")
    )


def _target(cells: DataFrame, margin: str, goal: Targets) -> DataFrame:
    """``cells`` with goal_<margin>: its category's share; shares sum to 1 over the categories met."""
    mine, every = Window.partitionBy(margin), Window.partitionBy(F.lit(1))
    now, size = F.sum("tokens").over(mine), F.count(F.lit(1)).over(mine)
    if isinstance(goal, Mapping):
        listed = F.lit(None).cast("double")
        for name, share in goal.items():
            listed = F.when(F.col(margin) == name, F.lit(float(share))).otherwise(listed)
        rest = F.lit(max(0.0, 1.0 - sum(goal.values())))
        unlisted = F.sum(F.when(listed.isNull(), F.col("tokens"))).over(every)
        raw = F.coalesce(listed, rest * now / F.coalesce(unlisted, F.lit(1)))
    else:
        raw = F.pow(now.cast("double"), F.lit(float(goal)))
    each = cells.select("*", raw.alias("__raw"), size.alias("__size"))
    return each.select("*", (F.col("__raw") / F.sum(F.col("__raw") / F.col("__size")).over(every)).alias(f"goal_{margin}")).drop("__raw", "__size")


def rake(cells: DataFrame, targets: Mapping[str, Targets]) -> DataFrame:
    """``cells`` (margin columns, tokens) with ``weight``, summing to 1."""
    together = (lambda df: df.coalesce(1)) if cells.count() <= ONE_TASK_CELLS else (lambda df: df)
    cells = together(cells)
    for margin, goal in targets.items():
        cells = _target(cells, margin, goal)
    cells = cells.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(MAX_BLOCKS):
        for _ in range(BLOCK):
            for margin in targets:
                total = F.sum("weight").over(Window.partitionBy(margin))
                cells = cells.withColumn("weight", F.when(total > 0, F.col("weight") * F.col(f"goal_{margin}") / total).otherwise(F.lit(0.0)))
        cells = staged(cells, "mix-cells")
        off = [
            cells.groupBy(m).agg(F.abs(F.sum("weight") - F.max(f"goal_{m}")).alias("off")).agg(F.max("off")).first()[0] or 0.0
            for m in targets
        ]
        if max(off, default=0.0) <= TOLERANCE:
            break
        cells = together(cells)
    return cells


def probabilities(cells: DataFrame, budget: float) -> DataFrame:
    """Raked cells with ``probability``: expected tokens are ``budget`` of all tokens."""
    every = Window.partitionBy(F.lit(1))
    rate = F.col("weight") / F.col("tokens")
    order = Window.partitionBy(F.lit(1)).orderBy(F.col("rate").desc(), *[c for c in cells.columns if c not in ("tokens", "weight")])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    ranked = cells.withColumn("rate", rate).select(
        "*", F.row_number().over(order).alias("place"),
        (F.sum("tokens").over(every) * F.lit(float(budget))).alias("wanted"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("whole"), F.sum("weight").over(after).alias("rest"),
    ).withColumn("scale", F.when(F.col("rest") > 0, (F.col("wanted") - F.col("whole")) / F.col("rest")))
    fits = F.when(F.col("scale") * F.col("rate") <= 1.0, F.struct("place", "scale"))
    solved = ranked.withColumn("c", F.min(fits).over(every)["scale"])
    p = F.when(F.col("weight") <= 0, 0.0).otherwise(F.least(F.lit(1.0), F.coalesce(F.col("c") * F.col("rate"), F.lit(1.0))))
    return solved.withColumn("probability", p).drop("rate", "place", "wanted", "whole", "rest", "scale", "c")


def mix(docs: DataFrame, targets: Mapping[str, Targets] = TARGETS, budget: float = BUDGET, *, doc_id="doc_id", text="text", topic_of=topic) -> DataFrame:
    """(``row``: the input row, tokens, margins, weight, probability, kept).

    A margin named ``topic`` is worked out from the text, others are columns."""
    def margins(row: str) -> list[Column]:
        at = lambda c: F.col(f"{row}`{c}`")
        return [(topic_of(at(text)) if m == "topic" else at(m)).alias(m) for m in targets]

    narrow = docs.select(*margins(""), tokens(F.col(f"`{text}`")).alias("n"))
    cells = staged(narrow.groupBy(*targets).agg(F.sum("n").alias("tokens")), "mix-counts")
    raked = staged(probabilities(rake(cells, targets), budget), "mix-probabilities")
    table = raked.select(*[F.col(m).alias(f"cell_{m}") for m in targets], "weight", "probability")
    if raked.count() <= ONE_TASK_CELLS:
        table = F.broadcast(table)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", *margins("row."))
    same = [F.col(m).eqNullSafe(F.col(f"cell_{m}")) for m in targets]
    drawn = uniform(F.col(f"row.`{doc_id}`"), "mix") < F.col("probability")
    return rows.join(table, same, "left").select("row", *targets, "weight", "probability", drawn.alias("kept"))


def sample(docs: DataFrame, targets: Mapping[str, Targets] = TARGETS, budget: float = BUDGET, **names) -> DataFrame:
    """The drawn rows of ``docs``, with their own columns."""
    return mix(docs, targets, budget, **names).where("kept").select("row.*")


def query(docs: DataFrame) -> DataFrame:
    return mix(docs).select(
        F.col("row.doc_id").alias("doc_id"), "source", "lang", "topic",
        F.round("weight", 9).alias("weight"), F.round("probability", 9).alias("probability"), "kept",
    )
