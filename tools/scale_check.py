"""Scale check: N copies of lineitem (sf dir) as landing CSV files, checked end to end.

usage: python tools/scale_check.py [copies] [sf_dir] [landing_dir]

Each copy is written once as three files (one per return flag) under a fresh
folder (or the given one, reused if it exists); then check_landing runs in
multi-line and line mode with the outputs staged, and the totals must agree.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sluice.catalog.datasets import DATASETS  # noqa: E402
from sluice.catalog.landing import CSV_WRITE, lineitem_landing_rules  # noqa: E402
from sluice.plans.landing import check_landing  # noqa: E402
from sluice.session import local_session  # noqa: E402


def build(spark, sf: str, copies: int, root: str) -> None:
    ds = DATASETS["lineitem"]
    names = [c.name for c in ds.rules.data_columns]
    recs = ds.spark_records(spark, sf)
    for i in range(copies):
        (recs.select(F.concat(F.col("l_returnflag"), F.lit(f"_{i}")).alias("_file"),
                     *[F.col(n).alias(h) for n, h in zip(names, ds.rules.header)])
         .repartition("_file").write.partitionBy("_file").options(**CSV_WRITE)
         .mode("append").csv(f"{root}/lineitem/lineitem_csv"))


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    root = sys.argv[3] if len(sys.argv) > 3 else tempfile.mkdtemp(prefix="sluice-scale-")
    spark = local_session()
    if not os.path.exists(f"{root}/lineitem"):
        build(spark, sf, copies, root)
    totals = set()
    for multi_line in (True, False):
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        res = check_landing(spark, root, lineitem_landing_rules(), table="lineitem",
                            multi_line=multi_line, materialize_as="stage")
        s = res.rows_stats.agg(F.sum("nb_valid_lines"), F.sum("nb_invalid_lines")).first()
        res.data_invalid.write.format("noop").mode("overwrite").save()
        res.valid.write.format("noop").mode("overwrite").save()
        print(f"multi_line={multi_line}: {time.perf_counter() - t0:.1f}s valid={s[0]} invalid={s[1]}")
        totals.add((s[0], s[1]))
        res.release()
    print("modes agree:", len(totals) == 1, "landing:", root)


if __name__ == "__main__":
    main()
