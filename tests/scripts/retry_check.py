"""Run the flagship recommendation twice — once clean, once with the first
attempt of some input tasks failing — and print whether the results match.
Run with a retrying local master (local[N, maxFailures])."""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from cinerank.operators import features as Fe, knn, split as S  # noqa: E402
from cinerank.plans import context as C  # noqa: E402


def flaky(batches):
    from pyspark import TaskContext
    tc = TaskContext.get()
    if tc.attemptNumber() == 0 and tc.partitionId() % 2 == 0:
        raise RuntimeError("injected task loss")
    yield from batches


def recommend(cells):
    s = S.split_rows(cells)
    train = S.side(s, "train")
    nbrs = Fe.similar_users(cells, 5)
    return sorted(tuple(r) for r in knn.recommend(cells, nbrs, train, 5, n=5).collect())


def main():
    spark = (SparkSession.builder.master("local[4, 3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cinerank-retry-"))
    cells = C.r1_cells(spark, sys.argv[1])
    clean = recommend(cells)
    shaky = cells.repartition(4).mapInPandas(flaky, cells.schema)
    again = recommend(shaky)
    print("MATCH" if clean == again and clean else "DIFFER", len(clean))
    spark.stop()


if __name__ == "__main__":
    main()
