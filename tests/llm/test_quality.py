import numpy as np
from pyspark.sql import functions as F

from loadkit.llm import quality


def test_isotonic_like_all_splits():
    source = np.random.default_rng(1)
    for _ in range(20):
        n = source.integers(1, 5, 8).astype(float)
        ones = np.array([source.integers(0, k + 1) for k in n], dtype=float)
        x, y = quality.isotonic(np.arange(8.0), n, ones)
        assert (np.diff(y) > 0).all() and (np.diff(x) > 0).all()
        # max-min formula of isotonic regression
        share = lambda i, j: ones[i : j + 1].sum() / n[i : j + 1].sum()
        want = [max(min(share(i, j) for j in range(k, 8)) for i in range(k + 1)) for k in range(8)]
        assert np.allclose(sorted(set(np.round(want, 9))), sorted(set(np.round(y, 9))))


def test_expanded_rows():
    z = quality.expand(np.random.default_rng(2).normal(size=(50, quality.N_STATISTICS)))
    assert z.shape == (50, quality.FEATURES + 1)
    near, far = quality.expand(np.zeros((1, quality.N_STATISTICS)))[0], quality.expand(np.full((1, quality.N_STATISTICS), 3.0))[0]
    assert abs(near[:-1] @ near[:-1] - 1) < 0.15 and abs(near[:-1] @ far[:-1]) < 0.25


def test_equations_like_one_solve(spark):
    """Fitting over many tasks gives the scores of a single dense solve over the same rows, calibrated in the same bins."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    taught = quality.learnable(labels)
    model = quality.fit(docs.repartition(5), taught)
    rows = [(quality.statistics(r.text or ""), r.y, r.fold) for r in docs.join(taught, "doc_id").select("text", "y", "fold").collect()]
    x, y, fold = (np.array(c) for c in zip(*rows))
    first = fold != 3
    mean, scale = x[first].mean(axis=0), x[first].std(axis=0)
    z = quality.expand((x - mean) / np.where(scale > 1e-9, scale, 1.0))
    # Ridge as least squares with a row for each weight but the constant, whose own penalty is next to nothing.
    n, f = int(first.sum()), quality.FEATURES
    penalty = np.sqrt(quality.RIDGE * n * np.append(np.full(f, 1 / f + 1e-9), 1e-9))
    weights = np.linalg.lstsq(np.vstack([z[first], np.diag(penalty)]), np.append(y[first], np.zeros(f + 1)), rcond=None)[0]
    assert np.allclose(z @ weights, model.raw(x), atol=1e-4)
    at = np.clip((z[~first] @ weights - quality.LOW) / (quality.HIGH - quality.LOW) * quality.BINS, 0, quality.BINS - 1).astype(int)
    bins = np.unique(at)
    centre = quality.LOW + (bins + 0.5) * (quality.HIGH - quality.LOW) / quality.BINS
    knots, values = quality.isotonic(centre, np.array([(at == b).sum() for b in bins], float), np.array([y[~first][at == b].sum() for b in bins]))
    want = np.clip(np.interp(z @ weights, knots, values), 0, 1)
    # A raw score next to the edge of a bin may fall to either side of it.
    assert np.mean(np.abs(want - model.score(x)) < 0.01) > 0.99


def test_statistics():
    assert quality.statistics("") == quality.statistics(" \n\t") == [0.0] * quality.N_STATISTICS
    for text in ("a", "Ab é. ###\nx x x", "w " * 200_000, "|" * 100_000):
        found = quality.statistics(text)
        assert len(found) == quality.N_STATISTICS and np.isfinite(found).all()


def test_learnable(spark):
    rows = [(i, i % 2, 0) for i in range(200)] + [(5, 0, 1), (None, 1, 0), (7, None, 0), (1000, 2, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, y int")
    got = {r.doc_id: (r.y, r.fold) for r in quality.learnable(labels).collect()}
    import zlib

    want = {i: (float(i % 2), zlib.crc32(str(i).encode()) % 4) for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2 and i != 5}
    assert got == want


def test_few_labels(spark, docs):
    labels = lambda rows: quality.learnable(spark.createDataFrame(rows, "doc_id long, quality int"))
    frame = docs([None, "", "Some words here.", "Some words here."])
    for rows, share in (([], 1.0), ([(0, 1), (1, 1)], 1.0), ([(0, 0), (1, 0)], 0.0)):
        model = quality.fit(frame, labels(rows))
        got = [r.score for r in quality.score(frame, model).collect()]
        assert got == [share] * 4
    model = quality.fit(docs([]), labels([(0, 1), (1, 0)]))
    assert quality.score(docs([]), model).count() == 0


def test_odd_rows_and_held_out_accuracy(spark):
    from loadkit.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = QUERIES["op3_quality"](spark, folder)
    assert rows.count() == docs.count()
    tested = rows.join(labels, "doc_id").filter("held_out AND quality IS NOT NULL")
    right = tested.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right >= 0.9
    model = quality.fit(docs, quality.learnable(labels))
    odd = spark.createDataFrame([(None, None, "old"), (1, "", "old"), (1, "the cat " * 100_000, "old"), (1, "", "old")], "doc_id long, text string, score string")
    scores = [r.score for r in quality.score(odd, model).collect()]
    assert len(scores) == 4 and all(0 <= s <= 1 for s in scores) and scores[0] == scores[1] == scores[3]
    again = quality.fit(docs.repartition(7), quality.learnable(labels))
    close = np.abs(again.score(np.array([quality.statistics("The end of it, with words.")])) - model.score(np.array([quality.statistics("The end of it, with words.")])))
    assert close < 1e-3
