from fractions import Fraction

from helpers import MEDIUM

from lakeviews.llm import mixing


def water_filled(sizes, weights, share):
    """Targets by repeated sharing of the excess."""
    left, open_, out = share * sum(sizes), list(range(len(sizes))), [Fraction(0)] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total >= 2 * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = Fraction(2 * sizes[i])
        left -= sum(2 * sizes[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return out


def test_targets_by_repeated_sharing(spark):
    for sizes in ([100, 10, 5, 900, 0, 33, 7], [1], [5, 5, 5], [0, 0], [1000, 1, 1, 1, 1]):
        rows = [(f"s{i}" if i < len(sizes) - 1 else None, n) for i, n in enumerate(sizes)]
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()}
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        for (source, _), want in zip(rows, water_filled(sizes, weights, Fraction(3, 2))):
            assert abs(got[source] - float(want)) < 1e-6


def test_taken_words_come_near_the_targets(spark):
    rows = mixing.op1_mix(spark, MEDIUM).collect()
    assert rows == mixing.op1_mix(spark, MEDIUM).collect() or sorted(rows) == sorted(mixing.op1_mix(spark, MEDIUM).collect())
    assert all(r.taken <= 2 * r.size for r in rows)
    mixed = mixing.mix(spark.read.parquet(f"{MEDIUM}/documents.parquet")).collect()
    by = {}
    for r in mixed:
        t = by.setdefault(r.source, [0, r.target, 0])
        t[0] += r.taken
        t[2] = max(t[2], r.size)
    assert all(abs(taken - target) <= largest for taken, target, largest in by.values())


def test_thresholds_are_nested(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    less, more = ({r.doc_id: r.copies for r in mixing.mix(docs, share=s).collect()} for s in (Fraction(1, 4), Fraction(3, 4)))
    assert all(less[k] <= more[k] for k in less) and sum(less.values()) < sum(more.values())
