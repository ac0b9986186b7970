import math

import pytest
from pyspark.sql import functions as F

from textmill.operators import metrics as M


def frame(spark, pred, ref, weight=None):
    rows = list(zip(pred, ref, map(float, weight or [1] * len(pred))))
    return spark.createDataFrame(rows, "p int, r int, w double")


def value(df):
    return df.first()[0]


def test_accuracy_known_values(spark):
    df = frame(spark, [0, 1, 1, 2, 1, 0], [0, 1, 2, 0, 1, 2], [0.5, 2, 0.7, 0.5, 9, 0.4])
    assert value(M.accuracy(df, "p", "r")) == 0.5
    assert value(M.accuracy(df, "p", "r", normalize=False)) == 3.0
    assert value(M.accuracy(df, "p", "r", weight="w")) == pytest.approx(0.8778625954198473)


def test_f1_known_values(spark):
    df = frame(spark, [0, 0, 1, 1, 0], [0, 1, 0, 1, 0], [0.9, 0.5, 3.9, 1.2, 0.3])
    assert value(M.f1(df, "p", "r")) == pytest.approx(0.5)
    assert round(value(M.f1(df, "p", "r", pos_label=0)), 2) == 0.67
    assert round(value(M.f1(df, "p", "r", weight="w")), 2) == 0.35
    many = frame(spark, [0, 2, 1, 0, 0, 1], [0, 1, 2, 0, 1, 2])
    assert [round(value(M.f1(many, "p", "r", a)), 2) for a in ("macro", "micro", "weighted")] == [0.27, 0.33, 0.27]
    assert {r.label: round(r.f1, 6) for r in M.f1(many, "p", "r", None).collect()} == {0: 0.8, 1: 0.0, 2: 0.0}
    fixed = spark.createDataFrame([(i,) for i in range(4)], "label int")
    assert value(M.f1(many, "p", "r", "macro", labels=fixed)) == pytest.approx(0.2)
    assert value(M.f1(frame(spark, [1, 1], [1, 1]), "p", "r", pos_label=0)) == 0.0


def test_spearman_known_value_and_ties(spark):
    df = spark.createDataFrame(list(zip([1.0, 2.0, 3.0, 4.0, 5.0], [10.0, 9.0, 2.5, 6.0, 4.0])), "x double, y double")
    row = M.spearman(df, "x", "y", pvalue=True).first()
    assert round(row.rho, 6) == -0.7 and round(row.p, 2) == 0.19 and row.p == pytest.approx(0.1881204, abs=1e-5)
    rows = [(float(i * 7 % 5), float(i * i % 7)) for i in range(300)]
    tied = spark.createDataFrame(rows, "x double, y double")

    def ranks(v):
        return [sum(u < t for u in v) + (sum(u == t for u in v) + 1) / 2 for t in v]

    rx, ry = ranks([r[0] for r in rows]), ranks([r[1] for r in rows])
    mean = (len(rows) + 1) / 2
    top = sum((a - mean) * (b - mean) for a, b in zip(rx, ry))
    want = top / math.sqrt(sum((a - mean) ** 2 for a in rx) * sum((b - mean) ** 2 for b in ry))
    assert value(M.spearman(tied, "x", "y")) == pytest.approx(want)


def test_p_values_to_nine_digits(spark):
    # Worked out from closed forms of Student's t: one degree 1 - 2 atan(t) / pi; two degrees 1 - |rho|;
    # four degrees 1 - |rho| (3 - rho^2) / 2; a correlation of zero is certain to be reached.
    cases = [(0.6, 4, 0.4), (0.3, 6, 1 - 0.3 * (3 - 0.09) / 2), (-0.9, 6, 1 - 0.9 * (3 - 0.81) / 2), (0.0, 50, 1.0), (1.0, 9, 0.0)]
    cases += [(r, 3, 1 - 2 / math.pi * math.atan(r / math.sqrt(1 - r * r))) for r in (0.1, 0.5, 0.99)]
    # Many rows: close to the normal law.
    cases += [(2.5 / math.sqrt(10**7), 10**7, math.erfc(2.5 / math.sqrt(2)))]
    df = spark.createDataFrame([(float(r), n, float(p)) for r, n, p in cases], "rho double, n long, want double")
    for row in df.select("*", M.two_sided_p(F.col("rho"), F.col("n")).alias("p")).collect():
        assert row.p == pytest.approx(row.want, abs=1e-9 if row.n < 1000 else 1e-6), row
    few = spark.createDataFrame([(0.5, 2)], "rho double, n long")
    assert few.select(M.two_sided_p(F.col("rho"), F.col("n"))).first()[0] is None


def test_entities(spark):
    def tags(*rows):
        flat = [(s, i, p, r) for s, (ps, rs) in enumerate(rows) for i, (p, r) in enumerate(zip(ps.split(), rs.split()))]
        return spark.createDataFrame(flat, "sent int, pos int, p string, r string")

    df = tags(("I-A I-A O B-B B-B", "B-A I-A O B-B I-B"), ("O O B-A", "O I-A I-A"), ("B-A I-B", "B-A -100"))
    spans = {(r.sent, r.type, r.s, r.e) for r in M.entity_spans(df, ["sent"], "pos", "p").collect()}
    assert spans == {(0, "A", 0, 1), (0, "B", 3, 3), (0, "B", 4, 4), (1, "A", 2, 2), (2, "A", 0, 0), (2, "B", 1, 1)}
    row = M.entity_scores(df, ["sent"], "pos", "p", "r").first()
    assert row.precision == pytest.approx(2 / 5) and row.recall == pytest.approx(2 / 4)
    assert row.f1 == pytest.approx(4 / 9) and row.accuracy == pytest.approx(5 / 9)


def test_answers(spark):
    rows = [(1, "The cat.", ["a cat", "dog"]), (2, "red red fox", ["red fox fox"]), (3, "", [""]), (4, "x", ["y"])]
    df = spark.createDataFrame(rows, "id int, guess string, answers array<string>")
    got = {r.id: (r.exact, round(r.f1, 6)) for r in M.squad_pairs(df, "guess", "answers").collect()}
    assert got == {1: (1.0, 1.0), 2: (0.0, round(2 * 2 / 6, 6)), 3: (1.0, 0.0), 4: (0.0, 0.0)}
    assert M.squad_scores(df, "guess", "answers").first().exact_match == 50.0


def test_losses_and_labels(spark):
    df = spark.createDataFrame([([1.0, 2.0, 0.5], 1), ([800.0, 0.0, 0.0], 1)], "logits array<double>, label int")
    got = [r[0] for r in df.select(M.cross_entropy("logits", "label")).collect()]
    want = math.log(sum(math.exp(v) for v in (1, 2, 0.5))) - 2
    assert got[0] == pytest.approx(want) and got[1] == pytest.approx(800.0)
    top = M.top_k_labels(df.withColumn("k", F.monotonically_increasing_id()), ["k"], "logits", 2).collect()
    assert sum(r.rank == 0 for r in top) == 2 and {r.id for r in top if r.rank == 0} == {0, 1}
    signs = spark.createDataFrame([(-1.0,), (0.0,), (2.0,)], "v double").select(M.by_sign(F.col("v"))).collect()
    assert [r[0] for r in signs] == [0, 0, 1]
    ties = spark.createDataFrame([([3.0, 3.0],)], "l array<double>").select(M.argmax("l")).first()[0]
    assert ties == 0


def test_auc_counts_ties_half(spark):
    rows = [(0.1, 0), (0.4, 1), (0.4, 0), (0.8, 1), (0.2, 0), (0.2, 1)]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert value(M.roc_auc(spark.createDataFrame(rows, "s double, y int"), "s", "y")) == pytest.approx(want)


def test_entities_of_sentence_rows_are_not_shuffled(spark):
    rows = [(1, "O B-A I-A I-B B-B", "O B-A I-A -100 B-B"), (2, "I-A I-A O", "B-A I-A O"), (3, "", ""), (4, "O B-A", "B-C B-A")]
    rows = [(k, p.split(), r.split()) for k, p, r in rows] + [(5, [None, "I-A"], ["B-A", None])]
    lists = spark.createDataFrame([(k, [10 * i for i in range(len(p))], p, r) for k, p, r in rows],
                                  "sent int, pos array<int>, p array<string>, r array<string>")
    flat = spark.createDataFrame([(k, 10 * i, a, b) for k, p, r in rows for i, (a, b) in enumerate(zip(p, r))],
                                 "sent int, pos int, p string, r string")
    made = M.entity_spans(lists, ["sent"], "pos", "p")
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    want = {(1, "A", 10, 20), (1, "B", 30, 30), (1, "B", 40, 40), (2, "A", 0, 10), (4, "A", 10, 10), (5, "A", 10, 10)}
    for df in (lists, flat):
        assert {tuple(r) for r in M.entity_spans(df, ["sent"], "pos", "p").collect()} == want
        row = M.entity_scores(df, ["sent"], "pos", "p", "r").first()
        assert row.precision == pytest.approx(4 / 4) and row.recall == pytest.approx(4 / 6)
        assert row.accuracy == pytest.approx(7 / 10)
