"""Scores of predictions: accuracy, F1, rank correlation, entities, answers, losses, labels, AUC.

All are plain aggregations with map-side combining; what is sorted is the table of distinct values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType

from textmill.functions.arrays import let
from textmill.functions.prefix import running_total
from textmill.operators.tagspans import row_matches, row_spans


def accuracy(df: DataFrame, pred: str, ref: str, normalize: bool = True, weight: str | None = None) -> DataFrame:
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    right = F.sum(F.when(F.col(pred) == F.col(ref), w).otherwise(0.0))
    return df.agg((right / F.sum(w) if normalize else right).alias("accuracy"))


def label_counts(df: DataFrame, pred: str, ref: str, weight: str | None = None, labels: DataFrame | None = None) -> DataFrame:
    """(label, tp, predicted, actual): weighted counts per class, one small row per class and task."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    both = F.array(
        F.struct(F.col(pred).alias("label"), F.lit(1).alias("p"), F.lit(0).alias("r")),
        F.struct(F.col(ref).alias("label"), F.lit(0).alias("p"), F.lit(1).alias("r")),
    )
    long = df.select(F.explode(both).alias("x"), w.alias("w"), (F.col(pred) == F.col(ref)).alias("hit"))
    counts = long.groupBy(F.col("x.label").alias("label")).agg(
        F.sum(F.when(F.col("hit"), F.col("w") * F.col("x.p")).otherwise(0.0)).alias("tp"),
        F.sum(F.col("w") * F.col("x.p")).alias("predicted"),
        F.sum(F.col("w") * F.col("x.r")).alias("actual"),
    )
    if labels is None:
        return counts
    zero = {c: F.coalesce(c, F.lit(0.0)) for c in ("tp", "predicted", "actual")}
    return labels.select("label").join(counts, "label", "left").withColumns(zero)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / b)


def f1(
    df: DataFrame, pred: str, ref: str, average: str | None = "binary", pos_label=1, weight: str | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    """One row with ``f1`` (one row per label for ``average=None``); 0 where undefined.

    ``average='samples'`` takes 0/1 arrays per row and averages the row scores.
    """
    if average == "samples":
        hits = F.aggregate(F.zip_with(pred, ref, lambda a, b: a * b), F.lit(0).cast("bigint"), lambda s, x: s + x)
        total = lambda c: F.aggregate(F.col(c), F.lit(0).cast("bigint"), lambda s, x: s + x)
        score = _ratio(2.0 * hits, total(pred) + total(ref))
        w = F.col(weight).cast("double") if weight else F.lit(1.0)
        return df.agg((F.sum(score * w) / F.sum(w)).alias("f1"))
    counts = label_counts(df, pred, ref, weight, labels).withColumn(
        "f1", _ratio(2 * F.col("tp"), F.col("predicted") + F.col("actual"))
    )
    if average is None:
        return counts.select("label", "f1")
    if average == "binary":
        return counts.agg(F.coalesce(F.max(F.when(F.col("label") == pos_label, F.col("f1"))), F.lit(0.0)).alias("f1"))
    if average == "micro":
        return counts.agg(_ratio(2 * F.sum("tp"), F.sum("predicted") + F.sum("actual")).alias("f1"))
    if average == "macro":
        return counts.agg(F.avg("f1").alias("f1"))
    if average == "weighted":
        return counts.agg(_ratio(F.sum(F.col("f1") * F.col("actual")), F.sum("actual")).alias("f1"))
    raise ValueError(f"unknown average {average}")


def _centred_ranks(pairs: DataFrame, column: str, out: str) -> DataFrame:
    """Average rank of each distinct value, less the mean rank."""
    counts = pairs.filter(F.col(column).isNotNull()).groupBy(column).agg(F.sum("_n").alias("_c"))
    total = counts.agg(F.sum("_c")).scalar()
    before = running_total(counts, column, F.col("_c"), "_before")
    return before.select(column, (F.col("_before") + (F.col("_c") + 1) / 2 - (total + 1) / 2).alias(out))


def log_gamma_step(a: Column) -> Column:
    """ln(gamma(a + 1/2) / gamma(a)): the series in 1/z at z = a + 20, and twenty factors back from there. The series
    is that of the ratio, so nothing cancels at large ``a``."""
    z = a + 20
    series = F.log(z) / 2 - 1 / (8 * z) + 1 / (192 * F.pow(z, 3)) - 1 / (640 * F.pow(z, 5)) + 17 / (14336 * F.pow(z, 7))
    return series + sum((F.log((a + i) / (a + i + 0.5)) for i in range(20)), F.lit(0.0))


def _beta_fraction(a: Column, b: Column, x: Column, steps: int) -> Column:
    """The continued fraction of the incomplete beta function, from the front (each step multiplies two ratios in)."""
    tiny = 1e-300
    safe = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)
    d0 = 1 / safe(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))

    def half(acc: Column, term: Column) -> Column:
        c, d = safe(1 + term / acc["c"]), 1 / safe(1 + term * acc["d"])
        return F.struct(c.alias("c"), d.alias("d"), (acc["h"] * c * d).alias("h"))

    def step(acc: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return let(half(acc, even), lambda e: half(e, odd))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda acc: acc["h"])


def two_sided_p(rho: Column, n: Column, steps: int = 400) -> Column:
    """Chance of a rank correlation at least this strong under independence (Student's t, n-2 degrees).

    With x = 1 - rho^2 it is the regularized incomplete beta function I_x((n-2)/2, 1/2), by its continued fraction, on
    the side where that converges. Null for fewer than three rows.
    """
    a, half = F.when(n > 2, (n - 2) / 2).cast("double"), F.lit(0.5)
    strength = rho * rho
    x = 1 - strength
    front = F.exp(log_gamma_step(a) - math.log(math.pi) / 2 + a * F.log1p(-strength) + F.log(strength) / 2)
    left = x < (a + 1) / (a + 2.5)
    p = F.when(left, front * _beta_fraction(a, half, x, steps) / a).otherwise(1 - 2 * front * _beta_fraction(half, a, strength, steps))
    return F.when(a.isNull() | rho.isNull(), None).when(x <= 0, 0.0).when(strength == 0, 1.0).otherwise(p)


def spearman(df: DataFrame, x: str, y: str, pvalue: bool = False) -> DataFrame:
    """One row with ``rho`` (and ``p``): correlation of average ranks.

    Rows with a null count nowhere. Equal pairs are counted first; ranks come from running totals over the
    distinct values. Undefined values are null: ``rho`` of a constant column, ``p`` of fewer than three rows.
    """
    complete = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = complete.groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count("*").alias("_n"))
    ranked = pairs.join(_centred_ranks(pairs, "x", "rx"), "x").join(_centred_ranks(pairs, "y", "ry"), "y")
    s = lambda a, b: F.sum(F.col("_n") * F.col(a) * F.col(b))
    out = ranked.agg(F.try_divide(s("rx", "ry"), F.sqrt(s("rx", "rx") * s("ry", "ry"))).alias("rho"), F.sum("_n").alias("n"))
    return out.select("rho", two_sided_p(F.col("rho"), F.col("n")).alias("p")) if pvalue else out.select("rho")


def _by_sentence(tags: DataFrame, sentence: list[str], pos: str, sides: list[str]) -> DataFrame:
    """A row for each sentence, with its places and tags as arrays in order. Rows that are sentences stay as they are."""
    if not isinstance(tags.schema[sides[0]].dataType, ArrayType):
        listed = F.sort_array(F.collect_list(F.struct(F.col(pos).alias("_pos"), *sides))).alias("_tags")
        tags = tags.groupBy(*sentence).agg(listed).select(
            *sentence, F.col("_tags")["_pos"].alias(pos), *[F.col("_tags")[side].alias(side) for side in sides]
        )
    return tags.select(*sentence, pos, *[F.col(side).cast("array<string>").alias(side) for side in sides])


def entity_spans(tags: DataFrame, sentence: list[str], pos: str, tag: str) -> DataFrame:
    """(sentence, type, s, e): runs of IOB tags; an inside tag without its begin opens a span.

    ``tags`` has a row for each token, or one for each sentence with arrays of places, in order, and of tags; those
    are not shuffled.
    """
    rows = _by_sentence(tags, sentence, pos, [tag])
    spans = F.arrow_udf(lambda lists: row_spans(lists), "array<struct<type:string,s:int,e:int>>")(tag)

    def placed(both: Column) -> Column:
        at = lambda i: F.get(both["pos"], i)
        return F.transform(both["spans"], lambda x: F.struct(x["type"].alias("type"), at(x["s"]).alias("s"), at(x["e"]).alias("e")))

    # Places are worked out once for a row, not once for a span.
    made = let(F.struct(F.col(pos).alias("pos"), spans.alias("spans")), placed)
    rows = rows.select(*sentence, made.alias("_spans"))
    # The outer form, so that no filter on the array is inferred, which would work all spans out twice.
    return rows.select(*sentence, F.inline_outer("_spans")).filter(F.col("s").isNotNull())


def entity_scores(tags: DataFrame, sentence: list[str], pos: str, pred: str, ref: str) -> DataFrame:
    """One row: exact-match precision, recall, F1 and token accuracy. Tokens whose reference tag is null or
    -100 are ignored; a null prediction is wrong. ``tags`` as in :func:`entity_spans`; a sentence's counts are made in
    its row."""
    rows = _by_sentence(tags, sentence, pos, [pred, ref])
    kind = "struct<tp:bigint,n_pred:bigint,n_ref:bigint,hits:bigint,n:bigint>"
    made = rows.select(F.arrow_udf(lambda p, r: row_matches(p, r), kind)(pred, ref).alias("_m"))
    counts = made.agg(
        *[F.sum(f"_m.{c}").cast("double").alias(c) for c in ("tp", "n_pred", "n_ref")],
        F.try_divide(F.sum("_m.hits"), F.sum("_m.n")).alias("accuracy"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    tp, n_pred, n_ref = zero(F.col("tp")), zero(F.col("n_pred")), zero(F.col("n_ref"))
    return counts.select(
        _ratio(tp, n_pred).alias("precision"), _ratio(tp, n_ref).alias("recall"),
        _ratio(2 * tp, n_pred + n_ref).alias("f1"), "accuracy",
    )


ASCII_PUNCTUATION = r"[!-/:-@\[-`{-~]"


def answer_text(text: Column) -> Column:
    """Answers compared: lower case, no ASCII punctuation, no English articles, single blanks."""
    bare = F.regexp_replace(F.lower(text), ASCII_PUNCTUATION, "")
    bare = F.regexp_replace(bare, r"\b(a|an|the)\b", " ")
    return F.btrim(F.regexp_replace(bare, r"\s+", " "))


def squad_pairs(df: DataFrame, pred: str, answers: str) -> DataFrame:
    """(id, exact, f1): best exact match and token F1 of a prediction over its answers."""
    long = df.select("id", answer_text(F.col(pred)).alias("p"), F.posexplode(answers).alias("no", "a")).withColumn(
        "g", answer_text(F.col("a"))
    )
    listed = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    words = long.select("id", "no", (F.col("p") == F.col("g")).cast("double").alias("exact"), F.explode_outer(F.concat(
        F.transform(listed("p"), lambda w: F.struct(w.alias("w"), F.lit(1).alias("p"), F.lit(0).alias("g"))),
        F.transform(listed("g"), lambda w: F.struct(w.alias("w"), F.lit(0).alias("p"), F.lit(1).alias("g"))),
    )).alias("x"))
    per_word = words.groupBy("id", "no", F.col("x.w").alias("w")).agg(
        F.max("exact").alias("exact"), F.sum("x.p").alias("np"), F.sum("x.g").alias("ng")
    )
    per_answer = per_word.groupBy("id", "no").agg(
        F.max("exact").alias("exact"), F.coalesce(F.sum(F.least("np", "ng")), F.lit(0)).alias("same"),
        F.coalesce(F.sum(F.col("np") + F.col("ng")), F.lit(0)).alias("all"),
    )
    # No words on either side give an exact match but no overlap, hence 0 as in the token formula.
    score = F.when(F.col("same") == 0, 0.0).otherwise(2.0 * F.col("same") / F.col("all"))
    return per_answer.groupBy("id").agg(F.max("exact").alias("exact"), F.max(score).alias("f1"))


def squad_scores(df: DataFrame, pred: str, answers: str) -> DataFrame:
    return squad_pairs(df, pred, answers).agg(
        (100 * F.avg("exact")).alias("exact_match"), (100 * F.avg("f1")).alias("f1")
    )


def _weighted(value: Column, weight: Column) -> Column:
    return _ratio(F.sum(value * weight), F.sum(weight))


def masked_metrics(slots: DataFrame, tokens: DataFrame) -> DataFrame:
    """One row of running training metrics.

    ``slots``: (label, pred, sampled, loss, weight) per masked slot; ``tokens``: (label, pred, mask, loss)
    per token. Precision and recall are accuracies weighted by prediction and by label, as in training.
    """
    same = lambda a, b: (F.col(a) == F.col(b)).cast("double")
    w = F.col("weight").cast("double")
    gen = slots.agg(
        _weighted(same("label", "pred"), w).alias("masked_lm_accuracy"),
        _weighted(F.col("loss"), w).alias("masked_lm_loss"),
        _weighted(same("label", "sampled"), w).alias("sampled_masked_lm_accuracy"),
    )
    m = F.col("mask").cast("double")
    disc = tokens.agg(
        F.avg("loss").alias("disc_loss"),
        _weighted(same("label", "pred"), m).alias("disc_accuracy"),
        _weighted(same("label", "pred"), m * F.col("pred")).alias("disc_precision"),
        _weighted(same("label", "pred"), m * F.col("label")).alias("disc_recall"),
    )
    # Both sides are one row, so they are put side by side by a constant key.
    return gen.withColumn("_k", F.lit(1)).join(disc.withColumn("_k", F.lit(1)), "_k").drop("_k")


def cross_entropy(logits: str, label: str) -> Column:
    """Softmax cross-entropy of one slot from its logits array."""
    top = F.array_max(logits).cast("double")
    total = F.aggregate(
        F.zip_with(F.col(logits), F.array_repeat(top, F.size(logits)), lambda v, m: F.exp(v.cast("double") - m)),
        F.lit(0.0), lambda s, x: s + x,
    )
    return top + F.log(total) - F.element_at(F.col(logits), F.col(label).cast("int") + 1).cast("double")


def sigmoid_cross_entropy(logit: Column, label: Column) -> Column:
    return F.greatest(logit, F.lit(0.0)) - logit * label + F.log1p(F.exp(-F.abs(logit)))


def weighted_loss(loss: Column, weight: Column) -> Column:
    return F.sum(loss * weight) / (F.sum(weight) + 1e-6)


def token_losses(
    slots: DataFrame, tokens: DataFrame, gen_weight: float = 1.0, disc_weight: float = 50.0
) -> DataFrame:
    """One row: generator, discriminator and total loss.

    ``slots``: (logits, label, weight); ``tokens``: (logit, label, mask).
    """
    gen = slots.agg(weighted_loss(cross_entropy("logits", "label"), F.col("weight").cast("double")).alias("gen_loss"))
    each = sigmoid_cross_entropy(F.col("logit").cast("double"), F.col("label").cast("double"))
    disc = tokens.agg(weighted_loss(each, F.col("mask").cast("double")).alias("disc_loss"))
    both = gen.withColumn("_k", F.lit(1)).join(disc.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return both.withColumn("total_loss", gen_weight * F.col("gen_loss") + disc_weight * F.col("disc_loss"))


def softmax(logits: str) -> Column:
    top = F.array_max(logits).cast("double")
    raised = F.zip_with(F.col(logits), F.array_repeat(top, F.size(logits)), lambda v, m: F.exp(v.cast("double") - m))
    total = F.aggregate(raised, F.lit(0.0), lambda s, x: s + x)
    return F.zip_with(raised, F.array_repeat(total, F.size(logits)), lambda v, t: v / t)


def top_k_labels(df: DataFrame, keys: list[str], logits: str, k: int, labels: DataFrame | None = None) -> DataFrame:
    """(keys, rank, id, score): the k best classes with softmax scores; ties go to the lower class."""
    ranked = F.array_sort(F.transform("_p", lambda p, i: F.struct((-p).alias("neg"), i.alias("id"))))
    top = (
        df.select(*keys, softmax(logits).alias("_p"))
        .select(*keys, F.posexplode(F.slice(ranked, 1, k)).alias("rank", "x"))
        .select(*keys, "rank", F.col("x.id").alias("id"), (-F.col("x.neg")).alias("score"))
    )
    return top if labels is None else top.join(labels, "id", "left")


def argmax(logits: str) -> Column:
    """The class with the largest logit, the first one on ties."""
    best = F.array_max(F.transform(logits, lambda v, i: F.struct(v.alias("v"), (-i).alias("back"))))
    return (-best["back"]).cast("int")


def by_sign(logit: Column) -> Column:
    """Binary decision: 1 for a positive logit, half-to-even at zero (0)."""
    return F.bround((F.signum(logit) + 1) / 2, 0).cast("int")


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve as the rank-sum of positives, ties counted half."""
    counts = df.groupBy(F.col(score).cast("double").alias("_s")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("_neg"),
    )
    below = running_total(counts, "_s", F.col("_neg"), "_below")
    return below.agg(
        _ratio(
            F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2.0)),
            F.sum("_pos").cast("double") * F.sum("_neg").cast("double"),
        ).alias("auc")
    )
