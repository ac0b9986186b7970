"""Masking and token replacement on fixed-length examples.

Everything works inside the example row (at most a few hundred tokens), so no step shuffles. Candidates, draws
and updates of all rows of an Arrow batch are made together. An example has ``input_ids``/``input_mask``/``segment_ids`` of one length and keys that feed the draws.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.drawn import least_drawn, uniform_each
from textmill.functions.draws import uniform
from textmill.operators.packing import filled
from textmill.operators.scatter import candidates, scattered

MASK_SHARE = 0.15
MASKED_AS_MASK = 0.85
KEYS = ["doc_id", "max_len", "ex"]


def max_predictions(length, share: float = MASK_SHARE) -> Column:
    """Slots per example: 19 for 128 tokens and 79 for 512 at the usual share."""
    return F.floor((share + 0.005) * (F.lit(length) if isinstance(length, int) else length)).cast("int")


def mask_budget(tokens: Column, slots: Column, share: float = MASK_SHARE) -> Column:
    """Positions to mask: the share of real tokens, half to even, at least one, at most ``slots``."""
    return F.greatest(F.lit(1), F.least(slots, F.bround(tokens * F.lit(share), 0).cast("int")))


def mask_candidates(df: DataFrame, ignore: list[Column], disallow: str | None = None) -> DataFrame:
    """Adds ``candidates``: positions of real tokens other than the ignored ids."""
    allowed = F.arrow_udf(lambda *lists: candidates(*lists), "array<int>")
    return df.withColumn("candidates", allowed("input_ids", "input_mask", F.array(*ignore).cast("array<int>"), *([disallow] if disallow else [])))


def sample_positions(
    df: DataFrame, share: float = MASK_SHARE, seed: int = 0, weights: str | None = None, replacement: bool = False,
    keys: list[str] | None = None, already: str | None = None,
) -> DataFrame:
    """Adds ``positions`` (ascending when drawn without replacement, else in slot order).

    Without replacement: order candidates by a hashed key (``-ln(u)/w`` when weighted) and keep the budget.
    With replacement: one draw per slot through the cumulative weights.
    """
    keys = keys or KEYS
    tokens = F.aggregate("input_mask", F.lit(0), lambda acc, m: acc + m)
    budget = mask_budget(tokens, max_predictions(F.size("input_ids"), share), share)
    df = df.withColumn("budget", budget)
    if replacement:
        weight = (lambda p: F.element_at(F.col(weights), p + 1)) if weights else (lambda p: F.lit(1.0))
        begin = F.struct(F.lit(0.0).alias("total"), F.array().cast("array<struct<pos:int,upto:double>>").alias("all"))
        cumulative = F.aggregate(
            "candidates", begin,
            lambda acc, p: F.struct(
                (acc["total"] + weight(p)).alias("total"),
                F.concat(
                    acc["all"], F.array(F.struct(p.alias("pos"), (acc["total"] + weight(p)).alias("upto")))
                ).alias("all"),
            ),
        )
        slots = F.transform(F.sequence(F.lit(0), F.col("budget") - 1), lambda j: uniform(seed, "slot", *keys, j))
        df = df.withColumn("_cum", cumulative).withColumn("_slots", slots)
        # The ladder rides along in the accumulator so that it is built once, not once per slot.
        start = F.struct(F.col("_cum").alias("c"), F.array().cast("array<int>").alias("out"))
        picked = F.aggregate(
            "_slots", start,
            lambda acc, u: F.struct(
                acc["c"].alias("c"),
                F.concat(acc["out"], F.array(F.get(
                    F.filter(acc["c"]["all"], lambda x: x["upto"] > u * acc["c"]["total"]), F.lit(0)
                )["pos"])).alias("out"),
            ),
            lambda acc: F.filter(acc["out"], lambda p: p.isNotNull()),
        )
        return df.withColumn("positions", picked).drop("_cum", "_slots")
    if weights:
        draw = lambda p: uniform(seed, "mask", *keys, p)
        # A weight of zero is never drawn. A draw of zero comes last, as its logarithm would put it.
        chance = lambda p: F.element_at(F.col(weights), p + 1)
        key = lambda p: F.coalesce(-F.log(draw(p)) / chance(p), F.lit(float("inf")))
        possible = F.filter("candidates", lambda p: chance(p) > 0)
        drawn = F.sort_array(F.transform(possible, lambda p: F.struct(key(p).alias("k"), p.alias("p"))))
        chosen = F.sort_array(F.transform(F.slice(drawn, F.lit(1), F.col("budget")), lambda x: x["p"]))
    else:
        chosen = least_drawn(seed, "mask", *keys, numbers="candidates", n=F.col("budget"))
    if already:
        chosen = F.array_except(chosen, F.col(already))
    return df.withColumn("positions", chosen)


def gather_positions(sequence: str, positions: str) -> Column:
    """Values of ``sequence`` at zero-based ``positions``."""
    return F.transform(positions, lambda p: F.element_at(F.col(sequence), p + 1))


def scatter_update(df: DataFrame, sequence: str, positions: str, updates: str, out: str, changed: str) -> DataFrame:
    """Replaces values at positions. Position 0 is ignored; updates that share a position are averaged
    (floor for ints). ``changed`` marks updated positions."""
    kind = df.schema[sequence].dataType.simpleString()
    put = F.arrow_udf(lambda *lists: scattered(*lists), f"struct<updated:{kind},changed:array<int>>")
    return (
        df.withColumn("_put", put(sequence, positions, updates))
        .withColumn(out, F.col("_put.updated")).withColumn(changed, F.col("_put.changed")).drop("_put")
    )


def apply_mask(df: DataFrame, mask_id: Column, seed: int = 0, keys: list[str] | None = None) -> DataFrame:
    """Adds ``masked_lm_ids`` (originals) and ``masked_ids`` (most positions replaced by the mask id)."""
    keys = keys or KEYS
    df = df.withColumn("_u", uniform_each(seed, "hide", *keys, numbers="positions"))
    drawn = F.filter(F.arrays_zip(F.col("positions").alias("p"), F.col("_u").alias("u")), lambda x: x["u"] < MASKED_AS_MASK)
    df = df.withColumn("masked_lm_ids", gather_positions("input_ids", "positions")).withColumn("_hidden", F.transform(drawn, lambda x: x["p"]))
    df = df.withColumn("_masks", F.array_repeat(mask_id, F.size("_hidden")))
    return scatter_update(df, "input_ids", "_hidden", "_masks", "masked_ids", "hidden_mask").drop("_u", "_hidden", "_masks")


def masked_slots(df: DataFrame, share: float = MASK_SHARE) -> DataFrame:
    """Fixed-width slot columns: positions, ids and weights padded with zeros to the slots per example."""
    slots = max_predictions(F.size("input_ids"), share)
    free = slots - F.size("positions")
    return df.withColumns({
        "masked_lm_positions": F.concat(F.col("positions"), filled(0, free)),
        "masked_lm_weights": F.concat(
            F.array_repeat(F.lit(1.0).cast("float"), F.size("positions")),
            F.array_repeat(F.lit(0.0).cast("float"), F.greatest(free, F.lit(0))),
        ),
        "masked_lm_ids": F.concat(F.col("masked_lm_ids"), filled(0, free)),
    })


def unmask(df: DataFrame) -> DataFrame:
    """Adds ``restored_ids``: the masked example with the original ids put back."""
    return scatter_update(df, "masked_ids", "positions", "masked_lm_ids", "restored_ids", "restored_mask")


def replace_tokens(
    df: DataFrame, vocab_size: Column, seed: int = 0, never_right: bool = False, keys: list[str] | None = None
) -> DataFrame:
    """Adds ``corrupted_ids`` and ``is_fake``: each masked slot gets a uniform draw over the vocabulary.

    ``never_right`` draws among the other ids. A slot that drew its own id is not fake.
    """
    keys = keys or KEYS
    df = df.withColumn("_u", uniform_each(seed, "fake", *keys, numbers="positions"))
    pairs = F.arrays_zip(F.col("_u").alias("u"), F.col("masked_lm_ids").alias("o"))

    def drawn(x: Column) -> Column:
        u = x["u"]
        if not never_right:
            return F.floor(u * vocab_size).cast("int")
        other = F.floor(u * (vocab_size - 1)).cast("int")
        return F.when(other >= x["o"], other + 1).otherwise(other)

    df = df.withColumn("sampled_ids", F.transform(pairs, drawn))
    df = scatter_update(df, "input_ids", "positions", "sampled_ids", "corrupted_ids", "replaced_mask")
    fake = F.transform(
        F.arrays_zip(F.col("corrupted_ids").alias("c"), F.col("input_ids").alias("i"), F.col("replaced_mask").alias("m")),
        lambda x: F.when((x["m"] == 1) & (x["c"] != x["i"]), 1).otherwise(0),
    )
    return df.withColumn("is_fake", fake).drop("_u", "replaced_mask")


def sample_from_logits(
    df: DataFrame, keys: list[str], logits: str, temperature: float = 1.0, disallow: str | None = None, seed: int = 0
) -> DataFrame:
    """(keys, sampled): Gumbel-max draw from each row of logits; ``disallow`` names a class to avoid."""
    def score(value: Column, c: Column) -> Column:
        noise = -F.log(-F.log(uniform(seed, "gumbel", *keys, c) + 1e-9) + 1e-9)
        level = value.cast("double") / temperature
        if disallow:
            level = level - F.when(c == F.col(disallow), 1000.0).otherwise(0.0)
        # The earlier class wins a tie, as an argmax does.
        return F.struct((level + noise).alias("score"), (-c).alias("back"))

    best = F.array_max(F.transform(logits, score))
    return df.select(*keys, (-best["back"]).alias("sampled"), best["score"].alias("score"))


def preview_masked(df: DataFrame, vocab: DataFrame, keys: list[str] | None = None, ids: str = "masked_ids") -> DataFrame:
    """(keys, preview): tokens of an example up to the padding, originals of masked slots in brackets."""
    keys = keys or KEYS
    originals = F.map_from_arrays("positions", "masked_lm_ids")
    # The outer form: a plain explode infers a filter that repeats the whole masking expression below.
    long = df.select(*keys, originals.alias("o"), F.posexplode_outer(ids).alias("pos", "id")).select(
        *keys, "pos", "id", F.element_at("o", F.col("pos")).alias("orig")
    )
    names = vocab.select("id", "token")
    shown = (
        long.join(names, "id")
        .join(names.select(F.col("id").alias("orig"), F.col("token").alias("orig_token")), "orig", "left")
    )
    text = F.when(F.col("orig").isNotNull(), F.concat("token", F.lit(" ("), "orig_token", F.lit(")"))).otherwise(
        F.col("token")
    )
    listed = F.sort_array(F.collect_list(F.struct("pos", "token", text.alias("text"))))
    first_pad = F.array_position(F.transform("all", lambda x: x["token"]), "[PAD]")
    return (
        shown.groupBy(*keys).agg(listed.alias("all"))
        .withColumn("_n", F.when(first_pad > 0, first_pad - 1).otherwise(F.size("all")).cast("int"))
        .select(*keys, F.array_join(F.transform(F.slice("all", F.lit(1), F.col("_n")), lambda x: x["text"]), " ").alias("preview"))
    )
