"""Personal data by boosted trees over candidate spans, in DataFrame functions alone.

Exact rules find the base spans of four kinds. Wider generators propose more spans, which may overlap them and
each other: addresses written out with "at" and "dot", numbers in looser notations. Boosted trees score each
proposal by its format and its context, and never see what its label comes from: check digits, the size of numbers,
the top-level domain, a leading plus, the number of dots, or the notation. Two sources of labels weigh the same:

* the corpus, where a proposal is positive if its normal form (written-out signs as signs, other separators as the
  usual ones) keeps the base rule and its check. Generators are wide enough to propose prose ("arrived at noon"),
  versions and order numbers too, so that the corpus shows in which contexts the format is no personal data;
* planted sentences, where the sentence decides: the same well-formed span is positive where it is announced and
  negative in prose, after "version" or after "order".

A kind's threshold is the least score at which enough of the proposals kept out of learning are positive, and only
proposals whose normal form keeps the base rule are added.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textmill.llm.rows import columns

KINDS = ("email", "ip", "card", "phone")
# The rules' patterns, with possessive repeats and look-behinds that change no match and keep long runs linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:@| ?[\[(]at[\])] ?| at )[A-Za-z0-9-]++"
    r"(?:(?:\.| ?[\[(]dot[\])] ?| dot )[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:(?:\.|\[\.\]|\(\.\)| \. )[0-9]{1,3}+){2,7}+",
    "card": r"(?<![0-9])[0-9](?:[ ./_-]{0,2}[0-9]){11,18}+",
    "phone": r"(?<![0-9])(?:\+|00)?\(?[0-9](?:[ ().-]{0,2}[0-9]){7,14}+",
}
# The end of an address: a country's two letters, or a common or reserved domain. Prose ("at noon dot matrix") has others.
DOMAIN = (
    r"(?i)\.(?:[a-z]{2}|com|net|org|edu|gov|mil|int|info|biz|name|pro|mobi|jobs|museum|travel|coop|aero|cat|tel|asia"
    r"|app|dev|cloud|online|site|shop|store|tech|blog|xyz|club|live|email|agency|company|world|news|media|systems"
    r"|eu|example|test|invalid|local|localhost|internal)$"
)
# Words that announce a kind, in the languages of the usual corpora.
CONTEXT = {
    "email": r"mail|contact|write|kontakt|contacto|correo|courriel|schreib",
    "ip": r"\bip\b|host|server|address|adresse|serveur|servidor",
    "card": r"card|visa|credit|pay|karte|carte|tarjeta",
    "phone": r"phone|tel|call|mobile|fax|anruf|appel|llam",
}
# Words that speak against all kinds.
AGAINST = r"version|release|build|section|chapter|paragraph|order|invoice|serial|isbn|article|figure|table"
# What a text must hold for a pattern to match; the others are not searched.
HOLDS = {
    "base_email": "@", "base_ip": r"[0-9]\.[0-9]", "base_card": "[0-9]", "base_phone": r"\+[0-9]",
    "wide_email": r"@|[ \[(]at[ \])]", "wide_ip": r"[0-9](?:\.|\[\.|\(\.| \.)", "wide_card": "[0-9]", "wide_phone": "[0-9]",
}
# How many values each feature has.
FEATURES = {"kind": 4, "digits": 7, "announced": 3, "before": 4, "after": 4, "shape": 4, "length": 5}


def code_points(text: str, name: str, holds: str) -> dict[str, Column]:
    """Pieces between matches and the matches themselves; the pieces are one more."""
    pattern, there = F.lit(name), F.col(text).rlike(holds)
    return {
        "parts": F.when(there, F.split(F.col(text), pattern, -1)).otherwise(F.array(F.col(text))),
        "hits": F.when(there, F.regexp_extract_all(F.col(text), pattern, 0)).otherwise(F.array().cast("array<string>")),
    }


def with_matches(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """For each named pattern a column of (start, end, hit, before, after) structs, the leftmost matches.

    Starts are running sums of the pieces' lengths, taken in blocks of 64 so that a text of many matches costs
    little more than its length. ``before``: 24 characters, ``after``: one.
    """
    names = list(patterns)
    kept = df.columns
    found = [c.alias(f"_{k}_{n}") for n in names for k, c in code_points(text, patterns[n], HOLDS[n]).items()]
    df = df.select(*kept, *found)

    def add(df: DataFrame, label: str, make: Callable[[str], Column]) -> DataFrame:
        return df.select("*", *[make(n).alias(f"_{label}_{n}") for n in names])

    sized = lambda n: F.zip_with(
        F.slice(f"_parts_{n}", 1, F.greatest(F.size(f"_hits_{n}"), F.lit(0))), f"_hits_{n}",
        lambda p, h: (F.length(p) + F.length(h)).cast("long"),
    )
    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)
    df = add(df, "lens", sized)
    df = add(df, "blocks", lambda n: F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(f"_lens_{n}") - 1) / 64), F.lit(0)).cast("int")),
        lambda b: F.slice(f"_lens_{n}", b * 64 + 1, 64),
    ))
    df = add(df, "sums", lambda n: F.transform(f"_blocks_{n}", total))
    df = add(df, "ahead", lambda n: F.transform(
        f"_sums_{n}", lambda _, i: total(F.slice(f"_sums_{n}", F.lit(1), i))
    ))
    df = add(df, "ends", lambda n: F.flatten(F.zip_with(
        f"_blocks_{n}", f"_ahead_{n}",
        lambda block, base: F.transform(block, lambda _, j: base + total(F.slice(block, F.lit(1), j + 1))),
    )))
    made = lambda n: F.transform(
        F.arrays_zip(
            F.col(f"_ends_{n}").alias("end"), F.col(f"_hits_{n}").alias("hit"),
            F.slice(f"_parts_{n}", F.lit(1), F.size(f"_hits_{n}")).alias("part"),
            F.slice(f"_parts_{n}", F.lit(2), F.size(f"_hits_{n}")).alias("rest"),
        ),
        lambda x: F.struct(
            (x["end"] - F.length(x["hit"])).alias("start"), x["end"].alias("end"), x["hit"].alias("hit"),
            F.right(x["part"], F.lit(24)).alias("before"), F.left(x["rest"], F.lit(1)).alias("after"),
        ),
    )
    return df.select(*kept, *[made(n).alias(n) for n in names])


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit fits; every second digit from the right counts double."""
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    turned = F.reverse(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.coalesce(F.substring(turned, place, F.lit(1)).try_cast("int"), F.lit(0))
        double = digit * 2
        return total + F.when(place % 2 == 1, digit).otherwise(F.when(double > 9, double - 9).otherwise(double))

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def small_parts(hit: Column) -> Column:
    """Whether all numbers between dots are at most 255, however many zeros lead."""
    short = lambda part: F.regexp_replace(part, "^0+", "")
    fits = lambda part: (F.length(short(part)) <= 3) & (F.coalesce(short(part).try_cast("int"), F.lit(0)) <= 255)
    return F.forall(F.split(hit, r"\.", -1), fits)


def holds(kind: str, hit: Column) -> Column:
    """The base rule's condition on a match."""
    digits = only_digits(hit)
    if kind == "ip":
        return small_parts(hit)
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def bins(value: Column, edges: list[int]) -> Column:
    """How many of ``edges`` are at most ``value``."""
    found = F.lit(0)
    for edge in edges:
        found = found + (value >= edge).cast("int")
    return found


def character(text: Column) -> Column:
    """0 for none or white space, 1 a letter, 2 a digit, 3 another."""
    return (
        F.when(F.length(text) == 0, 0).when(text.rlike(r"^\s"), 0).when(text.rlike(r"^\p{L}"), 1)
        .when(text.rlike("^[0-9]"), 2).otherwise(3)
    )


def normal(kind: str, hit: Column) -> Column:
    """A wide match in the base rule's notation."""
    if kind == "email":
        return F.regexp_replace(F.regexp_replace(hit, r" ?[\[(]at[\])] ?| at ", "@"), r" ?[\[(]dot[\])] ?| dot ", ".")
    if kind == "ip":
        return F.regexp_replace(hit, r"[^0-9.]", "")
    if kind == "card":
        return only_digits(hit)
    return F.regexp_replace(hit, r"^00", "+")


def keeps(kind: str, hit: Column) -> Column:
    """Whether the normal form of a wide match is a base span, whether or not the match itself is one."""
    form = normal(kind, hit)
    right = form.rlike("^(?:" + BASE[kind] + ")$") & holds(kind, form)
    return right & form.rlike(DOMAIN) if kind == "email" else right


def shape(kind: str, hit: Column) -> Column:
    """For an address whether its name is one plain word, has capitals, or digits or joining signs; for numbers the
    signs between the digits: none, blanks, dots, or others."""
    if kind == "email":
        name = F.regexp_extract(hit, "^[A-Za-z0-9._%+-]+", 0)
        return F.when(name.rlike("[0-9]"), 3).when(name.rlike("[._%+-]"), 2).when(name.rlike("[A-Z]"), 1).otherwise(0)
    if kind == "ip":
        return F.lit(0)  # the dots are how its notation strays
    inner = F.regexp_replace(hit, r"^(?:\+|00)", "")
    return F.when(inner.rlike("^[0-9]+$"), 0).when(inner.rlike("[()/_-]"), 3).when(inner.contains("."), 2).otherwise(1)


def features(kind: str, x: Column) -> dict[str, Column]:
    digits = only_digits(F.regexp_replace(x["hit"], "^00", "") if kind == "phone" else x["hit"])
    said = F.lower(x["before"])
    measured = F.regexp_extract(x["hit"], "^[A-Za-z0-9._%+-]+", 0) if kind == "email" else digits
    return {
        "kind": F.lit(KINDS.index(kind)),
        "digits": bins(F.length(digits), [1, 8, 11, 13, 16, 17]),
        "announced": F.when(said.rlike(AGAINST), 2).when(said.rlike(CONTEXT[kind]), 1).otherwise(0),
        "before": character(F.right(x["before"], F.lit(1))),
        "after": character(x["after"]),
        "shape": shape(kind, x["hit"]),
        "length": bins(F.length(measured), [3, 5, 8, 13]),
    }


def proposals(df: DataFrame) -> DataFrame:
    """Adds ``base``, an array of (start, kind, end), and ``proposed``, the same with features and whether its
    normal form keeps the base rule. Needs the column ``text``."""
    kept = df.columns
    df = with_matches(df, "text", {f"base_{k}": p for k, p in BASE.items()} | {f"wide_{k}": p for k, p in WIDE.items()})
    spans = lambda kind: F.transform(
        F.filter(f"base_{kind}", lambda x: holds(kind, x["hit"])),
        lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end")),
    )
    df = df.select(*kept, *[f"wide_{k}" for k in KINDS], *[spans(k).alias(f"held_{k}") for k in KINDS])

    def told(kind: str) -> Column:
        return F.transform(f"wide_{kind}", lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), keeps(kind, x["hit"]).alias("right"),
            *[c.cast("int").alias(n) for n, c in features(kind, x).items()],
        ))

    return df.select(
        *kept, F.array_sort(F.concat(*[F.col(f"held_{k}") for k in KINDS])).alias("base"),
        F.concat(*[told(k) for k in KINDS]).alias("proposed"),
    )


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    feature: str
    most: int  # values up to this one go left
    left: Split | Leaf
    right: Split | Leaf


def grow(rows: list[tuple[dict[str, int], float, float]], depth: int) -> Split | Leaf:
    """A tree for (features, gradient, curvature) rows that gains most by second-order steps."""
    worth = lambda g, h: g * g / (h + 1.0)
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = (1e-6, None)
    if depth:
        for name, size in FEATURES.items():
            by = [[0.0, 0.0] for _ in range(size)]
            for f, a, b in rows:
                by[f[name]][0] += a
                by[f[name]][1] += b
            left_g = left_h = 0.0
            for value in range(size - 1):
                left_g, left_h = left_g + by[value][0], left_h + by[value][1]
                gain = worth(left_g, left_h) + worth(g - left_g, h - left_h) - worth(g, h)
                if gain > best[0]:
                    best = (gain, (name, value))
    if best[1] is None:
        return Leaf(g / (h + 1.0))
    name, value = best[1]
    sides = [[r for r in rows if (r[0][name] <= value) == side] for side in (True, False)]
    return Split(name, value, grow(sides[0], depth - 1), grow(sides[1], depth - 1))


def value_of(tree: Split | Leaf, f: dict[str, int]) -> float:
    while isinstance(tree, Split):
        tree = tree.left if f[tree.feature] <= tree.most else tree.right
    return tree.value


def column_of(tree: Split | Leaf, x: Column) -> Column:
    if isinstance(tree, Leaf):
        return F.lit(tree.value)
    return F.when(x[tree.feature] <= tree.most, column_of(tree.left, x)).otherwise(column_of(tree.right, x))


@dataclass(frozen=True)
class Model:
    trees: tuple[Split | Leaf, ...]
    rate: float
    thresholds: tuple[float, ...]  # of the summed tree values, by kind

    def score(self, f: dict[str, int]) -> float:
        return self.rate * sum(value_of(tree, f) for tree in self.trees)

    def accepts(self, x: Column) -> Column:
        total = F.lit(0.0)
        for tree in self.trees:
            total = total + column_of(tree, x)
        threshold = F.element_at(F.array(*[F.lit(t) for t in self.thresholds]), x["kind"] + 1)
        return total * self.rate >= threshold


PLANTED = 4000  # sentences


def planted(spark: SparkSession) -> DataFrame:
    """(doc_id, text, kind, truth): sentences with one well-formed span each, personal data or not by what is said."""
    def pick(label: str, *values: str) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.pmod(F.xxhash64("id", F.lit(label)), F.lit(len(values))).cast("int") + 1)

    def number(label: str, size: int) -> Column:
        return F.lpad(F.pmod(F.xxhash64("id", F.lit(label)), F.lit(10**size)).cast("string"), size, "0")

    part = lambda label: F.pmod(F.xxhash64("id", F.lit(label)), F.lit(256)).cast("string")
    yes = F.pmod(F.floor(F.col("id") / 4), F.lit(2)) == 0
    lead = lambda right, wrong: F.when(yes, pick("lead", *right)).otherwise(pick("lead", *wrong))
    at, dot = pick("at", "@", " at ", " [at] ", "(at)"), pick("dot", ".", " dot ", " [dot] ", "(dot)")
    name = F.when(yes, pick("name", "john", "maria", "info", "j.smith", "ana_lopez", "User")).otherwise(
        pick("name", "talks", "arrived", "look", "meeting", "held", "stayed"))
    account = F.when(yes & (F.pmod(F.xxhash64("id"), F.lit(2)) == 0), F.concat(name, number("n", 2))).otherwise(name)
    email = F.concat(
        lead(["please write to ", "contact ", "my mail is ", "kontakt: "], ["the ", "they ", "we all ", "after the long "]), account,
        F.when(yes, at).otherwise(" at "), pick("host", "geneva", "example", "home", "uni", "work"),
        F.when(yes, dot).otherwise(" dot "), pick("end", "de", "org", "com", "fr"),
    )
    dots, mark = pick("dots", ".", "[.]", " . "), pick("mark", " ", "-", ".")
    ip = F.concat(
        lead(["server ", "the host ", "address ", "ip: "], ["version ", "release ", "section ", "chapter "]),
        part("a"), dots, part("b"), dots, part("c"), dots, part("d"),
    )
    stem = number("card", 15)
    valid = F.element_at(F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(stem, d.cast("string"))), luhn), 1)
    card = F.concat(
        lead(["my card ", "visa ", "pay with ", "credit: "], ["order ", "serial ", "invoice ", "article "]),
        F.regexp_replace(valid, "([0-9]{4})(?=[0-9])", F.concat(F.lit("$1"), pick("mark", "", " ", ".", "/"))),
    )
    phone = F.concat(
        lead(["call ", "phone ", "tel ", "mobile "], ["order ", "serial ", "isbn ", "invoice "]),
        pick("plus", "+", "00"), pick("land", "49", "33", "1", "44"), F.lit(" "),
        number("p", 2), mark, number("q", 4), mark, number("r", 4),
    )
    kind = F.pmod("id", F.lit(4)).cast("int")
    text = F.concat(
        F.when(kind == 0, email).when(kind == 1, ip).when(kind == 2, card).otherwise(phone), pick("tail", "", " soon", " again", ", thanks"),
    )
    return spark.range(PLANTED).select(F.col("id").alias("doc_id"), text.alias("text"), kind.alias("kind"), yes.alias("truth"))


def cell_counts(rows: DataFrame, label: Callable[[Column], Column], of_kind: Column | None = None) -> list[tuple[dict[str, int], bool, bool, int]]:
    """(features, label, kept out, count) of the proposals of all rows. There are at most 53,760 combinations,
    so what the driver holds does not grow with the corpus."""
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 3, F.lit(False))

    def cell(x: Column) -> Column:  # one number for all features, which is cheaper to group by than a struct
        code = label(x).cast("int")
        for name, size in FEATURES.items():
            code = code * size + x[name]
        return code

    proposed = F.col("proposed") if of_kind is None else F.filter("proposed", lambda x: x["kind"] == of_kind)
    counted = rows.select(fold.alias("out"), F.explode(F.transform(proposed, cell)).alias("cell"))
    cells = []
    for row in counted.groupBy("out", "cell").count().collect():
        f, code = {}, row["cell"]
        for name, size in reversed(FEATURES.items()):
            code, f[name] = divmod(code, size)
        cells.append(({n: f[n] for n in FEATURES}, bool(code), row["out"], row["count"]))
    return sorted(cells, key=lambda c: (tuple(c[0].values()), c[1], c[2]))


def shares(cells: list, weight: float = 1000.0) -> list:
    """The counts as weights; those of a kind add up to ``weight`` in each fold."""
    total: dict[tuple[int, bool], int] = {}
    for f, _, out, n in cells:
        total[f["kind"], out] = total.get((f["kind"], out), 0) + n
    return [(f, y, out, weight * n / total[f["kind"], out]) for f, y, out, n in cells]


def learn(proposed: DataFrame, trees: int = 16, depth: int = 3, rate: float = 0.5, precision: float = 0.95) -> Model:
    """A model from all rows with doc_id and ``proposed``, and the planted sentences.

    Proposals are counted by their features first. In each kind the corpus and the sentences weigh the same, whatever
    the size of the corpus. One in four documents and sentences is kept out for the thresholds.
    """
    sentences = proposals(planted(proposed.sparkSession))
    cells = shares(cell_counts(proposed, lambda x: x["right"])) + shares(cell_counts(sentences, lambda _: F.col("truth"), F.col("kind")))
    learned = [(f, y, n) for f, y, out, n in cells if not out]
    built, scores = [], [0.0] * len(learned)
    for _ in range(trees):
        rows = []
        for (f, y, n), s in zip(learned, scores, strict=True):
            chance = 1 / (1 + math.exp(-s))
            rows.append((f, n * (y - chance), n * chance * (1 - chance)))
        built.append(grow(rows, depth))
        scores = [s + rate * value_of(built[-1], f) for (f, _, _), s in zip(learned, scores, strict=True)]
    model = Model(tuple(built), rate, ())
    thresholds = []
    for kind in range(len(KINDS)):
        by: dict[float, list[float]] = {}
        for f, y, out, n in cells:
            if out and f["kind"] == kind:
                pair = by.setdefault(round(model.score(f), 9), [0.0, 0.0])
                pair[not y] += n
        right = wrong = 0.0
        least = math.inf
        for score in sorted(by, reverse=True):
            right, wrong = right + by[score][0], wrong + by[score][1]
            if right >= precision * (right + wrong):
                least = score - 1e-6
        thresholds.append(least)
    return Model(tuple(built), rate, tuple(thresholds))


def overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def with_spans(df: DataFrame) -> DataFrame:
    """Adds ``base`` and ``spans`` (arrays of start, kind, end in order) to rows with doc_id and ``text``."""
    proposed = proposals(df)
    model = learn(proposed)
    chosen = F.filter("proposed", lambda x: x["right"] & model.accepts(x) & ~F.exists("base", lambda b: overlap(b, x)))
    added = F.transform(
        chosen, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))
    )
    return proposed.select(*df.columns, "base", F.array_sort(F.concat("base", added)).alias("spans"))


def written(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))
    return F.concat_ws(",", F.transform(spans, one))


def personal_spans(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all ``spans`` of each row of ``docs`` (doc_id, text).

    Offsets are code points, ends exclusive. Null and empty texts have no spans; repeated rows are searched each; a null doc_id
    stays; other columns are ignored; no rows give no rows. No shuffle of texts: a row is worked on where it is read.
    """
    rows = columns(docs, doc_id="long", text="string")
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = with_spans(rows)
    of_kind = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(written("base").cast("binary"), 256).alias("base_sha256"), written("spans").alias("spans")
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all their columns, in which each run of overlapping spans is its first span's kind in brackets.

    Null texts stay null. Other columns are untouched, whatever their names.
    """
    packed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )
    found = with_spans(packed)
    # (runs so far, where the last one ends)
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")

    def merge(runs: Column, x: Column) -> Column:
        last = F.element_at(runs, -1)
        longer = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], x["end"]).alias("end"))
        joins = (F.size(runs) > 0) & (x["start"] < F.try_element_at(runs, F.lit(-1))["end"])
        return F.when(joins, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(longer))).otherwise(F.concat(runs, F.array(x)))

    runs = found.select("_row", "text", F.aggregate("spans", empty, merge).alias("runs"))
    ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("runs", lambda x: x["end"]))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    pieces = F.zip_with("runs", F.slice(ends, F.lit(1), F.size("runs")), lambda x, last: F.concat(
        F.substring(F.col("text"), (last + 1).cast("int"), (x["start"] - last).cast("int")), F.element_at(names, x["kind"] + 1)
    ))
    rest = F.substring(F.col("text"), (F.element_at(ends, -1) + 1).cast("int"), F.length("text"))
    text = F.when(F.size("runs") == 0, F.col("text")).otherwise(F.concat(F.array_join(pieces, ""), rest))
    cleaned = runs.select("_row", text.alias("_text"))
    return cleaned.select(*[
        F.col("_text").alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns
    ])
