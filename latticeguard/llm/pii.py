"""Personal data by candidate gradient boosting, in DataFrame functions and Spark ML only.

Base spans come from fixed patterns with checks (octets, Luhn, digit counts); they always stay.
High-recall generators propose more: the same kinds in looser forms (bracketed at and dot signs,
other separators, other digit counts), overlapping as they fall. Boosted trees judge a proposal by
its format and its surroundings, and a threshold per kind, calibrated for precision on held-out
rows, selects what is added.

The trees are fitted on a bounded sample of the corpus's own base spans (`FIT_SPANS`, drawn by hash)
and of a few fixed ones, so that no kind is ever without. Positive are the spans and copies of them in
loose forms; negative are the same strings where the surroundings speak against them (after a word
such as "order no.", grown together with other letters, or bare digits without a cue). Both share the
format, so the context decides, and every loose form is learnt whatever the corpus holds. Thresholds
are calibrated on all held-out spans of the corpus. The fitted trees become one CASE expression, so
that the pass over the corpus is a single narrow projection: nothing is shuffled and rows don't
depend on each other.

All patterns run in linear time and without recursion on long runs (possessive groups; a match may
start only where a run starts or the last match ended), offsets are prefix sums over blocks, and
overlaps are counted by merging sorted bounds, so texts of any length are searched whole.
"""
from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeguard.llm.common import free_name, materialize
from latticeguard.session import release

KINDS = ("email", "ip", "card", "phone")
#: Spans of the corpus drawn for the fit, of each kind at most.
FIT_SPANS = 5_000
TREES = 20
DEPTH = 3
#: Precision a kind's threshold must reach on held-out spans; without a held-out span, the default holds.
PRECISION = 0.995
DEFAULT_THRESHOLD = 0.9
GRID = tuple(i / 100 for i in range(50, 100, 2))
NEAR = 32
_BLOCK = 256
_CODE = 1 << 31

_LOCAL = "[A-Za-z0-9._%+-]"
_AT = r"(?:@|\x20?[\[({]\x20?(?:at|AT)\x20?[\])}]\x20?)"
_DOT = r"(?:\.|\x20?[\[({]\x20?(?:dot|DOT|\.)\x20?[\])}]\x20?)"
#: Base patterns: as the contract has them, but possessive and anchored to the start of a run.
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)*+",
    "ip": rf"(?:(?<![0-9])|\G)[0-9]++(?:{_DOT}[0-9]++){{3}}+",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20._/-]{0,2}+[0-9]){11,22}+",
    "phone": r"(?:(?<![0-9+])|\G)[+(]?[0-9][\x20()./0-9-]{5,20}[0-9]",
}
_CUES = {"email": r"(?i)mail|contact|write", "ip": r"(?i)\bip|host|server|addr", "card": r"(?i)card|visa|credit|pay",
          "phone": r"(?i)tel|phone|call|fax|mobil"}
#: Words right before a number that is a reference, not personal data.
_REFERENCE = ("no", "nr", "id", "order", "ref", "isbn", "invoice", "version", "section", "page")
_REFERENCES = rf"(?i)\b(?:{'|'.join(_REFERENCE)})\b[\x20.:#-]*$"
#: Spans every fit knows, reserved for documentation and tests.
SEEDS = {
    "email": ("ann@example.org", "j.doe+news@mail.example.com", "info@example.net", "first.last@dept.example.edu"),
    "ip": ("192.0.2.17", "198.51.100.3", "203.0.113.250", "10.0.0.1"),
    "card": ("4111 1111 1111 1111", "5555-5555-5555-4444", "4012888888881881", "6011 1111 1111 1117"),
    "phone": ("+1 202 555 0123", "+44 20 7946 0958", "+49 (30) 901820", "+1 (578) 555-6437"),
}
FEATURES = ("k_email", "k_ip", "k_card", "k_phone", "length", "digits", "letters", "marks", "blanks", "parts",
            "longest_part", "luhn", "octets", "tail", "prefix", "word_before", "word_after", "cue", "reference")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's check of a string of digits."""
    def add(total: Column, pair: Column) -> Column:
        value = F.coalesce(pair["d"].try_cast("int"), F.lit(0)) * F.when(pair["i"] % 2 == 1, 2).otherwise(1)
        return total + value - F.when(value > 9, 9).otherwise(0)

    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    return F.aggregate(each, F.lit(0), add) % 10 == 0


def _canonical(kind: str, text: Column) -> Column:
    """The proposal with bracketed signs spelt plainly."""
    if kind in ("email", "ip"):
        text = F.regexp_replace(F.regexp_replace(text, r"\x20?[\[({]\x20?(?:at|AT)\x20?[\])}]\x20?", "@"),
                                r"\x20?[\[({]\x20?(?:dot|DOT|\.)\x20?[\])}]\x20?", ".")
    return text


_OCTETS = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2}+)(?:\.|$)){4}$"


def base_check(kind: str, text: Column) -> Column:
    """Whether a match of the base pattern stays."""
    if kind == "ip":
        return text.rlike(_OCTETS)
    if kind == "card":
        digits = _digits(text)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(text)).between(8, 15)
    return F.lit(True)


def wide_check(kind: str, text: Column) -> Column:
    """Whether a proposal has the format of its kind."""
    text, digits = _canonical(kind, text), _digits(text)
    if kind == "email":
        return text.rlike(rf"^{_LOCAL}++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{{2,}}+$")
    if kind == "ip":
        return text.rlike(_OCTETS)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(8, 15) & ~text.rlike(r"[./]{2}|\x20{2}")


def _barrier(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with new columns that later projections can't inline (and so evaluate again per element)."""
    made = F.array(F.struct(*(c.alias(n) for n, c in columns.items())))
    return df.select("*", F.inline(made))


def _running(df: DataFrame, steps: str, into: str, kinds: dict[str, str]) -> DataFrame:
    """`into`_kind: running sums of the long arrays `steps`_kind, in blocks, so that the cost stays near
    linear for texts with very many spans."""
    def total(a: Column, x: Column) -> Column:
        return a + x

    def sums(kind: str) -> Column:
        step = F.col(f"{steps}_{kind}")
        last = F.floor(F.size(step) / _BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.aggregate(
            F.slice(step, b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0).cast("long"), total))

    def before(kind: str) -> Column:
        block = F.col(f"{into}_blocks_{kind}")
        return F.transform(block, lambda _, b: F.aggregate(
            F.slice(block, F.lit(1), b), F.lit(0).cast("long"), total))

    def ends(kind: str) -> Column:
        step, done = F.col(f"{steps}_{kind}"), F.col(f"{into}_before_{kind}")
        return F.transform(step, lambda _, i: F.aggregate(
            F.slice(step, i - i % _BLOCK + 1, i % _BLOCK + 1),
            F.get(done, F.floor(i / _BLOCK).cast("int")), total))

    df = _barrier(df, **{f"{into}_blocks_{k}": sums(k) for k in kinds})
    df = _barrier(df, **{f"{into}_before_{k}": before(k) for k in kinds})
    df = _barrier(df, **{f"{into}_{k}": ends(k) for k in kinds})
    return df.drop(*(f"{into}_{x}_{k}" for x in ("blocks", "before") for k in kinds))


def _matches(df: DataFrame, text: str, patterns: dict[str, str], into: str, around: bool = False) -> DataFrame:
    """A column `into`_kind per pattern: array of (s, e, t), code points, end exclusive, in order of start.

    With `around`, also before (at most NEAR characters) and after (at most 4), which reach no further
    than over the neighbouring match.
    """
    may = {"email": r"@|[\[({]\x20?(?:at|AT)", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
    none = F.array().cast("array<string>")
    raw = {}
    for kind, pattern in patterns.items():
        there = F.col(text).rlike(may[kind])
        raw[f"{into}_m_{kind}"] = F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
        raw[f"{into}_g_{kind}"] = F.when(there, F.split(text, pattern, -1)).otherwise(none)
    df = _barrier(df, **raw)
    steps = {f"{into}_s_{kind}": F.zip_with(
        F.slice(f"{into}_g_{kind}", F.lit(1), F.size(f"{into}_m_{kind}")), f"{into}_m_{kind}",
        lambda gap, match: (F.length(gap) + F.length(match)).cast("long")) for kind in patterns}
    df = _running(_barrier(df, **steps), f"{into}_s", f"{into}_e", patterns)

    def span(kind: str) -> Column:
        match, gap = F.col(f"{into}_m_{kind}"), F.col(f"{into}_g_{kind}")

        def one(t: Column, i: Column) -> Column:
            end = F.get(f"{into}_e_{kind}", i)
            parts = [(end - F.length(t)).alias("s"), end.alias("e"), t.alias("t")]
            if around:
                before = F.concat(F.coalesce(F.get(match, i - 1), F.lit("")), F.get(gap, i))
                after = F.concat(F.get(gap, i + 1), F.coalesce(F.get(match, i + 1), F.lit("")))
                parts += [F.right(before, F.lit(NEAR)).alias("before"), F.left(after, F.lit(4)).alias("after")]
            return F.struct(*parts)

        return F.transform(match, one)

    df = _barrier(df, **{f"{into}_{kind}": span(kind) for kind in patterns})
    return df.drop(*raw, *steps, *(f"{into}_e_{kind}" for kind in patterns))


def _check_all(spans: Column, kind: str, check) -> Column:
    return F.filter(spans, lambda x: check(kind, x["t"]))


def _features(kind: str, t: Column, before: Column, after: Column) -> list[Column]:
    plain, digits = _canonical(kind, t), _digits(t)
    count = lambda pattern: F.length(F.regexp_replace(t, pattern, ""))
    parts = F.split(plain, r"[^A-Za-z0-9]+")
    flag = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    values = [*(F.lit(int(kind == k)) for k in KINDS), F.length(plain), F.length(digits), count("[^A-Za-z]"),
              count(r"[A-Za-z0-9\x20]"), count(r"[^\x20]"), F.size(parts),
              F.array_max(F.transform(parts, lambda p: F.length(p))),
              flag(F.when(F.length(digits).between(12, 23), _luhn(digits))) if kind == "card" else F.lit(0),
              flag(plain.rlike(_OCTETS)) if kind == "ip" else F.lit(0),
              F.when(plain.rlike("@"), F.length(F.regexp_extract(plain, r"\.([A-Za-z]++)$", 1))).otherwise(0),
              flag(t.rlike(r"^(?:\+|00|\()")), flag(before.rlike(r"[\p{L}0-9]$")), flag(after.rlike(r"^[\p{L}0-9]")),
              flag(before.rlike(_CUES[kind])), flag(before.rlike(_REFERENCES))]
    return [v.cast("double").alias(n) for n, v in zip(FEATURES, values, strict=True)]


def _spans(docs: DataFrame, text: str) -> DataFrame:
    """(kind, t, before, after, h): the distinct base spans of the corpus with their surroundings, and the seeds."""
    df = _matches(docs.select(F.col(text).alias("text")).where("text IS NOT NULL"), "text", BASE, "base", around=True)

    def rows(kind: str) -> Column:
        return F.transform(_check_all(F.col(f"base_{kind}"), kind, base_check), lambda x: F.struct(
            F.lit(kind).alias("kind"), x["t"].alias("t"), x["before"].alias("before"), x["after"].alias("after")))

    found = df.select(F.inline(F.concat(*map(rows, KINDS)))).distinct()
    found = found.withColumn("h", F.xxhash64("t", "before", "after"))
    seeds = [(kind, t, before, after, i) for kind in KINDS for i, t in enumerate(SEEDS[kind])
             for before, after in (("", ""), ("We had it from ", " and more"), ("End. ", ", then"))]
    return materialize(found.unionByName(docs.sparkSession.createDataFrame(seeds, found.schema)), "pii-spans")


def _loose(kind: str, t: Column) -> list[Column]:
    """A span of `kind`, written in looser forms."""
    digits = _digits(t)
    if kind == "email":
        bracketed = F.regexp_replace(t, "@", " [at] ")
        return [F.regexp_replace(bracketed, r"\.(?=[^@\]]*$)", " [dot] "), F.regexp_replace(t, "@", " (at) "),
                F.regexp_replace(t, "@", "[at]")]
    if kind == "ip":
        return [F.regexp_replace(t, r"\.", "[.]"), F.regexp_replace(t, r"\.", " [dot] ")]
    if kind == "card":
        def shorter(n: int) -> Column:
            start = F.left(digits, F.lit(n - 1))
            last = F.filter(F.array(*(F.lit(str(d)) for d in range(10))), lambda d: _luhn(F.concat(start, d)))
            return F.concat(start, F.get(last, F.lit(0)))

        return [F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1."), F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1/"),
                shorter(15), shorter(13)]
    return [F.regexp_replace(t, r"^\+", "00"), F.regexp_replace(digits, "^[0-9]{2}([0-9]{2})([0-9]{3})", "(0$1) $2-")]


def _judged(rows: DataFrame) -> DataFrame:
    """(kind, label, held, the features): every span and its loose forms where they stand, and where they don't count."""
    t, before, after, h = (F.col(c) for c in ("t", "before", "after", "h"))
    reference = F.concat(before, F.lit(" "), F.get(F.array(*map(F.lit, _REFERENCE)), F.pmod(
        h, F.lit(len(_REFERENCE))).cast("int")), F.lit(" "))
    made = None
    for kind in KINDS:
        cases = []
        for form in [t, *_loose(kind, t)]:
            cases += [(form, before, after, 1), (form, reference, after, 0), (form, before, F.concat(F.lit("k"), after), 0),
                      (form, F.concat(before, F.lit("k")), after, 0)]
        if kind == "phone":
            digits, cued = _digits(t), F.concat(before, F.lit(" tel "))
            split = F.regexp_replace(digits, "^[0-9]([0-9]{3})([0-9]{3})", "$1-$2-")
            bare = [split, F.regexp_replace(split, "-", " "), digits, F.regexp_replace(digits, "^([0-9]{4})([0-9]{2})([0-9]{2})", "$1 $2 $3 ")]
            cases += [(form, b, after, label) for form in bare for b, label in (
                (cued, 1), (F.concat(cued, F.lit("order ")), 0), (F.lit("part of "), 0), (F.lit(""), 0), (F.lit("was in "), 0))]
        each = F.array(*(F.struct(f.alias("t"), F.right(b, F.lit(NEAR)).alias("before"), F.left(a, F.lit(4)).alias("after"),
                                  F.lit(label).alias("label")) for f, b, a, label in cases))
        one = rows.where(F.col("kind") == kind).select("kind", "h", F.inline(each)).where(
            wide_check(kind, F.col("t")) & ~((F.col("label") == 1) & F.col("before").rlike(_REFERENCES)))
        one = one.select("kind", "label", (F.pmod("h", F.lit(4)) == 0).alias("held"),
                         *_features(kind, F.col("t"), F.col("before"), F.col("after")))
        made = one if made is None else made.unionByName(one)
    return made


def _tree_case(node, column) -> Column:
    """One fitted tree as a CASE expression; `column(i)` is feature i."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(column(split.featureIndex()) <= float(split.threshold()), _tree_case(node.leftChild(), column)).otherwise(
        _tree_case(node.rightChild(), column))


class Model:
    """Fitted trees and a threshold per kind; without trees, nothing is ever added."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[str, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def score(self, features: Column) -> Column:
        column = lambda i: features[FEATURES[i]]
        margin = sum((_tree_case(tree.rootNode(), column) * w for tree, w in zip(self.trees, self.weights, strict=True)),
                     F.lit(0.0))
        return 1 / (1 + F.exp(margin * -2))


def fit(docs: DataFrame, text: str = "text") -> Model:
    """The model for a corpus. A quarter of the spans, by hash, is held out: the trees are fitted on at most
    FIT_SPANS of the others of each kind, the thresholds come from all that are held out."""
    spans = _spans(docs, text)
    some = None
    for kind in KINDS:
        part = spans.where((F.col("kind") == kind) & (F.pmod("h", F.lit(4)) != 0)).orderBy("h", "t", "before", "after")
        some = part.limit(FIT_SPANS) if some is None else some.unionByName(part.limit(FIT_SPANS))
    drawn = materialize(some, "pii-fit")
    made = materialize(_judged(drawn), "pii-features")
    train = made.coalesce(1).sortWithinPartitions("label", *FEATURES)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="v").transform(train).select("v", "label")
    gbt = GBTClassifier(featuresCol="v", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=7).fit(vectors)
    model = Model(list(gbt._java_obj.trees()), list(gbt.treeWeights), dict.fromkeys(KINDS, DEFAULT_THRESHOLD))
    held = _judged(spans.where(F.pmod("h", F.lit(4)) == 0))
    held = held.select("kind", "label", F.struct(*FEATURES).alias("f")).select("kind", "label", model.score(F.col("f")).alias("p"))
    at = F.explode(F.array(*map(F.lit, GRID)))
    table = (held.select("kind", "label", "p", at.alias("at")).where("p >= at").groupBy("kind", "at")
             .agg(F.avg("label").alias("precision")).where(F.col("precision") >= PRECISION)
             .groupBy("kind").agg(F.min("at").alias("at")).collect())
    model.thresholds.update({r["kind"]: r["at"] for r in table})
    for written in (spans, drawn, made):
        release(written)
    return model


def _bounds(spans: Column, end: str) -> Column:
    return F.transform(spans, lambda x: x[end])


def _before(values: Column, points: Column, equal: bool) -> Column:
    """For each of the ascending `points`, how many `values` are smaller (or `equal`), by one merge of both.

    A point's place in the merged order, less the number of points before it, is that count.
    """
    first, second = (0, 1) if equal else (1, 0)
    merged = F.sort_array(F.concat(F.transform(values, lambda v: v * 2 + first), F.transform(points, lambda q: q * 2 + second)))
    places = F.transform(merged, lambda v, j: F.when(v % 2 == second, j))
    return F.transform(F.filter(places, lambda j: j.isNotNull()), lambda j, i: j - i)


def _added(df: DataFrame, text: str, model: Model) -> DataFrame:
    """`df` with `added`: the selected proposals, as an array of (k, s, e)."""
    df = _matches(df, text, WIDE, "w", around=True)

    def unless_empty(kind: str, column: Column, empty: Column) -> Column:
        return F.when(F.size(f"w_{kind}") > 0, column).otherwise(empty)

    counts = F.array().cast("array<int>")
    df = _barrier(df, **{f"from_{k}": unless_empty(k, _before(_bounds(F.col("base"), "e"), _bounds(F.col(f"w_{k}"), "s"), True), counts)
                         for k in KINDS},
                  **{f"upto_{k}": unless_empty(k, _before(_bounds(F.col("base"), "s"), _bounds(F.col(f"w_{k}"), "e"), False), counts)
                     for k in KINDS})
    # As many base spans start before a free proposal's end as end before its start.
    df = _barrier(df, **{f"free_{k}": F.filter(F.filter(f"w_{k}", lambda x, i: F.get(f"from_{k}", i) == F.get(f"upto_{k}", i)),
                                               lambda x: wide_check(k, x["t"])) for k in KINDS})

    def featured(place: int, kind: str) -> Column:
        return F.transform(f"free_{kind}", lambda x: F.struct(
            F.lit(place).alias("k"), x["s"].alias("s"), x["e"].alias("e"),
            F.struct(*_features(kind, x["t"], x["before"], x["after"])).alias("f")))

    df = _barrier(df, featured=F.concat(*(featured(i, k) for i, k in enumerate(KINDS))))
    df = _barrier(df, scored=F.transform("featured", lambda x: F.struct(
        model.score(x["f"]).alias("p"), (x["e"] - x["s"]).alias("n"), (-x["s"]).alias("after"), x["k"].alias("k"),
        x["s"].alias("s"), x["e"].alias("e"))))
    df = _barrier(df, **{f"likely_{k}": F.filter("scored", lambda x: (x["k"] == i) & (x["p"] >= model.thresholds[k]))
                         for i, k in enumerate(KINDS)})
    pairs = [(a, b) for a in KINDS for b in KINDS if a != b]
    ranges = {}
    for a, b in pairs:
        mine, other = F.col(f"likely_{a}"), F.col(f"likely_{b}")
        both = (F.size(mine) > 0) & (F.size(other) > 0)
        ranges[f"lo_{a}_{b}"] = F.when(both, _before(_bounds(other, "e"), _bounds(mine, "s"), True))
        ranges[f"hi_{a}_{b}"] = F.when(both, _before(_bounds(other, "s"), _bounds(mine, "e"), False))
    df = _barrier(df, **ranges)

    def beaten(kind: str, x: Column, i: Column) -> Column:
        """Whether a better span of another kind overlaps x: those that do are neighbours in that kind's order."""
        found = F.lit(False)
        for a, b in pairs:
            if a == kind:
                lo, hi = F.get(f"lo_{a}_{b}", i), F.get(f"hi_{a}_{b}", i)
                found = found | F.coalesce(F.exists(F.slice(f"likely_{b}", lo + 1, hi - lo), lambda y: y > x), F.lit(False))
        return found

    best = F.concat(*(F.filter(f"likely_{k}", lambda x, i: ~beaten(k, x, i)) for k in KINDS))
    return df.withColumn("added", F.transform(best, lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"))))


def find(docs: DataFrame, text: str = "text", model: Model | None = None) -> DataFrame:
    """`docs` with `base` and `spans`: arrays of (k, s, e) by kind as listed, then start.

    `k` is the kind's place in KINDS; offsets are code points, ends exclusive. A null or empty text
    has no spans. Added spans overlap no base span; an added span goes if a better one overlaps it (a
    higher score, then the longer, then the earlier). Repeated rows are treated alike; an
    empty table gives no rows. All columns of `docs` stay, under their names; if one of them is
    called base or spans, the new column's name gets an underscore in front.
    """
    model = model or fit(docs, text)
    df = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                     F.coalesce(F.col(text), F.lit("")).alias("body"))
    df = _matches(df, "body", BASE, "b")
    df = _barrier(df, **{f"base_{k}": _check_all(F.col(f"b_{k}"), k, base_check) for k in KINDS})

    def listed(place: int, kind: str) -> Column:
        return F.transform(f"base_{kind}", lambda x: F.struct(F.lit(place).alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    df = _barrier(df, base=F.concat(*(listed(i, k) for i, k in enumerate(KINDS))))
    spans = F.col("base")
    if model.trees:
        df = _added(df, "body", model)
        spans = F.sort_array(F.concat("base", "added"))
    return df.select("row", F.col("base").alias("b"), spans.alias("s")).select(
        "row.*", F.col("b").alias(free_name(docs, "base")), F.col("s").alias(free_name(docs, "spans")))


def spelt(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def redact(docs: DataFrame, text: str = "text", model: Model | None = None) -> DataFrame:
    """`docs` with each span of `text` replaced by its kind in capitals and brackets; null text stays null."""
    spans = free_name(docs, "spans")
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def add(done: Column, x: Column) -> Column:
        inside = x["s"] < done["at"]
        gap = F.substr(F.col(text), (done["at"] + 1).cast("int"), (x["s"] - done["at"]).cast("int"))
        return F.struct(F.when(inside, done["out"]).otherwise(F.concat(done["out"], gap, F.get(names, x["k"]))).alias("out"),
                        F.greatest(done["at"], x["e"]).alias("at"))

    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    new = F.aggregate(ordered, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), add,
                      lambda done: F.concat(done["out"], F.substr(F.col(text), (done["at"] + 1).cast("int"))))
    new = F.when(F.col(text).isNotNull(), new)
    return find(docs, text, model).select(
        *(new.alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in docs.columns))
