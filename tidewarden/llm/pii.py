"""Personal data in texts: exact base patterns, and further spans that boosted trees choose among wide candidates.

Everything on the way is DataFrame operations. The base patterns are maximal runs that pass a check (Luhn, ranges,
numbers of digits). Wide generators propose overlapping candidates of each kind: other separators, spelt-out signs,
missing country codes. The trees see the format of a candidate and what stands around it, but none of the checks, and
learn on a bounded sample which candidates are personal data, the base spans being the examples. A threshold for each
kind, calibrated on candidates the trees have not seen, selects the spans to add.

Texts are read once. What the patterns match, with the lengths of the gaps between and a little of what stands around,
goes on as rows; places come from a running sum over a text's matches, overlaps from running extremes over its spans.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewarden.functions.plan import computed_once
from tidewarden.llm.frames import free_name, stored, whole_text

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Possessive repetitions and look-behinds name the maximal runs that the plain patterns find from
# left to right, but try each run once, however long it is.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\s?@\s?|\s?[\[(]\s?at\s?[\])]\s?|\sat\s)[A-Za-z0-9-]++"
    r"(?:(?:\.\s?|\s?[\[(]\s?dot\s?[\])]\s?|\sdot\s)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:\s?+[.,:_-]\s?+[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}+[0-9]){11,18}+(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:\+|00)?[(]?[0-9](?:[\x20().\/-]{0,2}+[0-9]){6,14}+(?![0-9])",
}
SIGNS = (
    r"(?i)mail|contact|kontakt|correo|courriel",
    r"(?i)\bip\b|host|server|addr",
    r"(?i)card|visa|credit|karte|carte|tarjeta",
    r"(?i)tel|phone|call|fax|mobil|num",
)
CUTS = tuple(c / 100 for c in (50, 60, 70, 80, 85, 90, 93, 95, 97, 99))
AROUND = 32
FOUND = "array<struct<pattern:int,at:int,gap:int,size:int,match:string,left:string,right:string>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    digits = F.split(F.reverse(_digits(text)), "")

    def share(digit: Column, place: Column) -> Column:
        value = digit.cast("int")
        doubled = value * 2
        return F.when(place % 2 == 0, value).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    total = F.aggregate(F.transform(F.filter(digits, lambda d: d != ""), share), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # Leading zeros do not change a number; three digits always fit an int.
        parts = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    n = F.length(_digits(text))
    if kind == "card":
        return n.between(14, 19) & _luhn(text)
    return n.between(10, 15)


def _matched(text: Column) -> dict[str, tuple[Column, int, str]]:
    """For each pattern: a column of all matches, the number of the pattern, the pattern. Base patterns come first."""
    patterns = [*[BASE[k] for k in KINDS], *[WIDE[k] for k in KINDS]]
    return {f"pattern_{i}": (F.regexp_extract_all(text, F.lit(p), F.lit(0)), i, p) for i, p in enumerate(patterns)}


def matches(docs: DataFrame) -> DataFrame:
    """(row, doc_id, draw, found) of (row, doc_id, text), a row for each row.

    `found` has one element for each match: the number of its pattern, its place among the pattern's matches, the
    length of the gap before it and its own, the match, and what stands left and right of it.
    """
    text = F.col("text")
    sets = _matched(text)
    slim = docs.select("row", "doc_id", whole_text(text).alias("text"))
    read = computed_once(slim, {name: found for name, (found, _, _) in sets.items()})

    def located(name: str, number: int, pattern: str) -> Column:
        gaps = F.split(text, pattern, -1)
        after = F.slice(gaps, 2, F.size(name))
        lists = F.arrays_zip(F.col(name).alias("match"), F.slice(gaps, 1, F.size(name)).alias("gap"), after.alias("next"))
        shaped = F.transform(
            lists,
            lambda x, i: F.struct(
                F.lit(number).alias("pattern"),
                i.alias("at"),
                F.length(x["gap"]).alias("gap"),
                F.length(x["match"]).alias("size"),
                x["match"].alias("match"),
                F.right(x["gap"], F.lit(AROUND)).alias("left"),
                F.left(x["next"], F.lit(AROUND)).alias("right"),
            ),
        )
        # Most texts have no match: they are not split.
        return F.when(F.size(name) > 0, shaped).otherwise(F.array().cast(FOUND))

    every = F.concat(*[located(name, number, pattern) for name, (_, number, pattern) in sets.items()])
    return read.select("row", "doc_id", F.xxhash64("doc_id", "text").alias("draw"), every.alias("found"))


def spans(found: DataFrame) -> DataFrame:
    """(row, draw, wide, kind, at, start, end, match, left, right): valid base spans and all wide candidates.

    `kind` is the place in KINDS; start and end count code points from 0, the end exclusive.
    """
    rows = found.select("row", "draw", F.inline("found"))
    upto = Window.partitionBy("row", "pattern").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
    kind = F.col("pattern") % len(KINDS)
    valid = F.lit(False)
    for i, name in enumerate(KINDS):
        valid = valid | ((kind == i) & _valid(name, F.col("match")))
    wide = F.col("pattern") >= len(KINDS)
    return placed.filter(wide | valid).select(
        "row", "draw", wide.alias("wide"), kind.alias("kind"), "at",
        (F.col("end") - F.col("size")).alias("start"), "end", "match", "left", "right",
    )


def with_overlap(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add whether a row overlaps a base span of the same keys: one that begins no later, or one that begins inside."""
    base_end = F.when(~F.col("wide"), F.col("end"))
    base_start = F.when(~F.col("wide"), F.col("start"))
    ahead = Window.partitionBy(*keys).orderBy("start", "wide").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy(*keys).orderBy(F.col("start").desc(), "wide").rowsBetween(Window.unboundedPreceding, 0)
    before = F.coalesce(F.max(base_end).over(ahead) > F.col("start"), F.lit(False))
    after = F.coalesce(F.min(base_start).over(back) < F.col("end"), F.lit(False))
    return rows.withColumn(name, before | after)


def features() -> dict[str, Column]:
    """What the trees see of a candidate: its format, and what stands around it."""
    match, left, right, kind = F.col("match"), F.col("left"), F.col("right"), F.col("kind")

    def sort_of(char: Column) -> Column:
        kinds = F.when(char == "", 0).when(char.rlike(r"\s"), 1).when(char.rlike(r"\p{L}"), 2).when(char.rlike("[0-9]"), 3)
        return kinds.otherwise(4)

    groups = F.filter(F.split(match, "[^0-9]+"), lambda g: g != "")
    sizes = F.transform(groups, F.length)
    values = {
        **{f"is_{k}": kind == i for i, k in enumerate(KINDS)},
        "length": F.length(match),
        "digits": F.length(_digits(match)),
        "letters": F.length(F.regexp_replace(match, r"[^\p{L}]", "")),
        "blanks": F.length(F.regexp_replace(match, r"[^\x20]", "")),
        "dots": F.length(F.regexp_replace(match, r"[^.]", "")),
        "dashes": F.length(F.regexp_replace(match, r"[^-]", "")),
        "has_at": match.contains("@"),
        "has_plus": match.startswith("+"),
        "has_bracket": match.contains("("),
        "groups": F.size(groups),
        "longest_group": F.coalesce(F.array_max(sizes), F.lit(0)),
        "shortest_group": F.coalesce(F.array_min(sizes), F.lit(0)),
        "distinct_digits": F.size(F.array_distinct(F.split(_digits(match), ""))),
        "before": sort_of(F.right(left, F.lit(1))),
        "after": sort_of(F.left(right, F.lit(1))),
        "digits_around": F.length(_digits(left)) + F.length(_digits(right)),
        **{f"sign_{k}": left.rlike(sign) for k, sign in zip(KINDS, SIGNS, strict=True)},
    }
    return {f"f_{name}": value.cast("double") for name, value in values.items()}


def _described(candidates: DataFrame) -> DataFrame:
    """The candidates with their features as a vector."""
    columns = features()
    return VectorAssembler(inputCols=list(columns), outputCol="vector").transform(candidates.withColumns(columns)).drop(*columns)


@dataclass
class Chooser:
    """The boosted trees, or none where nothing could be learnt, and the threshold of each kind."""

    model: GBTClassificationModel | None
    thresholds: dict[int, float] = field(default_factory=dict)

    def probabilities(self, candidates: DataFrame) -> DataFrame:
        """The candidates with `p`."""
        judged = self.model.transform(_described(candidates))
        return judged.withColumn("p", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "prediction")


def fit(found: DataFrame, sample_docs: int = 4000, most_rows: int = 20_000, precision: float = 0.95, rounds: int = 12) -> Chooser:
    """Boosted trees from the candidates of about `sample_docs` texts, drawn by a digest, `most_rows` candidates at most.

    Every fourth of them is held back. A kind's threshold is the lowest cut with at least `precision` among all wide
    candidates of the corpus that the trees were not fitted to. A kind without such a cut, or with fewer than ten of
    these candidates at each, gets none and adds nothing.
    """
    n = found.count()
    spread = F.pmod(F.xxhash64(F.lit("pii"), F.col("draw")), F.lit(1 << 30)) / float(1 << 30)
    in_sample = spread < min(1.0, sample_docs / max(n, 1))

    def wide(texts: DataFrame) -> DataFrame:
        rows = with_overlap(spans(texts), ["row", "kind"], "is_base").filter("wide")
        return rows.withColumn("order", F.xxhash64("draw", "kind", "at")).withColumn("label", F.col("is_base").cast("double"))

    sample = stored(wide(found.filter(in_sample)).orderBy("order", "row").limit(most_rows), "pii-sample")
    held = F.pmod("order", F.lit(4)) == 0
    labels = {r.label: r["count"] for r in sample.filter(~held).groupBy("label").count().collect()}
    if len(labels) < 2:
        return Chooser(None)
    # No leaf for a handful of rows: a rare format follows the formats most like it.
    learner = GBTClassifier(
        featuresCol="vector", labelCol="label", maxIter=rounds, maxDepth=3, maxBins=32, minInstancesPerNode=20, seed=7
    )
    chooser = Chooser(learner.fit(_described(sample.filter(~held)).select("label", "vector")))
    last = sample.agg(F.max("order")).first()[0]
    new = wide(found.filter(F.size("found") > 0)).filter(~in_sample | held | (F.col("order") > last))
    judged = chooser.probabilities(new).groupBy("kind").agg(
        *[F.count_if(F.col("p") >= c).alias(f"n{i}") for i, c in enumerate(CUTS)],
        *[F.count_if((F.col("p") >= c) & (F.col("label") == 1)).alias(f"hit{i}") for i, c in enumerate(CUTS)],
    )
    for row in judged.collect():
        good = [c for i, c in enumerate(CUTS) if row[f"n{i}"] >= 10 and row[f"hit{i}"] >= precision * row[f"n{i}"]]
        if good:
            chooser.thresholds[row.kind] = good[0]
    return chooser


def find(docs: DataFrame, sample_docs: int = 4000) -> DataFrame:
    """(row, doc_id, base_spans, added_spans) of (row, doc_id, text): arrays of (start, kind, end), in this order.

    Base spans are all kept. A candidate is added if its probability reaches the threshold of its kind and it overlaps
    no base span of any kind; candidates that overlap each other are all added.
    """
    found = stored(matches(docs), "pii-matches")
    chooser = fit(found, sample_docs)
    rows = spans(found.filter(F.size("found") > 0))
    kept = rows.filter(~F.col("wide")).select("row", "start", "kind", "end", F.lit(False).alias("added"))
    if chooser.model is not None and chooser.thresholds:
        free = with_overlap(rows, ["row"], "covered").filter("wide and not covered")
        cut = F.lit(2.0)
        for kind, value in chooser.thresholds.items():
            cut = F.when(F.col("kind") == kind, F.lit(value)).otherwise(cut)
        chosen = chooser.probabilities(free).filter(F.col("p") >= cut)
        kept = kept.unionByName(chosen.select("row", "start", "kind", "end", F.lit(True).alias("added")))
    span = F.struct("start", "kind", "end")
    lists = kept.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(~F.col("added"), span))).alias("base_spans"),
        F.array_sort(F.collect_list(F.when(F.col("added"), span))).alias("added_spans"),
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return found.select("row", "doc_id").join(lists, "row", "left").select(
        "row", "doc_id", *[F.coalesce(c, none).alias(c) for c in ("base_spans", "added_spans")]
    )


def _joined(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(found, one), ",")


def personal_data(docs: DataFrame, sample_docs: int = 4000) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for each row.

    Counts and digest are of the base spans; `spans` lists these and the added ones as kind:start:end, by start and
    kind, in code points with the end exclusive. A null text counts as empty and has no span; repeated rows get equal
    results; without examples of both sorts nothing is added; an empty table gives an empty result. Other columns are
    not read.
    """
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )

    def number(place: int) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == place)).cast("long")

    return find(numbered, sample_docs).select(
        "doc_id",
        *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base_spans", "added_spans"))).alias("spans"),
        F.size("added_spans").cast("long").alias("n_added"),
    )


def redacted(docs: DataFrame, sample_docs: int = 4000) -> DataFrame:
    """The rows and columns of `docs`, each span of `text` replaced by its kind in angle brackets.

    Overlapping spans become one, named after the first. A null text stays null.
    """
    row, spans_name = free_name(docs, "pii_row"), free_name(docs, "pii_spans")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "pii-documents")
    found = find(numbered.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), sample_docs)
    found = found.select(F.col("row").alias(row), F.array_sort(F.concat("base_spans", "added_spans")).alias(spans_name))
    text, names = F.col("text"), F.array(*[F.lit(f"<{k}>") for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        upto, start, end = acc["upto"], s["start"].cast("int"), s["end"].cast("int")
        piece = F.concat(F.substring(text, upto + 1, F.greatest(start - upto, F.lit(0))), F.element_at(names, s["kind"] + 1))
        return F.struct(F.greatest(upto, end).alias("upto"), F.when(start >= upto, F.concat(acc["text"], piece)).otherwise(acc["text"]).alias("text"))

    start = F.struct(F.lit(0).alias("upto"), F.lit("").alias("text"))
    whole = F.aggregate(spans_name, start, step, lambda acc: F.concat(acc["text"], F.substring(text, acc["upto"] + 1, F.length(text))))
    return numbered.join(found, row).withColumn("text", F.when(text.isNotNull(), whole)).select(*docs.columns)
