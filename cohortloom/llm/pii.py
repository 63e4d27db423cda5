"""Personal data by candidate generation and boosted trees, with DataFrame and Spark ML functions alone.

Strict patterns give the base spans, which always stay. Loose generators propose
further, overlapping candidates: split or disguised addresses, numbers without a
plus sign, cards with other separators, hexadecimal host addresses. Boosted trees
score every candidate from its format and its surroundings; a threshold per kind,
calibrated on candidates the trees did not see, selects the additions.

The trees learn from the corpus itself: a candidate whose value, once its disguise is
undone and its separators are plain, meets the strict rule of its kind is an example,
one that breaks it a counter-example. Candidates that overlap a base span teach
nothing besides the span itself. The trees see shape, checksum and context, but not
the marks by which strict patterns know a kind. They fit on every distinct candidate
of three folds, and the thresholds count every one of the fourth.

Defined cases: a null text counts as empty. Rows with equal or null ids are kept as
rows of their own. Additions that overlap a base span are dropped. Without both
examples and counter-examples there is no model, and only base spans remain. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import flagged, stored, text_of
from cohortloom.llm.spans import ROW, found, joined, uncovered, with_row

KINDS = ("email", "ip", "card", "phone")
FOLDS = 4
MIN_PRECISION = 0.98
MIN_ACCEPTED = 20
MIN_SCORE = 0.5  # where a kind has no counter-examples among the held-out candidates, any score would do

# The strict patterns. Possessive repeats never give characters back, which
# these patterns do not need, and \G lets a match begin where the last one ended.
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}|(?<![0-9.])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}",
    "card": r"(?<![0-9])[0-9]{4}(?:[ ._/-]{1,2}[0-9]{4}){2,3}(?![0-9])|(?<![0-9])[0-9]{12,19}(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{2,4}\)?[ .-]{1,2}[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
}
# Words that stand near personal data.
CUES = {
    "email": "e-?mail|mail|contact|write",
    "ip": "host|address|server|ip",
    "card": "card|visa|credit|payment|account",
    "phone": "phone|tel|call|fax|mobile",
}
FEATURES = (
    "kind", "length", "digits", "letters", "separators", "groups", "first_group", "last_group", "dots",
    "checksum", "largest_part", "parenthesis", "spaced", "left_kind", "right_kind", "cue", "digit_context",
)


def _patterns() -> dict[str, tuple[str, Column]]:
    text = F.col("_text")
    tests = {
        "email": text.contains("@"),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike("[0-9]"),
        "phone": text.contains("+"),
    }
    loose = {
        "email": text.rlike(r"@| at |\(at\)|\[at\]"),
        "ip": text.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]|\[\.\]"),
        "card": text.rlike("[0-9]{4}"),
        "phone": text.rlike("[0-9]{3}[ .-][0-9]{3}"),
    }
    return {k: (STRICT[k], tests[k]) for k in KINDS} | {f"{k}~": (LOOSE[k], loose[k]) for k in KINDS}


def valid(kind: Column, value: Column) -> Column:
    """Whether a strict match also passes the check of its kind."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    size = F.length(digits)
    parts = F.transform(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", F.forall(parts, lambda p: p))
        .when(kind == "card", size.between(13, 19) & F.call_function("luhn_check", digits))
        .when(kind == "phone", size.between(9, 15))
        .otherwise(False)
    )


def genuine(kind: Column, value: Column, left: Column, right: Column) -> Column:
    """Whether a candidate of any generator meets the strict check of its kind once it is written plainly."""
    plain = F.regexp_replace(value, r" ?(?:\(dot\)|\[dot\]) ?| dot ", ".")
    plain = F.regexp_replace(plain, r" ?(?:@|\(at\)|\[at\]) ?", "@")
    # The mere word is prose ("at noon. Then") unless no full stop is written as a sign.
    worded = ~F.regexp_replace(value, r"^.* at ", "").contains(".")
    plain = F.when(worded, F.regexp_replace(plain, " at ", "@")).otherwise(plain)
    address = F.regexp_replace(value, r"\[\.\]", ".")
    digits = F.regexp_replace(value, "[^0-9]", "")
    # Part of a longer number is no number of its own.
    whole = ~left.rlike("[0-9][ ._/-]?$") & ~right.rlike("^[ ._/-]?[0-9]")
    return F.coalesce(
        F.when(kind == "email", plain.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$"))
        .when(kind == "ip", F.when(value.contains(":"), F.size(F.split(value, ":")) == 8).otherwise(valid(kind, address)))
        .when(kind == "card", whole & valid(kind, digits))
        .when(kind == "phone", whole & valid(kind, digits)),
        F.lit(False),
    )


def candidates(rows: DataFrame) -> DataFrame:
    """Every candidate of every document, stored: (other columns, kind, start, end, value, base, clear, left, right).

    `rows` has _row and `text` besides columns to keep; a document without candidates
    has one row with a null kind. `clear`: no base span overlaps.
    """
    keep = [c for c in rows.columns if c != "text"]
    matches = found(rows.select(*keep, F.col("text").alias("_t")), F.col("_t"), _patterns()).drop("_t")
    loose = F.col("kind").endswith("~")
    kind = F.regexp_replace("kind", "~", "")
    spans = matches.withColumn("loose", loose).withColumn("kind", kind)
    spans = spans.withColumn("base", ~F.col("loose") & valid(F.col("kind"), F.col("value")))
    # Rows of one document stay together: no further exchange.
    return spans.select(
        *keep,
        "kind",
        "start",
        "end",
        "value",
        "left",
        "right",
        "base",
        uncovered(F.col("base")).alias("clear"),
    )


def _shape(c: Column) -> Column:
    last = F.coalesce(c, F.lit(""))
    return (
        F.when(last == "", 0)
        .when(last.rlike(r"^\s$"), 1)
        .when(last.rlike("^[0-9]$"), 2)
        .when(last.rlike("^[A-Za-z]$"), 3)
        .when(last.rlike("""^["'=:]$"""), 4)
        .otherwise(5)
    )


def features(spans: DataFrame) -> DataFrame:
    """Numbers on a candidate's format and context, in columns named as FEATURES, prefixed f_."""
    v, left, right = F.col("value"), F.col("left"), F.col("right")
    digits = F.regexp_replace(v, "[^0-9]", "")
    groups = F.expr("regexp_extract_all(value, '[0-9]+', 0)")
    kind = F.col("kind")
    cue = F.lit(False)
    for name, words in CUES.items():
        cue = F.when(kind == name, F.lower(left).rlike(rf"\b(?:{words})\b")).otherwise(cue)
    values = {
        "kind": F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind),
        "length": F.length(v),
        "digits": F.length(digits),
        "letters": F.length(F.regexp_replace(v, "[^A-Za-z]", "")),
        "separators": F.length(F.regexp_replace(v, "[A-Za-z0-9]", "")),
        "groups": F.size(groups),
        "first_group": F.length(F.get(groups, F.lit(0))),
        "last_group": F.length(F.get(groups, F.size(groups) - 1)),
        "dots": F.length(F.regexp_replace(v, r"[^.]", "")),
        "checksum": F.call_function("luhn_check", digits).cast("int"),
        "largest_part": F.least(F.array_max(F.transform(groups, lambda g: F.coalesce(g.try_cast("int"), F.lit(9999)))), F.lit(9999)),
        "parenthesis": v.contains("("),
        "spaced": v.contains(" "),
        "left_kind": _shape(F.substring(left, -1, 1)),
        "right_kind": _shape(F.substring(right, 1, 1)),
        "cue": cue,
        "digit_context": F.length(F.regexp_replace(F.concat(left, right), "[^0-9]", "")),
    }
    return spans.withColumns({f"f_{n}": F.coalesce(c.cast("double"), F.lit(0.0)) for n, c in values.items()})


class Booster:
    """Boosted trees with a threshold per kind; `model` is None when there was nothing to learn from."""

    def __init__(self, spans: DataFrame, seed: int = 7) -> None:
        right = F.col("base") | genuine(F.col("kind"), F.col("value"), F.col("left"), F.col("right"))
        shown = spans.filter("kind is not null and (base or clear)").withColumn("right_one", right)
        # Distinct candidates only, else one copied text would outweigh the others.
        pool = shown.groupBy("kind", "value", "left", "right").agg(F.max("right_one").cast("double").alias("label"))
        part = F.pmod(F.xxhash64("value", F.lit(seed + 1)), F.lit(FOLDS))
        # A fixed order of the rows, as Spark ML places its split points by rows that it draws.
        known = features(pool.withColumn("_fold", part)).sortWithinPartitions("value", "left", "right", "kind")
        known = stored(known, "pii-known")
        fit_on, held = known.filter("_fold > 0"), known.filter("_fold = 0")
        classes = {row.label for row in fit_on.select("label").distinct().limit(3).collect()}
        self.model, self.thresholds = None, {}
        if len(classes) == 2:
            assemble = VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="_features")
            trees = GBTClassifier(
                featuresCol="_features", labelCol="label", maxIter=12, maxDepth=4, stepSize=0.3, seed=seed
            )
            self.model = Pipeline(stages=[assemble, trees]).fit(fit_on)
            self.thresholds = self._calibrate(held)

    def _calibrate(self, held: DataFrame) -> dict[str, float]:
        """For each kind the lowest score above which the held-out candidates, all of them, are right often enough."""
        bins = self._scored(held).groupBy("kind", F.floor(F.col("_score") * 100).alias("bin"))
        counted = bins.agg(F.sum("label").alias("right"), F.count("*").alias("n"))
        above = Window.partitionBy("kind").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
        good = counted.select("kind", "bin", F.sum("right").over(above).alias("right"), F.sum("n").over(above).alias("n"))
        kept = good.filter(f"n >= {MIN_ACCEPTED} and right >= {MIN_PRECISION} * n").groupBy("kind").agg(F.min("bin").alias("bin"))
        return {row.kind: max(row.bin / 100, MIN_SCORE) for row in kept.collect()}  # a row a kind

    def _scored(self, featured: DataFrame) -> DataFrame:
        scored = self.model.transform(featured).withColumn("_score", vector_to_array("probability")[1])
        return scored.drop("_features", "rawPrediction", "probability", "prediction")

    def select(self, spans: DataFrame) -> DataFrame:
        """The rows with `chosen`: base spans, and clear candidates above their kind's threshold."""
        if self.model is None or not self.thresholds:
            return spans.withColumn("score", F.lit(None).cast("double")).withColumn("chosen", F.coalesce("base", F.lit(False)))
        threshold = F.create_map(*[F.lit(x) for pair in self.thresholds.items() for x in pair])[F.col("kind")]
        scored = self._scored(features(spans)).withColumnRenamed("_score", "score")
        chosen = F.col("base") | (F.col("clear") & F.coalesce(F.col("score") >= threshold, F.lit(False)))
        return scored.select(*spans.columns, "score", F.coalesce(chosen, F.lit(False)).alias("chosen"))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, id, kind, start, end, value, base, score) of every chosen span; null kind for documents without candidates."""
    rows = with_row(docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")))
    spans = stored(candidates(rows), "pii-candidates")
    return Booster(spans).select(spans)


def digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: counts and positions of its base spans, and the positions of all its spans."""
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    entry = F.struct(rank.alias("rank"), "start", "end", "kind")
    by_row = spans.groupBy(ROW, "id").agg(
        *[F.count_if(F.coalesce("base", F.lit(False)) & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
        F.array_sort(F.collect_set(F.when(F.col("base"), entry))).alias("_base"),
        F.array_sort(F.collect_set(F.when(F.col("chosen"), entry))).alias("_all"),
    )
    return by_row.select(
        F.col("id").alias(id_col),
        *[f"n_{k}" for k in KINDS],
        F.sha2(joined(F.col("_base")), 256).alias("base_sha256"),
        joined(F.col("_all")).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with every chosen span replaced by its kind in brackets; other columns as they were."""
    boxed = docs.select(F.struct("*").alias("doc"))
    rows = stored(with_row(boxed), "pii-documents")
    spans = stored(candidates(rows.select(ROW, text_of(f"doc.{text_col}").alias("text"))), "pii-candidates")
    chosen = Booster(spans).select(spans).filter("chosen").select(ROW, "kind", "start", "end")
    before = Window.partitionBy(ROW).orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    # What an earlier span covers is cut off a later one.
    apart = chosen.withColumn("start", F.greatest("start", reached)).filter("start < end")
    edits = stored(apart.groupBy(ROW).agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("edits")), "pii-edits")
    # Texts without an edit, which is most, stay where they are; the join decides on the others.
    told = flagged(rows.withColumn("key", F.xxhash64(ROW)), edits.select(F.xxhash64(ROW).alias("wanted")), "_edited")
    # Characters as an array: cutting pieces out of it takes time in proportion to the text, however many there are.
    edited = told.filter("_edited").join(edits, ROW, "left").withColumn("chars", F.split(f"doc.{text_col}", ""))
    pieces = F.expr("""
        transform(edits, (e, i) -> concat(
            array_join(slice(chars, int(if(i = 0, 0L, edits[i - 1].end)) + 1, int(e.start - if(i = 0, 0L, edits[i - 1].end))), ''),
            '[', upper(e.kind), ']'))
    """)
    tail = F.expr("array_join(slice(chars, int(element_at(edits, -1).end) + 1, size(chars)), '')")
    text = F.concat(F.array_join(pieces, ""), tail)
    changed = edited.select(F.when(F.col("edits").isNull(), F.col("doc")).otherwise(F.col("doc").withField(text_col, text)).alias("doc"))
    same = told.filter("not _edited").select("doc")
    return changed.unionByName(same).select("doc.*")
