"""Credentials by linking their parts, with DataFrame functions alone.

Strict patterns give the base spans, which always stay: assignments, access
identifiers and hexadecimal strings. Weak patterns propose further identifiers,
secrets and endpoints. An interval join within each document asks which roles occur
within `reach` characters of a candidate; a weak one is reported only when the parts
that complement it are there: a secret for an identifier, an identifier for a secret,
both for an endpoint. The join is a sweep over the spans sorted by position, so no
pair is ever formed, however many spans stand together.

Defined cases: a null text counts as empty. Rows with equal or null ids are kept as
rows of their own. Weak spans that overlap a base span are dropped. An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import text_of
from cohortloom.llm.spans import ROW, found, joined, running, uncovered, with_row

# The kinds, the role each plays, and what complements a role.
BASE = ("assign", "access", "hex")
WEAK = ("identifier", "secret", "endpoint")
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret"} | {k: k for k in WEAK}
COMPLEMENTS = {"identifier": ("secret",), "secret": ("identifier",), "endpoint": ("identifier", "secret")}

_ASSIGNED = r"""["']?+ *+[:=] *+["']?+"""
# The strict patterns. Possessive repeats never give characters back, which
# these patterns do not need.
STRICT = {
    "assign": rf"(?i:password|passwd|secret|token|api_?key){_ASSIGNED}[A-Za-z0-9+/_.=-]++",
    "access": r"AKIA[A-Z0-9]++",
    "hex": r"(?<![0-9a-f])[0-9a-f]{16,}+",
}
LOOSE = {
    "identifier": rf"(?i:\b(?:access[_-]?key[_-]?id|access[_-]?id|client[_-]?id|account[_-]?id|username|user|login)){_ASSIGNED}[A-Za-z0-9@._/+-]{{3,}}+",
    "secret": rf"(?i:\b(?:pwd|pass|passphrase|private[_-]?key|credential)){_ASSIGNED}[^\s\"']{{6,}}+"
    r"|(?<![A-Za-z0-9+/_-])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+={0,2}+",
    "endpoint": r"\b[a-z][a-z0-9+.-]{1,12}://[^\s\"'<>]++"
    rf"|(?i:\b(?:host|hostname|endpoint|server|url)){_ASSIGNED}[A-Za-z0-9._:/-]{{4,}}+",
}


def _patterns() -> dict[str, tuple[str, Column]]:
    text = F.col("_text")
    assigned = text.contains(":") | text.contains("=")
    tests = {
        "assign": assigned & text.rlike("(?i:password|passwd|secret|token|api_?key)"),
        "access": text.contains("AKIA"),
        "hex": text.rlike("[0-9a-f]{16}"),
        "identifier": assigned & text.rlike("(?i:[_-]?id|user|login)"),
        "secret": (assigned & text.rlike("(?i:pwd|pass|key|credential)")) | text.rlike("[A-Za-z0-9+/_-]{20}"),
        "endpoint": assigned & text.rlike("(?i:://|host|endpoint|server|url)"),
    }
    return {kind: (pattern, tests[kind]) for kind, pattern in (STRICT | LOOSE).items()}


def strict(kind: Column, value: Column) -> Column:
    """Whether a match of a strict pattern is also long enough."""
    group = F.regexp_replace(value, rf"^(?i:password|passwd|secret|token|api_?key){_ASSIGNED}", "")
    return (
        F.when(kind == "assign", F.length(group) >= 12)
        .when(kind == "access", F.length(value) >= 18)
        .when(kind == "hex", True)
        .otherwise(False)
    )


def near(role: str, reach: int) -> Column:
    """Whether a span of the role lies within `reach` characters of this row's, in its document."""
    of_role = F.col("role") == role
    behind = running(F.when(of_role, F.col("end")), ROW, F.col("start"))
    ahead = -running(F.when(of_role, -F.col("start")), ROW, F.col("start").desc())
    return F.coalesce(behind >= F.col("start") - reach, F.lit(False)) | F.coalesce(
        ahead <= F.col("end") + reach, F.lit(False)
    )


def detect(docs: DataFrame, reach: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, id, kind, start, end, value, base, chosen); null kind for documents without candidates."""
    rows = with_row(docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("_whole")))
    spans = found(rows, F.col("_whole"), _patterns()).drop("_whole", "left", "right")
    spans = spans.withColumn("base", F.col("kind").isin(*BASE) & strict(F.col("kind"), F.col("value")))
    spans = spans.withColumn("clear", uncovered(F.col("base")))
    # A part that counts: a base span, or a weak one clear of them.
    counts = F.col("base") | (F.col("clear") & F.col("kind").isin(*WEAK))
    role = F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])[F.col("kind")]
    spans = spans.withColumn("role", F.when(counts, role))
    spans = spans.withColumns({f"near_{r}": near(r, reach) for r in ("identifier", "secret")})
    linked = F.lit(False)
    for kind, others in COMPLEMENTS.items():
        complete = F.lit(True)
        for other in others:
            complete = complete & F.col(f"near_{other}")
        linked = linked | ((F.col("kind") == kind) & complete)
    chosen = F.coalesce(F.col("base") | (F.col("role").isNotNull() & linked), F.lit(False))
    return spans.select(ROW, "id", "kind", "start", "end", "value", "base", chosen.alias("chosen"))


def digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: counts and positions of its base spans, and the positions of all reported spans."""
    rank = F.array_position(F.array(*[F.lit(k) for k in (*BASE, *WEAK)]), F.col("kind"))
    entry = F.struct("start", rank.alias("rank"), "end", "kind")
    by_row = spans.groupBy(ROW, "id").agg(
        *[F.count_if(F.coalesce("base", F.lit(False)) & (F.col("kind") == k)).alias(f"n_{k}") for k in BASE],
        F.array_sort(F.collect_set(F.when(F.col("base"), entry))).alias("_base"),
        F.array_sort(F.collect_set(F.when(F.col("chosen"), entry))).alias("_all"),
    )
    return by_row.select(
        F.col("id").alias(id_col),
        *[f"n_{k}" for k in BASE],
        F.sha2(joined(F.col("_base")), 256).alias("base_sha256"),
        joined(F.col("_all")).alias("spans"),
    )
