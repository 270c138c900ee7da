"""Personal data: checked patterns, and further spans chosen by boosted trees.

Four base kinds are found by their patterns and checks: e-mail and IP addresses, card numbers (12 to 19 digits that pass
Luhn's check) and phone numbers (9 to 15 digits). Generators of high recall propose further spans, which may overlap: addresses
written with " at " and " dot ", numbers in groups without a country code, long runs of digits, and secrets such as keys
and tokens. Gradient-boosted trees (Spark ML) judge them by format (length, shares of character classes, separators) and
context (words before, characters around). They learn, on two thirds of the candidates of the same documents, what the
checks say of the candidates that the checks can judge: base spans, and secrets that are assigned to a name. Scores are
calibrated in steps on the other third, and per kind the lowest threshold of the precision asked for selects
the spans. Of overlapping ones the better stays, and none overlaps a base span.

Everything runs as DataFrame functions and Spark ML. Texts are read once; candidates are stored, without texts.
Null and empty texts have no spans. Null ids and repeated rows are judged like any other; rows are told apart by a number
that is stored with them. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import stored, table

KINDS = ["email", "ip", "card", "phone", "secret"]
# The base patterns, written so that a text of one long run costs one pass: \G or no run character before, no backtracking.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# only runs of 12 to 19 digits can pass: each whole run of digits is one match of the contract's pattern
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PROPOSED = {  # proposals beside the base spans, by kind
    "email": r"(?i)(?<![a-z0-9])(?<![a-z0-9][._+-])[a-z0-9][a-z0-9._+-]*+ ?(?:@|[\[(] ?at ?[\])]| at ) ?[a-z0-9-]++(?: ?(?:\.|[\[(] ?dot ?[\])]| dot ) ?[a-z0-9-]{2,}+){1,4}",
    "card": r"(?<![0-9])[0-9]{4}(?:[ .-]?[0-9]{4}){2}[ .-]?[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9])(?:\([0-9]{2,4}\) ?|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{24,}+",
}
FEATURES = ["kind", "length", "digits", "letters", "upper", "hexes", "separators", "groups", "distinct", "word", "assigned_sign", "quoted", "glued", "bracketed", "sign", "spelled_dot"]
_SPAN = "array<struct<kind: int, start: int, stop: int, value: string, before: string, after: string>>"


def _spans(text: Column, pattern: str, kind: int, check=None) -> Column:
    """All matches of a pattern that pass the check, with offsets from the lengths of matches and of what lies between.

    The work grows with the square of a text's matches, so the patterns match little that cannot pass.
    """
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def placed(pair: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, stop: int, value: string>>").alias("out"))

        def step(a: Column, i: Column) -> Column:
            value = F.get(pair["found"], i)
            first = a["at"] + F.length(F.get(pair["gaps"], i))
            stop = first + F.length(value)
            return F.struct(stop.alias("at"), F.concat(a["out"], F.array(F.struct(first.alias("start"), stop.alias("stop"), value.alias("value")))).alias("out"))

        steps = F.sequence(F.lit(0), F.size(pair["found"]) - 1)
        return F.when(F.size(pair["found"]) > 0, F.aggregate(steps, start, step, lambda a: a["out"]))

    spans = F.transform(F.array(F.struct(found.alias("found"), gaps.alias("gaps"))), placed)[0]
    if check:
        spans = F.filter(spans, lambda s: check(s["value"]))
    full = F.transform(spans, lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value"),
        F.substring(text, F.greatest(s["start"] - 23, F.lit(1)), F.least(s["start"], F.lit(24))).alias("before"), F.substring(text, s["stop"] + 1, F.lit(2)).alias("after"),
    ))
    return F.coalesce(F.when(text.rlike(pattern), full), F.array().cast(_SPAN))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """12 to 19 digits whose check digit is right."""
    digit = F.transform(F.split(F.reverse(_digits(value)), ""), lambda c, i: F.struct(c.try_cast("int").alias("d"), i.alias("i")))
    each = F.transform(digit, lambda x: F.when(x["i"] % 2 == 0, x["d"]).when(x["d"] > 4, 2 * x["d"] - 9).otherwise(2 * x["d"]))
    total = F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)))
    return F.length(_digits(value)).between(12, 19) & (total % 10 == 0)


def _octets(value: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
    return value.rlike(rf"^{part}(?:\.{part}){{3}}$")


BASE = [(EMAIL, None), (IP, _octets), (CARD, luhn), (PHONE, lambda v: F.length(_digits(v)).between(9, 15))]


def found_spans(docs: DataFrame, *more: str) -> DataFrame:
    """rid, doc_id, ``more``, the base spans and the proposed ones of each whole text, stored without the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.concat(*(_spans(text, pattern, kind, check) for kind, (pattern, check) in enumerate(BASE)))
    proposed = F.concat(*(_spans(text, pattern, KINDS.index(kind)) for kind, pattern in PROPOSED.items()))
    rows = docs.select("doc_id", *more, base.alias("base"), proposed.alias("proposed"))
    return stored(rows.withColumn("rid", F.monotonically_increasing_id()), "spans")


def candidates(spans: DataFrame) -> DataFrame:
    """rid, kind, start, stop, the features, and label: 1 or 0 as the checks say, null where they say nothing.

    Base spans are positive examples, as are card numbers in other writing that pass Luhn's check and secrets that are assigned to a
    name. Card-like numbers that fail the check are negative ones, as are other secrets, groups of under 9 or over 15 digits and an
    address with a written "at" but no sign and no written "dot".
    """
    base = spans.select("rid", F.inline("base")).withColumn("is_base", F.lit(True))
    # a proposal that is a base span itself is that span
    rest = F.filter("proposed", lambda p: ~F.exists("base", lambda b: (b["start"] < p["stop"]) & (p["start"] < b["stop"])))
    more = spans.withColumn("rest", rest).select("rid", F.inline("rest")).withColumn("is_base", F.lit(False))
    value, before = F.col("value"), F.lower("before")

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(value, f"[^{pattern}]", "")) / F.greatest(F.length(value), F.lit(1))

    names = r"(?:token|secret|key|passw|pwd|auth|bearer|credential)"
    assigned = before.rlike(rf"{names}[a-z_]*[\"' ]*[=:][\"' ]*$")
    rows = base.union(more).select(
        "rid", "kind", "start", "stop", "is_base", F.length(value).cast("double").alias("length"), share("0-9").alias("digits"), share("A-Za-z").alias("letters"),
        share("A-Z").alias("upper"), share("0-9a-fA-F").alias("hexes"), share(" ().,_+/=-").alias("separators"),
        F.size(F.split(value, "[^0-9A-Za-z]+")).cast("double").alias("groups"), F.size(F.array_distinct(F.split(value, ""))).cast("double").alias("distinct"),
        before.rlike(r"(?:mail|phone|tel|call|fax|card|visa|account|contact|ip|host|addr|token|secret|key|passw)[a-z]*\W{0,4}$").cast("double").alias("word"),
        before.rlike("[=:][\"' ]*$").cast("double").alias("assigned_sign"), before.rlike("[\"']$").cast("double").alias("quoted"),
        (before.rlike("[a-z0-9]$") | F.col("after").rlike("^[A-Za-z0-9]")).cast("double").alias("glued"), before.rlike(r"[(\[{<]$").cast("double").alias("bracketed"),
        value.rlike(r"[@\[(]").cast("double").alias("sign"), value.rlike(r"(?i)\bdot\b").cast("double").alias("spelled_dot"), assigned.alias("assigned"),
        F.length(_digits(value)).alias("numbers"), F.when(F.col("kind") == KINDS.index("card"), luhn(value)).alias("valid"),
    )
    # what the checks know: base spans are right, a card number is if it passes, a secret is one if a name is given it
    plain = (F.col("kind") == KINDS.index("email")) & (F.col("sign") == 0) & (F.col("spelled_dot") == 0)
    few = (F.col("kind") == KINDS.index("phone")) & ~F.col("numbers").between(9, 15)
    label = (
        F.when(F.col("is_base"), 1.0).when(plain | few, 0.0).when(F.col("kind") == KINDS.index("card"), F.col("valid").cast("double"))
        .when(F.col("kind") == KINDS.index("secret"), F.col("assigned").cast("double"))
    )
    return rows.withColumns({"label": label, "kind": F.col("kind").cast("double")}).drop("assigned", "numbers", "valid")


def select_spans(found: DataFrame, precision: float = 0.9, least: int = 30) -> DataFrame:
    """rid, kind, start, stop and score of the proposals that the trees accept.

    The trees and the thresholds come from all candidates that have a label; only the bins of features that Spark ML's trees split at are
    quantiles of its own sample of the rows.
    With fewer than ``least`` examples of either label no trees are grown, and the generators' own checks decide: a proposal is accepted, at
    score 1, unless its label is 0. They decide as well for kinds that have no example left to calibrate a threshold on.
    """
    checked = F.coalesce(F.col("label") == 1, F.lit(True))
    columns = ["rid", F.col("kind").cast("int").alias("kind"), "start", "stop"]
    order = F.xxhash64("rid", "start", "stop", "kind")
    known = found.where("label is not null").withColumn("part", F.pmod(order, F.lit(3)))
    known = stored(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(known), "pii-labelled")
    sizes = {r["label"]: r["count"] for r in known.where("part < 2").groupBy("label").count().collect()}
    if min(sizes.get(0.0, 0), sizes.get(1.0, 0)) < least:
        return found.where(~F.col("is_base") & checked).select(*columns, F.lit(1.0).alias("score"))
    trees = GBTClassifier(labelCol="label", maxIter=12, maxDepth=4, stepSize=0.3, seed=7).fit(known.where("part < 2").select("features", "label"))
    score = F.floor(vector_to_array("probability")[1] * 20) / 20
    # calibration: per kind and step, the precision of all candidates from that step on
    steps = trees.transform(known.where("part = 2")).groupBy("kind", score.alias("score")).agg(F.count("*").alias("n"), F.sum("label").alias("good")).collect()
    limits, enough = [], checked & ~F.col("kind").isin([r["kind"] for r in steps])
    for kind in sorted({r["kind"] for r in steps}):
        n = good = 0
        limit = None
        for r in sorted((r for r in steps if r["kind"] == kind), key=lambda r: -r["score"]):
            n, good = n + r["n"], good + r["good"]
            if good >= precision * n:
                limit = r["score"]
        if limit is not None:
            limits.append((kind, max(0.5, limit)))
    judged = trees.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found.where(~F.col("is_base")))).withColumn("score", score)
    for kind, limit in limits:
        enough = enough | ((F.col("kind") == kind) & (F.col("score") >= limit))
    return judged.where(enough).select(*columns, "score")


def find(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, ``more``, base (checked spans) and spans (all that are selected), each by start, then kind."""
    spans = found_spans(docs, *more)
    accepted = select_spans(stored(candidates(spans), "candidates"))
    # the best of overlapping proposals, then the longest, then the first
    ranked = accepted.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("a"), (F.col("start") - F.col("stop")).alias("b"), "start", "stop", "kind"))).alias("ranked"))
    kind = "array<struct<start: int, kind: int, stop: int>>"
    chosen = F.aggregate(
        F.coalesce("ranked", F.array().cast("array<struct<a: double, b: int, start: int, stop: int, kind: int>>")), F.array().cast(kind),
        lambda a, s: F.when(F.exists(a, lambda o: (o["start"] < s["stop"]) & (s["start"] < o["stop"])), a).otherwise(F.concat(a, F.array(F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))))),
    )
    base = F.array_sort(F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))))
    rows = spans.join(ranked, "rid", "left").select("doc_id", *more, base.alias("base"), chosen.alias("chosen"))
    return rows.select("doc_id", *more, "base", F.array_sort(F.concat("base", "chosen")).alias("spans"))


def _named(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[{}]") -> DataFrame:
    """``docs`` with every selected span of ``text`` replaced by its kind; of overlapping spans the first is marked."""
    rows = find(docs, *(c for c in docs.columns if c != "doc_id"))
    kinds = F.array(*(F.lit(mark.format(k.upper())) for k in KINDS))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        clear = F.concat(a["out"], F.col("text").substr(a["at"] + 1, s["start"] - a["at"]), kinds[s["kind"]])
        later = s["start"] >= a["at"]
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), F.when(later, clear).otherwise(a["out"]).alias("out"))

    done = F.aggregate("spans", start, step, lambda a: F.concat(a["out"], F.substring("text", a["at"] + 1, F.length("text"))))
    return rows.withColumn("text", F.when(F.size("spans") > 0, done).otherwise(F.col("text"))).select(*docs.columns)


def op2_pii(spark, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = map(count, range(4))
    return found.select("doc_id", *counts, F.sha2(_named(F.col("base")).cast("binary"), 256).alias("base_sha256"), _named(F.col("spans")).alias("spans"))
