"""Personal data by patterns, and by contexts that the patterns' findings teach.

Base identifiers (email, ip, card, phone) are found by pattern and check in every whole text. They are
the seeds of a bootstrap: every identifier-like expression (digit groups, words with ``@``) is an
instance; its lexical patterns are its shape together with the words around it, and for ``MANY_DIGITS`` or more
also the words alone, so that other formats than the seeds' are met. Patterns and
instances form a graph. In each round a pattern's confidence is the share of known identifiers
of a kind among its instances, and an instance's score the best confidence of its patterns. Instances that
score high enough and overlap no base span become spans of that kind.

Built-in functions only. A text is read once, by the scan; its matches are written to the shared folder and
everything behind works on these narrow rows: positions by a window over one document's matches, graph
rounds by combining aggregates. Base spans are never changed.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanweave.session import stage

from .common import packed, unpacked

# Where a run of letters or digits can begin: not inside one, as all places of a run fail alike, unless a match ends there.
NAME_START = r"(?:(?<![A-Za-z0-9._%+-])|\G)"
DIGITS_START = r"(?:(?<![0-9])|\G)"
# The four kinds in their order, and how each looks.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": NAME_START + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": DIGITS_START + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# An expression that may be an identifier of some kind.
INSTANCE = "instance"
INSTANCE_PATTERN = r"\+?\(?[0-9][0-9\x20().-]*[0-9]|" + NAME_START + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]*[A-Za-z0-9-]"
CONTEXT_CHARS = 48
#: So many digits may be an identifier whatever stands between them.
MANY_DIGITS = 7
ROUNDS = 3
SMOOTHING = 2
CONFIDENCE = 0.9


def matches(text: Column, pattern: str, wanted: Column) -> Column:
    """Struct arrays of one pattern's leftmost matches: length of the gap before, match, context on both sides."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = F.zip_with(
        F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(g.alias("g"), m.alias("m"))),
        F.slice(gaps, 2, F.size(found)),
        lambda x, after: F.struct(
            F.length(x["g"]).alias("gap"),
            x["m"].alias("match"),
            F.right(x["g"], F.lit(CONTEXT_CHARS)).alias("left"),
            F.left(after, F.lit(CONTEXT_CHARS)).alias("right"),
        ),
    )
    return F.when(wanted & (F.size(found) > 0), rows)


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``doc`` (the columns ``keep``), row number and the raw matches of every text, written once.

    A null text is an empty one.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    digits, at = F.col("body").rlike("[0-9]"), F.contains(F.col("body"), F.lit("@"))
    wanted = {"email": at, "ip": digits, "card": digits, "phone": digits & F.contains(F.col("body"), F.lit("+"))}
    found = docs.select(packed(docs, keep), body.alias("body")).select(
        "doc",
        *[matches(F.col("body"), PATTERNS[k], wanted[k]).alias(k) for k in KINDS],
        matches(F.col("body"), INSTANCE_PATTERN, digits | at).alias(INSTANCE),
    )
    return stage(found.withColumn("row", F.monotonically_increasing_id()), "pii-scan")


def placed(scanned: DataFrame) -> DataFrame:
    """One row per raw match: row number, kind, start and end in code points, match and context."""
    kinds = [F.struct(F.lit(k).alias("kind"), F.col(k).alias("found")) for k in (*KINDS, INSTANCE)]
    rows = (
        scanned.select("row", F.explode(F.array(*kinds)).alias("x"))
        .where("x.found IS NOT NULL")
        .select("row", "x.kind", F.posexplode("x.found").alias("k", "m"))
        .select("row", "kind", "k", "m.*")
    )
    in_text = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("match")).over(in_text)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))


def valid(kind: Column, match: Column) -> Column:
    """The checks behind the patterns; null for other kinds."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    count = F.length(digits)
    small = F.forall(F.split(match, r"\."), lambda part: part.cast("double") <= 255)
    backwards = F.reverse(digits)
    doubled = F.transform(
        F.sequence(F.lit(1), count),
        lambda k: F.substring(backwards, k, F.lit(1)).cast("int") * (2 - k % 2),
    )
    luhn = F.aggregate(doubled, F.lit(0), lambda total, d: total + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", small)
        .when(kind == "card", F.when(count.between(12, 19), luhn).otherwise(False))
        .when(kind == "phone", count.between(9, 15))
    )


def base_spans(places: DataFrame) -> DataFrame:
    return places.where(valid(F.col("kind"), F.col("match"))).select("row", "kind", "start", "end")


def instances(places: DataFrame, base: DataFrame) -> DataFrame:
    """Identifier-like expressions with number, normal form, patterns, and the base kind they overlap, if any."""
    # Digits with what stands between them, or that there is an @.
    shape = F.when(F.contains(F.col("name"), F.lit("@")), "@").otherwise(F.regexp_replace("name", "[0-9]", "9"))
    many = F.length(F.regexp_replace("name", "[^0-9]", "")) >= MANY_DIGITS
    coarse = F.when(~F.contains(F.col("name"), F.lit("@")) & many, "digits")
    before = F.lower(F.regexp_extract("left", r"(\S+)\s*$", 1))
    two = F.lower(F.regexp_extract("left", r"(\S+\s+\S+)\s*$", 1))
    after = F.lower(F.regexp_extract("right", r"^\s*(\S+)", 1))
    rows = (
        places.where(F.col("kind") == INSTANCE)
        .withColumn("name", F.lower("match"))
        .select(
            "row",
            "start",
            "end",
            F.xxhash64("name").alias("instance"),
            F.array_distinct(
                F.filter(
                    F.array(
                        *[
                            F.when((words != "") & form.isNotNull(), F.xxhash64(F.lit(side), words, form))
                            for form in (shape, coarse)
                            for side, words in (("before", before), ("two before", two), ("after", after))
                        ]
                    ),
                    lambda p: p.isNotNull(),
                )
            ).alias("patterns"),
        )
    )
    own = base.select(F.col("row").alias("r"), "kind", F.col("start").alias("s"), F.col("end").alias("e"))
    overlap = (F.col("row") == F.col("r")) & (F.col("start") < F.col("e")) & (F.col("s") < F.col("end"))
    first = F.min(F.when(F.col("kind").isNotNull(), F.array_position(F.lit(list(KINDS)), F.col("kind"))))
    return (
        rows.join(own, overlap, "left")
        .groupBy("row", "start", "end", "instance", "patterns")
        .agg(first.alias("k"))
        .withColumn("base", F.when(F.col("k").isNotNull(), F.element_at(F.lit(list(KINDS)), F.col("k").cast("int"))))
        .drop("k")
    )


def scored(found: DataFrame, rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> DataFrame:
    """Best ``kind`` and ``score`` of each instance that is no seed, after all rounds over the graph."""
    edges = stage(found.select("instance", F.explode("patterns").alias("pattern")).distinct(), "pii-edges")
    seeds = stage(
        found.where("base IS NOT NULL").groupBy("instance").agg(F.min("base").alias("kind")).withColumn("score", F.lit(1.0)),
        "pii-seeds",
    )
    sizes = stage(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "pii-sizes")
    known, learned = seeds, None
    for _ in range(rounds):
        confidence = (
            edges.join(known, "instance")
            .groupBy("pattern", "kind")
            .agg(F.sum("score").alias("score"))
            .join(sizes, "pattern")
            .select("pattern", "kind", (F.col("score") / (F.col("n") + smoothing)).alias("confidence"))
        )
        best = F.max(F.struct("confidence", "kind"))
        learned = stage(
            edges.join(confidence, "pattern")
            .groupBy("instance")
            .agg(best.alias("best"))
            .select("instance", "best.kind", F.col("best.confidence").alias("score"))
            .join(seeds, "instance", "left_anti"),
            "pii-scores",
        )
        known = seeds.unionByName(learned)
    return learned


def all_spans(scanned: DataFrame, confidence: float = CONFIDENCE) -> DataFrame:
    """``row``, ``kind``, ``start``, ``end`` and ``base`` of base and discovered spans."""
    places = stage(placed(scanned), "pii-places")
    base = stage(base_spans(places), "pii-base")
    found = stage(instances(places, base), "pii-instances")
    sure = scored(found).where(F.col("score") >= confidence)
    # A discovered instance that shares a place with a base span adds nothing.
    more = (
        found.where("base IS NULL").join(sure, "instance").select("row", "kind", "start", "end", F.lit(False).alias("base"))
    )
    return base.withColumn("base", F.lit(True)).unionByName(more)


def per_row(spans: DataFrame) -> DataFrame:
    """``row`` and its sorted ``spans``; the spans of one text are one array."""
    span = F.struct(
        "start", F.array_position(F.lit(list(KINDS)), F.col("kind")).alias("place"), "end", "kind", "base"
    )
    return spans.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def find_personal_data(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``doc`` (the columns ``keep``) and ``spans``, an array sorted by start and kind, for every row."""
    scanned = scan(docs, keep)
    return scanned.select("doc", "row").join(per_row(all_spans(scanned)), "row", "left").select(
        "doc", F.coalesce("spans", F.array().cast("array<struct<start:bigint,place:bigint,end:bigint,kind:string,base:boolean>>")).alias("spans")
    )


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; ``n_chars``, if there, is counted anew.

    Overlapping spans become one, named after the first. Texts without spans stay as they are.
    """
    columns = docs.columns
    scanned = scan(docs, columns)
    spans = per_row(all_spans(scanned))
    text = F.col("doc.text")
    # Texts in which no pattern has met anything cannot have spans and need not move.
    met = reduce(or_, [F.col(k).isNotNull() for k in (*KINDS, INSTANCE)])
    step = lambda acc, s: F.when(
        s["start"] >= acc["end"],
        F.struct(
            F.concat(
                acc["out"],
                F.substring(text, acc["end"].cast("int") + 1, (s["start"] - acc["end"]).cast("int")),
                F.concat(F.lit("<"), s["kind"], F.lit(">")),
            ).alias("out"),
            s["end"].alias("end"),
        ),
    ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["end"], s["end"]).alias("end")))
    masked = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("end")),
        step,
        lambda acc: F.concat(acc["out"], F.substring(text, acc["end"].cast("int") + 1, F.length(text))),
    )
    quiet = unpacked(scanned.where(~met), columns)
    loud = scanned.where(met).join(spans, "row", "left")
    result = loud.withColumn("new", F.when(F.col("spans").isNotNull(), masked).otherwise(text))
    changed = {"text": F.col("new")}
    if "n_chars" in columns:
        counted = F.length("new").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("spans").isNotNull(), counted).otherwise(F.col("doc.n_chars"))
    return quiet.unionByName(result.select(*[changed.get(c, F.col("doc").getField(c)).alias(c) for c in columns]))
