"""Personal data: generators with high recall propose spans, boosted trees and calibrated thresholds choose.

Patterns of known formats give the base spans; they always stay. Looser generators propose more, which may
overlap: runs and groups of digits, international and national numbers, spelled-out addresses. A candidate
is one row with its place, what it is made of and what stands around it. Candidates that are base spans are
examples of personal data; those that fail the check of their kind (parts above 255, check digit, number of
digits) or cut into a base span are examples of what is not. Boosted trees learn from all of
them but those kept back, on which thresholds per kind are set, and the candidates nobody labelled are
chosen by them: of candidates that overlap in a document the most probable stays.

All of it is DataFrame functions. A place is found from the text between matches: the pieces that ``split``
leaves and the matches of ``regexp_extract_all`` are one document's worth of lengths, summed by a window.
The patterns cannot run longer than the text: repeats take what they can and do not give it back, and a
match starts only where no longer one could have started.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.frames import stored, table

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 24
#: The share of labelled candidates kept back for thresholds; about so many distinct ones in a part.
KEPT_BACK, PART = 0.3, 50_000
ROUNDS, DEPTH, STEP, SPLITS = 20, 4, 0.3, 256
#: A threshold is the lowest that is this often right on the rows kept back.
PRECISION = 0.9
BINS = 50

_LOCAL = "[A-Za-z0-9._%+-]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


@dataclass(frozen=True)
class Generator:
    """``needs`` is a pattern that every text with a match holds, and quick to look for."""

    kind: str
    pattern: str
    needs: str
    base: bool = False


GENERATORS = (
    Generator("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True),
    Generator("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", True),
    Generator("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])", "[0-9]{3}|[0-9][ -][0-9]", True),
    Generator("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", True),
    Generator("email", rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+\x20?[\[(][Aa][Tt][\])]\x20?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"[\[(][Aa][Tt][\])]"),
    Generator("card", r"(?<![0-9])[0-9]{13,19}+(?![0-9])", "[0-9]{13}"),
    Generator("card", r"(?<![0-9])[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])", "[0-9]{4}[ -][0-9]{4}"),
    Generator("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])", r"\+[0-9]"),
    Generator("phone", r"(?<![0-9+(])(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[.-][0-9]{4}(?![0-9])", "[0-9]{3}[.-][0-9]{4}"),
)
#: Words before a candidate that speak of its kind.
HINTS = {
    "email": "(?i)mail|contact|write|kontakt|correo|courriel",
    "ip": r"(?i)\bip\b|host|server|addr|login",
    "card": "(?i)card|visa|credit|karte|tarjeta|carte",
    "phone": r"(?i)tel|phone|call|mobil|fax|ruf",
}
FEATURES = (
    *(f"is_{k}" for k in KINDS), *(f"hint_{k}" for k in KINDS), "size", "digits", "letters", "marks", "groups", "kinds_of_digits",
    "check_digit", "octets", "plus", "at", "before_letter", "before_digit", "before_space", "after_letter", "after_digit",
    "after_space", "digits_before", "digits_after",
)


def _key(doc_id: str, text: str) -> Column:
    """A digest of id and text: rows that agree in both have the same spans."""
    named = F.coalesce(F.concat(F.lit("i"), F.col(doc_id).cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(named, F.lit(" "), F.coalesce(F.col(text), F.lit("")))))


def check_digit(digits: Column) -> Column:
    """True where the last of ``digits`` is their Luhn check digit."""
    def value(x: Column, i: Column) -> Column:
        d = F.coalesce(x.try_cast("int"), F.lit(0))
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    values = F.transform(F.split(F.reverse(digits), ""), value)
    return F.aggregate(values, F.lit(0), lambda total, x: total + x) % 10 == 0


def _proposed(docs: DataFrame) -> DataFrame:
    """One row per match of a generator: key, row, generator, place among its matches, match, the length of
    the text since the match before, and the text around it. ``docs``: doc_id, text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select(_key("doc_id", "text").alias("key"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    matches = named.select(
        "*",
        *[
            F.when(F.col("text").rlike(g.needs), F.regexp_extract_all("text", F.lit(g.pattern), F.lit(0))).alias(f"m{i}")
            for i, g in enumerate(GENERATORS)
        ],
    )
    pieces = matches.select(
        "key", "row", *[f"m{i}" for i in range(len(GENERATORS))],
        *[F.when(F.size(f"m{i}") > 0, F.split("text", g.pattern, -1)).alias(f"p{i}") for i, g in enumerate(GENERATORS)],
    ).filter(" or ".join(f"size(m{i}) > 0" for i in range(len(GENERATORS))))

    def found(i: int) -> Column:
        m, p = F.col(f"m{i}"), F.col(f"p{i}")
        n = F.size(m)
        # Lambdas see their own element alone, so that no array is made again for each.
        beside = F.arrays_zip(
            m.alias("m"), F.slice(p, 1, n).alias("gap"), F.slice(p, 2, n).alias("after"), F.concat(F.array(F.lit("")), m).alias("last")
        )
        return F.transform(
            F.slice(beside, 1, n),
            lambda x, at: F.struct(
                F.lit(i).alias("generator"), at.alias("place"), x["m"].alias("match"), F.char_length(x["gap"]).cast("long").alias("gap"),
                F.right(F.concat(x["last"], x["gap"]), F.lit(CONTEXT)).alias("before"), F.left(x["after"], F.lit(CONTEXT)).alias("after"),
            ),
        )

    every = F.flatten(F.array(*[
        F.when(F.size(f"m{i}") > 0, found(i)).otherwise(F.array().cast(_FOUND)) for i in range(len(GENERATORS))
    ]))
    return pieces.select("key", "row", F.inline(every))


_FOUND = "array<struct<generator:int,place:int,match:string,gap:bigint,before:string,after:string>>"


def _flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("double"), F.lit(0.0))


def candidates(docs: DataFrame) -> DataFrame:
    """All proposals, once per key, kind and place, with ``base``, ``label`` (1, 0 or NULL) and the features."""
    found = _proposed(docs)
    size = F.char_length("match").cast("long")
    ordered = Window.partitionBy("key", "row", "generator").orderBy("place")
    placed = found.withColumn("end", F.sum(F.col("gap") + size).over(ordered)).withColumn("start", F.col("end") - size)
    kind = F.element_at(F.array(*[F.lit(g.kind) for g in GENERATORS]), F.col("generator") + 1)
    is_base = F.element_at(F.array(*[F.lit(g.base) for g in GENERATORS]), F.col("generator") + 1)
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.length("digits")
    described = placed.withColumns({"kind": kind, "digits": digits, "of_base": is_base})
    fits = (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", F.col("match").rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
        .when(F.col("kind") == "card", F.when(n.between(16, 19), check_digit(F.col("digits"))).otherwise(F.lit(False)))
        .otherwise(n.between(8, 15))
    )
    first, last = F.right("before", F.lit(1)), F.left("after", F.lit(1))
    values = {
        **{f"is_{k}": _flag(F.col("kind") == k) for k in KINDS},
        **{f"hint_{k}": _flag(F.col("before").rlike(HINTS[k])) for k in KINDS},
        "size": size.cast("double"), "digits": n.cast("double"),
        "letters": F.length(F.regexp_replace("match", "[^A-Za-z]", "")).cast("double"),
        "marks": F.length(F.regexp_replace("match", "[A-Za-z0-9]", "")).cast("double"),
        "groups": F.regexp_count("match", F.lit("[0-9]++")).cast("double"),
        "kinds_of_digits": F.size(F.array_distinct(F.split("digits", ""))).cast("double"),
        "check_digit": _flag(F.when(n.between(13, 19), check_digit(F.col("digits")))),
        "octets": _flag(F.col("match").rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")),
        "plus": _flag(F.startswith("match", F.lit("+"))), "at": _flag(F.contains("match", F.lit("@"))),
        "before_letter": _flag(first.rlike(r"\p{L}")), "before_digit": _flag(first.rlike("[0-9]")), "before_space": _flag(first.rlike(r"^$|\s")),
        "after_letter": _flag(last.rlike(r"\p{L}")), "after_digit": _flag(last.rlike("[0-9]")), "after_space": _flag(last.rlike(r"^$|\s")),
        "digits_before": F.regexp_count("before", F.lit("[0-9]")).cast("double"),
        "digits_after": F.regexp_count("after", F.lit("[0-9]")).cast("double"),
    }
    checked = described.select(
        "key", "kind", "start", "end", fits.alias("fits"), "of_base", F.struct(*[values[f].alias(f) for f in FEATURES]).alias("features")
    )
    once = checked.groupBy("key", "kind", "start", "end").agg(
        F.bool_or(F.col("fits") & F.col("of_base")).alias("base"), F.bool_or("fits").alias("fits"), F.max("features").alias("features")
    )
    # What follows is what came before in the other order: a frame that ends with the rows is summed once for each.
    along, back = Window.partitionBy("key").orderBy("start", "end", "kind"), [F.col(c).desc() for c in ("start", "end", "kind")]
    reached = F.max(F.when(F.col("base"), F.col("end"))).over(along.rowsBetween(Window.unboundedPreceding, -1))
    coming = F.min(F.when(F.col("base"), F.col("start"))).over(
        Window.partitionBy("key").orderBy(*back).rowsBetween(Window.unboundedPreceding, -1)
    )
    cuts = F.coalesce(reached > F.col("start"), F.lit(False)) | F.coalesce(coming < F.col("end"), F.lit(False))
    return once.withColumn("cuts", cuts).select(
        "key", "kind", "start", "end", "base",
        F.when(F.col("base"), 1.0).when(~F.col("fits") | F.col("cuts"), 0.0).alias("label"), "features.*",
    )


def fit(found: DataFrame, rounds: int = ROUNDS) -> tuple[GBTClassificationModel, dict[str, float]] | None:
    """Boosted trees on all labelled candidates but those kept back, and from these the threshold of every
    kind; None where the labelled candidates are all of one class.

    Candidates that are alike in kind, label and features are one row that weighs as much as they do."""
    draw = F.pmod(F.shiftright(F.xxhash64("key", "kind", "start", "end"), 32), F.lit(1000))
    alike = (
        found.filter("label is not null")
        .withColumn("held", draw < int(1000 * KEPT_BACK))
        .groupBy("held", "kind", "label", *FEATURES)
        .agg(F.count("*").cast("double").alias("weight"))
    )
    distinct = stored(alike, "personal_alike")
    # Rows of a part are in one order, and while they fit in one part every run sums them alike.
    order = F.xxhash64("held", "kind", "label", *FEATURES)
    parts = 1 + distinct.count() // PART
    rows = stored(
        assembled(distinct).select("held", "kind", "label", "vector", "weight", order.alias("order"))
        .repartition(parts, "order").sortWithinPartitions("order", "kind", "label"),
        "personal_labelled",
    )
    train = rows.filter("not held")
    if train.select("label").distinct().count() < 2:
        return None
    trees = GBTClassifier(
        featuresCol="vector", weightCol="weight", maxIter=rounds, maxDepth=DEPTH, stepSize=STEP, maxBins=SPLITS, seed=11
    )
    model = trees.fit(train)
    return model, thresholds(scored(model, rows.filter("held")))


def thresholds(held: DataFrame) -> dict[str, float]:
    """Per kind the lowest probability from which on candidates are right ``PRECISION`` of the time, with one
    wrong one more than was seen. Kinds without such a probability are missing. One row a kind."""
    bins = held.groupBy("kind", F.floor(F.col("p") * BINS).alias("bin")).agg(
        F.sum(F.col("label") * F.col("weight")).alias("right"), F.sum("weight").alias("n"), F.min("p").alias("least")
    )
    above = Window.partitionBy("kind").orderBy(F.col("bin").desc())
    right, n = F.sum("right").over(above), F.sum("n").over(above)
    good = bins.select("kind", "least", (right / (n + 1)).alias("precision")).filter(F.col("precision") >= PRECISION)
    return {r.kind: r.least for r in good.groupBy("kind").agg(F.min("least").alias("least")).collect()}


def assembled(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(found)


def scored(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("p", vector_to_array("probability")[1])


def chosen(found: DataFrame, fitted: tuple[GBTClassificationModel, dict[str, float]] | None) -> DataFrame:
    """key, kind, start, end, base of all spans: the base spans, and of the candidates without label those
    above their kind's threshold; of some that overlap, the most probable, then the longest, then the first."""
    base = found.filter("base").select("key", "kind", "start", "end", "base")
    if not fitted or not fitted[1]:
        return base
    model, limits = fitted
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("kind")]
    probable = scored(model, assembled(found.filter("label is null"))).filter(F.col("p") >= limit)
    along = Window.partitionBy("key").orderBy("start", "end", "kind")
    reached = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    islands = probable.withColumn("fresh", F.coalesce(reached <= F.col("start"), F.lit(True))).withColumn(
        "island", F.sum(F.col("fresh").cast("long")).over(along)
    )
    rank = F.struct("p", F.col("end") - F.col("start"), -F.col("start"), "kind")
    best = islands.groupBy("key", "island").agg(F.max_by(F.struct("kind", "start", "end"), rank).alias("best"))
    return base.unionByName(best.select("key", "best.*", F.lit(False).alias("base")))


def _listed(spans: Column) -> Column:
    """Spans as ``kind:start:end`` by kind, then place, joined by commas."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).alias("n"), s["start"].alias("a"), s["end"].alias("b"), s["kind"].alias("k")
    )))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["k"], s["a"].cast("string"), s["b"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, n_added, base_spans and spans.

    Spans are ``kind:start:end`` in code points, end exclusive, by kind as in ``KINDS``, then start. Null
    text is empty text; repeated rows give repeated rows; without labelled candidates of both classes
    the base spans are all there is; an empty table gives an empty result.
    """
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = stored(candidates(named), "personal_candidates")
    spans = chosen(found, fit(found, rounds))
    span = F.struct("kind", "start", "end")
    per_document = spans.groupBy("key").agg(
        F.collect_list(F.when(F.col("base"), span)).alias("base"), F.collect_list(span).alias("every")
    )
    joined = named.select("doc_id", _key("doc_id", "text").alias("key")).join(per_document, "key", "left")
    filled = {c: F.coalesce(F.col(c), F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")) for c in ("base", "every")}

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [of_kind(k).alias(f"n_{k}") for k in KINDS]
    return joined.withColumns(filled).select(
        "doc_id", *counts, (F.size("every") - F.size("base")).cast("long").alias("n_added"),
        _listed(F.col("base")).alias("base_spans"), _listed(F.col("every")).alias("spans"),
    )


def redact(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``spans`` (the rows of ``scan``, ids unique) replaced by its kind in brackets.
    Of spans that overlap the first takes the place of all."""
    listed = F.filter(F.split("spans", ","), lambda s: s != "")
    parsed = F.transform(listed, lambda s: F.struct(
        F.split_part(s, F.lit(":"), F.lit(2)).cast("long").alias("a"), F.split_part(s, F.lit(":"), F.lit(3)).cast("long").alias("b"),
        F.split_part(s, F.lit(":"), F.lit(1)).alias("k"),
    ))
    cut = F.aggregate(
        F.array_sort(parsed), F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out")),
        lambda done, s: F.when(s["a"] < done["at"], F.struct(F.greatest(done["at"], s["b"]).alias("at"), done["out"].alias("out"))).otherwise(
            F.struct(s["b"].alias("at"), F.concat(done["out"], F.array(
                F.substring(F.col("__text"), done["at"].cast("int") + 1, (s["a"] - done["at"]).cast("int")), F.concat(F.lit("["), s["k"], F.lit("]")),
            )).alias("out"))
        ),
    )
    ids = spans.select(F.col("doc_id").alias("__id"), "spans")
    joined = docs.withColumn("__text", F.col(f"`{text_col}`")).join(ids, F.col(f"`{id_col}`").eqNullSafe(F.col("__id")), "left")
    rest = joined.withColumn("__cut", F.when(F.col("__text").isNotNull() & F.col("spans").isNotNull(), cut))
    clean = F.concat(F.array_join("__cut.out", ""), F.substr(F.col("__text"), (F.col("__cut.at") + 1).cast("int")))
    return rest.withColumn(text_col, F.coalesce(clean, F.col("__text"))).select(*[f"`{c}`" for c in docs.columns])


def op12_personal(spark, sf_dir) -> DataFrame:
    """All documents; the base spans as a digest, all spans spelled out."""
    found = scan(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.encode("base_spans", "UTF-8"), 256)
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], digest.alias("base_sha256"), "spans", "n_added")
