"""Personal data: base patterns, and candidates that boosted trees select by format and context.

1. Base spans. E-mail addresses, IP addresses, card and phone numbers by pattern, checked for their digits. They stay.
2. Candidates. Two generators propose wider spans: anything that may spell an address ("name (at) host dot org"), and
   any run of digits with separators, proposed as card, phone and IP at once, so spans overlap.
3. Labels. A candidate that holds a valid base match of its kind is positive, one that its kind's check rejects is
   negative. The rest pass the check but no base pattern: these are what is to be decided.
4. Trees. Candidates are described by small numbers: characters before and after, cue words before, groups, size,
   separators, shape. What the base patterns test (plus sign, at sign, checksum) is left out. All candidates are counted
   by description, so the fit sees every candidate of the corpus as a weight; there are at most ``SHAPES``
   descriptions, whatever the corpus. Gradient-boosted trees are fitted on four fifths of the documents.
5. Thresholds. On the remaining fifth, each kind gets the least score from which on the share of positives is
   ``PRECISION`` at least; without such a score nothing of the kind is selected.
6. Undecided candidates whose description scores that much become spans; of a run proposed as several kinds, the
   best scored one does.

Spans are offsets in code points, end exclusive. Patterns are written so that no text takes more than linear time: runs
are possessive and start where a run starts (or where the last match ended), which finds the same matches.

Defined cases: null and empty texts have no spans; very long texts are searched whole; ties of start go by kind
(email, ip, card, phone); repeated rows are found alike and count as often as they occur; null ids take part in the
fit like others; an empty table gives no rows, and one whose candidates are all alike selects nothing; input columns
named like an output column are replaced, others are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbitlens.session import materialize

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: share of positives among held-out labelled candidates from the threshold on
PRECISION = 0.95
TREES, DEPTH = 20, 3
CONTEXT = 24

_LOCAL = "A-Za-z0-9._%+-"
_START = r"(?:(?<![{0}])|\G)"
BASE = (
    rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[ -]?[0-9])++",
    # what the pattern's middle may hold, up to the last digit of the run
    r"\+[0-9](?=[ ().0-9-])(?:[ ().-]*+[0-9])++",
)
SPELLED = (rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++(?:@| @ | ?\((?:at|AT)\) ?| ?\[(?:at|AT)\] ?| at )[A-Za-z0-9-]++"
           r"(?:(?:\.| \. | ?\((?:dot|DOT)\) ?| ?\[(?:dot|DOT)\] ?| dot )[A-Za-z0-9-]++)*+")
DIGITS = r"[+(]?[0-9](?:[ ().:/,-]{0,2}+[0-9])*+"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
QUAD = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"

# Words that announce a kind, and common endings of host names.
CUES = ("mail|contact|write|address", "ip|host|server|addr|node|from", "card|visa|credit|debit|pay|account",
        "phone|tel|call|fax|mobile|cell|dial")
ENDINGS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu"

#: (name, number of values) of a description, the kind first
FEATURES = (("kind", 4), ("before", 5), ("after", 5), ("cue", 2), ("groups", 6), ("size", 7), ("separators", 6), ("shape", 2))
SHAPES = 4 * 5 * 5 * 2 * 6 * 7 * 6 * 2


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_before(values: Column) -> Column:
    """For each number of an array the sum of those before it, in about n ** 1.5 steps."""
    zero = F.lit(0)

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, lambda a, x: a + x)

    def cut(v: Column, b: Column) -> Column:
        return F.transform(F.sequence(zero, b - 1), lambda k: F.slice(v, k * b + 1, b))

    def run(parts: Column) -> Column:
        return let(F.transform(parts, total), lambda sizes: F.flatten(F.transform(
            parts, lambda part, k: let(total(F.slice(sizes, F.lit(1), k)), lambda head: F.transform(
                part, lambda _, i: head + total(F.slice(part, F.lit(1), i)))))))

    def steps(v: Column) -> Column:
        return F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1))

    return let(values, lambda v: let(steps(v), lambda b: let(cut(v, b), run)))


def matches(text: Column, pattern: str) -> Column:
    """The leftmost matches that do not overlap: (start, value, before, after), with the text around."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(gaps: Column, hits: Column) -> Column:
        sizes = F.transform(hits, lambda h, i: F.length(h) + F.length(F.get(gaps, i)))
        return let(sums_before(sizes), lambda at: F.transform(hits, lambda h, i: F.struct(
            (F.get(at, i) + F.length(F.get(gaps, i))).alias("start"), h.alias("value"),
            F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"))))

    none = F.array().cast("array<struct<start: int, value: string, before: string, after: string>>")
    found = let(gaps, lambda g: let(hits, lambda h: placed(g, h)))
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(none)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the checksum."""
    def step(total: Column, d: Column) -> Column:
        # the last entry of the struct says whether the next digit is doubled
        twice = d * 2
        value = F.when(total["odd"], twice - F.when(twice > 9, 9).otherwise(0)).otherwise(d)
        return F.struct((total["sum"] + value).alias("sum"), (~total["odd"]).alias("odd"))

    ones = F.transform(F.split(F.reverse(number), ""), lambda c: F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0)))
    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd"))
    return F.aggregate(ones, start, step, lambda t: t["sum"] % 10 == 0)


def valid(kind: int, value: Column) -> Column:
    """The check of a kind's base match."""
    if kind == EMAIL:
        return F.lit(True)
    if kind == IP:
        return value.rlike(QUAD)
    size = F.length(digits(value))
    if kind == PHONE:
        return size.between(9, 15)
    return F.when(size.between(12, 19), luhn(digits(value))).otherwise(False)


SPAN = "struct<start: int, kind: int, end: int>"


def base_spans(text: Column) -> Column:
    """All valid base matches as (start, kind, end), in order."""
    text = F.coalesce(text, F.lit(""))

    def of(kind: int) -> Column:
        hits = F.filter(matches(text, BASE[kind]), lambda m: valid(kind, m["value"]))
        return F.transform(hits, lambda m: F.struct(
            m["start"].alias("start"), F.lit(kind).alias("kind"), (m["start"] + F.length(m["value"])).alias("end")))

    return F.array_sort(F.concat(*[of(kind) for kind in range(len(KINDS))]))


def _side(char: Column) -> Column:
    """0 edge of the text or line, 1 blank, 2 letter, 3 digit, 4 other."""
    return (F.when((char == "") | (char == "\n"), 0).when(char.rlike(r"^\s$"), 1).when(char.rlike(r"^\p{L}$"), 2)
            .when(char.rlike("^[0-9]$"), 3).otherwise(4))


def _bucket(n: Column, edges: tuple[int, ...]) -> Column:
    """How many of the edges a number exceeds."""
    return sum(((n > e).cast("int") for e in edges[1:]), (n > edges[0]).cast("int"))


def _code(kind: int, m: Column, value: Column, email: bool) -> Column:
    """A candidate's description as one number below SHAPES."""
    cue = F.lower(m["before"]).rlike(rf"(?:{CUES[kind]})").cast("int")
    if email:
        groups = F.size(F.split(F.regexp_extract(value, "@(.*)$", 1), r"\."))
        size, separators = F.length(F.regexp_extract(value, "^([^@]*)", 1)), F.lit(0)
        shape = value.rlike(rf"\.(?:{ENDINGS})$").cast("int")
        groups, size = F.least(groups, F.lit(5)), _bucket(size, (2, 5, 8, 12, 20, 40))
    else:
        number = digits(value)
        groups = F.least(F.size(F.split(F.regexp_replace(value, "^[^0-9]+", ""), "[^0-9]+")), F.lit(5))
        size = _bucket(F.length(number), (6, 8, 10, 12, 15, 16))
        inner = F.regexp_replace(value, r"[0-9+]", "")
        separators = (F.when(inner == "", 0).when(inner.rlike("^ +$"), 1).when(inner.rlike("^-+$"), 2)
                      .when(inner.rlike(r"^\.+$"), 3).when(inner.contains("("), 4).otherwise(5))
        shape = value.rlike(r"(?:^|[^0-9])[0-9]{4}(?:[^0-9][0-9]{4}){2,}|[0-9]{3}[^0-9]{1,2}[0-9]{4}$").cast("int")
    parts = (F.lit(kind), _side(F.right(m["before"], F.lit(1))), _side(m["after"]), cue, groups, size, separators, shape)
    code = F.lit(0)
    for (_, values), part in zip(FEATURES, parts):
        code = code * values + F.coalesce(part.cast("int"), F.lit(0))
    return code


def _proposal(kind: int, m: Column, value: Column, passes: Column, holds: Column, email: bool = False) -> Column:
    """(start, kind, end, code, label); the label is null where the check passes and no base pattern does."""
    return F.struct(
        m["start"].alias("start"), F.lit(kind).alias("kind"), (m["start"] + F.length(m["value"])).alias("end"),
        _code(kind, m, value, email).alias("code"), F.when(holds, 1).when(~passes, 0).alias("label"))


def candidates(text: Column) -> Column:
    """What the generators propose, with descriptions and labels."""
    text = F.coalesce(text, F.lit(""))

    def spelled(m: Column) -> Column:
        at = F.regexp_replace(m["value"], r" @ | ?\((?:at|AT)\) ?| ?\[(?:at|AT)\] ?| at ", "@")
        value = F.regexp_replace(at, r" \. | ?\((?:dot|DOT)\) ?| ?\[(?:dot|DOT)\] ?| dot ", ".")
        return let(value, lambda v: _proposal(EMAIL, m, v, v.rlike(BASE[EMAIL]), m["value"].rlike(BASE[EMAIL]), email=True))

    def numeric(m: Column) -> Column:
        value = m["value"]
        size = F.length(digits(value))

        def holds(kind: int) -> Column:
            return F.exists(F.regexp_extract_all(value, F.lit(BASE[kind]), F.lit(0)), lambda v: valid(kind, v))

        known = holds(IP) | holds(CARD) | holds(PHONE)
        cased = []
        for kind, wanted, passes in (
            (IP, F.size(F.split(value, "[^0-9]+")) >= 4, F.regexp_replace(value, " ", "").rlike(QUAD)),
            (CARD, size >= 12, valid(CARD, value)), (PHONE, size >= 7, valid(PHONE, value)),
        ):
            mine = holds(kind)
            # a run in which another kind was found is no such number
            cased.append(F.when(wanted, _proposal(kind, m, value, passes & (mine | ~known), mine)))
        return F.array_compact(F.array(*cased))

    long = F.filter(matches(text, DIGITS), lambda m: F.length(m["value"]) >= 7)
    return F.concat(F.transform(matches(text, SPELLED), spelled), F.flatten(F.transform(long, numeric)))


@dataclass(frozen=True)
class Selector:
    """Descriptions whose undecided candidates are spans, with their scores; at most SHAPES."""

    scores: dict[int, float]


def shapes_of(found: DataFrame) -> DataFrame:
    """All candidates counted by description, label and fold: at most SHAPES * 6 rows, whatever the corpus."""
    one = found.select("held_out", F.explode("candidates").alias("c"))
    counted = one.groupBy("held_out", "c.code", "c.label").agg(F.count("*").alias("n"))
    rest, columns = F.col("code"), []
    for name, values in reversed(FEATURES):
        columns.append((rest % values).cast("double").alias(name))
        rest = F.floor(rest / values)
    return materialize(counted.select("held_out", "code", "label", "n", *columns), "shapes")


def fit(found: DataFrame, precision: float = PRECISION) -> Selector:
    """Boosted trees over descriptions, and each kind's threshold."""
    shapes = shapes_of(found)
    # a bounded table: one partition in one order makes the fit repeatable
    learn = shapes.where("label is not null and not held_out").repartition(1).sortWithinPartitions("code", "label")
    if learn.select("label").distinct().count() < 2:
        return Selector({})
    names = [n for n, _ in FEATURES]
    vectors = VectorAssembler(inputCols=names, outputCol="features")
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH,
                          maxBins=8, seed=11, cacheNodeIds=False)
    weighed = vectors.transform(learn.withColumns({"label": F.col("label").cast("double"), "n": F.col("n").cast("double")}))
    model = trees.fit(weighed)
    scored = model.transform(vectors.transform(shapes)).select(
        "held_out", "code", "kind", "label", "n", F.round(F.get(vector_to_array("probability"), F.lit(1)), 12).alias("score"))
    scored = materialize(scored, "scores")
    # bounded like the descriptions: the window of a kind holds its distinct scores
    steps = (scored.where("held_out and label is not null").groupBy("kind", "score")
             .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("hits")))
    down = Window.partitionBy("kind").orderBy(F.desc("score"))
    share = F.sum("hits").over(down) / F.sum("n").over(down)
    cuts = steps.withColumn("share", share).where(F.col("share") >= precision).groupBy("kind").agg(F.min("score").alias("cut"))
    chosen = scored.where("label is null").join(cuts, "kind").where("score >= cut").select("code", "score").distinct().collect()
    return Selector({int(r["code"]): float(r["score"]) for r in chosen})


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", precision: float = PRECISION,
         kept: list[str] | None = None) -> DataFrame:
    """All rows with ``base`` and ``spans``: arrays of (start, kind, end), kinds as numbers into KINDS.

    ``kept`` are the input columns to keep, all by default.
    """
    fold = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0
    kept = [c for c in kept or docs.columns if c not in ("base", "spans")]
    found = materialize(docs.select(
        F.struct(*kept).alias("row"), fold.alias("held_out"), base_spans(F.col(text)).alias("base"),
        candidates(F.col(text)).alias("candidates")), "candidates")
    chosen = fit(found, precision).scores
    none = F.array().cast(f"array<{SPAN}>")
    if chosen:
        codes, scores = F.lit(list(chosen)), F.lit(list(chosen.values()))

        def score(c: Column) -> Column:
            return F.get(scores, F.array_position(codes, c["code"]).cast("int") - 1)

        undecided = F.filter("candidates", lambda c: c["label"].isNull() & F.array_contains(codes, c["code"]))
        rated = F.transform(undecided, lambda c: F.struct(
            c["start"].alias("start"), (-score(c)).alias("rank"), c["kind"].alias("kind"), c["end"].alias("end")))
        # candidates of one run share its start: the first of them in order of rank stays
        ordered = F.array_sort(rated)
        first = let(ordered, lambda r: F.filter(r, lambda c, i: (i == 0) | (F.get(r, i - 1)["start"] != c["start"])))
        added = F.transform(first, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    else:
        added = none
    return found.select("row.*", "base", F.array_sort(F.array_distinct(F.concat("base", added))).alias("spans"))


def listed(spans: str | Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.lit(list(KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(found: DataFrame, text: str = "text", out: str = "redacted") -> DataFrame:
    """The texts of :func:`find` with every span replaced by its kind in brackets; overlapping spans become one.

    A piece is cut out by its place in the text, so the work of a row is its spans times its length.
    """
    none = F.array().cast(f"array<{SPAN}>")
    # merge: a span that begins before the last one's end only extends it
    merged = F.aggregate("spans", none, lambda a, s: F.when(
        (F.size(a) > 0) & (F.element_at(a, -1)["end"] > s["start"]),
        F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
            F.element_at(a, -1)["start"].alias("start"), F.element_at(a, -1)["kind"].alias("kind"),
            F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end"))))).otherwise(F.concat(a, F.array(s))))
    names = F.lit([k.upper() for k in KINDS])

    def cut(m: Column) -> Column:
        begin = lambda i: F.coalesce(F.get(m, i - 1)["end"], F.lit(0))
        pieces = F.transform(m, lambda s, i: F.concat(
            F.substring(F.col(text), begin(i) + 1, s["start"] - begin(i)), F.lit("["), F.get(names, s["kind"]), F.lit("]")))
        last = F.coalesce(F.get(m, F.size(m) - 1)["end"], F.lit(0))
        return F.concat(F.array_join(pieces, ""), F.substring(F.col(text), last + 1, F.length(F.col(text))))

    return found.withColumn(out, let(merged, cut))
