"""Personal data by bootstrapped contextual extraction (operator 7), in
DataFrame functions only.

Base extraction finds the four kinds by their patterns.  The found entities
are seeds: the word before and the word after a span are its *lexical
patterns*.  Other identifier-like strings (long numbers, codes with digits,
addresses written with an "at") are candidate instances with patterns of
their own.  Spark then scores the graph of patterns and instances in rounds:

* a pattern's confidence in a kind is the sum of its instances' scores
  divided by their number plus a prior, and counts only with at least
  ``support`` distinct instances of a score over the limit;
* an instance's score is 1 for a seed, otherwise 1 - product(1 - confidence)
  over its patterns.

Scores only rise from round to round, and the rounds go on until they do so no
more.  Candidates whose score then reaches the limit are added as
spans of their best kind, if they pass that kind's check (digits, Luhn sum);
so are occurrences of seeds that the base patterns missed, such as a number
that runs into other digits.  Base spans always stay.  Words that stand beside
anything, such as articles, never reach the limit, because they surround
strings of every kind and of none.

Positions are code points, ends exclusive.  Match positions are running sums
of the lengths between matches, by a window over one text's matches, so that
texts with very many matches cost linear time.  Repeated groups in the
patterns are possessive, which Java matches without recursion.

Defined cases: null and empty texts have no spans; equal rows share their
result; null ids stay; an empty table gives an empty result; other columns
are passed through by ``redact`` whatever their names, and not read by
``extract``.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quantis.llm.work import cut, cut_alone

# Kinds in the order of results, with their patterns.  A match
# can only begin where a run of its first characters begins (or where the
# match before ended); the lookbehinds say so and save scanning runs again.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for any kind or candidate.
NEEDED = r"[0-9@+]|[(\[]at[)\]]"
#: Identifier-like strings: phone and card numbers that run into other digits
#: (base matches that failed), addresses, numbers with separators, codes.
CANDIDATE = (
    r"\+[0-9]{1,3}[\x20.-]?[(]?[0-9]{2,4}[)]?(?:[\x20.-]?[0-9]{2,4}){2}(?![0-9])"
    r"|(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9])"
    r"|(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"
    r"|[(]?[0-9][0-9()./\x20-]{3,}[0-9]"
    r"|(?<![A-Za-z0-9])[A-Za-z]*+[0-9][A-Za-z0-9]{5,}"
)
PART_OF_IP = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:[.]|$)){4}$"
SUPPORT, LIMIT, PRIOR = 3, 0.8, 1.0
#: Rounds end when no score rises by more than this; beyond so many rounds a warning says that some still do.
QUIET, ROUNDS = 1e-3, 40


def row_key(id_col: str, text_col: str) -> Column:
    """Names a row by its id and text; equal rows have equal results."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.coalesce(text_col, F.lit(""))))


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        double = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(PART_OF_IP)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _word(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))


#: The first word of a text.
FIRST_WORD = r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)"


def matches(texts: DataFrame, pattern: str) -> DataFrame:
    """Leftmost non-overlapping matches of each text (key, text): key, start,
    stop, match, and the words before and after it.

    The words are cut from the gaps between the matches, each with the match
    beyond it, so a text costs time in proportion to its length however many
    matches it has."""
    found = texts.withColumn("match", F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).filter(F.size("match") > 0)
    found = found.withColumn("gap", F.split("text", pattern, -1))

    def part(match: Column, i: Column) -> Column:
        gap, none = F.get("gap", i), F.lit("")
        before = F.concat(F.when(i > 0, F.get("match", i - 1)).otherwise(none), gap)
        after = F.concat(F.get("gap", i + 1), F.coalesce(F.get("match", i + 1), none))
        left = F.reverse(F.regexp_extract(F.reverse(before), FIRST_WORD, 1))
        return F.struct(
            F.length(gap).alias("gap"), match.alias("match"), _word(left).alias("left"), _word(F.regexp_extract(after, FIRST_WORD, 1)).alias("right")
        )

    parts = found.select("key", F.posexplode(F.transform("match", part)).alias("i", "part"))
    so_far = W.partitionBy("key").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    size = F.length("part.match")
    stop = F.sum(F.col("part.gap") + size).over(so_far)
    return parts.select("key", (stop - size).alias("start"), stop.alias("stop"), "part.match", "part.left", "part.right")


def base_spans(texts: DataFrame) -> DataFrame:
    """The valid matches of every kind, with their ``kind``."""
    kinds = [
        matches(texts, PATTERNS[k]).withColumn("kind", F.lit(k)).filter(_valid(k, F.col("match"))) for k in KINDS
    ]
    return reduce(DataFrame.union, kinds)


def with_patterns(spans: DataFrame) -> DataFrame:
    """Adds the lexical patterns of each span: the word before and the word
    after it, and its shape."""
    shape = F.regexp_replace(F.regexp_replace("match", "[0-9]", "9"), "[A-Za-z]", "a")
    pattern = F.array(F.concat(F.lit("before "), "left"), F.concat(F.lit("after "), "right"), F.concat(F.lit("shape "), shape))
    return spans.withColumn("patterns", F.filter(pattern, lambda p: ~p.isin("before ", "after "))).drop("left", "right")


def without_overlaps(found: DataFrame, spans: DataFrame) -> DataFrame:
    """Matches that share no place with a span of their text.

    A match overlaps a span that begins before its end if the furthest end of
    all such spans lies beyond its start: a running maximum over the text's
    places, instead of comparing every match with every span."""
    ends = spans.select("key", F.col("start").alias("at"), F.lit(1).alias("span"), F.col("stop").alias("reach"))
    asked = found.select("*", F.col("stop").alias("at"), F.lit(0).alias("span"))
    both = asked.unionByName(ends, allowMissingColumns=True)
    before = W.partitionBy("key").orderBy("at", "span").rowsBetween(W.unboundedPreceding, 0)
    marked = both.withColumn("reach", F.max("reach").over(before)).filter("span = 0")
    return marked.filter(F.coalesce(F.col("reach") <= F.col("start"), F.lit(True))).select(*found.columns)


def discover(
    spans: DataFrame, texts: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, limit: float = LIMIT, prior: float = PRIOR
) -> DataFrame:
    """Spans (key, kind, start, stop) of unseen identifiers."""
    apart = without_overlaps(matches(texts, CANDIDATE), spans)
    seeds = with_patterns(spans)
    unseen = with_patterns(apart.withColumn("kind", F.lit(None).cast("string")))
    marked = cut_alone(seeds.unionByName(unseen).withColumn("instance", F.lower("match")))
    edges = cut(marked.select("instance", "kind", F.explode("patterns").alias("pattern")).distinct())
    # what every round reads is made once, and a round's shuffles go with it: their small files are many where tasks are
    # a seed of several kinds counts for each of them
    fixed = cut(marked.filter("kind is not null").select("instance", "kind", F.lit(1.0).alias("score")).distinct())
    loose = cut(
        edges.filter("kind is null").select("instance", "pattern").join(fixed.select("instance").distinct(), "instance", "left_anti")
    )
    links = cut(edges.select("instance", "pattern").distinct())
    sizes = cut_alone(links.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")))
    scores, rise = fixed, 1.0
    for number in range(rounds + 1):
        if rise <= QUIET:
            break
        if number == rounds:
            warnings.warn(f"scores still rise after {rounds} rounds: identifiers that only further rounds reach are not found", stacklevel=2)
            break
        confidence = (
            links.join(scores, "instance").groupBy("pattern", "kind")
            .agg(F.sum("score").alias("sum"), F.sum((F.col("score") >= limit).cast("int")).alias("sure"))
            .filter(F.col("sure") >= support).join(sizes, "pattern")
            .select("pattern", "kind", (F.col("sum") / (F.col("n") + prior)).alias("confidence"))
        )
        found = (
            loose.join(confidence, "pattern").groupBy("instance", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.999999)))))).alias("score"))
        )
        before, scores = scores.withColumnRenamed("score", "was"), cut_alone(fixed.union(found))
        gained = scores.join(before, ["instance", "kind"], "left").agg(F.max(F.col("score") - F.coalesce("was", F.lit(0.0))))
        rise = gained.first()[0] or 0.0
    best = (  # with the seeds, for occurrences that the base missed
        scores.groupBy("instance")
        .agg(F.max(F.struct("score", "kind")).alias("top")).filter(F.col("top.score") >= limit)
        .select("instance", F.col("top.kind").alias("found"))
    )
    valid = reduce(Column.__or__, [(F.col("found") == k) & _valid(k, F.col("match")) for k in KINDS])
    chosen = marked.filter("kind is null").join(best, "instance").filter(valid)
    return chosen.select("key", F.col("found").alias("kind"), "start", "stop")


def spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All spans of the distinct rows that may hold any: key, kind, start,
    stop and whether the base found it."""
    some = docs.filter(F.col(text_col).rlike(NEEDED)).select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    texts = cut(some.dropDuplicates(["key"]))
    base = cut_alone(base_spans(texts))
    more = discover(base, texts)
    return cut_alone(
        base.select("key", "kind", "start", "stop", F.lit(True).alias("base"))
        .union(more.select("key", "kind", "start", "stop", F.lit(False).alias("base")))
    )


def _listed(rows: Column) -> Column:
    """kind:start:stop of sorted spans, comma-joined."""
    return F.array_join(
        F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def _number(rows: Column, kind: str) -> Column:
    return F.size(F.filter(rows, lambda s: s["kind"] == kind)).cast("long")


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each document: ``id_col``, the numbers of base spans by kind, and
    the base spans and all spans as sorted text."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    listed = (
        spans(docs, id_col, text_col).groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct(order.alias("order"), "start", "stop", "kind", "base"))).alias("all"))
        .withColumn("first", F.filter("all", lambda s: s["base"]))
        .select(
            "key",
            *[_number(F.col("first"), k).alias(f"n_{k}") for k in KINDS],
            _listed(F.col("first")).alias("base_spans"), _listed(F.col("all")).alias("spans"),
        )
    )
    # rows without a candidate find nothing; a key of their own spreads them over the tasks of the join
    apart = F.concat(F.lit("none "), F.xxhash64(F.col(id_col), F.col(text_col)).cast("string"))
    named = docs.select(F.col(id_col), F.when(F.col(text_col).rlike(NEEDED), row_key(id_col, text_col)).otherwise(apart).alias("key"))
    out = named.join(listed, "key", "left")
    return out.select(
        id_col, *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.coalesce("base_spans", F.lit("")).alias("base_spans"), F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; spans that
    overlap become one, named after the first."""
    found = spans(docs, id_col, text_col)
    reached = F.max("stop").over(W.partitionBy("key").orderBy("start", "stop").rowsBetween(W.unboundedPreceding, -1))
    fresh = found.withColumn("new", (F.col("start") >= F.coalesce(reached, F.lit(-1))).cast("int"))
    island = F.sum("new").over(W.partitionBy("key").orderBy("start", "stop").rowsBetween(W.unboundedPreceding, 0))
    merged = (
        fresh.withColumn("island", island).groupBy("key", "island")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min_by("kind", F.struct("start", "stop", "kind")).alias("kind"))
    )
    holes = merged.groupBy(F.col("key").alias("hole_key")).agg(F.array_sort(F.collect_list(F.struct("start", "stop", "kind"))).alias("holes"))
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.when(F.col(text_col).rlike(NEEDED), row_key(id_col, text_col)).alias("key"),
    )
    h, text = F.col("holes"), F.col("row")[text_col]
    pieces = F.transform(
        h,
        lambda s, i: F.concat(
            F.substring(text, F.when(i > 0, F.get(h, i - 1)["stop"]).otherwise(F.lit(0)) + 1, s["start"] - F.when(i > 0, F.get(h, i - 1)["stop"]).otherwise(F.lit(0))),
            F.lit("["), F.upper(s["kind"]), F.lit("]"),
        ),
    )
    last = F.element_at(h, -1)["stop"]
    clean = F.concat(F.array_join(pieces, ""), F.substring(text, last + 1, F.length(text)))
    # only rows that may hold spans are shuffled
    touched = packed.filter("key is not null").join(holes, F.col("key") == F.col("hole_key"), "left")
    replaced = touched.select(
        *[(F.when(h.isNull(), text).otherwise(clean) if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns]
    )
    return packed.filter("key is null").select("row.*").union(replaced)
