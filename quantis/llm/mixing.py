"""Mixing sources to target weights (operator 4).

Tokens (words) are summed per source, the corpus total is shared over the
sources by weight, and each source gets a repetition rate target / size.  A
document is emitted floor(rate) times, plus once more when a number in [0, 1)
hashed from the seed and the document falls below the fraction of the rate.
The hash makes reruns and retried tasks agree.

Targets stop at ``max_repeat`` times the source's size; the excess is shared
again by weight among the other sources until none is above (water filling).

Defined cases: a null text has size 0; a null source is one source of its
own, ranked last; a null document id is hashed as such together with the
text; equal rows get equal draws; sources without words have target 0 and
their documents no copies; an empty table gives an empty result; a document
column with the name of a column added here is replaced in the result of
``with_copies`` and kept as it is by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quantis.llm.work import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Sources up to this many (with names of up to 1 KB each: 16 MB) are
#: broadcast; more are joined on a salted key.
BROADCAST_SOURCES = 16_384
BROADCAST_NAME_BYTES = 1_024
SALTS = 64


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int, id_col: str, text_col: str) -> Column:
    """Uniform number in [0, 1), a function of the seed, the id and the text."""
    row = F.concat_ws(
        ":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))),
    )
    return F.conv(F.substring(F.md5(row), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def measure(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """Adds ``size``, ``draw`` and the source's join key to every document."""
    return docs.withColumns(
        {
            "size": n_words(F.col(text_col)),
            "draw": draw(seed, id_col, text_col),
            "source_null": F.col(source_col).isNull(),
            "source_key": F.coalesce(F.col(source_col), F.lit("")),
        }
    )


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their position by code point, null last.  Each range of
    names is numbered on its own and shifted by the sizes of the ranges before
    it, so that no task sees all sources."""
    order = ["source_null", "source_key"]
    numbered = cut(
        sources.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("n", F.monotonically_increasing_id())
    )
    part = F.shiftrightunsigned("n", 33)
    before = numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = before.select(
        "part",
        F.coalesce(F.sum("rows").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("shift"),
    )
    here = numbered.withColumn("part", part)
    return here.join(before, "part").withColumn("rank", F.col("shift") + F.col("n") - F.shiftleft("part", 33))


def targets(measured: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """One row per source: ``source_size``, ``target`` and ``rate``.

    Only scalar sums reach the driver.  A round of sharing caps the sources
    whose share passes ``max_repeat`` times their size; the level rises from
    round to round and stays once no further source is capped.
    """
    sources = measured.groupBy("source_null", "source_key").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = cut(
        _ranked(sources).select(
            "source_null", "source_key", "source_size", weight.cast("double").alias("weight"),
            (F.col("source_size") * max_repeat).cast("double").alias("most"),
        )
    )
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        capped = F.col("weight") * F.lit(level) >= F.col("most")
        most, free = table.agg(
            F.coalesce(F.sum(F.when(capped, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)),
        ).first()
        now = (total - most) / free if free else level
        if now <= level:
            break
        level = now
    target = F.least(F.col("weight") * F.lit(level), F.col("most"))
    return table.select(
        "source_null", "source_key", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
    )


def _join_sources(measured: DataFrame, plan: DataFrame) -> DataFrame:
    """Joins the sources to the documents: broadcast within the checked bound,
    otherwise on a salted key, so that a hot source is spread over tasks."""
    plan = cut(plan)
    n, longest = plan.agg(F.count(F.lit(1)), F.max(F.octet_length("source_key"))).first()
    key = ["source_null", "source_key"]
    if n <= BROADCAST_SOURCES and (longest or 0) <= BROADCAST_NAME_BYTES:
        return measured.join(F.broadcast(plan), key)
    salted = measured.withColumn("salt", F.pmod(F.hash("draw"), F.lit(SALTS)))
    copies = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*key, "salt"]).drop("salt")


def with_copies(measured: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """Adds ``source_size``, ``target``, ``rate`` and ``copies`` to measured
    documents."""
    joined = _join_sources(measured, targets(measured, weights, max_repeat))
    whole = F.floor("rate")
    copies = (whole + (F.col("draw") < F.col("rate") - whole).cast("long")).cast("long")
    return joined.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("long"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, seed: int = 0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, with
    the columns of ``docs``."""
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(id_col).alias("id"), F.col(text_col).alias("body"), F.col(source_col).alias("origin"),
    )
    taken = with_copies(measure(packed, "id", "body", "origin", seed), weights, max_repeat)
    times = taken.filter("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return times.select("doc.*")


def report(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, seed: int = 0) -> DataFrame:
    """What the mix takes of each document, without its text."""
    narrow = docs.select("doc_id", "text", "source")
    measured = cut(
        measure(narrow, "doc_id", "text", "source", seed).select("doc_id", "size", "draw", "source_null", "source_key")
    )
    return with_copies(measured, weights, max_repeat).select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
        (F.col("size") * F.col("copies")).alias("taken"), "copies",
    )
