"""MinHash near-duplicates with sequential Bayesian verification (operator 2).

A document's set holds its distinct runs of ``shingle`` words (A-Z in lower
case).  Two documents are linked if 100 * intersection >= percent * union.

1. Every document gets its set's size, a digest of the set (its *node*: exact
   copies share one) and ``BANDS * ROWS`` MinHash values.
2. Nodes that agree on all values of a band are candidates.  A pair at the
   limit of 0.8 is missed by all bands with a probability of 3e-6.
3. Every bucket names its most central node (the one that shares most buckets)
   as centre; each member is compared with it.  What is not linked to the
   largest part of its cluster of buckets is then compared with the rest of
   the cluster, in blocks of bounded size.  Only these documents are compared
   with many others, and only links that join two parts are emitted, never
   pairs within a group.
4. A comparison reads the signatures in batches.  After each batch the
   posterior probability (uniform prior) that the similarity reaches the limit
   is bounded; a pair below ``MISS`` is dropped, and the survivors are
   verified on their full sets.
5. Components of the verified links name the classes.

Defined cases: null and empty texts, and texts without words, have an empty
set, size 0, and are linked with nothing; with fewer words than a shingle the
whole sequence is the only member; equal rows share a node; null ids never are
a component's name unless it has no other, then the name is null; an empty
table gives an empty result.  Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quantis.llm.components import components
from quantis.llm.wordbatch import U64, Words, distinct, mix, run_hash, sequence_hash, split_words, word_hash
from quantis.llm.work import bounded_batches, cut, cut_alone, forget, give_up_shuffles, release

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Signature values compared before each decision, and the chance at which a
#: pair that reaches the limit may be dropped by one.
BATCH, MISS = 32, 1e-6
#: Members compared with one centre in a group, and nodes in a block.
MEMBERS, BLOCK = 512, 2_048
#: Bits of the filter that keeps texts of candidates (8 MB, whatever the input).
FILTER_BITS = 1 << 26

_rng = np.random.Generator(np.random.PCG64(20_240_101))
MULTIPLY = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint64) | U64(1)).astype(np.uint32)
ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)


def sets(w: Words, shingle: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a slice."""
    h = word_hash(w)
    runs = run_hash(h, shingle)
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= shingle:
            yield distinct(runs[a : b - shingle + 1])
        elif b > a:
            yield sequence_hash(h[a:b])
        else:
            yield runs[:0]


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash values of a set, 16 bits of each."""
    x = (found >> U64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(x), 512):
        np.minimum(least, (x[a : a + 512, None] * MULTIPLY + ADD).min(axis=0), out=least)
    return (least ^ (least >> np.uint32(16))).astype(np.uint16)


@lru_cache(maxsize=8)
def least_matches(percent: int) -> tuple[int, ...]:
    """For each batch: fewest equal values so far with which the posterior
    chance of reaching the limit is ``MISS`` or more.  With a uniform prior it
    is P(Binomial(n + 1, limit) <= m) after m of n matches."""
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        below = np.cumsum([comb(n + 1, j) * t**j * (1 - t) ** (n + 1 - j) for j in range(n + 1)])
        out.append(int(np.argmax(below >= MISS)))
    return tuple(out)


def survivors(one: np.ndarray, others: np.ndarray, percent: int) -> np.ndarray:
    """Positions in ``others`` that no batch rules out, most similar first."""
    left, matches = np.arange(len(others)), np.zeros(len(others), np.int64)
    for k, least in enumerate(least_matches(percent)):
        span = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (others[left, span] == one[span]).sum(axis=1)
        keep = matches >= least
        left, matches = left[keep], matches[keep]
        if not len(left):
            break
    return left[np.argsort(-matches, kind="stable")]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the limit."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sign(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for w in split_words(batch.column("text"), lower=True):
                node, size, sign = [], [], []
                for s in sets(w, shingle):
                    node.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                    size.append(len(s))
                    sign.append(signature(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(w.row, w.n_docs), pa.array(node, pa.binary()), pa.array(size, pa.int64()), pa.array(sign, pa.binary())],
                    names=["id", "node", "n_shingles", "sign"],
                )
        release()

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each band of each node."""
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        sign = np.frombuffer(b"".join(batch.column("sign").to_pylist()), np.uint16).reshape(n, BANDS, ROWS).astype(U64)
        key = np.zeros((n, BANDS), U64) + np.arange(1, BANDS + 1, dtype=U64)
        for r in range(ROWS):
            key = mix(key * U64(0x9E3779B97F4A7C15) + sign[:, :, r])
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.ravel().view(np.int64)), batch.column("node").take(pa.array(np.repeat(np.arange(n), BANDS)))], names=["band", "node"]
        )


def candidates(nodes: DataFrame) -> DataFrame:
    """(centre, node): each member of a bucket with the bucket's centre."""
    bands = nodes.select("node", "sign").mapInArrow(_bands, "band long, node binary")
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = cut(bands.join(shared, "band"))
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    centre = (
        members.join(weight, "node").groupBy("band").agg(F.max(F.struct("weight", "node")).alias("top"))
        .select("band", F.col("top.node").alias("centre"))
    )
    return cut(members.join(centre, "band").filter("node != centre").select("centre", "node").distinct())


def _filter_bit(id_):
    return F.pmod(F.xxhash64(id_), F.lit(FILTER_BITS))


def _nodes_of(column: pa.Array, shingle: int) -> pa.Array:
    """Node of each text of a batch."""
    found = [hashlib.md5(x.tobytes()).digest() if len(x) else None for w in split_words(column, lower=True) for x in sets(w, shingle)]
    return pa.array(found, pa.binary())


def _with_that_set(shingle: int):
    """Rows whose text has the set that is asked for: an id may stand for
    several texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pc.equal(_nodes_of(batch.column("text"), shingle), batch.column("node")))
        release()

    return run


def _node_rows(shingle: int, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = _nodes_of(batch.column("row").field(text_col), shingle)
            yield pa.RecordBatch.from_arrays([batch.column("row"), node], names=["row", "node"])

    return run


def candidate_texts(texts: DataFrame, nodes: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """One text for each wanted node, with its signature.

    A bitmap of fixed size tells the ids of most other texts before the
    shuffle; the join by id settles the rest, and only the texts that are left
    are hashed again."""
    chosen = cut(nodes.join(wanted, "node", "left_semi").withColumn("bit", _filter_bit("id")))
    bits = chosen.groupBy(F.bitmap_bucket_number("bit").alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    # a page of 2**15 bits each: at most FILTER_BITS / 2**15 rows, broadcast as a join side of at most 8 MB
    marked = texts.withColumn("bit", _filter_bit("id"))
    page, place = F.bitmap_bucket_number("bit"), F.bitmap_bit_position("bit")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(byte, cast(bitmap_bit_position(bit) % 8 as int)) & 1") == 1
    likely = marked.withColumn("page", page).join(F.broadcast(bits), "page").withColumn("byte", byte).filter(hit).select("id", "text")
    right = chosen.select("node", F.col("id").alias("i"), "sign")
    found = likely.join(right, F.col("id").eqNullSafe(F.col("i"))).select("node", "sign", "text")
    checked = found.mapInArrow(_with_that_set(shingle), "node binary, sign binary, text string")
    return cut(checked.dropDuplicates(["node"]))


class Group:
    """Nodes of a group with signatures and sets, each node once."""

    def __init__(self, table: pa.Table, shingle: int):
        names = table["node"].to_pylist()
        rows = list(dict(zip(reversed(names), reversed(range(len(names))), strict=True)).values())
        table = table.take(pa.array(sorted(rows)))
        self.table = table
        self.node: list[bytes] = table["node"].to_pylist()
        self.sign = np.frombuffer(b"".join(table["sign"].to_pylist()), np.uint16).reshape(-1, HASHES)
        self.sets = [s for w in split_words(table["text"], lower=True) for s in sets(w, shingle)]
        self.size = np.array([len(s) for s in self.sets])

    def candidates(self, i: int, among: np.ndarray, percent: int) -> np.ndarray:
        n = self.size[among]
        among = among[(100 * np.minimum(n, self.size[i]) >= percent * np.maximum(n, self.size[i]))]
        return among[survivors(self.sign[i], self.sign[among], percent)]


def _links(pairs: list[tuple[bytes, bytes]]) -> pa.Table:
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.binary()), "b": pa.array([p[1] for p in pairs], pa.binary())})


def _with_centre(shingle: int, percent: int):
    """Members of a group that are similar to its centre."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        g, centre = Group(table, shingle), key[0].as_py()
        i = g.node.index(centre)
        found = g.candidates(i, np.delete(np.arange(len(g.node)), i), percent)
        return _links([(centre, g.node[j]) for j in found if similar(g.sets[i], g.sets[j], percent)])

    return run


def star_links(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Verified links of members with their centres; a centre's members are
    dealt over groups of about ``MEMBERS``."""
    groups = pairs.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts"))
    member = pairs.join(groups, "centre").select("centre", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node")
    centre = groups.select("centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("centre").alias("node"))
    rows = member.union(centre).join(texts, "node")
    return rows.groupBy("centre", "part").applyInArrow(_with_centre(shingle, percent), "a binary, b binary")


def _in_block(shingle: int, percent: int):
    """Links between parts (labels) of a cluster: documents outside the
    largest part with all others of the block."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        g = Group(table, shingle)
        label, minor = g.table["label"].to_pylist(), np.array(g.table["minor"].to_pylist(), bool)
        chunk, apart = g.table["chunk"].to_numpy(), key[1].as_py() != key[2].as_py()
        parent = {x: x for x in label}

        def root(x: bytes) -> bytes:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        links, done = [], np.zeros(len(label), bool)
        for i in np.flatnonzero(minor).tolist():
            done[i] = True
            # a chunk is compared with itself in its own block only
            others = ~done & (chunk != chunk[i]) if apart else ~done
            for j in g.candidates(i, np.flatnonzero(others), percent):
                a, b = root(label[i]), root(label[j])
                if a != b and similar(g.sets[i], g.sets[j], percent):
                    parent[a] = b
                    links.append((g.node[i], g.node[j]))
        return _links(links)

    return run


def part_links(clusters: DataFrame, labels: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links between different parts of a cluster.

    The documents outside a cluster's largest part (its minor ones) meet all
    others.  Clusters are cut into blocks: minor and major documents each into
    chunks, and every chunk of minor ones meets every chunk of either kind, so
    a group never holds more than about two chunks."""
    named = clusters.join(labels, "node", "left").select(
        "node", F.col("cluster"), F.coalesce("label", "node").alias("label")
    )
    sizes = named.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
    # written, so that the join deals the documents through an exchange of its own and a large cluster can be split
    top = cut(sizes.groupBy("cluster").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("parts")
    ).filter("parts > 1"))
    rows = named.join(
        top.select(
            "cluster", F.col("top.label").alias("largest"),
            F.ceil(F.col("top.n") / BLOCK).cast("int").alias("majors"),
            F.ceil((F.col("all") - F.col("top.n")) / BLOCK).cast("int").alias("minors"),
        ),
        "cluster",
    ).withColumn("minor", F.col("label") != F.col("largest"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("minor"), F.col("minors")).otherwise(F.col("majors"))).cast("int")
    rows = rows.withColumn("own", own).withColumn("chunk", F.when(F.col("minor"), own).otherwise(own + F.col("minors")))
    # block (i, j): minor chunk i with minor chunk j >= i, or with major chunk j - minors
    of_minor = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("minors") + F.col("majors") - 1), lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j")))
    )
    of_major = F.transform(F.sequence(F.lit(0), F.col("minors") - 1), lambda i: F.struct(i.alias("i"), (F.col("own") + F.col("minors")).alias("j")))
    dealt = rows.withColumn("block", F.explode(F.when(F.col("minor"), of_minor).otherwise(of_major)))
    ready = dealt.select("cluster", "block.i", "block.j", "node", "label", "minor", "chunk").join(texts, "node")
    return ready.groupBy("cluster", "i", "j").applyInArrow(_in_block(shingle, percent), "a binary, b binary")


def classes(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """For each document: ``id_col``, ``n_shingles``, ``component_id`` (the
    least id of its class) and ``node`` (a digest of its set, null if empty)."""
    with bounded_batches(docs.sparkSession):
        return _classes(docs, shingle, percent, id_col, text_col)


def _classes(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    signed = cut(texts.mapInArrow(_sign(shingle), f"id {kind}, node binary, n_shingles long, sign binary"))
    nodes = cut(
        signed.filter("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.first("sign").alias("sign"))
    )
    pairs = candidates(nodes)
    wanted = pairs.select("node").union(pairs.select(F.col("centre").alias("node"))).distinct()
    found = candidate_texts(texts, nodes, wanted, shingle)
    give_up_shuffles(docs.sparkSession)
    near = cut(star_links(pairs, found, shingle, percent))
    clusters = components(pairs, "centre", "node").select("node", F.col("label").alias("cluster"))
    between = cut_alone(part_links(clusters, components(near, "a", "b"), found, shingle, percent))
    labels = components(near.union(between), "a", "b")
    labelled = signed.drop("sign").join(labels, "node", "left").withColumn("class", F.coalesce("label", "node"))
    # written, so that the join reads it through an exchange of its own and a hot class can be split
    names = cut_alone(labelled.filter("class is not null").groupBy("class").agg(F.min("id").alias("name")))
    out = labelled.join(names, "class", "left")
    return out.select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("name")).alias("component_id"), "node", "class",
    )


def one_of_each(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each class, with its columns: the one with the least id
    (an id before none; of equal rows with that id, one).

    A document with an empty set is alone in its class and stays; equal rows
    of such documents all stay."""
    found = classes(docs, shingle, percent, id_col, text_col)
    members = found.filter(F.col("class").isNotNull())
    first = cut_alone(members.groupBy("class").agg(F.min(id_col).alias("chosen")))
    # the class's first id with its set; a class of null ids alone is represented by its least set
    named = members.join(first, "class").filter(F.col(id_col).eqNullSafe(F.col("chosen")))
    sized = named.groupBy("class", "node").agg(F.count(F.lit(1)).alias("rows"), F.first("chosen").alias("chosen"))
    winners = sized.groupBy("class").agg(F.min(F.struct("node", "rows", "chosen")).alias("w")).select("w.*")
    several = found.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col(id_col).alias("repeated"))
    winners = cut_alone(winners.join(several, F.col("chosen").eqNullSafe(F.col("repeated")), "left").select(
        "node", "chosen", (F.col("repeated").isNull() & F.col("chosen").isNotNull() & (F.col("rows") == 1)).alias("alone")
    ))
    return _rows_of(docs, winners, shingle, id_col, text_col)


def _rows_of(docs: DataFrame, winners: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """One row of ``docs`` for each winner (node, chosen id), and all rows with
    an empty set.  An id that stands for one row is enough to find it; rows of
    repeated ids are told apart by their sets."""
    empty_set = ~F.coalesce(F.col(f"`{text_col}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    packed = docs.filter(~empty_set).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    alone = winners.filter("alone").select("chosen")
    found = packed.join(alone, F.col("row")[id_col] == F.col("chosen"), "left_semi")
    others = winners.filter("not alone").select("chosen", F.col("node").alias("set"))
    if not others.isEmpty():
        schema = StructType().add(packed.schema["row"]).add("node", "binary")
        repeated = packed.join(others.select("chosen").distinct(), F.col("row")[id_col].eqNullSafe(F.col("chosen")), "left_semi")
        named = repeated.mapInArrow(_node_rows(shingle, text_col), schema)
        of = (F.col("node") == F.col("set")) & F.col("row")[id_col].eqNullSafe(F.col("chosen"))
        found = found.union(named.join(others, of).groupBy("node").agg(F.first("row").alias("row")).select("row"))
    return found.select("row.*").union(docs.filter(empty_set))
