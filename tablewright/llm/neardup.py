"""Near duplicates: one-permutation MinHash with optimal densification, banded buckets,
star-shaped candidate edges, and links confirmed on the full shingle sets.

A document's set is hashed once; its hashes are dealt to bins by their leading bits and
each bin keeps its least. An empty bin borrows from another one, picked by a hash of its
own number and the attempt, so that equal sets borrow alike. Rows of bins are banded, and
documents that agree in a band share a bucket. Each bucket has one centre and gives an edge
from it to every other member: as many edges as members, however large the bucket. The
centre is the member whose buckets are largest altogether, that is, the one most like the
others; so the buckets of one group of copies mostly share their centre, and its edges
count once.

A member of a star is known by how it differs from the centre: the shingles that one of
both has alone. Two members in different components are not both linked to the centre, and
if one is not, a link between them needs a number of such differences in common that follows
from the sizes, one at least. They are taken rarest first, and two members are compared as
well where one of them is the first they can share, enough are left behind it in both, and
neither sizes nor the parities of their sets exclude a link. So no link between documents of
one bucket is lost, and in a group of copies with changes of their own hardly any pair is
compared.

Documents of one and the same set are one node from the start.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tablewright.llm.common import map_rows, register, table
from tablewright.llm.components import components
from tablewright.llm.hashing import MIX, Bits, WordHashes, mixed, word_hashes
from tablewright.session import materialize

BINS, ROWS = 128, 4
WIDTH, PERCENT = 5, 80
BITS = 24  # of the filters for buckets and for documents whose sets are compared, 2 MB
CELL = 2000  # members of a bucket that one task compares with the others


def _borrowing(bins: int) -> np.ndarray:
    """borrow[t, i]: where bin i looks at attempt t while it has nothing."""
    at = np.arange(8 * bins, dtype=np.uint64)[:, None] * np.uint64(bins) + np.arange(bins, dtype=np.uint64)[None, :]
    return (mixed(at + np.uint64(1)) % np.uint64(bins)).astype(np.int64)


def shingles(hashes: WordHashes, text: str, width: int) -> np.ndarray:
    """The sorted distinct hashes of the runs of ``width`` words of the text in lower case;
    of a text with fewer words, the hash of all of them; nothing without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    return np.unique(hashes.runs(words, min(width, len(words))))


def signature(values: np.ndarray, bins: int, borrow: np.ndarray) -> np.ndarray:
    """The least hash in each bin, empty bins filled. ``values`` are sorted, not empty."""
    shift = np.uint64(64 - bins.bit_length() + 1)
    start = np.searchsorted(values, np.arange(bins, dtype=np.uint64) << shift)
    first = values[np.minimum(start, len(values) - 1)]
    filled = (start < len(values)) & ((first >> shift) == np.arange(bins, dtype=np.uint64))
    source = np.arange(bins)
    empty = np.flatnonzero(~filled)
    for looks in borrow:
        if not len(empty):
            break
        found = filled[looks[empty]]
        source[empty[found]] = looks[empty[found]]
        empty = empty[~found]
    source[empty] = np.flatnonzero(filled)[0]  # after very many attempts
    return first[source]


def sketches(docs: DataFrame, width: int = WIDTH, bins: int = BINS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, bands): ``node`` is a hash of the set, null
    for an empty one; ``bands`` has one number for each band."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))

    def make():
        hashes, borrow = word_hashes(), _borrowing(bins)
        tag = np.arange(bins // rows, dtype=np.uint64)

        def step(ids, keys, values):
            sizes, nodes, bands = [], [], []
            for text in values:
                found = shingles(hashes, text or "", width)
                sizes.append(len(found))
                if not len(found):
                    nodes.append(None)
                    bands.append(None)
                    continue
                # two sums over hashes mixed in two ways: equal sets have equal ones
                nodes.append(b"".join(int(mixed(found ^ salt).sum(dtype=np.uint64)).to_bytes(8, "big") for salt in MIX[:2]))
                of = signature(found, bins, borrow).reshape(-1, rows)
                band = tag
                for k in range(rows):
                    band = mixed(band + of[:, k] * MIX[k])
                bands.append(band.view(np.int64))
            return [ids, keys, sizes, nodes, bands]

        return step

    return map_rows(source, make, "doc_id long, text_hash long, n_shingles long, node binary, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, centre, hashes) for the ``wanted`` (node, doc_id, text_hash, centre) documents.
    Their sets are made where the texts are read, behind a filter of fixed size, so no text
    is shuffled."""
    look = Bits.of(wanted.select(F.xxhash64("doc_id", "text_hash").alias("look")), "look", BITS)
    shared = docs.sparkSession.sparkContext.broadcast(look)
    source = docs.select("_id", "_key", F.xxhash64("_id", "_key").alias("_look"), "_text")

    def make():
        hashes, filter_ = word_hashes(), shared.value

        def step(ids, keys, looks, values):
            take = np.flatnonzero(filter_.has(np.array(looks, dtype=np.int64).view(np.uint64)))
            made = [shingles(hashes, values[i] or "", width).tobytes() for i in take]
            return [[ids[i] is None for i in take], [ids[i] or 0 for i in take], [keys[i] for i in take], made]

        return step

    made = map_rows(source, make, "no_id boolean, _id long, _key long, hashes binary")
    # a document may be repeated; grouped by the keys of the join, sets move once
    made = made.groupBy("no_id", "_id", "_key").agg(F.first("hashes").alias("hashes"))
    keys = F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("text_hash").alias("_key")
    return made.join(wanted.select("node", "centre", *keys), ["no_id", "_id", "_key"]).select("node", "centre", "hashes")


def prefix(values: np.ndarray, lacks: np.ndarray, percent: int) -> np.ndarray:
    """The first hashes of a set, those in ``lacks`` before the others, of which a set that
    is linked has one among its own first."""
    length = len(values) - -(-percent * len(values) // 100) + 1
    if length > len(lacks):
        lacks = np.concatenate([lacks, np.setdiff1d(values, lacks, assume_unique=True)])
    return lacks[:length]


def parities(values: np.ndarray) -> np.ndarray:
    """Whether a set has an odd number of hashes in each of 256 bins, as four numbers. In
    how many bins two sets differ is at most the number of hashes that one of them lacks."""
    odd = np.bincount((values >> np.uint64(56)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _side_by_side(pairs: DataFrame, sets: DataFrame, others: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with _a and _b; the second of a pair has its set in ``others``."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("_a"))
    right = others.select(F.col("node").alias("b"), F.col("hashes").alias("_b"))
    return pairs.join(left, "a").join(right, "b").select(*pairs.columns, "_a", "_b")


def excess(size: int, differ: int, percent: int) -> int:
    """How far a set of ``size`` hashes, of which ``differ`` it or the centre has alone, is
    from the centre. Two sets are linked if and only if the sum of theirs is at most
    2 * (100 + percent) for each difference that they share. The centre's own is the least of
    all, -(100 - percent) for each of its hashes."""
    return (100 + percent) * differ - (100 - percent) * size


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, good, size, excess, least, odd, differ): whether the sets of a pair (a, b,
    several), the second a centre, have ``percent`` of their union in common; size, excess
    and parities of the first and the centre's excess; the hashes that one of both has alone,
    if the centre has ``several`` members."""
    rows = _side_by_side(pairs.select("a", "b", "several"), sets, sets.filter("centre"))

    def make():
        def step(a, b, several, first, second):
            out: list[list] = [a, b, [], [], [], [], [], []]
            for many, x, y in zip(several, first, second, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                differ = np.setxor1d(x, y, assume_unique=True)
                own, least = excess(len(x), len(differ), percent), excess(len(y), 0, percent)
                found = own + least <= 0, len(x), own, least, parities(x), differ.view(np.int64) if many else None
                for column, v in zip(out[2:], found, strict=True):
                    column.append(v)
            return out

        return step

    return map_rows(rows, make, "a binary, b binary, good boolean, size long, excess long, least long, odd array<long>, differ array<long>")


def _good(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are links. Only sets of their nodes are moved."""
    needed = materialize(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "needed")
    sets = sets.join(needed, "node", "left_semi")
    rows = _side_by_side(pairs, sets, sets)

    def make():
        def step(a, b, first, second):
            good = []
            for x, y in zip(first, second, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            return [[v for v, g in zip(c, good, strict=True) if g] for c in (a, b)]

        return step

    return map_rows(rows, make, "a binary, b binary")


def _across(compared: DataFrame, edges: DataFrame, percent: int, cell: int) -> DataFrame:
    """Pairs (a, b) of nodes in different components that share a star and may be linked.

    One of them, x, is not linked to the centre. Differences that only one component has in a
    star cannot be shared by such a pair and are dropped; the others are ordered by how many
    members have them, and each keeps how many are behind it, itself included. The first one
    that a pair shares has enough behind it on both sides. A difference of more than
    ``cell`` members is dealt to several tasks on one side; what is excluded never leaves
    the join.
    """
    roots = edges.select(F.col("a"), F.col("b").alias("_root"))
    members = compared.filter("differ is not null").join(roots, "a", "left").withColumn("root", F.coalesce("_root", "a"))
    several = members.groupBy("b").agg((F.min("root") != F.max("root")).alias("_open")).filter("_open").select("b")
    members = members.join(materialize(several, "several"), "b").withColumn("side", F.xxhash64("b", "a"))
    members = materialize(members.select("side", F.col("a").alias("node"), "b", "root", "good", "size", "excess", "least", "odd", "differ"), "members")
    found = members.select("side", "b", "root", F.explode("differ").alias("hash"))
    found = materialize(found.select(F.xxhash64("b", "hash").alias("band"), "side", "root"), "differences")
    counts = found.groupBy("band").agg(F.count("*").alias("_n"), (F.min("root") != F.max("root")).alias("_open")).filter("_open")
    behind = F.row_number().over(Window.partitionBy("side").orderBy(F.desc("_n"), F.desc("band")))
    shared = found.select("band", "side").join(counts.select("band", "_n"), "band").withColumn("_rest", behind)
    rest = F.col("_rest") * (2 * (100 + percent))
    rows = shared.select("band", "side", F.ceil(F.col("_n") / cell).cast("int").alias("_parts"), rest.alias("rest"))
    rows = rows.join(members.select("side", "node", "root", "good", "size", "excess", "least", "odd"), "side")
    # whether enough can be shared with any member, and with any that is not linked to the centre
    rows = rows.filter(F.col("rest") >= F.col("excess") + F.col("least")).withColumn("_any", F.col("rest") > F.col("excess") - F.col("least"))
    rows = materialize(rows.filter("_any or not good"), "open")
    both = F.struct("node", "root", "good", "size", "excess", "odd", "rest")
    left = rows.filter("not good").withColumn("_part", F.pmod(F.hash("node"), F.col("_parts"))).select("band", "_part", both.alias("x"))
    right = rows.filter("_any").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).select("band", "_part", both.alias("y"))
    once = F.col("y.good") | (F.col("x.node") < F.col("y.node"))
    enough = F.least("x.rest", "y.rest") >= F.col("x.excess") + F.col("y.excess")
    differ = sum((F.bit_count(F.col("x.odd")[k].bitwiseXOR(F.col("y.odd")[k])) for k in range(4)), F.lit(0))
    # of two linked sets, at most so many hashes of both together are in one alone
    near = differ * (100 + percent) <= (F.col("x.size") + F.col("y.size")) * (100 - percent)
    fits = F.least("x.size", "y.size") * 100 >= F.greatest("x.size", "y.size") * percent
    pairs = left.join(right, ["band", "_part"]).filter((F.col("x.root") != F.col("y.root")) & once & enough & fits & near)
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _weighed(nodes: DataFrame) -> DataFrame:
    """The members of buckets with several sets, as (band, member), each with a ``weight``:
    how many members its buckets have. In a group of copies, what they were copied from
    shares most buckets and has the largest weight. Most buckets have one member; a filter
    of fixed size holds these back before the rows are shuffled."""
    sizes = nodes.select(F.explode("bands").alias("band")).groupBy("band").agg(F.count("*").alias("_n")).filter("_n > 1")
    sizes = materialize(sizes, "sizes")
    look = nodes.sparkSession.sparkContext.broadcast(Bits.of(sizes, "band", BITS))

    def make():
        filter_ = look.value

        def step(bands, *columns):
            out: list[list] = [[] for _ in range(1 + len(columns))]
            for own, row in zip(bands, zip(*columns, strict=True), strict=True):
                own = np.array(own, dtype=np.int64)
                kept = own[filter_.has(own.view(np.uint64))].tolist()
                out[0] += kept
                for column, v in zip(out[1:], row, strict=True):
                    column += [v] * len(kept)
            return out

        return step

    kind = "node binary, doc_id long, text_hash long, n_shingles long"
    members = map_rows(nodes.select("bands", "node", "doc_id", "text_hash", "n_shingles"), make, f"band long, {kind}")
    shared = materialize(members.join(sizes, "band"), "shared")
    weights = shared.groupBy("node").agg(F.sum("_n").alias("weight"))
    return shared.join(weights, "node").select("band", F.struct("node", "doc_id", "text_hash", "n_shingles", "weight").alias("member"))


def _stars(members: DataFrame) -> DataFrame:
    """The ``members`` (band, member), each with its bucket's ``centre``, the heaviest."""
    key = F.struct("member.weight", "member.node", "member")
    return members.join(members.groupBy("band").agg(F.max(key)["member"].alias("centre")), "band")


def linked(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bins: int = BINS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) for each document.

    Documents are linked if their sets of ``width``-word shingles have at least
    ``percent`` of their union in common; ``component_id`` is the smallest doc_id that
    links lead to, and ``kept`` marks the document that has it.

    Null and wordless texts have an empty set, are linked with nothing and kept. Rows that
    repeat id and text are one document and give one row. Rows with one id and different
    texts are different documents, each with a row. Null ids are no smallest id: a
    component of null ids alone has a null component_id and one kept row. An empty table
    gives no rows. Further columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    keyed = docs.withColumn("_key", F.xxhash64("_text"))
    made = materialize(sketches(docs, width, bins, rows, "_id", "_text"), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "n_shingles")).alias("own")
    nodes = made.filter("node is not null").groupBy("node").agg(first, F.min(F.struct("node", "bands"))["bands"].alias("bands"))
    nodes = materialize(nodes.select("node", "own.doc_id", "own.text_hash", "own.n_shingles", "bands"), "nodes")
    stars = _stars(_weighed(nodes)).filter("member.node != centre.node").select("member", "centre").distinct()
    stars = materialize(stars, "stars")
    sides = stars.select("member.*", F.lit(False).alias("centre")).union(stars.select("centre.*", F.lit(True)))
    wanted = sides.groupBy("node").agg(F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.max("centre").alias("centre"))
    sets = materialize(_sets(keyed, materialize(wanted, "wanted"), width), "sets")
    pairs = stars.select(F.col("member.node").alias("a"), F.col("centre.node").alias("b"))
    pairs = pairs.join(pairs.groupBy("b").agg((F.count("*") > 1).alias("several")), "b")
    compared = materialize(_compared(pairs, sets, percent), "compared")
    edges = components(compared.filter("good").select("a", "b"))
    across = materialize(_across(compared, edges, percent, cell), "across")
    more = materialize(_good(across, sets, percent), "more")
    if not more.isEmpty():
        edges = components(edges.union(more))

    root = F.coalesce("b", "node")
    full = nodes.join(edges, F.col("node") == F.col("a"), "left").select("node", "doc_id", root.alias("root"))
    least = full.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_node = full.join(least, "root").select("node", "component_id")
    out = made.select("doc_id", "text_hash", "n_shingles", "node").distinct().join(by_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.withColumn("component_id", component)
    return out.select("doc_id", "text_hash", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@register("op7_minhash")
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of four words, as this query's contract says."""
    return linked(table(spark, sf_dir, "documents"), width=4)
