"""N-gram Jaccard join: a grouped prefix join over word shingles.

1. Shingles get one global order: by how often their hash bucket occurs in all documents (a sketch of
   ``SKETCH`` counters over the whole table, so its size is fixed), then by hash. The order is the same
   everywhere, which is all that prefix filtering needs; rare shingles come first.
2. Documents with the same shingle set are one *node*; nodes with the same prefix and size are one
   *group*. Postings are made per group; a shingle that no other group of similar size has in its prefix
   can be in no intersection with a prefix that ends no earlier, so of the prefix that ends first only the
   others count. A pair of groups is formed only at shingles that can be the first they share: the one
   before it differs, the rest of both sets is long enough, and a signature tells enough of what the prefix
   that ends first has and the other lacks. Bitmaps of the whole sets of their members bound what a pair
   can share; what remains is verified on the whole sets.
3. Groups of copies would give all pairs of their members. So each group is first compared with one
   other: of the hubs of its posting lists, the one it shares most with. What verifies is contracted
   to components. Then all remaining pairs are taken whose nodes are in different components. A list
   has at most one component that holds most of its postings; postings of the others (outsiders) meet
   the list, so a list of copies costs nothing any more. No link between components is left out.

A pair is linked when ``100 * intersection >= threshold * union``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm import kernels
from roadlens.llm.components import stars
from roadlens.llm.frames import map_batches, masked, small_batches, stored, table, unmasked

THRESHOLD = 90
WORDS = 3
SKETCH = 1 << 18
SKETCH_ROWS = 64
FILTER_BITS = 23
#: What a posting of a group says: its place in the prefix, the shared shingles before it (the last of them, their number),
#: the most that can be common, and a signature of the shared shingles of the prefix from it on.
POSTING = ("grp", "n", "last", "pos", "at", "before", "most", "sig0", "sig1")


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and ordered distinct shingle hashes of every text that has words."""
    for block in kernels.blocks(column):
        w = kernels.words(block, kernels.LOWERED)
        edges = kernels.row_bounds(w.row, block.rows)
        hashes, at = kernels.windows(w.hash, w.row, n)
        parts = np.searchsorted(at, edges)
        for i in range(block.rows):
            if parts[i + 1] > parts[i]:
                own = np.sort(hashes[parts[i] : parts[i + 1]])
                keep = np.ones(len(own), dtype=bool)
                keep[1:] = own[1:] != own[:-1]
                yield block.first + i, own[keep]
            elif edges[i + 1] > edges[i]:
                few = w.hash[edges[i] : edges[i + 1]]
                yield block.first + i, kernels.windows(few, np.zeros(len(few), dtype=np.int64), len(few))[0]


def sketch(docs: DataFrame, n: int) -> np.ndarray:
    """The level of every hash bucket: 0 for the usual number of occurrences, more for frequent ones."""
    width = SKETCH // SKETCH_ROWS
    shift = np.uint64(64 - (SKETCH.bit_length() - 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, dtype=np.int64)
        for batch in batches:
            for block in kernels.blocks(batch.column(0)):
                w = kernels.words(block, kernels.LOWERED)
                hashes, _ = kernels.windows(w.hash, w.row, n)
                counts += np.bincount((hashes >> shift).astype(np.int64), minlength=SKETCH)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SKETCH_ROWS), pa.int32()), pa.array([c.tobytes() for c in counts.reshape(SKETCH_ROWS, width)])],
            names=["part", "counts"],
        )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, dtype=np.int64)
        for counts in table.column("counts").to_pylist():
            total += np.frombuffer(counts, dtype=np.int64)
        return pa.table({"part": table.column("part")[:1], "counts": pa.array([total.tobytes()])})

    small_batches(docs.sparkSession)
    schema = "part int, counts binary"
    rows = docs.select("text").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()
    total = np.zeros((SKETCH_ROWS, width), dtype=np.int64)
    for part, counts in rows:
        total[part] = np.frombuffer(counts, dtype=np.int64)
    counts = total.ravel()
    usual = max(counts.mean(), 1.0)
    return np.clip(np.round(4 * np.log2(np.maximum(counts, 1) / usual)), 0, 255).astype(np.uint8)


def prefixes(docs: DataFrame, level: np.ndarray, n: int, threshold: int) -> DataFrame:
    """Per document: id, number of shingles, node (digest of the set), group (short digest of size and
    prefix), the prefix as packed hashes and the place of its last shingle in the order. Documents
    without words have no node."""
    levels = docs.sparkSession.sparkContext.broadcast(level)
    shift = np.uint64(64 - (SKETCH.bit_length() - 1))
    schema = "doc_id long, row_key long, n int, node binary, grp long, last long, prefix binary"

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = batch.num_rows
        sizes = np.zeros(rows, dtype=np.int32)
        nodes, groups, ends, heads = ([None] * rows for _ in range(4))
        for row, own in shingle_sets(batch.column("text"), n):
            size = len(own)
            order = (levels.value[own >> shift].astype(np.uint64) << np.uint64(56)) | (own >> np.uint64(8))
            length = size - -(-threshold * size // 100) + 1
            first = np.argsort(order, kind="stable")[:length]
            head = own[first].tobytes()
            sizes[row] = size
            nodes[row] = xxhash.xxh3_128_digest(own.tobytes())
            groups[row] = xxhash.xxh3_64_intdigest(head + size.to_bytes(8, "little")) - (1 << 63)
            ends[row] = int(order[first[-1]]) - (1 << 63)
            heads[row] = head
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("row_key"), pa.array(sizes),
                pa.array(nodes, pa.binary()), pa.array(groups, pa.int64()), pa.array(ends, pa.int64()),
                pa.array(heads, pa.binary()),
            ],
            names=["doc_id", "row_key", "n", "node", "grp", "last", "prefix"],
        )

    return map_batches(docs, schema, cut)


def postings(groups: DataFrame) -> DataFrame:
    """A row per group and prefix shingle with its place in the prefix."""
    schema = "token long, grp long, n int, last long, pos int"

    def spread(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        heads = batch.column("prefix")
        length = pc.binary_length(heads).to_numpy(zero_copy_only=False).astype(np.int64) // 8
        tokens = np.frombuffer(b"".join(heads.to_pylist()), dtype=np.int64)
        owner = np.repeat(np.arange(batch.num_rows), length)
        pos = (np.arange(len(tokens)) - np.repeat(np.cumsum(length) - length, length)).astype(np.int32)
        grp, n, last = (batch.column(c).to_numpy() for c in ("grp", "n", "last"))
        for at in range(0, len(tokens), 200_000):
            own = owner[at : at + 200_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tokens[at : at + 200_000]), pa.array(grp[own]), pa.array(n[own]),
                    pa.array(last[own]), pa.array(pos[at : at + 200_000]),
                ],
                names=["token", "grp", "n", "last", "pos"],
            )

    return map_batches(groups.select("grp", "n", "last", "prefix"), schema, spread)


def _may_be_first(a: str, b: str, threshold: int) -> F.Column:
    """Whether the shingle of two postings can be the first that their sets share, and the sets similar
    enough. The first common shingle of similar sets always passes, so no pair is lost.

    What stands before the shingle is then in one set alone, so the shingles before it (``before``) differ and
    what is common is at most the rest behind its place ``pos``. Of the prefix that ends first, ``at`` shared shingles
    lie before it; of those from here on, one that the other lacks is not in the other set either: the bits
    only its signature has. ``most`` counts what of the set can be shared with prefixes that end no earlier.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = F.floor((threshold * (n + m) + 99 + threshold) / (100 + threshold))

    def bound(first: str, other: str) -> F.Column:
        lost = F.col(f"{first}.at")
        for word in ("sig0", "sig1"):
            lost = lost + F.bit_count(F.col(f"{first}.{word}").bitwiseAND(F.bitwise_not(F.col(f"{other}.{word}"))))
        return F.col(f"{first}.most") - lost >= need

    enough = F.when(F.col(f"{a}.last") <= F.col(f"{b}.last"), bound(a, b)).otherwise(bound(b, a))
    places = (n - F.col(f"{a}.pos") >= need) & (m - F.col(f"{b}.pos") >= need)
    fresh = F.coalesce(F.col(f"{a}.before") != F.col(f"{b}.before"), F.lit(True))
    return fresh & (100 * n >= threshold * m) & (100 * m >= threshold * n) & places & enough


def key_bits(keys: DataFrame, column: str):
    """A broadcast bit map of fixed size over 64-bit keys; a bit may stand for several keys."""
    bits = keys.select(F.pmod(column, F.lit(1 << FILTER_BITS)).alias("b"))
    maps = bits.groupBy(F.floor(F.col("b") / 32768).cast("int").alias("part")).agg(
        F.bitmap_construct_agg(F.pmod("b", F.lit(32768))).alias("bits")
    )
    whole = np.zeros((1 << FILTER_BITS) // 32768 * 4096, dtype=np.uint8)
    for part, data in maps.collect():
        whole[part * 4096 : (part + 1) * 4096] = np.frombuffer(bytes(data), dtype=np.uint8)
    return keys.sparkSession.sparkContext.broadcast(whole)


def in_bits(bits: np.ndarray, keys: pa.Array) -> np.ndarray:
    key = keys.to_numpy() & ((1 << FILTER_BITS) - 1)
    return (bits[key >> 3] >> (key & 7)) & 1 == 1


def bitmap(own: np.ndarray) -> bytes:
    """A bit for every shingle of a set, four to eight times as many bits as shingles."""
    marks = np.zeros(1 << max(6, (4 * len(own) - 1).bit_length()), dtype=bool)
    marks[(kernels.mix(own) & np.uint64(len(marks) - 1)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little").tobytes()


def may_share(one: np.ndarray, two: np.ndarray, n: int, m: int) -> int:
    """The most that sets of ``n`` and ``m`` shingles with these bitmaps can have in common: a bit that only one
    has is a shingle of its own. The wider bitmap is folded to the width of the other."""
    a, b = one.view(np.uint64), two.view(np.uint64)
    while len(a) != len(b):
        if len(a) > len(b):
            a = a[: len(a) // 2] | a[len(a) // 2 :]
        else:
            b = b[: len(b) // 2] | b[len(b) // 2 :]
    return min(n - int(np.bitwise_count(a & ~b).sum()), m - int(np.bitwise_count(b & ~a).sum()))


def wanted(docs: DataFrame, nodes: DataFrame, n: int, pack: Callable[[np.ndarray], bytes]) -> DataFrame:
    """What ``pack`` makes of the shingle sets of ``nodes`` (node, key of a row that has it), read again from the
    documents: node, size of the set, packed.

    A bit map over the rows' keys spares the others the work; the join is what decides.
    """
    shared = key_bits(nodes, "row_key")

    def sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = batch.filter(pa.array(in_bits(shared.value, batch.column("row_key"))))
        names, sizes, values = [], [], []
        for _, own in shingle_sets(found.column("text"), n):
            names.append(xxhash.xxh3_128_digest(own.tobytes()))
            sizes.append(len(own))
            values.append(pack(own))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array(sizes, pa.int32()), pa.array(values, pa.binary())],
            names=["node", "n", "packed"],
        )

    read = map_batches(docs.select("row_key", "text"), "node binary, n int, packed binary", sets)
    return read.join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(
        F.first("n").alias("n"), F.first("packed").alias("packed")
    )


def tested(pairs: DataFrame, sets: DataFrame, threshold: int, common: Callable[..., int]) -> DataFrame:
    """The node pairs (u, v) that are similar enough if they share ``common(packed, packed, size, size)``."""
    both = (
        pairs.join(sets.select(F.col("node").alias("u"), F.col("n").alias("n"), F.col("packed").alias("one")), "u")
        .join(sets.select(F.col("node").alias("v"), F.col("n").alias("m"), F.col("packed").alias("two")), "v")
        .select("u", "v", "n", "m", "one", "two")
    )

    def test(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(batch.num_rows, dtype=bool)
        sizes = zip(batch.column("n").to_pylist(), batch.column("m").to_pylist(), strict=True)
        for i, (one, two, (n, m)) in enumerate(zip(batch.column("one"), batch.column("two"), sizes, strict=True)):
            c = common(np.frombuffer(one.as_buffer(), dtype=np.uint64), np.frombuffer(two.as_buffer(), dtype=np.uint64), n, m)
            keep[i] = 100 * c >= threshold * (n + m - c)
        yield batch.select(["u", "v"]).filter(pa.array(keep))

    return map_batches(both, "u binary, v binary", test)


def shared_shingles(a: np.ndarray, b: np.ndarray, n: int, m: int) -> int:
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _of(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes (node, row_key) of ``pairs``."""
    named = nodes.select("node", "row_key")
    ends = [named.join(pairs.select(F.col(c).alias("node")), "node", "left_semi") for c in ("u", "v")]
    return ends[0].unionByName(ends[1]).distinct()


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, threshold: int) -> DataFrame:
    """The linked of ``pairs``: bitmaps, a sixteenth to an eighth of the sets, rule out most; whole sets decide."""
    close = stored(tested(pairs, wanted(docs, _of(pairs, nodes), n, bitmap), threshold, may_share), "jaccard-close")
    whole = wanted(docs, _of(close, nodes), n, lambda own: own.tobytes())
    return stored(tested(close, whole, threshold, shared_shingles), "jaccard-links")


def _pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).unionByName(
        right.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    ).distinct()


def classes(
    docs: DataFrame, threshold: int = THRESHOLD, n: int = WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, row_key (hash of id and text), n_shingles, component_id and component
    (a name for it that is never shared; null where there are no words).

    Rows with the same set are one node, whatever their ids; component_id is the smallest id that can
    be reached over links, itself included. Null, empty and wordless texts have no shingles and are
    their own component; a null id counts only where no row of the component has one. Ids are cast to
    long. An empty table gives an empty result.
    """
    named = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).alias("row_key"),
        F.col(f"`{text_col}`").alias("text"),
    )
    rows = stored(prefixes(named, sketch(named, n), n, threshold), "jaccard-rows")
    nodes = stored(
        rows.filter("node is not null")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"), F.min("row_key").alias("row_key"), F.first("grp").alias("grp"),
            F.first("n").alias("n"), F.first("last").alias("last"),
        ),
        "jaccard-nodes",
    )
    # the short digest is not trusted: groups that differ in size or last shingle are posted apart
    groups = nodes.groupBy("grp", "n", "last").agg(F.min("row_key").alias("row_key"))
    posted = postings(rows.join(groups, ["grp", "n", "last", "row_key"], "left_semi"))
    # of a list, only groups of similar size can be paired: in order of size, those with such a neighbour
    of_token = Window.partitionBy("token")
    less, more = F.lag("n").over(of_token.orderBy("n")), F.lead("n").over(of_token.orderBy("n"))
    paired = F.coalesce(100 * less >= threshold * F.col("n"), F.lit(False)) | F.coalesce(
        100 * F.col("n") >= threshold * more, F.lit(False)
    )
    prefix = Window.partitionBy("grp", "n", "last")
    from_end = prefix.orderBy(F.col("pos").desc())
    behind = F.floor((F.col("n") * threshold + 99) / 100) - 1
    bit = F.expr("shiftleft(1L, cast(token & 63 as int))")
    shared = stored(
        posted.withColumn("paired", paired).filter("paired")
        .withColumn("size", F.count("*").over(of_token))
        .withColumn("at", (F.count("*").over(prefix) - F.row_number().over(from_end)).cast("int"))
        .withColumn("before", F.lead("token").over(from_end))
        .withColumn("most", (F.count("*").over(prefix) + behind).cast("int"))
        .withColumn("sig0", F.bit_or(F.when(F.col("token").bitwiseAND(64) == 0, bit).otherwise(0)).over(from_end))
        .withColumn("sig1", F.bit_or(F.when(F.col("token").bitwiseAND(64) != 0, bit).otherwise(0)).over(from_end))
        .select("token", *POSTING, "size"),
        "jaccard-postings",
    )
    members = nodes.select("grp", "node")

    # linear: every group with one hub, every node with the first of its group. Of a list, the group
    # with the most neighbours over all its lists is the hub: the original among its copies.
    central = shared.groupBy("grp").agg(F.sum("size").alias("near"))
    ranked = shared.join(central, "grp")
    hubs = ranked.groupBy("token").agg(F.max(F.struct("near", *POSTING)).alias("hub"))
    best = (
        shared.alias("own").join(hubs, "token")
        .filter((F.col("hub.grp") != F.col("own.grp")) & _may_be_first("hub", "own", threshold))
        .groupBy(F.col("own.grp").alias("gb"), F.col("hub.grp").alias("ga"))
        .agg(F.count("*").alias("c"))
        .groupBy("gb")
        .agg(F.max_by("ga", F.struct("c", "ga")).alias("ga"))
    )
    first = members.groupBy("grp").agg(F.min("node").alias("first"))
    to_hub = (
        best.join(first.select(F.col("grp").alias("ga"), F.col("first").alias("u")), "ga")
        .join(members.select(F.col("grp").alias("gb"), F.col("node").alias("v")), "gb")
    )
    in_group = members.join(first, "grp").filter("node != first").select(F.col("first").alias("u"), F.col("node").alias("v"))
    asked = stored(_pairs(to_hub, in_group), "jaccard-pairs")
    links = _links(asked, nodes, named, n, threshold)
    part = stars(links)

    # what is left: nodes of one list or group in different components
    labelled = stored(
        nodes.select("grp", "node").join(part.toDF("node", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node")),
        "jaccard-labels",
    )
    of_group = labelled.groupBy("grp").agg(F.min("comp").alias("comp"), (F.min("comp") != F.max("comp")).alias("mixed"))
    known = shared.drop("size").join(of_group, "grp")
    shares = known.groupBy("token", "comp").agg(F.count("*").alias("c"), F.max("mixed").alias("mixed"))
    ruling = shares.groupBy("token").agg(
        F.max_by("comp", F.struct("c", "comp")).alias("ruler"), F.count("*").alias("kinds"), F.max("mixed").alias("mixed")
    ).filter("kinds > 1 or mixed").select("token", "ruler")
    open_lists = stored(
        known.join(ruling, "token").withColumn("outside", (F.col("comp") != F.col("ruler")) | F.col("mixed")), "jaccard-open"
    )
    meet = open_lists.filter("outside").alias("a").join(open_lists.alias("b"), F.col("a.token") == F.col("b.token")).filter(
        (F.col("a.grp") != F.col("b.grp"))
        & (~F.col("b.outside") | (F.col("a.grp") < F.col("b.grp")))
        & ((F.col("a.comp") != F.col("b.comp")) | F.col("a.mixed") | F.col("b.mixed"))
        & _may_be_first("a", "b", threshold)
    )
    # which of the two is the outsider may change from list to list
    left = meet.select(F.least("a.grp", "b.grp").alias("ga"), F.greatest("a.grp", "b.grp").alias("gb")).distinct()
    one = labelled.select(F.col("grp").alias("ga"), F.col("node").alias("u"), F.col("comp").alias("cu"))
    two = labelled.select(F.col("grp").alias("gb"), F.col("node").alias("v"), F.col("comp").alias("cv"))
    across = left.join(one, "ga").join(two, "gb").filter("cu != cv").select("u", "v")
    mixed = of_group.filter("mixed").select(F.col("grp").alias("ga"))
    inside = one.join(mixed, "ga").join(two, F.col("ga") == F.col("gb")).filter("u < v and cu != cv").select("u", "v")
    rest = stored(_pairs(across, inside).join(asked, ["u", "v"], "left_anti"), "jaccard-rest")
    part = stars(part.unionByName(_links(rest, nodes, named, n, threshold)))

    labels = nodes.select("node", "doc_id").join(
        part.withColumnRenamed("u", "node").withColumnRenamed("v", "comp"), "node", "left"
    ).withColumn("comp", F.coalesce("comp", "node"))
    smallest = labels.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of_node = labels.join(smallest, "comp").select("node", F.struct("component_id", "comp").alias("_found"))
    return rows.select("doc_id", "row_key", "n", "node").join(of_node, "node", "left").select(
        "doc_id", "row_key", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("_found").isNull(), F.col("doc_id")).otherwise(F.col("_found.component_id")).alias("component_id"),
        F.col("_found.comp").alias("component"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id. Wordless rows all stay.

    Only rows of components with several rows, found by a bit map over their keys, are joined with the
    decision; the others pass without a shuffle. Of repeated rows that are chosen one stays.
    """
    rows, names = masked(docs)
    found = stored(
        classes(rows, id_col=names[id_col], text_col=names[text_col], **options)
        .filter("component is not null")
        .select("doc_id", "row_key", "component"),
        "jaccard-classes",
    )
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    several = found.groupBy("component").agg(F.count("*").alias("size"), F.min(order).alias("best")).filter("size > 1")
    suspects = stored(
        found.join(several, "component")
        .select(F.col("row_key").alias("__suspect"), (F.col("row_key") == F.col("best.row_key")).alias("__keep"))
        .distinct(),
        "jaccard-suspects",
    )
    bits = key_bits(suspects, "__suspect")
    keyed = rows.withColumn("__key", F.xxhash64(F.col(names[id_col]).cast("long"), F.col(names[text_col])))

    def part(hit: bool) -> DataFrame:
        def choose(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            yield batch.filter(pa.array(in_bits(bits.value, batch.column("__key")) == hit))

        return map_batches(keyed, keyed.schema, choose)

    judged = part(True).join(suspects, F.col("__key") == F.col("__suspect"), "left")
    apart = judged.filter("__keep is null")
    chosen = judged.filter("__keep").dropDuplicates(["__key"])
    kept = part(False).unionByName(apart.select(keyed.columns)).unionByName(chosen.select(keyed.columns))
    return unmasked(kept, names)


def op1_jaccard(spark, sf_dir) -> DataFrame:
    """All documents: 3-word shingles, similarity of 0.9 and more."""
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
