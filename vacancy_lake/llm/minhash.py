"""Near-duplicates: one-permutation MinHash, banded buckets, stars and a prefix join for candidates, links confirmed on full sets.

1. Each text becomes the set of hashes of its word shingles. One permutation splits the hashes into BINS by their
   leading bits; a bin's least hash is its sample. Empty bins borrow by optimal densification: bin i takes the sample
   of the first non-empty bin among h(i, 1), h(i, 2), ..., the same for every text.
2. Texts with equal sets form a class, whose first row stands for it. Bands of ROWS bins are bucket keys; at a
   similarity of 0.8 two sets miss all 32 bands with a probability below 1e-7.
3. In every bucket the first member is the centre; the others are compared with it alone, so a bucket of n gives n - 1
   pairs at most. Each pair is confirmed on the full sets. A second round looks only at buckets whose members are not in
   one component yet: members outside the bucket's largest component meet CENTRES of its best-linked members, which in a
   group of copies of one text are nearest to it. Pairs of large sets go by their samples first; one that these rule out
   counts as not compared. Before full sets travel, parities of the sets give a least size of their difference, which
   rules out most other pairs for certain. What is left is joined exactly: of the members of buckets still open, all pairs of different
   components that could reach the similarity, by prefixes of the sets (rare shingles first) and the places of shared
   shingles in them, each confirmed on the full sets. Whatever the stars or the samples left out is found there.
4. Components of the confirmed links, spread over the classes. Each round joins components, not nodes, so its graph is
   only as large as what the round has found.

All of it is joins and groupings; hot buckets and classes combine before the shuffle or are split as skewed joins.

Defined results: null and empty texts have no shingles and stand alone; a text with fewer words than a shingle is one
shingle; a null id is never the smallest; of rows repeated under one id the first is kept; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import begin, keep_rows, lower_words, staged, table_of
from .components import components

BINS = 128
ROWS = 4
CENTRES = 2
#: Sets from this size on go by their samples in the star rounds, of which so many must agree.
LARGE = 24
AGREE = 84
CACHED = 150_000
#: Counters of shingles, by which the exact step orders them; shingles that share one are ordered by their hashes.
COUNTERS = 1 << 20
#: Candidate lists up to this length travel to every executor (16 bytes a row); longer ones are joined by a shuffle.
BROADCAST_ROWS = 200_000


class WordHashes(dict):
    """64-bit hashes of words, kept per worker and bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = WordHashes()
table_of("minhash", _HASHES.clear)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of runs of `width` words; of the whole sequence if it is shorter."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    rolled = np.full(n, width, np.uint64)
    for i in range(width):
        rolled = mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    return np.unique(rolled)


@lru_cache(512)
def probes(block: int, bins: int) -> np.ndarray:
    """Columns 16 * block ... of the table h(bin, attempt)."""
    return np.random.default_rng((20_170, bins, block)).integers(0, bins, (bins, 16))


def signature(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One-permutation samples with empty bins densified; `hashes` sorted, distinct, not empty."""
    shift = np.uint64(64 - bins.bit_length() + 1)
    edges = np.searchsorted(hashes, np.arange(bins, dtype=np.uint64) << shift)
    full = np.append(edges[1:], len(hashes)) > edges
    out = hashes[np.minimum(edges, len(hashes) - 1)]
    empty, block = np.flatnonzero(~full), 0
    while len(empty):
        tried = probes(block % 512, bins)[empty]
        hit = full[tried]
        found = hit.any(1)
        donor = tried[np.arange(len(empty)), hit.argmax(1)]
        out[empty[found]] = hashes[edges[donor[found]]]
        empty, block = empty[~found], block + 1
    return out


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    parts = sig.reshape(-1, rows)
    keys = np.arange(1, len(parts) + 1, dtype=np.uint64)
    for i in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return keys.view(np.int64)


def sample_bytes(sig: np.ndarray) -> np.ndarray:
    """Eight bits of every sample, packed into 64-bit numbers."""
    return mixed(sig).astype(np.uint8).view(np.int64)


def parities(hashes: np.ndarray) -> np.ndarray:
    """Whether an odd number of `hashes` ends in each value of their lowest bits: two to four bits a hash, as 64-bit numbers."""
    bits = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def sketches(df: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, digest of the text, n, set_key, bands) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("minhash")
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                digests, sizes, keys, bands = [], [], [], []
                for text in part.column(1):
                    text = text.as_py()
                    found = shingles(text, width)
                    digests.append(hashlib.sha256((text or "").encode()).digest())
                    sizes.append(len(found))
                    keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                    bands.append(band_keys(signature(found)) if len(found) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                     pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "digest", "n", "set_key", "bands"])

    return df.select(id_col, text_col).mapInArrow(
        run, f"doc_id {_kind(df, id_col)}, digest binary, n long, set_key binary, bands array<long>")


def full_sets(df: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(node, n, samples, parity, shingles) for the rows of `wanted` (doc_id, set_key, node), from the texts again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                nodes, samples, odd, sets = [], [], [], []
                for node, key, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                    found = shingles(text, width)
                    if xxhash.xxh3_128_digest(found.tobytes()) == key:
                        nodes.append(node)
                        samples.append(sample_bytes(signature(found)))
                        odd.append(parities(found))
                        sets.append(found.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array(list(map(len, sets)), pa.int64()),
                     *(pa.array(x, pa.list_(pa.int64())) for x in (samples, odd, sets))], ["node", "n", "samples", "parity", "shingles"])

    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = df.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t"))
    rows = texts.join(wanted, F.col("_i").eqNullSafe(F.col("doc_id"))).select("node", "set_key", "_t")
    return rows.mapInArrow(run, "node long, n long, samples array<long>, parity array<long>, shingles array<long>")


def plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, sampled) without those whose sizes rule out the similarity; sampled is false where the samples do.

    At a similarity of 0.8 samples agree in 102 of 128 places on average, with a standard deviation of 4.5 and more for
    small sets; the few true pairs below AGREE are left to the exact step. The smallest sets are compared in any case.
    """
    for side in "ab":
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"),
                                        F.col("samples").alias(f"s{side}")), side)
    differ = F.transform(F.arrays_zip("sa", "sb"), lambda z: z["sa"].bitwiseXOR(z["sb"]))

    def folded(x: Column, *shifts: int) -> Column:
        """Any bit of a byte moved to its lowest."""
        return folded(x.bitwiseOR(F.shiftrightunsigned(x, shifts[0])), *shifts[1:]) if shifts else x

    ones = F.aggregate(differ, F.lit(0), lambda n, x: n + F.bit_count(
        folded(x, 4, 2, 1).bitwiseAND(F.lit(0x0101010101010101))).cast("int"))
    small = F.least("na", "nb") < LARGE
    sized = pairs.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return sized.select("a", "b", (small | (F.lit(percent) < 80) | (BINS - ones >= AGREE)).alias("sampled"))


def possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of `pairs` without those whose parities rule out the similarity.

    A shingle that both sets have changes both parities, so these differ in no more bits than the sets differ in shingles;
    with n and m shingles and d of them in one set only, (n + m - d) / 2 are shared. No pair that is similar is lost.
    """
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("parity").alias(f"p{side}")), side)
    words = F.least(F.size("pa"), F.size("pb"))

    def folded(parity: str) -> Column:
        """Parities by fewer bits of the hashes."""
        return F.transform(F.sequence(F.lit(0), words - 1), lambda i: F.aggregate(
            F.sequence(i, F.size(parity) - 1, words), F.lit(0).cast("long"), lambda x, j: x.bitwiseXOR(F.get(parity, j))))

    differ = F.aggregate(F.arrays_zip(folded("pa").alias("x"), folded("pb").alias("y")), F.lit(0),
                         lambda n, z: n + F.bit_count(z["x"].bitwiseXOR(z["y"])).cast("int"))
    both = F.col("na") + F.col("nb")
    return pairs.where(100 * (both - differ) >= percent * (both + differ)).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) of `pairs` whose full sets share `percent` of their union."""
    pairs = staged(possible(pairs, sets, percent), "possible")
    for side in "ab":
        used = staged(pairs.select(F.col(side).alias("node")).distinct(), "used")
        mine = sets.select("node", "shingles").join(F.broadcast(used) if used.count() <= BROADCAST_ROWS else used, "node", "left_semi")
        pairs = pairs.join(mine.select(F.col("node").alias(side), F.col("shingles").alias(f"s{side}")), side)
    n, m = F.size("sa"), F.size("sb")
    shared = F.size(F.array_intersect("sa", "sb"))
    return pairs.where(100 * shared >= percent * (n + m - shared)).select("a", "b")


def counted(sets: DataFrame) -> np.ndarray:
    """How many shingles of `sets` fall on each counter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            found = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            total += np.bincount(found & (COUNTERS - 1), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])

    rows = sets.select("shingles").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return out


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, most, firsts) of all `sets`: their size, their prefix for partners of any size, and the last place of it
    that counts for partners of their size or larger; rare shingles come first."""
    shared = sets.sparkSession.sparkContext.broadcast(counted(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, most, firsts = [], [], []
                for found in part.column(1):
                    found = found.values.to_numpy()
                    n = len(found)
                    firsts.append(found[np.lexsort((found, counts[found & (COUNTERS - 1)]))][:n - -(-percent * n // 100) + 1])
                    most.append(n - -(-2 * percent * n // (100 + percent)))
                    sizes.append(n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int32()), pa.array(most, pa.int32()), pa.array(firsts, pa.list_(pa.int64()))],
                    ["node", "n", "most", "firsts"])

    return sets.select("node", "shingles").mapInArrow(run, "node long, n int, most int, firsts array<long>")


def prefix_pairs(sets: DataFrame, left: DataFrame, percent: int) -> DataFrame:
    """(a, b) of all sets of `left` (node, label, outer) that can be `percent` similar, have different labels and one of which is
    outer.

    With the shingles of all sets in one order, two sets that share s of them share one among the first n - s + 1 of
    either, and the first one they share lies before no fewer than s places. The smaller set needs only the prefix for
    partners of its size or larger, so texts that share a passage without being similar do not meet through it. Prefixes
    are cut where the sets lie, so a fifth of them travels.
    """
    firsts = staged(prefixes(sets, percent).join(left, "node")
                    .select("node", "label", "outer", "n", "most", F.posexplode("firsts").alias("place", "shingle"))
                    .withColumn("short", F.col("place") <= F.col("most")).drop("most"), "prefixes")
    o = firsts.where("outer").select("shingle", *[F.col(c).alias(f"o_{c}") for c in ("node", "label", "n", "place", "short")])
    smaller = F.struct("n", "node") < F.struct("o_n", "o_node")
    fits = ((F.col("label") != F.col("o_label")) & F.when(smaller, F.col("short")).otherwise(F.col("o_short"))
            & ((100 + percent) * F.least(F.col("n") - F.col("place"), F.col("o_n") - F.col("o_place"))
               >= percent * (F.col("n") + F.col("o_n")))
            & (100 * F.least("n", "o_n") >= percent * F.greatest("n", "o_n")))
    return (firsts.join(o, "shingle").where(fits)
            .select(F.least("node", "o_node").alias("a"), F.greatest("node", "o_node").alias("b")).distinct())


def _shared_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, node, first node of the bucket) of buckets with two members or more; rows come sorted by both."""
    bucket = centre = None  # of the run that the batch before ended in
    shown = True  # whether its first member has been given out
    for batch in batches:
        keys = batch.column(batch.schema.get_field_index("bucket")).to_numpy()
        nodes = batch.column(batch.schema.get_field_index("node")).to_numpy()
        if not len(keys):
            continue
        goes_on = bucket is not None and keys[0] == bucket
        starts = np.flatnonzero(np.concatenate([[not goes_on], keys[1:] != keys[:-1]]))
        run = np.searchsorted(starts, np.arange(len(keys)), "right") - 1  # -1: the run from before
        firsts = nodes[starts]
        centres = np.where(run >= 0, firsts[run] if len(starts) else 0, centre if goes_on else 0)
        sizes = np.bincount(run + 1, minlength=len(starts) + 1)
        keep = np.where(run >= 0, sizes[run + 1] > 1, True)
        out = [keys[keep], nodes[keep], centres[keep]]
        if goes_on and not shown and run[0] == -1:
            out = [np.concatenate([[x], y]) for x, y in zip((bucket, centre, centre), out)]
            shown = True
        if len(starts):
            bucket, centre, shown = keys[-1], firsts[-1], sizes[-1] > 1
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["bucket", "node", "c"])


def near_groups(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
                ) -> DataFrame:
    """One row per row of `df`: doc_id, digest, n_shingles, component_id, kept."""
    rows = staged(sketches(df, width, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    classes = staged(rows.where("n > 0").groupBy("set_key").agg(F.min("row").alias("node"), F.min(order).alias("least")), "classes")
    members = rows.withColumnRenamed("row", "node").join(classes.select("node"), "node", "left_semi").select(
        "node", F.explode("bands").alias("bucket"))
    # One shuffle: sorted, a bucket is a run, however long, of which its first member is all that is remembered.
    buckets = staged(members.repartition("bucket").sortWithinPartitions("bucket", "node").mapInArrow(
        _shared_buckets, "bucket long, node long, c long"), "buckets")
    nodes = buckets.select("node").distinct()
    wanted = staged(rows.withColumnRenamed("row", "node").select("node", "doc_id", "set_key").join(nodes, "node", "left_semi"), "nodes")
    sets = full_sets(df, wanted, width, id_col, text_col)
    same = rows.select("doc_id", "set_key").join(
        wanted.select(F.col("doc_id").alias("_i"), F.col("set_key").alias("_k")),
        F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("set_key") == F.col("_k")))
    if same.count() > wanted.count():  # rows repeated under one id
        sets = sets.dropDuplicates(["node"])
    sets = staged(sets, "sets")

    labels = wanted.select("node", F.col("node").alias("label"))
    tested, degrees = None, None
    for turn in range(3):
        if turn == 0:  # the first member of each bucket is its centre
            pairs = buckets.where("node <> c").select(F.col("c").alias("a"), F.col("node").alias("b")).distinct()
        else:  # buckets whose members are in one component stay so
            sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
            current = buckets.select("bucket", "node").join(labels.join(sizes, "label"), "node")
            open_ = (current.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                                   F.max(F.struct("size", "label")).alias("main"))
                     .where("lo <> hi").select("bucket", F.col("main.label").alias("main")))
            current = buckets = staged(current.join(open_, "bucket").select("bucket", "node", "label", "main"), "open")
        if turn == 1:  # members outside the largest component meet its best-linked members
            hub = Window.partitionBy("bucket").orderBy(F.desc("degree"), "node")
            stars = (current.where("label = main").join(degrees, "node").withColumn("place", F.row_number().over(hub))
                     .where(F.col("place") <= CENTRES).select("bucket", F.col("node").alias("c"), F.col("label").alias("cl")))
            pairs = (current.where("label <> main").join(stars, "bucket").where("label <> cl")
                     .select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct())
        if turn == 2:  # all pairs of what is left; of two components in a bucket, one is not its largest
            left = current.groupBy("node", "label").agg(F.max(F.col("label") != F.col("main")).alias("outer"))
            pairs = prefix_pairs(sets, left, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs if turn == 2 else plausible(pairs, sets, percent), "pairs")
        compared = pairs if turn == 2 else pairs.where("sampled").select("a", "b")
        links = staged(confirmed(compared, sets, percent), "links")
        tested = compared if tested is None else tested.unionByName(compared)
        if turn == 0:
            degrees = links.select("a").unionByName(links.select(F.col("b").alias("a"))).groupBy("a").agg(
                F.count("*").alias("degree")).withColumnRenamed("a", "node")
        if links.isEmpty():
            continue
        for side in "ab":  # links between components
            links = links.join(labels.select(F.col("node").alias(side), F.col("label").alias(f"l{side}")), side)
        merged = components(links.select(F.col("la").alias("a"), F.col("lb").alias("b")))
        merged = merged.select(F.col("node").alias("label"), F.col("label").alias("joined"))
        labels = staged(labels.join(merged, "label", "left").select("node", F.coalesce("joined", "label").alias("label")), "labels")

    # The first row of a component is found among its classes, so rows meet it by their class, not by component.
    known = classes.join(labels, "node", "left").withColumn("component", F.coalesce("label", "node"))
    firsts = known.groupBy("component").agg(F.min("least").alias("first"))
    known = known.join(firsts, "component").select("set_key", "first")
    return rows.select("row", "doc_id", "digest", "n", "set_key").join(known, "set_key", "left").select(
        "doc_id", "digest", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce(F.col("row") == F.col("first.row"), F.lit(True)).alias("kept"))


def keep_one(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that stay, one of each component, with all their columns."""
    return keep_rows(df, near_groups(df, width, percent, id_col, text_col), id_col, text_col)
