"""Near duplicates by word shingles: MinHash bands, odd sketches, exact confirmation.

Every text gets MinHash samples of its shingle set. The samples are banded to
find candidates, and folded into an odd sketch: a bitmap in which each sample
flips one bit. The population count of the XOR of two sketches estimates how
many samples differ, precisely where similarity is high; candidates whose
estimate lies far below the limit go. The others are confirmed on full sets.

Equal sets are one class from the start. Within a bucket of a band, not all pairs
are formed. First each member meets the bucket's leader, the member that shares
most buckets with others (of near copies mostly their original). Buckets that
then still hold several components are contested. Inside such a bucket every node
outside its largest component is compared with the others by set size and sketch,
block of nodes by block of nodes. Components with two nodes near by sketch form
clusters; so texts that only share boilerplate, and meet in a bucket by chance,
are in no cluster, and clusters do not grow from bucket to bucket. In a cluster
every node outside the largest component is compared with all nodes, by sketch and
then on full sets. Only links leave a block. So no link that joins two components
is lost, a group of near copies costs about one pair per member, and no task holds
more than two blocks. Every step is written to the shared folder.

With 56 bands of 6 samples a pair at the limit of 0.8 shares no band with chance
4e-8; the sketch then drops it with chance below 1e-7. A pair at 0.33 shares a
given band with chance 0.0013.

Defined cases: a text without words has an empty set, is linked with nothing and
kept; so is a row with a null id (component null). Rows that repeat an id are
separate texts. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from logtrail.llm.common import batches, maybe_in, prepare
from logtrail.llm.components import components, write_small
from logtrail.llm.wordhash import ROLL, Words, mix, records, run_hashes
from logtrail.session import write_stage

BANDS, SAMPLES_IN_BAND = 56, 6
SAMPLES = BANDS * SAMPLES_IN_BAND
SKETCH_BITS = 512
# Estimated similarity below which a candidate is not confirmed; links have 0.8 and more.
LEAST_ESTIMATE = 0.62
# Shingles in a block of a cluster, nodes in a block of a bucket, bytes of block pairs a worker gets at once.
BLOCK_SHINGLES = 1 << 16
BLOCK_NODES = 1 << 12
BATCH_BYTES = 32 << 20
_ODD = np.random.default_rng(20240229).integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(own: Words, rows: int, size: int) -> list[np.ndarray]:
    """Distinct shingle hashes, sorted, of each text; fewer words than `size` make one shingle."""
    out = []
    for row in range(rows):
        words = own.hashes_of(row)[0]
        if len(words) >= size:
            out.append(np.unique(run_hashes(words, size, ROLL[0])))
        elif len(words):
            out.append(run_hashes(words, len(words), ROLL[1]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """Samples (rows x SAMPLES) of non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), SAMPLES), np.uint64)
    for k in range(SAMPLES):
        out[:, k] = np.minimum.reduceat(flat * _ODD[k], starts)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(samples), BANDS), np.uint64)
    for k in range(SAMPLES_IN_BAND):
        keys = mix(keys * np.uint64(31) + samples[:, k::SAMPLES_IN_BAND])
    return mix(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """rows x (SKETCH_BITS / 64) words of 64 bits; each sample flips the bit it hashes to."""
    at = (mix(samples + np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    flips = np.zeros((len(samples), SKETCH_BITS), np.uint8)
    np.add.at(flips, (np.arange(len(samples))[:, None], at), 1)
    return np.packbits(flips & 1, axis=1).view(np.int64)


def most_differing_bits(least: float = LEAST_ESTIMATE) -> int:
    """XOR population count at which the estimated similarity is `least`."""
    flipped = 2 * SAMPLES * (1 - least)
    return int(SKETCH_BITS / 2 * (1 - np.exp(-2 * flipped / SKETCH_BITS)))


_SKETCH = [f"s{k}" for k in range(SKETCH_BITS // 64)]


def _described(rows: DataFrame, size: int) -> DataFrame:
    """doc, n_shingles, node (hash of the set; null if empty), bands, sketch."""

    def describe(source):
        for batch in batches(source):
            sets = shingle_sets(Words(batch.column("text"), lower=True), batch.num_rows, size)
            full = [i for i, own in enumerate(sets) if len(own)]
            nodes, bands, sketches = [None] * len(sets), [None] * len(sets), np.zeros((len(sets), len(_SKETCH)), np.int64)
            if full:
                samples = minhashes([sets[i] for i in full])
                sketches[full] = odd_sketches(samples)
                for i, keys in zip(full, band_keys(samples)):
                    nodes[i] = node_of(sets[i])
                    bands[i] = keys
            yield records(
                "doc n_shingles node bands " + " ".join(_SKETCH), batch.column("doc"), pa.array(map(len, sets), pa.int64()),
                pa.array(nodes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), *sketches.T.copy(),
            )

    kinds = ", ".join(f"{name} long" for name in _SKETCH)
    return rows.mapInArrow(describe, f"doc long, n_shingles long, node long, bands array<long>, {kinds}")


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _full_sets(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node, shingles of each wanted (doc, node)."""

    def shingles(source):
        for batch in batches(source):
            sets = shingle_sets(Words(batch.column("text"), lower=True), batch.num_rows, size)
            nodes = batch.column("node").to_pylist()
            held = [i for i, own in enumerate(sets) if len(own) and node_of(own) == nodes[i]]
            yield records(
                "node shingles", pa.array([nodes[i] for i in held], pa.int64()),
                pa.array([sets[i].view(np.int64) for i in held], pa.list_(pa.int64())),
            )

    found = maybe_in(rows, "doc", wanted).join(wanted, "doc").select("node", "text").mapInArrow(shingles, "node long, shingles array<long>")
    return found


def _differing(one: str, two: str) -> Column:
    counts = [F.bit_count(F.col(f"{one}.{name}").bitwiseXOR(F.col(f"{two}.{name}"))) for name in _SKETCH]
    return sum(counts[1:], counts[0])


def _links(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a < b) whose full sets reach the similarity."""
    near = (
        pairs.join(sketches.alias("x"), F.col("a") == F.col("x.node")).join(sketches.alias("y"), F.col("b") == F.col("y.node"))
        .where(_differing("x", "y") <= most_differing_bits()).select("a", "b")
    )
    first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("two"))
    both = near.join(first, "a").join(second, "b")
    common = F.size(F.array_intersect("one", "two"))
    return both.where(100 * common >= percent * (F.size("one") + F.size("two") - common)).select("a", "b")


def _nodes_of(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes with their component so far."""
    return nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _compared(dealt: DataFrame, group: str, compare, name: str) -> DataFrame:
    """a, b that `compare` yields for the blocks of a group, each with every block that has minor nodes; dealt: group, block, own."""
    blocks = write_stage(dealt.groupBy(group, "block").agg(F.collect_list("own").alias("own"), F.max("own.minor").alias("minors")), f"{name}-blocks")
    minors = blocks.where("minors").select(group, F.col("block").alias("i"), F.filter("own", lambda x: x["minor"]).alias("one"))
    pairs = minors.join(blocks.select(group, F.col("block").alias("j"), F.col("own").alias("two")), group)

    def run(source):
        for batch in batches(source):
            found = [pair for one, two in zip(batch.column("one"), batch.column("two")) for pair in compare(_Block(one), _Block(two))]
            yield records("a b", *[pa.array([pair[k] for pair in found], pa.int64()) for k in (0, 1)])

    spread = pairs.repartition(group, "i", "j").select("one", "two")
    return write_stage(spread.mapInArrow(run, "a long, b long").distinct(), name)


def _near_components(buckets: DataFrame, found: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of components with nodes near by sketch in a bucket; enough of them to connect all that are near."""
    meeting = _nodes_of(found, buckets).groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    contested = write_small(
        meeting.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("top"))
        .where("parts > 1").select("bucket", F.col("top.component").alias("main"), F.ceil(F.col("n") / BLOCK_NODES).alias("blocks")), "contested")
    held = write_stage(maybe_in(buckets, "bucket", contested).join(contested, "bucket"), "held")
    described = _nodes_of(found, sketches.select("node", F.col("n_shingles").alias("size"), *_SKETCH))
    dealt = held.join(described, "node").select(
        "bucket", F.pmod(F.xxhash64("node"), "blocks").alias("block"),
        F.struct("node", "component", (F.col("component") != F.col("main")).alias("minor"), "size", *_SKETCH).alias("own"),
    )
    return _compared(dealt, "bucket", lambda one, two: _near(one, two, percent), "near")


def _contested_links(buckets: DataFrame, found: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components with nodes near each other."""
    clusters = components(_near_components(buckets, found, sketches, percent))
    clusters = clusters.select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    members = _nodes_of(found, sketches.select("node", F.col("n_shingles").alias("size"), *_SKETCH)).join(clusters, "component")
    of_component = members.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    of_cluster = write_small(of_component.groupBy("cluster").agg(
        F.max(F.struct("n", "component")).alias("top"), F.ceil(F.sum("size") / BLOCK_SHINGLES).alias("blocks")
    ).select("cluster", F.col("top.component").alias("main"), "blocks"), "clusters")
    dealt = members.join(of_cluster, "cluster").join(sets, "node").select(
        "cluster", F.pmod(F.xxhash64("node"), "blocks").alias("block"),
        F.struct("node", "component", (F.col("component") != F.col("main")).alias("minor"), "size", *_SKETCH, "shingles").alias("own"),
    )
    # A block's size is bounded by BLOCK_SHINGLES on average.
    return _compared(dealt, "cluster", lambda one, two: _compare(one, two, percent), "contested-links")


class _Block:
    """Nodes of one block as arrays; shingles where they were sent along."""

    def __init__(self, rows: pa.ListScalar):
        own = rows.values
        self.node, self.component, self.size = (own.field(name).to_numpy() for name in ("node", "component", "size"))
        self.minor = own.field("minor").to_numpy(zero_copy_only=False)
        self.sketch = np.stack([own.field(name).to_numpy() for name in _SKETCH], axis=1).view(np.uint64)
        if own.type.get_field_index("shingles") >= 0:
            shingles = own.field("shingles")
            self.bounds, self.values = shingles.offsets.to_numpy(), shingles.values.to_numpy()

    def shingles(self, row: int) -> np.ndarray:
        return self.values[self.bounds[row] : self.bounds[row + 1]]


def _candidates(one: _Block, two: _Block, percent: int):
    """Pairs of rows of two blocks in two components, near by size and sketch, nearest first; told of each pair whether it is one component now."""
    heads: dict[int, int] = {}

    def head(component: int) -> int:
        while component in heads:
            component = heads[component]
        return component

    most = most_differing_bits()
    for i in range(len(one.node)):
        other = (two.component != one.component[i]) & (~two.minor | (two.node > one.node[i]))
        small, large = np.minimum(two.size, one.size[i]), np.maximum(two.size, one.size[i])
        other = np.flatnonzero(other & (100 * small >= percent * large))
        bits = np.bitwise_count(two.sketch[other] ^ one.sketch[i]).sum(axis=1)
        near = np.flatnonzero(bits <= most)
        for j in other[near[np.argsort(bits[near], kind="stable")]]:
            a, b = head(int(one.component[i])), head(int(two.component[j]))
            if a != b and (yield i, int(j)):
                heads[max(a, b)] = min(a, b)


def _near(one: _Block, two: _Block, percent: int):
    """Pairs of components; those already connected by others are not repeated."""
    found = _candidates(one, two, percent)
    pair = next(found, None)
    while pair:
        yield int(one.component[pair[0]]), int(two.component[pair[1]])
        pair = _after(found, True)


def _compare(one: _Block, two: _Block, percent: int):
    """Links between nodes of two blocks that are not in one component yet."""
    found = _candidates(one, two, percent)
    pair = next(found, None)
    while pair:
        i, j = pair
        common = len(np.intersect1d(one.shingles(i), two.shingles(j), assume_unique=True))
        linked = 100 * common >= percent * (int(one.size[i]) + int(two.size[j]) - common)
        if linked:
            yield int(one.node[i]), int(two.node[j])
        pair = _after(found, linked)


def _after(found, linked: bool):
    try:
        return found.send(linked)
    except StopIteration:
        return None


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """key, n_shingles, component_id, kept of each row. Similarity: shared shingles of all, in percent."""
    prepare(docs.sparkSession).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    described = write_stage(_described(rows, size), "described")
    linkable = described.where("doc IS NOT NULL AND node IS NOT NULL")

    places = linkable.select(F.explode("bands").alias("bucket"), "node")
    several = write_small(places.groupBy("bucket").agg(
        F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("bucket"), "several")
    buckets = write_stage(maybe_in(places, "bucket", several).join(several.hint("shuffle_hash"), "bucket").distinct(), "buckets")
    held = write_small(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "bucket-sizes")
    weights = buckets.join(held, "bucket").groupBy("node").agg(F.sum("n").alias("weight"))
    sketches = write_stage(
        linkable.join(weights, "node").groupBy("node").agg(
            F.min("doc").alias("doc"), F.min("weight").alias("weight"), F.min("n_shingles").alias("n_shingles"), *[F.min(name).alias(name) for name in _SKETCH]), "sketches")
    sets = write_stage(_full_sets(rows.where("doc IS NOT NULL"), sketches.select("doc", "node"), size).dropDuplicates(["node"]), "sets")

    weighed = buckets.join(sketches.select("node", "weight"), "node")
    leaders = write_small(weighed.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("top")).select(
        "bucket", F.col("top.node").alias("leader")), "leaders")
    pairs = buckets.join(leaders, "bucket").where("node <> leader").select(
        F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    links = write_stage(_links(pairs, sketches, sets, percent), "links")
    found = components(links.union(_contested_links(buckets, components(links), sketches, sets, percent)))

    classes = linkable.groupBy("node").agg(F.min("doc").alias("first")).join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    smallest = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    of_node = classes.join(smallest, "component").select("node", "component_id")
    rest = described.where("node IS NULL").select("node", "doc", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    out = described.where("node IS NOT NULL").select("doc", "n_shingles", "node").join(of_node, "node", "left").unionByName(rest)
    component = F.when(F.col("doc").isNotNull(), F.coalesce("component_id", "doc"))
    return out.select(
        F.col("doc").alias(key), "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"),
    )


def op8_odd_sketch(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents, size=4, percent=80)
