"""MinHash near-duplicate detection with odd sketches (operator 4).

Method. Every text becomes its set of distinct 5-word shingles. Equal sets are one node (grouped by a
128-bit digest of the set, the smallest doc_id stands for it), so copies are never compared. A node
gets 160 MinHash samples: 40 bands of 4 make candidate keys, and the samples are also folded into a
512-bit odd sketch, a bitmap of parities. For two nodes the population count of the XOR of their
sketches estimates how many samples differ; at similarity s, 2 * 160 * (1 - s) samples are expected
to, and the estimate is tight for high s. Pairs whose count is far above that of 0.75 are dropped.
Candidates also carry an odd sketch of their whole set, 4096 parities: its XOR population count never
exceeds the size d of the symmetric difference, and similarity 0.75 means 7 d <= |A| + |B|, so this
second test drops pairs without any error. (Folded to 1024 parities, which never counts more, the same
test is made first: it drops most pairs of small sets.) What passes is confirmed on the full sets.

Within a band key no list of all pairs is made. First each member is paired with one leader of its
key (the smallest, then one of those not linked to it); the confirmed links are merged into connected
components, and a key whose members are in one component is done. At last the members that are not in
their key's largest component are paired with the members of other components, with the sketch tests
inside the join. So a group of n
near copies costs about n comparisons, and no link between different texts is lost: a pair of
similarity 0.75 or more misses all 40 bands with a probability below 3e-7.

Defined results: text null, empty or without words - n_shingles 0, linked with nothing, its own
component. doc_id null - linked with nothing, component_id null, kept. Rows repeated with the same
doc_id are one document, whatever their texts: each row is returned, with its own n_shingles and the one component of all of them, so
that two groups that share a doc_id are one. Extra columns are ignored here; ``deduplicate`` carries them along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, col, free_name, slices
from .graph import components
from .text_sets import WordNumbers, mix, shingles

BANDS, ROWS, SKETCH_BITS, FOLD_BITS, SET_BITS = 40, 4, 512, 1024, 4096
THRESHOLD = 75  # of 100
#: Differing sketch bits up to which a pair is confirmed on its sets. At similarity 0.75 about 80 of
#: the 160 samples of either side differ (deviation 11), which sets 69 bits (deviation 9); 120 is beyond 5 deviations.
MAX_BITS = 120
_RNG = np.random.default_rng(40_4)
_MUL = _RNG.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_XOR = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_BAND_COEF = _RNG.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SAMPLE = np.arange(BANDS * ROWS, dtype=np.uint64) << np.uint64(32)


def minhash(numbers: np.ndarray) -> np.ndarray:
    """160 MinHash samples (32 bits each) of a shingle set, in blocks that fit the cache."""
    x = (numbers >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        block = (x[None, i : i + 512] ^ _XOR[:, None]) * _MUL[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return least


def band_keys(samples: np.ndarray) -> np.ndarray:
    keys = (samples.reshape(BANDS, ROWS).astype(np.uint64) * _BAND_COEF).sum(axis=1, dtype=np.uint64)
    return mix(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def parities(elements: np.ndarray, size: int) -> np.ndarray:
    """Bitmap of ``size`` (a power of two) parities of well mixed 64-bit elements, as longs."""
    bits = (elements >> np.uint64(65 - size.bit_length())).astype(np.int64)
    return np.packbits((np.bincount(bits, minlength=size) & 1).astype(np.uint8)).view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Odd sketch of the (position, sample) elements, as 8 longs."""
    return parities(mix(_SAMPLE | samples), SKETCH_BITS)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordNumbers()
    for batch in slices(batches):
        fps, sizes, bands, sketches = [], [], [], []
        for text in batch.column(1).to_pylist():
            found = shingles(text, words)
            sizes.append(len(found))
            if len(found):
                samples = minhash(found)
                fps.append(xxhash.xxh3_128_digest(found.tobytes()))
                bands.append(band_keys(samples))
                sketches.append(odd_sketch(samples))
            else:
                fps.append(None)
                bands.append(None)
                sketches.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(fps, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())),
             pa.array(sketches, pa.list_(pa.int64()))], ["doc_id", "fp", "n_shingles", "bands", "odd"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordNumbers()
    for batch in slices(batches):
        nodes, sets, bitmaps, folds = [], [], [], []
        for node, fp, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            found = shingles(text, words)
            if len(found) and xxhash.xxh3_128_digest(found.tobytes()) == fp:
                nodes.append(node)
                sets.append(found.view(np.int64))
                bitmaps.append(parities(found, SET_BITS))
                folds.append(np.bitwise_xor.reduce(bitmaps[-1].reshape(-1, FOLD_BITS // 64), axis=0))
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), *(pa.array(x, longs) for x in (sets, folds, bitmaps))],
                                         ["node", "items", "fold", "parity"])


def _differing(a: str, b: str, size: int) -> Column:
    """Population count of the XOR of two bitmaps."""
    counts = [F.bit_count(col(a)[i].bitwiseXOR(col(b)[i])) for i in range(size // 64)]
    return sum(counts[1:], counts[0])


def _near() -> Column:
    """Size and sketch tests of (odd, fold, parity, n) against (odd2, ..., n2), the cheapest first."""
    both = F.col("n") + F.col("n2")
    sizes = (4 * F.col("n") >= 3 * F.col("n2")) & (4 * F.col("n2") >= 3 * F.col("n"))
    return (sizes & (_differing("odd", "odd2", SKETCH_BITS) <= MAX_BITS) & (7 * _differing("fold", "fold2", FOLD_BITS) <= both)
            & (7 * _differing("parity", "parity2", SET_BITS) <= both))


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of distinct (u, v) pairs those with 100 * intersection >= 75 * union, on the full sets."""
    left = sets.select(F.col("node").alias("u"), F.col("items").alias("_a"))
    right = sets.select(F.col("node").alias("v"), F.col("items").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    joined = pairs.join(left, "u").join(right, "v")
    return joined.where(100 * both >= THRESHOLD * (F.size("_a") + F.size("_b") - both)).select("u", "v").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept (see the module's docstring)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dup")
    given = docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text"))
    signed = scratch.stage(given.mapInArrow(
        _signatures, "doc_id long, fp binary, n_shingles long, bands array<long>, odd array<long>"), "signed")

    linked = signed.where("doc_id is not null and fp is not null")
    first = scratch.stage(linked.groupBy("fp").agg(F.min("doc_id").alias("doc")), "first")
    # a doc_id with several texts may be the smallest of several sets: all but one of them get a number beyond all doc_ids
    shared_doc = first.groupBy("doc").agg(F.min("fp").alias("own"), F.max("fp").alias("other")).where("own < other").select("doc", "own")
    beyond = F.xxhash64("fp").bitwiseAND((1 << 61) - 1).bitwiseOR(1 << 62)
    first = scratch.stage(first.join(shared_doc, "doc", "left").select("fp", "doc", F.when(F.col("own") < F.col("fp"), beyond).otherwise(F.col("doc")).alias("node")), "numbered")
    nodes = scratch.stage(
        linked.join(first, "fp").where("doc_id = doc").select("node", "doc", "fp", "bands", "odd"), "nodes")
    # texts of one doc_id are linked
    several = linked.groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select("doc_id")
    texts = linked.join(several, "doc_id", "left_semi").select("doc_id", "fp").distinct().join(first.select("fp", "node"), "fp")
    least = texts.groupBy("doc_id").agg(F.min("node").alias("u"))
    same_doc = scratch.stage(texts.join(least, "doc_id").where("u < node").select("u", F.col("node").alias("v")).distinct(), "same-doc")

    # keys that at least two nodes share, and their members
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    members = scratch.stage(keyed.join(shared, "key").select("key", "node"), "members")
    wanted = members.select("node").distinct()
    candidates = nodes.join(wanted, "node", "left_semi")
    sets = scratch.stage(
        given.join(candidates.select("node", "doc", "fp"), given.doc_id == F.col("doc")).select("node", "fp", "text")
        .mapInArrow(_sets, "node long, items array<long>, fold array<long>, parity array<long>"), "sets")
    sketch = candidates.select("node", "odd").join(sets.select("node", "fold", "parity", F.size("items").alias("n")), "node")
    sketch = scratch.stage(sketch, "sketch")
    mates = sketch.select(*(F.col(c).alias(c + "2") for c in sketch.columns))
    scratch.drop("nodes")

    # stars: each member against one leader of its key, the smallest, then the one of least hash among the
    # members apart from their key's main component (a round only saves work: what is open is compared below)
    links = tested = None
    live = members.select("key", "node", F.col("node").alias("c"), F.lit(True).alias("apart"))
    for round_no, rank in enumerate((F.col("node"), F.xxhash64("node"))):
        leaders = live.where("apart").groupBy("key").agg(F.min(F.struct(rank.alias("rank"), F.col("node").alias("node2"), F.col("c").alias("c2"))).alias("l"))
        star = live.join(leaders.select("key", "l.node2", "l.c2"), "key").where("c <> c2").select("node", "node2").distinct()
        pairs = star.join(sketch, "node").join(mates, "node2").where(_near())
        pairs = pairs.select(F.least("node", "node2").alias("u"), F.greatest("node", "node2").alias("v")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["u", "v"], "left_anti")
        pairs = scratch.stage(pairs, f"pairs-{round_no}")
        found = scratch.stage(_confirm(pairs, sets), f"links-{round_no}")
        tested = pairs if tested is None else tested.unionByName(pairs)
        if links is not None and found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        live = _open_keys(members, components(links, scratch, f"comp-{round_no}"), scratch, round_no)

    # what is still open: members outside of their key's largest component, against all of other components
    live = live.join(sketch, "node")
    other = live.select(*(F.col(c).alias(c + "2") for c in live.columns))
    once = ~F.col("apart2") | (F.col("node") < F.col("node2"))
    open_pair = (F.col("key") == F.col("key2")) & (F.col("c") != F.col("c2")) & once & _near()
    rest = live.where("apart").join(other, open_pair)
    rest = rest.select(F.least("node", "node2").alias("u"), F.greatest("node", "node2").alias("v")).distinct()
    rest = scratch.stage(rest.join(tested, ["u", "v"], "left_anti"), "pairs-rest")
    links = links.unionByName(scratch.stage(_confirm(rest, sets), "links-rest")).unionByName(same_doc)
    comp = scratch.stage(components(links, scratch, "comp"), "components")
    scratch.drop("members", "sketch", "sets")

    node_of = first.join(comp, "node", "left").select("fp", F.coalesce("comp", "node").alias("c"))
    out = signed.select("doc_id", "fp", "n_shingles").join(node_of, "fp", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _open_keys(members: DataFrame, comp: DataFrame, scratch: Scratch, round_no: int) -> DataFrame:
    """Members (key, node) of the keys whose members are in several components, with their component c and
    whether they are apart from the component that has most members of the key."""
    placed = members.join(comp, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("c"))
    several = placed.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.mode("c").alias("major")).where("c0 < c1")
    marked = placed.join(several.select("key", "major"), "key").withColumn("apart", F.col("c") != F.col("major")).drop("major")
    return scratch.stage(marked, f"open-{round_no}")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one row for each group of near duplicates.

    A row with a null doc_id stays. Of rows that repeat a doc_id one stays, one with the smallest text (null first).
    """
    own, place = free_name(docs, "_kept_id"), free_name(docs, "_place")
    kept = near_duplicates(docs, id_col, text_col).where("kept and doc_id is not null").select(F.col("doc_id").alias(own)).distinct()
    w = Window.partitionBy(col(id_col)).orderBy(col(text_col))
    some = docs.join(kept, col(id_col).cast("long") == F.col(own), "left_semi")
    some = some.withColumn(place, F.row_number().over(w)).where(F.col(place) == 1).drop(place)
    return some.unionByName(docs.where(col(id_col).isNull()))
