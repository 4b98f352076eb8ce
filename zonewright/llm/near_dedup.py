"""Near-duplicate groups by banded MinHash, odd sketches and exact confirmation.

Each distinct shingle set gets MinHash samples. Sets that agree on all samples of a
band share a bucket. The samples are also folded into an odd sketch, a bitmap of
parities: the set bits of two sketches' XOR estimate how many samples differ, most
precisely where few do. A second bitmap folds the whole set; its XOR has no more set
bits than the sets differ in, so it never turns a link down; it has at least two bits
for each element, so it tells long sets apart as well. Pairs that pass both
are confirmed on the full sets.

First each set is held against one hub of each of
its buckets, and the confirmed links are joined to components. Then only pairs of
a bucket whose components still differ are compared, inside the join, so that no
component stays apart from one it has a link to. What is written out is the pairs that the
bitmaps can't tell from links; texts of one template that don't link are compared, but not written out.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonewright.llm.common import map_texts
from zonewright.session import materialize

#: Words of a shingle, and the share of two sets' union, in percent, that links them unless another is given.
SHINGLE, PERCENT = 5, 85

#: How often a link may be in no common bucket, about once in four million, and the samples that its bands may take for that.
MISSED, MOST_SAMPLES = 2.7e-7, 200


@cache
def banding(percent: int) -> tuple[int, int]:
    """Bands and samples of a band: the longest bands that miss a link of ``percent`` no more often than ``MISSED``."""
    if not 10 <= percent <= 99:
        raise ValueError(f"{percent} percent is not from 10 to 99")
    found = ((math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** rows))), rows) for rows in range(1, MOST_SAMPLES + 1))
    return max((x for x in found if x[0] * x[1] <= MOST_SAMPLES), key=lambda x: x[1])


BANDS, ROWS = banding(PERCENT)

#: Bits of the odd sketch of the samples, and of the bitmap of the whole set, as 64-bit words.
SKETCH_WORDS, SET_WORDS = 8, 16

#: Elements up to which the bitmap of so many words is wide enough; longer sets have a second one, of at least two bits an element.
SET_ELEMENTS = 32 * SET_WORDS

#: Pairs whose estimate is so many standard deviations of the samples below a link are left out.
DEVIATIONS = 8

_RANDOM = np.random.default_rng(5)
_FACTORS = (_RANDOM.integers(0, 1 << 31, MOST_SAMPLES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_OFFSETS = _RANDOM.integers(0, 1 << 32, MOST_SAMPLES, dtype=np.uint32)
_MULTIPLIERS = _RANDOM.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IN_BAND = _RANDOM.integers(0, 1 << 63, MOST_SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = _RANDOM.integers(0, 1 << 63, 4, dtype=np.uint64)

#: Shingles whose samples are computed at once, so that the work stays in the cache.
_STRIDE = 256


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words(text: bytes) -> list[bytes]:
    """Lower-cases A to Z only and splits at ASCII white space only, as bytes do."""
    return text.lower().split()


def shingle_set(text: bytes) -> set[tuple[bytes, ...]]:
    own = words(text)
    if len(own) < SHINGLE:
        return {tuple(own)} if own else set()
    return set(zip(*(own[i:] for i in range(SHINGLE)), strict=False))


def _hashed_set(text: bytes) -> np.ndarray:
    """The set as sorted 64-bit hashes."""
    own = words(text)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    if len(own) < SHINGLE:
        short = np.full(1, len(own), np.uint64) * _SALTS[0]
        for h in hashes:
            short = _mixed(short + h)
        return short if own else hashes
    n = len(own) - SHINGLE + 1
    sums = np.zeros(n, np.uint64)
    for i, m in enumerate(_MULTIPLIERS):
        sums = _mixed(sums + hashes[i : i + n] * m)
    return np.unique(sums)


def _parities(positions: np.ndarray, n_words: int) -> list[int]:
    bits = (np.bincount(positions.astype(np.int64), minlength=64 * n_words) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64).tolist()


def _width(n: int) -> int:
    """64-bit words of the bitmap of a set of n elements, a power of two."""
    return max(SET_WORDS, 1 << (-(-n // 32) - 1).bit_length())


def signature(text: bytes, percent: int = PERCENT) -> tuple:
    """Size of the set, its identity (two hashes), band keys for links of ``percent``, odd sketch, set bitmap and its wide one, if long."""
    bands, in_band = banding(percent)
    n = bands * in_band
    elements = _hashed_set(text)
    if not len(elements):
        return 0, None, None, None, None, None, None
    high = (elements >> np.uint64(32)).astype(np.uint32)
    samples = np.full(n, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(high), _STRIDE):
        np.minimum(samples, (high[i : i + _STRIDE, None] * _FACTORS[:n] + _OFFSETS[:n]).min(0), out=samples)
    wide = samples.astype(np.uint64)
    keys = _mixed((wide.reshape(bands, in_band) * _IN_BAND[:in_band]).sum(1) + np.arange(1, bands + 1, dtype=np.uint64) * _SALTS[1])
    folded = _mixed(wide + np.arange(n, dtype=np.uint64) * _SALTS[2]) % np.uint64(64 * SKETCH_WORDS)
    identity = int(elements.sum().astype(np.int64)), int(np.bitwise_xor.reduce(_mixed(elements + _SALTS[3])).astype(np.int64))
    whole, width = elements % np.uint64(64 * SET_WORDS), _width(len(elements))
    wide = _parities(elements % np.uint64(64 * width), width) if width > SET_WORDS else None
    return len(elements), *identity, keys.astype(np.int64).tolist(), _parities(folded, SKETCH_WORDS), _parities(whole, SET_WORDS), wide


_LONGS = T.ArrayType(T.LongType())
SIGNATURE = [
    T.StructField("n_shingles", T.LongType()),
    T.StructField("set_a", T.LongType()),
    T.StructField("set_b", T.LongType()),
    T.StructField("bands", _LONGS),
    T.StructField("odd", _LONGS),
    T.StructField("parity", _LONGS),
    T.StructField("wide", _LONGS),
]


def _differing(left: str, right: str, n: int) -> Column:
    """Set bits of the XOR of two bitmaps, as one expression without a loop."""
    return sum((F.bit_count(F.col(f"{left}{i}").bitwiseXOR(F.col(f"{right}{i}"))) for i in range(1, n)),
               F.bit_count(F.col(f"{left}0").bitwiseXOR(F.col(f"{right}0"))))


def _estimate(differing: Column, percent: int) -> Column:
    """Share of samples that agree, from the set bits of the sketches' XOR."""
    bits = 64 * SKETCH_WORDS
    return 1 + bits / (4.0 * math.prod(banding(percent))) * F.log(F.greatest(1 - 2 * differing / bits, F.lit(1e-9)))


def least_estimate(percent: int) -> float:
    """An estimate that a link of ``percent`` doesn't fall below."""
    share = percent / 100
    return max(0.0, share - DEVIATIONS * math.sqrt(share * (1 - share) / math.prod(banding(percent))))


def _may_link(left: str, right: str, percent: int) -> Column:
    """False only for pairs that no link is between."""
    a, b = F.col(f"{left}n"), F.col(f"{right}n")
    sizes = (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (
        (100 + percent) * _differing(f"{left}p", f"{right}p", SET_WORDS) <= (100 - percent) * (a + b)
    )
    # the estimate falls with the number of set bits, so the bound is put as a number of bits
    most = 32 * SKETCH_WORDS * (1 - math.exp(-4.0 * math.prod(banding(percent)) * (1 - least_estimate(percent)) / (64 * SKETCH_WORDS)))
    return sizes & (_differing(f"{left}o", f"{right}o", SKETCH_WORDS) <= int(most))


def _side(side: str) -> list[Column]:
    """Columns of a representative under a prefix: id, n, o0.., p0..."""
    return [
        F.col("id").alias(f"{side}id"),
        F.col("n_shingles").alias(f"{side}n"),
        *(F.col("odd")[i].alias(f"{side}o{i}") for i in range(SKETCH_WORDS)),
        *(F.col("parity")[i].alias(f"{side}p{i}") for i in range(SET_WORDS)),
    ]


def _at_widths(members: DataFrame) -> DataFrame:
    """Each row with its bitmap in its own ``width``, and folded to half of it, as sets that link may be a width apart.

    An element's bit is its hash modulo the width, so the XOR of the halves is the bitmap of half the width.
    """
    own = F.coalesce("wide", "parity")
    half = (F.size(own) / 2).cast("int")
    folded = F.zip_with(F.slice(own, F.lit(1), half), F.slice(own, half + 1, half), lambda a, b: a.bitwiseXOR(b))

    def at(bitmap: Column, is_own: bool) -> Column:
        return F.struct(F.size(bitmap).alias("width"), bitmap.alias("bitmap"), F.lit(is_own).alias("own"))

    widths = F.when(half >= SET_WORDS, F.array(at(own, True), at(folded, False))).otherwise(F.array(at(own, True)))
    return members.withColumn("__at", F.explode(widths)).select(*members.columns, "__at.*").drop("wide")


def _far(left: str, right: str, percent: int) -> Column:
    """Whether the bitmaps differ in more bits than sets that link can."""
    bits = F.aggregate(
        F.zip_with(f"{left}bitmap", f"{right}bitmap", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, n: total + n
    )
    return (100 + percent) * bits > (100 - percent) * (F.col(f"{left}n") + F.col(f"{right}n"))


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets link."""
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    held = materialize(texts.join(wanted, "id", "left_semi"), "texts")
    sided = pairs.join(held.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    sided = sided.join(held.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[bytes, set] = OrderedDict()  # a hub's pairs come one after another

        def of(text: bytes) -> set:
            if text not in recent:
                recent[text] = shingle_set(text)
                if len(recent) > 8:
                    recent.popitem(last=False)
            return recent[text]

        for batch in batches:
            ta, tb = (batch.column(i).cast(pa.binary()).to_pylist() for i in (2, 3))
            linked = []
            for x, y in zip(ta, tb, strict=True):
                hub = of(y)
                own = shingle_set(x)
                common = len(own & hub)
                linked.append(100 * common >= percent * (len(own) + len(hub) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))
        pa.default_memory_pool().release_unused()

    return sided.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, root): the smallest id reachable, for every id in ``links`` (a, b) that isn't it itself.

    Alternates two steps: neighbours above a node are tied to its smallest neighbour, then
    those below it. Both keep the components; stars are what doesn't change. The smallest neighbour is a
    partial aggregate, and AQE splits the join of a node with many neighbours.
    """

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    # a > b throughout
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = materialize(edges, "links")
    before = state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        edges = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        down = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(down.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("id"), "root")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Columns ``key``, ``n_shingles``, ``component_id`` and ``kept`` (the row has its component's smallest key).

    Two rows link if their shingle sets share ``percent`` percent of their union. Null, empty and
    blank texts have an empty set, which links with nothing; fewer words than a shingle
    are one shingle. Rows with equal keys are one node, so repeated rows share their component, and
    a key with several texts joins their groups. Rows without a key link with nothing, have no component, and are
    kept. Only ``key`` and ``text`` are read, so other columns can't clash. An empty table gives an empty one.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    signed = materialize(map_texts(rows, ["id"], "text", SIGNATURE, lambda texts: [signature(t or b"", percent) for t in texts]), "signatures")
    texts = rows.where("id IS NOT NULL AND text IS NOT NULL")

    # equal sets are one class, whose smallest id stands for it
    same = ["n_shingles", "set_a", "set_b"]
    usable = signed.where("n_shingles > 0 AND id IS NOT NULL")
    classes = usable.groupBy(same).agg(F.min("id").alias("rep"))
    member = materialize(usable.select("id", *same).join(classes, same).select("id", "rep").distinct(), "members")
    reps = usable.join(classes.withColumnRenamed("rep", "id"), [*same, "id"], "left_semi").dropDuplicates([*same, "id"])
    reps = materialize(reps, "representatives")

    keyed = reps.select("id", F.explode("bands").alias("bucket"))
    crowded = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(keyed.join(crowded, "bucket"), "buckets")

    # the hub of a bucket is the set that shares most buckets with most others: next to what copies were made from
    centrality = shared.groupBy("id").agg(F.sum("size").alias("centrality"))
    hubs = shared.join(centrality, "id").groupBy("bucket").agg(F.max(F.struct("centrality", (-F.col("id")).alias("minus"))).alias("hub"))
    star = shared.join(hubs.select("bucket", (-F.col("hub.minus")).alias("hub")), "bucket").where("id <> hub").select("id", "hub").distinct()
    sided = star.withColumnsRenamed({"id": "l_id", "hub": "r_id"})
    sided = sided.join(reps.select(*_side("l_")), "l_id").join(reps.select(*_side("r_")), "r_id")
    estimate = _estimate(_differing("l_o", "r_o", SKETCH_WORDS), percent)
    nearest = sided.where(_may_link("l_", "r_", percent)).groupBy("l_id").agg(F.max(F.struct(estimate.alias("e"), "r_id")).alias("hub"))
    pairs = materialize(nearest.select(F.col("l_id").alias("a"), F.col("hub.r_id").alias("b")), "pairs")
    links = materialize(_confirmed(pairs, texts, percent), "links")

    # keys with several texts join their classes
    several = member.groupBy("id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    links = links.union(member.join(several, "id", "left_semi").select("id", "rep"))

    found = materialize(components(links), "components")
    rooted = shared.select("id", "bucket").join(found, "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("bucket")
    open_ = rooted.join(mixed, "bucket", "left_semi")
    open_ = materialize(_at_widths(open_.join(reps.select("id", "n_shingles", "odd", "parity", "wide"), "id")), "open")
    left, right = (
        open_.select("bucket", "width", *(F.col(c).alias(f"{side}{c}") for c in ("root", "bitmap", "own")), *_side(side)) for side in ("l_", "r_")
    )
    met = left.join(right, ["bucket", "width"]).where((F.col("l_root") < F.col("r_root")) & (F.col("l_own") | F.col("r_own")))
    across = met.where(_may_link("l_", "r_", percent) & ~_far("l_", "r_", percent))
    pairs = materialize(across.select(F.col("l_id").alias("a"), F.col("r_id").alias("b")).distinct(), "pairs")
    across = _confirmed(pairs, texts, percent)
    # components of components: every id stays tied to the root it had
    found = materialize(components(across.union(found.select("id", "root"))), "components")

    placed = signed.select("id", *same).join(classes, same, "left").select("id", "n_shingles", F.coalesce("rep", "id").alias("rep"))
    placed = placed.join(found.select(F.col("id").alias("rep"), "root"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "rep"))
    return placed.select(
        F.col("id").alias(key), "n_shingles", component.alias("component_id"), (F.col("id").isNull() | (F.col("id") == component)).alias("kept")
    )
