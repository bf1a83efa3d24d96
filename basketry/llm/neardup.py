"""Near-duplicates by MinHash bands and odd sketches.

1. A document's set is its distinct 5-word shingles, as 64-bit hashes.  Documents with equal
   sets form a class, whose representative is the smallest id.
2. A class with another in the same band of MinHash values is a candidate.  Bands of `ROWS`
   values, `BANDS` of them, miss a pair of similarity 0.75 with a chance of 2 in a million.
3. In each band's bucket, all members of other components are compared with one leader, and
   the links found are contracted into components; this is repeated with other leaders as long
   as it halves the pairs across components.  Then every pair across components that is left
   in a bucket, between the smaller components and all others, is compared, so no candidate
   link between different components is left out, while near copies never meet in all pairs.
4. The odd sketch (MinHash samples folded into a parity bitmap) estimates the similarity of a
   candidate from the population count of the XOR; pairs five deviations below the threshold
   go.  A second bitmap has the parity of the whole set: its XOR never has more bits than the
   sets differ in shingles, so pairs that exceed a seventh of both sizes go without any risk.
   The join of a bucket tests both before it makes a pair.  The rest is confirmed on the full
   shingle sets.
5. Components come from star contractions of the links in Spark.

Null and empty texts have an empty set and are linked with nothing.  Rows that share an id
each get the component of their own set; a row with a null id is linked with nothing, its
component is null and it is kept.  Long texts are shingled whole.  `components` reads only
its two columns, so other columns cannot clash; one row per input row is returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import keep, texts

SHINGLE = 5
LEAST = 75  # percent of the union
ROWS, BANDS = 5, 48
SKETCH_WORDS = 16  # of 64 bits
SKETCH_LEAST = 0.60  # estimates below this are five deviations under the threshold
PARITY_WORDS = 32  # of the bitmap of the whole set
STAR_ROUNDS = 8
SIEVE_BITS = 1 << 26  # of the bitmap that spares texts of no candidate the shuffle: 8 MB
MEMO = 500_000

_U64 = np.uint64
_SEEDS = np.random.default_rng(20240229)
_FLIPS = _SEEDS.integers(0, 1 << 32, ROWS * BANDS, np.uint32)
_FACTORS = _SEEDS.integers(0, 1 << 32, ROWS * BANDS, np.uint32) | np.uint32(1)
_PLACES = [_U64(int(x) | 1) for x in _SEEDS.integers(0, 1 << 63, SHINGLE, np.uint64)]


class WordHashes(dict):
    """64-bit hash of each word seen; forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> _U64(27))) * _U64(0x94D049BB133111EB)
    return values ^ (values >> _U64(31))


def shingles(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; of the whole sequence if it is shorter."""
    tokens = text.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    word = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    width = min(SHINGLE, len(word))
    total = np.full(len(word) - width + 1, width, np.uint64)
    for k in range(width):
        total += word[k:len(word) - width + 1 + k] * _PLACES[k]
    return np.unique(_mix(total))


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash values of a set that is not empty."""
    low = (found >> _U64(32)).astype(np.uint32)
    values = np.full(len(_FLIPS), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), 512):  # the block stays in cache
        block = low[start:start + 512]
        np.minimum(values, ((block[None, :] ^ _FLIPS[:, None]) * _FACTORS[:, None]).min(1), out=values)
    return values


def bands(values: np.ndarray) -> np.ndarray:
    """One hash for each band of MinHash values."""
    grouped = values.reshape(BANDS, ROWS).astype(np.uint64)
    total = np.arange(BANDS, dtype=np.uint64) * _U64(0x9E3779B97F4A7C15)
    for k in range(ROWS):
        total = _mix(total + grouped[:, k])
    return total.view(np.int64)


def _parity(places: np.ndarray, size: int) -> np.ndarray:
    """Bitmap of the places that come up an odd number of times, as 64-bit words."""
    odd = np.bincount((places >> _U64(32)).astype(np.int64) % (64 * size), minlength=64 * size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def odd_sketch(values: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples (number, value)."""
    return _parity(_mix(values.astype(np.uint64) << _U64(16) | np.arange(len(values), dtype=np.uint64)), SKETCH_WORDS)


def set_parity(found: np.ndarray) -> np.ndarray:
    """Parity bitmap of the whole set."""
    return _parity(_mix(found + _U64(0x9E3779B97F4A7C15)), PARITY_WORDS)


def _differing(a: str, b: str, size: int) -> Column:
    return reduce(Column.__add__, [F.bit_count(F.get(F.col(a), k).bitwiseXOR(F.get(F.col(b), k))) for k in range(size)])


def may_be_linked(a: str, b: str) -> Column:
    """Whether two documents, told by the prefixes of their columns, may be similar enough."""
    bits, samples = 64 * SKETCH_WORDS, ROWS * BANDS
    # The estimate 1 + bits / (4 samples) ln(1 - 2 differing / bits) is at least SKETCH_LEAST.
    most = (1 - math.exp((SKETCH_LEAST - 1) * 4 * samples / bits)) * bits / 2
    sizes = F.col(f"{a}n_shingles") + F.col(f"{b}n_shingles")
    smaller, larger = F.least(f"{a}n_shingles", f"{b}n_shingles"), F.greatest(f"{a}n_shingles", f"{b}n_shingles")
    return (100 * smaller >= LEAST * larger) & (_differing(f"{a}sketch", f"{b}sketch", SKETCH_WORDS) <= most) & (
        (100 + LEAST) * _differing(f"{a}parity", f"{b}parity", PARITY_WORDS) <= (100 - LEAST) * sizes)


def sketches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands, sketch, parity) of each row; set_a and set_b tell equal sets."""
    schema = ("doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>, "
              "parity array<long>")

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            out = []
            for content in texts(batch["text"]):
                found = shingles(content, hashes)
                if len(found):
                    values = signature(found)
                    digest = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64)
                    out.append((len(found), digest[0], digest[1], bands(values), odd_sketch(values), set_parity(found)))
                else:
                    out.append((0, 0, 0, None, None, None))
            made = pd.DataFrame(out, columns=["n_shingles", "set_a", "set_b", "bands", "sketch", "parity"])
            yield pd.concat([batch["doc_id"].reset_index(drop=True), made], axis=1)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(sketched, schema)


def _linked(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    hashes = WordHashes()
    for left, right in pairs:
        known: dict[str, np.ndarray] = {}  # leaders come up again and again

        def of(content: str) -> np.ndarray:
            if content not in known:
                known[content] = shingles(content.encode("utf-8", "replace"), hashes)
            return known[content]

        out = []
        for a, b in zip(left, right):
            one, two = of(a), of(b)
            both = len(np.intersect1d(one, two, assume_unique=True))
            out.append(100 * both >= LEAST * (len(one) + len(two) - both))
        yield pd.Series(out, dtype=bool)


def sieve(ids: DataFrame, docs: DataFrame, doc_id: str) -> Column:
    """Whether an id may be among the ids: a test against a bitmap of fixed size, built by grouped ORs."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(SIEVE_BITS))
    bits = ids.select(place(F.col("id")).alias("p")).groupBy(F.shiftright("p", 6).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("bits")).toArrow()
    bitmap = np.zeros(SIEVE_BITS >> 6, np.int64)
    bitmap[bits["word"].to_numpy()] = bits["bits"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def passes(places: pd.Series) -> pd.Series:
        at = places.to_numpy(np.int64)
        return pd.Series((shared.value[at >> 6] >> (at & 63)) & 1 > 0)

    return passes(place(F.coalesce(F.col(doc_id).cast("long"), F.lit(-1))))


def contract(links: DataFrame) -> DataFrame:
    """(node, root): smallest node reachable over links (a, b), by large and small stars."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, before = keep(edges, "links"), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.inline(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m")))).toDF("u", "v")
        edges = keep(small.where("u <> v").distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.toDF("node", "root")
        before = state


def grown(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) with more links (a, b): only these are contracted, between the roots there are."""
    moved = links
    for side in ("a", "b"):
        own = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        moved = moved.join(own, side, "left").withColumn(side, F.coalesce(f"root_{side}", side)).drop(f"root_{side}")
    joined = contract(moved)
    further = joined.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return keep(roots.join(further, "root", "left").select("node", F.coalesce("next", "root").alias("root")).union(joined), "roots")


def _confirm(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    for side in ("a", "b"):
        pairs = pairs.join(contents.select(F.col("id").alias(side), F.col("text").alias(f"text_{side}")), side)
    return keep(pairs.where(F.pandas_udf(_linked, "boolean")(F.col("text_a"), F.col("text_b"))).select("a", "b").distinct(), "confirmed")


def link_classes(classes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, root) of the classes that are linked with others; classes has id, bands, n_shingles and both bitmaps."""
    buckets = classes.select("id", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = keep(buckets.join(shared, "bucket"), "members")
    ids = keep(members.select("id").distinct(), "candidates")
    contents = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where(
        sieve(ids, docs, doc_id)).join(ids, "id", "left_semi").where("text is not null")
    contents = keep(contents, "contents")
    marks = ["n_shingles", "sketch", "parity"]
    thin = keep(classes.select("id", *marks).join(ids, "id", "left_semi"), "sketches")
    roots = before = None
    for step in range(STAR_ROUNDS + 1):
        placed = members.withColumn("root", F.col("id")) if roots is None else keep(members.join(
            roots, F.col("id") == F.col("node"), "left").select("bucket", "id", F.coalesce("root", "id").alias("root")), "placed")
        # Components of each bucket, and the one with most members there, which gives the leader.
        sizes = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.min_by("id", F.xxhash64("id", F.lit(step))).alias("id"))
        open_ones = keep(sizes.groupBy("bucket").agg(
            F.count("*").alias("parts"), F.max(F.struct("n", "root", "id")).alias("top"), F.sum("n").alias("all"))
            .where("parts > 1").select("bucket", "top.root", "top.id", "top.n", "all")
            .toDF("bucket", "top", "leader", "n", "all"), "open-buckets")
        pairs, all_members = open_ones.agg(F.sum(F.col("all") * (F.col("all") - F.col("n"))), F.sum("all")).first()
        if not pairs:
            break
        last = step == STAR_ROUNDS or (before is not None and (pairs <= 2 * all_members or 2 * pairs > before))
        before = pairs
        rest = placed.join(open_ones.select("bucket", "top", "leader"), "bucket").where("root <> top").join(thin, "id").select(
            "bucket", "leader", *[F.col(c).alias(f"a_{c}") for c in ["id", "root", *marks]])
        if last:
            others = placed.join(open_ones.select("bucket"), "bucket", "left_semi").join(thin, "id").select(
                "bucket", *[F.col(c).alias(f"b_{c}") for c in ["id", "root", *marks]])
            compared = rest.join(others, (rest["bucket"] == others["bucket"]) & (F.col("a_root") != F.col("b_root")) & may_be_linked("a_", "b_"))
        else:
            leaders = thin.select(*[F.col(c).alias(f"b_{c}") for c in ["id", *marks]])
            compared = rest.drop("bucket").distinct().join(leaders, (F.col("leader") == F.col("b_id")) & may_be_linked("a_", "b_"))
        compared = compared.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct()
        links = _confirm(compared, contents)
        roots = contract(links) if roots is None else grown(roots, links)
        if last:
            break
    if roots is None:
        return classes.select(F.col("id").alias("node"), F.col("id").alias("root")).limit(0)
    return roots


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row."""
    sketched = keep(sketches(docs, doc_id, text), "set-sketches")
    sets = ["set_a", "set_b"]
    full = sketched.where("n_shingles > 0 and doc_id is not null")
    classes = keep(full.groupBy(*sets).agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"),
                                           F.first("sketch").alias("sketch"),
                                           F.first("parity").alias("parity"), F.first("n_shingles").alias("n_shingles")), "set-classes")
    roots = link_classes(classes, docs, doc_id, text)
    named = classes.select(*sets, "id").join(roots, F.col("id") == F.col("node"), "left").select(
        *sets, F.coalesce("root", "id").alias("component"))
    rows = sketched.select("doc_id", "n_shingles", *[F.when(F.col("n_shingles") > 0, F.col(c)).alias(c) for c in sets])
    return rows.join(named, sets, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
