"""Near-duplicate documents by a multi-index Hamming join over b-bit MinHash signatures.

A signature is ``SYMBOLS`` MinHash values of ``BITS`` bits each; its distance counts the symbols that differ.
Symbols are dealt to chunks of ``CHUNK``.  By the pigeonhole principle two signatures that differ in at most
``MAX_DISTANCE`` symbols agree in some chunk but for at most ``ERRORS`` symbols, so enumerating each chunk with
every set of ``ERRORS`` symbols left out gives keys of which such a pair shares one.  A pair at a similarity of
exactly 0.75 shares no key with a probability of 2e-6 (all ten chunks would need two errors or more).

Keys of many documents are never expanded into pairs:

1. documents with the same shingle set are one class, of which the smallest id stands for all;
2. for each key, its smallest class (the hub) is compared with the others; most groups are one component now;
3. in keys whose classes still lie in several components, up to ``HUBS`` components send a hub each, which is compared
   with the members of the other components; that is done ``TURNS`` times and costs a constant number of pairs for
   each member;
4. only keys whose classes still lie in several components go on, without their hubs.  Their members are cut into
   blocks by set size and hash; a block meets those blocks whose sizes allow a similarity of 0.75, and a pair
   leaves the task only if its components differ, this is the first key it shares, and its bottom-k sketches
   (the whole sets, where those are small) allow 0.75.

Sketches only turn pairs away far below 0.75 (five standard deviations); links are confirmed on full shingle
sets and go through connected components.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import (LOWER, SPACE, U, arrow_map, gram_hashes, mix, span_hashes, spans, stored,
                                  table, text_runs)
from medallion.llm.components import components
from medallion.llm.registry import query

SHINGLE = 5
SYMBOLS, BITS, CHUNK, ERRORS = 40, 16, 4, 1
CHUNKS = SYMBOLS // CHUNK
# The largest distance that the pigeonhole covers: one error more than ERRORS in every chunk would exceed it.
MAX_DISTANCE = CHUNKS * (ERRORS + 1) - 1
# Symbols that may differ before a pair is turned away unconfirmed: 5 deviations above the mean at 0.75.
FAR = int(SYMBOLS / 4 + 5 * (SYMBOLS * 3 / 16) ** 0.5 + 1)
# Smallest hashes of a set that a sketch keeps.
SKETCH = 256
# Rows of 64 bits in the table that turns texts away.
FILTER_WORDS = 1 << 17
# Rounds of further hubs, and hubs of a key in each.
TURNS, HUBS = 1, 8
# Members of a block in step 4, which bounds a task's memory and leaves no pair out.
BLOCK = 512
SEED = 20240601

_rng = np.random.default_rng(SEED)
_FLIP = _rng.integers(0, 2**64, SYMBOLS, dtype=np.uint64)[:, None]
_TIMES = (_rng.integers(0, 2**63, SYMBOLS, dtype=np.uint64) * U(2) + U(1))[:, None]
_KEPT = list(combinations(range(CHUNK), CHUNK - ERRORS))


def shingle_sets(column: pa.Array):
    """For each text its set of shingle hashes, sorted; fewer than five words are one shingle, none are none."""
    with np.errstate(over="ignore"):
        for _, _, data, offsets in text_runs(column):
            data = LOWER[data]
            starts, ends, bounds = spans(SPACE[data], offsets)
            hashes = span_hashes(data, starts, ends)
            grams, first = gram_hashes(hashes, bounds, SHINGLE)
            cut = np.searchsorted(first, bounds)
            for i in range(len(offsets) - 1):
                if cut[i + 1] > cut[i]:
                    yield np.unique(grams[cut[i]:cut[i + 1]])
                elif bounds[i + 1] > bounds[i]:
                    own = hashes[bounds[i]:bounds[i + 1]]
                    yield gram_hashes(own, np.array([0, len(own)]), len(own))[0] ^ mix(np.full(1, len(own), np.uint64))
                else:
                    yield grams[:0]


def signature(found: np.ndarray) -> np.ndarray:
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), 2048):
        np.minimum(least, ((found[None, i:i + 2048] ^ _FLIP) * _TIMES).min(axis=1), out=least)
    return (mix(least) >> U(64 - BITS)).astype(np.uint16)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of each signature: every chunk with every allowed set of its symbols left out."""
    chunks = signatures.reshape(-1, CHUNKS, CHUNK).astype(np.uint64)
    keys = []
    for n, kept in enumerate(_KEPT):
        packed = np.zeros(chunks.shape[:2], np.uint64)
        for i in kept:
            packed = (packed << U(BITS)) | chunks[:, :, i]
        keys.append(mix(packed ^ mix(np.arange(CHUNKS, dtype=np.uint64) * U(len(_KEPT)) + U(n + 1))[None, :]))
    return np.concatenate(keys, axis=1)


def _sketch(batch: pa.RecordBatch) -> pa.Table:
    with np.errstate(over="ignore"):
        sizes, marks, signatures = [], [], []
        for found in shingle_sets(batch.column("text")):
            sizes.append(len(found))
            # two sums over the set stand for the whole set
            marks.append(np.array([mix(found).sum(), mix(found ^ U(SEED)).sum()], np.uint64).tobytes())
            signatures.append(signature(found).tobytes())
    return pa.table({"doc_id": batch.column("doc_id"), "n_shingles": pa.array(sizes, pa.int64()),
                     "mark": pa.array(marks, pa.binary()), "signature": pa.array(signatures, pa.binary())})


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def _keys(batch: pa.RecordBatch) -> pa.Table:
    with np.errstate(over="ignore"):
        keys = chunk_keys(_signatures(batch.column("signature"))).view(np.int64)
    n = keys.shape[1]
    return pa.table({"id": np.repeat(batch.column("id").to_numpy(), n), "key": keys.ravel(),
                     "place": np.tile(np.arange(n, dtype=np.int32), len(keys))})


def _bottom(batch: pa.RecordBatch) -> pa.Table:
    found = [x[:SKETCH].tobytes() for x in shingle_sets(batch.column("text"))]
    return pa.table({"id": batch.column("doc_id"), "bottom": pa.array(found, pa.binary())})


def _near(batch: pa.RecordBatch) -> pa.Table:
    differ = (_signatures(batch.column("sa")) != _signatures(batch.column("sb"))).sum(axis=1)
    return pa.Table.from_batches([batch]).select(["a", "b"]).filter(pa.array(differ <= FAR))


def _sets(batch: pa.RecordBatch) -> pa.Table:
    found = list(shingle_sets(batch.column("text")))
    ends = np.cumsum([0, *(len(x) for x in found)]).astype(np.int32)
    held = np.concatenate([x.view(np.int64) for x in found])
    return pa.table({"id": batch.column("doc_id"), "shingles": pa.ListArray.from_arrays(ends, held)})


def _confirm(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs ``a, b`` (stored) whose full sets have a similarity of 0.75 or more."""
    ids = pairs.select(F.col("a").alias("doc_id")).distinct().union(pairs.select(F.col("b").alias("doc_id")).distinct())
    sets = arrow_map(_texts_of(docs, ids), _sets, "id long, shingles array<long>")
    sets = stored(sets)
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(a, "a").join(b, "b").where(
        100 * common >= 75 * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """One text (the smallest) for each id.

    A bit table of the ids' hashes, of a fixed size, turns most other documents away before their texts are shuffled.
    """
    ids = stored(ids.distinct())
    place, bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_WORDS)), F.pmod(F.hash("doc_id"), F.lit(64)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    bits = ids.groupBy(place.alias("place")).agg(F.bit_or(one).alias("bits"))
    # at most FILTER_WORDS rows of 16 bytes
    seen = docs.withColumn("place", place).join(F.broadcast(bits), "place").where(F.col("bits").bitwiseAND(one) != 0)
    return seen.select("doc_id", "text").join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))


def _against_hubs(members: DataFrame, hubs: DataFrame, stands: DataFrame, apart: str) -> DataFrame:
    """Pairs ``a, b`` of members (``key, id, ...``) and the hubs of their keys (``key, hub, ...``), once each, without
    those whose sizes or signatures say that they are no links; stored.

    Sizes and signatures go with the rows of a key, so that no pair is looked up on its own; ``apart`` says which
    member and hub meet.
    """
    looks = stands.select("id", "n_shingles", "signature")
    hubs = hubs.join(looks.select(F.col("id").alias("hub"), F.col("n_shingles").alias("nh"), F.col("signature").alias("sh")), "hub")
    if "signature" not in members.columns:
        members = members.join(looks, "id")
    pairs = (members.join(hubs, "key")
             .where(f"({apart}) and 100 * least(n_shingles, nh) >= 75 * greatest(n_shingles, nh)")
             .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"), F.col("signature").alias("sa"), F.col("sh").alias("sb")))
    return stored(arrow_map(pairs, _near, "a long, b long").distinct())


def _more_hubs(rest: DataFrame, stands: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of further hubs of open keys (``key, place, id, component, n_shingles, signature``) with the members of
    other components, and the members left.

    Each component of a key sends one member, by a hash; at most ``HUBS`` of those are hubs.  A hub meets all
    members of other components, so it need not be met again.
    """
    # drawn alike for all keys, so that documents that share many keys meet the same hubs in them
    draw, of = F.xxhash64("id", F.lit(turn)), F.xxhash64("component", F.lit(turn))
    sent = rest.groupBy("key", "component").agg(F.min_by("id", draw).alias("id"))
    hubs = sent.groupBy("key", F.pmod(of, F.lit(HUBS)).alias("slot")).agg(F.min_by(F.struct("id", "component"), of).alias("hub"))
    hubs = stored(hubs.select("key", F.col("hub.id").alias("hub"), F.col("hub.component").alias("of")))
    pairs = _against_hubs(rest.select("key", "id", "component", "n_shingles", "signature"), hubs, stands, "component != of")
    left = rest.select("key", "place", "id").join(hubs.select("key", F.col("hub").alias("id")), ["key", "id"], "left_anti")
    return pairs, stored(left)


def _blocks(keys: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of step 4.  keys: ``key, place, id``; found: ``id, n_shingles, signature, component, bottom``."""
    rows = keys.join(found, "id")
    # Blocks follow set size: classes (by powers of 4/3) cut by a hash, so that a hot key is many small blocks.
    rows = rows.withColumn("band", F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(4 / 3))).cast("int"))
    counts = rows.groupBy("key", "band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("cuts"))
    near = counts.select("key", (F.col("band") - 1).alias("band"), F.col("cuts").alias("next_cuts"))
    rows = (rows.join(counts, ["key", "band"]).join(near, ["key", "band"], "left")
            .withColumn("cut", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int")))
    # Two sizes with a ratio of 0.75 or more lie in one band or in bands next to each other.
    below = F.col("cut")
    own = F.concat(F.transform(F.sequence(F.lit(0), below),
                               lambda o: F.struct(F.col("band").alias("x"), o.alias("i"), F.col("band").alias("y"), below.alias("j"))),
                   F.when(below + 1 < F.col("cuts"), F.transform(
                       F.sequence(below + 1, F.col("cuts") - 1),
                       lambda o: F.struct(F.col("band").alias("x"), below.alias("i"), F.col("band").alias("y"), o.alias("j"))))
                   .otherwise(F.array()))
    up = F.when(F.col("next_cuts").isNotNull(), F.transform(
        F.sequence(F.lit(0), F.coalesce("next_cuts", F.lit(1)) - 1),
        lambda o: F.struct(F.col("band").alias("x"), below.alias("i"), (F.col("band") + 1).alias("y"), o.alias("j")))).otherwise(F.array())
    prior = counts.select("key", (F.col("band") + 1).alias("band"), F.col("cuts").alias("prior_cuts"))
    down = F.when(F.col("prior_cuts").isNotNull(), F.transform(
        F.sequence(F.lit(0), F.coalesce("prior_cuts", F.lit(1)) - 1),
        lambda o: F.struct((F.col("band") - 1).alias("x"), o.alias("i"), F.col("band").alias("y"), below.alias("j")))).otherwise(F.array())
    rows = rows.join(prior, ["key", "band"], "left").withColumn("meet", F.explode(F.concat(own, up, down)))
    rows = rows.select("key", "place", "meet.*", "id", "n_shingles", "signature", "component", "bottom")

    def near_pairs(group: pa.Table) -> pa.Table:
        ids, parts = group.column("id").to_numpy(), group.column("component").to_numpy()
        a, b = [], []
        if (parts != parts[:1]).any():
            sizes = group.column("n_shingles").to_numpy()
            signs = _signatures(group.column("signature"))
            bottoms = [np.frombuffer(x, np.uint64) for x in group.column("bottom").to_pylist()]
            chunk, left_out = group.column("place")[0].as_py() % CHUNKS, group.column("place")[0].as_py() // CHUNKS
            for i in range(len(ids)):
                near = (parts != parts[i]) & (ids > ids[i]) & (
                    100 * np.minimum(sizes, sizes[i]) >= 75 * np.maximum(sizes, sizes[i]))
                rest = np.flatnonzero(near)
                if not len(rest):
                    continue
                differ = (signs[rest] != signs[i]).reshape(-1, CHUNKS, CHUNK)
                first = (differ.sum(axis=2) <= ERRORS).argmax(axis=1)
                odd = differ[:, chunk]
                kept = ~np.stack([odd[:, list(k)].any(axis=1) for k in _KEPT], axis=1)
                rest = rest[(first == chunk) & (kept.argmax(axis=1) == left_out) & (differ.sum(axis=(1, 2)) <= FAR)]
                for j in rest:
                    if possible(bottoms[i], bottoms[j]):
                        a.append(ids[i])
                        b.append(ids[j])
        return pa.table({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return rows.groupBy("key", "x", "i", "y", "j").applyInArrow(near_pairs, "a long, b long").distinct()


def possible(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two bottom-k sketches (sorted) allow a similarity of 0.75; exact where both hold whole sets."""
    both = np.union1d(x, y)
    if len(x) == SKETCH or len(y) == SKETCH:
        both = both[:SKETCH]
        shared = len(np.intersect1d(np.intersect1d(x, y, True), both, True))
        return shared >= 0.75 * len(both) - 5 * (len(both) * 3 / 16) ** 0.5
    return 100 * (len(x) + len(y) - len(both)) >= 75 * len(both)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id`` long, ``text``).

    Words are runs of ``[^\\x20\\x09-\\x0D]`` with A-Z lower-cased; a document's set holds its five-word shingles,
    or its whole sequence if it is shorter.  Documents with 75 % of their shingles in common (intersection by
    union) are linked; ``component_id`` is the smallest id reachable and ``kept`` marks that document.
    A null or empty text has no shingles and is linked with nothing.  Rows that repeat an id are each returned;
    rows with different texts under one id count as one document: copies of any of them link it, near links are
    confirmed on its smallest text, and ``kept`` holds for all its rows or none.  Rows with a null id are returned unlinked and kept.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = stored(arrow_map(docs, _sketch, "doc_id long, n_shingles long, mark binary, signature binary"))
    full = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("mark").agg(F.min("doc_id").alias("id"))
    member = stored(full.select("doc_id", "mark").join(classes, "mark").select("doc_id", "mark", "id"))
    stands = stored(full.join(member.where("doc_id = id").select("doc_id", "mark").distinct(), ["doc_id", "mark"], "left_semi")
                    .groupBy(F.col("doc_id").alias("id"), "mark")
                    .agg(F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")).drop("mark"))
    keys = arrow_map(stands, _keys, "id long, key long, place int")
    hubs = stored(keys.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1"))
    shared = stored(keys.join(hubs, "key"))

    star = _against_hubs(shared.select("key", "id").distinct(), hubs.select("key", F.col("a").alias("hub")), stands, "id != hub")
    star_links = stored(_confirm(docs, star))
    parts = components(star_links)

    # A hub has met all others of its key, so keys of two are done.
    rest = shared.where("n > 2 and id != a").select("key", "place", "id").distinct()
    for turn in range(TURNS + 1):
        found = stored(stands.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id")))
        rest = rest.join(found.select("id", "component", "n_shingles", "signature"), "id")
        open_keys = rest.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("key")
        rest = stored(rest.join(open_keys, "key", "left_semi"))
        if turn == TURNS or rest.isEmpty():
            break
        more, rest = _more_hubs(rest, stands, turn)
        star_links = stored(star_links.union(_confirm(docs, more)).distinct())
        parts = components(star_links)
    rest = rest.select("key", "place", "id")
    bottoms = arrow_map(_texts_of(docs, rest.select(F.col("id").alias("doc_id"))), _bottom, "id long, bottom binary")
    links = star_links.union(_confirm(docs, stored(_blocks(rest, found.join(bottoms, "id")))))
    several = member.groupBy("doc_id").agg(F.min("id").alias("a"), F.count_distinct("mark").alias("n")).where("n > 1")
    several = member.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("id").alias("b"))
    parts = stored(components(links.union(several)))

    label = (member.groupBy("doc_id").agg(F.min("id").alias("id")).join(parts, "id", "left")
             .select("doc_id", F.coalesce("component", "id").alias("component_id")))
    return (sketches.select("doc_id", "n_shingles").join(label, "doc_id", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is kept, with all their columns."""
    out = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(out, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")


@query()
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
