"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, union-find.

1. One pass over the texts makes each document's set of distinct word shingles, its SuperMinHash
   band keys and a 128-bit key of the set.  Documents with the same set form a class; the class is
   represented by its smallest id, so exact copies cost one row each and no pairs.
2. A bucket is a band key that at least two classes share.  Buckets of more than ``CELL`` members
   are thinned first, without loss.  Shingles of their members are ordered by how many members hold
   them (a sketch of counts; any order is right, a good one is quick), rarest first.  Two sets that
   are similar enough share a shingle among the first few of each, so a member whose first shingles
   no other member has among its own is linked with none of them and leaves the bucket.  Texts made
   from one template share buckets by the thousand, but what comes first is what is their own.
3. Every member left is verified against the bucket's centre (its smallest id): a star, not all pairs.
4. The verified links are joined into components.  From large buckets, members whose first shingles are
   only shared within their component leave too.  In the buckets that still hold more than one component, the members
   outside the centre's component are verified against all other members, in cells of at most
   ``CELL`` x ``CELL`` members.  So every pair of different components that shares a bucket has been
   compared on full sets, or cannot be similar enough, and no such link is lost.

Words are told by 64-bit hashes, shingles by 64-bit hashes of these, and equal sets by two 64-bit
sums over their shingles: full sets are compared, as sets of hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.llm import superminhash, textbuf
from tablemill.llm.components import components
from tablemill.llm.scratch import short_batches, small_or_shuffled, store

SHINGLE = 5
SIMILARITY = 75  # percent
SLOTS = 128
ROWS = 4  # a pair at 0.75 shares none of the 32 bands with probability 5e-6
CELL = 200
SKETCH = 1 << 18  # counters, a power of two
SIGN_BYTES = 1 << 18  # text signed at once: small sets keep a permutation of all slots per shingle
_SALT = np.uint64(0xA5A5A5A55A5A5A5B)


def _sets_of(run: pa.RecordBatch, size: int) -> list[np.ndarray]:
    raw, at = textbuf.utf8(run.column(1))
    raw = textbuf.LOWER[raw]
    start, end, first = textbuf.words(raw, at, textbuf.SPACE_WORDS)
    return textbuf.shingle_sets(textbuf.word_hashes(raw, start, end), first, size)


def _lists(sets: list[np.ndarray]) -> pa.Array:
    at = np.zeros(len(sets) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in sets], out=at[1:])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))


def _signer(size: int, slots: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in textbuf.runs(batch, "text", SIGN_BYTES):
                sets = _sets_of(run, size)
                n = np.array([len(x) for x in sets], dtype=np.int64)
                keys = superminhash.band_keys(superminhash.signatures(sets, slots), rows)
                k1 = [int(textbuf.mix64(x).sum(dtype=np.uint64).view(np.int64)) for x in sets]
                k2 = [int(textbuf.mix64(x ^ _SALT).sum(dtype=np.uint64).view(np.int64)) for x in sets]
                bands = _lists([k if c else k[:0] for k, c in zip(keys, n)])
                yield pa.RecordBatch.from_arrays([run.column(0), pa.array(n), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), bands], ["id", "n", "k1", "k2", "bands"])

    return sign


def _set_maker(size: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in textbuf.runs(batch, "text"):
                yield pa.RecordBatch.from_arrays([run.column(0), _lists(_sets_of(run, size))], ["id", "shingles"])

    return make


def _needed(n: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """Least overlap of a set of n shingles with a larger or equal, and with a smaller or equal, similar set."""
    return -(-2 * similarity * n // (100 + similarity)), -(-similarity * n // 100)


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters of shingles, of those that more than one set of the task holds: the order needs no others."""
    count = np.zeros(SKETCH, dtype=np.int64)
    for batch in batches:
        count += np.bincount(np.asarray(batch.column(0).flatten(), dtype=np.int64) & (SKETCH - 1), minlength=SKETCH)
    slot = np.flatnonzero(count > 1)
    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(count[slot])], ["slot", "n"])


def _leader(shared, similarity: int):
    """The shingles that come first in each set, rarest first: ``narrow`` ones must be shared with a larger
    similar set, all of them with a smaller one."""

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value
        for batch in batches:
            ids, sizes, tokens, narrow = batch.column(0), [], [], []
            for shingles in batch.column(1):
                own = np.asarray(shingles.values, dtype=np.int64)
                order = np.lexsort((own, count[own & (SKETCH - 1)]))
                close, wide = (len(own) - int(x) + 1 for x in _needed(np.int64(len(own)), similarity))
                tokens.append(own[order[:wide]])
                narrow.append(np.arange(len(tokens[-1])) < close)
                sizes.append(len(tokens[-1]))
            if sizes:
                owner = ids.take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
                yield pa.RecordBatch.from_arrays([owner, pa.array(np.concatenate(tokens)), pa.array(np.concatenate(narrow))], ["id", "token", "narrow"])

    return lead


def _contested(lead: DataFrame, by: str) -> DataFrame:
    """Distinct ids of ``lead`` that share a leading shingle with one of another ``by``."""
    tokens = lead.groupBy("token").agg(F.min(by).alias("low"), F.max(by).alias("high"), F.max("narrow").alias("narrow")).filter("low < high and narrow").select("token")
    return lead.join(tokens, "token", "left_semi").select("id").distinct()


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Exact intersection sizes of every left with every right set, in blocks of the shared values."""
    a, b = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    row_a = np.repeat(np.arange(len(left)), [len(x) for x in left])
    row_b = np.repeat(np.arange(len(right)), [len(x) for x in right])
    at_a, at_b = np.searchsorted(shared, a), np.searchsorted(shared, b)
    hit_a = at_a < len(shared)
    hit_a[hit_a] = shared[at_a[hit_a]] == a[hit_a]
    hit_b = at_b < len(shared)
    hit_b[hit_b] = shared[at_b[hit_b]] == b[hit_b]
    row_a, at_a, row_b, at_b = row_a[hit_a], at_a[hit_a], row_b[hit_b], at_b[hit_b]
    for lo in range(0, len(shared), 8192):
        in_a, in_b = (at_a >= lo) & (at_a < lo + 8192), (at_b >= lo) & (at_b < lo + 8192)
        wide = min(8192, len(shared) - lo)
        x, y = np.zeros((len(left), wide), np.float32), np.zeros((len(right), wide), np.float32)
        x[row_a[in_a], at_a[in_a] - lo] = 1
        y[row_b[in_b], at_b[in_b] - lo] = 1
        out += (x @ y.T).astype(np.int64)
    return out


def _cell_links(similarity: int):
    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        side = cell["side"].to_numpy()
        a, b = cell[side == 0], cell[side == 1]
        if not len(a) or not len(b):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        inter = _overlaps(list(a["shingles"]), list(b["shingles"]))
        size = np.add.outer(a["shingles"].map(len).to_numpy(), b["shingles"].map(len).to_numpy())
        near = (100 * inter >= similarity * (size - inter)) & np.not_equal.outer(a["root"].to_numpy(), b["root"].to_numpy())
        i, j = np.nonzero(near)
        # Links between the same two components say the same: one of each is enough.
        out = pd.DataFrame({"a": a["root"].to_numpy()[i], "b": b["root"].to_numpy()[j]})
        return out.drop_duplicates()

    return compare


def _kept(cand: DataFrame, ids: DataFrame) -> DataFrame:
    """``cand`` without the members of hot buckets (more than one cell compares) that are not among ``ids``.
    Rows of other buckets meet no join."""
    hot = F.col("members") > CELL
    listed = cand.filter(hot).join(small_or_shuffled(ids.select(F.col("id").alias("rep"))), "rep", "left_semi")
    return cand.filter(~hot).unionByName(listed)


def _without_strangers(cand: DataFrame, sets: DataFrame, similarity: int) -> tuple[DataFrame, DataFrame | None]:
    """(``cand`` without the members of hot buckets that can be linked with no other, the leading shingles
    of members of hot buckets, or None if no bucket is hot).  Small buckets are compared as they are."""
    ids = store(cand.filter(F.col("members") > CELL).select(F.col("rep").alias("id")).distinct(), "hot_ids")
    if ids.isEmpty():
        return cand, None
    own = sets.join(small_or_shuffled(ids), "id", "left_semi")
    # What many of these members hold, in a table of fixed size.
    held = own.select("shingles").mapInArrow(_repeats, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(SKETCH, dtype=np.int64)
    count[held["slot"].to_numpy()] = held["n"].to_numpy()
    shared = cand.sparkSession.sparkContext.broadcast(count)
    lead = store(own.mapInArrow(_leader(shared, similarity), "id long, token long, narrow boolean"), "lead")
    return store(_kept(cand, store(_contested(lead, "id"), "alive")), "thinned"), lead


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: int = SIMILARITY,
    slots: int = SLOTS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    Documents are linked when 100 * |intersection| >= ``similarity`` * |union| of their shingle sets.
    component_id is the smallest id reachable; kept is true on that document.

    Words are what ASCII white space separates, after lower-casing A-Z.  A null, empty or blank
    text has no shingle and is linked with nothing; a text of fewer than ``shingle`` words has one.
    A row without an id is linked with nothing: its component_id is null and kept is false.  Rows
    that repeat an id are the same document.  Other columns are ignored.
    """
    short_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = store(
        texts.mapInArrow(_signer(shingle, slots, rows), "id long, n long, k1 long, k2 long, bands array<long>"), "signed"
    )
    classes = signed.filter("n > 0 and id is not null").groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    banded = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    cand = store(banded.join(shared, "bucket"), "cand")

    involved = store(cand.select(F.col("rep").alias("id")).distinct(), "involved")
    sets = store(
        texts.filter("id is not null")
        .join(small_or_shuffled(involved), "id", "left_semi")
        .mapInArrow(_set_maker(shingle), "id long, shingles array<long>"),
        "sets",
    )
    cand, lead = _without_strangers(cand, sets, similarity)
    centres = cand.groupBy("bucket").agg(F.min("rep").alias("centre"), F.count("*").alias("members")).filter("members > 1")
    # One row for a member and its centre, however many bands they share: what is looked up by document is looked up once.
    met = store(
        cand.drop("members").join(centres, "bucket").filter("rep != centre")
        .groupBy("rep", "centre").agg(F.collect_list(F.struct("bucket", "members")).alias("buckets")),
        "met",
    )

    pairs = met.select(F.col("centre").alias("a"), F.col("rep").alias("b"))
    one = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    two = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    inter = F.size(F.array_intersect("x", "y"))
    stars = (
        pairs.join(one, "b").join(two, "a").select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"), inter.alias("i"))
        .filter(F.col("i") * 100 >= (F.col("nx") + F.col("ny") - F.col("i")) * similarity)
        .select("a", "b")
    )
    first = store(components(stars), "first")

    root = first.select(F.col("node").alias("rep"), "root")
    centre_root = first.select(F.col("node").alias("centre"), F.col("root").alias("centre_root"))
    rooted = met.join(root, "rep", "left").join(centre_root, "centre", "left")
    rooted = rooted.withColumns({"root": F.coalesce("root", "rep"), "outside": F.coalesce("root", "rep") != F.coalesce("centre_root", "centre")})
    placed = rooted.select("rep", "root", "outside", F.inline("buckets"))
    if lead is not None:
        led = lead.join(small_or_shuffled(first.select(F.col("node").alias("id"), "root")), "id", "left").withColumn("root", F.coalesce("root", "id"))
        placed = _kept(placed, store(_contested(led, "root"), "contested"))
    placed = store(placed.select("bucket", "rep", "root", "outside"), "placed")
    live = (
        placed.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.col("outside").cast("int")).alias("u"))
        .filter("n > 1 and u > 0")  # all have been compared with the centre
        .select("bucket", F.ceil(F.col("u") / CELL).cast("int").alias("blocks_a"), F.ceil(F.col("n") / CELL).cast("int").alias("blocks_b"))
    )
    rest = placed.join(live, "bucket").join(sets.withColumnRenamed("id", "rep"), "rep")
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    cols = ["bucket", "root", "shingles"]
    side_a = rest.filter("outside").select(*cols, block("blocks_a").alias("x"), span("blocks_b").alias("y"), F.lit(0).alias("side"))
    side_b = rest.select(*cols, block("blocks_b").alias("y"), span("blocks_a").alias("x"), F.lit(1).alias("side")).select(side_a.columns)
    more = side_a.unionByName(side_b).groupBy("bucket", "x", "y").applyInPandas(_cell_links(similarity), "a long, b long")
    second = components(more)

    merged = first.join(second.select(F.col("node").alias("root"), F.col("root").alias("above")), "root", "left")
    late = second.select("node", "root").join(first.select("node"), "node", "left_anti")
    final = merged.select("node", F.coalesce("above", "root").alias("root")).unionByName(late)
    reps = classes.select("k1", "k2", F.col("rep").alias("node")).join(final, "node", "left")
    reps = reps.select("k1", "k2", F.coalesce("root", "node").alias("component"))
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "id"))
    return (
        signed.drop("bands").join(reps, ["k1", "k2"], "left")
        .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that are not the smallest id of their group.

    Rows without an id are documents too, told by their text and placed behind all ids: one of equal
    texts stays, and none that is near a document with an id.  Of rows that repeat id and text one
    stays (which one is not defined).  Null, empty and blank texts are near nothing.  Columns keep
    names and order.
    """
    text = F.col(text_col).cast("string")
    key = F.coalesce(F.col(id_col).cast("long"), F.shiftrightunsigned(F.xxhash64(text), 2) + F.lit(1 << 62))
    named = docs.select(key.alias("id"), text.alias("text"))
    gone = store(near_duplicates(named, "id", "text", **options).filter(~F.col("kept")).select("id").distinct(), "gone")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), key.alias("id"))
    left = rows.join(small_or_shuffled(gone), "id", "left_anti")
    twice = store(docs.select(key.alias("id")).groupBy("id").count().filter("count > 1").select("id"), "twice")
    if not twice.isEmpty():
        hint = small_or_shuffled(twice)
        again = left.join(hint, "id", "left_semi").withColumns({"a": F.xxhash64(F.col("row")[text_col]), "b": F.crc32(F.col("row")[text_col].cast("string").cast("binary"))})
        left = left.join(hint, "id", "left_anti").unionByName(again.dropDuplicates(["id", "a", "b"]).select("row", "id"))
    return left.select("row.*")


def op1_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
