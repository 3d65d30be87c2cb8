"""Near duplicates: one-permutation MinHash, banded buckets, star edges.

1. Each text becomes its set of word shingles (64-bit hashes). One hash of each
   shingle gives both its bin and its value; a bin keeps its least
   value. An empty bin copies the bin that comes first in a random order of its
   own (optimal densification), so even a text of one shingle has a full
   signature, and any two signatures agree in each bin with a probability
   equal to the similarity of their sets.
2. Equal sets are one class, represented by its smallest id; from here on
   there is one row for each different set, however many copies it has.
3. ``rows`` neighbouring bins make a band, each band of a set a bucket. The number of
   bands is chosen so that a pair at the threshold shares no bucket
   with a probability of at most :data:`MISS`.
4. In each bucket the members are paired with one hub, not with each other,
   so pairs grow with the members. The hub is the member that meets most others over
   all its buckets: of a group of near copies that is the text they were made
   from, or one close to it, which links to more of them than any copy does.
   Pairs whose full signatures agree in far fewer bins than a link's would (by
   :data:`SIGMAS` standard deviations) are dropped; the others are confirmed on the full
   sets, computed anew from the whole texts.
5. Links make components (alternating large-star and small-star steps, each
   written to the shared folder). What stars alone would miss are links in
   buckets that still hold several components. The members of such buckets are
   put together by hub (a text comes once, however many buckets of that hub it is
   in). Small groups give all their pairs across components, confirmed as above;
   larger ones are cut into blocks, and each pair of blocks counts the shared
   shingles of all its pairs at once, exactly, by a product of its 0/1 matrices. Of the links
   found, a pair of blocks returns only as many as join its components.

Results for odd input: null and empty texts (and those without words) have an
empty set and are linked with nothing; a text with fewer words than a shingle
has one shingle, the whole sequence; texts are read whole; a row without id is
linked with nothing, has a null component and is kept. Ids are meant to be
unique: rows that share an id are one node, and links of an id with different
texts are confirmed on the greatest of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .common import byte_words, release_tables, returning_memory

#: Probability that a pair at the threshold shares no bucket.
MISS = 1e-6
SIGMAS = 5
#: Members up to which a group's pairs across components are joined one by
#: one; a larger group is compared in blocks of about BLOCK texts, fewer where
#: they hold more than BLOCK_SHINGLES shingles.
SMALL_GROUP = 16
BLOCK = 1024
BLOCK_SHINGLES = 1 << 20
#: Shingles for which a pair of blocks builds its matrices at a time.
COLUMNS = 4096


@dataclass(frozen=True)
class Method:
    """Shingle length in words, similarity threshold in percent, bins in a band."""

    shingle: int = 5
    percent: int = 80
    rows: int = 5

    @property
    def bands(self) -> int:
        return math.ceil(math.log(MISS) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def bins(self) -> int:
        return self.bands * self.rows

    @property
    def least_agreement(self) -> int:
        s = self.percent / 100
        return math.floor(self.bins * s - SIGMAS * math.sqrt(self.bins * s * (1 - s)))


def _mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one (shifts and odd multipliers)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E37_79B9_7F4A_7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8_FEB8_6659_FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a UTF-8 text."""
    w = byte_words(text)
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    size = min(k, len(w))
    n = len(w) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = _mix(out ^ h[i: i + n]) + np.uint64(i + 1)
    return np.unique(out)


def donor_orders(bins: int) -> np.ndarray:
    """For each bin the order in which it asks the others, the same everywhere."""
    rng = np.random.default_rng(20240229)
    return np.stack([rng.permutation(bins) for _ in range(bins)]).astype(np.int32)


def signature(s: np.ndarray, bins: int, donors: np.ndarray) -> np.ndarray:
    """Densified one-permutation signature of a non-empty shingle set."""
    bin_of = ((s >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)  # sorted, as s is
    value = (_mix(s) >> np.uint64(32)).astype(np.uint32)
    first = np.flatnonzero(np.r_[True, bin_of[1:] != bin_of[:-1]])
    used = bin_of[first].astype(np.int64)
    out = np.zeros(bins, np.uint32)
    out[used] = np.minimum.reduceat(value, first)
    if len(used) < bins:
        full = np.zeros(bins, bool)
        full[used] = True
        empty = np.flatnonzero(~full)
        asked = donors[empty]
        out[empty] = out[asked[np.arange(len(empty)), full[asked].argmax(axis=1)]]
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    bands = sig.reshape(-1, rows).astype(np.uint64)
    key = _mix(np.arange(len(bands), dtype=np.uint64) + np.uint64(1))
    for i in range(rows):
        key = _mix(key ^ bands[:, i]) + np.uint64(i)
    return key.view(np.int64)


def sketch(docs: DataFrame, method: Method, id_col: str, text: str) -> DataFrame:
    """``id``, ``n_shingles``, ``s1``, ``s2`` (identity of the set), ``bands``
    and ``sig`` (low 16 bits of each bin), null for an empty set."""

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        donors = donor_orders(method.bins)
        for batch in batches:
            n, s1, s2, bands, sigs = [], [], [], [], []
            for t in batch.column(1):
                s = shingles(t.as_py(), method.shingle)
                n.append(len(s))
                if not len(s):
                    s1.append(None), s2.append(None), bands.append(None), sigs.append(None)
                    continue
                sig = signature(s, method.bins, donors)
                mixed = _mix(s)
                s1.append(int(mixed.sum(dtype=np.uint64).view(np.int64)))
                s2.append(int(np.bitwise_xor.reduce(_mix(mixed)).view(np.int64)))
                bands.append(band_keys(sig, method.rows))
                sigs.append(sig.astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                names=["id", "n_shingles", "s1", "s2", "bands", "sig"])

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").cast("binary").alias("t"))
    return source.mapInArrow(run, "id long, n_shingles long, s1 long, s2 long, bands array<long>, sig binary")


def _texts(docs: DataFrame, wanted: DataFrame, id_col: str, text: str) -> DataFrame:
    """``id``, ``t`` (UTF-8) of the ids in ``wanted``, one row each. The ids are
    written first: while their measured size is below Spark's broadcast threshold, no
    text that isn't wanted is shuffled."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").cast("binary").alias("t"))
    wanted = materialize(wanted.select("id").distinct(), "wanted")
    return texts.join(wanted, "id", "left_semi").groupBy("id").agg(F.max("t").alias("t"))


def confirm(pairs: DataFrame, docs: DataFrame, method: Method, id_col: str, text: str) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets reach the threshold."""
    texts = _texts(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")), id_col, text)
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b").select("a", "b", "ta", "tb")

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in batches:
            a_list, b_list = batch.column(0), batch.column(1)
            out_a, out_b, hub, hub_text = [], [], None, None
            for i in range(batch.num_rows):
                ta, tb = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                if ta != hub_text:
                    hub_text, hub = ta, shingles(ta, method.shingle)
                s = shingles(tb, method.shingle)
                if 100 * min(len(s), len(hub)) < method.percent * max(len(s), len(hub)):
                    continue
                shared = len(hub) + len(s) - len(np.union1d(hub, s))
                if shared and 100 * shared >= method.percent * (len(hub) + len(s) - shared):
                    out_a.append(a_list[i].as_py())
                    out_b.append(b_list[i].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (least node of its component, the root itself left
    out) from links ``a`` < ``b``. Writes its edges after every round and
    ends when a round changes none."""
    edges = materialize(links.select("a", "b"), "links")
    before = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("m").alias("v"), F.col("v").alias("u"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").where(F.col("v") != F.col("m")).select(F.col("m").alias("a"), F.col("v").alias("b"))
        edges = materialize(small.unionByName(root.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = now


def _plausible(pairs: DataFrame, sigs: DataFrame, method: Method) -> DataFrame:
    """The pairs whose signatures agree in as many bins as a link's may."""
    both = pairs.join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a").join(
        sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb")

    @returning_memory
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in batches:
            sa, sb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, method.bins) for i in (2, 3))
            near = pa.array((sa == sb).sum(axis=1) >= method.least_agreement)
            yield batch.select([0, 1]).filter(near)

    return both.mapInArrow(run, "a long, b long").distinct()


def _hubs(buckets: DataFrame) -> DataFrame:
    """``key``, ``hub``: of each bucket the member that meets most others, the greatest of equals."""
    return buckets.groupBy("key").agg(F.max(F.struct("met", "rep"))["rep"].alias("hub"))


def _star_pairs(buckets: DataFrame) -> DataFrame:
    """Pairs (``a`` < ``b``) of each bucket's hub with its other members."""
    pairs = buckets.select("key", "rep").join(_hubs(buckets), "key").where(F.col("rep") != F.col("hub"))
    return pairs.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of each set of ``left`` with each of ``right``, exact."""
    flat_l, flat_r = np.concatenate(left), np.concatenate(right)
    row_l = np.repeat(np.arange(len(left)), [len(x) for x in left])
    row_r = np.repeat(np.arange(len(right)), [len(x) for x in right])
    common = np.intersect1d(flat_l, flat_r)
    out = np.zeros((len(left), len(right)))

    def placed(flat: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns of the shingles in ``common``, by column."""
        at = np.searchsorted(common, flat)
        ok = np.flatnonzero(common[np.minimum(at, len(common) - 1)] == flat) if len(common) else at[:0]
        order = ok[np.argsort(at[ok], kind="stable")]
        return row[order], at[order]

    (row_l, col_l), (row_r, col_r) = placed(flat_l, row_l), placed(flat_r, row_r)
    for lo in range(0, len(common), COLUMNS):
        part = []
        for n, row, col in ((len(left), row_l, col_l), (len(right), row_r, col_r)):
            cut = slice(*np.searchsorted(col, (lo, lo + COLUMNS)))
            m = np.zeros((n, min(COLUMNS, len(common) - lo)), np.float32)
            m[row[cut], col[cut] - lo] = 1
            part.append(m)
        out += part[0] @ part[1].T
    return out


def joining_links(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Links between texts of different components, as many as join what they
    join. Both frames have ``rep``, ``comp`` and ``set`` (bytes of sorted shingles)."""
    sets_l, sets_r = ([np.frombuffer(x, "<u8") for x in side["set"]] for side in (left, right))
    shared = shared_counts(sets_l, sets_r)
    total = np.array([len(x) for x in sets_l])[:, None] + np.array([len(x) for x in sets_r])[None, :] - shared
    comp_l, comp_r = left["comp"].to_numpy(), right["comp"].to_numpy()
    link = (100 * shared >= percent * total) & (comp_l[:, None] != comp_r[None, :])
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while x in root:
            x = root[x]
        return x

    out = []
    for r in np.flatnonzero(link.any(axis=1)):
        partners = np.flatnonzero(link[r])
        for c in partners[np.unique(comp_r[partners], return_index=True)[1]]:
            x, y = find(int(comp_l[r])), find(int(comp_r[c]))
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((int(left["rep"].iloc[r]), int(right["rep"].iloc[c])))
    return out


def _open_links(buckets: DataFrame, labels: DataFrame, reps: DataFrame, stars: DataFrame, docs: DataFrame, method: Method,
                id_col: str, text: str) -> DataFrame:
    """Links (``a`` < ``b``) across components in buckets that hold more than
    one, enough of them to join all that are linked."""
    named = buckets.join(labels, F.col("rep") == F.col("node"), "left").select("key", "rep", F.coalesce("root", "rep").alias("comp"))
    open_keys = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key")
    members = named.join(open_keys.join(_hubs(buckets), "key"), "key").groupBy("hub", "rep").agg(F.min("comp").alias("comp"))
    members = materialize(members.join(reps.select("rep", "n_shingles"), "rep"), "open-members")
    sizes = members.groupBy("hub").agg(F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("weight"))
    members = members.join(sizes, "hub")
    few = members.where(F.col("size") <= SMALL_GROUP)
    other = few.select("hub", F.col("rep").alias("b"), F.col("comp").alias("comp_b"))
    pairs = few.withColumnRenamed("rep", "a").join(other, "hub").where((F.col("a") < F.col("b")) & (F.col("comp") != F.col("comp_b")))
    pairs = pairs.select("a", "b").distinct().join(stars, ["a", "b"], "left_anti")
    pairs = materialize(_plausible(pairs, reps.select("rep", "sig"), method), "open-pairs")
    many = members.where(F.col("size") > SMALL_GROUP)

    @returning_memory
    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in batches:
            sets = [shingles(t.as_py(), method.shingle).astype("<u8").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["rep", "set"])

    texts = _texts(docs, many.select(F.col("rep").alias("id")), id_col, text)
    sets = materialize(texts.mapInArrow(to_sets, "rep long, set binary"), "open-sets")
    n = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int")
    cells = many.withColumn("blk", F.pmod(F.xxhash64("rep"), n).cast("int")).withColumn(
        "_o", F.explode(F.sequence(F.lit(0), n - 1))).select(
        "hub", F.least("blk", "_o").alias("i"), F.greatest("blk", "_o").alias("j"), "blk", "rep", "comp").join(sets, "rep")

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        left, right = g[g["blk"] == g["i"]], g[g["blk"] == g["j"]]
        found = []
        if len(left) and len(right) and g["comp"].nunique() > 1:
            found = joining_links(left, right, method.percent)
        both = np.sort(np.array(found, np.int64).reshape(-1, 2), axis=1)
        return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})

    exact = cells.groupBy("hub", "i", "j").applyInPandas(compare, "a long, b long")
    return confirm(pairs, docs, method, id_col, text).unionByName(exact).distinct()


def near_duplicates(docs: DataFrame, method: Method = Method(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` (long), ``n_shingles``,
    ``component_id`` (smallest id reachable by links, its own included) and
    ``kept`` (it is that id). Actions: writes sketches, buckets, links and edges."""
    sketches = materialize(sketch(docs, method, id_col, text), "sketches")
    filled = sketches.where((F.col("n_shingles") > 0) & F.col("id").isNotNull())
    identity = ["s1", "s2", "n_shingles"]
    classes = filled.groupBy(*identity).agg(F.min("id").alias("rep"))
    nodes = materialize(filled.select("id", *identity).join(classes, identity).select("id", "rep", *identity), "classes")
    reps = filled.join(classes.withColumnRenamed("rep", "id"), ["id", *identity], "left_semi").select(
        F.col("id").alias("rep"), "bands", "sig", "n_shingles")
    buckets = reps.select("rep", F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count(F.lit(1)).alias("n"))
    buckets = buckets.join(shared.where(F.col("lo") != F.col("hi")).select("key", "n"), "key")
    met = F.sum("n").over(W.partitionBy("rep"))  # a rep has one row for each band
    buckets = materialize(buckets.select("key", "rep", met.alias("met")), "buckets")
    stars = materialize(_plausible(_star_pairs(buckets), reps.select("rep", "sig"), method), "star-pairs")
    links = materialize(confirm(stars, docs, method, id_col, text), "star-links")
    labels = components(links)
    more = materialize(_open_links(buckets, labels, reps, stars, docs, method, id_col, text), "open-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    named = nodes.join(labels, F.col("rep") == F.col("node"), "left").select(
        "id", "n_shingles", F.coalesce("root", "rep").alias("component_id"))
    alone = sketches.where(~((F.col("n_shingles") > 0) & F.col("id").isNotNull())).select(
        "id", "n_shingles", F.col("id").alias("component_id"))
    out = named.unionByName(alone)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
