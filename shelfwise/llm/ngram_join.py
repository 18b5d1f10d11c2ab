"""N-gram Jaccard join: exact links and link components of documents by shingle sets.

Jaccard(x, y) >= t means that the symmetric difference of the sets, a metric, is at most
(|x| + |y|) * (1 - t) / (1 + t). The join works in that metric space:

1. Signature regions. The hash range is cut into classes, about three shingles of a set in each.
   If at most D shingles differ, one of any D + 1 classes holds the same shingles on both sides,
   so each set enters the regions named by the contents of its first D + 1 non-empty classes.
   Sets that differ in size are compared on levels whose bounds grow by 1 / t; a set enters its
   own level and the one below. Sets with too few classes also enter one region for each of
   their first D + 1 shingles. Linked sets always meet in a region.
2. Near components. Class counts of a set (``sketches``) are a vector whose L1 distance to another
   never exceeds the symmetric difference. Each region is joined on them: pivots create Voronoi
   cells, a set is replicated to each cell whose pivot is within twice the link radius of its
   nearest, cells are joined recursively. Pairs within the radius are near; a region reports a
   spanning forest of its near pairs, never the pairs. Components of all forests are formed, and
   every linked pair lies in one of them.
3. Whole sets. Only sets with a near partner are fetched, each once, and dealt by near component,
   which is joined by the same recursion; here a near pair of unlike component is tested on the
   whole sets, and a link joins their components.

Regions and components of more than ``limit`` sets are first parted over tasks, by the same pivots
and windows in rounds, and where distances don't part them any more, by blocks that meet in pairs.
A signature that too many sets share is gathered by DataFrame operations in place of one task.

Sets are told apart by two 64-bit hashes of their shingles' 64-bit hashes. Copies of a set are one
node, so a hot group of copies costs no more than one document of it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, buckets_for, discard, materialize, mix64, release, shingle_sets, split_by_key, tidy, trim_memory

WIDTH = 5
#: Stored bytes of the input whose signatures share one bucket.
BUCKET_BYTES = 4 << 20
#: Bytes of a signature that are stored in its bucket, the rest of it being the bucket's. Where two
#: signatures agree in these by chance, their sets share a region, and whole sets still decide.
KEY_BYTES = 5
#: Signature bytes of a bucket that one task gathers; a larger bucket goes through DataFrame operations.
GATHER_BYTES = 64 << 20
#: Counts of a class-count vector; sets above ``FINE`` shingles have twice as many at each doubling.
SKETCH, FINE = 256, 2048
#: Sums of neighbouring counts that are compared first.
COARSE = 32
#: Sets of a region that are compared directly; above it the region is split by pivots.
LEAF, PIVOTS = 256, 12
#: Sets of a region that one task joins, and of all regions that share a task, on average.
LIMIT, GROUP_SETS = 1 << 13, 1 << 13
#: Rounds of splitting by pivots before the rest is split by blocks.
ROUNDS = 4


class Radius:
    """Integer arithmetic of a similarity of ``percent`` / 100."""

    def __init__(self, percent: int = 80):
        self.percent = percent
        bounds = [1]
        while bounds[-1] < 1 << 48:
            bounds.append(bounds[-1] * 100 // percent + 1)
        self.bounds = np.array(bounds, dtype=np.int64)

    def differ(self, a, b):
        """The most shingles in which linked sets of sizes a and b differ."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def largest(self, n):
        return n * 100 // self.percent

    def level(self, n):
        return np.searchsorted(self.bounds, n, side="right") - 1

    def classes(self, level):
        """Classes of a level; about three shingles in each at the level's upper bound."""
        return self.bounds[level + 1] * 33 // 100 + 3


def set_ids(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Two 64-bit ids (as columns) for each non-empty segment of sorted distinct hashes."""
    out = np.empty((len(starts), 2), dtype=np.int64)
    for column, (a, b) in enumerate(((0x5851F42D4C957F2D, 0x14057B7EF767814F), (0x9E6C63D0876A9A47, 0x2F0B4C47A5D1E3B9))):
        total = np.add.reduceat(mix64(hashes ^ np.uint64(a)), starts)
        other = np.bitwise_xor.reduceat(mix64(hashes + np.uint64(b)), starts)
        out[:, column] = mix64(total ^ mix64(other)).view(np.int64)
    return out


def signatures(hashes: np.ndarray, size: np.ndarray, radius: Radius) -> tuple[np.ndarray, np.ndarray]:
    """Region keys of sets laid end to end (sorted hashes, ``size`` of each), and whose they are."""
    owner = np.repeat(np.arange(len(size)), size)
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    keys, whose = [], []
    own = radius.level(size)
    for down in (0, 1):
        level = own - down
        some = level >= 0
        partner = radius.largest(size) if down == 0 else radius.bounds[np.maximum(own, 0)] - 1
        need = radius.differ(size, partner) + 1
        # a set of this size may be the larger of a pair on the lower level only if one is small enough
        some &= (down == 0) | (radius.largest(partner) >= size)
        m = radius.classes(np.maximum(level, 0)).astype(np.uint64)
        use = some[owner]
        h, o = hashes[use], owner[use]
        if not len(h):
            continue
        cls = ((h >> np.uint64(32)) * m[o]) >> np.uint64(32)
        change = np.flatnonzero(np.concatenate([[True], (cls[1:] != cls[:-1]) | (o[1:] != o[:-1])]))
        seg_owner = o[change]
        content = np.add.reduceat(mix64(h + np.uint64(0x2545F4914F6CDD1D)), change)
        begin = np.searchsorted(seg_owner, np.arange(len(size)))
        rank = np.arange(len(seg_owner)) - begin[seg_owner]
        kept = rank < need[seg_owner]
        tag = mix64((level[seg_owner].astype(np.uint64) << np.uint64(40)) + cls[change])
        keys.append(mix64(content ^ tag)[kept])
        whose.append(seg_owner[kept])
        count = np.bincount(seg_owner, minlength=len(size))
        weak = some & (count < need)
        if weak.any():
            place = np.arange(len(hashes)) - first[owner]
            pick = weak[owner] & (place < need[owner])
            keys.append(mix64(mix64(hashes[pick] + np.uint64(0x9FB21C651E98DF25)) + level[owner[pick]].astype(np.uint64)))
            whose.append(owner[pick])
    if not keys:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    return np.concatenate(keys), np.concatenate(whose)


def pack_keys(keys: np.ndarray) -> bytes:
    """The low ``KEY_BYTES`` bytes of each key."""
    return keys.astype("<u8").view("u1").reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    low = np.frombuffer(data, dtype="u1").reshape(-1, KEY_BYTES)
    return np.pad(low, ((0, 0), (0, 8 - KEY_BYTES))).view("<u8").ravel()


def _chunks(texts: pa.Array, limit: int = 1 << 18):
    """Lists of (row, set), some ``limit`` shingles each."""
    some, total = [], 0
    for i, s in enumerate(shingle_sets(texts, WIDTH)):
        some.append((i, s))
        total += len(s)
        if total >= limit:
            yield some
            some, total = [], 0
    if some:
        yield some


_PACKED = "bucket int, keys binary, sets binary, docs binary, sketches binary"
_INFO = np.dtype([("doc", "<i8"), ("gone", "?"), ("text", "<i8"), ("text_b", "<i8"), ("n", "<i8"), ("set", "<i8"), ("set_b", "<i8"), ("width", "<i4")])


def sketch_width(n):
    """How many classes the sketch of a set of n shingles counts."""
    return SKETCH << np.maximum(0, np.floor(np.log2(np.maximum(n, 1) / FINE)).astype(np.int64) + 1)


def sketches(hashes: np.ndarray, size: np.ndarray) -> list[bytes]:
    """How many hashes of each set fall into each of its classes, at most 255."""
    first, width = np.concatenate([[0], np.cumsum(size)]), sketch_width(size)
    mixed = mix64(hashes)
    out: list[bytes] = [b""] * len(size)
    for w in np.unique(width).tolist():
        some = np.flatnonzero(width == w)
        picked = np.concatenate([mixed[first[i] : first[i + 1]] for i in some])
        owner = np.repeat(np.arange(len(some)), size[some])
        cls = (picked >> np.uint64(65 - int(w).bit_length())).astype(np.int64)
        counts = np.minimum(np.bincount(owner * w + cls, minlength=len(some) * w), 255).astype(np.uint8).reshape(len(some), w)
        for i, row in zip(some.tolist(), counts):
            out[i] = row.tobytes()
    return out


def common_width(rows: list[bytes], least: int | None = None) -> np.ndarray:
    """Sketches as rows of one matrix, finer ones summed to the coarsest (or ``least``); distances only shrink."""
    least = least or min(map(len, rows))
    return np.stack([np.frombuffer(r, dtype=np.uint8).reshape(least, -1).sum(axis=1, dtype=np.int32) for r in rows])


def _emit(buckets: int, radius: Radius):
    """Packs signatures and document facts of a partition into one row for each chunk and bucket.

    A set that the partition has met before isn't sent again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(3)
            number = ids.fill_null(0).to_numpy(zero_copy_only=False)
            gone = ids.is_null().to_numpy(zero_copy_only=False)
            text_a, text_b = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
            for some in _chunks(texts):
                at = np.array([i for i, _ in some])
                size = np.array([len(s) for _, s in some], dtype=np.int64)
                facts = np.zeros(len(at), dtype=_INFO)
                facts["doc"], facts["gone"], facts["n"] = number[at], gone[at], size
                facts["text"], facts["text_b"] = text_a[at], text_b[at]
                full = np.flatnonzero(size)
                rows: dict[str, list] = {c: [] for c in ("bucket", "keys", "sets", "docs", "sketches")}
                drawn = b""
                if len(full):
                    flat = np.concatenate([some[i][1] for i in full])
                    sids = set_ids(flat, np.concatenate([[0], np.cumsum(size[full])[:-1]]))
                    facts["set"][full], facts["set_b"][full] = sids[:, 0], sids[:, 1]
                    new = []
                    for i, s in zip(full.tolist(), sids[:, 0].tolist()):
                        if s not in seen:
                            new.append((i, s))
                            if len(seen) < 1_000_000:
                                seen.add(s)
                    if new:
                        which, fresh = [i for i, _ in new], np.array([s for _, s in new], dtype=np.int64)
                        flat = np.concatenate([some[i][1] for i in which])
                        made = sketches(flat, size[which])
                        facts["width"][which] = [len(m) for m in made]
                        drawn = b"".join(made)
                        keys, whose = signatures(flat, size[which], radius)
                        bucket = (mix64(keys) % np.uint64(buckets)).astype(np.int64)
                        order = np.argsort(bucket, kind="stable")
                        bucket, keys, whose = bucket[order], keys[order], whose[order]
                        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                        for a, b in zip(cut, [*cut[1:], len(bucket)]):
                            rows["bucket"].append(int(bucket[a]))
                            rows["keys"].append(pack_keys(keys[a:b]))
                            rows["sets"].append(fresh[whose[a:b]].tobytes())
                            rows["docs"].append(None)
                            rows["sketches"].append(None)
                rows["bucket"].append(int(mix64(np.array([facts["text"][0] ^ len(at)]).view(np.uint64))[0] % np.uint64(buckets)))
                for c, v in (("keys", None), ("sets", None), ("docs", facts.tobytes()), ("sketches", drawn)):
                    rows[c].append(v)
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(rows["bucket"], pa.int32()), **{c: pa.array(rows[c], pa.binary()) for c in ("keys", "sets", "docs", "sketches")}
                })

    return run


def shared_regions(keys: np.ndarray, sets: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(region id, sorted members) of every distinct member list of two or more sets."""
    order = np.argsort(keys)
    keys, sets = keys[order], sets[order]
    same = keys[1:] == keys[:-1]
    both = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    keys, sets = keys[both], sets[both]
    if not len(keys):
        return []
    order = np.lexsort((sets, keys))
    keys, sets = keys[order], sets[order]
    once = np.concatenate([[True], (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])])
    keys, sets = keys[once], sets[once]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    lengths = np.diff(np.concatenate([starts, [len(keys)]]))
    names = mix64(np.add.reduceat(mix64(sets.view(np.uint64)), starts) + lengths.astype(np.uint64)).view(np.int64)
    names, starts, lengths = names[lengths > 1], starts[lengths > 1], lengths[lengths > 1]
    names, at = np.unique(names, return_index=True)
    return [(int(n), sets[starts[i] : starts[i] + lengths[i]]) for n, i in zip(names, at)]


#: What a gathered row is: a member of a region, a signature of a bucket too large for a task, facts of a document.
MEMBER, SPILLED, FACTS = 0, 1, 2
_GATHERED = "kind byte, region long, set_id long, set_b long, doc_id long, text_a long, text_b long, n long, sketch binary"
_TYPES = [pa.int8(), *[pa.int64()] * 7, pa.binary()]
_NAMES = [c.split()[0] for c in _GATHERED.split(", ")]


def _rows(kind: int, count: int, **columns) -> pa.RecordBatch:
    made = [pa.array(np.full(count, kind, dtype=np.int8))]
    for name, of in zip(_NAMES[1:], _TYPES[1:]):
        made.append(pa.array(columns[name], of) if name in columns else pa.nulls(count, of))
    return pa.RecordBatch.from_arrays(made, names=_NAMES)


def _facts(docs: bytes, drawn: bytes) -> pa.RecordBatch:
    f = np.frombuffer(docs, dtype=_INFO)
    none = f["n"] == 0
    ends = np.cumsum(f["width"])
    cut = [drawn[e - w : e] if w else None for e, w in zip(ends.tolist(), f["width"].tolist())]
    return _rows(
        FACTS, len(f), doc_id=pa.array(f["doc"], pa.int64(), mask=f["gone"]), text_a=np.ascontiguousarray(f["text"]), text_b=np.ascontiguousarray(f["text_b"]),
        n=np.ascontiguousarray(f["n"]), set_id=pa.array(f["set"], pa.int64(), mask=none), set_b=pa.array(f["set_b"], pa.int64(), mask=none), sketch=cut,
    )


def _gather(most: int):
    """Facts of a bucket's documents, and the members of its regions; a bucket of more than ``most``
    signature bytes is passed on signature by signature and never held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sets, bucket, held = [], [], 0, 0

        def spill() -> Iterator[pa.RecordBatch]:
            for k, s in zip(keys, sets):
                yield _rows(SPILLED, len(k), region=mix64(k ^ mix64(np.full(len(k), bucket, dtype=np.uint64))).view(np.int64), set_id=s)

        for batch in batches:
            for row in batch.to_pylist():
                if row["docs"] is not None:
                    yield _facts(row["docs"], row["sketches"])
                    continue
                bucket = row["bucket"]
                keys.append(unpack_keys(row["keys"]))
                sets.append(np.frombuffer(row["sets"], dtype=np.int64))
                held += len(row["keys"]) + len(row["sets"])
            if held > most:
                yield from spill()
                keys.clear(), sets.clear()
        if held > most:
            yield from spill()
        elif keys:
            found = shared_regions(np.concatenate(keys), np.concatenate(sets))
            keys.clear(), sets.clear()
            for i in range(0, len(found), 1 << 12):
                some = found[i : i + (1 << 12)]
                yield _rows(MEMBER, sum(len(m) for _, m in some), region=np.repeat([r for r, _ in some], [len(m) for _, m in some]), set_id=np.concatenate([m for _, m in some]))
        trim_memory()

    return run


class Forest:
    """Components of rows that are joined one link at a time."""

    def __init__(self, count: int):
        self.up = list(range(count))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        """The smallest row of each row's component."""
        up = np.array(self.up, dtype=np.int64)
        while True:
            over = up[up]
            if (over == up).all():
                return up
            up = over


Test = Callable[[int, int], bool]


def _meet(i: np.ndarray, j: np.ndarray, points: np.ndarray, coarse: np.ndarray, sizes: np.ndarray, radius: Radius, forest: Forest, test: Test | None) -> None:
    """Join the components of those row pairs (i, j) that are near and pass ``test``."""
    step = 1 << 16
    for at in range(0, len(i), step):
        a, b = i[at : at + step], j[at : at + step]
        most = radius.differ(sizes[a], sizes[b])
        open_ = np.abs(coarse[a] - coarse[b]).sum(axis=1) <= most
        a, b, most = a[open_], b[open_], most[open_]
        for k in range(0, len(a), 1 << 12):
            x, y = a[k : k + (1 << 12)], b[k : k + (1 << 12)]
            near = np.abs(points[x] - points[y]).sum(axis=1) <= most[k : k + (1 << 12)]
            for p, q in zip(x[near].tolist(), y[near].tolist()):
                if forest.root(p) != forest.root(q) and (test is None or test(p, q)):
                    forest.join(p, q)


def join_region(points: np.ndarray, sizes: np.ndarray, radius: Radius, test: Test | None = None) -> np.ndarray:
    """The component (as its smallest row) of each row of one region.

    Rows are near when the L1 distance of their ``points`` leaves a link open; a near pair of unlike
    component joins the two where ``test`` holds. Voronoi cells with windows, recursively.
    """
    points = points.astype(np.int32 if points.max(initial=0) > 1 << 14 else np.int16)
    coarse = points.reshape(len(points), COARSE, -1).sum(axis=2, dtype=np.int32) if points.shape[1] % COARSE == 0 else points
    reach = radius.differ(sizes, radius.largest(sizes))
    forest = Forest(len(points))

    def leaf(home: np.ndarray, rest: np.ndarray) -> None:
        every = np.concatenate([home, rest])
        at, rough, size = points[every], coarse[every], sizes[every]
        for k in range(len(home)):
            most = radius.differ(size[k], size[k + 1 :])
            open_ = np.flatnonzero(np.abs(rough[k + 1 :] - rough[k]).sum(axis=1) <= most)
            near = open_[np.abs(at[k + 1 :][open_] - at[k]).sum(axis=1) <= most[open_]]
            p = int(home[k])
            for q in every[k + 1 + near].tolist():
                if forest.root(p) != forest.root(q) and (test is None or test(p, q)):
                    forest.join(p, q)

    def join(home: np.ndarray, rest: np.ndarray) -> None:
        every = np.concatenate([home, rest])
        if len(every) <= LEAF:
            if len(rest) == 0 and len(home) > 1:
                i, j = np.triu_indices(len(home), 1)
                return _meet(home[i], home[j], points, coarse, sizes, radius, forest, test)
            return leaf(home, rest)
        picked = every[np.argsort(mix64(every.astype(np.uint64)), kind="stable")[:PIVOTS]]
        distance = np.stack([np.abs(points[every] - points[p]).sum(axis=1) for p in picked], axis=1)
        nearest = distance.argmin(axis=1)
        least = distance[np.arange(len(every)), nearest]
        inside = distance <= (least + 2 * reach[every])[:, None]
        at_home = np.arange(len(every)) < len(home)
        if inside.sum() > 3 * len(every):  # distances don't part it any more
            return leaf(home, rest)
        for q in range(len(picked)):
            core, ring = nearest == q, inside[:, q] & (nearest != q)
            if not core.any():
                continue
            # pairs are found where one of the two is at home; both orders of core and ring occur
            a, b = every[core & at_home], every[core & ~at_home]
            outer = every[ring]
            shrinks = core.sum() + ring.sum() < len(every)
            if len(a):
                (join if shrinks else leaf)(a, np.concatenate([b, outer]))
            if len(b):
                mine = every[ring & at_home]
                if len(mine):
                    (join if shrinks else leaf)(mine, b)

    join(np.arange(len(points)), np.empty(0, dtype=np.int64))
    return forest.roots()


def split_regions(members: DataFrame, limit: int, radius: Radius) -> DataFrame:
    """``members`` (region, node, n, sketch, ...) with no region of more than ``limit`` rows. Two
    near rows of a region still share one.

    Each round takes ``PIVOTS`` pivots of every large region, deals its rows by (region, salt) and
    sends a row to the cell of its nearest pivot and to those whose windows it lies in. Regions
    whose rows more than double in a round, and those left after the last, are dealt into blocks,
    each pair of which is a new region.
    """
    names = members.columns
    schema = ", ".join(f"{c} {t}" for c, t in members.dtypes)

    def large(df: DataFrame) -> DataFrame:
        sized = df.groupBy("region").agg(F.count("*").alias("rows"), F.min(F.length("sketch")).alias("width"))
        return materialize(sized.where(F.col("rows") > limit), "large")

    counts = large(members)
    if counts.isEmpty():
        return members
    done, rest = members.join(counts, "region", "left_anti"), members.join(counts.select("region"), "region", "left_semi")
    blocks = None
    for turn in range(ROUNDS):
        salt = F.pmod(F.xxhash64("node", F.lit(turn)), F.ceil(F.col("rows") * 2 / limit)).cast("int")
        dealt = rest.join(counts, "region").withColumn("salt", salt)
        pivots = (
            rest.withColumn("slot", F.pmod(F.xxhash64("node", F.lit(turn + 100)), F.lit(PIVOTS)).cast("int"))
            .groupBy("region", "slot").agg(F.min(F.struct(F.xxhash64("node"), "n", "sketch")).alias("p"))
            .join(counts, "region")
            .select(F.col("region").alias("of"), "slot", "p.sketch", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("rows") * 2 / limit) - 1).cast("int"))).alias("of_salt"))
        )

        def cells(rows: pd.DataFrame, at: pd.DataFrame) -> pd.DataFrame:
            if not len(rows):
                return pd.DataFrame(columns=[*names, "origin"])
            at = at.sort_values("slot")
            # one width for all tasks of a region, as windows hold within one metric
            points = common_width([*rows["sketch"], *at["sketch"]], int(rows["width"].iloc[0]))
            sizes = rows["n"].to_numpy()
            reach = radius.differ(sizes, radius.largest(sizes))
            distance = np.stack([np.abs(points[: len(rows)] - p).sum(axis=1) for p in points[len(rows) :]], axis=1)
            inside = distance <= (distance.min(axis=1) + 2 * reach)[:, None]
            row, cell = np.nonzero(inside)
            out = rows.iloc[row][names].copy()
            slot = at["slot"].to_numpy()[cell].astype(np.uint64)
            out["region"] = mix64(mix64(out["region"].to_numpy().view(np.uint64)) + slot + np.uint64(1 + 64 * turn)).view(np.int64)
            out["origin"] = rows["region"].to_numpy()[row]
            return out

        parted = dealt.groupBy("region", "salt").cogroup(pivots.groupBy("of", "of_salt")).applyInPandas(cells, f"{schema}, origin long")
        parted = materialize(parted, "cells")
        grown = parted.groupBy(F.col("origin").alias("region")).agg(F.count("*").alias("made")).join(counts, "region").where("made > 2 * rows").select("region")
        grown = materialize(grown, "grown")
        stuck = rest.join(grown, "region", "left_semi").join(counts, "region")
        blocks = stuck if blocks is None else blocks.unionByName(stuck)
        parted = parted.join(grown.withColumnRenamed("region", "origin"), "origin", "left_anti").select(*names)
        counts = large(parted)
        done = done.unionByName(parted.join(counts, "region", "left_anti"))
        rest = parted.join(counts.select("region"), "region", "left_semi")
        if counts.isEmpty():
            break
    blocks = blocks.unionByName(rest.join(counts, "region")).withColumn("parts", F.ceil(F.col("rows") * 2 / limit).cast("int"))
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts")).cast("int")
    paired = blocks.withColumn("own", own).withColumn("other", F.explode(F.expr("filter(sequence(0, parts - 1), x -> x <> own)")))
    region = F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other"))
    return done.unionByName(paired.withColumn("region", region).select(*names))


def _dealt(members: DataFrame, rows: int) -> DataFrame:
    """``members`` with a task number that keeps a region together, some ``GROUP_SETS`` of ``rows`` rows a task."""
    tasks = max(1, rows // GROUP_SETS)
    return members.withColumn("part", F.pmod(F.xxhash64("region"), F.lit(tasks)))


def near_edges(members: DataFrame, limit: int, radius: Radius) -> DataFrame:
    """(a, b): a spanning forest of the near pairs of each region (region, node, n, sketch)."""
    members = split_regions(members, limit, radius)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["region", "node"], ignore_index=True)
        region, node, n, drawn = group["region"].to_numpy(), group["node"].to_numpy(), group["n"].to_numpy(), group["sketch"].tolist()
        cut = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1], [True]]))
        a, b = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        for i, j in zip(cut.tolist(), cut[1:].tolist()):
            if j - i < 2:
                continue
            root = join_region(common_width(drawn[i:j]), n[i:j], radius)
            some = np.flatnonzero(root != np.arange(j - i))
            a.append(node[i + root[some]])
            b.append(node[i + some])
        trim_memory()
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()

    return _dealt(members, members.count()).groupBy("part").applyInPandas(run, "a long, b long").distinct()


def link_components(members: DataFrame, groups: DataFrame, limit: int, radius: Radius) -> DataFrame:
    """node, label: the smallest node that each member of a near component reaches by links.

    ``members`` has (region, node, n, sketch, hashes), the region being the near component, and
    ``groups`` the same nodes and regions, materialized.
    """
    rows = groups.count()
    parted = not groups.groupBy("region").agg(F.count("*").alias("rows")).where(F.col("rows") > limit).isEmpty()
    if parted:
        members = split_regions(materialize(members, "sets"), limit, radius)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["region", "node"], ignore_index=True)
        region, node, n, sets = group["region"].to_numpy(), group["node"].to_numpy(), group["n"].to_numpy(), group["hashes"].tolist()
        drawn = group["sketch"].tolist()
        cut = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1], [True]]))
        label = node.copy()
        for i, j in zip(cut.tolist(), cut[1:].tolist()):

            def linked(p: int, q: int, i: int = i) -> bool:
                common = len(np.intersect1d(sets[i + p], sets[i + q], assume_unique=True))
                return 100 * common >= radius.percent * (n[i + p] + n[i + q] - common)

            if j - i > 1:
                label[i:j] = node[i + join_region(common_width(drawn[i:j]), n[i:j], radius, linked)]
        trim_memory()
        return pd.DataFrame({"node": node, "label": label})

    found = _dealt(members, rows).groupBy("part").applyInPandas(run, "node long, label long")
    if not parted:
        return found
    found = materialize(found, "links")
    first = components(found.select(F.col("node").alias("a"), F.col("label").alias("b")))
    return found.select("node").distinct().join(first, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def _sets_of(texts: DataFrame) -> DataFrame:
    """Rows (region, node, text) with n, sketch and hashes of the text's set in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _chunks(batch.column(2)):
                at = pa.array([i for i, _ in some])
                sets = [s for _, s in some]
                size = np.array([len(s) for s in sets], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(size), pa.array(sketches(np.concatenate(sets), size), pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["region", "node", "n", "sketch", "hashes"],
                )

    return texts.mapInArrow(tidy(run), "region long, node long, n long, sketch binary, hashes array<long>")


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node that each node of ``edges`` (a, b) reaches.

    Alternates large and small stars; stars come from a partial minimum and a join, so a node
    with very many neighbours isn't gathered in one task.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if not state["n"] or (state["n"], state["h"]) == mark:
            break
        mark = (state["n"], state["h"])
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).distinct()
        small = materialize(small, "small")
        discard(now, large)
        now = small
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(now.select("v", "v").distinct())


def labelled(docs: DataFrame, percent: int = 80, limit: int = LIMIT, gather_bytes: int = GATHER_BYTES) -> DataFrame:
    """One row for each input row: doc_id, text_a, text_b (hashes of the text), n, and the pair
    (label, label_b) that all rows of a component share; it is null without words."""
    spark = docs.sparkSession
    bound_batches(spark)
    radius = Radius(percent)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_a"), F.xxhash64(F.lit(1), "text").alias("text_b"), "text")
    packed = rows.mapInArrow(tidy(_emit(buckets_for(docs, BUCKET_BYTES), radius)), _PACKED)
    gathered = materialize(packed.groupBy("bucket").applyInArrow(_gather(gather_bytes), _GATHERED), "gathered")
    release(spark)
    facts = gathered.where(f"kind = {FACTS}").drop("kind", "region")

    # regions: equal lists of members that several buckets have found have one name
    regions = gathered.where(f"kind = {MEMBER}").select("region", "set_id")
    spilled = gathered.where(f"kind = {SPILLED}").select("region", "set_id")
    if not spilled.isEmpty():
        spilled = spilled.distinct()
        shared = spilled.groupBy("region").agg(F.count("*").alias("rows")).where("rows > 1").select("region")
        regions = regions.unionByName(spilled.join(shared, "region", "left_semi"))
    # one row for each set, with one of its texts; of two sets that share an id by chance the second gets a new one
    def sets(*columns: str) -> DataFrame:
        drawn = F.struct("set_b", "n", *columns)
        found = facts.where("sketch IS NOT NULL").groupBy("set_id").agg(F.min(drawn).alias("x"), F.max(drawn).alias("y"))
        found = found.select("set_id", F.posexplode(F.expr("CASE WHEN x.set_b = y.set_b THEN array(x) ELSE array(x, y) END")).alias("place", "x"))
        return found.select("set_id", "x.*", F.when(F.col("place") == 0, F.col("set_id")).otherwise(F.xxhash64("set_id", "x.set_b")).alias("node"))

    members = materialize(regions.distinct().join(sets("sketch"), "set_id").select("region", "node", "n", "sketch"), "members")
    near = materialize(near_edges(members, limit, radius), "near")
    discard(members)
    groups = materialize(components(near).select("node", F.col("label").alias("region")), "groups")
    discard(near)
    release(spark)

    # whole sets of those with a near partner, from one text each
    wanted = materialize(groups.join(sets("text_a", "text_b").drop("n"), "node"), "wanted")
    some, _ = split_by_key(rows.select("text_a", "text_b", "text"), wanted.select("text_a"), "text_a")
    # copies are dropped before they are shuffled, so a hot text reaches a task once from each other
    once = some.dropDuplicates(["text_a", "text_b"]).join(wanted.select("text_a", "text_b", "region", "node"), ["text_a", "text_b"])
    links = materialize(link_components(_sets_of(once.select("region", "node", "text")), groups, limit, radius), "links")
    release(spark)
    roots = links.join(wanted.select("node", "set_id", "set_b"), "node").select("set_id", "set_b", F.col("label").alias("root"))
    named = facts.join(roots, ["set_id", "set_b"], "left")
    out = materialize(
        named.select("doc_id", "text_a", "text_b", "n", F.coalesce("root", "set_id").alias("label"), F.when(F.col("root").isNull(), F.col("set_b")).otherwise(F.lit(0)).alias("label_b")),
        "labelled",
    )
    discard(gathered, groups, wanted, links)
    return out


def ngram_join(docs: DataFrame, percent: int = 80, limit: int = LIMIT, gather_bytes: int = GATHER_BYTES) -> DataFrame:
    """One row for each input row: doc_id, n_shingles, component_id.

    Words are runs without the ASCII space and 0x09-0x0D, after lower-casing A-Z; a set holds the
    distinct 5-word shingles, or the whole sequence of a shorter text. Null texts and texts
    without words have no shingles, link with nothing and are their own component. Rows that
    repeat an id stay separate rows. component_id is the smallest id of the component; null ids
    are passed over by it. Other columns are ignored; no rows in, none out.
    """
    named = labelled(docs, percent, limit, gather_bytes)
    least = named.where("label IS NOT NULL").groupBy("label", "label_b").agg(F.min("doc_id").alias("least"))
    return named.join(least, ["label", "label_b"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, all its columns unchanged.

    The row with the smallest id stays (null ids come last), of rows with that id the one with the
    smallest hashes of its text, of rows that repeat both, any one. Rows are told apart by id and text,
    so a row that shares its id with a near copy of another stays. Rows without words are their own
    components and all stay. No rows in, none out.
    """
    named = labelled(docs, percent)
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_a", "text_b")
    first = named.where("label IS NOT NULL").groupBy("label", "label_b").agg(F.min(row).alias("first"), F.count("*").alias("rows")).where("rows > 1")
    judged = named.join(first, ["label", "label_b"]).select("doc_id", "text_a", "text_b", row.eqNullSafe(F.col("first")).alias("stays"))
    judged = judged.groupBy("doc_id", "text_a", "text_b", "stays").agg((F.count("*") > 1).alias("repeats"))
    judged = materialize(judged, "judged").toDF("_id", "_a", "_b", "_stays", "_repeats")
    names = docs.columns
    hashed = docs.withColumns({"_text_a": F.xxhash64("text"), "_text_b": F.xxhash64(F.lit(1), "text")})
    some, rest = split_by_key(hashed, judged.select(F.col("_a").alias("_text_a")), "_text_a")
    same = (F.col("_text_a") == F.col("_a")) & (F.col("_text_b") == F.col("_b")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
    out = rest.select(*names).unionByName(some.join(judged, same, "left").where("_stays IS NULL OR _stays AND NOT _repeats").select(*names))
    again = judged.where("_stays AND _repeats")
    if not again.isEmpty():
        out = out.unionByName(some.join(again, same).dropDuplicates(["doc_id", "_text_a", "_text_b"]).select(*names))
    return out
