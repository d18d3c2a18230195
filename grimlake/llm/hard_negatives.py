"""Hard negatives by inner product, over lists that clusters of anchors share.

Anchors are dealt to clusters by direction. For a cluster, with mean direction c
and members at most b away from it, a candidate x at angle t from c has an inner
product of at most |x| cos(t - b) with a member of norm one. The candidates are
sorted by that bound once, and every member walks the list; it ends, certified,
where the bound can't reach what the member already has.

On Spark, candidates lie in blocks and anchors in packs of neighbouring
clusters, both of bounded size, as packed rows. Every block meets every pack (the
query set against all rows): packs are broadcast some at a time, so neither
candidates nor anchors are shuffled per pair, and a job per wave bounds
memory, task time and what is lost with an executor. The best of every pair are
put together by anchor. Members start from what their own cluster's anchors
already give them, so lists end early and little is written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grimlake.llm.common import stored
from grimlake.llm.vector_codes import integers, matrix, whole_vectors

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
#: Candidates of a block, anchors of a pack (about), packs of a wave.
BLOCK, PACK, WAVE = 8192, 4096, 16
#: Members of a cluster (about), clusters at most, anchors from which their
#: directions are fitted. They only shape the lists: any clusters give the same result.
MEMBERS, CLUSTERS, FIT_ANCHORS, FIT_ROUNDS = 128, 1024, 20_000, 8
STEP = 512
SLACK = 1e-6
NO = np.iinfo(np.int64).min
PACKED = ("row", "id", "known", "label", "vec")
KINDS = {"row": np.int64, "id": np.int64, "known": np.uint8, "label": np.int64, "vec": np.float64,
         "cluster": np.int64, "floor": np.int64, "positive": np.int64}


def units(vec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(directions, norms); the zero vector has the direction zero."""
    norm = np.sqrt((vec * vec).sum(1))
    return vec / np.where(norm > 0, norm, 1.0)[:, None], norm


def fit_directions(vec: np.ndarray, k: int) -> np.ndarray:
    """``k`` directions at most, by rounds of assignment and averaging, in the
    order of their main axis, so that neighbours are near."""
    unit, _ = units(vec)
    centres = np.unique(unit[np.linspace(0, len(unit) - 1, k).astype(int)], axis=0)
    for _ in range(FIT_ROUNDS):
        best = (unit @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, best, unit)
        moved, norm = units(sums)
        centres = np.where(norm[:, None] > 0, moved, centres)
    if len(centres) > 2 and centres.shape[1]:
        axis = np.linalg.svd(centres - centres.mean(0), full_matrices=False)[2][0]
        centres = centres[np.argsort(centres @ axis, kind="stable")]
    return centres


class Table:
    """Packed rows as arrays."""

    def __init__(self, values: dict[str, np.ndarray]):
        self.__dict__.update(values)
        self.n = len(self.row)

    @classmethod
    def unpack(cls, packed: dict[str, bytes]) -> Table:
        out = {k: np.frombuffer(v, KINDS[k]) for k, v in packed.items()}
        n = len(out["row"])
        return cls({k: v.reshape(n, -1) if k in ("vec", "floor", "positive") else v for k, v in out.items()})

    def take(self, at: np.ndarray) -> Table:
        return Table({k: v[at] for k, v in self.__dict__.items() if k != "n"})

    def pack(self) -> dict[str, bytes]:
        return {k: np.ascontiguousarray(v, KINDS[k]).tobytes() for k, v in self.__dict__.items() if k != "n"}


def from_batch(batch: pa.RecordBatch, scale: int) -> Table:
    ids = batch.column("vec_id")
    return Table({"row": batch.column("row").to_numpy(), "id": ids.fill_null(np.iinfo(np.int64).max).to_numpy(),
                  "known": (~np.asarray(ids.is_null())).astype(np.uint8), "label": batch.column("label").to_numpy(),
                  "vec": integers(matrix(batch.column("vec")), scale).astype(np.float64)})


class Best:
    """Per target (an anchor, or an anchor and one of its positives) the best
    ``k`` hits so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.parts: list[np.ndarray] = []

    def add(self, target: np.ndarray, score: np.ndarray, rows: Table, at: np.ndarray) -> None:
        self.parts.append(np.stack([target, score, rows.id[at], rows.known[at].astype(np.int64), rows.row[at]]))

    def trim(self) -> np.ndarray:
        """(target, score, id, known, row) of the best, sorted."""
        hits = np.concatenate(self.parts, 1) if self.parts else np.zeros((5, 0), np.int64)
        hits = hits[:, np.lexsort((hits[4], hits[2], 1 - hits[3], -hits[1], hits[0]))]
        first = np.r_[True, hits[0, 1:] != hits[0, :-1]][:hits.shape[1]]
        place = np.arange(hits.shape[1]) - np.flatnonzero(first)[np.cumsum(first) - 1] if hits.shape[1] else hits[0]
        hits = hits[:, place < self.k]
        self.parts = [hits]
        return hits

    def floors(self, floor: np.ndarray) -> np.ndarray:
        """What a hit must reach now: the k-th best score, where there are k."""
        hits = self.trim()
        if not hits.shape[1]:
            return floor
        count = np.bincount(hits[0], minlength=len(floor))
        worst = np.full(len(floor), np.iinfo(np.int64).max)
        np.minimum.at(worst, hits[0], hits[1])
        return np.where(count >= self.k, np.maximum(floor, worst), floor)


def walk(members: Table, rows: Table, k: int, low: int, high: int) -> tuple[np.ndarray, int]:
    """The best hits (member * targets + target, score, id, known, row) of one
    cluster's members among ``rows``, and how many products it took.

    Without ``positive`` scores a member looks for rows of its own label; with
    them, per positive, for rows of other labels between the shares."""
    unit, norm = units(members.vec)
    centre = units(unit.sum(0, keepdims=True))[0][0]
    spread = np.arccos(np.clip(unit @ centre, -1, 1))[norm > 0].max(initial=0.0) + SLACK
    direction, size = units(rows.vec)
    bound = size * np.cos(np.maximum(np.arccos(np.clip(direction @ centre, -1, 1)) - spread, 0.0))
    order = np.argsort(-bound, kind="stable")
    seek_own = not hasattr(members, "positive")
    targets = members.floor.shape[1]
    floor, best, products = members.floor.copy(), Best(k), 0
    for at in range(0, len(order), STEP):
        # Bounds widened against rounding; a member walks on while a target can still be reached.
        reach = norm * bound[order[at]]
        going = np.flatnonzero(reach + SLACK * np.abs(reach) + 1 >= floor.min(1, initial=np.iinfo(np.int64).max).astype(np.float64))
        if not len(going):
            break
        some = order[at:at + STEP]
        score = members.vec[going] @ rows.vec[some].T
        products += score.size
        same = members.label[going, None] == rows.label[some]
        if seek_own:
            fit = same & (members.row[going, None] != rows.row[some]) & (score >= floor[going])
            m, x = np.nonzero(fit)
            best.add(going[m], score[m, x].astype(np.int64), rows, some[x])
        else:
            fit = ~same & (score >= floor[going].min(1)[:, None])
            m, x = np.nonzero(fit)
            s, who = score[m, x].astype(np.int64), going[m]
            for p in range(targets):
                ok = (s >= floor[who, p]) & (100 * s <= high * members.positive[who, p])
                best.add(who[ok] * targets + p, s[ok], rows, some[x[ok]])
        floor = best.floors(floor.ravel()).reshape(floor.shape)
    return best.trim(), products


def first_floors(members: Table, k: int, low: int, high: int) -> np.ndarray:
    """What hits must reach at least, from the cluster's own anchors; hits
    themselves come from the blocks, which hold the anchors too."""
    if hasattr(members, "positive"):
        # 100 * score >= low * positive; out of reach where nothing can satisfy both shares
        least = -((-low * members.positive) // 100)
        floor = np.where(100 * least > high * members.positive, np.iinfo(np.int64).max, least)
    else:
        floor = np.full((members.n, 1), NO)
    members.floor = floor
    hits, _ = walk(members, members, k, low, high)
    start = Best(k)
    start.parts = [hits]
    return start.floors(floor.ravel()).reshape(floor.shape)


def blocks(rows: DataFrame, scale: int) -> DataFrame:
    """Rows as packed blocks, made where the rows are read."""
    schema = T.StructType([T.StructField(c, T.BinaryType()) for c in PACKED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Table] = []

        def out() -> pa.RecordBatch:
            whole = Table({c: np.concatenate([getattr(t, c) for t in held]) for c in PACKED})
            held.clear()
            return pa.RecordBatch.from_pylist([whole.pack()])

        n = 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK // 4):
                held.append(from_batch(batch.slice(at, BLOCK // 4), scale))
                n += held[-1].n
                if n >= BLOCK:
                    yield out()
                    n = 0
        if held:
            yield out()

    return rows.mapInArrow(run, schema)


def packs(anchors: DataFrame, k: int, low: int, high: int, scale: int) -> DataFrame:
    """(pack, packed anchors with cluster and floor). ``anchors`` has pack,
    cluster, row, vec_id, label, vec and maybe positive, an array of scores."""
    with_positive = "positive" in anchors.columns
    names = [*PACKED, "cluster", "floor", *(["positive"] if with_positive else [])]
    schema = T.StructType([T.StructField("pack", T.LongType())] + [T.StructField(c, T.BinaryType()) for c in names])

    def run(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        whole = from_batch(batch, scale)
        whole.cluster = batch.column("cluster").to_numpy()
        if with_positive:
            lists = batch.column("positive")
            width = np.diff(lists.offsets.to_numpy())
            whole.positive = np.full((whole.n, width.max(initial=1)), -1, np.int64)  # -1: no share of it is reached
            whole.positive[np.arange(whole.positive.shape[1]) < width[:, None]] = lists.flatten().to_numpy()
        whole = whole.take(np.lexsort((whole.row, whole.cluster)))
        parts = []
        for a, b in spans(whole.cluster):
            members = whole.take(np.arange(a, b))
            parts.append(first_floors(members, k, low, high))
        whole.floor = np.concatenate(parts)
        return pa.Table.from_pylist([{"pack": batch.column("pack")[0].as_py(), **whole.pack()}],
                                    schema=pa.schema([("pack", pa.int64()), *((c, pa.binary()) for c in names)]))

    return anchors.groupBy("pack").applyInArrow(run, schema)


def spans(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal neighbours."""
    cut = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]) if len(values) else [0]
    yield from zip(cut[:-1], cut[1:])


HITS = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("target", T.IntegerType()),
                     T.StructField("score", T.LongType()), T.StructField("id", T.LongType()),
                     T.StructField("known", T.BooleanType()), T.StructField("row", T.LongType())])


def walks(candidates: DataFrame, packed: DataFrame, k: int, low: int, high: int, name: str) -> DataFrame:
    """The best ``k`` hits of every target in each block, over all packs, some
    packs at a time."""
    mine = [f"a_{c}" for c in packed.columns if c != "pack"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[bytes, Table] | None = None
        for batch in batches:
            for r in batch.to_pylist():
                if kept is None or kept[0] != r["row"]:
                    kept = r["row"], Table.unpack({c: r[c] for c in PACKED})
                pack = Table.unpack({c[2:]: r[c] for c in mine})
                for a, b in spans(pack.cluster):
                    members = pack.take(np.arange(a, b))
                    hits, _ = walk(members, kept[1], k, low, high)
                    targets = members.floor.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(members.row[hits[0] // targets]), pa.array((hits[0] % targets).astype(np.int32)),
                         pa.array(hits[1]), pa.array(hits[2]), pa.array(hits[3] > 0), pa.array(hits[4])],
                        names=[f.name for f in HITS])

    n = packed.agg(F.max("pack").alias("n")).first()["n"]
    out = None
    for at in range(0, (-1 if n is None else n) + 1, WAVE):
        some = packed.filter(F.col("pack").between(at, at + WAVE - 1)).select(*[
            F.col(c).alias(f"a_{c}") for c in packed.columns if c != "pack"])
        # A wave holds WAVE packs of bounded size, whatever the number of anchors.
        pairs = candidates.join(F.broadcast(some), F.lit(True))
        found = stored(pairs.mapInArrow(run, HITS), name)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else candidates.sparkSession.createDataFrame([], HITS)


def best_of(hits: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each target, with their place (from 1)."""
    order = [F.desc("score"), F.desc("known"), F.asc("id"), F.asc("row")]
    place = F.row_number().over(Window.partitionBy("anchor", "target").orderBy(*order))
    return hits.withColumn("place", place).filter(F.col("place") <= k)


def dealt(anchors: DataFrame, n: int, scale: int) -> DataFrame:
    """Anchors with cluster and pack. Directions are fitted on at most
    ``FIT_ANCHORS`` anchors; a pack is a group of neighbouring clusters, cut by
    row where it has more anchors than a pack holds."""
    many = -(-n // MEMBERS)
    fit = anchors.orderBy(F.xxhash64("row"), "row").limit(FIT_ANCHORS).select("vec").toArrow()
    centres = fit_directions(integers(matrix(fit.column("vec")), scale).astype(np.float64), min(many, CLUSTERS, fit.num_rows))
    groups = -(-n // PACK)
    per_group = -(-len(centres) // min(groups, len(centres)))
    schema = T.StructType([*anchors.schema.fields, T.StructField("cluster", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vec = integers(matrix(batch.column("vec")), scale).astype(np.float64)
                best = (vec @ centres.T).argmax(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best)], names=[*batch.schema.names, "cluster"])

    with_group = anchors.mapInArrow(run, schema).withColumn("group", F.floor(F.col("cluster") / per_group))
    with_group = stored(with_group, "negatives-anchors")
    counts = {r["group"]: -(-r["n"] // PACK) for r in with_group.groupBy("group").agg(F.count(F.lit(1)).alias("n")).collect()}
    # At most CLUSTERS groups: where each one's packs begin, and how many it has.
    first = dict(zip(sorted(counts), np.r_[0, np.cumsum([counts[g] for g in sorted(counts)])].tolist()))
    begin = F.create_map(*[F.lit(x) for g in first for x in (int(g), int(first[g]))])
    parts = F.create_map(*[F.lit(x) for g in counts for x in (int(g), int(counts[g]))])
    pack = begin[F.col("group")] + F.pmod(F.xxhash64("row"), parts[F.col("group")].cast("long"))
    return with_group.withColumn("pack", pack.cast("long")).drop("group")


RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE) -> DataFrame:
    """Per anchor and positive the first ``negatives`` rows of another label
    whose score lies between ``low`` and ``high`` per cent of the positive's:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` picks the anchors, by columns of ``rows``. A score is the inner
    product of the vectors' integers; higher ones come first, then smaller ids,
    null ids last. Rows with a null label, a null vector or a null or non-finite
    component take no part; rows with a null id can be positives and negatives.
    A row is not its own positive, but its repetitions are; an anchor that is
    repeated gets its rows once per repetition. Anchors without positives or
    without negatives give no rows, an empty table an empty result. Vectors
    must have one length.
    """
    spark = rows.sparkSession
    # An anchor condition that is null means no.
    kept = whole_vectors(rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                                     F.col(vec_col).alias("vec"), F.coalesce(anchor, F.lit(False)).alias("anchor")), "vec")
    kept = stored(kept.filter(F.col("label").isNotNull()).withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    anchors = kept.filter("anchor").select("row", "vec_id", "label", "vec")
    n = anchors.count()
    if not n:
        return spark.createDataFrame([], RESULT)
    anchors = dealt(anchors, n, scale)
    candidates = stored(blocks(kept.select("row", "vec_id", "label", "vec"), scale), "negatives-blocks")
    own = stored(packs(anchors, positives, low, high, scale), "negatives-packs")
    found = best_of(walks(candidates, own, positives, low, high, "negatives-positives"), positives)
    found = stored(found.select("anchor", (F.col("place") - 1).cast("int").alias("target"), "score",
                                F.when(F.col("known"), F.col("id")).alias("id")), "negatives-best")
    scores = found.groupBy("anchor").agg(F.expr("transform(array_sort(collect_list(struct(target, score))), x -> x.score)")
                                         .alias("positive"))
    own = stored(packs(anchors.join(scores, F.col("row") == F.col("anchor")).drop("anchor"), negatives, low, high, scale),
                 "negatives-packs")
    last = best_of(walks(candidates, own, negatives, low, high, "negatives-negatives"), negatives)
    last = last.select("anchor", "target", "place", "score", F.when(F.col("known"), F.col("id")).alias("id"))
    names = kept.filter("anchor").select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    pairs = found.select("anchor", "target", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return last.join(pairs, ["anchor", "target"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


SQL = """
WITH r AS MATERIALIZED (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256.0 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, a.label AS own, x.vec_id AS other_id, x.label AS other,
        CAST(list_sum(list_transform(list_zip(a.v, x.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM r a JOIN r x ON a.vec_id % 50 = 0 AND a.vec_id <> x.vec_id),
p AS MATERIALIZED (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE own = other
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
    SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS place
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.own <> s.other
        AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= 3
"""
