"""Product codes of vectors, fitted with norm-of-sum bounds.

Vectors of integers are cut into parts; each part has a codebook that is fitted
by rounds of nearest-entry assignment and averaging. Every codebook of the past
is retained (a few thousand integers). A row carries, per part, its entry, an
upper bound on the distance to it and a lower bound on the distance to every
other entry, each with the round in which it was exact. In a later round both
are moved by the true net displacement of the entries since that round (the
norm of the sum of the moves), which is never more than the sum of the moves'
norms. Only parts whose bounds cross are measured again: first against their own
entry, then, if that isn't enough, against the whole codebook.

Rows and bounds are one table, written anew each round; the table of the round
before is deleted then. Tasks also write what their moved parts add to the sums
and counts of the entries, so a round is one pass with no shuffle of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grimlake.llm.common import drop_stored, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integers beyond this would not fit the sums of squares.
LARGEST = 1 << 26
#: Below this, squared distances are exact in doubles, which have a fast product.
SMALL = 1 << 22
#: Share by which a bound is widened against rounding.
SLACK = 1e-9
ROWS, SUMS = "rows", "sums"


def whole_vectors(df: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector is there and holds only finite numbers."""
    vec = F.col(vec_col)
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.filter(vec.isNotNull() & ~F.coalesce(odd, F.lit(True)))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as an array (rows, length) of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(column) and len(flat) != len(column) * len(column[0]):
        raise ValueError("vectors of different lengths")
    return flat.reshape(len(column), -1)


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    out = np.floor(scale * vectors)
    if out.size and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST / scale:g}")
    return out.astype(np.int64)


def squared(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (n, k) between integer parts (n, w) and entries (k, w)."""
    top = max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.float64 if top < SMALL and parts.shape[1] <= 64 else np.int64
    p, e = parts.astype(kind), entries.astype(kind)
    if kind is np.float64:
        return ((p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)).astype(np.int64)
    return ((p[:, None, :] - e[None, :, :]) ** 2).sum(2)


def up(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + SLACK)).astype(np.float32), np.float32(np.inf))


def down(x: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter((x * (1 - SLACK)).astype(np.float32), np.float32(-np.inf)), np.float32(0))


class History:
    """All codebooks so far, (rounds, parts, entries, width), and how far each
    entry is now from where it was in each earlier round."""

    def __init__(self, books: np.ndarray):
        self.books = books
        self.now = len(books) - 1
        step = (books[-1] - books).astype(np.float64)
        self.own = np.sqrt((step * step).sum(3)) * (1 + SLACK)  # (rounds, parts, entries)
        k = self.own.shape[2]
        rest = np.repeat(self.own[:, :, None, :], k, 2)
        rest[:, :, np.arange(k), np.arange(k)] = 0.0
        self.other = rest.max(3)  # the largest of the entries besides this one


class Bounds:
    """Per row and part: entry, upper and lower bound, and the rounds in which
    they were exact."""

    def __init__(self, n: int, parts: int):
        self.entry = np.zeros((n, parts), np.uint8)
        self.upper = np.full((n, parts), np.inf, np.float32)
        self.lower = np.zeros((n, parts), np.float32)
        self.upper_at = np.zeros((n, parts), np.uint8)
        self.lower_at = np.zeros((n, parts), np.uint8)

    FIELDS = ("entry", "upper", "lower", "upper_at", "lower_at")

    @classmethod
    def read(cls, batch: pa.RecordBatch, parts: int) -> Bounds:
        out = cls(0, parts)
        for f in cls.FIELDS:
            kind = getattr(out, f).dtype
            data = b"".join(batch.column(f).to_pylist())
            setattr(out, f, np.frombuffer(data, kind).reshape(-1, parts).copy())
        return out

    def column(self, field: str) -> pa.Array:
        x = np.ascontiguousarray(getattr(self, field))
        width = x.dtype.itemsize * x.shape[1]
        offsets = pa.py_buffer((np.arange(len(x) + 1) * width).astype(np.int32).tobytes())
        return pa.Array.from_buffers(pa.binary(), len(x), [None, offsets, pa.py_buffer(x.tobytes())])

    def assign(self, rows: np.ndarray, past: History, first: bool) -> tuple[int, int]:
        """Move to the nearest entries of the newest codebook. Returns how many
        parts were measured against their own entry, and against all."""
        own = scans = 0
        for p in range(self.entry.shape[1]):
            book, a = past.books[-1, p], self.entry[:, p]
            near = np.arange(len(rows))
            if not first:
                lower = self.lower[:, p] - past.other[self.lower_at[:, p], p, a]
                upper = self.upper[:, p] + past.own[self.upper_at[:, p], p, a]
                near = np.flatnonzero(~(lower > upper))  # equal: another entry may come first
                if len(near):
                    step = rows[near, p] - book[a[near]]
                    exact = up(np.sqrt((step * step).sum(1).astype(np.float64)))
                    self.upper[near, p], self.upper_at[near, p] = exact, past.now
                    own += len(near)
                    near = near[~(lower[near] > exact)]
            scans += len(near)
            for at in range(0, len(near), 8192):
                some = near[at:at + 8192]
                d = squared(rows[some, p], book)
                best = d.argmin(1)
                self.entry[some, p] = best
                self.upper[some, p] = up(np.sqrt(d[np.arange(len(some)), best].astype(np.float64)))
                d[np.arange(len(some)), best] = np.iinfo(np.int64).max
                rest = d.min(1).astype(np.float64) if d.shape[1] > 1 else np.full(len(some), np.inf)
                self.lower[some, p] = down(np.sqrt(rest))
                self.upper_at[some, p] = self.lower_at[some, p] = past.now
        return own, scans

    def errors(self, rows: np.ndarray, past: History) -> np.ndarray:
        total = np.zeros(len(rows), np.int64)
        for p in range(rows.shape[1]):
            step = rows[:, p] - past.books[-1, p, self.entry[:, p]]
            total += (step * step).sum(1)
        return total


class Sums:
    """What moved parts add to the sums and counts of the entries."""

    def __init__(self, shape: tuple[int, int, int]):
        self.sums = np.zeros(shape, np.int64)
        self.counts = np.zeros(shape[:2], np.int64)
        self.own = self.scans = 0

    def move(self, rows: np.ndarray, before: np.ndarray | None, after: np.ndarray) -> None:
        for p in range(rows.shape[1]):
            moved = np.arange(len(rows)) if before is None else np.flatnonzero(before[:, p] != after[:, p])
            np.add.at(self.sums[p], after[moved, p], rows[moved, p])
            np.add.at(self.counts[p], after[moved, p], 1)
            if before is not None:
                np.subtract.at(self.sums[p], before[moved, p], rows[moved, p])
                np.subtract.at(self.counts[p], before[moved, p], 1)


def row_schema(df: DataFrame) -> T.StructType:
    bounds = [T.StructField(f, T.BinaryType()) for f in Bounds.FIELDS]
    return T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("vec_id", df.schema["vec_id"].dataType),
        T.StructField("label", df.schema["label"].dataType), T.StructField("vec", T.ArrayType(T.IntegerType())), *bounds,
        T.StructField("error", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType())),
        T.StructField("counts", T.ArrayType(T.LongType()))])


def one_round(df: DataFrame, books: np.ndarray, scale: int, final: bool) -> DataFrame:
    """Rows with new entries and bounds (kind "rows"), and behind them one row per
    task with its sums, counts and numbers of measurements (kind "sums"): reading
    either kind passes over the other's pages."""
    first, shape = len(books) == 1, books.shape[1:]
    schema = row_schema(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        names = to_arrow_schema(schema)
        past, total = History(books), Sums(shape)

        def out(n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([columns["kind"]] * n, names.field(i).type) if f.name == "kind" else
                 columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type)
                 for i, f in enumerate(names)], schema=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            vec = batch.column("vec")
            flat = integers(matrix(vec), scale) if first else matrix(vec).astype(np.int64)
            rows = flat.reshape(len(flat), shape[0], shape[2])
            bounds = Bounds(len(rows), shape[0]) if first else Bounds.read(batch, shape[0])
            before = None if first else bounds.entry.copy()
            own, scans = bounds.assign(rows, past, first)
            total.own, total.scans = total.own + own, total.scans + scans
            total.move(rows, before, bounds.entry)
            ends = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
            yield out(len(rows), kind=ROWS, vec_id=batch.column("vec_id"), label=batch.column("label"),
                      vec=pa.ListArray.from_arrays(ends, pa.array(flat.astype(np.int32).ravel())),
                      **{f: bounds.column(f) for f in Bounds.FIELDS},
                      **({"error": pa.array(bounds.errors(rows, past))} if final else {}))
        yield out(1, kind=SUMS, sums=pa.array([total.sums.ravel()], pa.list_(pa.int64())),
                  counts=pa.array([[*total.counts.ravel(), total.own, total.scans]], pa.list_(pa.int64())))

    return df.mapInArrow(run, schema)


def added_up(sums: DataFrame, col: str, n: int) -> np.ndarray:
    """Position by position sum of an array column of ``n`` numbers; ``n`` is a
    codebook's size, whatever the number of rows."""
    got = sums.select(F.posexplode(col)).groupBy("pos").agg(F.sum("col").alias("n")).collect()
    out = np.zeros(n, np.int64)
    for r in got:
        out[r["pos"]] = r["n"]
    return out


class Codes:
    """``rows``: (vec_id, label, entry, error); ``books``: all codebooks,
    (rounds + 1, parts, entries, width); ``measured``: per round, how many parts
    were measured against their own entry and against a whole codebook."""

    def __init__(self, rows: DataFrame, books: np.ndarray, measured: list[tuple[int, int]]):
        self.rows, self.books, self.measured = rows, books, measured

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books[-1].ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """Codes of all rows whose vector is not null and holds no null and no
    non-finite component; other rows are left out.

    Codebooks start as the vectors of the smallest ids (equal ids by vector,
    null ids last); with fewer rows than ``entries`` there are as many entries
    as rows. Equal distances go to the lower entry. Repeated rows each count
    and are each returned; ids and labels, null ones too, are passed through;
    an empty table gives an empty result. Vectors must have one length, which
    ``parts`` divides, and integers up to 2^26: else an error is raised.
    """
    rows = whole_vectors(vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                                        F.col(vec_col).alias("vec")), "vec")
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vec").select("vec").limit(entries).collect()
    width = len(start[0]["vec"]) if start else 0
    if width % parts:
        raise ValueError(f"{parts} parts don't divide vectors of length {width}")
    first = integers(np.array([r["vec"] for r in start], np.float64).reshape(len(start), width), scale)
    books = first.reshape(len(start), parts, width // parts).transpose(1, 0, 2)[None]
    sums, counts, measured, found = np.zeros(books.shape[1:], np.int64), np.zeros(books.shape[1:3], np.int64), [], None
    if not start:
        empty = rows.select("vec_id", "label", F.lit(b"").alias("entry"), F.lit(0).cast("long").alias("error"))
        return Codes(empty.limit(0), books, [])
    for k in range(rounds + 1):
        source = rows if found is None else found.filter(F.col("kind") == ROWS)
        before, found = found, stored(one_round(source, books, scale, k == rounds), f"codes-{k}")
        if before is not None:
            drop_stored(before)
        told = found.filter(F.col("kind") == SUMS)
        more = added_up(told, "counts", counts.size + 2)
        measured.append((int(more[-2]), int(more[-1])))
        if k == rounds:
            break
        sums = sums + added_up(told, "sums", sums.size).reshape(sums.shape)
        counts = counts + more[:-2].reshape(counts.shape)
        # floor of the mean; an entry without parts stays as it is
        mean = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books[-1])
        books = np.concatenate([books, mean[None]])
    return Codes(found.filter(F.col("kind") == ROWS).select("vec_id", "label", "entry", "error"), books, measured)


def code_digits(entry: F.Column) -> F.Column:
    """Entries, a byte each, as two hex digits each."""
    return F.lower(F.hex(entry))


def with_label_errors(codes: Codes) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256). A label's errors
    are summed by partial aggregation and its total joined back, so that a
    frequent label is in no one task."""
    totals = stored(codes.rows.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")
    rows = codes.rows.alias("r").join(totals.alias("t"), F.col("r.label").eqNullSafe(F.col("t.label")))
    return rows.select("r.vec_id", code_digits(F.col("r.entry")).alias("code"), "r.error", "t.label_error",
                       F.lit(codes.digest()).alias("codebooks_sha256"))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same result in plain SQL: every part against every entry, each round."""
    steps = [f"""
e AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale}.0 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS MATERIALIZED (SELECT vec_id, label, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS p
    FROM e, range({parts}) t(part)),
b0 AS MATERIALIZED (SELECT part, entry, p FROM (SELECT part, p, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry
    FROM c) WHERE entry < {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""
d{k} AS MATERIALIZED (SELECT c.vec_id, c.label, c.part, any_value(c.p) AS p, min(b.entry + {entries} * list_sum(list_transform(
    list_zip(c.p, b.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS best FROM c JOIN b{k} b ON c.part = b.part GROUP BY c.vec_id, c.label, c.part),
a{k} AS MATERIALIZED (SELECT *, CAST(best % {entries} AS BIGINT) AS entry, CAST(best // {entries} AS BIGINT) AS error FROM d{k})""")
        if k < rounds:
            steps.append(f"""
u{k} AS (SELECT part, entry, pos, sum(p[pos]) AS s, count(*) AS n FROM a{k}, range(1, 1 + (SELECT max(len(p)) FROM c)) t(pos)
    GROUP BY part, entry, pos),
m{k} AS (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS p FROM u{k} GROUP BY part, entry),
b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.p, b.p) AS p FROM b{k} b LEFT JOIN m{k} m USING (part, entry))""")
    return "WITH" + ",".join(steps) + f""",
r AS (SELECT vec_id, label, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error
    FROM a{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256 FROM r"""


SQL = sql()
