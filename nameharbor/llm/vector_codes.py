"""Vector codes: product quantisation in whole numbers, by matrix products split into limbs that stay exact."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Rows handled at once, and values that a hot label's total is sent out under.
ROWS, SALTS = 8192, 64
#: A float64 holds every whole number up to this one.
EXACT = 2**53


def range_of(length: int) -> int:
    """The largest component (either sign) for which the error of a vector still fits a long."""
    return math.isqrt(2**62 // max(1, length)) // 2


def bounds_of(length: int, parts: int) -> list[tuple[int, int]]:
    """Start and end of each part; where the length is no multiple, later parts are the longer ones."""
    return [(length * p // parts, length * (p + 1) // parts) for p in range(parts)]


def whole_vectors(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a vector of that length, all finite, and their floor(SCALE * x) as int64."""
    column = column.cast(pa.large_list(pa.float64()))
    good = np.zeros(len(column), bool)
    starts = column.offsets.to_numpy()
    sizes = np.diff(starts)
    if column.null_count:
        sizes[column.is_null().to_numpy(zero_copy_only=False)] = -1
    rows = np.flatnonzero(sizes == length)
    if not len(rows) or not length:
        good[rows] = True
        return good, np.zeros((len(rows), length), np.int64)
    values = column.values
    flat = values.to_numpy(zero_copy_only=False)  # nulls become NaN
    vectors = flat[starts[rows][:, None] + np.arange(length)]
    finite = np.isfinite(vectors).all(axis=1)
    good[rows[finite]] = True
    most = float(range_of(length))
    return good, np.clip(np.floor(vectors[finite] * SCALE), -most, most).astype(np.int64)


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 arrays that give ``values`` when the k-th is shifted by ``k * bits``; the last one has the sign."""
    out = []
    while True:
        if not values.size or int(np.abs(values).max()) < 1 << bits:
            return [*out, values.astype(np.float64)]
        out.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` of int64 matrices, exactly, through float64 BLAS.

    Limbs have so many bits that a sum over all columns of products of two limbs stays below 2^53;
    each product of limbs is then exact, and they are put together in int64.
    """
    columns = max(1, left.shape[1])
    bits = (EXACT.bit_length() - 1 - columns.bit_length()) // 2
    out = np.zeros((left.shape[0], right.shape[0]), np.int64)
    right_limbs = limbs(right, bits)
    for i, a in enumerate(limbs(left, bits)):
        for j, b in enumerate(right_limbs):
            out += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first nearest entry of each vector and the squared distance to it, both exact."""
    far = (vectors * vectors).sum(axis=1)[:, None] + (entries * entries).sum(axis=1) - 2 * exact_products(vectors, entries)
    first = far.argmin(axis=1)
    return first, far[np.arange(len(far)), first]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _first_vectors(rows: DataFrame, entries: int) -> tuple[int, list[list[int]]]:
    """The length of vectors, and the vectors that the codebooks start from: those of the smallest ids.

    A vector without a null or non-finite component counts; its length is that of all the others.
    """
    finite = F.forall("__vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.filter(F.col("__vector").isNotNull() & finite)
    order = [F.col("__id").asc_nulls_last(), F.col("__vector")]
    first = kept.orderBy(*order).first()
    if first is None:
        return 0, []
    length = len(first["__vector"])
    smallest = kept.filter(F.size("__vector") == length).orderBy(*order).limit(entries).collect()
    most = range_of(length)
    return length, [[max(-most, min(most, math.floor(x * SCALE))) for x in row["__vector"]] for row in smallest]


def _moved(rows: DataFrame, books: list[np.ndarray], length: int) -> list[np.ndarray]:
    """The codebooks after one round; only sums and counts of each entry leave the tasks."""
    bounds = bounds_of(length, len(books))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        totals = [np.zeros(b.shape, object) for b in books]  # Python numbers do not run over
        for batch in _slices(batches):
            _, vectors = whole_vectors(batch.column("__vector"), length)
            for p, (a, z) in enumerate(bounds):
                entry, _ = nearest(vectors[:, a:z], books[p])
                counts[p] += np.bincount(entry, minlength=len(books[p]))
                for e in np.unique(entry):
                    totals[p][e] += vectors[entry == e, a:z].sum(axis=0).astype(object)
        out = [(p, e, k, int(counts[p][e]), str(total)) for p in range(len(books)) for e in np.flatnonzero(counts[p]).tolist()
               for k, total in enumerate(totals[p][e].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(
            (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string()))], ["part", "entry", "place", "n", "total"])

    got = rows.select("__vector").mapInArrow(sums, "part int, entry int, place int, n long, total string")
    got = got.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    moved = [b.copy() for b in books]
    for row in got.collect():  # ENTRIES numbers for each component
        moved[row["part"]][row["entry"], row["place"]] = int(row["total"]) // row["n"]
    return moved


def fitted_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[int, list[np.ndarray]]:
    """Length of the vectors and the codebook of each part, over all rows (``__id``, ``__vector``)."""
    length, first = _first_vectors(rows, entries)
    books = [np.array([v[a:z] for v in first], np.int64).reshape(len(first), z - a) for a, z in bounds_of(length, parts)]
    for _ in range(rounds if first else 0):
        books = _moved(rows, books, length)
    return length, books


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def vector_codes(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``id, code, error, label, label_error, codebooks_sha256`` of each vector; ``id`` and ``label`` keep their names.

    Every component x counts as floor(4096 x). A codebook for each of ``parts`` starts from the
    vectors of the ``entries`` smallest ids and moves ``rounds`` times to the floored means; then
    each part gets the first nearest entry, ``code`` two hex digits for each.

    Rows whose vector is null, or holds a null or non-finite component, are dropped. The length of
    the vector of the smallest id is that of all; rows of another length are dropped too. Rows that
    share an id are taken in the order of their vectors, null ids last; each repeated row is a row
    of its own. With fewer vectors than entries the codebooks are shorter. A length that is no
    multiple of ``parts`` gives parts that differ by one. Components saturate where the error of a
    vector might not fit a long (2^27 for 64 components, that is values beyond 32,768); a label's
    error that does not fit one is null. Null labels are one label. Other columns are not looked at,
    whatever their names; an empty table gives no row.
    """
    narrow = rows.select(F.col(f"`{id_column}`").alias("__id"), F.col(f"`{vector}`").cast("array<double>").alias("__vector"),
                         F.col(f"`{label}`").alias("__label"))
    length, books = fitted_books(narrow, parts, entries, rounds)
    bounds = bounds_of(length, parts)
    hexes = np.array([f"{e:02x}" for e in range(max(1, entries))])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not len(books[0]):
            return
        for batch in _slices(batches):
            good, vectors = whole_vectors(batch.column("__vector"), length)
            error, code = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), "<U0")
            for p, (a, z) in enumerate(bounds):
                entry, far = nearest(vectors[:, a:z], books[p])
                error += far
                code = np.char.add(code, hexes[entry])
            kept = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([kept.column("__id"), kept.column("__label"), pa.array(code.tolist(), pa.string()),
                                              pa.array(error, pa.int64())], ["__id", "__label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    codes = narrow.select("__id", "__label", "__vector").mapInArrow(
        coded, f"__id {kinds['__id']}, __label {kinds['__label']}, code string, error long")
    # a label's total is joined under SALTS keys, so that the rows of a hot label are spread over tasks
    totals = codes.groupBy("__label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    totals = totals.select(F.col("__label").alias("__of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__to"))
    salted = codes.withColumn("__salt", F.pmod(F.xxhash64("code", "__id"), F.lit(SALTS)).cast("int"))
    out = salted.join(totals, salted["__label"].eqNullSafe(totals["__of"]) & (salted["__salt"] == totals["__to"]))
    return out.select(F.col("__id").alias(id_column), "code", "error", F.col("__label").alias(label), "label_error",
                      F.lit(books_digest(books)).alias("codebooks_sha256"))


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    rows = vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _sql() -> str:
    steps = [f"""
WITH whole AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT vec_id, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS v FROM whole, range({PARTS}) AS t(p)),
book0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v AS c FROM part
  WHERE vec_id IN (SELECT vec_id FROM whole ORDER BY vec_id LIMIT {ENTRIES}))"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""
far{r} AS (SELECT vec_id, p, v, e, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM part JOIN book{r} USING (p)),
near{r} AS MATERIALIZED (SELECT vec_id, p, any_value(v) AS v, min({{'d': d, 'e': e}}) AS best FROM far{r} GROUP BY vec_id, p)""")
        if r < ROUNDS:
            steps.append(f"""
sum{r} AS (SELECT p, best.e AS e, i, sum(v[i + 1])::HUGEINT AS s, count(*) AS n
  FROM near{r}, range((SELECT max(len(v)) FROM part)) AS t(i) WHERE i < len(v) GROUP BY p, best.e, i),
mean{r} AS (SELECT p, e, list(CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END::BIGINT ORDER BY i) AS c FROM sum{r} GROUP BY p, e),
book{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(mean{r}.c, book{r}.c) AS c FROM book{r} LEFT JOIN mean{r} USING (p, e))""")
    return ",".join(steps) + f""",
coded AS (SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near{ROUNDS} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN whole USING (vec_id), digest
"""


OP13_SQL = _sql()
