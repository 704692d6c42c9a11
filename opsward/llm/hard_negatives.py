"""Hard negatives by Fagin's threshold algorithm over blocks of candidates.

Rows are cut into blocks by label, then id; a label with many rows fills many blocks. A block keeps its rows' integer
vectors and, for every dimension, the list of its rows sorted by that component. Every group of anchors meets every
block, which is a search of stated queries against all rows in blocks of bounded size: a task reads some stored
blocks and some stored groups, so no label or vector decides how much it gets, and nothing is copied for all tasks.

In a block each anchor reads the lists of all dimensions in parallel, from the large end where its component is positive,
from the small end where it is negative, not at all where it is zero. A row met for the first time is
scored in full (random access, integer inner product). The components last read give the highest score a row not
met yet can have: the threshold. Reading stops once the threshold lies strictly below the kth score of every
window asked for (or below the window), so rows that tie with the kth are always met and the smaller id wins.
A first search finds each anchor's positives, a second one the negatives in the windows they open. What blocks
find is merged by anchor; a block returns no more than k rows for each window.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take no part; of rows that agree
in id the one with the smallest label, then vector stays; missing components of shorter vectors count as zero;
components are capped at the range of a long, as are scores; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

BLOCK_ROWS = 8192
GROUP_ANCHORS = 512
#: Most lanes of blocks and of groups: a task for every two of them, and it holds the groups of its lane.
BLOCK_LANES = 1000
GROUP_LANES = 20
FIRST_DEPTH = 32
#: What a worker gets at once: about one pair of a block and a group.
ARROW_BYTES = "4194304"
_LONG = np.iinfo(np.int64)


def integer_rows(embeddings: DataFrame, id_col: str, vector: str, label: Column, scale: int) -> DataFrame:
    """id, label and the vector of floor(scale * component) of every row that takes part."""
    real = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(real, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = embeddings.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        F.when(finite, F.transform(real, lambda x: F.floor(x * F.lit(float(scale))))).alias("vector"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    best = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("best"))
    return best.select("id", "best.label", "best.vector")


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All elements of an array column, and how many each row has."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(column.offsets.to_numpy())


def _matrix(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    if len(sizes) and (sizes == sizes[0]).all():
        return values.reshape(len(sizes), sizes[0])
    out = np.zeros((len(sizes), sizes.max(initial=0)), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _pack(batches: Iterable[pa.RecordBatch], rows_each: int, pack_rows) -> Iterator[pa.RecordBatch]:
    """One row for about as many rows as asked for (fewer than twice)."""
    held, n = [], 0

    def packed(table: pa.Table) -> pa.RecordBatch:
        fields = {"low": table["label"][0].as_py(), "high": table["label"][-1].as_py(), "n": len(table)} | pack_rows(table)
        return pa.RecordBatch.from_pylist([fields])

    for batch in batches:
        held.append(batch)
        n += len(batch)
        while n >= 2 * rows_each:
            table = pa.Table.from_batches(held)
            yield packed(table.slice(0, rows_each))
            held, n = table.slice(rows_each).to_batches(), n - rows_each
    if n:
        yield packed(pa.Table.from_batches(held))


def _vectors(table: pa.Table) -> dict:
    matrix = _matrix(*_flat(table["vector"]))
    ids, labels = (table[c].to_numpy() for c in ("id", "label"))
    return {"ids": ids.tobytes(), "labels": labels.tobytes(), "dims": matrix.shape[1], "vectors": matrix.tobytes()}


def _block_fields(table: pa.Table) -> dict:
    fields = _vectors(table)
    matrix = np.frombuffer(fields["vectors"], np.int64).reshape(len(table), fields["dims"])
    return fields | {"lists": np.argsort(matrix.T, axis=1)[:, ::-1].astype(np.int32).tobytes()}


def _group_fields(table: pa.Table) -> dict:
    fields = _vectors(table)
    for name in [c for c in table.column_names if c in ("wanted", "wanted_scores")]:
        values, sizes = _flat(table[name])
        fields |= {name: values.tobytes(), f"n_{name}": sizes.astype(np.int64).tobytes()}
    return fields


_PACKED = "low long, high long, n long, ids binary, labels binary, dims long, vectors binary"
_WANTED = ", wanted binary, n_wanted binary, wanted_scores binary, n_wanted_scores binary"


def pack(rows: DataFrame, n_rows: int, rows_each: int, kind: str) -> DataFrame:
    """The rows in stored packs ordered by label, then id."""
    parts = max(1, -(-n_rows // rows_each))
    make = _block_fields if kind == "blocks" else _group_fields
    schema = _PACKED + (", lists binary" if kind == "blocks" else _WANTED if "wanted" in rows.columns else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pack(batches, rows_each, make):
            yield batch.select(names)

    spread = rows.repartitionByRange(parts, "label", "id").sortWithinPartitions("label", "id")
    return store(spread.mapInArrow(run, schema), kind)


class Block:
    """A block's rows with their sorted lists."""

    def __init__(self, row: dict):
        n, dims = row["n"], row["dims"]
        self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        self.rows = np.frombuffer(row["vectors"], np.int64).reshape(n, dims)
        self.lists = np.frombuffer(row["lists"], np.int32).reshape(dims, n)
        self.largest = int(np.abs(self.rows.astype(np.float64)).max(initial=0))
        self.kinds: dict = {}

    def numbers(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, sorted components, and anchor in a type in which all sums are exact: floats, or Python's integers."""
        exact = self.largest * int(np.abs(anchor.astype(np.float64)).max(initial=0)) * max(1, len(anchor)) < 1 << 52
        kind = np.float64 if exact else object
        if kind not in self.kinds:
            rows = self.rows.astype(kind)
            self.kinds[kind] = rows, np.take_along_axis(rows.T, self.lists, 1)
        return *self.kinds[kind], anchor.astype(kind)


def search(block: Block, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[float, float]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and scores of the k best allowed rows of each window, best first, ties by the smaller id."""
    n, dims = block.rows.shape
    anchor = np.pad(anchor[:dims], (0, max(0, dims - len(anchor))))
    rows, values, anchor = block.numbers(anchor)
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    met, scored = np.zeros(n, bool), np.zeros(n, bool)
    scores = np.zeros(n, rows.dtype)
    depth, done = 0, not allowed.any()
    while not done:
        before, depth = depth, min(n, max(FIRST_DEPTH, 2 * depth))
        met[block.lists[up, before:depth]] = True
        met[block.lists[down, n - depth : n - before]] = True
        if depth == n:
            met[:] = True  # an anchor of zeros has no list
        fresh = np.flatnonzero(met & ~scored)
        scores[fresh] = rows[fresh] @ anchor
        scored[fresh] = True
        threshold = values[up, depth - 1] @ anchor[up] + values[down, n - depth] @ anchor[down]
        known = scores[scored & allowed]
        done = bool(scored.all()) or all(
            threshold < low or (inside := known[(known >= low) & (known <= high)]).size >= k and threshold < np.partition(inside, -k)[-k]
            for low, high in windows
        )
    found = []
    for low, high in windows:
        at = np.flatnonzero(scored & allowed & (scores >= low) & (scores <= high))
        at = at[np.lexsort((block.ids[at], -scores[at]))][:k]
        found.append((at, scores[at]))
    return found


def _long(scores: np.ndarray) -> list[int]:
    return [max(_LONG.min, min(_LONG.max, int(s))) for s in scores]


def _search_pairs(batches: Iterable[pa.RecordBatch], low: int, high: int, k: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Every anchor of a group against a block: of its own label, or of the others in the windows its positives open."""
    last, block = None, None
    for batch in batches:
        for pair in (batch.slice(i, 1).to_pylist()[0] for i in range(len(batch))):
            if last != (key := pair["ids"]):
                last, block = key, Block(pair)
            ids, labels = (np.frombuffer(pair[f"g_{c}"], np.int64) for c in ("ids", "labels"))
            anchors = np.frombuffer(pair["g_vectors"], np.int64).reshape(len(ids), pair["g_dims"])
            out: dict[str, list] = {c: [] for c in names}

            def give(**columns: list) -> None:
                for name, values in columns.items():
                    out[name] += values

            if "positive_id" not in names:
                for anchor_id, label, anchor in zip(ids.tolist(), labels.tolist(), anchors, strict=True):
                    allowed = (block.labels == label) & (block.ids != anchor_id)
                    at, scores = search(block, anchor, allowed, [(-np.inf, np.inf)], k)[0]
                    give(anchor_id=[anchor_id] * len(at), id=block.ids[at].tolist(), score=_long(scores))
            else:
                wanted, wanted_scores = (np.frombuffer(pair[f"g_{c}"], np.int64).tolist() for c in ("wanted", "wanted_scores"))
                start = 0
                for anchor_id, label, anchor, n in zip(ids.tolist(), labels.tolist(), anchors, np.frombuffer(pair["g_n_wanted"], np.int64).tolist(), strict=True):
                    asked = [(p, s, -(-low * s // 100), high * s // 100) for p, s in zip(wanted[start : start + n], wanted_scores[start : start + n], strict=True)]
                    asked = [a for a in asked if a[2] <= a[3]]
                    start += n
                    found = search(block, anchor, block.labels != label, [a[2:] for a in asked], k) if asked else []
                    for (positive, score, _, _), (at, scores) in zip(asked, found, strict=True):
                        m = len(at)
                        give(anchor_id=[anchor_id] * m, positive_id=[positive] * m, positive_score=[score] * m, id=block.ids[at].tolist(), score=_long(scores))
            if out["id"]:
                yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in out.items()})


def meet(blocks: DataFrame, groups: DataFrame, same_label: bool, low: int, high: int, k: int) -> DataFrame:
    """The best k rows of each window in each block.

    Both sides are read from storage by every task that needs them: packed rows are small in files and large in memory, so
    a join that Spark plans by their size in files would send them all through the driver.
    """
    found = ["anchor_id", *([] if same_label else ["positive_id", "positive_score"]), "id", "score"]
    dealt = groups.select(*[F.col(c).alias(f"g_{c}") for c in groups.columns]).coalesce(GROUP_LANES).hint("shuffle_replicate_nl")
    overlap = (F.col("low") <= F.col("g_high")) & (F.col("g_low") <= F.col("high"))
    alike = (F.col("low") == F.col("high")) & (F.col("g_low") == F.col("g_high")) & (F.col("low") == F.col("g_low"))
    pairs = blocks.coalesce(BLOCK_LANES).join(dealt, overlap if same_label else ~alike)
    return pairs.mapInArrow(lambda batches: _search_pairs(batches, low, high, k, found), ", ".join(f"{c} long" for c in found))


def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame, anchors: Column, label: Column | None = None, id_col: str = "vec_id", vector: str = "embedding",
    n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose ``id`` meets the condition. An anchor's positives are the best other rows of its label; for
    each, the best rows of other labels whose score lies between ``low`` and ``high`` per cent of the positive's.
    """
    spark = embeddings.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    rows = store(integer_rows(embeddings, id_col, vector, F.col("label") if label is None else label, scale), "vectors")
    blocks = pack(rows, rows.count(), BLOCK_ROWS, "blocks")
    asking = rows.where(anchors)
    n_asking = asking.count()
    groups = pack(asking, n_asking, GROUP_ANCHORS, "groups")
    positives = first(meet(blocks, groups, True, low, high, n_positives), ["anchor_id"], n_positives)
    wanted = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))
    opened = asking.join(wanted.hint("merge"), asking["id"] == wanted["anchor_id"]).select(
        "id", "label", "vector", F.col("found.id").alias("wanted"), F.col("found.score").alias("wanted_scores")
    )
    windows = pack(store(opened, "windows"), n_asking, GROUP_ANCHORS, "groups")
    negatives = first(meet(blocks, windows, False, low, high, n_negatives), ["anchor_id", "positive_id"], n_negatives)
    return negatives.select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


ORACLE = """
WITH valid AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), rows AS (
  SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY id ORDER BY label, vector) = 1
), scored AS (
  SELECT a.id AS anchor_id, a.label = r.label AS same, r.id, CAST(list_inner_product(a.vector, r.vector) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.id <> r.id WHERE a.id % 50 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), negatives AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""
