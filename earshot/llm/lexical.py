"""Ranked lexical search over K2-treaps of the term-document grid.

Documents are dealt into segments where they are read; nothing is shuffled. A
segment is the grid of its terms (rows) and documents (columns), cut by quarters
into a quadtree of which only non-empty cells are kept: it stores the leaf cells'
codes in quadtree order with their term frequencies. When a segment is searched,
its cells get their impacts (which hang on the average length of all documents)
and every quadtree cell the greatest impact below it: a K2-treap. A cell has a
bitmap of its four quarters; the sum of the bitmaps' ones before it leads to its
children.

An item has a path through the quadtree for each of its terms. The paths descend
together over ranges of documents, best first: a range's bound is the sum over the
item's terms of weight x count x the greatest impact in the cell that holds the
term's row over the range. The ranges with the best bounds are halved, one
document's bound is its score, and a range is left out once its bound is below the
item's k-th best score. That score carries over from segment to segment of a task,
so later segments are hardly opened. Nothing is left out that could be in the
result: the search is exact.

Every task returns k rows an item; two rounds of ranking (by a part of the
documents, then by item) leave k. Items come to the tasks in blocks of a bounded
number of terms.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earshot.llm.common import LARGE_ROWS, broadcast_if_small, materialize, rows_per_batch, table

TOP = 20
#: A segment is closed when it has so many documents or so many cells.
SEGMENT_DOCS, SEGMENT_CELLS = 4_096, 500_000
#: Items are searched in blocks of at most so many distinct terms in all (and one item at least).
BLOCK_TERMS = 200_000
#: Tables of the items' terms are broadcast up to so many rows (about 60 bytes each).
BROADCAST_TERMS = 500_000
#: Ranges that are halved in one step.
BEAM = 512
#: Ids are ordered with null first; this one stands for null inside tasks.
NO_ID = -(2**63)

_KEEP = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Bytes outside terms become spaces, A-Z becomes a-z. Every byte of a character beyond ASCII belongs to a term.
_CLEAN = bytes(ord(chr(b).lower()) if b < 0x80 and b in _KEEP else b if b in _KEEP else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return text.translate(_CLEAN).split()


def _spread(values: np.ndarray) -> np.ndarray:
    """A zero bit before every bit."""
    out = values.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        out = (out | (out << np.uint64(shift))) & np.uint64(mask)
    return out


def _gather(codes: np.ndarray) -> np.ndarray:
    """The bits at even places, the reverse of ``_spread``."""
    out = codes & np.uint64(0x5555555555555555)
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        out = (out | (out >> np.uint64(shift))) & np.uint64(mask)
    return out.astype(np.int64)


def cell_codes(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Quadtree codes: bit pairs of (row, column), the highest first."""
    return (_spread(rows) << np.uint64(1)) | _spread(columns)


class Segmenter:
    """Collects documents into segments."""

    def __init__(self, docs: int, cells: int):
        self.most_docs, self.most_cells = docs, cells
        self.clear()

    def clear(self) -> None:
        self.rows: dict = defaultdict(count().__next__)  # no method of its own: a dict in a cycle would stay until Python looks for cycles
        self.ids, self.lengths, self.parts, self.cells = [], [], [], 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        found = terms(text)
        row, tf = np.unique(np.fromiter(map(self.rows.__getitem__, found), np.int32, len(found)), return_counts=True)
        self.parts.append((row, tf.astype(np.int32)))
        self.ids.append(doc_id)
        self.lengths.append(len(found))
        self.cells += len(row)

    def full(self) -> bool:
        return len(self.ids) >= self.most_docs or self.cells >= self.most_cells

    def close(self) -> dict:
        """The segment: documents by length (so neighbours have like impacts), terms by row, cells in quadtree order."""
        order = np.argsort(np.array(self.lengths, np.int64), kind="stable")
        parts = [self.parts[i] for i in order]
        rows = np.concatenate([p[0] for p in parts])
        columns = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p[0]) for p in parts])
        tf = np.concatenate([p[1] for p in parts])
        codes = cell_codes(rows, columns)
        by_code = np.argsort(codes)
        codes = codes[by_code]
        steps = np.diff(codes, prepend=np.uint64(0))
        out = {
            "ids": [self.ids[i] for i in order],
            "lengths": [self.lengths[i] for i in order],
            "terms": [t.decode("utf-8", "surrogatepass") for t in self.rows],
            "df": np.bincount(rows, minlength=len(self.rows)).tolist(),
            # steps between codes are small where cells stand close; byte planes leave columns of zeros to the file's codec
            "steps": np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(),
            "tf": tf[by_code].tobytes(),
            "n_docs": sum(n > 0 for n in self.lengths),
            "n_terms": sum(self.lengths),
        }
        self.clear()
        return out


SEGMENT = pa.schema(
    [
        ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())), ("df", pa.list_(pa.int64())),
        ("steps", pa.binary()), ("tf", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64()),
    ]
)
SEGMENT_SQL = "ids array<bigint>, lengths array<bigint>, terms array<string>, df array<bigint>, steps binary, tf binary, n_docs bigint, n_terms bigint"


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_docs: int = SEGMENT_DOCS, segment_cells: int = SEGMENT_CELLS) -> DataFrame:
    """The segments of all documents, written to the shared folder. Documents without a term are in none.

    Ids are integers or null (-2^63 stands for null and can't be an id itself); rows
    that repeat an id are documents of their own. Null and empty texts have no terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = Segmenter(segment_docs, segment_cells)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                segment.add(doc_id, text.as_py())
                if segment.full():
                    yield pa.RecordBatch.from_pylist([segment.close()], SEGMENT)
        if segment.ids:
            yield pa.RecordBatch.from_pylist([segment.close()], SEGMENT)

    has_term = F.col(text_col).rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]")
    slim = docs.where(has_term).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    with rows_per_batch(docs.sparkSession, 1_000):
        return materialize(slim.mapInArrow(run, SEGMENT_SQL), "segments", **LARGE_ROWS)


#: How many ones a bitmap has.
_ONES = np.array([bin(b).count("1") for b in range(16)], np.uint8)


class Treap:
    """The K2-treap of a segment: cells of all levels in one numbering, 0 being the empty cell."""

    def __init__(self, codes: np.ndarray, impacts: np.ndarray, height: int):
        codes, values = codes.copy(), impacts
        levels = []
        bits = None
        for _ in range(height + 1):
            levels.append((values, bits, len(values)))
            upper = codes >> np.uint64(2)
            first = np.flatnonzero(np.concatenate([[True], upper[1:] != upper[:-1]]))
            bits = np.bitwise_or.reduceat(np.left_shift(np.uint8(1), (codes & np.uint64(3)).astype(np.uint8)), first)
            values, codes = np.maximum.reduceat(values, first), upper[first]
        levels.reverse()  # from the root down; a level's cells stand before those of the next
        self.height = height
        self.best = np.concatenate([np.zeros(1, values.dtype), *[v for v, _, _ in levels]])
        inner = [np.zeros(n, np.uint8) if b is None else b for _, b, n in levels]
        self.bits = np.concatenate([np.zeros(1, np.uint8), *inner])
        ones = _ONES[self.bits]
        self.first = (np.cumsum(ones) - ones + 2).astype(np.int32)  # the root is cell 1 and its first child cell 2

    def child(self, cells: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        bits = self.bits[cells]
        there = (bits >> quarter) & 1
        return np.where(there, self.first[cells] + _ONES[bits & ((1 << quarter) - 1)], 0)

    def top(self, rows: np.ndarray, weights: np.ndarray, least: int, k: int, offer) -> None:
        """Calls ``offer(columns, scores)`` for every column that may be among the k best; it returns the new least score."""
        cells = np.ones((len(rows), 1), np.int64)
        starts, heights = np.zeros(1, np.int64), np.full(1, self.height)
        bounds = weights @ self.best[cells]
        while len(starts):
            alive = bounds >= least
            if not alive.all():
                starts, heights, bounds, cells = starts[alive], heights[alive], bounds[alive], cells[:, alive]
                if not len(starts):
                    return
            if len(starts) > BEAM:
                turn = np.argpartition(bounds, len(bounds) - BEAM)
                rest, turn = turn[:-BEAM], turn[-BEAM:]
            else:
                rest, turn = np.zeros(0, np.int64), np.arange(len(starts))
            done = turn[heights[turn] == 0]
            if len(done):
                least = offer(starts[done], bounds[done])
            turn = turn[heights[turn] > 0]
            if len(turn):
                h = heights[turn] - 1
                upper = ((rows[:, None] >> h) & 1) << 1
                left = self.child(cells[:, turn], upper)
                right = self.child(cells[:, turn], upper | 1)
                new_cells = np.concatenate([left, right], axis=1)
                new_bounds = weights @ self.best[new_cells]
                keep = (new_bounds >= max(least, 1)).nonzero()[0]
                new_starts = np.concatenate([starts[turn], starts[turn] + (1 << h)])[keep]
                new_heights = np.concatenate([h, h])[keep]
                new_cells, new_bounds = new_cells[:, keep], new_bounds[keep]
            else:
                new_starts, new_heights, new_bounds, new_cells = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((len(rows), 0), np.int64)
            starts, heights = np.concatenate([starts[rest], new_starts]), np.concatenate([heights[rest], new_heights])
            bounds, cells = np.concatenate([bounds[rest], new_bounds]), np.concatenate([cells[:, rest], new_cells], axis=1)


def impacts(tf: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The part of a score that hangs on a cell alone, at most a million."""
    m = 75 + (25 * lengths * n_docs) // n_terms
    return ((1_000_000_000 * tf) // (1000 * tf + 12 * m)).astype(np.int32)


def open_segment(row: dict, n_docs: int, n_terms: int) -> tuple[Treap, np.ndarray, dict[str, int]]:
    """(treap, ids of its columns, rows of its terms)."""
    steps = np.ascontiguousarray(np.frombuffer(row["steps"], np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    codes, tf = np.cumsum(steps), np.frombuffer(row["tf"], np.int32).astype(np.int64)
    columns = _gather(codes)
    lengths = np.array(row["lengths"], np.int64)
    side = max(len(row["ids"]), len(row["terms"]))
    height = max(1, (side - 1).bit_length())
    ids = np.array([NO_ID if i is None else i for i in row["ids"]], np.int64)
    return Treap(codes, impacts(tf, lengths[columns], n_docs, n_terms), height), ids, {t: i for i, t in enumerate(row["terms"])}


@dataclass
class Best:
    """The k best documents of an item so far, and the score that a further one must reach."""

    k: int
    scores: np.ndarray
    ids: np.ndarray

    @property
    def least(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> int:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        return self.least


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term, times)."""
    lower = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(lower, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), 0)
    return items.select(F.col(id_col).alias("item_id"), F.explode(found).alias("term")).groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def _search_block(segments: DataFrame, queries: list[tuple[int, list[str], list[int]]], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(query, doc_id, score): the k best of every query among each task's segments. Queries have terms and weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {number: Best(k, np.zeros(0, np.int64), np.zeros(0, np.int64)) for number, _, _ in queries}
        for batch in batches:
            for at in range(batch.num_rows):
                treap, ids, rows = open_segment(batch.slice(at, 1).to_pylist()[0], n_docs, n_terms)
                for number, words, weights in queries:
                    held = [(rows[t], w) for t, w in zip(words, weights, strict=True) if t in rows and w]
                    if held:
                        own = best[number]
                        row, weight = (np.array(x, np.int64) for x in zip(*held, strict=True))
                        treap.top(row, weight, own.least, k, lambda columns, scores, own=own, ids=ids: own.offer(ids[columns], scores))
                del treap, ids, rows  # before the next one is opened
        numbers = np.concatenate([np.full(len(b.ids), n, np.int64) for n, b in best.items()])
        found = np.concatenate([b.ids for b in best.values()])
        ids = pa.array(found, pa.int64(), mask=found == NO_ID)
        scores = pa.array(np.concatenate([b.scores for b in best.values()]), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(numbers), ids, scores], ["query", "doc_id", "score"])

    return segments.select("ids", "lengths", "terms", "steps", "tf").mapInArrow(run, "query bigint, doc_id bigint, score bigint")


def search(segments: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, ties by ascending id, null first.

    Scores are above 0. Item rows that share an id are one item with the terms of all,
    a null id included. Items without terms, and items of which no document holds a
    term, have no rows; nor has anything where no document has a term. Documents that
    repeat an id are ranked each, so the id may come twice."""
    spark = segments.sparkSession
    wanted = materialize(item_terms(items, id_col, text_col), "item-terms")
    kind = wanted.schema["item_id"].dataType.simpleString()
    n_docs, n_terms = segments.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    numbers = materialize(
        wanted.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).withColumn("query", F.monotonically_increasing_id()).select("query", "item_id", "n"), "queries"
    )
    if not n_docs:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    held = wanted.select("term").distinct()
    held = broadcast_if_small(held, held.count(), BROADCAST_TERMS)
    listed = segments.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.df").alias("df"))
    with rows_per_batch(spark, 1, 1):  # a segment is some MB
        df = materialize(listed.join(held, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df")), "df")
    weighted = wanted.join(df, "term").join(numbers.withColumnRenamed("item_id", "item"), F.col("item_id").eqNullSafe(F.col("item")))
    weighted = materialize(weighted.select("query", "n", "term", "times", "df"), "weighted-terms")
    parts = []
    for block in _blocks(numbers, block_terms):
        queries: dict[int, tuple[list, list]] = {}
        # a block has at most block_terms terms, or one item
        for row in weighted.where(F.col("query").isin(block)).select("query", "term", "times", "df").toLocalIterator():
            words, weights = queries.setdefault(row["query"], ([], []))
            words.append(row["term"])
            weights.append(row["times"] * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row["df"] + 1))))
        if queries:
            with rows_per_batch(spark, 1, 1):
                parts.append(materialize(_search_block(segments, [(q, *v) for q, v in sorted(queries.items())], n_docs, n_terms, k), "found"))
    if not parts:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64))).withColumn("rank", place("query", "part")).where(F.col("rank") <= k)
    ranked = found.drop("rank", "part").withColumn("rank", place("query")).where(F.col("rank") <= k)
    return ranked.join(numbers, "query").select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def _blocks(numbers: DataFrame, block_terms: int) -> Iterator[list[int]]:
    """Numbers of queries, in blocks of at most ``block_terms`` terms or one query."""
    block, load = [], 0
    for row in numbers.select("query", "n").toLocalIterator():
        if block and load + row["n"] > block_terms:
            yield block
            block, load = [], 0
        block.append(row["query"])
        load += row["n"]
    if block:
        yield block


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """Builds the index of ``docs`` (doc_id, text) and searches it for ``items`` (item_id, text)."""
    return search(build_index(docs), items, k=k)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents WHERE text IS NOT NULL),
d AS (SELECT row, doc_id, ws, len(ws) AS n FROM t WHERE len(ws) > 0),
g AS (SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM d),
q AS (SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), g),
s AS (SELECT item_id, d.row, d.doc_id, sum(times * w.w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * all_docs) // all_terms))))::BIGINT AS score
      FROM p JOIN d USING (row) JOIN w USING (term) JOIN q USING (term), g GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 20
"""
