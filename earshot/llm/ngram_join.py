"""N-gram Jaccard join over a prefix tree of globally ordered sets.

Each document is the set of its hashed four-word shingles. Equal sets are one
class, worked on once. Then:

1. *Survivors.* Of ``n`` shingles in any one order, two linked sets share at
   least ``k`` among their first ``n - ceil(t n) + k`` (t = 0.85). A set whose
   prefix holds fewer than ``k`` shingles that any other set's prefix holds has
   no partner. Most documents end here.
2. *Global order.* For the survivors every shingle's document frequency is
   counted; sets are ordered rarest first. Shingles of one set alone use up the
   prefix; what is left of it holds shared, rare shingles. Sets that share one
   are in a family.
3. *Prefix-tree join.* A family's sets go into a trie. A set walks it with its
   own members marked; sets that share a beginning share its overlap; a subtree
   is left as soon as the shingles still to come can't reach the overlap that its
   lengths ask for. A family of up to ``block_sets`` sets is one unit of work; a
   unit gives a spanning forest of its links, so a group of copies gives links
   in proportion to its rows, never all pairs.
4. *Large families* are dealt into blocks of sets whose sizes can match and joined
   in two rounds. First every block meets one pivot block: near copies of one text
   are in one component after that, at a few copies of each set. Then only sets that
   share a prefix shingle with a set of another component are looked at again, and of
   those only pairs that don't both lie in the largest component of their family.

Hot keys: copies collapse into classes before anything is exploded to pairs,
counts are combined on the map side, joins are between written tables so that
adaptive execution can split a hot side, and a shingle that very many documents
share comes last in the order and hardly ever lies in a prefix.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from earshot.llm.common import broadcast_if_small, connected_components, fresh, materialize, table

WORDS, PERCENT = 4, 85
#: Extra share of the shingles that phase 1 compares.
OVER = 5
BLOCK_SETS = 256
#: Survivor ids (16 bytes each) are broadcast up to so many.
BROADCAST_IDS = 400_000
_KEPT_WORDS = 200_000


def _least(n, percent: int = PERCENT):
    """ceil(percent/100 * n)"""
    return -(-percent * n // 100)


def _release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffles of steps whose results are written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text: words are runs of bytes
    other than ASCII white space, A-Z in lower case."""

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, {}

    def _word(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= _KEPT_WORDS:
                self.known.clear()
            found = self.known[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return found

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.empty(0, np.int64)
        h = np.fromiter(map(self._word, words), np.uint64, len(words))
        span = min(self.words, len(h))
        m = len(h) - span + 1
        mixed = np.full(m, span, np.uint64)
        for i in range(span):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[i : i + m]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return np.unique((mixed ^ (mixed >> np.uint64(29))).view(np.int64))


def _set_ids(shingles: np.ndarray) -> tuple[int, int]:
    a, b = np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64)
    return int(a), int(b)


def _heads(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, body, n, s1, s2 (the set's 128-bit name), least, prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            rows, prefixes = [], []
            for text in batch.column("text"):
                s = shingler(text.as_py())
                n = len(s)
                rows.append((n, *_set_ids(s), 1 + OVER * _least(n, percent) // 100))
                prefixes.append(s[: n - _least(n, percent) + 1 + OVER * n // 100])
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 4
            arrays = [batch.column("doc_id"), batch.column("body"), *columns, pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "body", "n", "s1", "s2", "least", "prefix"])

    return docs.mapInArrow(run, "doc_id long, body long, n long, s1 long, s2 long, least long, prefix array<long>")


def _whole_sets(texts: DataFrame, words: int) -> DataFrame:
    """node, n, shingles of the rows whose set is the one asked for; rows that share id and set repeat it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for batch in batches:
            rows = []
            for text, node, s1, s2 in zip(batch["text"], batch["node"], batch["s1"], batch["s2"], strict=True):
                s = shingler(text)
                if _set_ids(s) == (s1, s2):
                    rows.append((node, len(s), s))
            yield pd.DataFrame(rows, columns=["node", "n", "shingles"])

    return texts.mapInPandas(run, "node long, n long, shingles array<long>")


def survivors(heads: DataFrame) -> DataFrame:
    """(node, rep, s1, s2): sets that may have a partner, numbered; ``rep`` is a document that has the set."""
    probes = heads.where("n > 0").select("s1", "s2", "least", F.explode("prefix").alias("shingle"))
    shared = materialize(probes.groupBy("shingle").count().where("count > 1").select("shingle"), "shared")
    _release(heads.sparkSession)
    counts = probes.join(shared, "shingle").groupBy("s1", "s2", "least").count().where("count >= least").select("s1", "s2")
    classes = heads.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
    found = classes.join(counts, ["s1", "s2"]).where("rep is not null")
    return materialize(found.withColumn("node", F.monotonically_increasing_id()), "survivors")


def ordered_sets(sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, left, seq): the shared shingles of each set, rarest first; ``left``
    of them lie in the prefix. A member of ``seq`` is one number that sorts by the
    frequency's class (eighths of powers of two, 9 bits), then by 54 bits of hash."""
    held = sets.select("node", F.explode("shingles").alias("shingle"))
    counts = materialize(held.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "frequencies")
    _release(sets.sparkSession)
    rank = F.shiftleft(F.least(F.floor(F.log2("df") * 8), F.lit(511)).cast("long"), 54).bitwiseOR(F.col("shingle").bitwiseAND(F.lit(2**54 - 1)))
    shared = held.join(counts, "shingle").select("node", rank.alias("rank")).groupBy("node").agg(F.array_sort(F.collect_set("rank")).alias("seq"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    left = (prefix - (F.col("n") - F.size("seq"))).cast("int")
    sized = shared.join(sets.select("node", "n").distinct(), "node")
    return materialize(sized.withColumn("left", left).where("left > 0").select("node", "n", "left", "seq"), "ordered")


class Trie:
    """Ascending integer sequences in a path-compressed prefix tree, edges in depth-first order.

    Per edge: its label, the edge above, the edge after its subtree, the most
    members still to come below it, the smallest set size in its subtree, and the
    sequences that end at its foot.
    """

    def __init__(self, seqs: list[np.ndarray], sizes: list[int]):
        self.labels, self.above, self.after, self.room, self.smallest, self.ends = [], [], [], [], [], []
        self.seqs, self.sizes = seqs, sizes
        self._grow(sorted(range(len(seqs)), key=lambda i: seqs[i].astype(">u4").tobytes()), 0, -1)

    def _grow(self, group: list[int], depth: int, above: int) -> None:
        """Edges for the sorted sequences ``group``, which share ``depth`` members and end below."""
        seqs, at = self.seqs, 0
        while at < len(group):
            first, to = seqs[group[at]], at + 1
            while to < len(group) and seqs[group[to]][depth] == first[depth]:
                to += 1
            run, last = group[at:to], seqs[group[to - 1]]
            m = min(len(first), len(last))
            differ = np.flatnonzero(first[:m] != last[:m])
            foot = int(differ[0]) if len(differ) else m
            edge = len(self.labels)
            self.labels.append(first[depth:foot])
            self.above.append(above)
            self.room.append(max(len(seqs[i]) for i in run) - foot)
            self.smallest.append(min(self.sizes[i] for i in run))
            self.ends.append([i for i in run if len(seqs[i]) == foot])
            self.after.append(0)
            self._grow([i for i in run if len(seqs[i]) > foot], foot, edge)
            self.after[edge] = len(self.labels)
            at = to

    def linked(self, own: np.ndarray, n: int, mask: np.ndarray, percent: int) -> Iterator[int]:
        """Sequences whose sets (of ``sizes``) are as similar to ``own`` (a set of
        ``n``) as ``percent`` asks; ``mask`` marks the members of ``own``."""
        overlap = [0] * len(self.labels)
        edge = 0
        while edge < len(self.labels):
            label, above = self.labels[edge], self.above[edge]
            overlap[edge] = have = (overlap[above] if above >= 0 else 0) + int(np.count_nonzero(mask[label]))
            to_come = min(self.room[edge], len(own) - int(np.searchsorted(own, label[-1], "right")))
            if (100 + percent) * (have + to_come) < percent * (n + self.smallest[edge]):
                edge = self.after[edge]
                continue
            for i in self.ends[edge]:
                if (100 + percent) * have >= percent * (n + self.sizes[i]):
                    yield i
            edge += 1


def _forest(unit: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links (node, node) of one unit that span its components. Side 0 is the trie;
    side 1, or side 0 itself where the unit has one side, walks it."""
    _, ranks = np.unique(np.concatenate([u[3] for u in unit]), return_inverse=True)
    seqs = np.split(ranks, np.cumsum([len(u[3]) for u in unit])[:-1])
    left = [i for i, u in enumerate(unit) if u[0] == 0]
    right = [i for i, u in enumerate(unit) if u[0] == 1] or left
    trie = Trie([seqs[i] for i in left], [unit[i][2] for i in left])
    root = list(range(len(unit)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    links, mask = [], np.zeros(int(ranks.max()) + 1, bool)
    for i in right:
        mask[seqs[i]] = True
        for j in trie.linked(seqs[i], unit[i][2], mask, percent):
            a, b = find(i), find(left[j])
            if a != b:
                root[a] = b
                links.append((unit[i][1], unit[left[j]][1]))
        mask[seqs[i]] = False
    return links


def _join_units(units: DataFrame, percent: int) -> DataFrame:
    """(a, b) from rows sorted by unit within each partition; one unit is held at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unit, held = None, []
        for batch in batches:
            links = []
            for key, side, node, n, seq in batch.itertuples(index=False, name=None):
                if key != unit:
                    links += _forest(held, percent) if len(held) > 1 else []
                    unit, held = key, []
                held.append((side, node, n, seq))
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")
        if len(held) > 1:
            yield pd.DataFrame(_forest(held, percent), columns=["a", "b"], dtype="int64")

    return units.mapInPandas(run, "a long, b long")


def _postings(ordered: DataFrame) -> DataFrame:
    """(node, shingle): what lies in the prefixes."""
    return ordered.select("node", F.explode(F.slice("seq", 1, F.col("left"))).alias("shingle"))


def _families(postings: DataFrame) -> DataFrame:
    """(node, family): sets that share a prefix shingle with another, directly or by others."""
    hubs = postings.groupBy("shingle").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top").drop("top")
    edges = postings.join(materialize(hubs, "hubs"), "shingle").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    return materialize(connected_components(edges).select("node", F.col("component").alias("family")), "families")


def _dealt(ordered: DataFrame, families: DataFrame, percent: int, block_sets: int) -> DataFrame:
    """``families`` (node, family, rest) with n_f (sets of the family), c (class of size), i (block in
    the class), r (block among the ``rest``, null for others), and of the classes below,
    own and above: nb_* (blocks) and nr_* (blocks of the rest)."""
    # sizes that can match lie in the same or in neighbouring classes
    width = float(np.log(100 / percent) * 1.0001)
    members = materialize(ordered.select("node", F.floor(F.log("n") / width).cast("int").alias("c")).join(families, "node"), "members")
    blocks = members.groupBy("family", "c").agg(F.count(F.lit(1)).alias("n_c"), F.count_if("rest").alias("r_c"))
    sizes = materialize(blocks.groupBy("family").agg(F.sum("n_c").alias("n_f"), F.sum("r_c").alias("r_f")), "family-sizes")
    whole = lambda n: F.ceil(F.col(n) / block_sets).cast("int")
    blocks = materialize(blocks.select("family", "c", whole("n_c").alias("nb"), whole("r_c").alias("nr")), "blocks")
    out = members.join(sizes, "family")
    for step, name in ((0, "own"), (-1, "above"), (1, "below")):
        beside = blocks.select("family", (F.col("c") + step).alias("c"), F.col("nb").alias(f"nb_{name}"), F.col("nr").alias(f"nr_{name}"))
        out = out.join(beside, ["family", "c"], "left").na.fill(0, [f"nb_{name}", f"nr_{name}"])
    block = lambda n: F.pmod(F.xxhash64("node"), F.greatest(F.col(n), F.lit(1))).cast("int")
    return out.withColumn("i", block("nb_own")).withColumn("r", F.when(F.col("rest"), block("nr_own")))


_PLACE = "array<struct<u:string,side:int>>"


def _each(count, one):
    """An array of the places ``one(j)`` for j below ``count``."""
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), one)).otherwise(F.array().cast(_PLACE))


def _unit(c1, i1, c2, i2, side) -> Column:
    side = side if isinstance(side, Column) else F.lit(side)
    return F.struct(F.concat_ws("/", "family", c1, i1, c2, i2).alias("u"), side.cast("int").alias("side"))


def _whole() -> Column:
    return F.array(F.struct(F.col("family").cast("string").alias("u"), F.lit(0).alias("side")))


def _pivot_places(block_sets: int) -> Column:
    """Units of the first round: small families whole; of large ones every block with block 0 of its class and of the classes beside."""
    c, i = F.col("c"), F.col("i")
    first = F.col("i") == 0
    count = lambda name: F.when(first, F.col(name)).otherwise(F.least(F.col(name), F.lit(1)))
    same = _each(count("nb_own"), lambda j: _unit(c, F.least(i, j), c, F.greatest(i, j), F.when(j < i, 1).otherwise(0)))
    up = _each(count("nb_above"), lambda j: _unit(c, i, c + 1, j, 0))
    down = _each(count("nb_below"), lambda j: _unit(c - 1, j, c, i, 1))
    return F.when(F.col("n_f") <= block_sets, _whole()).otherwise(F.concat(same, up, down))


def _rest_places(block_sets: int) -> Column:
    """Units of the second round: small families whole; of large ones each block of the rest (side 1) with all blocks of sizes that can match (side 0)."""
    c, i, r = F.col("c"), F.col("i"), F.col("r")

    def rest_with_any(step: int, name: str) -> Column:
        return _each(F.col(f"nb_{name}"), lambda j: _unit(c, r, c + step, j, 1))

    def any_with_rest(step: int, name: str) -> Column:
        return _each(F.col(f"nr_{name}"), lambda j: _unit(c + step, j, c, i, 0))

    sides = ((0, "own"), (1, "above"), (-1, "below"))
    as_rest, as_any = [rest_with_any(*x) for x in sides], [any_with_rest(*x) for x in sides]
    places = F.concat(F.when(r.isNotNull(), F.concat(*as_rest)).otherwise(F.array().cast(_PLACE)), *as_any)
    return F.when(F.col("n_f") <= block_sets, _whole()).otherwise(places)


def _links(ordered: DataFrame, dealt: DataFrame, places: Column, percent: int) -> DataFrame:
    """(a, b) of all units."""
    rows = materialize(dealt.select("node", F.explode(places).alias("p")).select("node", "p.u", "p.side"), "places")
    units = rows.join(ordered, "node").select(F.col("u").alias("unit"), "side", "node", "n", "seq")
    return materialize(_join_units(units.repartition("unit").sortWithinPartitions("unit", "side", "node"), percent), "links")


def _second_round(ordered: DataFrame, large: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, family, rest) of what the first round left open: the sets of ``large`` families
    that share a prefix shingle with a set of another label. Pairs of one label are linked
    already, so pairs of the family's most frequent label are passed over."""
    own = F.coalesce("label", "node")
    labelled = large.join(labels, "node", "left").select("node", own.alias("label"))
    postings = materialize(_postings(ordered.join(labelled.select("node"), "node", "left_semi")).join(labelled, "node"), "postings")
    mixed = postings.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("shingle")
    families = _families(postings.join(materialize(mixed, "mixed"), "shingle", "left_semi").select("node", "shingle"))
    found = materialize(families.join(labelled, "node"), "open-sets")
    counts = found.groupBy("family", "label").agg(F.count(F.lit(1)).alias("k"))
    most = counts.groupBy("family").agg(F.max(F.struct("k", "label")).alias("m")).select("family", F.col("m.label").alias("most"))
    return found.join(most, "family").select("node", "family", (F.col("label") != F.col("most")).alias("rest"))


def _components(ordered: DataFrame, percent: int, block_sets: int) -> DataFrame:
    """(node, label) of the sets that are linked with another."""
    families = _families(_postings(ordered))
    dealt = materialize(_dealt(ordered, families.withColumn("rest", F.lit(False)), percent, block_sets), "dealt")
    links = _links(ordered, dealt, _pivot_places(block_sets), percent)
    labels = materialize(connected_components(links).select("node", F.col("component").alias("label")), "labels")
    large = dealt.where(F.col("n_f") > block_sets).select("node")
    if large.isEmpty():
        return labels
    # a small family is settled; of large ones block 0 has met all
    left = materialize(_second_round(ordered, large, labels), "open")
    if left.isEmpty():
        return labels
    more = _links(ordered, _dealt(ordered, left, percent, block_sets), _rest_places(block_sets), percent)
    if more.isEmpty():
        return labels
    # only the labels that the new links join are named anew
    alone = more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti")
    known = materialize(labels.unionByName(alone.withColumn("label", F.col("node"))), "labels")
    end = lambda n: known.select(F.col("node").alias(n), F.col("label").alias(f"label_{n}"))
    joined = more.join(end("a"), "a").join(end("b"), "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    over = connected_components(joined).select(F.col("node").alias("label"), F.col("component").alias("top"))
    return known.join(over, "label", "left").select("node", F.coalesce("top", "label").alias("label"))


def _named(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, block_sets: int) -> DataFrame:
    """doc_id, body (hash of the text), n_shingles, component_id, a row per row of ``docs``."""
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"the n-gram join needs whole numbers as ids, {id_col} is {docs.schema[id_col].dataType.simpleString()}")
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("body"), F.col(text_col).alias("text"))
    heads = materialize(_heads(slim, words, percent), "heads")
    found = survivors(heads)
    _release(spark)
    wanted = broadcast_if_small(found, found.count(), BROADCAST_IDS)
    texts = slim.join(wanted, F.col("doc_id") == F.col("rep")).select("text", "node", "s1", "s2")
    ordered = ordered_sets(materialize(_whole_sets(texts, words), "sets"), percent)
    _release(spark)
    linked = _components(ordered, percent, block_sets)
    _release(spark)
    labelled = materialize(found.join(linked, "node").select("s1", "s2", "rep", "label"), "labelled")
    lowest = materialize(labelled.groupBy("label").agg(F.min("rep").alias("component")), "lowest")
    linked_sets = materialize(labelled.join(lowest, "label").select("s1", "s2", "component"), "components")
    # sets without a link: equal sets are one component all the same
    classes = heads.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
    named = classes.join(linked_sets, ["s1", "s2"], "left").select("s1", "s2", F.coalesce("component", "rep").alias("component"))
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return (
        heads.select("doc_id", "body", "n", "s1", "s2")
        .join(materialize(named, "classes"), ["s1", "s2"], "left")
        .select("doc_id", "body", F.col("n").alias("n_shingles"), own.alias("component_id"))
    )


def ngram_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, block_sets: int = BLOCK_SETS
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    A document of fewer than ``words`` words has one shingle, the whole sequence;
    one without words, or null, has none and is linked with nothing. component_id
    is the smallest doc_id reachable by links of ``100 * shared >= percent *
    union``. Ids are whole numbers, others raise a TypeError. A null id is never a
    component, and sets that only rows without an id have are linked with nothing:
    such a row takes the component of an equal set that has an id, else null. Rows
    that repeat an id are each compared. No rows give no rows; other columns are not read.
    """
    return _named(docs, id_col, text_col, words, percent, block_sets).drop("body")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, block_sets: int = BLOCK_SETS) -> DataFrame:
    """``docs`` with the smallest id of each component; rows whose id is null stay.

    Rows are told apart by id and text: where an id is repeated with different
    texts, each goes or stays by its own. Rows that repeat the staying id in one
    component all stay. All columns, of any name, as they were.
    """
    name = fresh(docs.columns)
    id_, body = name("id"), name("body")
    gone = _named(docs, id_col, text_col, words, percent, block_sets).where("component_id <> doc_id").select(F.col("doc_id").alias(id_), F.col("body").alias(body)).distinct()
    gone = materialize(gone, "near-copies")
    return docs.join(gone, (F.col(id_col) == F.col(id_)) & (F.xxhash64(F.col(text_col)) == F.col(body)), "left_anti")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents", "doc_id", "text"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
           lambda x: x <> '') AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 3, 1) + 1), lambda i: array_to_string(ws[i : i + 3], ' '))) AS s
  FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, c.low) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS low FROM r GROUP BY a) c ON c.a = d.doc_id
"""
