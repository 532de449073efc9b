"""Merkle manifest of a dataset, its trees stored in the van Emde Boas layout.

A row's leaf is the SHA-256 of its fields, each written with its length. The
leaves of a group stand in order; every two consecutive nodes become the hash of
their hex digests (a last one alone becomes its own hash) until one is left, the
group's subroot. The subroots in order of the groups form one more such tree.

A tree is cut into aligned subtrees of ``block_height`` levels. Each is one row,
whose nodes lie in one string in the van Emde Boas order: a subtree of L node
levels is the subtree of its upper L // 2 levels, followed by the subtrees below
it from left to right, each laid out the same way. ``addresses`` computes where a
node stands from its depth and place alone, so building a subtree and reading
siblings touch few distant bytes at any size of cache line, without pointers. The
roots of a tier's blocks are the leaves of the tier above, until a group has one
block; a tree of n leaves has log(n) / block_height tiers.

Places come from ``ranks.row_number`` (range partitions and offsets), so no task
holds a group; a block has at most 2 ** block_height leaves. Texts are hashed
where they are read; only digests are shuffled.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import materialize, table
from earshot.operators import ranks

BLOCK_HEIGHT = 12
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SIZE = 32


def encoded(value: Column) -> Column:
    """A field of a leaf: its UTF-8 bytes, counted, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    """The hex digest of a row."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def addresses(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes ``index`` at ``depth`` of a complete binary tree of ``levels`` node levels stand."""
    if levels <= 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return addresses(top, depth, index)
    below = levels - top
    tree = index >> (depth - top)
    within = index & ((1 << (depth - top)) - 1)
    return (1 << top) - 1 + tree * ((1 << below) - 1) + addresses(below, depth - top, within)


@functools.lru_cache(maxsize=64)
def layout(height: int) -> tuple[np.ndarray, ...]:
    """The addresses of all nodes by depth, for a tree of ``height`` levels above its leaves."""
    return tuple(addresses(height + 1, d, np.arange(1 << d)) for d in range(height + 1))


def parent(left: bytes, right: bytes | None) -> bytes:
    """The hash of one or two nodes' hex digests."""
    return hashlib.sha256((left.hex() + (right.hex() if right is not None else "")).encode()).digest()


def widths(leaves: int, height: int) -> list[int]:
    """How many nodes a subtree with so many leaves has at each depth."""
    return [-(-leaves // (1 << (height - d))) for d in range(height + 1)]


def build_block(digests: list[bytes], height: int) -> tuple[bytes, bytes]:
    """(nodes in the van Emde Boas order, root) of a subtree; places without a node are zero."""
    where = layout(height)
    nodes = np.zeros(((2 << height) - 1, SIZE), np.uint8)
    level = digests
    for depth in range(height, -1, -1):
        nodes[where[depth][: len(level)]] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, SIZE)
        if depth:
            level = [parent(level[i], level[i + 1] if i + 1 < len(level) else None) for i in range(0, len(level), 2)]
    return nodes.tobytes(), level[0]


def siblings(nodes: bytes, leaves: int, height: int) -> list[bytes]:
    """The path of each leaf to the subtree's root, a step a level: one byte (0: no sibling,
    1: it stands left, 2: it stands right) and the sibling's digest if there is one."""
    where, count = layout(height), widths(leaves, height)
    paths = [[] for _ in range(leaves)]
    for depth in range(height, 0, -1):
        place = np.arange(leaves) >> (height - depth)
        beside = place ^ 1
        at = where[depth][np.minimum(beside, count[depth] - 1)] * SIZE
        for path, i, j, a in zip(paths, place.tolist(), beside.tolist(), at.tolist(), strict=True):
            path.append(b"\0" if j >= count[depth] else (b"\1" if j < i else b"\2") + nodes[a : a + SIZE])
    return [b"".join(p) for p in paths]


def steps(path: bytes) -> Iterator[tuple[int, bytes]]:
    """(side, sibling) of each step of a path that has a sibling, and (0, b"") of the others."""
    at = 0
    while at < len(path):
        side = path[at]
        yield side, path[at + 1 : at + 1 + SIZE] if side else b""
        at += 1 + (SIZE if side else 0)


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for side, other in steps(path):
        leaf = parent(leaf, None) if not side else parent(other, leaf) if side == 1 else parent(leaf, other)
    return leaf


def proof_digest(path: bytes) -> str:
    """SHA-256 of the hex digests of all siblings on a path."""
    return hashlib.sha256("".join(other.hex() for side, other in steps(path) if side).encode()).hexdigest()


@dataclass
class Manifest:
    """``tiers[t]``: grp, block, total, leaves, height, nodes, root (and members in tier 0: the rows'
    columns besides the digest); ``top``: the same tiers over the subroots, with one group.
    ``roots``: grp, subroot."""

    tiers: list[DataFrame]
    top: list[DataFrame]
    roots: DataFrame

    def root(self) -> DataFrame:
        """One row: the root of the whole dataset; none for a dataset without rows."""
        return self.top[-1].select(F.hex("root").alias("root"))


def _tiers(leaves: DataFrame, block_height: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Tiers of all groups of ``leaves`` (grp, place from 0, total, digest, member), and (grp, root)."""
    tiers, roots, span = [], None, 1 << block_height

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                digests = one.column("digests")[0].as_py()
                height = one.column("height")[0].as_py()
                nodes, root = build_block(digests, height)
                rest = [one.column(c) for c in ("grp", "block", "total", "leaves", "height", "members")]
                built = [*rest, pa.array([nodes], pa.binary()), pa.array([root], pa.binary())]
                yield pa.RecordBatch.from_arrays(built, ["grp", "block", "total", "leaves", "height", "members", "nodes", "root"])

    while True:
        block = F.floor(F.col("place") / span).cast("long")
        packed = leaves.groupBy("grp", block.alias("block"), "total").agg(F.sort_array(F.collect_list(F.struct("place", "digest", "member"))).alias("held"))
        whole = F.when(F.col("total") > 1, F.length(F.bin(F.col("total") - 1))).otherwise(0)
        packed = packed.select(
            "grp", "block", "total", F.size("held").alias("leaves"), F.when(F.col("total") > span, block_height).otherwise(whole).cast("int").alias("height"),
            F.col("held.digest").alias("digests"), F.col("held.member").alias("members"),
        )
        schema = packed.select("grp", "block", "total", "leaves", "height", "members", F.lit(b"").alias("nodes"), F.lit(b"").alias("root")).schema
        built = materialize(packed.mapInArrow(run, schema), f"{name}-{len(tiers)}")
        tiers.append(built)
        single = built.where(F.col("total") <= span).select("grp", "root")
        roots = single if roots is None else roots.unionByName(single)
        rest = built.where(F.col("total") > span)
        if rest.isEmpty():
            return tiers, roots
        above = F.ceil(F.col("total") / span).cast("long")
        leaves = rest.select("grp", F.col("block").alias("place"), above.alias("total"), F.col("root").alias("digest"), F.lit(None).cast("string").alias("member"))


def build(rows: DataFrame, group_col: str, order_cols: list[str], digest_col: str, member_cols: list[str], block_height: int = BLOCK_HEIGHT) -> Manifest:
    """The manifest of ``rows``, whose digests are hex. Groups are ordered by their bytes, null first;
    the rows of a group by ``order_cols``, null first. Rows that are equal in all of them keep no
    order among themselves, so ``order_cols`` should end with the digest. No rows, no trees."""
    member = F.struct(*[F.col(c) for c in member_cols])
    slim = rows.select(F.col(group_col).alias("grp"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)], F.unhex(digest_col).alias("digest"), member.alias("member"))
    slim = slim.withColumn("row", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("grp"), *[F.asc_nulls_first(f"o{i}") for i in range(len(order_cols))], F.col("row")]
    placed = ranks.row_number(materialize(slim, "merkle-leaves"), order, "global")
    placed = materialize(placed.select("grp", "global", "digest", "member"), "merkle-places")
    groups = placed.groupBy("grp").agg(F.min("global").alias("first"), F.count(F.lit(1)).alias("total"))
    groups = materialize(groups, "merkle-groups").withColumnRenamed("grp", "g")
    leaves = placed.join(groups, F.col("grp").eqNullSafe(F.col("g"))).select("grp", (F.col("global") - F.col("first")).alias("place"), "total", "digest", "member")
    tiers, roots = _tiers(leaves, block_height, "merkle-tier")
    roots = materialize(roots, "merkle-subroots")
    numbered = materialize(ranks.row_number(roots, [F.asc_nulls_first("grp")], "global"), "merkle-order")
    total = numbered.count()
    top = numbered.select(F.lit("").alias("grp"), (F.col("global") - 1).alias("place"), F.lit(total).cast("long").alias("total"), F.col("root").alias("digest"), F.col("grp").alias("member"))
    return Manifest(tiers, _tiers(top, block_height, "merkle-top")[0], roots.withColumnRenamed("root", "subroot"))


def _below(blocks: DataFrame) -> DataFrame:
    """(grp, block, member, path, subroot, root): a row for each leaf of ``blocks``, which have the path above."""
    kind = blocks.schema["members"].dataType.elementType.simpleString()
    group = blocks.schema["grp"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                paths = siblings(row["nodes"], row["leaves"], row["height"])
                n = len(paths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["grp"]] * n, batch.schema.field("grp").type),
                        pa.array(range(row["block"] << row["span"], (row["block"] << row["span"]) + n), pa.int64()),
                        pa.array(row["members"], batch.schema.field("members").type.value_type),
                        pa.array([p + row["path"] for p in paths], pa.binary()),
                        pa.array([row["subroot"]] * n, pa.binary()),
                        pa.array([row["top_root"]] * n, pa.binary()),
                    ],
                    ["grp", "block", "member", "path", "subroot", "top_root"],
                )

    return blocks.mapInArrow(run, f"grp {group}, block bigint, member {kind}, path binary, subroot binary, top_root binary")


def _down(tiers: list[DataFrame], starts: DataFrame, block_height: int, name: str) -> DataFrame:
    """The blocks of tier 0 with path, subroot and top_root; ``starts`` has them for the one block of each group's last tier."""
    starts = starts.select(F.col("grp").alias("g"), F.lit(0).cast("long").alias("b"), "path", "subroot", "top_root")
    held = None
    for t in range(len(tiers) - 1, -1, -1):
        own = tiers[t].where(F.col("total") <= (1 << block_height)).join(starts, F.col("grp").eqNullSafe(F.col("g")) & (F.col("block") == F.col("b")))
        if held is not None:
            low = held.select(F.col("grp").alias("g"), F.col("block").alias("b"), "path", "subroot", "top_root")
            own = own.unionByName(tiers[t].where(F.col("total") > (1 << block_height)).join(low, F.col("grp").eqNullSafe(F.col("g")) & (F.col("block") == F.col("b"))))
        own = own.drop("g", "b").withColumn("span", F.lit(block_height))
        if t:
            held = materialize(_below(own), f"{name}-{t}")
    return own


def proofs(manifest: Manifest, block_height: int = BLOCK_HEIGHT) -> DataFrame:
    """The blocks of tier 0, each with the path above its root, its subroot and the root."""
    tops = manifest.top[-1].select("grp", F.lit(b"").alias("path"), F.lit(b"").alias("subroot"), F.col("root").alias("top_root"))
    by_group = materialize(_below(_down(manifest.top, tops, block_height, "merkle-top-paths")), "merkle-group-paths")
    by_group = by_group.select(F.col("member").alias("k"), "path", "top_root")
    starts = manifest.roots.join(by_group, F.col("grp").eqNullSafe(F.col("k"))).select("grp", "path", "subroot", "top_root")
    return _down(manifest.tiers, starts, block_height, "merkle-paths")


def verify(manifest: Manifest, block_height: int = BLOCK_HEIGHT) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The members of the manifest are (doc_id, changed): where ``changed`` isn't
    null it is the digest of the row as it is now, and is folded instead of the leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes, height = row["nodes"], row["height"]
                at = (layout(height)[height] * SIZE).tolist()
                root, subroot, out = row["top_root"].hex(), row["subroot"].hex(), []
                for member, path, a in zip(row["members"], siblings(nodes, row["leaves"], height), at, strict=False):
                    path += row["path"]
                    leaf = nodes[a : a + SIZE]
                    folded = fold(leaf if member["changed"] is None else member["changed"], path).hex()
                    out.append((member["doc_id"], leaf.hex(), subroot, root, proof_digest(path), folded, folded == root))
                kinds = [batch.schema.field("members").type.value_type.field("doc_id").type, *[pa.string()] * 5, pa.bool_()]
                names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)], names)

    blocks = proofs(manifest, block_height)
    kind = blocks.schema["members"].dataType.elementType["doc_id"].dataType.simpleString()
    return blocks.mapInArrow(run, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def manifest_check(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: list[str] | None = None,
    alter: dict[str, Column] | None = None,
    altered: Column | None = None,
    block_height: int = BLOCK_HEIGHT,
) -> DataFrame:
    """Builds the manifest of ``docs`` and checks every row against it as ``verify`` tells.

    ``alter`` gives fields new values in rows where ``altered`` holds; nulls in
    ``altered`` count as false. Rows are ordered by id within the group; null ids come first, and
    rows that share an id are ordered by their leaf. Rows that are alike in all fields
    have one leaf digest but each a place and a proof of its own. A null group is a
    group of its own. No rows in, no rows out; other columns are not read.
    """
    names = fields or FIELDS
    leaf = leaf_digest([F.col(c) for c in names])
    now = F.lit(None).cast("string")
    if alter:
        now = F.when(altered, leaf_digest([alter.get(c, F.col(c)) for c in names]))
    rows = docs.select(F.col(group_col).alias("grp"), F.col(id_col).alias("doc_id"), leaf.alias("leaf"), F.unhex(now).alias("changed"))
    return verify(build(rows, "grp", ["doc_id", "leaf"], "leaf", ["doc_id", "changed"], block_height), block_height)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *FIELDS)
    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest_check(docs, alter={"n_chars": F.col("n_chars") + 1}, altered=drawn)


ORACLE = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, i:
         CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
f AS (
  SELECT doc_id, lang, n_chars, doc_id::VARCHAR AS name,
         coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS a,
         coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS b,
         coalesce(octet_length(encode((n_chars + 1)::VARCHAR)) || ':' || (n_chars + 1), '-') AS b2,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS c
  FROM documents),
d AS (
  SELECT doc_id, lang, sha256(a || b || c) AS leaf,
         CASE WHEN xor(list_reduce(list_concat([4294967295], list_transform(range(length(name)), lambda i: ascii(name[(i + 1)::BIGINT])::BIGINT)),
                   lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 7 = 0
              THEN sha256(a || b2 || c) ELSE sha256(a || b || c) END AS now
  FROM f, crc),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
             dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp FROM d),
tree AS (
  SELECT grp, 0 AS lvl, place, leaf AS h, count(*) OVER (PARTITION BY grp) AS n FROM r
  UNION ALL
  SELECT grp, lvl + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (any_value(n) + 1) // 2 FROM tree WHERE n > 1 GROUP BY grp, lvl, place // 2),
sub AS (SELECT grp, h AS subroot FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lvl, grp AS place, subroot AS h, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT lvl + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (any_value(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY lvl, place // 2),
low AS (
  SELECT r.grp, r.place, t.lvl, s.h AS sib, s.place < t.place AS is_left, true AS go FROM r
  JOIN tree t ON t.grp = r.grp AND t.n > 1 AND t.place = r.place >> t.lvl LEFT JOIN tree s ON s.grp = t.grp AND s.lvl = t.lvl AND s.place = xor(t.place, 1)),
high AS (
  SELECT r.grp, r.place, 1000 + t.lvl AS lvl, s.h AS sib, s.place < t.place AS is_left FROM r
  JOIN top t ON t.n > 1 AND t.place = r.grp >> t.lvl LEFT JOIN top s ON s.lvl = t.lvl AND s.place = xor(t.place, 1)),
path AS (SELECT *, row_number() OVER (PARTITION BY grp, place ORDER BY lvl) AS step FROM (SELECT grp, place, lvl, sib, is_left FROM low UNION ALL SELECT * FROM high)),
folded AS (
  SELECT grp, place, 0 AS step, now AS h FROM r
  UNION ALL
  SELECT p.grp, p.place, p.step, sha256(CASE WHEN p.sib IS NULL THEN f.h WHEN p.is_left THEN p.sib || f.h ELSE f.h || p.sib END)
  FROM folded f JOIN path p ON p.grp = f.grp AND p.place = f.place AND p.step = f.step + 1),
ends AS (SELECT grp, place, arg_max(h, step) AS folded_root FROM folded GROUP BY grp, place),
proof AS (SELECT grp, place, sha256(coalesce(string_agg(sib, '' ORDER BY step), '')) AS proof_sha256 FROM path GROUP BY grp, place)
SELECT doc_id, leaf, subroot, top.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = top.h AS verified
FROM r JOIN sub ON sub.grp = r.grp JOIN ends ON ends.grp = r.grp AND ends.place = r.place
LEFT JOIN proof ON proof.grp = r.grp AND proof.place = r.place, top WHERE top.n = 1
"""
