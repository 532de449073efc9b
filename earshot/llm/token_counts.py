"""Edit-aware token counts over segment trees of pre-tokens.

A byte-level BPE never merges across pre-tokens, so a document's token count is
the sum over its pre-tokens. Each document keeps a segment tree: leaves are runs
of up to ``LEAF`` pre-tokens (text length, token count), inner nodes are sums.
An edit (offset, characters removed, characters put in) cuts the text again only
from a pre-token boundary before it until the new cut meets an old boundary
behind it; the touched leaves are replaced and the sums on their paths updated.

``build_trees`` and ``apply_edits`` keep trees in a table between runs: a row is a
text with the lengths of its pre-tokens and the token count of each leaf, so a
later run of edits neither cuts nor encodes what the edits don't touch.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import map_rows, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LEAF = 32
KEPT_PRETOKENS = 500_000
LONGEST_KEPT = 128


class Counter(dict):
    """pre-token -> its number of tokens; each distinct one is encoded once, up to a bound."""

    def __init__(self, encoding, limit: int = KEPT_PRETOKENS):
        super().__init__()
        self.encoding, self.limit = encoding, limit

    def __missing__(self, piece: str) -> int:
        n = len(self.encoding.encode_ordinary(piece))
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = n
        return n


class SegmentTree:
    """Sums (characters, tokens) over leaves; leaves can be replaced by a different number."""

    def __init__(self, pieces: list[str], counter: Counter):
        self.counter = counter
        self.leaves = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)]
        self._build([self._sum(leaf) for leaf in self.leaves])

    @classmethod
    def stored(cls, leaves: list[list[str]], tokens: list[int], counter: Counter) -> SegmentTree:
        """A tree from its leaves and their token counts; nothing is encoded."""
        tree = cls([], counter)
        tree.leaves = leaves
        tree._build([(sum(map(len, leaf)), n) for leaf, n in zip(leaves, tokens, strict=True)])
        return tree

    def _sum(self, pieces: list[str]) -> tuple[int, int]:
        return sum(map(len, pieces)), sum([self.counter[p] for p in pieces])

    def _build(self, sums: list[tuple[int, int]]) -> None:
        self.levels = [sums]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            self.levels.append([self._pair(low, i) for i in range(0, len(low), 2)])

    @staticmethod
    def _pair(low: list[tuple[int, int]], i: int) -> tuple[int, int]:
        return (low[i][0] + low[i + 1][0], low[i][1] + low[i + 1][1]) if i + 1 < len(low) else low[i]

    @property
    def total(self) -> tuple[int, int]:
        return self.levels[-1][0] if self.levels[0] else (0, 0)

    def find(self, offset: int) -> tuple[int, int]:
        """The leaf that holds the character at ``offset``, and where the leaf starts."""
        node, start = 0, 0
        for level in range(len(self.levels) - 2, -1, -1):
            node *= 2
            if node + 1 < len(self.levels[level]) and offset >= start + self.levels[level][node][0]:
                start += self.levels[level][node][0]
                node += 1
        return node, start

    def replace(self, first: int, last: int, pieces: list[str]) -> None:
        """Leaves first..last-1 become ``pieces``. Sums change along the paths of
        the leaves; only when their number changes are the levels laid out anew."""
        fresh = [pieces[i : i + LEAF] for i in range(0, len(pieces), LEAF)]
        if len(fresh) > last - first and len(fresh[-1]) < LEAF // 2 and len(fresh) > 1:
            fresh[-2:] = [fresh[-2] + fresh[-1]]
        sums = [self._sum(leaf) for leaf in fresh]
        self.leaves[first:last] = fresh
        if len(fresh) != last - first:
            low = self.levels[0]
            low[first:last] = sums
            self._build(low)
            return
        for at, pair in enumerate(sums, first):
            self.levels[0][at] = pair
        for level in range(1, len(self.levels)):
            first, last = first // 2, (last + 1) // 2
            for node in range(first, last):
                self.levels[level][node] = self._pair(self.levels[level - 1], 2 * node)


class Document:
    """A text with its segment tree."""

    def __init__(self, text: str, pattern, counter: Counter):
        self.text, self.pattern = text, pattern
        self.tree = SegmentTree(pattern.findall(text), counter)

    @classmethod
    def stored(cls, text: str, lengths, tokens, pattern, counter: Counter) -> Document:
        """A document from its stored tree: the lengths of each leaf's pre-tokens and its token count."""
        document = cls("", pattern, counter)
        document.text, leaves, at = text, [], 0
        for leaf in lengths:
            pieces = []
            for n in leaf:
                pieces.append(text[at : at + n])
                at += n
            leaves.append(pieces)
        document.tree = SegmentTree.stored(leaves, list(tokens), counter)
        return document

    def to_store(self) -> tuple[list[list[int]], list[int]]:
        return [list(map(len, leaf)) for leaf in self.tree.leaves], [n for _, n in self.tree.levels[0]]

    @property
    def n_tokens(self) -> int:
        return self.tree.total[1]

    def edit(self, offset: int, removed: int, put: str) -> int:
        """Applies an edit; returns how many characters were cut and counted again."""
        offset = max(0, min(offset, len(self.text)))
        removed = max(0, min(removed, len(self.text) - offset))
        text = self.text = self.text[:offset] + put + self.text[offset + removed :]
        if not self.tree.leaves:
            self.tree = SegmentTree(self.pattern.findall(text), self.tree.counter)
            return len(text)
        # a pre-token looks one character past its end: begin two pre-tokens before the edit
        first, start = self.tree.find(max(0, offset - 1))
        leaf = self.tree.leaves[first]
        place, keep = start, 0
        while keep < len(leaf) and place + len(leaf[keep]) < offset:
            place += len(leaf[keep])
            keep += 1
        if keep < 2 and first > 0:
            first -= 1
            leaf = self.tree.leaves[first]
            start -= self.tree.levels[0][first][0]
            place, keep = start + self.tree.levels[0][first][0] - len(leaf[-1]), len(leaf) - 1
        elif keep:
            keep -= 1
            place -= len(leaf[keep])
        shift, behind = len(put) - removed, offset + len(put)
        # old boundaries, in new offsets, behind the edit
        last, at = self.tree.find(min(max(0, offset + removed), max(0, self.tree.total[0] - 1)))
        old = at + shift
        bounds, i = [], 0
        pieces = leaf[:keep]
        found, here = [], place
        current = self.tree.leaves[last]
        for match in self.pattern.finditer(text, place):
            found.append(match.group())
            here = match.end()
            if here < behind:
                continue
            while old < here and last < len(self.tree.leaves):
                if i < len(current):
                    old += len(current[i])
                    i += 1
                else:
                    last += 1
                    current, i = (self.tree.leaves[last], 0) if last < len(self.tree.leaves) else ([], 0)
            if old == here and last < len(self.tree.leaves):
                bounds = current[i:]
                break
        else:
            last = len(self.tree.leaves) - 1
        self.tree.replace(first, min(last, len(self.tree.leaves) - 1) + 1, pieces + found + bounds)
        return here - place


def standard_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, edits): three edits per document drawn from the row itself:
    a word put in at a third, a span of a tenth (100 characters at most) cut out
    at two thirds, and a line break with the first 20 characters added at the end."""
    n = F.char_length("text")
    third, twice = F.floor(n / 3), F.floor(n * 2 / 3)
    tenth = F.least(F.floor(n / 10), F.lit(100))
    edit = lambda at, out, put: F.struct(at.cast("int").alias("offset"), out.cast("int").alias("removed"), put.alias("put"))
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return slim.withColumn(
        "edits",
        F.array(
            edit(third, F.lit(0), F.concat(F.lit(" "), F.substring("text", 1, 7))),
            edit(twice, tenth, F.lit("")),
            edit(n - tenth + F.least(n, F.lit(7)) + 1, F.lit(0), F.concat(F.lit("\n"), F.substring("text", 1, 20))),
        ),
    )


def _reader(vocabulary: str, pattern: str):
    """(compiled pattern, counter) of a task."""
    import regex
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return regex.compile(pattern), Counter(tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}))


def _apply(document: Document, edits) -> int:
    """Applies a row's edits in order; returns how many characters were counted again."""
    recounted = 0
    for one in edits if edits is not None else ():
        if one is not None:
            recounted += document.edit(int(one["offset"] or 0), int(one["removed"] or 0), one["put"] or "")
    return recounted


def count_edited(edited: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens (before), n_tokens_edited, n_chars_edited, recounted_chars
    for rows of (doc_id, text, edits array<struct<offset, removed, put>>).

    Offsets count code points of the text as the edits before left it, and are
    brought into its range. Null texts count as empty, null edits or fields as
    none, 0 and ''. Rows that repeat an id are counted each. No rows give no
    rows; other columns are not read, whatever their names.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut, counter = _reader(vocabulary, pattern)
        for batch in batches:
            rows = []
            for text, edits in zip(batch["text"], batch["edits"], strict=True):
                document = Document(text or "", cut, counter)
                before = document.n_tokens
                recounted = _apply(document, edits)
                rows.append((before, document.n_tokens, len(document.text), recounted))
            out = pd.DataFrame(rows, columns=["n_tokens", "n_tokens_edited", "n_chars_edited", "recounted_chars"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return map_rows(edited.select("doc_id", "text", "edits"), "doc_id", run, "n_tokens long, n_tokens_edited long, n_chars_edited long, recounted_chars long")


TREE = "text string, leaves array<array<int>>, leaf_tokens array<int>, n_tokens long"


def _trees(rows: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id and the columns of ``TREE`` after the edits of rows of doc_id, text, leaves, leaf_tokens, edits; null leaves are cut from the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut, counter = _reader(vocabulary, pattern)
        for batch in batches:
            out = []
            for text, leaves, tokens, edits in batch[["text", "leaves", "leaf_tokens", "edits"]].itertuples(index=False, name=None):
                fresh = leaves is None
                document = Document(text, cut, counter) if fresh else Document.stored(text, leaves, tokens, cut, counter)
                _apply(document, edits)
                out.append((document.text, *document.to_store(), document.n_tokens))
            frame = pd.DataFrame(out, columns=["text", "leaves", "leaf_tokens", "n_tokens"])
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    return map_rows(rows, "doc_id", run, TREE)


def build_trees(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, leaves (lengths of each leaf's pre-tokens), leaf_tokens, n_tokens: one tree per row, to be written as a table. Null texts count as empty."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    none = {"leaves": F.lit(None).cast("array<array<int>>"), "leaf_tokens": F.lit(None).cast("array<int>"), "edits": F.lit(None).cast(EDITS)}
    return _trees(slim.withColumns(none), vocabulary, pattern)


EDITS = "array<struct<offset:int,removed:int,put:string>>"


def apply_edits(trees: DataFrame, edits: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``trees`` (of ``build_trees``) after an edit table (doc_id, edit_no, offset, removed, put).

    A document's edits are applied by edit_no, ties by offset, removed and put; they
    come to the document's row, so they have to fit a row like its text. Trees without edits are not
    unpacked. Edits of ids that no tree has, or without an id, do nothing; trees
    that repeat an id get the edits each; trees without an id none.
    """
    listed = edits.where("doc_id is not null").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("edit_no", "offset", "removed", "put"))).alias("e"))
    cast = F.transform("e", lambda x: F.struct(x["offset"].cast("int").alias("offset"), x["removed"].cast("int").alias("removed"), x["put"].alias("put")))
    listed = listed.select("doc_id", cast.alias("edits"))
    columns = ["doc_id", "text", "leaves", "leaf_tokens", "n_tokens"]
    same = trees.join(listed, "doc_id", "left_anti").select(*columns)
    return same.unionByName(_trees(trees.join(listed, "doc_id").select(*columns[:4], "edits"), vocabulary, pattern))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return count_edited(standard_edits(docs), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
