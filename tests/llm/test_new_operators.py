"""Operators 11 to 13 on small fixtures: layout, proofs, spans and search against brute force."""

import gc
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from earshot.llm import lexical, merkle, pii

CLASH = ["grp", "place", "digest", "member", "total", "global", "row", "o0", "leaf", "changed", "base", "pii", "base_email", "more_card", "term", "score", "rank", "query", "n"]


def clashing(df):
    return df.withColumns({c: F.lit("x") for c in CLASH})


# --- Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("height", [0, 1, 2, 3, 5, 8])
def test_van_emde_boas_addresses(height):
    places = np.concatenate(merkle.layout(height))
    assert sorted(places.tolist()) == list(range((2 << height) - 1))  # every place once
    top = (height + 1) // 2
    for depth in range(top, height + 1):  # a subtree below the cut stands in one piece
        size = (1 << (height + 1 - top)) - 1
        trees = (merkle.layout(height)[depth] - ((1 << top) - 1)) // size
        assert trees.tolist() == [i >> (depth - top) for i in range(1 << depth)]


def brute_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return levels


def brute_manifest(rows, altered):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha("".join(map(field, r)))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([leaf(r) for r in sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for g in groups}
    top = brute_tree([trees[g][-1][0] for g in order])
    out = []
    for g in order:
        for i, r in enumerate(sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))):
            now = leaf((*r[:3], None if r[3] is None else r[3] + 1, r[4])) if altered(r) else leaf(r)
            proof = ""
            for levels, at in ((trees[g], i), (top, order.index(g))):
                for level in levels[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else None
                    now = sha(now) if other is None else sha(other + now) if at & 1 else sha(now + other)
                    proof += other or ""
                    at >>= 1
            out.append((r[0], trees[g][0][i], trees[g][-1][0], top[-1][0], sha(proof), now, now == top[-1][0]))
    return out


@pytest.mark.parametrize("height", [1, 2, 12])
def test_manifest_against_plain_hashing(spark, height):
    draw = random.Random(height)
    rows = [(i, draw.choice([None, "s"]), draw.choice([None, "de", "en", "é"]), draw.choice([None, i]), draw.choice([None, "", "t" * i, "ü"])) for i in range(61)]
    rows += [(61, "s", "alone", 1, "x"), (None, "s", "en", 1, "a"), (None, "s", "en", 1, "b"), (5, "s", "en", 5, "twice"), (5, "s", "en", 5, "twice"), (70, None, None, None, "w " * 30_000)]
    df = clashing(spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string"))
    got = merkle.manifest_check(df, alter={"n_chars": F.col("n_chars") + 1}, altered=F.col("doc_id") % 7 == 0, block_height=height)
    want = brute_manifest(rows, lambda r: r[0] is not None and r[0] % 7 == 0)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert any(not w[-1] for w in want)


def test_manifest_of_one_row_and_none(spark):
    one = spark.createDataFrame([(1, None, None, None, None)], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    (row,) = merkle.manifest_check(one).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root == sha("1:1----") and row.proof_sha256 == sha("") and row.verified
    assert merkle.manifest_check(one.limit(0)).count() == 0


# --- personal data

BITS = ["a", "Z", "0", "9", "12", "255", "256", "4111111111111111", "4111 1111 1111 1111", "-", " ", ".", "@", "+", "_", "%", "(", ")", "é", "😀", "tel", "card", "iban",
        "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "\n", "order", "555-123-4567", "1.2.3.4", "a@b.c", "+1 (555) 123-4567", "0000000000000"]


def test_pii_against_sql(spark, tmp_path):
    draw = random.Random(3)
    rows = [(i, "".join(draw.choice(BITS) for _ in range(draw.randrange(60)))) for i in range(300)]
    rows += [(900, None), (901, ""), (None, "a@b.c_d@e.f.g 1.2.3.4.5.6.7.8"), (903, "1." * 900), (904, "é 4111111111111111 card " * 300), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    df.write.parquet(f"file://{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(map(str, db.sql(pii.ORACLE).fetchall()))
    assert sorted(map(str, map(tuple, pii.op12_pii(spark, f"file://{tmp_path}").collect()))) == want
    assert any(",iban:" in w for w in want) and any("card:" in w for w in want)


def test_pii_of_long_runs(spark):
    """Runs of one sort of character neither overflow the stack nor take the square of their length."""
    rows = [(1, "1" * 200_000), (2, "1 " * 100_000), (3, "1." * 50_000), (4, "a" * 200_000 + "@x"), (5, "a@" + "b." * 50_000 + "c"), (6, "+1" + " " * 100_000)]
    got = {r.doc_id: r.pii for r in pii.find_pii(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert not got[1] and not got[2] and not got[4] and not got[6] and len(got[3]) == 12_500
    assert [(s.kind, s["at"], s.upto) for s in got[5]] == [("email", 0, 100_003)]


def test_pii_scores_and_redaction(spark):
    rows = [
        (1, "Call 555-123-4567 or pay to IBAN DE89 3704 0044 0532 0130 00.", "Call [phone] or pay to IBAN [iban]."),
        (2, "part 555-123-4567, order 4111111111111111", "part 555-123-4567, order [card]"),
        (3, "serial DE89370400440532013000, code DE89370400440532013001", "serial DE89370400440532013000, code DE89370400440532013001"),
        (4, "x@y.de 10.0.0.1 10.0.0.256", "[email] [ip] 10.0.0.256"),
        (5, "card 12 4111111111111111 99999", "card 12 [card] 99999"),
        (6, None, None),
        (7, "", ""),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in pii.redact(df).collect()} == {r[0]: r[2] for r in rows}
    wide = clashing(df)
    found = pii.find_pii(wide, out_col="found")
    assert found.columns == [*wide.columns, "found"] and found.count() == len(rows) and pii.find_pii(df.limit(0)).count() == 0
    assert pii.redact(wide).columns == wide.columns
    spans = {r.doc_id: [(s.kind, s.score, s.base) for s in r.found] for r in found.collect()}
    assert spans[1] == [("phone", 70, False), ("iban", 110, False)] and spans[2] == [("card", 100, True)] and spans[5] == [("card", 90, False)]


# --- ranked search


def brute_search(docs, items, k):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    held = [(i, w) for i, w in ((i, words(t)) for i, t in docs) if w]
    n_docs, n_terms = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    asked = {}
    for item, text in items:
        asked.setdefault(item, []).extend(words(text))
    for item, ask in asked.items():
        found = []
        for doc_id, w in held:
            m = 75 + 25 * len(w) * n_docs // n_terms
            score = 0
            for t in ask:
                tf = w.count(t)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            if score > 0:
                found.append((-score, doc_id is not None, doc_id or 0))
        out += [(item, r + 1, d if there else None, -s) for r, (s, there, d) in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize(("docs_a_segment", "block_terms"), [(3, 1), (16, 20), (8_192, 200_000)])
def test_search_against_all_documents(spark, docs_a_segment, block_terms):
    draw = random.Random(docs_a_segment)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "é", "ÀB", "x9", "😀"]
    text = lambda n: " ".join(vocabulary[min(int(draw.expovariate(0.12)), len(vocabulary) - 1)] for _ in range(n))
    docs = [(i, text(draw.randrange(1, 40))) for i in range(70)]
    docs += [(i, "same TEXT, w1_w2") for i in range(100, 130)] + [(None, "same text w1"), (7, "repeated id w3"), (7, "repeated id w3"), (200, None), (201, ""), (202, "-- !"), (203, "w1 " * 20_000)]
    items = [(1, "w1 w2 w2 w3 same"), (2, text(30)), (3, None), (4, "nowhere"), (5, "É é àb ÀB"), (None, "w5 w6"), (6, "w7"), (6, "W8 w7"), (8, "repeated")]
    docs_df = clashing(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3))
    items_df = spark.createDataFrame(items, "item_id bigint, text string")
    index = lexical.build_index(docs_df, segment_docs=docs_a_segment)
    got = lexical.search(index, items_df, k=5, block_terms=block_terms).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_search(docs, items, 5)))


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical.ranked_search(docs.limit(0), items).count() == 0
    assert lexical.ranked_search(docs, items.limit(0)).count() == 0
    assert lexical.ranked_search(docs.where("text is null"), items).count() == 0


def test_closed_segments_leave_no_garbage():
    segment = lexical.Segmenter(10, 1_000)
    gc.collect()
    gc.disable()
    try:
        for _ in range(3):
            segment.add(1, b"a b c a")
            segment.close()
        assert gc.collect() == 0
    finally:
        gc.enable()


def test_segments_are_written_and_read_few_at_once(spark, monkeypatch):
    monkeypatch.setattr(lexical, "LARGE_ROWS", lexical.LARGE_ROWS | {"parquet.block.size": "65536"})
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(500))) for i in range(60)], "doc_id bigint, text string")
    index = lexical.build_index(docs.coalesce(1), segment_docs=1)
    (file,) = index.inputFiles()
    groups = pq.ParquetFile(file.removeprefix("file://")).metadata
    assert groups.num_rows == 60 and groups.num_row_groups > 5
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before, held = spark.conf.get(name), []
    write = lexical.materialize
    monkeypatch.setattr(lexical, "materialize", lambda df, to, **options: (held.append((to, spark.conf.get(name))), write(df, to, **options))[1])
    items = spark.createDataFrame([(1, "w3x4 w5x6")], "item_id bigint, text string")
    assert {r.doc_id for r in lexical.search(index, items).collect()} == {3, 5}
    assert {to for to, rows in held if rows == "1"} == {"df", "found"} and spark.conf.get(name) == before


def test_segments_are_read_back(spark):
    docs = spark.createDataFrame([(i, f"a b{i % 5} " + "c " * i) for i in range(40)], "doc_id bigint, text string")
    (row,) = lexical.build_index(docs.coalesce(1)).collect()
    treap, ids, rows = lexical.open_segment(row.asDict(), row.n_docs, row.n_terms)
    assert (row.n_docs, row.n_terms, len(rows)) == (40, sum(2 + i for i in range(40)), 7) and sorted(ids.tolist()) == list(range(40))
    assert len(treap.best) > 40 and treap.best[1] == treap.best.max()
