"""The opN queries against SQL, and the ones SQL can't express against brute force."""

import hashlib
import html
import re
import zlib

import pytest

from earshot.llm import queries
from tests.conftest import SF
from tests.oracle import assert_same, connect


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, name):
    assert_same(spark, queries.QUERIES[name], queries.ORACLES[name], SF)


def test_op2_against_plain_cutting(spark):
    got = {r.page_id: (r.text, r.n_chars) for r in queries.QUERIES["op2_html_extraction"](spark, SF).collect()}
    pages = connect(SF).sql("select page_id, html from pages").fetchall()
    assert len(got) == len(pages)
    for page_id, page in pages:
        body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|ul|li)>", body)]
        text = "\n".join(b for b in blocks if b)
        assert got[page_id] == (text, len(text))


def test_op6_against_the_library(spark):
    import sentencepiece

    from earshot.llm.sentencepiece_codec import default_model

    sp = sentencepiece.SentencePieceProcessor(model_file=default_model())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op6_sentencepiece"](spark, SF).collect()}
    for doc_id, text in connect(SF).sql("select doc_id, coalesce(text, '') from documents").fetchall():
        ids = sp.encode(text)
        assert got[doc_id] == (len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))


def test_op9_against_whole_encoding(spark):
    import base64

    import public_tokenizers as P
    import tiktoken

    from earshot.llm.token_counts import VOCABULARY, standard_edits

    with open(P.path(VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in queries.QUERIES["op9_token_counts"](spark, SF).collect()}
    for row in standard_edits(spark.read.parquet(f"{SF}/documents.parquet")).collect():
        text = row.text
        for e in row.edits:
            at = max(0, min(e.offset, len(text)))
            text = text[:at] + e.put + text[at + min(e.removed, len(text) - at) :]
        out = got[row.doc_id]
        assert (out.n_tokens, out.n_tokens_edited, out.n_chars_edited) == (len(enc.encode_ordinary(row.text)), len(enc.encode_ordinary(text)), len(text))


def test_op10_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op10_quality"](spark, "/root/testdata/sf0.01").collect()}
    labels = connect("/root/testdata/sf0.01").sql("select doc_id, quality from labels").fetchall()
    held = [(got[i], q) for i, q in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and all(r.held_out for r, _ in held) and all(0 <= r.score <= 1 for r in got.values())
    good = [r.predicted for r, q in held if q == 1]
    assert sum(good) >= 0.98 * len(good)
    pairs = [(a.score > b.score) + (a.score == b.score) / 2 for a, x in held for b, y in held if x == 1 and y == 0]
    assert sum(pairs) / len(pairs) > 0.95


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for _, stage in cp.STAGES[:-1]:
        docs = cp.materialize(stage(spark, docs, SF), "t")
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    last = cp.STAGES[-1][1](spark, docs, SF)
    assert last.count() == before and {"doc_id", "n_tokens", "ids_sha256"} <= set(last.columns)
