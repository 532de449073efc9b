"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import gzip
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from earshot.llm import common, decontaminate, exact_dedup, html_extract, line_dedup, ngram_join, quality_gam, sentencepiece_codec, sharding, token_counts, warc

LONG = " ".join(f"w{i}" for i in range(20_000))
ROWS = [(1, "a b c d e f g", "x"), (2, None, None), (3, "", "x"), (4, LONG, "y"), (5, LONG + " tail", "y"), (1, "a b c d e f g", "x"), (None, "a b c d e f g", "x"), (7, "a\nb\nc\nd", "x"), (8, "z\nb\nc\nd", "x")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, source string")
    clash = ["__id", "__key", "__body", "__starts", "__gone", "__lines", "__n", "__start", "__place", "__group", "id", "starts", "node", "family", "place", "slot", "draw", "key", "keep_id", "kept", "n", "rep", "body", "w1", "covered", "removed_lines", "ids", "score", "label", "rank", "bucket", "component", "lines"]
    return df.withColumns({c: F.lit("x") for c in clash})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_exact_dedup(docs, empty):
    got = sorted((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs, bucket_entries=2).collect())
    assert ("1", 1, 3, True) in got and ("None", 1, 3, False) in got and ("2", 3, 2, False) in got and ("3", 3, 2, True) in got and len(got) == len(ROWS)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_directory_doubles_until_buckets_fit(spark):
    entries = spark.range(5000).select(F.xxhash64("id").alias("key"))
    buckets, start = exact_dedup.directory(entries, 40)
    loads = exact_dedup.with_bucket(entries, buckets, start).groupBy("bucket").count()
    assert loads.agg(F.max("count")).first()[0] <= 40 and loads.agg(F.sum("count")).first()[0] == 5000
    assert buckets.agg(F.max("depth")).first()[0] > start and buckets.count() == buckets.select("bucket").distinct().count()


def test_buckets_are_split_without_limit(spark):
    entries = spark.range(40).select(F.when(F.col("id") < 30, F.col("id")).otherwise(F.shiftleft("id", 57)).alias("key"))  # 30 keys differ in their last bits only
    buckets, start = exact_dedup.directory(entries, 3)
    loads = exact_dedup.with_bucket(entries, buckets, start).groupBy("bucket").count()
    assert loads.agg(F.max("count")).first()[0] <= 3 and loads.agg(F.sum("count")).first()[0] == 40 and buckets.agg(F.max("depth")).first()[0] >= 62


def test_owners_have_whole_buckets(spark, monkeypatch):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.xxhash64((F.col("id") % 1500).cast("string")).alias("key"), (F.col("id") % 1500).cast("string").alias("text"))
    index, chains, buckets, _ = exact_dedup.build_index(rows, 50)
    files = index.select("bucket", "key", F.input_file_name().alias("f"))
    assert files.groupBy("bucket").agg(F.count_distinct("f").alias("n")).where("n > 1").isEmpty()  # a bucket is held by one task
    spans = sorted(map(tuple, files.groupBy("f").agg(F.min("key"), F.max("key")).select("min(key)", "max(key)").collect()))
    unsigned = sorted((a % 2**64, b % 2**64) for a, b in spans)
    assert len(spans) > 1 and index.count() == 1500 and chains.isEmpty() and unsigned
    plan = exact_dedup.owned(index, buckets)._jdf.queryExecution().toString()
    assert "rangepartitioning(bucket" in plan
    # without the directory there is one owner for all keys
    alone = lambda keys, most: (spark.createDataFrame([(0, 0)], "bucket bigint, depth int"), 0)
    monkeypatch.setattr(exact_dedup, "directory", alone)
    bypassed = exact_dedup.build_index(rows, 50)[0]
    assert bypassed.select(F.input_file_name()).distinct().count() == 1


@pytest.mark.parametrize("broadcast", [0, 1000])
@pytest.mark.parametrize("bits", [0, 3])
def test_texts_with_one_key_are_chained_and_compared(spark, bits, broadcast):
    draw = random.Random(bits)
    rows = [(i, draw.choice(["a", "b", "c", "a ", "A", None, "", "d" * 3000, "d" * 2999 + "e"])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    forced = lambda text: F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 64 - bits), 64 - bits) if bits else F.lit(7).cast("long") + F.length(text) * 0
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    got = exact_dedup.exact_dedup(df, bucket_entries=2, key=forced, broadcast_keys=broadcast).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == {(i, max(g), len(g), i == max(g)) for g in groups.values() for i in g} and len(got) == 300
    assert max(r.place for r in got) > 0
    plain = {(r.doc_id, r.keep_id, r.text_sha256) for r in exact_dedup.exact_dedup(df).collect()}
    assert plain == {(r.doc_id, r.keep_id, r.text_sha256) for r in got}


def test_line_dedup(docs, empty):
    got = [(r.doc_id, r.text, r.removed_lines) for r in line_dedup.line_dedup(docs).select("doc_id", "text", "removed_lines").collect()]
    assert (7, "a\nb\nc\nd", 0) in got and (8, "z", 3) in got and (2, None, 0) in got and len(got) == len(ROWS)
    assert line_dedup.line_dedup(empty).count() == 0


def test_line_dedup_within_a_document(spark):
    df = spark.createDataFrame([(1, "a\nb\nc\na\nb\nc\nx"), (2, "\n\n\n\n\n")], "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in line_dedup.line_dedup(df).collect()} == {1: "a\nb\nc\nx", 2: "\n\n\n\n\n"}


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame([(1, LONG[40:400]), (2, None), (None, LONG[40:400]), (3, "too short"), (4, "not in any document at all here"), (1, LONG[40:400])], "item_id bigint, text string")
    hits = decontaminate.contamination(docs, items)
    assert sorted((r.doc_id, r.item_id) for r in hits.collect()) == [(4, 1), (5, 1)]
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 2
    assert decontaminate.contamination(empty, items).count() == 0 and decontaminate.decontaminate(docs, items.limit(0)).count() == len(ROWS)


def test_containment_threshold(spark):
    words = [f"t{i}" for i in range(24)]  # 20 shingles
    near = words[:20]  # 16 of them: exactly 0.8
    far = words[:19]
    docs = spark.createDataFrame([(1, "Pre " + " ".join(near).upper() + "!"), (2, " ".join(far))], "doc_id bigint, text string")
    items = spark.createDataFrame([(9, " ".join(words))], "item_id bigint, text string")
    assert [(r.doc_id, r.n_shared) for r in decontaminate.contamination(docs, items).collect()] == [(1, 16)]


def test_ngram_join(docs, empty):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_components(docs).collect()}
    assert {(1, 4, 1), (None, 4, 1), (2, 0, 2), (3, 0, 3), (4, 19997, 4), (5, 19998, 4)} <= got
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and 5 not in {r.doc_id for r in kept.collect()} and kept.count() == len(ROWS) - 1
    assert ngram_join.ngram_components(empty).count() == 0


@pytest.mark.parametrize("block", [2, 7, 256])
def test_ngram_join_against_all_pairs(spark, block):
    draw = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for _ in range(70):
        words = list(base[draw.randrange(3) * 8 :])
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = f"r{draw.randrange(9)}"
        texts.append(" ".join(words))
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (t.split() for t in texts)]
    low = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 85 * len(a | b):
                    low[i] = low[j] = min(low[i], low[j])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(df, block_sets=block).collect()}
    assert [got[i] for i in range(len(texts))] == low


def test_words_end_at_ascii_white_space_in_code_and_oracle():
    text = "a\rb\x0bc\x0cd\te\nf g\x1fh\u00a0i"
    db = duckdb.connect()
    db.execute("create table documents as select 1 as doc_id, ? as text", [text])
    assert db.sql(ngram_join.ORACLE).fetchall() == [(1, 4, 1)] and len(ngram_join.Shingler()(text)) == 4


def test_trie_finds_what_counting_finds():
    draw = np.random.default_rng(3)
    seqs = [np.unique(draw.integers(0, 40, draw.integers(1, 30))) for _ in range(120)]
    trie = ngram_join.Trie(seqs, [len(s) for s in seqs])
    for own in seqs[:40]:
        mask = np.zeros(40, bool)
        mask[own] = True
        want = {i for i, s in enumerate(seqs) if 100 * len(set(s) & set(own)) >= 60 * len(set(s) | set(own))}
        assert set(trie.linked(own, len(own), mask, 60)) == want


def test_sharding(docs, empty):
    got = sharding.shard(docs, bucket_rows=2).collect()
    sizes = {}
    for r in got:
        sizes.setdefault(r.shard, []).append(r.slot)
    assert len(got) == len(ROWS) and all(sorted(v) == list(range(len(v))) for v in sizes.values())
    assert max(map(len, sizes.values())) <= 1 + len(ROWS) // 8 and sharding.shard(empty).count() == 0


def test_shards_match_the_mixture(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 20)).alias("source"))
    counts = sharding.shard(df).groupBy("source", "shard").count()
    spread = counts.groupBy("source").agg((F.max("count") - F.min("count")).alias("d"))
    assert spread.agg(F.max("d")).first()[0] <= 2


def test_sentencepiece_round_trip(docs, empty):
    model = sentencepiece_codec.default_model()
    enc = sentencepiece_codec.encode(docs, model, table_chunks=3)
    assert enc.count() == len(ROWS) and sentencepiece_codec.encode(empty, model).count() == 0
    back = {r.doc_id: r.decoded for r in sentencepiece_codec.decode(enc, model).collect()}
    assert back[4] == LONG and back[2] == "" and back[7] == "a\nb\nc\nd"


def test_chunks_are_the_whole_encoding():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.default_model())
    held, draw = sentencepiece_codec.ChunkTable(sp, 500), random.Random(2)
    for _ in range(20_000):
        text = "".join(draw.choice(" ▁\n\tabé中😀 \x00.<s>") for _ in range(draw.randrange(14)))
        found = [held[c] for c in sentencepiece_codec.chunks(text)]
        ids = sp.encode(text)
        assert [i for e in found for i in e[0]] == ids and "".join(e[2] for e in found)[1:] == sp.decode(ids)


def test_token_counts_edges(spark, empty):
    import public_tokenizers as P

    run = lambda df: token_counts.count_edited(df, P.path(token_counts.VOCABULARY), P.PATTERN)
    schema = "doc_id bigint, text string, edits array<struct<offset:int,removed:int,put:string>>"
    df = spark.createDataFrame([(1, None, [(5, 3, "new text")]), (2, "some words here", None), (None, "abc", [None, (99, 9, None)])], schema)
    got = {r.doc_id: (r.n_tokens, r.n_chars_edited) for r in run(df).collect()}
    assert got[1] == (0, 8) and got[2][1] == 15 and got[None][1] == 3 and run(df.limit(0)).count() == 0


def test_segment_tree_edits():
    import base64

    import public_tokenizers as P
    import regex
    import tiktoken

    with open(P.path(token_counts.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    cut, counter, draw = regex.compile(P.PATTERN), token_counts.Counter(enc, 1000), random.Random(4)
    letters = "ab 's\n\t12é中.,!  're"
    for _ in range(300):
        text = "".join(draw.choice(letters) for _ in range(draw.choice([0, 1, 40, 900])))
        doc = token_counts.Document(text, cut, counter)
        for _ in range(4):
            at, gone = draw.randrange(len(text) + 1), draw.choice([0, 1, 30])
            put = "".join(draw.choice(letters) for _ in range(draw.choice([0, 2, 50])))
            text = text[:at] + put + text[at + gone :]
            doc.edit(at, gone, put)
            assert doc.text == text and doc.n_tokens == len(enc.encode_ordinary(text))


def test_quality_edges(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, None), (99, 1), (1, 1)], "doc_id bigint, quality int")
    for model in (quality_gam.train(docs, labels), quality_gam.train(empty, labels), quality_gam.train(docs, labels.limit(0))):
        got = quality_gam.classify(docs, model).collect()
        assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert quality_gam.keep_good(docs, model, threshold=0.0).columns == docs.columns


def test_gam_learns_an_interaction():
    x = np.random.default_rng(1).uniform(-1, 1, (3000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality_gam.fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9 and (0, 1) in model.pairs


PAGES = [(1, "http://h/1", "p" * 1500), (2, "http://h/2", "p" * 1500), (3, None, None), (4, "u", "small"), (5, "u", "small"), (6, "u", "WARC/1.0\r\nfake\r\n\r\n" + "ż" * 900), (None, "u", "x")]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("w") / "warc")
    warc.write_warc(spark.createDataFrame(PAGES, "page_id bigint, url string, html string").coalesce(1), f"file://{path}")
    return path


def test_warc_round_trip(spark, archive):
    rows = warc.read_warc(spark, f"file://{archive}").where("kind = 'record'").collect()
    found = {r.record_id: r for r in rows}
    assert len(found) == len(PAGES) and found["<urn:x-page:1>"].record_type == "revisit" and found["<urn:x-page:1>"].refers_to == "<urn:x-page:2>"
    assert found["<urn:x-page:1>"].payload_bytes == 1500 and found["<urn:x-page:4>"].record_type == "response" and bytes(found["<urn:x-page:6>"].payload).decode() == PAGES[5][2]


def test_warc_salvage(archive):
    import glob

    raw = gzip.decompress(open(glob.glob(f"{archive}/**/part-*", recursive=True)[0], "rb").read())
    whole = [r for r in warc.records(raw) if r[0] == "record"]
    bad = bytearray(raw)
    bad[whole[1][1] + 400] ^= 255  # the second record no longer meets its digest
    got = list(warc.records(bytes(bad)))
    assert [g[0] for g in got].count("gap") == 1 and sum(g[0] == "record" for g in got) == len(whole) - 1
    assert [(g[1], g[2]) for g in got if g[0] == "gap"] == [whole[1][1:3]]
    packed = [gzip.compress(raw[r[1] : r[2]]) for r in whole]
    broken = bytearray(b"".join(packed))
    broken[len(packed[0]) + 30] ^= 255
    seen = [m for m in warc.members(bytes(broken)) if m[3]]
    assert sum(len([r for r in warc.records(m[2]) if r[0] == "record"]) for m in seen) >= len(whole) - 1
    assert list(warc.records(raw[:-10]))[-1][0] == "gap" and list(warc.records(b"")) == []


HTML = """<html><head><title>T</title><style>p{}</style></head><body><nav>Menu</nav><header>Site</header><aside>Side</aside>
<article><h1>Head&amp;line</h1><p>One <b>two</b>\n three<p>Four<div class="ad">Buy</div><div class="cookie-notice">OK?</div><form><p>mail</p></form>
<section id="comments"><p>first!</p></section><p>&lt;end&gt;</p><script>var a = "</p>";</script></article><footer>&copy; x</footer></body></html>"""


def test_html_roles():
    assert html_extract.main_text(HTML)[0] == "Head&line\nOne two three\nFour\n<end>"
    assert html_extract.main_text("<div class='post-content'><main><p>a</p></main></div> tail")[0] == "a"
    assert html_extract.main_text("<p>just <i>text</i> <!-- no --> here")[1] == ["just text here"]
    assert html_extract.main_text("<article>a<br>b<p title='>'>c</p><foo")[0] == "a b\nc"


def test_html_suffix_array(spark):
    shared = "read more stories like this one on our big site today"
    rows = [(i, f"http://h.org/{i}", f"<div>{shared}</div><div>own words of page number {i} that nobody else has written</div>") for i in range(3)]
    rows += [(8, "http://other.org/8", f"<div>{shared}</div>"), (9, None, None), (10, "http://h.org/0", rows[0][2])]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got[8] == shared and got[9] == "" and got[10] == got[0]
    assert all(got[i] == f"{i} that nobody else has written" for i in (1, 2))  # "... today own words of page number" is one repeated substring
    assert all(shared not in got[i] for i in range(3)) and html_extract.extract(df.limit(0)).count() == 0


def test_components_drop_loops(spark):
    edges = spark.createDataFrame([(1, 1), (5, 2), (2, 9), (None, 3)], "a bigint, b bigint")
    assert {tuple(r) for r in common.connected_components(edges).collect()} == {(2, 2), (5, 2), (9, 2)}


def test_keep_one_tells_rows_of_one_id_apart(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    df = spark.createDataFrame([(3, a), (7, a), (7, b), (None, a), (8, None)], "doc_id bigint, text string")
    assert sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(df).collect()), key=str) == sorted([(3, a), (7, b), (None, a), (8, None)], key=str)
    with pytest.raises(TypeError, match="whole numbers"):
        ngram_join.ngram_components(df.withColumn("doc_id", F.col("doc_id").cast("string")))


@pytest.mark.parametrize("block", [5, 16])
def test_large_families_lose_no_link(spark, block):
    """Clusters that share rare passages without being linked, near copies, and sets between two clusters."""
    draw, texts = random.Random(block), []
    passage = [f"p{i}" for i in range(12)]
    for k in range(4):
        base = [f"k{k}-{i}" for i in range(50)] + passage
        for _ in range(22):
            words = list(base)
            for _ in range(draw.randrange(3)):
                words[draw.randrange(len(words))] = f"r{draw.randrange(5)}"
            texts.append(" ".join(words[: len(words) - draw.randrange(5)]))
    for _ in range(8):
        texts.append(" ".join([f"z{draw.randrange(99)}" for _ in range(30)] + passage))
    draw.shuffle(texts)
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (t.split() for t in texts)]
    low = list(range(len(texts)))
    for _ in range(12):
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 85 * len(a | b):
                    low[i] = low[j] = min(low[i], low[j])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(df, block_sets=block).collect()}
    assert [got[i] for i in range(len(texts))] == low and 4 < len(set(low)) < len(low)


def test_models_with_pieces_across_markers_take_whole_texts():
    class Model:
        def __init__(self, pieces):
            self.pieces = pieces

        id_to_piece = lambda self, i: self.pieces[i]
        get_piece_size = lambda self: len(self.pieces)
        is_control = is_unknown = is_byte = lambda self, i: False

    across = sentencepiece_codec.has_pieces_across_markers
    assert not across(Model(["▁", "▁▁a", "b"])) and across(Model(["a▁b"])) and across(Model(["▁a▁"]))


def test_table_scores_equal_a_loop_over_rows():
    draw = np.random.default_rng(7)
    x = draw.uniform(-1, 1, (400, 5))
    model = quality_gam.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] + draw.normal(0, 0.2, 400) > 0).astype(float))
    for row, got in zip(x[:60], model.score(x[:60]), strict=True):
        total = model.base
        for j, (cuts, values) in enumerate(zip(model.cuts, model.tables, strict=True)):
            total += values[sum(1 for c in cuts if c <= row[j])]
        for (a, b), values in zip(model.pairs, model.pair_tables, strict=True):
            total += values[sum(1 for c in model.pair_cuts[a] if c <= row[a]), sum(1 for c in model.pair_cuts[b] if c <= row[b])]
        assert abs(1 / (1 + np.exp(-total)) - got) < 1e-12


def test_training_takes_the_same_rows_whatever_repeats(spark):
    rows = [(i, f"text {i} " * (i % 9 + 1)) for i in range(200)] + [(5, "zz other text"), (6, None)]
    labels = [(i, i % 2) for i in range(200)] + [(5, 0), (7, 0), (8, 3), (None, 1)]
    df, ls = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int")
    one, two = (quality_gam.train(d.repartition(n), l.repartition(n), rows=50) for d, l, n in ((df, ls, 1), (df.orderBy(F.desc("text")), ls, 5)))
    assert np.array_equal(one.raw(np.ones((1, 19))), two.raw(np.ones((1, 19)))) and all(np.array_equal(a, b) for a, b in zip(one.tables, two.tables))


def test_pipeline_on_clashing_columns_nulls_and_repeats(spark, tmp_path):
    import corpus_pipeline as cp

    clash = {c: F.lit("x") for c in ["__id", "__key", "__body", "__starts", "__gone", "__lines", "id", "body", "key", "starts", "lines", "count", "removed_lines_", "label", "score"]}
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, None), (None, "some text here"), (900_001, None), (900_002, ""), (900_002, ""), (900_003, LONG)], "doc_id bigint, text string")
    docs = docs.unionByName(odd.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "n_chars": F.lit(None).cast("bigint")}), allowMissingColumns=True).withColumns(clash)
    for rows in (docs, docs.limit(0)):
        now = rows
        for _, stage in cp.STAGES[:-1]:
            now = cp.materialize(stage(spark, now, SF), "clash")
            assert now.columns == docs.columns
        assert cp.STAGES[-1][1](spark, now, SF).count() == now.count()


def test_stored_trees_take_later_edits(spark):
    import base64

    import public_tokenizers as P
    import tiktoken

    path, draw = P.path(token_counts.VOCABULARY), random.Random(9)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    letters = "ab 's\n\t12é中.,!  're"
    texts = {i: "".join(draw.choice(letters) for _ in range(draw.choice([0, 3, 90, 2_000]))) for i in range(60)} | {60: LONG, 61: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ["edits", "leaves", "e", "put"]})
    trees = common.materialize(token_counts.build_trees(docs, path, P.PATTERN), "trees")
    texts = {i: t or "" for i, t in texts.items()}
    for _ in range(2):
        edits = [(i, n, draw.randrange(50), draw.choice([0, 1, 30]), "".join(draw.choice(letters) for _ in range(draw.choice([0, 2, 40])))) for i in range(0, 62, 2) for n in range(3)]
        for i, _, at, gone, put in edits:
            at = min(at, len(texts[i]))
            texts[i] = texts[i][:at] + put + texts[i][at + gone :]
        table = spark.createDataFrame([*edits, (99, 0, 0, 0, "none"), (None, 0, 0, 0, "none")], "doc_id bigint, edit_no int, offset int, removed int, put string")
        trees = common.materialize(token_counts.apply_edits(trees, table, path, P.PATTERN), "trees")
        got = {r.doc_id: r for r in trees.collect()}
        assert {i: r.text for i, r in got.items()} == texts
        assert {i: r.n_tokens for i, r in got.items()} == {i: len(enc.encode_ordinary(t)) for i, t in texts.items()}
        assert all(sum(r.leaf_tokens) == r.n_tokens and sum(map(sum, r.leaves)) == len(r.text) for r in got.values())
    assert token_counts.apply_edits(trees.limit(0), table, path, P.PATTERN).count() == 0


def test_token_counts_of_repeated_rows_and_clashing_columns(spark):
    import public_tokenizers as P

    schema = "doc_id bigint, text string, edits array<struct<offset:int,removed:int,put:string>>"
    df = spark.createDataFrame([(1, "same text", [(0, 0, "x")])] * 2 + [(1, "other", None)], schema).withColumns({c: F.lit("y") for c in ["n_tokens", "leaves", "recounted_chars"]})
    got = sorted((r.doc_id, r.n_chars_edited) for r in token_counts.count_edited(df, P.path(token_counts.VOCABULARY), P.PATTERN).collect())
    assert got == [(1, 5), (1, 10), (1, 10)]


def test_quality_of_tied_and_repeated_labels(spark):
    df = spark.createDataFrame([(i, f"word {i % 3}") for i in range(60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, q) for i in range(60) for q in (0, 1)], "doc_id bigint, quality int")
    got = quality_gam.classify(df, quality_gam.train(df, labels)).collect()
    assert {r.predicted for r in got} == {0}  # of labels that differ the lowest holds


def test_large_ids_beside_nulls_stay_whole(spark):
    import public_tokenizers as P

    big = 2**62 + 1
    df = spark.createDataFrame([(big, "a b", "http://h/"), (None, "a b", None)], "doc_id bigint, text string, url string")
    found = [
        sentencepiece_codec.encode(df, sentencepiece_codec.default_model()),
        token_counts.build_trees(df, P.path(token_counts.VOCABULARY), P.PATTERN),
        html_extract.extract(df, "doc_id", "url", "text").withColumnRenamed("page_id", "doc_id"),
        ngram_join.ngram_components(df),
    ]
    assert all({r.doc_id for r in f.collect()} == {big, None} and dict(f.dtypes)["doc_id"] == "bigint" for f in found)


def test_sharding_of_null_ids_and_copies(spark):
    n = 6_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),  # a third has no id ...
        F.when(F.col("id") % 6 == 0, "one text").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"),  # ... half of them with one text
        F.lit("only").alias("source"),
    )
    rows = df.select("doc_id", F.octet_length("text").alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"), "source")
    counted = sharding._counted(rows)
    assert counted.count() == n and counted.distinct().count() == n and counted.where("size = 8").agg(F.max("copy")).first()[0] == n // 6 - 1
    drawn = counted.select(F.floor(F.conv(F.substring(F.md5(F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in counted.columns))), 1, 8), 16, 10).cast("double") / 2**32 * (n // 2)).alias("bucket"))
    assert drawn.groupBy("bucket").count().agg(F.max("count")).first()[0] < 12  # two rows a bucket are expected
    got = sharding.shard(df, bucket_rows=2).collect()
    assert len(got) == n and {r.shard: 0 for r in got}.keys() == set(range(8))
    for k in range(8):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(n // 8))
