"""Every stage of the pipeline against a brute-force version, each on what the stage before kept."""

import hashlib
import re

import pytest
import sentencepiece

import corpus_pipeline as cp
from earshot.llm import quality_gam
from earshot.llm.common import materialize, table
from earshot.llm.sentencepiece_codec import default_model
from tests.conftest import SF


def by_quality(rows, spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_gam.train(docs, table(spark, SF, "labels", "doc_id", "quality"))
    return {i: t for i, t in rows.items() if model.score(quality_gam.features([t or ""]))[0] >= 0.3}


def by_lines(rows, spark):
    seen, out = set(), {}
    for i in sorted(rows):
        if rows[i] is None:
            out[i] = None
            continue
        lines = rows[i].split("\n")
        gone = set()
        for k in range(len(lines) - 2):
            window = tuple(lines[k : k + 3])
            if all(not line.strip() for line in window):
                continue
            if window in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(window)
        out[i] = "\n".join(line for k, line in enumerate(lines) if k not in gone)
    return out


def _shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").encode().lower().decode())
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def by_near_copies(rows, spark):
    ids, sets = sorted(rows), {i: _shingles(t, 5) for i, t in rows.items()}
    low = {i: i for i in ids}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((root(a), root(b)))
                low[y] = x
    return {i: rows[i] for i in ids if root(i) == i}


def _grams(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def by_benchmark(rows, spark):
    items = [g for r in table(spark, SF, "benchmark", "item_id", "text").collect() if (g := _grams(r.text))]
    return {i: t for i, t in rows.items() if not any(len(g & held) * 100 >= 80 * len(g) for held in [_grams(t)] for g in items)}


def by_tokens(rows, spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=default_model())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = {i: sp.encode(t or "") for i, t in rows.items()}
    return {i: (len(v), sha(",".join(map(str, v))), sha(sp.decode(v))) for i, v in ids.items()}


BRUTE = [by_quality, by_lines, by_near_copies, by_benchmark, by_tokens]


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    assert [n for n, _ in cp.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "sentencepiece"]
    for (name, stage), brute in zip(cp.STAGES, BRUTE, strict=True):
        docs = materialize(stage(spark, docs, SF), "brute")
        got = docs.collect()
        if name == "sentencepiece":
            found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got}
        else:
            found = {r.doc_id: r.text for r in got}
            assert all(r.n_chars == len(r.text or "") for r in got)
        want = brute(rows, spark)
        assert len(found) == len(got) and found == want, name
        rows = want
    assert sorted(map(tuple, cp.run(spark, SF).select("doc_id", "ids_sha256").collect())) == sorted((i, v[1]) for i, v in rows.items())


@pytest.mark.parametrize("kept", [0, 1])
def test_run_survives_tiny_tables(spark, tmp_path, kept):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(kept).write.parquet(f"file://{tmp_path}/{name}.parquet")
    assert cp.run(spark, f"file://{tmp_path}").count() <= kept
