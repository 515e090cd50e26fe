"""The stages of the pipeline on the smallest tables, each against what it was given and against brute force; odd rows; no rows."""

import re

import corpus_pipeline as cp
import pytest

from landstat.llm import bpe, quality, simhash
from test_operators import ODD, brute_components


def staged(spark, docs, sf):
    """What each stage was given and what it returned."""
    out = []
    for _, stage in cp.STAGES:
        given = docs.toPandas()
        found = stage(spark, docs, sf)
        schema = found.schema
        docs = spark.createDataFrame(found.collect(), schema)
        out.append((given, docs.toPandas()))
    return out


def contaminated(text, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit = cut(text), set()
    for item in map(cut, items):
        n = min(13, len(item))
        windows = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_stages_against_brute_force(spark, sf):
    import public_tokenizers
    import tiktoken

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = staged(spark, docs, sf)
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination", "byte-level BPE"]
    assert all(found.columns.tolist() == docs.columns for _, found in stages[:-1])
    given, kept = stages[0]
    scores = quality.quality_scores(docs, spark.read.parquet(f"{sf}/labels.parquet")).toPandas()
    assert set(kept.doc_id) == set(scores[scores.predicted == 1].doc_id) and 0 < len(kept) < len(given)
    given, kept = stages[1]
    assert set(given.doc_id) == set(kept.doc_id) and (kept.n_chars == kept.text.str.len()).all() and kept.text.str.len().sum() < given.text.str.len().sum()
    given, kept = stages[2]
    given = given.sort_values("doc_id")
    roots = brute_components(given.doc_id.tolist(), [simhash.simhash(t) for t in given.text])
    assert sorted(kept.doc_id) == sorted(set(roots))
    given, kept = stages[3]
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert set(kept.doc_id) == {i for i, t in zip(given.doc_id, given.text) if not contaminated(t, items)}
    given, kept = stages[4]
    ranks = bpe.RankTable(bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))).ranks
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(zip(given.doc_id, given.text))
    assert all(list(r.token_ids) == enc.encode_ordinary(texts[r.doc_id]) for r in kept.itertuples()) and len(kept) == len(given)


def test_stages_bear_odd_rows_repeated_ids_and_no_rows(spark, sf):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, `row` int, words string"
    rows = [(i, t, None, "s", len(t or ""), "own", 1, None) for i, t in enumerate(ODD)] + [(3, "another text with an id that is taken", "en", None, 37, None, None, "w"), (None, "no id", None, None, None, None, None, None)]
    stages = staged(spark, spark.createDataFrame(rows, schema), sf)
    for given, found in stages[:-1]:
        assert found.columns.tolist() == given.columns.tolist() and len(found) <= len(given)
        assert set(map(str, found.doc_id)) <= set(map(str, given.doc_id))
    assert len(stages[-1][0]) == len(stages[-1][1])
    for _, found in staged(spark, spark.createDataFrame([], schema), sf):
        assert len(found) == 0


@pytest.mark.parametrize("kind", ["none", "one class"])
def test_classifiers_without_labels_and_with_one_class(spark, sf, kind):
    from landstat.llm import toxicity

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(40)
    labels = spark.read.parquet(f"{sf}/labels.parquet").limit(0) if kind == "none" else docs.selectExpr("doc_id", "1 as quality", "1 as toxic")
    for found in (quality.quality_scores(docs, labels), toxicity.toxicity_scores(docs, labels)):
        rows = found.collect()
        assert len(rows) == 40 and all(r["score"] == 0.5 if kind == "none" else 0.5 < r["score"] <= 1 for r in rows)
    assert quality.quality_scores(docs.limit(0), labels).count() == 0
