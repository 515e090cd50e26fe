"""Each operator of the subpackage against brute force, an exact round trip or held-out accuracy, and on nulls and odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from landstat.llm import bpe, decontaminate, fingerprint, htmltext, licenses, linededup, lmscore, quality, simhash, toxicity

SCHEMA = "doc_id long, text string, lang string, words string"  # words: a name that operators use inside


def frame(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    return spark.createDataFrame([(i, t, "en", "w") for i, t in zip(ids, texts)], SCHEMA)


ODD = [None, "", " ", "one", "one", "one two", "x" * 30_000, "a b c\n\nd e\n" * 400, "日本語 \u0001 \U0001f600 é"]


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


# 1. near-duplicates


def brute_components(ids, fps, most=2):
    fps = np.array(fps, dtype=np.uint64)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= most):
            root[find(int(j))] = find(i)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


@pytest.mark.parametrize("chunk", [4096, 4])
def test_simhash_components(spark, chunk):
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 2**64, 6, dtype=np.uint64)
    fps = {int(c) for c in rng.integers(0, 2**64, 200, dtype=np.uint64)}
    for c in centres:
        for _ in range(60):
            f = c
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                f ^= np.uint64(1) << np.uint64(b)
            fps.add(int(f))
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2, chunk)).collect()}
    assert [roots.get(f, f) for f in signed] == brute_components(signed, fps)


def test_simhash_nodes_of_many_chunks(spark):
    rng = np.random.default_rng(1)
    low = rng.choice(2**20, 900, replace=False).astype(np.uint64)
    fps = sorted({*(int(x) for x in low), *(int(x) ^ 1 << 9 for x in low[:100])})  # all in one top node, 240 chunks of four
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2, 4)).collect()}
    assert [roots.get(f, f) for f in fps] == brute_components(fps, fps)


def test_simhash_groups_of_many_partitions(spark):
    """Members of a group come from several partitions, among so many other fingerprints that the join before the groups is planned anew."""
    from landstat.llm.common import checkpointed

    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2**64, 300, dtype=np.uint64)
    near = {int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centres for a, b in rng.integers(0, 64, (6, 2))}
    fps = sorted(near | {int(x) for x in rng.integers(0, 2**64, 20_000, dtype=np.uint64)})
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    rows = checkpointed(spark.createDataFrame([(f,) for f in signed], "fp long").repartition(8, F.xxhash64("fp")))
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(rows)).collect()}
    assert [roots.get(f, f) for f in signed] == brute_components(signed, fps)


def test_simhash_fingerprints_and_odd_rows(spark, sf):
    import xxhash

    def plain(text):
        w = text.encode().lower().split()
        shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) > len(shingles)) if shingles else 0

    got = simhash.near_duplicates(docs(spark, sf)).toPandas()
    texts = dict(docs(spark, sf).select("doc_id", "text").collect())
    assert all(int(r.fingerprint, 16) == plain(texts[r.doc_id]) for r in got.itertuples())
    assert got.component_id.tolist() == brute_components(got.doc_id.tolist(), [int(x, 16) for x in got.fingerprint])
    odd = simhash.near_duplicates(frame(spark, [*ODD, "lone null"], [*range(len(ODD)), None])).collect()
    by = {r["doc_id"]: r for r in odd}
    assert len(odd) == len(ODD) + 1 and by[1]["component_id"] == by[2]["component_id"] == 0 and by[4]["component_id"] == 3
    assert by[0]["fingerprint"] == "0" * 16 and by[None]["component_id"] is None
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


# 2. cross-entropy difference


def test_lm_scores_against_plain_counts(spark):
    rng = random.Random(0)
    texts = [words(rng, 30) + " the cat the cat" if i % 2 else "a dog a dog " + words(rng, 20) for i in range(20)] + [None, ""]
    targets = {1, 3, 5}
    size = 12
    got = {r["doc_id"]: r for r in lmscore.cross_entropy_difference(frame(spark, texts), spark.createDataFrame([(i,) for i in targets], "doc_id long"), size).collect()}
    counts = {}
    for t in texts:
        for w in (t or "").lower().split():
            counts[w] = counts.get(w, 0) + 1
    ids = {w: i + 1 for i, w in enumerate(sorted(counts, key=lambda w: (-counts[w], w))[:size])}
    start, width = size + 1, size + 2
    pair = np.zeros((2, width, width))
    seqs = [[start, *(ids.get(w, 0) for w in (t or "").lower().split())] for t in texts]
    for i, s in enumerate(seqs):
        for a, b in zip(s, s[1:]):
            pair[1, a, b] += 1
            pair[0, a, b] += i in targets
    uni = (pair.sum(1) + 1) / (pair.sum(1) + 1).sum(1, keepdims=True)
    p = (pair + lmscore.MASS * uni[:, None, :]) / (pair.sum(2, keepdims=True) + lmscore.MASS)
    for i, s in enumerate(seqs):
        want = np.mean([np.log(p[1, a, b] / p[0, a, b]) for a, b in zip(s, s[1:])]) if len(s) > 1 else 0.0
        assert got[i]["score"] == pytest.approx(want, abs=1e-5) and got[i]["n_tokens"] == len(s) - 1


def test_lm_scores_know_every_word_and_do_not_depend_on_blocks(spark):
    rng = random.Random(10)
    seldom = [f"w{i}" for i in range(5_000)]  # more words than any fixed vocabulary of the operator has held
    texts = [" ".join(seldom[i : i + 50]) for i in range(0, 5_000, 50)] + ["the cat"] * 5 + [words(rng, 40), None, ""]
    targets = {0, 2, 98, 101}
    seqs = [["<", *(t or "").split()] for t in texts]
    names = sorted({w for s in seqs for w in s[1:]})
    pair, single, first = ([{}, {}] for _ in range(3))
    for i, s in enumerate(seqs):
        for a, b in zip(s, s[1:]):
            for m in [1] + [0] * (i in targets):
                for table, k in ((pair, (a, b)), (single, b), (first, a)):
                    table[m][k] = table[m].get(k, 0) + 1
    totals = [sum(x.values()) + len(names) + 2 for x in single]
    p = lambda m, a, b: (pair[m].get((a, b), 0) + lmscore.MASS * (single[m].get(b, 0) + 1) / totals[m]) / (first[m].get(a, 0) + lmscore.MASS)
    marks = spark.createDataFrame([(i,) for i in targets] * 2 + [(None,)], "doc_id long")
    for chars, direct in ((lmscore.BLOCK, 512), (200, 512), (200, 1)):  # one block, many that ask themselves, many in parties
        got = {r["doc_id"]: r for r in lmscore.cross_entropy_difference(frame(spark, texts), marks, block_chars=chars, most_direct=direct).collect()}
        assert len(got) == len(texts)
        for i, s in enumerate(seqs):
            want = np.mean([np.log(p(1, a, b) / p(0, a, b)) for a, b in zip(s, s[1:])]) if len(s) > 1 else 0.0
            assert got[i]["score"] == pytest.approx(want, abs=1e-9) and got[i]["n_tokens"] == len(s) - 1 and got[i]["words"] == "w"


def test_lm_parties_send_fewer_parts_and_cut_the_same_key_space(monkeypatch, spark):
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(-(2**63), 2**63 - 1, 5_000))
    whole = lmscore.edges_of(keys, 7 * 5)
    for b, (i, j) in enumerate(zip(lmscore.edges_of(keys, 7), lmscore.edges_of(keys, 7)[1:])):
        assert (lmscore.edges_of(keys[i:j], 35, b * 5, 5) + i == whole[b * 5 : b * 5 + 6]).all()
    seen = []
    monkeypatch.setattr(lmscore, "checkpointed", lambda df: seen.append(df.count()) or df)
    d = frame(spark, [" ".join(f"a{i}b{j}" for j in range(9)) for i in range(400)])
    none = spark.createDataFrame([], "doc_id long")
    for chars in (200, 50):
        lmscore.cross_entropy_difference(d, none, block_chars=chars, most_direct=1)
    chars = d.agg(F.sum(F.length("text"))).first()[0]
    for n, blocks in zip(seen, (chars // 200 + 1, chars // 50 + 1)):
        assert n <= blocks * (blocks**0.5 + 1)  # and not blocks ** 2


# 3. licenses


def test_licenses_tell_versions_apart_and_find_long_notices(spark):
    mit = licenses.TEMPLATES[4][1]
    texts = ["x\nLicensed under CC BY-NC 4.0.\ny", "Licensed under CC BY 4.0.", "This work is licensed under the GNU General Public License, version 2.", mit.replace("to deal in", "to trade in"), "My driving license is old.", *ODD]
    got = [[(b["license"], b["confirmed"]) for b in r["blocks"]] for r in licenses.license_blocks(frame(spark, texts)).orderBy("doc_id").collect()]
    assert got[:4] == [[("CC-BY-NC-4.0", True)], [("CC-BY-4.0", True)], [("GPL-2.0", True)], [("MIT", True)]]
    assert not any(sure for _, sure in got[4]) and not any(got[5:])


BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
THIRD = "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
@pytest.mark.parametrize("width", [40, 70, 80])
def test_licenses_wrapped_in_comments(mark, width):
    import textwrap

    scanner = licenses.Scanner()
    wrapped = lambda t: "\n".join(mark + line for part in t.split("\n") for line in (textwrap.wrap(part, width) or [""]))
    found = lambda t: {m.license for b in scanner.blocks(wrapped(t)) for m in scanner.matches(b) if m.confirmed}
    for name, text in licenses.TEMPLATES:
        assert found(text) == {name}, text
        assert found(f"import this\n\n{text}\n\ndef main(): pass") == {name}, text
    assert found(BSD.format("")) == {"BSD", "BSD-2-Clause"}
    assert found(BSD.format(THIRD)) == {"BSD", "BSD-3-Clause"}


def test_licenses_that_are_denied():
    scanner = licenses.Scanner()
    found = lambda t: {m.license for b in scanner.blocks(t) for m in scanner.matches(b) if m.confirmed}
    assert found("This is not licensed under the MIT License.") == found("It was never released under the MIT License.") == set()
    assert found("Licensed under the MIT License.") == {"MIT"}


def test_licenses_every_template_in_prose_and_none_without(spark):
    rng = random.Random(14)
    texts = [f"{words(rng, 30)} {text} {words(rng, 30)}" for _, text in licenses.TEMPLATES] + [words(rng, 200), "under the Apache License 2.0 as of today", "He said the car was sold as is, with permission to use the garage."]
    rows = licenses.license_blocks(frame(spark, texts + texts[:1])).orderBy("doc_id").collect()
    got = [{b["license"] for b in r["blocks"] if b["confirmed"]} for r in rows]
    assert all(name in g for (name, _), g in zip(licenses.TEMPLATES, got)) and got[-1] == got[0]
    assert got[len(licenses.TEMPLATES) :][:3] == [set(), {"Apache-2.0"}, set()] and licenses.license_blocks(frame(spark, [])).count() == 0


def test_licenses_inside_long_lines(spark):
    rng = random.Random(11)
    notices = [("MIT", "Released under the MIT License."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."), ("MIT", licenses.TEMPLATES[4][1])]
    texts = [f"{words(rng, n)} {text} {words(rng, n)}" for n in (10, 40, 400) for _, text in notices]
    got = [[(b["license"], b["confirmed"]) for b in r["blocks"]] for r in licenses.license_blocks(frame(spark, texts)).orderBy("doc_id").collect()]
    assert got == [[(name, True)] for _ in range(3) for name, _ in notices]


def test_licenses_all_notices_of_a_block(spark):
    rng = random.Random(12)
    mit, apache, cc = "Licensed under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-SA 4.0."
    texts = [f"{mit}\n{apache}", f"{apache} {mit}", f"{words(rng, 60)} {cc} {words(rng, 30)} {mit} {apache} {words(rng, 60)}", f"{mit} {mit}", f"{mit}\n{licenses.TEMPLATES[4][1]}\n{cc}"]
    rows = licenses.license_blocks(frame(spark, texts)).orderBy("doc_id").collect()
    got = [sorted(b["license"] for b in r["blocks"] if b["confirmed"]) for r in rows]
    assert got == [["Apache-2.0", "MIT"], ["Apache-2.0", "MIT"], ["Apache-2.0", "CC-BY-SA-4.0", "MIT"], ["MIT", "MIT"], ["CC-BY-SA-4.0", "MIT", "MIT"]]
    assert all(not b["missing"] and not b["extra"] for r in rows for b in r["blocks"] if b["confirmed"]) and {b["number"] for b in rows[0]["blocks"]} == {0}


# 4. toxicity


def test_toxicity_separates_held_out_texts_and_bears_odd_rows(spark):
    rng = random.Random(1)
    texts = [words(rng, 40) + (" you idiot" if i % 4 == 0 else "") for i in range(400)]
    d = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity_scores(d.unionByName(frame(spark, ODD, [1000 + i for i in range(len(ODD))])), labels).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 1000]
    assert len(held) > 60 and np.mean([r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in toxicity.toxicity_scores(d.limit(3), labels.limit(0)).collect()} == {0.5}


def test_counterfactual_penalty_takes_weight_from_group_terms():
    rng = random.Random(2)
    texts, y = [], []
    for i in range(400):
        toxic = i % 2
        named = rng.random() < (0.8 if toxic else 0.1)
        texts.append(words(rng, 20) + (" muslim" if named else "") + (" idiot" if toxic and rng.random() < 0.9 else ""))
        y.append(float(toxic))
    neutral = ["the muslim baker " + words(rng, 10) for _ in range(20)]
    score = lambda penalty: toxicity.scorer(toxicity.fit(texts, np.array(y), 0.5, penalty=penalty))(neutral).mean()
    assert score(50.0) < score(0.0) - 0.05


def test_every_group_of_a_set_is_swapped_for_every_other():
    for of in toxicity.GROUPS:
        for i, terms in enumerate(of):
            got = {swap[t] for swap in toxicity.swaps(toxicity.GROUPS) for t in terms if t in swap}
            assert {t for j, other in enumerate(of) if j != i for t in other[: len(terms)]} <= got


def test_gaps_between_groups_shrink_on_held_out_texts_that_name_none(spark):
    # no text names a group, but toxic words share their beginning with terms of one
    rng = random.Random(6)
    texts = [words(rng, 30) + (" straggle blather" if i % 3 == 0 else "") for i in range(420)] + [None, ""]
    d = frame(spark, texts).withColumn("gap", F.lit("a")).withColumn("terms", F.lit(1))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(420)], "doc_id long, toxic int")
    gaps = lambda penalty: {r["terms"]: r for r in toxicity.group_gaps(d, labels, penalty=penalty).collect()}
    plain, fair = gaps(0.0), gaps(5.0)
    name = "gay, straight, lesbian, bisexual, queer, heterosexual, transgender"
    assert plain[name]["gap"] > 0.02 and fair[name]["gap"] < plain[name]["gap"] / 4
    held = sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in range(len(texts)))
    assert len(fair) == len(toxicity.GROUPS) and {r["n"] for r in fair.values()} == {held}
    scores = toxicity.toxicity_scores(d, labels).filter("held_out and doc_id < 420").collect()
    assert np.mean([r["predicted"] == int(r["doc_id"] % 3 == 0) for r in scores]) > 0.97
    assert {r["gap"] for r in toxicity.group_gaps(d, labels.limit(0)).collect()} == {0.0} and not toxicity.group_gaps(d.limit(0), labels).collect()


# 5. line dedup


def plain_line_dedup(texts):
    """Three-line dedup in plain Python, over texts in the order of their ids."""
    seen, out = set(), []
    for text in texts:
        lines = (text or "").splitlines(keepends=True) if "\r" not in (text or "") else (text or "").split("\n")
        lines = [x + "\n" for x in (text or "").split("\n")[:-1]] + [(text or "").split("\n")[-1]]
        full = [i for i, x in enumerate(lines) if x.encode().split()]
        gone = set()
        for a, b, c in zip(full, full[1:], full[2:]):
            window = tuple(b" ".join(lines[i].encode().split()) for i in (a, b, c))
            if window in seen:
                gone |= {a, b, c}
            seen.add(window)
        out.append(("".join(x for i, x in enumerate(lines) if i not in gone) if text is not None else None, len(gone)))
    return out


def lined(rng, n):
    """Texts of short and long lines, some of them runs of lines from a common stock."""
    stock = [words(rng, rng.choice([1, 2, 3, 5, 13, 16, 40])) for _ in range(30)]

    def part():
        k = rng.randint(0, 27)
        return stock[k : k + rng.randint(2, 5)] if rng.random() < 0.6 else [words(rng, rng.randint(1, 30)), ""]

    return ["\n".join(x for _ in range(rng.randint(1, 5)) for x in part()) for _ in range(n)]


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_whole_line_windows_against_plain_python(spark, sf, most):
    given = docs(spark, sf).orderBy("doc_id").collect()
    texts = [r["text"] for r in given] + lined(random.Random(20), 120) + ODD
    want = plain_line_dedup(texts)
    got = linededup.dedup_lines(frame(spark, texts), most_broadcast=most).orderBy("doc_id").collect()
    assert [(r["text"], r["n_removed"]) for r in got] == want and sum(n for _, n in want) > 200
    wrapped = linededup.dedup_lines(frame(spark, texts), longest=linededup.LONG, most_broadcast=most).orderBy("doc_id").collect()
    squeezed = lambda t: (t or "").split()
    for r, (plain, n) in zip(wrapped, want):  # wrapping only ever takes more away, in order
        rest = iter(squeezed(plain))
        assert all(w in rest for w in squeezed(r["text"])) and (r["n_removed"] >= n)


def test_window_of_short_and_long_lines_goes(spark):
    rng = random.Random(21)
    for _ in range(5):
        block = f"{words(rng, 2)}\n{words(rng, 15)}\n{words(rng, 2)}"
        rows = linededup.dedup_lines(frame(spark, [f"{words(rng, 9)}\n{block}\nend", f"{block}\n{words(rng, 8)}"]), longest=linededup.LONG).orderBy("doc_id").collect()
        assert block in rows[0]["text"] and not any(x in rows[1]["text"] for x in block.split("\n"))


def test_passages_go_from_all_but_the_first_and_clean_texts_stay(spark):
    rng = random.Random(3)
    passage = words(rng, 55)
    lines = "\n".join(words(rng, 20) for _ in range(3))
    texts = [f"{words(rng, 9)} {passage} {words(rng, 9)}", f"{words(rng, 20)} {passage}", words(rng, 200), f"{words(rng, 5)}\n{lines}\n{words(rng, 5)}", f"{lines}\n{words(rng, 5)}", *ODD]
    rows = linededup.dedup_lines(frame(spark, texts), longest=linededup.LONG, most_broadcast=0).orderBy("doc_id").collect()
    assert [r["n_removed"] > 0 for r in rows[:5]] == [False, True, False, False, True]
    assert passage not in rows[1]["text"] and lines not in rows[4]["text"] and rows[2]["text"] == texts[2]
    assert [r["text"] for r in rows[5:12]] == ODD[:7] and rows[0]["words"] == "w"
    assert linededup.dedup_lines(frame(spark, [])).count() == 0


# 6. decontamination


@pytest.mark.parametrize("most", [200_000, 1])
def test_contamination_against_brute_force(spark, most):
    import re

    rng = random.Random(4)
    items = [words(rng, 20), words(rng, 5), words(rng, 13), None, "", "short One!"]
    texts = [f"{words(rng, 30)} {items[0]} {words(rng, 30)}", items[0].upper(), f"{items[1]}, {words(rng, 300)}", "a " + items[2].replace(" ", ", "), words(rng, 50), "SHORT-one short one", *ODD]
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bench = spark.createDataFrame([(i * 7, t, 1) for i, t in enumerate(items)], "item_id long, text string, hits int")
    rows = {r["doc_id"]: r for r in decontaminate.contamination(frame(spark, texts), bench, most_windows=most).collect()}
    for i, t in enumerate(texts):
        w, hit, found = cut(t), set(), set()
        for k, item in enumerate(items):
            iw = cut(item)
            n = min(13, len(iw))
            wins = {tuple(iw[a : a + n]) for a in range(len(iw) - n + 1)} if n else set()
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in wins:
                    hit |= set(range(a, a + n))
                    found.add(str(k * 7))
        want = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
        assert tuple(rows[i][c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == want
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(frame(spark, texts), bench, most_windows=most).collect()}
    assert kept == {i for i, r in rows.items() if not r["contaminated"]}
    assert decontaminate.drop_contaminated(frame(spark, texts), bench.limit(0)).count() == len(texts)


def test_spans_are_taken_out(spark):
    bench = spark.createDataFrame([(1, "b c d")], "item_id long, text string")
    got = [r["text"] for r in decontaminate.remove_spans(frame(spark, ["A, B c; D e!", None, "x y"]), bench).orderBy("doc_id").collect()]
    assert got == ["A, e!", None, "x y"]


# 7. fingerprints


def test_fingerprints_against_sets_of_digests(spark):
    rng = random.Random(5)
    base = words(rng, 400)
    texts = [base, base[: len(base) * 9 // 10] + words(rng, 30), words(rng, 400), base, words(rng, 3), words(rng, 5000), words(rng, 40), *ODD]
    rows = {r["doc_id"]: r for r in fingerprint.edited_fingerprints(frame(spark, texts)).collect()}
    edited = []
    for i, t in enumerate(texts):
        t, after = t or "", texts[(i + 1) % len(texts)] or ""
        k = len(t) // 4
        edited.append(t[: len(t) - k] + after[:k])
        assert (rows[i]["n_chars"], rows[i]["edited_sha256"]) == (len(t), hashlib.sha256(edited[i].encode()).hexdigest())
    sets = [set(r["d"]) for r in frame(spark, [t or "" for t in texts] + edited).select("doc_id", fingerprint.digests(F.col("text")).alias("d")).orderBy("doc_id").collect()]
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for i in range(len(texts)):
        assert rows[i]["near_edited"] == pytest.approx(alike(sets[i], sets[len(texts) + i]), abs=1e-12)
        assert rows[i]["near_next"] == pytest.approx(alike(sets[i], sets[(i + 1) % len(texts)]), abs=1e-12)
    assert rows[0]["near_next"] > 0.5 > rows[1]["near_next"] and rows[0]["fingerprint"] == rows[3]["fingerprint"] != rows[2]["fingerprint"]
    assert fingerprint.edited_fingerprints(frame(spark, [])).count() == 0


def test_fingerprint_columns_against_sql(spark, sf):
    import duckdb

    want = duckdb.sql(f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id), '') AS z FROM '{sf}/documents.parquet')
        SELECT doc_id, n, sha256(substring(t, 1, n - n // 4) || substring(z, 1, n // 4)) FROM d""").fetchall()
    got = fingerprint.op7_fingerprints(spark, sf).select("doc_id", "n_chars", "edited_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_fingerprints_of_long_texts_see_small_edits_and_shared_passages(spark):
    rng = random.Random(13)
    long = words(rng, 6000).split()
    edited = [w + "x" if i % 1000 == 500 else w for i, w in enumerate(long)]
    passage = words(rng, 400)
    texts = [" ".join(long), " ".join(edited), f"{words(rng, 5000)} {passage} {words(rng, 500)}", f"{words(rng, 300)} {passage} {words(rng, 5000)}"]
    rows = fingerprint.edited_fingerprints(frame(spark, texts)).orderBy("doc_id").collect()
    assert 0.95 < rows[0]["near_next"] < 1 and rows[0]["near_edited"] > 0.5 and rows[2]["near_next"] > 0.02 and rows[1]["near_next"] < 0.01
    assert int(rows[0]["fingerprint"].split(";")[0]) > 500


def test_peeling_finds_the_very_digests_or_says_that_it_cannot(spark):
    rng = random.Random(6)
    common = [rng.getrandbits(63) for _ in range(30)]
    other = [rng.getrandbits(63) for _ in range(40)]
    few = [rng.getrandbits(63) for _ in range(4)]
    cases = [(common + few[:3], common + few[3:]), (common, common), ([], []), (common, other)]
    df = spark.createDataFrame([(i, a, b, 8) for i, (a, b) in enumerate(cases)], "i int, a array<long>, b array<long>, w int")
    small = fingerprint.peel(fingerprint.subtract(fingerprint.sketch("a", "w"), fingerprint.sketch("b", "w")), "w")
    out = df.select(F.expr(small).alias("p"), F.expr(fingerprint.larger("a", "b", "w")).alias("q"), F.expr(f"({fingerprint.folded(fingerprint.sketch('a', '64'), '64', '8')}) = ({fingerprint.sketch('a', '8')})").alias("same")).orderBy("i").collect()
    found = lambda x: {(y["k"], y["c"]) for y in x}
    assert found(out[0]["p"]) == {*((k, 1) for k in few[:3]), (few[3], -1)} and out[1]["p"] == [] and out[2]["p"] == [] and out[3]["p"] is None
    assert found(out[3]["q"]) == {(k, 1) for k in common} | {(k, -1) for k in other} and all(r["same"] for r in out)


def test_repeated_and_null_ids_have_a_next_document(spark):
    rows = fingerprint.edited_fingerprints(frame(spark, ["aaaa", "bbbb", "bbbc", "cccc"], [1, 2, 2, None])).collect()
    assert len(rows) == 4
    by = {(r["doc_id"], r["n_chars"]): r for r in rows}
    assert by[(None, 4)]["edited_sha256"] == hashlib.sha256(b"ccca").hexdigest() and by[(1, 4)]["edited_sha256"] == hashlib.sha256(b"aaab").hexdigest()


# 8. quality


def test_quality_on_held_out_rows(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rng = random.Random(7)
    good, bad = [words(rng, 60).capitalize() + "." for _ in range(150)], ["".join(w + "***" for w in words(rng, 1).split()) + " " + "!! ".join(words(rng, 40).upper().split()) for _ in range(150)]
    texts = [t for pair in zip(good, bad) for t in pair]
    marks = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(300)], labels.select("doc_id", "quality", "toxic").schema)
    rows = quality.quality_scores(frame(spark, texts).unionByName(frame(spark, ODD, [1000 + i for i in range(len(ODD))])), marks).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 1000]
    assert len(held) > 40 and np.mean([r["predicted"] == 1 - r["doc_id"] % 2 for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == 300 + len(ODD)


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    z = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < quality.sigmoid(z)).astype(float)
    assert quality.temperature(3 * z, y) == pytest.approx(3, rel=0.15)


# 9. HTML


def test_html_extraction_on_labelled_pages_it_was_not_trained_on():
    crf = htmltext.train(htmltext.labelled_pages())
    pages = htmltext.labelled_pages(6, seed=99)
    right = [a == b for blocks, want in pages for a, b in zip(crf.labels(blocks), want)]
    assert np.mean(right) > 0.99


def test_html_pages_of_other_layouts():
    crf = htmltext.train(htmltext.labelled_pages())
    p = "This is a paragraph of the story, with enough words to look like one."
    q = "Another one follows it, as long as the first, and it ends here."
    cases = {
        f"<html><body><nav><a href='/'>Home</a></nav><article class='post hidden-gem promo-series'><h1>A title</h1><p>{p}</p><p>{q}</p></article><footer>foot</footer></body></html>": f"A title\n{p}\n{q}",
        f"<html><body><main><p>{p}</p><div class='content-ad'><p>Buy our fine things now.</p></div><p>{q}</p></main></body></html>": f"{p}\n{q}",
        f"<html><body><article><p>{p}</p><form><label>Say it</label><textarea>type here</textarea><button>Send</button></form><textarea>typed text</textarea><p>{q}</p></article></body></html>": f"{p}\n{q}",
        f"<html><body><h2>Heading</h2><p>{p}</p><p>{q}</p><p>Short one.</p></body></html>": f"Heading\n{p}\n{q}\nShort one.",
        f"<html><body class='single has-sidebar'><header id='masthead' class='site-header'><p>Brand</p></header><main id='main' class='site-main'><article class='post-12 post hentry'><header class='entry-header'><h1 class='entry-title'>The title</h1></header><div class='entry-content'><p>{p}</p><p>{q}</p></div></article><div id='comments' class='comments-area'><ol class='comment-list'><li><p>I agree with all of it.</p></li></ol></div></main><aside class='widget-area'><section class='widget'><h2>Search</h2></section></aside><footer id='colophon'>Powered</footer></body></html>": f"The title\n{p}\n{q}",
    }
    for html, want in cases.items():
        assert htmltext.main_text(html, crf) == want


def test_html_long_repeated_and_no_pages(spark):
    long = "<article>" + "".join(f"<p>Paragraph {i} of a very long page that goes on and on.</p>" for i in range(20_000)) + "</article>"
    df = spark.createDataFrame([(1, "u", long), (1, "u", long), (2, "u", "<article><p>One.</p></article>")], "page_id long, url string, html string")
    rows = htmltext.extract(df).orderBy("page_id").collect()
    assert rows[0]["text"] == rows[1]["text"] and rows[0]["text"].count("\n") == 19_999 and htmltext.extract(df.limit(0)).count() == 0


def test_html_blocks_and_odd_pages(spark):
    pages = [
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href='/x'>Home</a></li></ul></nav><article><h1>A &amp;lt; B</h1><p>One\n  two&nbsp;<b>three</b>.<br><p>Four <i>f</i>ive &eacute;<script>var t='</p>';</script></article><div class='comments'><p>Nice post, I like it a lot.</p></div><footer>&copy; x</footer></body></html>",
        None, "", "<p>", "<!-- only --><script>x</script>",
    ]
    df = spark.createDataFrame([(i, f"u{i}", p, "keep") for i, p in enumerate(pages)], "page_id long, url string, html string, kind string")
    rows = htmltext.extract(df).orderBy("page_id").collect()
    assert rows[0]["text"] == "A &lt; B\nOne two three.\nFour five é" and [r["text"] for r in rows[1:]] == [""] * 4 and rows[0]["kind"] == "keep"


# 10. BPE


def test_bpe_equals_the_public_library_and_round_trips(spark, sf):
    import public_tokenizers as P
    import tiktoken

    content = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    ranks = bpe.RankTable(content)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})
    rng = random.Random(8)
    texts = [r["text"] for r in docs(spark, sf).limit(60).collect()] + ODD + ["".join(rng.choice("ab \n\té日'1!") for _ in range(rng.randint(1, 80))) for _ in range(300)] + ["ab" * 4000, " lead", "trail ", "<|endoftext|>"]
    d = frame(spark, texts)
    coded = bpe.decode(bpe.encode(d, content, P.PATTERN), content).orderBy("doc_id").collect()
    assert [list(r["token_ids"]) for r in coded] == [enc.encode_ordinary(t or "") for t in texts]
    assert [bytes(r["decoded"]) for r in coded] == [(t or "").encode() for t in texts]
    assert bpe.encode(frame(spark, []), content, P.PATTERN).count() == 0


def test_wide_sketches_peel_in_one_round_and_never_leave_digests_behind(spark, monkeypatch):
    from landstat.llm import fingerprint as fp

    monkeypatch.setattr(fp, "ROUNDS", 1)
    rows = spark.range(40).selectExpr("transform(sequence(1, 150), i -> xxhash64(id, i)) as a", "transform(sequence(101, 250), i -> xxhash64(id, i)) as b")
    peeled = lambda width: fp.peel(fp.summed(f"concat({fp.placed('a', str(width), '1', 'd')}, {fp.placed('b', str(width), '-1', 'd')})"), str(width))
    want = [(sorted(set(r["a"]) - set(r["b"])), sorted(set(r["b"]) - set(r["a"]))) for r in rows.collect()]
    for width, least in ((8192, 36), (512, 0), (64, 0)):  # one round is enough for nearly all, for some, for none
        got = rows.select(F.expr(peeled(width)).alias("out")).collect()
        found = [r["out"] and (sorted(x["k"] for x in r["out"] if x["c"] == 1), sorted(x["k"] for x in r["out"] if x["c"] == -1)) for r in got]
        assert all(f is None or f == w for f, w in zip(found, want)) and sum(f is not None for f in found) >= least
        assert width > 64 or set(found) == {None}
    assert fp.WIDE * 200 >= 4096


def test_first_table_of_a_wide_sketch_shows_all_digests_or_says_that_it_cannot(spark):
    from landstat.llm import fingerprint as fp

    rng = random.Random(17)
    some = lambda n: [rng.getrandbits(64) - (1 << 63) for _ in range(n)]
    common, left, right = some(60), some(80), some(50)
    cases = [(common + left, right + common), (common, common[::-1]), ([], []), ([], right), (left, [])]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cases)], "i int, a array<long>, b array<long>")
    shown = lambda width: F.expr(fp.first_table("a", "b", str(width)))
    rows = df.select(shown(1 << 21).alias("wide"), shown(16).alias("narrow"), F.expr(fp.roughly_apart("a", "b")).alias("rough")).collect()
    for (a, b), r in zip(cases, rows):
        want = {*((k, 1) for k in set(a) - set(b)), *((k, -1) for k in set(b) - set(a))}
        found = {(x["k"], x["c"]) for x in r["wide"]}
        assert found == want and len(r["wide"]) == len(want)
        assert r["narrow"] == [] if not want else r["narrow"] is None
        assert (r["rough"] == 0) == (not want)
    many = spark.range(1).selectExpr("transform(sequence(1, 200000), i -> xxhash64(i)) as a", "cast(array() as array<bigint>) as b")
    assert many.select(F.expr(fp.roughly_apart("a", "b"))).first()[0] >= 0  # counts do not overflow


def test_sketches_made_from_digests_are_the_sums_of_their_entries(spark):
    from landstat.llm import fingerprint as fp

    df = spark.range(0, 400, 23).selectExpr("transform(filter(sequence(0, id), i -> i > 0), i -> xxhash64(id, i)) as a")
    for width in ("4", "64", "4096"):
        assert all(r["same"] for r in df.select(F.expr(f"({fp.sketch('a', width)}) = ({fp.summed(fp.placed('a', width, '1', 'd'))})").alias("same")).collect())


def test_three_tables_of_a_larger_sketch_are_seldom_needed(spark, monkeypatch):
    from landstat.llm import fingerprint as fp

    rng = random.Random(19)
    texts = [words(rng, 300) for _ in range(60)]
    want = fp.edited_fingerprints(frame(spark, texts)).orderBy("doc_id").collect()
    monkeypatch.setattr(fp, "larger", lambda a, b, width: f"cast(null as {fp.FOUND})")
    got = fp.edited_fingerprints(frame(spark, texts)).orderBy("doc_id").collect()
    for name in ("near_edited", "near_next"):
        assert all(g[name] in (None, w[name]) for g, w in zip(got, want)) and sum(g[name] is not None for g in got) >= 50
