"""Packing, spelling variants and the prefix trie against brute force, the public tokenizer, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from landstat.llm import packing, spelling, trie

SCHEMA = "doc_id long, text string, offset string, n string"  # offset, n: names that operators use


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "o", "n") for i, t in zip(ids or range(len(texts)), texts)], SCHEMA)


# 11. packing


@pytest.fixture(scope="module")
def content():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        return f.read()


def test_parts_are_encoded_as_whole_texts(content):
    rng, encoder = random.Random(3), packing.Encoder(content)
    signs = [*" \n\t  ab'sé日1-.,!²½×÷—…ʼ", "\x85", "\xa0", " ", "᠎", "\x1c", "​", "　", "́", "<|endoftext|>", "don't", "x" * 90]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(5_000)]
    whole = Tokenizer.from_buffer(content)
    whole.encode_special_tokens = True
    for text, coded in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(coded, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def check_packed(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def test_pack_whole_table(spark, sf, content):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack(packing.pieces(docs, content)).collect()
    whole = Tokenizer.from_buffer(content)
    whole.encode_special_tokens = True
    want = {}
    for r in docs.collect():
        ids = [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r["doc_id"], k] = (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), ids[a:b])
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"], r["token_ids"]) for r in rows} == want and len(rows) == len(want)
    n = check_packed(rows, 2048)
    assert n <= -(-sum(r["length"] for r in rows) // 2048) + 1
    whole = packing.sequences(packing.pack(packing.pieces(docs, content))).collect()
    assert len(whole) == n and sum(len(r["token_ids"]) for r in whole) == sum(r["length"] for r in rows)


@pytest.mark.parametrize("seed", range(8))
def test_runs_fill_bins(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([7, 12, 30, 100]))
    lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 300))).tolist() if seed % 2 else np.clip(rng.geometric(4 / capacity, 400), 1, capacity).tolist()
    counts = Counter(lengths)
    runs = packing.runs(counts, capacity)
    rows = []
    for length, n in counts.items():
        own = [r for r in runs if r[0] == length]
        assert [r[1] for r in own][0] == 0
        for rank in range(n):
            _, first, each, base, offset = max((r for r in own if r[1] <= rank), key=lambda r: r[1])
            row, turn = divmod(rank - first, each)
            rows.append({"sequence_id": base + row, "offset": offset + turn * length, "length": length})
    n = check_packed(rows, capacity)
    # no packing takes fewer than the best pairing of large items, found here by brute force, or than the volume
    large, pairs = sorted(x for x in lengths if 3 * x > capacity), 0
    i, j = 0, len(large) - 1
    while i < j:
        if large[i] + large[j] <= capacity:
            pairs, i = pairs + 1, i + 1
        j -= 1
    least = max(len(large) - pairs, -(-sum(lengths) // capacity))
    assert least <= n <= 1.1 * least + 1


def test_pack_odd_rows(spark, content):
    texts = [None, "", "", "x " * 5_000, "same text", "same text", "日本語 " * 900, " " * 4_000]
    docs = frame(spark, texts, [None, 1, 1, 2, 3, 3, 4, 5])
    rows = packing.pack(packing.pieces(docs, content)).collect()
    check_packed(rows, 2048)
    assert Counter(r["doc_id"] for r in rows if r["doc_id"] in (None, 1, 3)) == {None: 1, 1: 2, 3: 2}
    assert packing.pack(packing.pieces(docs.limit(0), content)).count() == 0
    items = spark.range(30).select(F.lit(5).alias("length"), F.col("id").alias("place"), F.lit("x").alias("sequence_id"))
    assert check_packed(packing.pack(items, 10).collect(), 10) == 15
    with pytest.raises(ValueError):
        packing.pack(items, 4).count()


# 12. spelling


def brute_words(texts, ids, slip, shortest, least):
    n = Counter()
    for i, text in zip(ids, texts):
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in word)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if slip and h % slip == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= shortest:
                n[word] += 1
    return {w: k for w, k in n.items() if k >= least}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(n):
    near = {w: [v for v in n if v != w and one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else 0) for w in n)


def told(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


@pytest.mark.parametrize(("sample", "cell"), [(50_000, 400), (60, 10), (0, 10)])
def test_spelling_variants(spark, sample, cell):
    rng = random.Random(5)
    n = {}
    for _ in range(60):
        word, k = "".join(rng.choice("abcé") for _ in range(rng.randint(6, 9))), rng.randint(5, 50_000)
        for _ in range(8):
            n.setdefault(word, k)
            at, k = rng.randrange(len(word) + 1), max(5, k // rng.choice([2, 5, 30]))
            word = word[:at] + rng.choice(["", "a", "é"]) + word[at + rng.randint(0, 1) :]
    n |= {w: 7 for w in ("x" * 700, "x" * 699, "x" * 350 + "y" + "x" * 349, "abcdef", "abcdfe", "fedcba", "Ünderü", "ünderü")}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert told(spelling.spelling_variants(df, sample=sample, cell=cell)) == brute_variants(n)


def test_spelling_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.collect()
    n = brute_words([r["text"] for r in rows], [r["doc_id"] for r in rows], 199, 6, 5)
    words = spelling.count_words(docs, slip=199)
    assert {r["word"]: r["n"] for r in words.collect()} == n
    assert told(spelling.spelling_variants(words)) == brute_variants(n)


def test_spelling_odd_rows(spark):
    texts = [None, "", "12 !!", "Colour colour COLOUR color Color×÷", "ÀÉÜß àéüß", "z" * 40_000] * 9
    ids = [None, 1, 1, 2, 3, 4] * 9
    docs = frame(spark, texts, ids)
    n = brute_words(texts, ids, 2, 4, 5)
    words = spelling.count_words(docs, 4, 5, slip=2)
    assert {r["word"]: r["n"] for r in words.collect()} == n
    assert told(spelling.spelling_variants(words)) == brute_variants(n)
    assert spelling.spelling_variants(words.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(words, ratio=1)


# 13. prefix trie


def brute_rebuilt(rows):
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            held[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    held = {c: [x[3:] for x in sorted(t)] for c, t in held.items()}
    out = {}
    for c, own in held.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = held.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, some in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(some) - 1) * words
    return sorted(
        (
            min(some),
            len(k),
            min(members[k[:-1]]) if k else -1,
            len(some),
            children[k],
            leaves[k],
            saved[k],
            hashlib.sha256(",".join(map(str, sorted(c for c in some if len(convs[c]) == len(k)))).encode()).hexdigest(),
        )
        for k, some in members.items()
    )


def nodes(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == names and all(t == ("string" if c == "ends_sha256" else "bigint") for c, t in df.dtypes)
    return sorted(tuple(-1 if r[c] is None else r[c] for c in names) for r in df.collect())


TURNS = "conv_id long, turn long, role string, text string, words string, n long"


def test_trie_of_conversations(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert nodes(trie.op13_prefix_trie(spark, sf)) == brute_trie(brute_rebuilt(rows))


@pytest.mark.parametrize("width", [None, 8, 256])
def test_trie_of_shared_prefixes(spark, width, monkeypatch):
    """Hot prefixes, copies, prefixes of others, long conversations in several stretches, ties, nulls and repeated rows."""
    monkeypatch.setattr(trie, "STRETCH", 4)
    monkeypatch.setattr(trie, "IDS", 3)
    monkeypatch.setattr(trie, "SLICE", 8)
    rng = random.Random(7)
    rows = []
    for c in rng.sample(range(400), 90):
        for t in range(rng.choice([0, 1, 2, 3, 5, 6, 17]) + (c % 20 != 0)):
            text = rng.choice(["hot one", "hot two  words", None, "", f"own {rng.random()}"]) if t > 1 else "You are\thelpful"
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "user", None]), text))
    rows += [(401, 0, "user", "x")] * 3 + [(402, None, None, None), (None, 0, "user", "lost"), (500, 3, "a", "b c"), (500, 3, "b", "a c")]
    convs = brute_rebuilt(rows)
    assert any(not t for t in convs.values())
    turns = trie.turns_of(spark.createDataFrame([(*r, "w", 1) for r in rows], TURNS))
    assert nodes(trie.prefix_trie(*trie.rebuilt(turns), width=width)) == brute_trie(convs)


def test_trie_of_plain_conversations(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "a"), (3, 0, "u", "a"), (3, 1, "u", "c")]
    turns = trie.plain(trie.turns_of(spark.createDataFrame([(*r, "w", 1) for r in rows], TURNS)))
    convs = {c: [(r[2], r[3]) for r in rows if r[0] == c] for c in (1, 2, 3)}
    assert nodes(trie.prefix_trie(turns, turns.select("conv_id", "n").distinct())) == brute_trie(convs)
    none = trie.turns_of(spark.createDataFrame([], TURNS))
    assert nodes(trie.prefix_trie(*trie.rebuilt(none))) == []


def test_screening_emits_tails_locally(spark, sf):
    """Nearly every singleton is told from its own rows."""
    turns, _ = trie.rebuilt(trie.turns_of(spark.read.parquet(f"{sf}/conversations.parquet")))
    prefix = trie.checkpointed(trie.prefixes(turns))
    single = prefix.groupBy("depth", "a", "b").count().filter("count = 1").count()
    tails = trie.screened(prefix).filter("tail > 0").count()
    assert 0.95 * single <= tails <= single
