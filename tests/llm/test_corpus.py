"""Sharding, near-duplicates, token counts, mixing, decontamination and the pipeline."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from arrears_mart.llm import components, mixing, phrase_index, sharding, simhash, token_counts
from arrears_mart.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, source string, size long, shard string, key string, fp string, n_words int, start int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "x", "k", "f", 2, 3) for i, t, s in rows], DOCS)


def texts_of(spark, name="documents"):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").select("doc_id" if name == "documents" else "item_id", "text").collect()]


# ---- components and near-duplicates --------------------------------------------------------------------------


def roots(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(5)
    links = {
        "chain": [(i, i + 1) for i in rng.sample(range(60), 60)],
        "star": [(99, i) for i in range(40)] + [(-3, 7), (7, -3), (7, 7)],
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(50)],
        "none": [],
    }[shape]
    table = spark.createDataFrame([*links, (None, 1)], "a long, b long")
    if not spark.sparkContext.getCheckpointDir():
        pytest.skip("no checkpoint folder")
    found = {r.node: r.root for r in components.components(table).collect()}
    assert found == {x: r for x, r in roots([p for p in links if p[0] != p[1]]).items()}


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_of_odd_texts():
    for text in (None, "", " \t", "A", "É b C d", "a b c d e f\ng h", "x " * 3000, "a b c d " * 400):
        assert simhash.simhash(text) % (1 << 64) == plain_fingerprint(text)


def classes(fingerprints, distance=4):
    links = [(a, b) for a, b in itertools.combinations(fingerprints, 2) if (a ^ b).bit_count() <= distance]
    return roots(links)


@pytest.mark.parametrize("crowded", [64, 2])
def test_links_against_all_pairs(spark, crowded):
    rng = random.Random(11)
    base = [rng.getrandbits(64) for _ in range(12)]
    values = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(8))) for b in base for _ in range(25)}
    values |= {0, 1, (1 << 64) - 1, 1 << 63, 0xF, 0x1F, sum(1 << k for k in (0, 1, 22, 23, 43))}
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    table = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    found = {r.node: r.root for r in simhash.linked_fingerprints(table, crowded=crowded).collect()}
    want = classes(sorted(values))
    assert {frozenset(g) for g in _groups(found)} == {frozenset(signed[v] for v in g) for g in _groups(want)}


def _groups(root_of):
    groups = defaultdict(set)
    for x, r in root_of.items():
        groups[r].add(x)
    return groups.values()


def test_near_duplicates_of_the_test_table(spark):
    rows = texts_of(spark)
    prints = {i: plain_fingerprint(t) for i, t in rows}
    root = classes(sorted(set(prints.values())))
    least = defaultdict(lambda: 10**9)
    for i, f in prints.items():
        least[root.get(f, f)] = min(least[root.get(f, f)], i)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash"](spark, FOLDER).collect()}
    assert found == {i: (f"{f:016x}", least[root.get(f, f)]) for i, f in prints.items()}


def test_one_document_of_each_class_stays(spark):
    rows = [(5, "a b c d e", "s"), (2, "A b c d e", "t"), (2, "A b c d e", "t"), (None, "q r s t", None), (None, "q r s t", None), (7, None, "s"), (9, "", "s"), (8, "other words here now", "s")]
    kept = simhash.keep_one(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "q r s t"), (2, "A b c d e"), (7, ""), (8, "other words here now")]
    assert simhash.keep_one(docs(spark, rows).limit(0)).count() == 0


# ---- sharding ------------------------------------------------------------------------------------------------


def test_splitters_meet_their_goals(spark):
    rng = np.random.default_rng(3)
    rows = [(int(a), int(b), int(s)) for a, b, s in zip(rng.integers(-(2**63), 2**63 - 1, 3000), rng.integers(-(2**63), 2**63 - 1, 3000), rng.integers(1, 50, 3000))]
    rows += [(77, int(b), 40) for b in rng.integers(-(2**63), 2**63 - 1, 1500)]  # a third under one first key
    table = spark.createDataFrame(rows, "_k1 long, _k2 long, size long")
    total = sum(r[2] for r in rows)
    goals = [total * i / 20 for i in range(1, 20)]
    ordered = sorted((((a + 2**63) << 64) + b + 2**63, s) for a, b, s in rows)
    for goal, s in zip(goals, sharding.find_splitters(table, goals, [total / 2000] * 19)):
        below = [x for k, x in ordered if k < s.value]
        assert (sum(below), len(below)) == (s.bytes_below, s.rows_below)
        assert abs(s.bytes_below - goal) <= max(total / 2000, 25)


@pytest.mark.parametrize("part_bytes", [1 << 28, 2000])
def test_shards_are_near_equal_and_gapless(spark, part_bytes):
    rng = random.Random(9)
    rows = [(i, "w" * rng.randrange(200), "s") for i in range(600)] + [(1000 + i, "the same copy", "s") for i in range(300)]
    rows += [(None, None, None), (None, None, None), (3, "", "s")]
    found = sharding.shard_documents(docs(spark, rows), shards=7, part_bytes=part_bytes).collect()
    assert len(found) == len(rows)
    groups = defaultdict(list)
    for r in found:
        groups[r.shard].append(r)
        assert r["size"] == len((r.text or "").encode()) + 16
        assert r.text_crc32 == (None if r.text is None else zlib.crc32(r.text.encode()))
        assert (r.law, r.grown_shard, r.key) == ("bytes", None, "k")
    assert set(groups) == set(range(7))
    sizes = [sum(r["size"] for r in g) for g in groups.values()]
    assert max(sizes) - min(sizes) <= 2 * (216 + 0.01 * sum(sizes) / 7)
    assert all(sorted(r.slot for r in g) == list(range(len(g))) for g in groups.values())


def test_shards_of_few_or_no_rows(spark):
    assert sharding.shard_documents(docs(spark, [(1, "a", "s")]).limit(0)).count() == 0
    assert [(r.slot, 0 <= r.shard < 40) for r in sharding.shard_documents(docs(spark, [(1, "a", "s")])).collect()] == [(0, True)]


# ---- token counts --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("common", [0, 3, 1 << 18])
def test_token_counts_against_whole_texts(spark, common):
    whole = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    odd = ["", None, " ", "  ", "   ", " a", "a ", "a  ", "  a  b ", "a\nb", "▁a", "a▁ b", "a ▁b", "<s> a</s>", "é ﬁ  ﬁ", "a\x00 b", "日本 語 ", "x" * 5000, "ab " * 5000]
    rows = [(i, t, "s") for i, t in enumerate(odd)] + [(3, "  ", "s"), (None, "q q", None), (None, "q q", None)]
    found = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs(spark, rows), MODEL, common=common).collect())
    assert found == Counter((i, len((t or "").encode()), len(whole.encode(t or ""))) for i, t, _ in rows)


def test_token_counts_of_the_test_table(spark):
    whole = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = {r.doc_id: (r.n_tokens, r.over_limit) for r in QUERIES["op6_token_counts"](spark, FOLDER).collect()}
    counts = {i: len(whole.encode(t)) for i, t in texts_of(spark)}
    assert found == {i: (n, n > 4096) for i, n in counts.items()}
    assert token_counts.count_tokens(docs(spark, [(1, "a", "s")]).limit(0), MODEL).count() == 0


# ---- mixing --------------------------------------------------------------------------------------------------


def test_seats_go_to_the_highest_quotients(spark):
    rng = random.Random(2)
    rows = [(g, u, float(rng.randrange(0, 900)), 37) for g in range(6) for u in range(9)] + [(9, 0, 0.0, 0)]
    dealt = mixing.apportion(spark.createDataFrame(rows, "g int, u int, size double, seats long"), ["g"], ["u"], "size", "seats")
    found = {(r.g, r.u): r.quota for r in dealt.collect()}
    for g in range(6):
        won = Counter()
        for _ in range(37):
            won[max(((s / (2 * won[u] + 1), -u) for h, u, s, _ in rows if h == g and s))[1] * -1] += 1
        assert {u: found[g, u] for u in range(9)} == {u: won[u] for u in range(9)}


def filled(sizes, weights):
    target, total = dict.fromkeys(sizes, 0.0), sum(sizes.values())
    open_ = dict(weights)
    while True:
        level = (total - sum(3 * sizes[s] for s in sizes if s not in open_)) / (sum(open_.values()) or 1)
        over = [s for s in open_ if open_[s] * level > 3 * sizes[s]]
        if not over:
            return {s: open_[s] * level if s in open_ else 3.0 * sizes[s] for s in sizes}
        for s in over:
            del open_[s]


def test_mix_meets_targets_and_repeats(spark):
    rng = random.Random(6)
    rows = [(i, " ".join("w" * rng.randrange(1, 90)), rng.choice(["a", "a", "a", "b", "c", "z", None])) for i in range(900)]
    rows += [(900 + i, "x y z", "tiny") for i in range(3)] + [(None, "p q", "a"), (None, "p q", "a"), (7, None, "b"), (8, "", "empty")]
    sized = docs(spark, rows).withColumn("size", mixing.token_size(F.col("text")))
    found = mixing.mix(sized).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.mix(sized.repartition(3)).collect())) if all(r.doc_id is not None and r.source for r in found) else True
    assert len(found) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in found:
        assert 0 <= r.taken <= 3 * r["size"]
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = filled(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    for r in found:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    for s in order:
        assert abs(taken[s] - want[s]) <= 0.03 * want[s] + 64
    copies = Counter(r.doc_id for r in mixing.mixed_documents(docs(spark, rows)).collect())
    assert set(copies) <= {r.doc_id for r in found if r.taken or r.doc_id is None}
    assert mixing.mix(sized.limit(0)).count() == 0


# ---- decontamination -----------------------------------------------------------------------------------------


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered) if w]


def plain_hits(rows, items):
    for i, text in rows:
        w, hit, found = terms(text), set(), set()
        for name, item in items:
            t = terms(item)
            for s in range(max(1, len(t) - 9)) if t else ():
                run = t[s : s + 10]
                for k in range(len(w) - len(run) + 1):
                    if w[k : k + len(run)] == run:
                        hit |= set(range(k, k + len(run)))
                        found.add(name)
        names = sorted(str(n) for n in found if n is not None)
        yield i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)


def test_hits_against_brute_force(spark):
    long = " ".join(f"t{i % 13}" for i in range(40))
    items = [(1, "One two THREE four"), (2, long), (3, "é-É x"), (4, None), (5, "..."), (10, "one"), (None, "null id words"), (2, "two again")]
    rows = [
        (1, "zero one two three four five"), (2, f"{long} and {long}"), (3, "É x é É x"), (4, None), (5, ""), (6, " ".join(long.split()[3:14])),
        (7, " ".join(long.split()[:9])), (8, "null id words"), (9, "a a a " * 3000 + "one"), (1, "zero one two three four five"), (None, "one"), (11, "One-two.three FOUR"),
    ]
    tests = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, size int")
    found = phrase_index.decontaminate(docs(spark, [(*r, "s") for r in rows]), tests)
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in found.collect())
    assert got == Counter(plain_hits(rows, items))
    kept = phrase_index.without_contaminated(docs(spark, [(*r, "s") for r in rows]), tests)
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 7]
    assert phrase_index.decontaminate(docs(spark, []), tests).count() == 0
    assert {r.n_hit for r in phrase_index.decontaminate(docs(spark, [(*rows[0], "s")]), tests.limit(0)).collect()} == {0}


def test_proximity_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(60))) for i in range(12)]
    items = [(1, "a b c"), (2, "h g"), (3, "a a b")]
    tests = spark.createDataFrame(items, "item_id long, text string")
    windows = phrase_index.stage_table(phrase_index.test_windows(tests, "item_id", "text", 10), "w")
    vocabulary = phrase_index.vocabulary_of(windows)
    index = phrase_index.build_index(docs(spark, [(*r, "s") for r in rows]), vocabulary)
    places = windows.join(vocabulary, "term").select("window", "size", "offset", "term_id")
    names = {r.window: r["items"][0] for r in windows.select("window", "items").distinct().collect()}
    found = {(r.doc_id, r.start, names[r.window]) for r in phrase_index.find_proximity(index, places, 1).collect()}
    counts = Counter(c for _, t in rows for c in t.split())
    ids = {r.term: r.term_id for r in vocabulary.collect()}
    want = set()
    for name, item in items:
        t = item.split()
        offset = min(range(len(t)), key=lambda k: (counts[t[k]], ids[t[k]], k))
        for i, text in rows:
            w = text.split()
            for p in (p for p, c in enumerate(w) if c == t[offset]):
                low, high = max(0, p - offset - 1), p - offset + len(t)
                if set(t) <= set(w[low : high + 1]):
                    want.add((i, p - offset, name))
    assert found == want


# ---- pipeline ------------------------------------------------------------------------------------------------


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline as P

    assert [name for name, _ in P.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    names = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    kept = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = kept.count()
    for name, stage in P.STAGES[:4]:
        kept = phrase_index.stage_table(stage(spark, kept, FOLDER), f"test-{name}")
        assert kept.columns == names
        if name != "mixing":
            now = kept.count()
            assert 0 < now <= before
            before = now
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert not any(h[-1] for h in plain_hits(dict(rows).items(), texts_of(spark, "benchmark")))
    prints = [plain_fingerprint(t) for t in dict(rows).values()]
    assert not any((a ^ b).bit_count() <= 4 for a, b in itertools.combinations(prints, 2))
    placed = P.assign_shards(spark, kept, FOLDER)
    assert placed.count() == len(rows) and {"shard", "slot"} <= set(placed.columns)
    assert P.assign_shards(spark, kept.limit(0), FOLDER).count() == 0
