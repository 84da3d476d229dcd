from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from apptlake.llm.components import connected
from apptlake.llm.jaccard_join import (
    Partition,
    Rule,
    _across,
    _likely,
    _open,
    parities,
    similarity_classes,
)
from apptlake.llm.shingles import exact_shingles, shingle_sets

SF_DIR = "/root/testdata/sf0.001"


def brute(rows, rule):
    """Size, smallest reachable id and smallest id with the same set of every document."""
    sets = {key: exact_shingles(text or "", rule.width) for key, text in rows}
    root = {key: key for key in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having = defaultdict(list)
    for key, own in sets.items():
        for shingle in own:
            having[shingle].append(key)
    for key, own in sets.items():
        common = Counter(other for shingle in own for other in having[shingle] if other < key)
        for other, n in common.items():
            if 100 * n >= rule.percent * (len(own) + len(sets[other]) - n):
                a, b = find(key), find(other)
                root[max(a, b)] = min(a, b)
    classes = defaultdict(list)
    for key, own in sets.items():
        classes[own if own else key].append(key)
    same = {key: min(keys) for keys in classes.values() for key in keys}
    return {key: (len(own), find(key), same[key]) for key, own in sets.items()}


def found(docs, rule):
    rows = similarity_classes(docs, rule).collect()
    return {r.doc_id: (r.n_shingles, r.component_id, r.class_id) for r in rows}


def families(seed):
    """Originals of several lengths with copies from nearly equal to quite different."""
    rng, rows = random.Random(seed), []
    words = [f"w{n}" for n in range(2000)]
    for length, copies, share in ((150, 150, 0.06), (60, 60, 0.05), (12, 60, 0.1), (20, 60, 0.08), (300, 30, 0.04), (5, 30, 0.2)):
        original = [rng.choice(words) for _ in range(length)]
        for _ in range(copies):
            part = rng.random() * share * 2
            text = [rng.choice(words) if rng.random() < part else w for w in original]
            rows.append(" ".join(text[: rng.randrange(int(length * 0.85), length + 1)]))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("rule", "seed"), [
    (Rule(3, 90, paired=64, paired_each=2), 1),
    (Rule(5, 80, paired=64, paired_each=2), 2),
    (Rule(2, 70, paired=16, paired_each=1, rounds=2), 3),
])
def test_components_of_large_families_are_exact(spark, rule, seed):
    rows = families(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs, rule) == brute(rows, rule)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs, Rule(3, 90)) == brute(rows, Rule(3, 90))


def test_similar_sets_share_a_key_on_which_they_rely():
    """The pigeonhole itself: similar sets meet in the larger one's band, in more segments than
    the smaller one can pass over."""
    rng, rule = random.Random(5), Rule(1, 80)
    partition, similar = Partition(rule), 0
    for _ in range(400):
        tokens = [f"t{k}" for k in range(rng.randrange(4, 200))]
        other = tokens[rng.randrange(0, len(tokens) // 5 + 1) :]
        other += [f"new{k}" for k in range(rng.randrange(0, len(tokens) // 8 + 1))]
        sets, _ = shingle_sets([" ".join(tokens).encode(), " ".join(other).encode()], 1)
        a, b = sorted(sets, key=len)
        common = len(set(a.tolist()) & set(b.tolist()))
        if 100 * common < rule.percent * (len(a) + len(b) - common):
            continue
        similar += 1
        mine, theirs = ({band: (set(k.tolist()), n) for band, k, n in partition.keys(s)} for s in (a, b))
        band = min(theirs)  # the band of the larger set's own size comes first
        assert band in mine
        own, needed = mine[band]
        shared = own & theirs[band][0]
        assert shared and (not needed or len(own) - len(shared) < needed)
    assert similar > 100


def test_parities_never_tell_similar_sets_apart(spark):
    rng, rows = random.Random(8), []
    rule = Rule(1, 80)
    for n in range(400):
        tokens = [f"t{k}" for k in range(rng.choice([1, 2, 5, 30, 33, 60, 64, 66, 300]))]
        cut = rng.randrange(0, len(tokens) // 3 + 1)
        other = tokens[cut:] + [f"new{k}" for k in range(rng.randrange(0, len(tokens) // 4 + 1))]
        rows += [(2 * n, " ".join(tokens)), (2 * n + 1, " ".join(other))]
    sets, _ = shingle_sets([text.encode() for _, text in rows], 1)
    kind = "_doc long, _size long, _parities array<long>"
    sketches = spark.createDataFrame([(k, len(s), parities(s).tolist()) for k, s in enumerate(sets)], kind)
    pairs = spark.createDataFrame([(2 * n, 2 * n + 1) for n in range(400)] + [(0, 2 * n) for n in range(1, 400)], "_a long, _b long")
    likely = {tuple(r) for r in _likely(pairs, sketches, rule).collect()}
    own = [set(s.tolist()) for s in sets]
    similar = {(a, b) for a, b in map(tuple, pairs.collect()) if 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b])}
    assert similar <= likely and 100 < len(similar) and len(likely) < 1.3 * len(similar)


def test_words_that_break_polynomial_hashes_stay_apart(spark):
    # The Thue-Morse word and its complement: equal under any polynomial modulo 2**64.
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(1 << 12))
    other = word.translate({97: "b", 98: "a"})
    rows = [(1, word), (2, other), (3, word), (4, f"{word} x y"), (5, f"{other} x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for rule in (Rule(3, 90), Rule(1, 20)):
        assert found(docs, rule) == brute(rows, rule)


def test_families_with_a_single_round(spark):
    rows = families(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rule = Rule(3, 90, paired=4, paired_each=1, rounds=1)
    assert found(docs, rule) == brute(rows, rule)


@pytest.mark.parametrize("block", [2, 512])
def test_pairs_across_components_are_all_and_only_those(spark, monkeypatch, block):
    monkeypatch.setattr("apptlake.llm.jaccard_join.BLOCK", block)
    rng = random.Random(9)
    rows = list({(key, doc): (key, doc, 0, rng.random() < 0.6) for key in range(12) for doc in rng.choices(range(40), k=25)}.values())
    # Two documents in three are in the component of 0, some in that of 1, the rest alone.
    roots = {d: 0 if d % 3 else 1 for d in range(2, 40) if d % 3 or d % 2}
    buckets = spark.createDataFrame(rows, "_key long, _doc long, _score long, _chosen boolean")
    found = _open(buckets, spark.createDataFrame(sorted(roots.items()), "_node long, _root long"))
    want, per_key = set(), Counter()
    for key, x, _, chosen in rows:
        for other, y, _, _ in rows:
            if key == other and chosen and roots.get(x, x) != roots.get(y, y):
                want.add((max(x, y), min(x, y)))
                per_key[key] += 1
    assert {tuple(r) for r in _across(found).collect()} == want
    members = Counter(key for key, *_ in rows)
    got = {r._key: (r._members, r._pairs) for r in found.collect()}
    assert got == {key: (members[key], n) for key, n in per_key.items()}


@pytest.mark.parametrize("seed", [5, 6])
def test_families_whose_buckets_are_all_narrowed(spark, seed):
    rows = families(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rule = Rule(3, 85, paired=4, paired_each=1, rounds=3)
    assert found(docs, rule) == brute(rows, rule)


def test_odd_rows(spark, odd, nothing):
    rows = similarity_classes(odd, Rule(3, 90)).collect()
    component = {2: 1, 10: 9}
    want = [
        (r.doc_id, len(exact_shingles(r.text or "", 3)), component.get(r.doc_id, r.doc_id))
        for r in odd.select("doc_id", "text").collect()
    ]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert similarity_classes(nothing).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(200, 300)]
    star = [(7, k) for k in range(50, 90)]
    links = spark.createDataFrame([*chain, *star, (400, 400)], "_a long, _b long")
    roots = {r._node: r._root for r in connected(links).collect()}
    assert roots == {**{k: 200 for k in range(201, 301)}, **{k: 7 for k in range(50, 90)}}
    assert connected(links.limit(0)).collect() == []
