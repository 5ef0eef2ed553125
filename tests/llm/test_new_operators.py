"""SimHash, the Merkle manifest and centroid clustering against brute force, with the awkward cases."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import values
from tallyweave.llm import centroids, merkle, simhash

rng = random.Random(11)
WORDS = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(400)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _tree string, fp string, component long"


def words(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def near(text, edits):
    own = text.split()
    for _ in range(edits):
        own[rng.randrange(len(own))] = rng.choice(WORDS)
    return " ".join(own)


LONG = words(40_000)
BASE = words(300)
TEXTS = [None, "", " \t\n", "one two", "One TWO", "Ä ä ß", BASE, BASE, BASE.upper(), *[near(BASE, rng.randint(1, 6)) for _ in range(60)],
         *[words(rng.randint(1, 60)) for _ in range(40)], LONG, near(LONG, 3), "line\nby\nline", "x" * 100_000]


def rows():
    out = [(i + 1, t) for i, t in enumerate(TEXTS)] + [(3, BASE), (7, BASE), (7, BASE), (None, "one two"), (None, words(20)), (None, None)]
    rng.shuffle(out)
    return [(i, t, None if n % 7 == 0 else "en", None if n % 5 == 0 else f"s{n % 3}" if n % 11 else "Ä", None if n % 4 == 0 else n, "own", "own", n)
            for n, (i, t) in enumerate(out)]


ROWS = rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).cache()


def plain_fingerprint(text):
    own = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    if not own:
        return 0
    shingles = [b" ".join(own[i:i + 4]) for i in range(max(1, len(own) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    distinct = sorted(set(prints))
    leader = {f: f for f in distinct}

    def find(f):
        while leader[f] != f:
            f = leader[f]
        return f

    for i, f in enumerate(distinct):
        for g in distinct[:i]:
            if (f ^ g).bit_count() <= radius:
                leader[find(f)] = find(g)
    return {f: find(f) for f in distinct}


def test_simhash_against_brute_force(docs):
    made = {t: plain_fingerprint(t) for _, t, *_ in ROWS}
    group = plain_components(list(made.values()), 4)
    least = defaultdict(list)
    for i, t, *_ in ROWS:
        if i is not None:
            least[group[made[t]]].append(i)
    expected = [(i, f"{made[t]:016x}", min(least[group[made[t]]], default=None)) for i, t, *_ in ROWS]
    assert values(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == sorted(expected, key=repr)
    assert max(Counter(x[2] for x in expected).values()) > 10


def test_fingerprints_are_spark_s_own_hashes(spark):
    text = words(4)
    signed = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert simhash.fingerprint(text.encode()) == signed % (1 << 64)  # one shingle


@pytest.mark.parametrize("hot", [simhash.HOT, 40])
@pytest.mark.parametrize("key_rows", [simhash.KEY_ROWS, 1])
def test_bit_sliced_links_connect_what_brute_force_connects(spark, monkeypatch, hot, key_rows):
    monkeypatch.setattr(simhash, "KEY_ROWS", key_rows)
    own = random.Random(3)
    prints = [own.getrandbits(64) for _ in range(40)]
    for center in prints[:6]:
        prints += [center ^ sum(1 << b for b in own.sample(range(64), own.randint(1, 6))) for _ in range(60)]
    prints = sorted(set(prints) | {0, (1 << 64) - 1, 1 << 63, 31, 15})
    nodes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in prints], "fp long").repartition(4)
    links = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.near_links(nodes, 4, hot).collect()]
    expected = plain_components(prints, 4)
    assert all(expected[a] == expected[b] for a, b in links)
    leader = {f: f for f in prints}

    def find(f):
        while leader[f] != f:
            f = leader[f]
        return f

    for a, b in links:
        leader[find(a)] = find(b)
    assert len({find(f) for f in prints}) == len(set(expected.values()))
    assert len(links) <= len(simhash.tables_for(len(prints), 4)) * len(prints) * (1 if hot == simhash.HOT else 4)  # never all pairs


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_distances_are_counted_and_abandoned_exactly(radius):
    own = np.random.default_rng(radius)
    fps = own.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2)
    fps[100:150] = fps[0] ^ (np.uint64(1) << own.integers(0, 64, 50, dtype=np.uint64)) ^ (np.uint64(1) << own.integers(0, 64, 50, dtype=np.uint64))
    fps[150:] = fps[1] ^ own.integers(0, 1 << 10, 50, dtype=np.uint64)
    probe, word = np.repeat(np.arange(200), 4), np.tile(np.arange(4), 200)
    lanes = np.where(word == 3, np.uint64(0xFF), np.uint64((1 << 64) - 1))
    a, b = simhash.within(simhash.bit_planes(fps), fps, probe, word, lanes, radius)
    expected = {(i, j) for i in range(200) for j in range(200) if int(fps[i] ^ fps[j]).bit_count() <= radius}
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(expected)


@pytest.mark.parametrize("n", [1, 5000, 10**7, 10**11])
def test_tables_keep_every_choice_of_blocks(n):
    masks = simhash.tables_for(n, 4)
    own = random.Random(n)
    for _ in range(300):
        flipped = sum(1 << b for b in own.sample(range(64), 4))
        assert any(not mask & flipped for mask in masks)
    assert n >> min(m.bit_count() for m in masks) <= 2 * simhash.KEY_ROWS


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """Root and, for each leaf, the runs above it: (siblings before, siblings behind)."""
    levels, paths = [nodes], []
    while len(levels[-1]) > 1:
        levels.append([H(levels[-1][k:k + 3]) for k in range(0, len(levels[-1]), 3)])
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            start = i - i % 3
            path.append((level[start:i], level[i + 1:start + 3]))
            i //= 3
        paths.append(path)
    return levels[-1][0], paths


def spelled(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def plain_manifest(rows, claim):
    trees = defaultdict(list)
    for doc_id, text, lang, source, n_chars, *_ in rows:
        leaf = H([spelled(x) for x in (doc_id, source, lang, n_chars, text)])
        claimed = H([spelled(x) for x in (doc_id, source, lang, n_chars, claim(text))])
        trees[source].append(((doc_id is not None, doc_id or 0, leaf), doc_id, leaf, claimed))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for name in names:
        trees[name].sort()
        made[name] = plain_tree([x[2] for x in trees[name]])
    root, over = plain_tree([made[name][0] for name in names])
    out = []
    for name, above in zip(names, over):
        subroot, paths = made[name]
        for (_, doc_id, leaf, claimed), path in zip(trees[name], paths):
            node = claimed
            for left, right in path + above:
                node = H([*left, node, *right])
            out.append((doc_id, leaf, subroot, root, H([d for left, right in path + above for d in left + right]), node, node == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def without_lines(text):
    return text and text.replace("\n", "")


def test_manifest_against_brute_force(docs):
    proved = merkle.proofs(docs, F.replace("text", F.lit("\n"), F.lit("")))
    assert values(proved, *COLUMNS) == plain_manifest(ROWS, without_lines)
    assert {row["verified"] for row in proved.select("verified").distinct().collect()} == {True, False}


def test_manifest_of_a_hot_source_and_many_sources(spark):
    """Trees of several tiers, over documents as well as over sources."""
    many = [(i, f"t\n{i}" if i % 3 else "t", "en", "hot" if i < 1500 else f"s{i}", i, "", "", i) for i in range(2100)]
    proved = merkle.proofs(spark.createDataFrame(many, SCHEMA).repartition(4), F.replace("text", F.lit("\n"), F.lit("")))
    assert values(proved, *COLUMNS) == plain_manifest(many, without_lines)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 9, 10, 26, 27, 28, 80, 81, 200, 243])
def test_positions_are_where_the_builder_appended(n):
    leaves = [hashlib.sha256(str(i).encode()).hexdigest().encode() for i in range(n)]
    for levels in (merkle.levels_over(n), merkle.HEIGHT):
        log = merkle.append_log(leaves, levels)
        nodes, at = leaves, merkle.positions(n, levels)
        for level in range(levels + 1):
            assert [log[k] for k in at[level]] == nodes
            nodes = [merkle.joined_hash(nodes[k:k + 3]) for k in range(0, len(nodes), 3)]
        assert len(log) == sum(map(len, at))


def plain_clusters(rows, k, rounds, dim):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [p for _, p in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(p, c)), i) for i, c in enumerate(cents)) for _, p in kept]

    for _ in range(rounds):
        near = assign()
        for i in range(len(cents)):
            own = [p for (_, p), (_, c) in zip(kept, near) if c == i]
            if own:
                cents[i] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    total = Counter()
    for d, c in near:
        total[c] += d
    return sorted(((i, c, d, total[c], sum(total.values()), cents[c]) for (i, _), (d, c) in zip(kept, near)), key=repr)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string, point int")


def test_clusters_against_brute_force(spark):
    own = np.random.default_rng(4)
    rows = [(i, own.normal(size=6).tolist(), "x", 1) for i in range(200)]
    rows += [(i, rows[0][1], "x", 1) for i in range(200, 260)]  # one vector many times
    rows += [(5, rows[5][1], "x", 1), (6, own.normal(size=6).tolist(), "x", 1), (None, own.normal(size=6).tolist(), "x", 1), (300, None, "x", 1),
             (301, [], "x", 1), (302, [1.0] * 5, "x", 1), (303, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x", 1), (304, [float("nan")] * 6, "x", 1),
             (305, [float("inf")] * 6, "x", 1), (306, [-0.0005] * 6, "x", 1), (307, [90_000.0] * 6, "x", 1)]
    found = centroids.clusters(vectors(spark, rows).repartition(3), k=8, rounds=4, dim=6)
    got = sorted(((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], list(r["centroid"])) for r in found.collect()), key=repr)
    assert got == plain_clusters(rows, 8, 4, 6)


def test_few_equal_and_huge_vectors(spark):
    rows = [(1, [1.0, 2.0], "x", 1), (2, [1.0, 2.0], "x", 1), (3, [9.0, -3.0], "x", 1)]
    found = centroids.clusters(vectors(spark, rows), k=8, rounds=3, dim=2)
    assert values(found, "vec_id", "cluster", "distance") == sorted((r[0], r[1], r[2]) for r in plain_clusters(rows, 8, 3, 2))
    huge = [(i, [(-1.0) ** i * 1e300] * 64, "x", 1) for i in range(9)]
    assert {r["distance"] for r in centroids.clusters(vectors(spark, huge), k=2, rounds=2, dim=64).collect()} == {0}


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(nothing).collect() == []
    assert merkle.proofs(nothing).collect() == []
    assert centroids.clusters(vectors(spark, [])).collect() == []
    unusable = [(1, None, "x", 1), (2, [1.0], "x", 1)]
    assert centroids.clusters(vectors(spark, unusable)).collect() == []
