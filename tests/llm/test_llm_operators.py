"""The training-data operators against brute force, on small tables with all the awkward cases."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from conftest import values
from tallyweave.llm import chat, components, exact, jaccard, packing, pieces, sharding, shingles, suffix, topk, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, piece string, _id string, node int, _size string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
rng = random.Random(5)
WORDS = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(300)]


def words(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


BASE = words(90)
PASSAGE = words(25)


def near(text, edits):
    own = text.split()
    for _ in range(edits):
        own[rng.randrange(len(own))] = rng.choice(WORDS)
    return " ".join(own)


def corpus():
    texts = [None, "", "  ", "Zu und ÄÖ. \U0001d54f ▁", "one two", "One TWO", BASE, BASE.upper(), BASE, *[near(BASE, 1) for _ in range(12)],
             *[near(BASE, 3) for _ in range(5)], *[f"{words(20)} {PASSAGE} {words(15)}" for _ in range(6)],
             *[words(rng.randint(1, 40)) for _ in range(20)], " ".join([words(700), PASSAGE]), "ab" * 3000, "x" * 60, "y" * 49, "Ä" * 40, "é" * 40]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    rows += [(7, BASE), (7, BASE), (None, BASE), (None, words(30)), (4, "one two"), (1000, "ab" * 3000)]  # repeated ids, NULL ids
    rng.shuffle(rows)
    return rows


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "p", "own", 1, "big") for i, t in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_groups_against_brute_force(docs):
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[(t or "").translate(LOWER)].append(i)
    expected = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, sha = (max(known) if known else None), hashlib.sha256(text.encode()).hexdigest()
        stay = True
        for i in ids:
            expected.append((i, keep, len(ids), stay and i == keep, sha))
            stay = stay and i != keep
    assert values(exact.membership(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(expected, key=repr)


def test_exact_keeps_one_row_of_each_group_with_its_columns(docs):
    kept = exact.keep_one(docs)
    assert kept.columns == docs.columns
    assert {row._id for row in kept.collect()} == {"own"}
    assert Counter((r.text or "").translate(LOWER) for r in kept.collect()) == Counter({(t or "").translate(LOWER) for _, t in ROWS})


def test_packing_is_whole_gapless_and_tight(docs):
    capacity = 50
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    expected = Counter()
    for i, t in ROWS:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), capacity):
            own = np.array(ids[at:at + capacity], "<u4").tobytes()
            expected[(i, at // capacity, at, len(own) // 4, zlib.crc32(own))] += 1
    rows = packing.packed_documents(docs, path, capacity, with_ids=True).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in rows)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        assert [o for o, _ in sorted(own)] == list(np.cumsum([0] + [n for _, n in sorted(own)][:-1])) and sum(n for _, n in own) <= capacity
    assert len(bins) == len(plain_best_fit([r.length for r in rows], capacity))


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, room in enumerate(rooms) if room >= n]
        if fit:
            rooms[min(fit, key=rooms.__getitem__)] -= n
        else:
            rooms.append(capacity - n)
    return rooms


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_plan_equals_plain_best_fit(seed):
    own = random.Random(seed)
    lengths = [own.randint(1, 64) for _ in range(own.randint(0, 300))] + [17] * own.randint(0, 50)
    plan = packing.best_fit_decreasing(Counter(lengths), 64)
    used = Counter()
    for length, _, count, first, each, _ in plan.tolist():
        for k in range(count):
            used[first + k // each] += length
    assert sorted(64 - n for n in used.values()) == sorted(plain_best_fit(lengths, 64))


def test_special_tokens_and_odd_spaces_are_encoded_as_in_whole_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, encoder = Tokenizer.from_file(path), packing.WordEncoder(path, cached=3)
    for text in ["<|endoftext|> A<|ENDOFTEXT|>b", "don't Don T x\x1cy \x0bz", "ÉÅ 12,5 İstanbul", "a b c d e f a b c d"]:
        assert np.frombuffer(next(encoder.encode([text.encode()])), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "<|x Hello NASA.", "<|X HELLO <|endoftext|> Hello, <|ENDOFTEXT|>", "A\u0130.", "\u0130. a\u0130.. A\u0130", "\u0958. \u0958", "J\u030c. T\u0308 w\u030a, W\u0344",
    "\u00c4rger. \u00e4RGER, \u212a! e\u0301."])
def test_words_have_the_ids_that_the_tokenizer_gives_them(text):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    expected = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(next(packing.WordEncoder(path).encode([text.encode()])), "<u4").tolist() == expected


def test_every_letter_is_split_from_a_mark_behind_it():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    every = [f"{chr(c)}." for c in range(0x110000) if chr(c).isalpha()]
    expected = [found.ids for found in Tokenizer.from_file(path).encode_batch_fast(every, add_special_tokens=False)]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in packing.WordEncoder(path).encode([x.encode() for x in every])] == expected


class CountedTokenizer:
    """A tokenizer that counts the texts given to it."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode(self, text, **options):
        self.texts += 1
        return self.tokenizer.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_small_letters_of_latin_1_skip_the_normalizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = packing.WordEncoder(path)
    plain, encoder.tokenizer = encoder.tokenizer, CountedTokenizer(encoder.tokenizer)
    letters = [chr(c) for c in (*range(0x61, 0x7b), *range(0xdf, 0x100)) if c != 0xf7]
    texts = [f"{a}{b}t\u00e9&&& \u00e9{b}{a}&&&" for a in letters for b in letters]
    found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode([text.encode() for text in texts])]
    assert found == [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert encoder.tokenizer.texts == 1  # the marks


def test_texts_of_several_steps_have_the_ids_of_each(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(packing, "STEP_BYTES", 20, raising=False)
    texts = ["", " ", "\n a", "The the THE the.", "", "a\u00a0b \u0130x.. \u00c9t\u00e9", "x" * 50, "(the) the, \u4e2d\u6587. ...", "\t"]
    encoder = packing.WordEncoder(path, cached=2)
    expected = [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in texts * 3]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode([text.encode() for text in texts * 3])] == expected


def test_shards_are_even_and_slots_gapless(docs):
    rows = sharding.shard_documents(docs, 4, rows_per_task=5).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(ROWS)
    assert all(r._size == len((r.text or "").encode()) + 16 and r._id == "own" for r in rows)
    slots = defaultdict(list)
    sizes = Counter()
    for r in rows:
        slots[r._shard].append(r._slot)
        sizes[r._shard] += r._size
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r._size for r in rows)


def test_one_hot_text_is_split_over_shards(spark):
    hot = spark.createDataFrame([(i, "same text" if i % 3 else words(3)) for i in range(400)], "doc_id long, text string")
    sizes = Counter()
    for r in sharding.shard_documents(hot, 8).collect():
        sizes[r._shard] += r._size
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 80


@pytest.mark.parametrize("shards", [1, 2, 8])
def test_cells_of_a_hot_text_are_dealt_to_several_tasks(spark, shards):
    rows = [(i, "same text" if i % 3 else words(3)) for i in range(400)] + [(None, None), (3, ""), (5, "same text")]
    slots, moved, sizes = defaultdict(list), Counter(), Counter()
    for r in sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards, rows_per_task=10).collect():
        slots[r._shard].append(r._slot)
        sizes[r._shard] += r._size
        moved[r.doc_id, r.text] += 1
    assert moved == Counter(rows) and len(slots) == shards and all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= 100


def test_no_expression_of_the_borders_grows_with_the_rows(spark):
    plans = []
    for rows_per_task in (1000, 10):
        docs = spark.createDataFrame([(i, f"text {i}") for i in range(1000)], "doc_id long, text string")
        plans.append(sharding.shard_documents(docs, 4, rows_per_task=rows_per_task)._jdf.queryExecution().analyzed().toString().count("CASE WHEN"))
    assert plans[0] == plans[1]


def test_rows_that_repeat_id_and_text_are_split_over_shards(spark):
    rows = [(None, "same text")] * 200 + [(i, words(3)) for i in range(400)]
    hot = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sizes, slots, moved = Counter(), defaultdict(list), Counter()
    for r in sharding.shard_documents(hot, 8).collect():
        sizes[r._shard] += r._size
        slots[r._shard].append(r._slot)
        moved[r.doc_id, r.text] += 1
    assert moved == Counter(rows) and all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 80
    copies = spark.createDataFrame([(7, "x")] * 100, "doc_id long, text string")
    assert Counter(r._shard for r in sharding.shard_documents(copies, 10).collect()) == Counter({i: 10 for i in range(10)})


def shingle_set(text, n):
    own = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(own[i:i + n]) for i in range(len(own) - n + 1)) if len(own) >= n else frozenset([tuple(own)] if own else [])


@pytest.mark.parametrize("n, num, den", [(4, 85, 100), (5, 4, 5), (1, 1, 2)])
def test_jaccard_components_against_brute_force(docs, n, num, den):
    sets = [(i, shingle_set(t, n)) for i, t in ROWS]
    group = list(range(len(sets)))

    def find(x):
        return x if group[x] == x else find(group[x])

    for x, (_, a) in enumerate(sets):
        for y, (_, b) in enumerate(sets[:x]):
            if a and b and den * len(a & b) >= num * len(a | b):
                group[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    expected = [(i, len(s), least.get(find(x)) if s else i) for x, (i, s) in enumerate(sets)]
    assert values(jaccard.jaccard_components(docs, n, num, den), "doc_id", "n_shingles", "component_id") == sorted(expected, key=repr)


def test_near_copies_leave_row_by_row(spark):
    own = random.Random(9)
    texts = [" ".join(f"w{own.randrange(10**6)}" for _ in range(60)) for _ in range(5)]
    rows = [(1, texts[0]), (None, texts[0] + " end"), (None, texts[1]), (None, texts[2]), (None, None), (None, ""),  # NULL ids
            (5, texts[0] + " stop"), (5, texts[3]), (5, ""), (5, None), (6, texts[3] + " end"), (6, texts[4]), (6, texts[4])]  # repeated ids
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = [row for row in rows if row not in [(None, texts[0] + " end"), (5, texts[0] + " stop"), (6, texts[3] + " end")]]
    assert values(jaccard.one_per_component(frame), "doc_id", "text") == sorted(expected, key=repr)


def test_hot_shingles_meet_in_blocks(docs, monkeypatch):
    expected = values(jaccard.jaccard_components(docs, 4, 85, 100), "doc_id", "component_id")
    monkeypatch.setattr(jaccard, "HOT", 2)
    monkeypatch.setattr(jaccard, "STARS", 1)
    assert values(jaccard.jaccard_components(docs, 4, 85, 100), "doc_id", "component_id") == expected


@pytest.mark.parametrize("few, strip, salt_nodes", [(64, 512, 4096), (3, 16, 4096), (3, 7, 40)])
def test_links_around_a_hub_are_those_of_brute_force(spark, monkeypatch, few, strip, salt_nodes):
    for name, value in (("FEW", few), ("STRIP", strip), ("HUB_NODES", salt_nodes)):
        monkeypatch.setattr(jaccard, name, value)
    own = random.Random(8)
    hub = set(range(100))
    sets = [hub] + [hub - set(own.sample(range(100), own.randint(5, 25))) | {own.randrange(1000, 1040) for _ in range(own.randint(0, 25))} for _ in range(150)]
    sets += [set(s) ^ {own.randrange(2000, 9000)} for s in own.sample(sets, 60)]
    threshold = jaccard.Threshold(85, 100)
    rows = [(i, 0, 100, len(s & hub), len(s), np.array(sorted(s ^ hub), np.uint64).tobytes()) for i, s in enumerate(sets)]
    hubs = spark.createDataFrame(rows, "node long, hub long, hub_n long, shared long, n long, delta binary").repartition(3)
    early = spark.createDataFrame([(0, 0), (1, 0)], "node long, component long")
    links = [tuple(r) for r in jaccard.hub_links(hubs, early, threshold).collect()]

    def groups(edges):
        leader = list(range(len(sets)))

        def find(i):
            while leader[i] != i:
                i = leader[i]
            return i

        for a, b in edges:
            leader[find(a)] = find(b)
        return len({find(i) for i in range(len(sets))}), [find(i) for i in range(len(sets))]

    near = [(a, b) for a in range(len(sets)) for b in range(a) if threshold.holds(len(sets[a] & sets[b]), len(sets[a]), len(sets[b]))]
    n, label = groups([*near, (0, 1)])
    assert all(label[a] == label[b] for a, b in links) and groups([*links, (0, 1)])[0] == n < len(sets)
    assert len(links) < 4 * len(sets)


def test_shingles_are_counted_beyond_a_byte(spark):
    frame = spark.createDataFrame([(i, f"a b c d e {i}") for i in range(700)], "doc_id long, text string").coalesce(1)
    counts = jaccard.shingle_counts(jaccard.signatures(frame, 5, "doc_id", "text").cache())
    assert counts.max() >= 700 and 1399 <= counts.sum() <= 1400  # two shingles each, which share a cell at times


def test_shingle_hashes_count_distinct_shingles():
    texts = [(t or "") for _, t in ROWS]
    for n in (1, 4):
        assert [len(s) for s in shingles.shingle_sets([t.encode() for t in texts], n)] == [len(shingle_set(t, n)) for t in texts]


def test_shingles_of_many_texts_take_little_memory():
    own = random.Random(5)
    texts = [b" ".join(b"w%d" % own.randrange(10**5) for _ in range(300)) for _ in range(1000)]
    whole = [set(s.tolist()) for t in texts[:50] for s in shingles.shingle_sets([t], 5)]
    tracemalloc.start()
    try:
        found = [len(s) for s in shingles.shingle_sets(texts, 5)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 6 << 20  # with steps of 512 KB: 12 MB
    assert found[:50] == [len(s) for s in whole]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (100, 102)], "a long, b long")
    found = dict(values(components.components(edges), "node", "component"))
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def removed(rows, length):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for j in range(len(b) - length + 1):
            key = b[j:j + length]
            first[key] = min(first.get(key, (1, 0)), (i is None, i or 0))
    out = []
    for i, t in rows:
        b, gone = (t or "").encode(), set()
        for j in range(len(b) - length + 1):
            if first[b[j:j + length]] < (i is None, i or 0):
                gone.update(range(j, j + length))
        kept = bytes(x for j, x in enumerate(b) if j not in gone)
        out.append((i, len(b), len(gone), sum(j - 1 not in gone for j in gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [50, 20])
def test_repeats_are_removed_as_by_brute_force(docs, length):
    done = suffix.without_repeats(docs, length)
    assert values(done, "doc_id", "_n_bytes", "_n_removed", "_n_spans", "_kept_sha256") == removed(ROWS, length)
    assert set(docs.columns) < set(done.columns)


@pytest.mark.parametrize("length, gram", [(50, 20), (20, 20), (21, 20)])
def test_stretches_that_share_no_string_are_not_sorted(length, gram):
    own, spare = random.Random(length), length - gram
    anchors = [own.randbytes(gram) for _ in range(40)]
    stretches, leads = {}, []
    for anchor in anchors:
        left, right = own.randbytes(spare), own.randbytes(spare)
        for _ in range(4):  # around one anchor, some bytes on each side agree
            a, b = own.randint(0, spare), own.randint(0, spare)
            before = own.randbytes(own.randint(0, spare - a)) + left[spare - a:]
            behind = right[:b] + own.randbytes(spare - b)
            if len(before) + gram + len(behind) >= length and before + anchor + behind not in stretches:
                stretches[before + anchor + behind] = anchor
                leads.append(len(before))
    texts = list(stretches)
    strings = [{t[i:i + length] for i in range(max(lead - spare, 0), lead + 1) if i + length <= len(t)} for t, lead in zip(texts, leads)]
    shares = [any(x & y for j, y in enumerate(strings) if j != i) for i, x in enumerate(strings)]
    found = suffix.with_partners(texts, np.array(leads), length, gram).tolist()
    assert all(f for f, s in zip(found, shares) if s)
    crowd = Counter(stretches.values())
    assert length <= gram + 1 or sum(found) < sum(crowd[a] > 1 for a in stretches.values()) * 0.8


def test_runs_of_hits_by_group():
    own = random.Random(3)
    groups = [[own.random() < 0.6 for _ in range(own.randint(1, 6))] for _ in range(200)]
    expected = []
    for g, hits in enumerate(groups):
        for i, hit in enumerate(hits):
            if hit and (i == 0 or not hits[i - 1]):
                expected.append((g, i, next((j for j in range(i, len(hits)) if not hits[j]), len(hits)) - 1))
    found = suffix.hit_ranges(np.array(sum(groups, [])), np.array([len(g) for g in groups]))
    assert list(zip(*(x.tolist() for x in found))) == expected


@pytest.mark.parametrize("bucket_rows", [suffix.BUCKET_ROWS, 0])
def test_names_are_sorted_level_by_level(monkeypatch, bucket_rows):
    monkeypatch.setattr(suffix, "BUCKET_ROWS", bucket_rows)
    levels, build = [], suffix.suffix_array
    monkeypatch.setattr(suffix, "suffix_array", lambda text, symbols: levels.append(symbols) or build(text, symbols))
    unit, text = [2, 1, 2, 0], []
    for part in ([unit, [2, 1, 2, 1]] * 5 + [unit] * 2) * 4:
        text += part
    order = suffix.suffix_array(np.array(text), 3)
    expected = sorted(range(len(text)), key=lambda i: text[i:])
    assert order.tolist() == expected
    assert len(levels) >= 3  # the text, its names, and theirs
    shared = suffix.common_prefixes(np.array(text), order, len(text))
    for a, b in zip(expected, expected[1:]):
        assert shared[b] == next((i for i, (x, y) in enumerate(zip(text[a:], text[b:])) if x != y), len(text) - max(a, b))


@pytest.mark.parametrize("bucket_rows", [suffix.BUCKET_ROWS, 0])
@pytest.mark.parametrize("seed", range(30))
def test_suffix_arrays_and_common_prefixes(monkeypatch, seed, bucket_rows):
    monkeypatch.setattr(suffix, "BUCKET_ROWS", bucket_rows)
    own = random.Random(seed)
    text = np.array([own.randint(0, own.choice([1, 2, 6])) for _ in range(own.randint(1, 120))] if seed % 3 else ([0, 1, 1] * 40)[:own.randint(1, 119)])
    order = suffix.suffix_array(text, 8)
    expected = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert order.tolist() == expected
    shared = suffix.common_prefixes(text, order, 15)
    for a, b in zip(expected, expected[1:]):
        same = 0
        while same < 15 and b + same < len(text) and a + same < len(text) and text[a + same] == text[b + same]:
            same += 1
        assert shared[b] == same


def pages_of(n):
    htmls = [None, "", "<p>ä</p>\r\n\r\nWARC/1.1\r\n", "<b>one</b>", "<b>one</b>", "<b>one</b>", "x" * 100_000, ""]
    rows = [(i * 2, f"http://h/{i}", html) for i, html in enumerate(htmls)] + [(None, "http://n", "<b>one</b>"), (2, None, ""), (6, "a b\r\nc", "<b>one</b>")]
    return rows[:n]


def test_archives_give_back_every_page_with_its_original(spark):
    rows = pages_of(99)
    captures = warc.page_captures(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), payloads=True)
    by_payload = defaultdict(list)
    for i, _, html in rows:
        by_payload[html or ""].append(i)
    got = captures.collect()
    assert Counter(r.page_id for r in got) == Counter(i for i, _, _ in rows)
    for payload, ids in by_payload.items():
        digest = base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()
        own = [r for r in got if r.declared_digest == f"sha1:{digest}"]
        first = min((i for i in ids if i is not None), default=None)
        assert sorted(r.record_type for r in own) == ["response"] + ["revisit"] * (len(ids) - 1)
        assert {r.original_page for r in own if r.record_type == "revisit"} <= {first}
        response = next(r for r in own if r.record_type == "response")
        assert response.page_id == first and bytes(response.response.payload) == payload.encode() and response.response.payload_digest == digest
        assert all(r.n_requests == r.n_metadata == 1 and r.request.record_type == "request" for r in own)


def test_revisits_of_a_hot_payload(spark, monkeypatch):
    monkeypatch.setattr(warc.heavy_keys, "__defaults__", (20,))
    monkeypatch.setattr(warc.hot_keys, "__defaults__", (20,))
    rows = [(i, f"http://h/{i}", "same body" if i % 3 else f"body {i}") for i in range(90)] + [(None, "http://n", None), (200, None, "same body")]
    captures = warc.page_captures(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4))
    got = {r.page_id: (r.record_type, r.original_page, bytes(r.response.payload)) for r in captures.collect()}
    assert got == {page: ("revisit", 1, b"") if html == "same body" and page != 1 else ("response", None, (html or "").encode())
                   for page, _, html in rows}


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(1, None, "aa"), (2, None, "aa"), (3, None, "bbbb"), (4, None, "bbbb")], "page_id long, url string, html string")
    kinds = dict(values(warc.page_captures(pages, min_bytes=3), "page_id", "record_type"))
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_records_are_assembled_whichever_side_names_the_other(spark):
    blank = {"target_uri": None, "date": None, "refers_to": None, "declared_digest": None, "content_type": None, "head": None,
             "payload": bytearray(b""), "payload_bytes": 0, "payload_digest": None}

    def record(record_id, kind, *to):
        own = {**blank, "record_id": record_id, "record_type": kind, "concurrent_to": list(to)}
        return tuple(own[name] for name in warc.RECORD.fieldNames())

    records = spark.createDataFrame([
        record("r1", "response"), record("q1", "request", "r1"), record("m1", "metadata", "q1"), record("m1", "metadata", "q1"),
        record("r2", "response", "q2"), record("q2", "request"), record("m2", "metadata", "r2"), record("m3", "metadata", "r2"),
        record("r3", "response"), record("q9", "request", "gone"), record("i", "warcinfo")], warc.RECORD)
    got = {r.capture_id: (r.request and r.request.record_id, r.metadata and r.metadata.record_id, r.n_requests, r.n_metadata)
           for r in warc.assemble(records).collect()}
    assert got == {"r1": ("q1", "m1", 1, 1), "r2": ("q2", "m2", 1, 2), "r3": (None, None, 0, 0)}
    assert values(warc.unassembled(records), "record_id") == [("q9",)]


def test_archives_of_single_gzip_members_are_read_too():
    import gzip

    one = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: 5\r\n\r\nab\r\nc\r\n\r\n"
    assert [r[9] for r in warc.parsed_records(gzip.compress(one) + gzip.compress(one))] == [b"ab\r\nc"] * 2
    assert [r[9] for r in warc.parsed_records(one * 3)] == [b"ab\r\nc"] * 3
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parsed_records(one[:-8]))


def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 3, None, "x"), (1, 1, "ann", "hi <|im_end|>"),
            (2, None, "ann", "late"), (2, 600, "bob", "ü!"), *[(4, n, "ann" if n % 2 else "bob", f"turn {n}") for n in range(600)], (3, 0, "system", "alone"), (None, 0, "ann", "lost")]
    talk = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    rotated = chat.rotate(talk).collect()
    got = {(r.conv_id, r.speaker): r for r in rotated}
    assert len(rotated) == len(got) and set(got) == {(1, "ann"), (1, "bob"), (1, "unknown"), (2, "ann"), (2, "bob"), (4, "ann"), (4, "bob")}
    ann = got[1, "ann"]
    assert ann.text == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi <​|im_end|><|im_end|>\n"
                        "<|im_start|>user name=bob\n<|im_end|>\n<|im_start|>user name=unknown\nx<|im_end|>\n")
    start, end = map(int, ann.mask.split("-"))
    assert ann.text[start:end] == "hi <​|im_end|><|im_end|>"
    assert [(m.role, m.name, m.trained) for m in ann.messages] == [
        ("system", None, False), ("assistant", None, True), ("user", "bob", False), ("user", "unknown", False)]
    late = got[2, "bob"]
    assert [m.content for m in late.messages] == ["late", "ü!"] and late.text[slice(*map(int, late.mask.split("-")))] == "ü!<|im_end|>"
    whole = got[4, "ann"]  # a long dialogue is one row
    spoken = [whole.text[slice(*map(int, span.split("-")))] for span in whole.mask.split(";")]
    assert len(whole.messages) == 600 and spoken == [f"turn {n}<|im_end|>" for n in range(1, 600, 2)]
    assert chat.rotate(talk.limit(0)).count() == 0


def test_sampled_pieces_are_lossless_and_repeatable(docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    first = values(pieces.sampled_pieces(docs, path, seed=3), "key", "ids", "lossless")
    assert all(row[2] for row in first) and len(first) == len(ROWS)
    assert first == values(pieces.sampled_pieces(docs.repartition(5), path, seed=3), "key", "ids", "lossless")
    assert first != values(pieces.sampled_pieces(docs, path, seed=4), "key", "ids", "lossless")
    back = values(pieces.decoded(pieces.sampled_pieces(docs, path, seed=3), path), "key", "text")
    assert back == sorted(((i, t or "") for i, t in ROWS), key=repr)


def test_lattices_hold_all_edges_with_their_shares():
    model = pieces.piece_model(public_tokenizers.path("piece_bpe_32k.model"), 1.0)
    assert model is pieces.piece_model(public_tokenizers.path("piece_bpe_32k.model"), 1.0)  # one per worker, not per task
    ids_of = {model.spelled[i]: i for _, ids in model.tables.values() for i in ids.tolist()}
    lattices = pieces.Lattices(model)
    for texts in [[" the", "\n", "    ", " \u2581a\u2581"], [" na\u00efve\0b\x7f", "a" * 40, "  \u4e2d\u6587\U0001f600\U00012345!", " \u00e9\u00e9\u0430\u0431", "\0"]]:
        before = len(lattices.index)
        stretches = [text.encode() for text in texts]
        lattices.add(stretches)
        for s, (text, stretch) in enumerate(zip(texts, stretches)):
            chars = [len(text[:i].encode()) for i in range(len(text) + 1)]
            into = {at: [] for at in range(1, len(stretch) + 1)}
            for i, start in enumerate(chars[:-1]):
                for end in chars[i + 1:]:
                    if stretch[start:end] in ids_of:
                        into[end].append((end - start, ids_of[stretch[start:end]]))
                if stretch[start:chars[i + 1]] not in ids_of:
                    for at in range(start, chars[i + 1]):
                        into[at + 1].append((99, int(model.byte_id[stretch[at]])))  # bytes come last
            weight = {0: 1.0}
            first = lattices.finals[before + s] - len(stretch)
            for at, edges in into.items():
                parts = [weight[at - int(model.sizes[i])] * np.exp(model.weights[i]) for _, i in sorted(edges)]
                weight[at] = sum(parts)
                begin = lattices.begin[first + at]
                held = lattices.edges[begin:begin + len(edges)]
                assert (held & np.uint64(0xFFFFFFFF)).tolist() == [i for _, i in sorted(edges)]
                if edges:
                    assert np.allclose((held >> np.uint64(32)) / 2 ** 30, np.cumsum(parts) / weight[at], atol=1e-8)
                    assert int(held[-1] >> np.uint64(32)) == 1 << 30


@pytest.mark.parametrize("text", ["", "\n", " ", "\n\n a", "a  b\n  \n c ", "  ", "a b", "\u2581 \u2581\n\0 "])
def test_stretches_begin_at_newlines_behind_them_and_at_runs_of_spaces(text):
    others = ["x y", "\nz "]
    found, first, sizes = pieces._stretches([t.encode() for t in (text, *others)])
    expected = [re.findall(rb" *[^ \n]+| +|\n", b" " + t.encode()) for t in (text, *others)]
    assert found.to_pylist() == [stretch for own in expected for stretch in own]
    assert sizes.tolist() == [len(own) for own in expected] and first.tolist() == [0, sizes[0], sizes[0] + sizes[1]]


def test_sampling_follows_the_weights_of_the_paths():
    model = pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"), 0.7)
    lattices = pieces.Lattices(model)
    word = b" thing"
    lattices.add([b" other", word])
    n = 200_000
    ids, counts = lattices.sample(np.full(n, 1), pieces.mixed(np.arange(n).astype(np.uint64)))
    ends = np.cumsum(counts)
    got = Counter(tuple(ids[e - c:e].tolist()) for e, c in zip(ends, counts))

    ids_of = {model.spelled[i]: i for length in model.tables for i in model.tables[length][1].tolist()}

    def paths(rest):
        if not rest:
            yield (), 0.0
        for k in range(1, len(rest) + 1):
            if rest[:k] in ids_of:
                i = ids_of[rest[:k]]
                for tail, weight in paths(rest[k:]):
                    yield (i, *tail), weight + model.weights[i]

    exact_weights = {p: np.exp(w) for p, w in paths(word)}
    total = sum(exact_weights.values())
    assert set(got) <= set(exact_weights)
    for path, weight in exact_weights.items():
        p = weight / total
        assert abs(got[path] / n - p) < 5 * np.sqrt(p * (1 - p) / n) + 1e-5


def test_queries_reach_few_cells_and_lose_none():
    own = np.random.default_rng(5)
    points = np.floor(np.repeat(own.normal(0, 1000, (16, 4)), 200, axis=0) + own.normal(0, 20, (3200, 4)))
    cells = topk.Cells.fitted(points[::3], 16)
    of = cells.of(points)
    assert cells.count == 16 and set(of.tolist()) == set(range(16))
    low, high = (np.array([side(points[of == c], axis=0) for c in range(16)]) for side in (np.min, np.max))
    sent = 0
    for query in points[::100]:
        scores = points @ query
        kth = int(np.sort(scores)[-10])
        found = topk.reached(query, kth, low, high)
        sent += len(found)
        assert set(of[scores >= kth].tolist()) <= set(found.tolist())
    assert sent < 32 * 16 / 3
    assert topk.Cells.fitted(np.ones((50, 3)), 8).count == 1 and topk.Cells.fitted(np.zeros((0, 3)), 8).count == 1


def test_top_k_against_brute_force(spark):
    own = np.random.default_rng(1)
    rows = [(i, own.normal(size=6).tolist(), 1) for i in range(300)]
    rows += [(i, rows[0][1], 1) for i in range(300, 400)]  # one vector many times
    rows += [(500, None, 1), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (502, [float("nan")] * 6, 1), (503, [float("inf")] * 6, 1), (None, [1.0] * 6, 1),
             (600, [1e15] * 6, 1), (700, [1.0, 2.0], 1), (701, [3.0, -1.0], 1), (800, [], 1), (100, rows[100][1], 1)]
    vectors = spark.createDataFrame([(i, v, x) for i, v, x in rows], "vec_id long, embedding array<double>, rank int")
    whole = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            whole[i] = [int(np.floor(1024 * x)) for x in v]
    expected = []
    for q in (i for i in whole if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:10]
        expected += [(q, rank, i, min(-s, (1 << 63) - 1)) for rank, (s, i) in enumerate(scores, 1)]  # the nearest long
    for shard_rows in (8192, 60):
        got = values(topk.top_k(vectors, shard_rows=shard_rows), "query_id", "rank", "vec_id", "score")
        assert got == sorted(expected, key=repr)


def test_toxicity_is_learned_and_told_apart(spark):
    insults = ["slimewort", "grubnose", "twaddlehead"]

    def text(toxic):
        own = words(rng.randint(30, 80)).split()
        for _ in range(3 * toxic):
            own.insert(rng.randrange(len(own)), rng.choice(insults))
        return " ".join(own)

    rows = [(i, text(i % 4 == 0), i % 4 == 0) for i in range(600)]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t, _ in rows] + [(9001, None, 0.0), (9002, "", 0.0), (None, "hello", 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(x)) for i, _, x in rows if i < 400] + [(None, 1), (7, None), (55555, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert len(scores) == 603 and all(0 <= s <= 1 for s in scores.values())
    right = [(scores[i] >= 0.5) == x for i, _, x in rows if i >= 400]
    assert sum(right) / len(right) > 0.97
    assert max(scores[9001], scores[9002], scores[None]) < 0.5
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i, s in scores.items() if s < 0.5}


def test_toxicity_without_labels_rejects_nothing(spark, docs):
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.scored(docs, model).collect()} == {0.0}


def test_empty_tables(spark, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert exact.membership(nothing).count() == exact.keep_one(nothing).count() == 0
    assert packing.packed_documents(nothing, path).count() == 0
    assert sharding.shard_documents(nothing, 40).count() == 0
    assert jaccard.jaccard_components(nothing).count() == jaccard.one_per_component(nothing).count() == 0
    assert suffix.without_repeats(nothing).count() == 0
    assert pieces.sampled_pieces(nothing, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert warc.page_captures(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert toxicity.scored(nothing, toxicity.fit(nothing, spark.createDataFrame([], "doc_id long, toxic int"))).count() == 0
