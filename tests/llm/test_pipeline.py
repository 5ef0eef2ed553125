"""Stages of the corpus pipeline against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, c0 string, _kept_text string, component_id long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", -1, "own", "mine", 7) for i, t in rows], SCHEMA).repartition(2)


def found(frame):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars, r.c0, r._kept_text, r.component_id) for r in frame.collect())


def expected(rows, n_chars):
    return Counter((i, t, "en", "s", n_chars(t), "own", "mine", 7) for i, t in rows)


def test_repeats_are_cut_and_counted_anew(spark):
    own = random.Random(3)
    passage, other = ("".join(own.choice("abcdefgh \u00e4") for _ in range(80)) for _ in range(2))
    rows = [(1, "A" + passage + "B"), (2, "C" + passage + "D"), (2, other), (3, None), (3, ""), (4, "short"), (None, "E" + passage + "F"), (None, "kept")]
    left = [(i, {"C" + passage + "D": "CD", "E" + passage + "F": "EF"}.get(t, t)) for i, t in rows]
    done = corpus_pipeline.cut_repeats(spark, documents(spark, rows), "")
    assert done.columns == documents(spark, rows).columns
    assert found(done) == expected(left, lambda t: None if t is None else len(t))


def test_near_copies_leave_with_their_columns(spark):
    own = random.Random(4)
    texts = [" ".join(f"w{own.randrange(10**6)}" for _ in range(60)) for _ in range(3)]
    rows = [(1, texts[0]), (None, texts[0] + " end"), (None, texts[1]), (5, texts[0] + " stop"), (5, texts[2]), (5, None), (None, "")]
    left = [row for row in rows if row not in [(None, texts[0] + " end"), (5, texts[0] + " stop")]]
    done = corpus_pipeline.drop_near_copies(spark, documents(spark, rows), "")
    assert done.columns == documents(spark, rows).columns
    assert found(done) == expected(left, lambda t: -1)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Labelled documents, a fifth of them toxic, with exact and near copies and a passage in several; and the folder they lie in."""
    own = random.Random(9)
    plain = [f"word{i}" for i in range(300)]
    vile = ["scumbag", "imbecile", "worthless trash", "shut up you", "pathetic loser"]
    texts = []
    for i in range(300):
        text = " ".join(own.choice(plain) for _ in range(own.randint(40, 80)))
        texts.append(f"{text} {' '.join(own.sample(vile, 4))} {text[:50]}" if i % 5 == 0 else text)
    passage = " ".join(own.choice(plain) for _ in range(30))
    texts += [texts[1].upper(), texts[1], texts[2] + " end", *[f"{' '.join(own.sample(plain, 30))} {passage} {' '.join(own.sample(plain, 30))}" for _ in range(3)], None, ""]
    rows = [(i, t, "en", "s", -1, "own", "mine", 7) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i < 300 and i % 5 == 0)) for i in range(len(texts))], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return texts, folder


def test_toxic_documents_leave_and_clean_ones_stay(spark, corpus):
    texts, folder = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = found(corpus_pipeline.drop_toxic(spark, docs, folder))
    clean = {i for i in range(len(texts)) if i >= 300 or i % 5}
    assert not kept - found(docs) and {row[0] for row in kept} == clean


def test_of_exact_copies_the_largest_id_stays(spark):
    rows = [(1, "Same"), (4, "sAME"), (3, "same"), (2, None), (5, ""), (6, "other"), (None, "same"), (6, "other")]
    done = corpus_pipeline.drop_exact_copies(spark, documents(spark, rows), "")
    assert found(done) == expected([(4, "sAME"), (5, ""), (6, "other")], lambda t: -1)


def packed_as_expected(rows, texts):
    """Every document's pieces are there, in sequences without gaps."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = Counter(), defaultdict(list)
    for r in rows:
        pieces[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces == Counter({i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts.items()})
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 4096


def test_documents_are_packed_whole(spark):
    texts = {1: "a few words", 2: None, 3: "", 4: "Many words. " * 3000}
    packed_as_expected(corpus_pipeline.pack(spark, documents(spark, texts.items()), "").collect(), texts)


def test_the_whole_pipeline(spark, corpus):
    """What brute force leaves of the corpus is what is packed."""
    texts, folder = corpus
    docs = {i: t for i, t in enumerate(texts) if i >= 300 or i % 5}
    last = {hashlib.sha256((t or "").lower().encode()).digest(): i for i, t in docs.items()}  # the largest id of equal texts
    docs = {i: docs[i] for i in sorted(last.values())}

    def shingles(text):
        own = (text or "").lower().split()
        return {tuple(own[i:i + 5]) for i in range(max(1, len(own) - 4))} if own else set()

    sets = {i: shingles(t) for i, t in docs.items()}
    near = {b for a in docs for b in docs if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    docs = {i: (t or "").encode() for i, t in docs.items() if i not in near}
    first: dict[bytes, int] = {}
    left = {}
    for i in sorted(docs):
        text, gone = docs[i], set()
        own = [text[at:at + 50] for at in range(len(text) - 49)]
        for at, string in enumerate(own):
            if first.get(string, i) < i:
                gone.update(range(at, at + 50))
        for string in own:
            first.setdefault(string, i)
        left[i] = bytes(b for at, b in enumerate(text) if at not in gone).decode()
    assert any(len(left[i]) < len(docs[i]) for i in docs) and len(docs) < len(last)
    packed_as_expected(corpus_pipeline.run(spark, folder).collect(), left)
