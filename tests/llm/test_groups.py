"""Shingle sets, signature trees, the n-gram join and decontamination against brute force."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from hourgrid.llm import components, decontaminate, ngram_join, queries, shingle_sets, signature_tree

TEXTS = [None, "", " \n\t", "one", "One", "one two", "two one", "a b c d", "A B  C\nD", "é É é é", "a b c d e", "b c d e f"]


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def set_of(text, k):
    w = words_of(text)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_groups(rows, k, num, den):
    sets = [set_of(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def noisy(rng, text, share):
    return " ".join(w if rng.random() > share else f"w{rng.randrange(300)}" for w in text.split())


def corpus(rng, families=12, copies=9):
    rows = []
    for _ in range(families):
        base = " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(6, 90)))
        texts = [noisy(rng, base, rng.choice([0, 0, 0.01, 0.02, 0.04, 0.1])) for _ in range(copies)]
        rows += texts + [texts[0] + " " + " ".join(f"x{rng.randrange(99)}" for _ in range(3))]
    passage = " ".join(f"p{i}" for i in range(30))
    rows += [f"{passage} " + " ".join(f"w{rng.randrange(300)}" for _ in range(40)) for _ in range(20)]
    rng.shuffle(rows)
    return list(enumerate(rows + TEXTS))


def got_groups(df, *a):
    return sorted(map(tuple, ngram_join.near_groups(df, *a).collect()), key=repr)


@pytest.mark.parametrize("text", [*TEXTS, "x" * 70000 + " y z w v", "A\x0bB\x0cC\x1cD E", "\u00a0a b"])
@pytest.mark.parametrize("k", [1, 4, 5])
def test_shingle_sets(text, k):
    assert len(shingle_sets.shingle_set(text, k)) == len(set_of(text, k))
    assert len(shingle_sets.word_hashes(text or "")) == len(words_of(text))


def test_hashes_tell_sets_apart():
    rng = random.Random(1)
    seen = {}
    for i in range(3000):
        text = " ".join("".join(rng.choice("abAB ") for _ in range(rng.randrange(1, 5))) for _ in range(5))
        key = shingle_sets.shingle_set(text, 3).tobytes()
        assert seen.setdefault(key, set_of(text, 3)) == set_of(text, 3), i
    assert len(seen) == len(set(seen.values()))


@pytest.mark.parametrize("seed", range(4))
def test_trees_find_every_connection(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(25):
        base = rng.integers(-(2**63), 2**63, rng.integers(1, 200))
        for _ in range(rng.integers(1, 9)):
            keep = base[rng.random(len(base)) > rng.choice([0, 0.05, 0.1, 0.2])]
            sets.append(np.unique(keep if len(keep) else base))
    want = signature_tree.Forest(len(sets))
    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(np.intersect1d(a, sets[j]))
            if 100 * shared >= 80 * (len(a) + len(sets[j]) - shared):
                want.join(i, j)
    want = [want.find(i) for i in range(len(sets))]
    join = joined(sets)
    join.within(join.tree(list(range(len(sets))), lambda d: len(sets[d])))
    assert join.labels() == want
    halves = [list(range(i, len(sets), 2)) for i in (0, 1)]
    join = joined(sets)
    a, b = map(join.tree, halves)
    join.within(a)
    join.between(a, b)
    join.within(b)
    assert join.labels() == want
    known = joined(sets, want)
    known.similar = lambda x, y: False if want[x] != want[y] else pytest.fail("connected documents were compared")
    known.within(known.tree(list(range(len(sets)))))
    assert known.labels() == want


def joined(sets, labels=None):
    bits = [signature_tree.bitmap(s) for s in sets]
    return signature_tree.Join(bits, [len(s) for s in sets], 80, 100, signature_tree.exact(sets, 80, 100), labels)


def test_bounds_never_cut_off_a_similar_pair(monkeypatch):
    rng = np.random.default_rng(8)
    for least, most in ((256, 1 << 16), (64, 64)):  # with 64 bits many tokens share one
        monkeypatch.setattr(signature_tree, "LEAST_BITS", least)
        monkeypatch.setattr(signature_tree, "MOST_BITS", most)
        for n in (3, 40, 63, 64, 200):
            for _ in range(30):
                base = np.unique(rng.integers(0, 2**40, n))
                other = np.unique(np.concatenate((base[rng.random(len(base)) > 0.08], rng.integers(0, 2**40, n // 20))))
                join = joined([base, other, np.unique(rng.integers(0, 2**40, 4 * n))])
                assert not join.similar(0, 1) or len(join._pairs([0], [1])) == 1
                a, b = join._leaf([0, 2]), join._leaf([1])
                assert not join.similar(0, 1) or join._fits(a, b)


def test_groups_of_a_corpus(documents, clashing):
    rows = corpus(random.Random(4))
    rows += [(None, rows[0][1]), (None, "null id alone in the world"), (5, rows[5][1]), (2000, rows[7][1])]
    want = brute_groups(rows, 4, 85, 100)
    assert got_groups(clashing(documents(rows).repartition(6), "component", "first", "rep_id"), 4, 85, 100) == want
    assert len({c for _, _, c in want}) > 40


def test_groups_in_chunks(documents, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 4)
    monkeypatch.setattr(ngram_join, "LIST", 8)
    monkeypatch.setattr(ngram_join, "BROADCAST_MEMBERS", 0)
    rows = corpus(random.Random(9), families=3, copies=30)
    assert got_groups(documents(rows).repartition(3), 5, 80, 100) == brute_groups(rows, 5, 80, 100)


def test_no_documents(documents):
    assert got_groups(documents([]), 5, 80, 100) == []
    assert got_groups(documents([(1, ""), (2, None)]), 5, 80, 100) == [(1, 0, 1), (2, 0, 2)]


def test_groups_of_the_documents(spark, sf_dir, read):
    rows = [(r["doc_id"], r["text"]) for r in read("documents").collect()]
    got = queries.queries()["op8_ngram_jaccard_join"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=repr) == brute_groups(rows, 4, 85, 100)


def counted(monkeypatch, sets, least):
    """What the count of shingles passes on for documents of these sets, as batches."""
    monkeypatch.setattr(ngram_join, "COUNTED", least)
    monkeypatch.setattr(ngram_join, "shingle_set", lambda text, words: sets[int(text)])
    rows = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(len(sets))])], ["text"])
    return ngram_join._count(5)(iter([rows]))


def test_repeated_shingles_are_passed_on(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(-300, 300, n)) for n in (0, 5, 400, 0, 90, 2000, 7, 1)]
    monkeypatch.setattr(ngram_join, "ROOM", 3)
    monkeypatch.setattr(ngram_join, "PASSED_ON", 50)
    got, want, held = Counter(), Counter(), []
    for batch in counted(monkeypatch, sets, 200):
        assert 0 < batch.num_rows <= 50
        got.update(dict(zip(*(c.to_pylist() for c in batch.columns), strict=True)))
    for i, s in enumerate(sets):
        held += s.tolist()
        if len(held) >= 200 or i == len(sets) - 1:
            want.update({t: n for t, n in Counter(held).items() if n > 1})
            held = []
    assert got == want and len(got) > 50


def test_shingles_are_counted_in_the_room_they_take(monkeypatch):
    sets = [np.arange(10_000 * i, 10_000 * (i + 1)) for i in range(200)]
    tracemalloc.start()
    try:
        assert list(counted(monkeypatch, sets, 2_000_000)) == []
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 1.6 * 8 * 2_000_000


def test_components(spark):
    path = [(i, i + 1) for i in range(30)] + [(100, 50), (50, 101), (7, 7), (200, 200)]
    got = dict(map(tuple, components.components(spark.createDataFrame(path, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(31)} | {100: 50, 50: 50, 101: 50}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def runs_of(text, k=5):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]


def brute_held(docs, items, least=0.8):
    best = {}
    for d, text in docs:
        held = set(runs_of(text))
        for i, item in items:
            own = set(runs_of(item))
            if own and len(own & held) >= least * len(own):
                best[d, i] = max(best.get((d, i), 0), len(own & held))
    return best


def planted(rng, n_items=25):
    word = lambda: f"w{rng.randrange(4000)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(5, 130)))) for i in range(n_items)]
    items += [(900, "too short"), (901, None), (902, ""), (3, items[3][1])]
    docs = []
    for d in range(150):
        body = [word() for _ in range(rng.randrange(0, 1500))]
        if d % 2:
            own = rng.choice(items[:n_items])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                own[rng.randrange(len(own))] = word()
            at = rng.randrange(len(body) + 1)
            body[at:at] = [w.upper() + rng.choice(["", ",", "!"]) for w in own]
        docs.append((d, " ".join(body)))
    return docs + [(None, items[1][1]), (500, None), (501, ""), (7, docs[7][1])], items


@pytest.mark.parametrize("few", [10**6, 0])
def test_planted_items_are_found(spark, documents, clashing, few):
    docs, items = planted(random.Random(6))
    held = clashing(spark.createDataFrame(items, "item_id long, text string"), "hash", "own", "half", "doc_id")
    got = decontaminate.contaminated(clashing(documents(docs), "hashes", "at", "words"), held, broadcast_minima=few).collect()
    assert {(r["doc_id"], r["item_id"]): r["n_shared"] for r in got} == brute_held(docs, items)
    assert len(got) == len({(r["doc_id"], r["item_id"]) for r in got}) > 40
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(documents(docs), none, broadcast_minima=few).count() == 0
    assert decontaminate.contaminated(documents([]), held, broadcast_minima=few).count() == 0


def test_places_take_along_what_is_around_them_not_the_document(spark, documents, monkeypatch):
    """F1 (op4): each place that met a minimum held a copy of its document's shingles, and all places of a document lay in memory."""
    rng, kept, store = random.Random(3), [], decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", lambda df, name: kept.append(df) or store(df, name))
    items = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(8, 90)))) for i in range(12)]
    whole = " ".join(text for _, text in items)
    docs = [(1, whole), (2, whole), (3, " ".join([items[4][1]] * 30)), (4, "w1 " * 300), (5, items[7][1]), (6, None)]
    items += [(12, items[0][1]), (None, items[1][1]), (13, "w1 " * 40)]
    held = spark.createDataFrame(items, "item_id long, text string")
    for few in (10**6, 0):
        got = decontaminate.contaminated(documents(docs), held, broadcast_texts=few).collect()
        assert {(r["doc_id"], r["item_id"]): r["n_shared"] for r in got} == brute_held(docs, items)
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    (around,) = re.findall(r"Generate explode\(array\(slice.*\[([^][]*)\], true, \[around#\d+\]", plan)
    assert "item#" in around and "hashes#" not in around


def test_words_of_like_structure_differ(spark, documents):
    """Words that a polynomial modulo a power of two cannot tell apart."""
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"one two three {word}"), (2, f"one two three {other}"), (3, f"ONE two three {word}")]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_groups(documents(rows), 4, 85, 100).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_words_are_cut_and_lowered_as_bytes():
    hashes = shingle_sets.word_hashes
    assert hashes("A\x0bb\x0cC\rd\n").tolist() == hashes("a b c d").tolist()
    assert len(set(hashes("Ä ä K k x\x1cy x\xa0y x y").tolist())) == 7  # only ASCII is lowered or cut
    assert len(hashes("")) == len(hashes(" \t\n")) == 0
