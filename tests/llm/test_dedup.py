"""Exact groups and Jaccard components against brute force."""

import random

import numpy as np
import pytest
from navloom.llm import jaccard
from navloom.llm.components import components
from navloom.llm.exact_dedup import exact_dedup


def kept_by_brute_force(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r"), []).append((-len(t or ""), i is None, i or 0, i))
    best = {k: min(v)[3] for k, v in groups.items()}
    return {(i, t): (best[k := "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")], len(groups[k])) for i, t, *_ in rows}


@pytest.mark.parametrize("bits", [128, 4])
def test_exact_groups(documents, bits):
    rows = [(5, "a b"), (3, "ab"), (9, "a  b"), (8, "a\t\nb"), (2, "c"), (1, "\u00a0c"), (7, None), (6, ""), (4, " "), (None, "d"), (10, "d"), (None, "e"), (-3, "f"), (12, "f"), (11, "x" * 50_000), (13, "x " * 50_000)]
    rows += [(100 + k, f"t{k % 17}") for k in range(60)]
    docs = documents(*rows, extra=", kept long, hash long, row long")
    found = exact_dedup(docs, hash_bits=bits)
    want = kept_by_brute_force(rows)
    got = {(r.row.doc_id, r.row.text): (r.keep_id, r.group_size) for r in found.collect()}
    assert got == want
    assert found.where("kept").count() == len(set(want.values()))


def test_exact_groups_of_no_rows(documents):
    assert exact_dedup(documents()).count() == 0


def grams(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1)))


def components_by_brute_force(rows, width, percent):
    sets = [(i, grams(t, width)) for i, t, *_ in rows]
    label = {i: i for i, _ in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(i), top(j)))
                label[y] = x
    return {i: (len(s), top(i)) for i, s in sets}


def near_copies(seed, copies, words):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randrange(0, 6)):
            text[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        yield " ".join(text)


@pytest.mark.parametrize("width,percent,hot", [(3, 90, 50_000), (5, 80, 50_000), (3, 90, 10)])
def test_jaccard_components(documents, monkeypatch, width, percent, hot):
    monkeypatch.setattr(jaccard, "HOT_LIST", hot)
    texts = [t for seed, copies, words in ((1, 60, 90), (2, 25, 30), (3, 10, 200), (4, 8, 7)) for t in near_copies(seed, copies, words)]
    texts += ["", None, " \n", "One", "one", "one two", "One  TWO", "\u00c9t\u00e9 a b c", "\u00e9t\u00e9 a b c", "a b c d " * 500, "a b c d " * 501]
    passage = " ".join(f"p{k}" for k in range(40))
    texts += [passage + " " + " ".join(f"q{n}_{k}" for k in range(n)) for n in range(0, 60, 3)]
    rng = random.Random(5)
    ids = rng.sample(range(1000), len(texts))
    rows = list(zip(ids, texts))
    found = jaccard.jaccard_components(documents(*rows, extra=", id long, component long"), width, percent).collect()
    assert {r.id: (r.n_shingles, r.component) for r in found} == components_by_brute_force(rows, width, percent)


def test_jaccard_with_missing_and_repeated_ids(documents):
    rows = [(4, "a b c d"), (4, "a b c d"), (2, "A b C d"), (None, "a b c d"), (7, "z z z"), (7, "y y y"), (8, None)]
    found = sorted(((r.id, r.component, r.n_shingles) for r in jaccard.jaccard_components(documents(*rows)).collect()), key=str)
    assert found == sorted([(4, 2, 2), (4, 2, 2), (2, 2, 2), (None, None, 2), (7, 7, 1), (7, 7, 1), (8, 8, 0)], key=str)
    assert jaccard.jaccard_components(documents()).count() == 0


def test_jaccard_links_every_text_of_an_id(documents):
    """Ids 2 and 1 share 38 of 39 shingles by the second text of 1; 3 links with the first; one row of the component is kept."""
    a, b = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, a + " more"), (5, "c c"), (5, "d d"), (5, "d d")]
    found = jaccard.jaccard_components(documents(*rows))
    got = sorted((r.id, r.component, r.kept) for r in found.collect())
    assert [(i, c) for i, c, _ in got] == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (5, 5), (5, 5)]
    assert [i for i, _, k in got if k] == [1, 1, 5, 5, 5]  # two components share the name 1


def test_long_lists_meet_their_pairs_once(documents, monkeypatch):
    """A passage that fifty documents share in part: no pair is lost where long lists compare what stands before."""
    monkeypatch.setattr(jaccard, "LONG_LIST", 2)
    rng = random.Random(11)
    passage = [f"p{k}" for k in range(60)]
    texts = [" ".join(passage[: rng.randrange(40, 61)] + [f"o{n}_{k}" for k in range(rng.randrange(0, 25))]) for n in range(50)]
    texts += [t for seed in (7, 8) for t in near_copies(seed, 30, 60)]
    rows = list(zip(rng.sample(range(500), len(texts)), texts))
    found = jaccard.jaccard_components(documents(*rows), 5, 80).collect()
    assert {r.id: (r.n_shingles, r.component) for r in found} == components_by_brute_force(rows, 5, 80)


def test_pairs_that_met_at_a_hub_do_not_meet_again(documents, monkeypatch):
    """Lists of two and the hubs of longer lists are not compared a second time."""
    seen, between = [], jaccard._between
    monkeypatch.setattr(jaccard, "_between", lambda listed, *rest: seen.extend(listed.collect()) or between(listed, *rest))
    copies = lambda c, n: [" ".join([f"{c}{k}" for k in range(60)] + [f"{c}x{j}" for j in range(more)]) for more in range(n)]
    texts = [t for k in range(20) for t in copies(f"p{k}_", 2)] + copies("t", 3)
    found = jaccard.jaccard_components(documents(*enumerate(texts))).collect()
    assert {r.id: (r.n_shingles, r.component) for r in found} == components_by_brute_force(list(enumerate(texts)), 3, 90)
    lists = {r.gram: 0 for r in seen}
    for r in seen:
        lists[r.gram] += 1
    assert lists and set(lists.values()) == {2} and len({r.key for r in seen}) <= 3


def test_frequent_ngrams_are_found_beside_any_number_of_rare_ones(documents, monkeypatch):
    """Sixty documents share ten n-grams and have 2,000 of their own each, far more than are told."""
    monkeypatch.setattr(jaccard, "FREQUENT", 100)
    monkeypatch.setattr(jaccard, "COUNTED_AT_ONCE", 20_000)
    passage = " ".join(f"p{k}" for k in range(12))
    texts = [passage + " " + " ".join(f"q{n}_{k}" for k in range(2000)) for n in range(60)] + [passage] * 30 + [""]
    grams, counts = jaccard.frequent_grams(documents(*enumerate(texts)).select("text"), 3)
    want = set(jaccard.shingles(passage, 3, {}).tolist())
    assert set(grams[:-1].tolist()) == want and counts[-1] == 0
    assert all(30 <= n <= 90 for n in counts[:-1])
    none = jaccard.frequent_grams(documents().select("text"), 3)
    assert len(none[0]) == 1 and none[1].tolist() == [0]


def test_parities_differ_no_more_than_sets(spark):
    rng = np.random.default_rng(3)
    rows = []
    for n in (0, 1, 3, 63, 64, 65, 200, 1000, 5000):
        for m, common in ((n, n), (n, n - n // 20), (n // 2, n // 3), (n + n // 9, n), (4 * n, n // 2), (n, 0)):
            grams = np.unique(rng.integers(0, 2**64, n + m - common, dtype=np.uint64))
            rng.shuffle(grams)
            a, b = (jaccard.parities(x).tolist() for x in (grams[:n], grams[n - common :]))
            rows.append((a, b, n + m - 2 * common, n, m))
    found = spark.createDataFrame(rows, "odd_a array<long>, odd_b array<long>, apart long, n int, m int").withColumn("least", jaccard._differing("odd_a", "odd_b")).collect()
    assert len(found) == len(rows) and all(0 <= r.least <= r.apart for r in found)
    assert all(r.least > 0.3 * r.n for r in found if r.n == r.m > 100 and r.apart == 2 * r.n)


def test_sets_are_fetched_only_for_pairs_that_are_almost_linked(documents, monkeypatch):
    """Two long documents share a rare passage of 87 percent, what they do not share is frequent: the parities tell that they are not linked."""
    fetched, shingled = [], jaccard.measured
    monkeypatch.setattr(jaccard, "measured", lambda df: fetched.append((df.columns, df.count())) or shingled(df))
    words = lambda c, n: [f"{c}{k}" for k in range(n)]
    texts = [" ".join(words("p", 4350) + words(q, 650)) for q in "ab"]
    texts += [" ".join(words(q, 650) + words(f"{q}own{k}_", 650)) for q in "ab" for k in range(5)]
    found = jaccard.jaccard_components(documents(*enumerate(texts)), 3, 90).collect()
    assert {r.id: (r.n_shingles, r.component) for r in found} == components_by_brute_force(list(enumerate(texts)), 3, 90)
    assert [n for columns, n in fetched if {"key", "id"} <= set(columns)][-2:] == [0, 0]


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(200, 200), (None, 3), (149, 300), (300, 299)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(50)} | {200: 200, 299: 100, 300: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
