"""Near words, forms and roots against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from navloom.llm import spelling as S


def near_by_brute_force(words):
    known, pairs, rests = set(words), set(), {}
    for w in words:
        for k in range(len(w)):
            rest = w[:k] + w[k + 1 :]
            if rest in known:
                pairs.add((rest, w))
            rests.setdefault((k, rest), []).append(w)
    for same in rests.values():
        pairs |= {(min(a, b), max(a, b)) for i, a in enumerate(same) for b in same[:i]}
    return {(min(p), max(p)) for p in pairs}


def found_in_shards(words, opened):
    shards = {}
    for word, vector in zip(words, S.letter_vectors(words).tolist()):
        for prefix, spent in S.shards_of(vector, opened):
            shards.setdefault(prefix, []).append((word, spent))
    out = []
    for prefix, rows in shards.items():
        a, b = S.pairs_in_shard([w for w, _ in rows], np.array([s for _, s in rows], np.uint8), len(prefix))
        out += [(min(rows[i][0], rows[j][0]), max(rows[i][0], rows[j][0])) for i, j in zip(a, b)]
    return out


def some_words(seed, letters, n, low, high):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(low, high))) for _ in range(n)}
    for w in sorted(words)[: n // 2]:
        k = rng.randrange(len(w))
        words.add(rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]]))
    return sorted(w for w in words if w)


@pytest.mark.parametrize("words", [some_words(1, "abcdefghijéÿ", 1500, 1, 9), some_words(2, "am", 1500, 8, 12), some_words(3, "aq", 1200, 11, 13), ["a"], ["ab", "b", "a", "ba"]])
@pytest.mark.parametrize("share", [2, 0.02])
def test_every_pair_is_found_once(words, share):
    """The second and third lists make leaves of many words with the same counts (a, m and q are in one group)."""
    found = found_in_shards(words, S.cut_of(words, share))
    assert len(found) == len(set(found)) and set(found) == near_by_brute_force(words)


def variants_by_brute_force(counts, ratio=5):
    near = {w: [] for w in counts}
    for a, b in near_by_brute_force(counts):
        near[a].append(b)
        near[b].append(a)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= ratio * n else None
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, n, len(near[w]), form[w], form[w] and counts[form[w]], root))
    return rows


def test_forms_and_roots(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD_WORDS", 50)
    rng = random.Random(6)
    counts = {w: rng.choice([1, 1, 2, 5, 25, 125]) for w in some_words(5, "abcdà", 600, 3, 7)}
    counts |= {"x" * k: 5**k for k in range(1, 9)} | {"kk" + "m" * 5_000: 3, "kk" + "m" * 5_001: 20}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    found = S.spelling_variants(words).collect()
    assert {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in found} == variants_by_brute_force(counts) and len(found) == len(counts)
    assert S.spelling_variants(words.limit(0)).count() == 0


def test_counts_with_planted_slips(documents):
    rng = random.Random(7)
    words = some_words(8, "abcé×Z", 40, 4, 8)
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(40)]
    rows = [*enumerate(texts), (None, texts[0]), (3, texts[3]), (77, None), (78, ""), (79, "BÉbébÉ_Ā" + "word" * 600_000 + " abcabc" * 5 + "ÖÖ"), (80, "abcabc, " * 300_000)]
    want = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 7 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    found = S.word_counts(documents(*rows, extra=", word string, n long"), slip=7).collect()
    assert {r.word: r.n for r in found} == {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
    assert S.word_counts(documents()).count() == 0
