"""Conversation repair against a search over all edits, and rows, counts and hashes against plain Python."""

import hashlib
import heapq
import random

import pytest
from navloom.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"


def by_all_edits(codes):
    """Cheapest (cost, audit) in the order in which a uniform-cost search meets them."""
    heap, seen = [(0, "", 0, C.NOTHING)], set()
    while heap:
        cost, audit, row, state = heapq.heappop(heap)
        if row == len(codes) and state in C.ENDS:
            return cost, audit
        if (row, state) not in seen:
            seen.add((row, state))
            heapq.heappush(heap, (cost + 2, audit + "I", row, C.NEXT[state]))
            for c, edit, after in C.moves(codes[row], state) if row < len(codes) else ():
                heapq.heappush(heap, (cost + c, audit + edit, row + 1, after))


@pytest.mark.parametrize("block", [1024, 3])
def test_search_is_optimal(monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    rng = random.Random(1)
    for n in range(9):
        for _ in range(150):
            codes = "".join(rng.choice("suaoxSUAO") for _ in range(n))
            cost, audit = C.cheapest(codes)
            assert (cost, audit) == by_all_edits(codes), codes
            steps = list(C.steps_of(codes, audit)) if codes else []
            assert "".join(e for e, _ in steps) == audit and len(steps) == n


def test_prefixes_are_given_up_with_weak_bounds_too(monkeypatch):
    """Without bounds, dominance and the incumbent alone lead to the same edits."""
    rng = random.Random(2)
    some = ["".join(rng.choice("suaoxSUAO") for _ in range(7)) for _ in range(60)]
    want = [C.search(c, {C.NOTHING: (0, "")}, C.ENDS)[:2] for c in some]
    monkeypatch.setattr(C, "suffix_bounds", lambda codes, goals: [[0.0] * 4 for _ in range(len(codes) + 1)])
    assert [C.search(c, {C.NOTHING: (0, "")}, C.ENDS)[:2] for c in some] == want


def test_long_conversations_take_time_in_proportion():
    assert C.cheapest("ua" * 30_000) == (0, "K" * 60_000)
    assert C.cheapest("o" * 30_001) == (60_003, "D" + "R" * 30_000)


def by_hand(rows):
    """Report of one conversation in plain Python."""
    rows = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for _, t, r, x in rows), key=lambda r: (r[:3], hashlib.md5(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).hexdigest()))
    blanks = " \t\n\x0b\x0c\r"
    faults, seen, codes = [], set(), ""
    for _, _, role, text in rows:
        bare = text.strip(blanks)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        letter = role[:1] if role[:1] in tuple("sua") else "o"
        codes += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
    cost, audit = by_all_edits(codes)
    lines, row, state = [], 0, C.NOTHING
    for edit in audit:
        if edit in "IR":
            state = C.NEXT[state]
            lines.append(f"{C.ROLE[state]}:{'' if edit == 'I' else rows[row][3]}")
        elif edit == "K":
            state = C.KEPT[rows[row][2][0]][state]
            lines.append(f"{rows[row][2]}:{rows[row][3]}")
        row += edit != "I"
    turns = {r[1] for r in rows if r[0]}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    count = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def test_reports_and_messages(spark):
    rng = random.Random(3)
    texts = ["Yes.", "No!", "Why", "", " \n", None, "a" * 50_000 + "?", "Yes.", "café  ", "x.  "]
    roles = ["user", "user", "assistant", "assistant", "system", None, "", "tool", "usher"]
    rows = [(c, rng.choice([None, *range(6), 2**62]), rng.choice(roles), rng.choice(texts)) for c in [None, *range(40)] for _ in range(rng.randrange(1, 9))]
    rows += rows[:20] + [(99, 1, "user", "Hi.")] * 50 + [(98, -5, "user", "Hi."), (98, 5, "assistant", "Ho.")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", at int, key string").repartition(5)
    repaired = C.repair_conversations(df)
    groups = {}
    for r in rows:
        groups.setdefault("" if r[0] is None else f":{r[0]}", []).append(r)
    want = {k: by_hand(v) for k, v in groups.items()}
    assert {r.key: tuple(r)[1:] for r in C.reports(repaired).collect()} == {k: w for k, (w, _) in want.items()}
    lines = {}
    for m in C.messages(repaired).orderBy("key", "at", "step").collect():
        lines.setdefault(m.key, []).append(f"{m.role}:{m.text}")
    assert lines == {k: v for k, (_, v) in want.items() if v}
    assert len(rows) == sum(r.copies for r in repaired.collect())


def test_no_rows(spark):
    assert C.reports(C.repair_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
