"""Conversation repair: the cheapest edits that make the roles alternate, found by depth-first branch and bound."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom.llm.common import quoted
from navloom.session import cut_lineage

#: Costs of the edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Where a repaired conversation stands: nothing yet, after the system row, after a user row, after an assistant row.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ALL, ENDS = (NOTHING, SYSTEM, USER, ASSISTANT), (NOTHING, ASSISTANT)
#: What a row with this initial, an inserted row or a row with a new role leads to.
KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Codes of a row to be repaired: its initial, upper case where it is truncated; "x" must go, "o" has a role of no place.
GONE, OTHER = "x", "o"
#: Rows of a conversation that one search covers; longer ones are searched block by block for every place a block can end at.
BLOCK = 1024
NOT_BLANK, CUT_OFF = r"[^\x20\x09-\x0D]", r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"


def moves(code: str, state: int) -> list[tuple[int, str, int]]:
    """(cost, initial, next state) of the edits that use up a row."""
    out = [(DELETE, "D", state)]
    if code != GONE:
        more = TRUNCATED * code.isupper()
        kept = KEPT.get(code.lower(), {})
        if state in kept:
            out.append((KEEP + more, "K", kept[state]))
        out.append((REROLE + more, "R", NEXT[state]))
    return out


def suffix_bounds(codes: str, goals: tuple[int, ...]) -> list[list[float]]:
    """By row and state: no edits of the rows from there on that end in a goal cost less (all costs, no ties)."""
    infinite = float("inf")

    def inserted(bound: list[float]) -> list[float]:
        for _ in range(2):
            bound = [min(b, INSERT + bound[NEXT[s]]) for s, b in enumerate(bound)]
        return bound

    bounds = [inserted([0.0 if s in goals else infinite for s in ALL])]
    for code in reversed(codes):
        bounds.append(inserted([min(c + bounds[-1][t] for c, _, t in moves(code, s)) for s in ALL]))
    return bounds[::-1]


def search(codes: str, roots: dict[int, tuple[int, str]], goals: tuple[int, ...]) -> tuple[int, str, int] | None:
    """Cheapest (cost, audit, state) from any root (state: cost and audit so far) over all rows to a goal, ties ASCII-least.

    Depth first with an explicit stack.  A prefix is given up if its cost and its bound exceed the incumbent, or equal it and its
    audit cannot be smaller, or if another prefix came to the same row and state for less (cost, then audit); what is
    left when the stack is empty is optimal.  No audit of a node is the start of another of the same cost, since only
    inserted rows could lie between, so the order of prefixes is the order of whole audits.
    """
    bounds = suffix_bounds(codes, goals)
    best: tuple[int, str, int] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(cost, audit, 0, state) for state, (cost, audit) in roots.items()]
    stack.sort(key=lambda x: (x[0] + bounds[0][x[3]], x[1]), reverse=True)
    while stack:
        cost, audit, row, state = stack.pop()
        least = cost + bounds[row][state]
        if least == float("inf") or best and (least > best[0] or least == best[0] and audit > best[1][: len(audit)]):
            continue
        if reached.get((row, state), (cost, audit)) < (cost, audit):
            continue
        reached[row, state] = (cost, audit)
        if row == len(codes) and state in goals and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, state)
        onward = [(cost + INSERT, audit + "I", row, NEXT[state])]
        if row < len(codes):
            onward += [(cost + c, audit + edit, row + 1, t) for c, edit, t in moves(codes[row], state)]
        onward = [x for x in onward if (x[0], x[1]) < reached.get(x[2:], (float("inf"), ""))]
        stack += sorted(onward, key=lambda x: (x[0] + bounds[x[2]][x[3]], x[1]), reverse=True)
    return best


@lru_cache(maxsize=5_000)
def _short(codes: str) -> tuple[int, str]:
    return search(codes, {NOTHING: (0, "")}, ENDS)[:2]


def cheapest(codes: str) -> tuple[int, str]:
    """Cost and audit of a conversation.  Beyond a block, the search goes from block to block with one best prefix for each
    state, and what all of them start with is put aside, so time grows with the length."""
    if len(codes) <= BLOCK:
        return _short(codes)
    done: list[str] = []
    roots: dict[int, tuple[int, str]] = {NOTHING: (0, "")}
    for cut in range(0, len(codes), BLOCK):
        part, last = codes[cut : cut + BLOCK], cut + BLOCK >= len(codes)
        if last:
            cost, audit, _ = search(part, roots, ENDS)
            return cost, "".join(done) + audit
        found = [search(part, roots, (s,)) for s in ALL]
        alive = [f for f in found if f]
        low, high = min(f[1] for f in alive), max(f[1] for f in alive)
        same = next((k for k, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
        done.append(low[:same])
        roots = {s: (cost, audit[same:]) for cost, audit, s in alive}
    raise AssertionError


def steps_of(codes: str, audit: str) -> Iterator[tuple[str, list[str | None]]]:
    """For each row its edits, insertions before it first (the last row also has those at the end), and for each edit that leaves
    a row the new role (null: its own)."""
    row, state, edits, roles = 0, NOTHING, [], []
    for edit in audit:
        if row and edits and edits[-1] != "I" and row < len(codes):
            yield "".join(edits), roles
            edits, roles = [], []
        edits.append(edit)
        if edit in "IR":
            state = NEXT[state]
            roles.append(ROLE[state])
        elif edit == "K":
            state = KEPT[codes[row].lower()][state]
            roles.append(None)
        row += edit != "I"
    yield "".join(edits), roles


def _plans(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits of conversations whose rows come in order; of a conversation only a letter a row is held."""

    def planned(key: str | None, parts: list[str]) -> Iterator[pd.DataFrame]:
        codes = "".join(parts)
        steps = enumerate(steps_of(codes, cheapest(codes)[1]), 1) if codes else iter(())
        while some := list(islice(steps, 10_000)):
            yield pd.DataFrame({"key": key, "at": [at for at, _ in some], "edits": [e for _, (e, _) in some], "roles": [r for _, (_, r) in some]})

    key, parts, out = None, [], []
    for frame in frames:
        for now, part in frame.groupby("key", sort=False):
            if now != key:
                out += planned(key, parts) if len(parts) < 100 else ()
                if len(parts) >= 100:
                    yield from planned(key, parts)
                if len(out) > 1000:
                    yield pd.concat(out)
                    out = []
                key, parts = now, []
            parts.append("".join(part["code"]))
    if out:
        yield pd.concat(out)
    yield from planned(key, parts)


def key_of(conv: Column) -> Column:
    """The text that names a conversation; a null one has a name too."""
    return F.coalesce(F.concat(F.lit(":"), conv.cast("string")), F.lit(""))


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows of every conversation with the edits that repair it, one row for each distinct (conversation, turn, role, text).

    Columns: ``key`` (:func:`key_of` the conversation), ``conv``, ``at`` (place by turn, nulls first, then role and a hash of the text), ``turn`` (digits,
    empty: null), ``role``, ``text``, ``copies``, ``fault`` (first of blank, duplicate, truncated, or null; further copies of a blank row are blank, of
    any other duplicates), ``before`` (initial of the row before), ``edits`` (initials of Keep, Rerole, Delete, Insert: insertions before the
    row, the row, its copies; in the last row also the insertions at the end) and ``roles`` (for each edit but deletions the new role, null: its own).

    The roles that are left begin with at most one system row and then alternate between user and assistant, ending with the
    assistant, or nothing is left.  Equal rows are one row with a count, so a row that a third of the table repeats is reduced in
    every task.  Only a letter for each row goes through the search, one conversation after the other; texts meet their edits by key.

    Null role or text: one space, so the row has a role of no place, or is blank.  An empty role has no place either.  A null
    conversation is a conversation of its own.  Empty table: no rows.  Other columns are not read.
    """
    text = lambda c: F.coalesce(F.col(quoted(c)).cast("string"), F.lit(" "))
    conv, turn = F.col(quoted(conv_col)), F.col(quoted(turn_col)).cast("long")
    told = rows.select(key_of(conv).alias("key"), conv.alias("conv"), turn.alias("number"), F.coalesce(turn.cast("string"), F.lit("")).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    told = told.withColumn("said", F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text")))
    one = ["key", "turn", "said"]
    fault = F.when(~F.col("text").rlike(NOT_BLANK), "blank").when(F.col("text").rlike(CUT_OFF), "truncated")
    skeleton = told.groupBy(*one, "number", "role", fault.alias("fault")).agg(F.count(F.lit(1)).alias("copies"))
    order = Window.partitionBy("key").orderBy(F.col("number").asc_nulls_first(), "role", "said")
    initial = F.substring("role", 1, 1)
    numbered = cut_lineage(skeleton.select(*one, "copies", "fault", initial.alias("initial"), F.row_number().over(order).cast("long").alias("at"), F.lag(initial).over(order).alias("before")))
    first = numbered.groupBy("key", "said").agg(F.min("at").alias("first"))
    fault = F.when((F.col("at") > F.col("first")) & ~F.col("fault").eqNullSafe("blank"), "duplicate").otherwise(F.col("fault"))
    marked = cut_lineage(numbered.join(first, ["key", "said"]).withColumn("fault", fault).drop("first"))
    letter = F.when(F.col("initial").isin(*KEPT), F.col("initial")).otherwise(OTHER)
    letter = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    # a letter a row is so few bytes that adaptive execution would search all conversations in one task; an explicit count is left alone
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    codes = marked.select("key", "at", letter.alias("code")).repartition(parts, "key").sortWithinPartitions("key", "at")
    plans = codes.select("key", "code").mapInPandas(_plans, "key string, at long, edits string, roles array<string>")
    planned = marked.drop("initial").join(plans, ["key", "at"])
    texts = told.groupBy(*one).agg(*[F.first(c).alias(c) for c in ("conv", "role", "text")])
    found = texts.join(planned, one)
    own = F.regexp_extract("edits", "^I*[KRD]", 0)
    copies = F.repeat(F.lit("D"), (F.col("copies") - 1).cast("int"))
    edits = F.concat(own, copies, F.substr(F.col("edits"), F.length(own) + 1))
    return found.select("key", "conv", "at", "turn", "role", "text", "copies", "fault", "before", edits.alias("edits"), "roles")


def messages(repaired: DataFrame) -> DataFrame:
    """The repaired conversations: ``key``, ``conv``, ``at`` and ``step`` (their order), ``edit``, ``role``, ``text``."""
    left = F.filter(F.split("edits", ""), lambda e: e.isin("K", "R", "I"))
    rows = repaired.select("*", F.posexplode(F.arrays_zip(left.alias("edit"), F.col("roles").alias("role"))).alias("step", "m"))
    return rows.select("key", "conv", "at", "step", "m.edit", F.coalesce("m.role", "role").alias("role"), F.when(F.col("m.edit") == "I", "").otherwise(F.col("text")).alias("text"))


def reports(repaired: DataFrame) -> DataFrame:
    """One row per conversation: ``key``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.

    Rows stream through in order; a task holds a batch of them and the audit.  A SHA-256 has to see a conversation's text in one
    go, so all rows of one conversation pass through one task, but never stand in its memory together.
    """
    costs = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, out = None, []

        def closed() -> dict:
            audit = "".join(edits)
            whole = sum(costs[e] * audit.count(e) for e in costs)
            gaps = max(0, high - low + 1 - turns) if turns else 0
            return {"key": key, "gaps": min(gaps, 2**63 - 1)} | count | {"cost": whole + kept_cut, "audit": audit, "repaired_sha256": sha.hexdigest()}

        for frame in frames:
            for now, turn, role, text, copies, fault, before, steps, roles in frame.itertuples(index=False):
                if now != key:
                    if key is not None:
                        out.append(closed())
                    key, sha, edits, kept_cut, written = now, hashlib.sha256(), [], 0, False
                    low, high, turns, count = 0, 0, 0, dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
                if turn:
                    t = int(turn)
                    low, turns = (low, turns + (t != high)) if turns else (t, 1)
                    high = t
                count["blank" if fault == "blank" else "duplicate"] += copies - 1
                if isinstance(fault, str):
                    count[fault] += 1
                count["illegal"] += (copies - 1) + (isinstance(before, str) and before + role[:1] not in ("su", "ua", "au"))
                edits.append(steps)
                left = [e for e in steps if e != "D"]
                kept_cut += TRUNCATED * (fault == "truncated" and left.count("I") < len(left))
                for edit, new in zip(left, roles):
                    line = f"{role if new is None else new}:{'' if edit == 'I' else text}"
                    sha.update(("\n" * written + line).encode("utf-8", "surrogatepass"))
                    written = True
            if len(out) > 5000:
                yield pd.DataFrame(out)
                out = []
        if key is not None:
            out.append(closed())
        if out:
            yield pd.DataFrame(out)

    rows = repaired.repartition("key").sortWithinPartitions("key", "at")
    rows = rows.select("key", "turn", "role", "text", "copies", "fault", "before", "edits", "roles")
    return rows.mapInPandas(stream, "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
