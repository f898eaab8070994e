"""Conversation structure repair: cheapest edits to a legal role sequence, least audit by prefix-doubling path ranking.

Damage (for tests and audits of the repair itself) is a per-row rule in Spark functions. Repair works on each
conversation's rows ordered by turn (nulls first; ties by role, then text). Each row has at most one fault, the first
that applies: blank (no ``[^\\x20\\x09-\\x0D]``), duplicate (same role and text as an earlier row), truncated (last such
character not one of ``.!?``). The target is a role-initial sequence of ``(s?(ua)+)?``; edits are Keep (0), Rerole to
user/assistant (2), Delete (3, required for blank and duplicate rows) and Insert of an empty user/assistant row (2);
a truncated row that is not deleted adds 1.

Method. Nodes are (row position, automaton state) of the target's four-state automaton; each edit is an arc labelled by
its initial (D < I < K < R). A backward DP gives every node its cheapest cost to the end; an arc is optimal when its cost
plus its head's cost equals its tail's. A label fixes an arc's head (the role a Rerole or Insert gives is forced by the
state), so following the least optimal label from every node yields the least audit: every node gets one pointer.
Pointers are doubled (2^j steps) and each node is ranked by its distance to the end, the sum over doubled jumps; the
source's path is read off by the same doubled pointers, so its audit and repaired rows come in order.

Scale. Damage, nulls and counts are Spark columns; the sequential part (order inside one conversation, its DP and the
sha256 chain of its repaired text) runs in one Arrow pass over partitions dealt by conv_id and sorted inside: a single
conversation is walked by a single task (its rows and texts are in memory once); conversations are dealt over all tasks.

Defined cases: null text or role is one space (so a null role is illegal everywhere and must be rerolled or deleted; a
null text is blank); a null conv_id is a conversation of its own; a conversation whose rows were all dropped gives zeros,
an empty audit and the sha256 of the empty string; repeated rows are duplicates after the first; any extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_schema

MODULUS = 20
SPACE = " "
BLANK = re.compile(r"[^\x20\x09-\x0D]")
ENDS = ".!?"
# fixed values of the task: edit costs, their initials in ASCII order, and the roles an edit can give
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LABELS = "DIKR"
NAMES = {"u": "user", "a": "assistant"}
# automaton of (s?(ua)+)?: state 0 start, 1 after s, 2 after u, 3 after a; 0 and 3 accept
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FORCED = {0: "u", 1: "u", 2: "a", 3: "u"}
ACCEPT = (0, 3)
INF = float("inf")
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def damage_code(conv_id: Column, turn: Column) -> Column:
    """crc32 of ``conv_id:turn`` (a null part is one space) modulo 20."""
    key = F.concat(F.coalesce(conv_id.cast("string"), F.lit(SPACE)), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(SPACE)))
    return (F.crc32(key) % MODULUS).cast("int")


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): 0 drops (kept as a ``gone`` marker so the conversation is still seen), 1
    empties the text, 2 removes ``.!?``, 3 repeats the row, 4 sets the role to user; nulls are one space first."""
    code = damage_code(F.col("conv_id"), F.col("turn"))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role"), F.lit(SPACE)).alias("role"), F.coalesce(F.col("text"), F.lit(SPACE)).alias("text"),
        code.alias("code"))
    rows = rows.select(
        "conv_id", "turn",
        F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.regexp_replace("text", r"[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("code") == 0).alias("gone"), F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


def faults(roles: list[str], texts: list[str]) -> list[str]:
    """Each row's first fault: ``blank``, ``duplicate``, ``truncated`` or ``""``."""
    seen, out = set(), []
    for role, text in zip(roles, texts):
        marks = BLANK.findall(text)
        if not marks:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif marks[-1] not in ENDS:
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


def arcs(i: int, q: int, n: int, initials: list[str], fault: list[str]):
    """(label, cost, head node, emitted role initial or None) of every edit from node (i, q)."""
    out = []
    for r in ("u", "a"):
        if STEP.get((q, r)) is not None:
            out.append(("I", INSERT, (i, STEP[(q, r)]), r))
    if i < n:
        out.append(("D", DELETE, (i + 1, q), None))
        if fault[i] not in ("blank", "duplicate"):
            extra = TRUNCATED if fault[i] == "truncated" else 0
            if (q, initials[i]) in STEP:
                out.append(("K", KEEP + extra, (i + 1, STEP[(q, initials[i])]), initials[i]))
            forced = FORCED[q]
            out.append(("R", REROLE + extra, (i + 1, STEP[(q, forced)]), forced))
    return out


def arc_table(n: int, initials: list[str], fault: list[str]) -> list[list[list]]:
    """The arcs of every node, listed once."""
    return [[arcs(i, q, n, initials, fault) for q in range(4)] for i in range(n + 1)]


def cheapest(n: int, table: list[list[list]]) -> np.ndarray:
    """Cost to the end of every node (n + 1 layers x 4 states): backward over rows, inserts relaxed inside a layer."""
    cost = np.full((n + 1, 4), INF)
    for q in ACCEPT:
        cost[n, q] = 0.0
    for i in range(n, -1, -1):
        for q in range(4):
            for label, c, (j, h), _ in table[i][q]:
                if j == i + 1:
                    cost[i, q] = min(cost[i, q], c + cost[j, h])
        for _ in range(4):  # insert arcs inside the layer have positive costs: four relaxations settle them
            for q in range(4):
                for label, c, (j, h), _ in table[i][q]:
                    if j == i:
                        cost[i, q] = min(cost[i, q], c + cost[j, h])
    return cost


def least_path(n: int, table: list[list[list]], cost: np.ndarray) -> list[tuple[str, int, str | None]]:
    """(label, row, emitted initial) along the least optimal path from (0, 0), read by doubled pointers."""
    nodes = (n + 1) * 4
    pointer = np.arange(nodes)
    chosen: dict[int, tuple[str, int, str | None]] = {}
    for i in range(n + 1):
        for q in range(4):
            v = i * 4 + q
            if i == n and q in ACCEPT:
                continue  # the end: the empty rest is the least
            best = None
            for label, c, (j, h), emit in table[i][q]:
                if cost[i, q] < INF and abs(c + cost[j, h] - cost[i, q]) < 1e-9 and (best is None or label < best[0]):
                    best = (label, j * 4 + h, emit)
            if best:
                pointer[v] = best[1]
                chosen[v] = (best[0], i, best[2])
    # rank every node by its distance to the end with doubled pointers
    jump, dist = pointer.copy(), (pointer != np.arange(nodes)).astype(np.int64)
    tables = [jump.copy()]
    while True:
        dist2 = dist + dist[jump]
        jump2 = jump[jump]
        if np.array_equal(jump2, jump):
            break
        jump, dist = jump2, dist2
        tables.append(jump.copy())
    length = int(dist[0])
    # the t-th node of the source's path: jump t steps by its binary digits
    steps = np.arange(length)
    at = np.zeros(length, dtype=np.int64)
    for bit, table in enumerate(tables):
        take = (steps >> bit) & 1 == 1
        at[take] = table[at[take]]
    return [chosen[int(v)] for v in at]


def repair_rows(turns: list, roles: list[str], texts: list[str]) -> dict:
    """The repair of one conversation's rows, already in order (turn nulls first, role, text)."""
    known = [t for t in turns if t is not None]
    gaps = int(max(known) - min(known) + 1 - len(set(known))) if known else 0
    n = len(roles)
    if n == 0:
        return dict(gaps=gaps, blank=0, duplicate=0, truncated=0, illegal=0, cost=0, audit="", repaired_sha256=EMPTY_SHA)
    fault = faults(roles, texts)
    initials = [r[:1] for r in roles]
    illegal = sum(1 for a, b in zip(initials, initials[1:]) if a + b not in ("su", "ua", "au"))
    table = arc_table(n, initials, fault)
    cost = cheapest(n, table)
    path = least_path(n, table, cost)
    lines = []
    for label, i, emit in path:
        if label == "K":
            lines.append(f"{roles[i]}:{texts[i]}")
        elif label == "R":
            lines.append(f"{NAMES[emit]}:{texts[i]}")
        elif label == "I":
            lines.append(f"{NAMES[emit]}:")
    return dict(gaps=gaps, blank=fault.count("blank"), duplicate=fault.count("duplicate"), truncated=fault.count("truncated"),
                illegal=illegal, cost=int(cost[0, 0]), audit="".join(p[0] for p in path),
                repaired_sha256=hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest())


def repair_one(conv: pd.DataFrame) -> dict:
    """The same from an unordered frame of (turn, role, text, gone), for small checks."""
    rows = conv[~conv["gone"].astype(bool)].copy()
    rows["null_turn"] = rows["turn"].isna()
    rows = rows.sort_values(["null_turn", "turn", "role", "text"], ascending=[False, True, True, True], kind="stable")
    turns = [None if pd.isna(t) else int(t) for t in rows["turn"]]
    return repair_rows(turns, rows["role"].tolist(), rows["text"].tolist())


RESULT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
          ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation of (conv_id, turn, role, text, gone): conv_id and the repair's counts, cost, audit and hash.

    Rows are dealt by conv_id and sorted inside the partitions by (conv_id, turn nulls first, role, text); one Arrow
    pass then walks each partition's conversations in order as plain lists.
    """
    kind = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind)] + [T.StructField(name, from_arrow_type(t)) for name, t in RESULT])
    ordered = rows.select("conv_id", "turn", "role", "text", "gone").repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {name: [] for name in ["conv_id"] + [n for n, _ in RESULT]}
        current, turns, roles, texts = None, [], [], []
        started = False

        def flush():
            found = repair_rows(turns, roles, texts)
            out["conv_id"].append(current)
            for name, _ in RESULT:
                out[name].append(found[name])

        for batch in batches:
            ids, ts, rs, xs, gone = (batch.column(i).to_pylist() for i in range(5))
            for c, t, r, x, g in zip(ids, ts, rs, xs, gone):
                if not started or c != current:
                    if started:
                        flush()
                    current, turns, roles, texts, started = c, [], [], [], True
                if not g:
                    turns.append(t)
                    roles.append(r)
                    texts.append(x)
            if len(out["conv_id"]) >= 4096:
                yield pa.RecordBatch.from_pydict(out, schema=to_arrow_schema(schema))
                out = {name: [] for name in out}
        if started:
            flush()
        if out["conv_id"]:
            yield pa.RecordBatch.from_pydict(out, schema=to_arrow_schema(schema))

    return ordered.mapInArrow(run, schema)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The damage rule, then the repair: one row per original conv_id."""
    return repair(damaged(conversations))
