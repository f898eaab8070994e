"""Conversation repair, centroid clustering and syncmer fingerprints against brute force, and on odd rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from loomwork.llm import centroids, conversations, fingerprints

# --- conversation repair -------------------------------------------------------------------------------------------


def brute_repair(roles, texts):
    """Every edit script of cost at most all-deleted, searched exhaustively; least (cost, audit) wins."""
    n = len(roles)
    fault = conversations.faults(roles, texts)
    limit = 3 * n + 4
    best = [None]

    def walk(i, q, cost, audit, out, inserts_in_a_row):
        if cost > limit or inserts_in_a_row > 3:
            return
        if i == n and q in (0, 3):
            key = (cost, audit)
            if best[0] is None or key < best[0][0]:
                best[0] = (key, list(out))
        for r in ("u", "a"):
            if (q, r) in conversations.STEP:
                walk(i, conversations.STEP[(q, r)], cost + 2, audit + "I", out + [f"{conversations.NAMES[r]}:"], inserts_in_a_row + 1)
        if i == n:
            return
        walk(i + 1, q, cost + 3, audit + "D", out, 0)
        if fault[i] in ("blank", "duplicate"):
            return
        extra = 1 if fault[i] == "truncated" else 0
        init = roles[i][:1]
        if (q, init) in conversations.STEP:
            walk(i + 1, conversations.STEP[(q, init)], cost + extra, audit + "K", out + [f"{roles[i]}:{texts[i]}"], 0)
        for r in ("u", "a"):
            if (q, r) in conversations.STEP:
                walk(i + 1, conversations.STEP[(q, r)], cost + 2 + extra, audit + "R", out + [f"{conversations.NAMES[r]}:{texts[i]}"], 0)

    walk(0, 0, 0, "", [], 0)
    (cost, audit), out = best[0]
    return cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def test_repair_matches_brute_force():
    rng = random.Random(7)
    pool_roles = ["user", "assistant", "system", "tool", " ", ""]
    pool_texts = ["Hello.", "Hi", "", "  ", "Sure!", "Why?", "ok ", "Hello."]
    for _ in range(300):
        n = rng.randint(0, 4)
        roles = [rng.choice(pool_roles) for _ in range(n)]
        texts = [rng.choice(pool_texts) for _ in range(n)]
        import pandas as pd

        frame = pd.DataFrame({"conv_id": [1] * n, "turn": list(range(n)), "role": roles, "text": texts, "gone": [False] * n})
        got = conversations.repair_one(frame)
        if n == 0:
            assert (got["cost"], got["audit"], got["repaired_sha256"]) == (0, "", conversations.EMPTY_SHA)
            continue
        assert (got["cost"], got["audit"], got["repaired_sha256"]) == brute_repair(roles, texts), (roles, texts)


def test_faults_first_one_counts():
    roles = ["user", "user", "user", "assistant", "user"]
    texts = ["  ", "Hello.", "Hello.", "no end", "  "]
    assert conversations.faults(roles, texts) == ["blank", "", "duplicate", "truncated", "blank"]


def dropped_turn(conv_id):
    turn = 0
    while zlib.crc32(f"{conv_id}:{turn}".encode()) % 20 != 0:
        turn += 1
    return turn


def test_repair_on_odd_rows(spark):
    gone = dropped_turn(5)
    rows = [
        (1, 0, "user", "Hello there.", "x"), (1, 1, "assistant", None, "x"), (1, None, None, "What?", "x"),
        (None, 0, "user", "Nameless.", "x"), (None, 1, "assistant", "Yes.", "x"),
        (2, 0, "user", "Again.", "x"), (2, 0, "user", "Again.", "x"), (2, 5, "assistant", "x" * 100_000, "x"),
        (5, gone, "user", "Only row.", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, cost string")
    out = {r["conv_id"]: r for r in conversations.repair_damaged(df).collect()}
    assert set(out) == {1, None, 2, 5}
    assert out[5]["cost"] == 0 and out[5]["audit"] == "" and out[5]["repaired_sha256"] == conversations.EMPTY_SHA
    assert out[2]["gaps"] == 4
    assert conversations.repair_damaged(df.limit(0)).count() == 0
    # the Spark damage rule agrees with a plain one
    local = []
    for c, t, r, x, _ in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r if r is not None else " ", x if x is not None else " "
        if code == 0:
            continue
        r = "user" if code == 4 else r
        x = "" if code == 1 else re.sub(r"[.!?]", "", x) if code == 2 else x
        local += [(c, t, r, x)] * (2 if code == 3 else 1)
    got = sorted(((r["conv_id"] or -1, r["turn"] or -1, r["role"], r["text"]) for r in conversations.damaged(df).where("NOT gone").collect()))
    assert got == sorted(((c or -1, t or -1, r, x) for c, t, r, x in local))


# --- centroid clustering -------------------------------------------------------------------------------------------


def brute_cluster(ids, vectors, k=40, rounds=5):
    keep = [i for i, v in enumerate(vectors) if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    pts = np.array([[math.floor(256 * float(x)) for x in vectors[i]] for i in keep], dtype=np.int64)
    kid = [ids[i] for i in keep]
    order = sorted(range(len(keep)), key=lambda i: (kid[i] is None, hashlib.sha256(f"2:{kid[i]}".encode()).hexdigest() if kid[i] is not None else "", list(pts[i])))[:k]
    cen = pts[order].copy()

    def assign(c):
        d = ((pts[:, None, :] - c[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        a, _ = assign(cen)
        for j in range(len(cen)):
            if (a == j).any():
                cen[j] = np.floor_divide(pts[a == j].sum(0), (a == j).sum())
    a, d = assign(cen)
    return sorted(zip([x if x is not None else -1 for x in kid], a.tolist(), d.tolist()))


def test_clusters_match_brute_force(spark):
    rng = np.random.default_rng(3)
    ids, vecs = [], []
    for i in range(300):
        ids.append(i)
        vecs.append([float(x) for x in rng.normal(0, 0.3, 64).astype(np.float32)])
    vecs[5] = vecs[6]  # ties of distance
    ids += [300, 301, 302, 303, 7, None]
    vecs += [None, [0.1] * 63, [0.1] * 63 + [None], [0.1] * 63 + [float("nan")], vecs[7], [0.2] * 64]
    df = spark.createDataFrame(list(zip(ids, vecs, ["clash"] * len(ids))), "vec_id long, embedding array<float>, cluster string")
    got = sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["cluster"], r["distance"]) for r in centroids.cluster(df).collect())
    f32 = [None if v is None else [None if x is None else float(np.float32(x)) for x in v] for v in vecs]
    assert got == brute_cluster(ids, f32)


def test_cluster_small_and_empty(spark):
    df = spark.createDataFrame([(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.5] * 64)], "vec_id long, embedding array<double>")
    rows = centroids.cluster(df).collect()
    assert len(rows) == 3 and all(r["distance"] == 0 for r in rows) and rows[0]["inertia"] == 0
    assert centroids.cluster(df.limit(0)).count() == 0


# --- syncmer fingerprints ------------------------------------------------------------------------------------------


def test_fingerprints_match_python(spark):
    long = " ".join(f"w{i % 53}" for i in range(30_000))
    rows = [(3, "a b c d e f g h i j k l m n o p q r s t."), (1, None), (2, ""), (4, "   "), (5, "short text"), (6, long),
            (6, long), (None, "nameless text here"), (7, "a b c d e f g h i j k l m n o p q r s t.")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fingerprint string")
    got = fingerprints.fingerprint_documents(df).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[3][0]["fingerprint"] == by[7][0]["fingerprint"] != ""
    assert by[6][0]["fingerprint"] == by[6][1]["fingerprint"]
    assert by[1][0]["fingerprint"] == "" and by[2][0]["fingerprint"] == "" and by[4][0]["fingerprint"] == ""
    assert len(by[5][0]["fingerprint"].split()) == 1
    # edits: ascending doc_id, nulls last, the last followed by the first
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    texts = [t or "" for _, t in order]
    for i, (d, t) in enumerate(order):
        t = t or ""
        nxt = texts[(i + 1) % len(texts)]
        cut = len(t) // 4
        edited = t[:len(t) - cut] + nxt[:cut]
        assert any(r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() for r in by[d])
    assert all(0.0 <= r["near_edited"] <= 1.0 and 0.0 <= r["near_next"] <= 1.0 for r in got)
    assert by[1][0]["near_edited"] == 1.0  # empty text, empty edit


def test_syncmers_are_closed_and_context_free(spark):
    words = [f"t{(i * 7919) % 101}" for i in range(400)]
    text = " ".join(words)
    inner = " ".join(words[100:300])
    df = spark.createDataFrame([(1, text), (2, inner)], "doc_id long, text string")
    out = df.select("doc_id", fingerprints.anchors(df["text"]).alias("a")).collect()
    a = {r["doc_id"]: r["a"] for r in out}
    # every anchor of the inner passage that lies wholly inside it is an anchor of the whole text
    assert set(a[2]) <= set(a[1])
    # closed syncmers are a part of all k-mers, about 2 / (K - S + 1)
    assert 0 < len(a[1]) < len(words) - fingerprints.K + 1


def test_fingerprints_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fingerprints.fingerprint_documents(df).count() == 0


# --- n-gram Jaccard join with repeated ids ---------------------------------------------------------------------------


def test_jaccard_keeps_links_of_repeated_ids(spark):
    from loomwork.llm import jaccard

    words = " ".join(f"w{i}" for i in range(60))
    a = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(1, a), (5, a), (5, words), (7, words + " extra"), (9, None), (9, words.replace("w1 ", "w1x ")), (3, "lonely text here only"),
            (12, "x y"), (12, "x y"), (20, "p q r s t u v w"), (40, "p q r s t u v w")]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(
        spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, _gone string")).collect()}

    def sets(text):
        w = (text or "").lower().split()
        return set() if not w else ({" ".join(w)} if len(w) < 3 else {" ".join(w[i:i + 3]) for i in range(len(w) - 2)})

    parent = {d: d for d, _ in rows}  # keyed by id: rows of one id are one vertex

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (d1, t1), (d2, t2) in [(p, q) for i, p in enumerate(rows) for q in rows[i + 1:]]:
        s1, s2 = sets(t1), sets(t2)
        if d1 != d2 and s1 and s2 and 100 * len(s1 & s2) >= 90 * len(s1 | s2):
            parent[max(find(d1), find(d2))] = min(find(d1), find(d2))
    want = {(d, len(sets(t)), find(d)) for d, t in rows}
    assert got == want


def test_jaccard_sends_copies_once_and_no_texts(spark):
    """Copies in several tasks are one class without any shuffle of the texts."""
    from loomwork.llm import jaccard

    words = " ".join(f"w{i}" for i in range(60))
    rows = [(i, words) for i in range(40)] + [(100, words + " extra")]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), "doc_id long, text string")
    sent = jaccard.sent_elements(docs, 3, 1, 4)
    assert "Exchange" not in sent._jdf.queryExecution().toString()
    senders = [np.frombuffer(r["ids"], np.int64) for r in sent.collect()]
    assert max(len(s) for s in senders) <= 2  # a task sends a class once
    shared = jaccard.shared_elements(sent, 4).collect()
    assert {int(c) for r in shared for c in np.frombuffer(r["counts"], np.int64)} == {2}  # two classes, whoever sent them
    assert sum(len(r["keys"]) // 8 for r in shared) == 2 * 58
    got = jaccard.similar_components(docs.union(docs), 3, 90).collect()
    assert len(got) == 82 and {(r["doc_id"], r["component_id"]) for r in got} == {(i, 0) for i in [*range(40), 100]}
