"""The corpus operators against brute force, and on nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.llm import (
    components, contamination, jaccard, language, lines, mixing, packing, privacy, quality, suffixes, tokens, toxicity,
)
from loomwork.llm.common import held_out
from loomwork.session import fresh_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, n_lines string"
LINE = "This line is long enough to be a key of its own"


def odd_rows():
    prose = " ".join(f"word{i % 97}" for i in range(30_000))
    rows = [
        (1, f"{LINE}\nfirst", "en", "a"), (2, f"  {LINE.upper()}\t\nsecond", "en", "a"), (3, f"{LINE}\n{LINE}\nthird", "de", None),
        (4, None, None, None), (5, "", "en", "b"), (None, f"{LINE}\nnameless", "en", "b"), (7, "1234 567", "en", "b"),
        (8, prose, "fr", "c"), (9, prose, "fr", "c"), (9, prose, "fr", "c"), (10, "ein kurzer Satz", "de", "c"), (11, "ein kurzer Satz", "de", "c"),
    ]
    return [(*r, len(r[1] or ""), 9.5, "clash", "clash") for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def benchmark_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_language_on_odd_rows(spark, odd, none):
    model = language.fit(odd)
    rows = language.identify(odd, model).collect()
    assert len(rows) == 12 and set(rows[0].asDict()) == {*odd.columns, "lang_pred"}
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (4, 5, 7))
    assert all(0 <= r.score <= 1 for r in rows)
    assert language.identify(none, language.fit(none)).count() == 0
    assert {r.lang_pred for r in language.identify(odd, language.fit(none)).collect()} == {"und"}
    assert language.keep_known(odd, model).columns == odd.columns


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs.where(~held_out(F.col("doc_id"))))
    rows = language.identify(docs.where(held_out(F.col("doc_id"))), model).select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_presence_of_pieces_is_that_of_the_whole(monkeypatch):
    text = "".join(random.Random(1).choice("abcdé ") for _ in range(500))
    whole = language.presence(text)
    monkeypatch.setattr(language, "PIECE", 37)
    assert (language.presence(text) == whole).all()


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_token_scan_stitches_blocks(spark, block):
    rng = random.Random(block)
    files = {0: [], 1: [9], 2: [7, 7, 9, 9, 8], 3: [rng.choice([1, 2, 3, 9]) for _ in range(200)] + [5]}
    rows = [(f, i // block, np.array(ids[i:i + block], np.uint16).tobytes()) for f, ids in files.items() for i in range(0, len(ids), block)]
    blocks = spark.createDataFrame(rows, "file int, block long, data binary")
    expected = set()
    for f, ids in files.items():
        parts, part = [], 0
        for i in ids:
            if i == 9:
                parts.append((part, True))
                part = 0
            else:
                part += 1
        expected |= {(f, k, *p) for k, p in enumerate(parts + ([(part, False)] if part else []))}
    got = {tuple(r) for r in tokens.count_tokens(blocks, separator=9).select("file", "ordinal", "n_tokens", "closed").collect()}
    assert got == expected


def test_tokens_of_odd_rows_and_raw_files(spark, odd, none, tmp_path):
    encode = tokens.encoder(open(tokens.VOCABULARY, "rb").read()).encode_ordinary
    texts = [(r[0], r[1]) for r in odd_rows()] + [(20, "<|endoftext|> spelled out")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_tokens) for r in tokens.document_tokens(docs, fresh_path(spark, "t")).collect())
    assert got == sorted((i or -1, len(encode(t or ""))) for i, t in texts)
    assert tokens.document_tokens(none, fresh_path(spark, "t")).count() == 0
    (tmp_path / "a.bin").write_bytes(np.array([4, 4, 9, 9, 4], "<u4").tobytes())
    raw = tokens.count_tokens(tokens.read_blocks(spark, str(tmp_path), width=4, block=2), separator=9, width=4)
    assert sorted((r.ordinal, r.n_tokens, r.closed) for r in raw.collect()) == [(0, 2, True), (1, 0, True), (2, 1, False)]


def filled(sizes, share=1.5):
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        rest = budget - sum(target.values())
        over = [s for s in free if rest * weight[s] / sum(weight[x] for x in free) > 2 * sizes[s]]
        if not over:
            return target | {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        for s in over:
            target[s] = 2.0 * sizes[s]
        free -= set(over)
    return target


def test_mix_meets_targets_and_repeats_itself(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(["a"] * 12 + ["b", "b", "c", "é", None])) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs, block_words=16)
    got = mixed.collect()
    assert len(got) == 900
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    target, taken, spans = filled(sizes), {}, {}
    for r in got:
        assert r.size == len(rows[r.doc_id][1].split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        words = sum(p.words for p in r.pieces)
        assert words <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + words
        for p in r.pieces:
            spans.setdefault((r.doc_id, p.epoch), []).append((p.first, p.first + p.words))
    for source in sizes:
        assert taken[source] == pytest.approx(target[source], rel=0.01, abs=4)
    for parts in spans.values():  # disjoint within a pass
        parts.sort()
        assert all(a[1] <= b[0] for a, b in zip(parts, parts[1:]))
    again = mixing.mix(docs.repartition(5), block_words=16)
    assert {(r.doc_id, str(r.pieces)) for r in again.collect()} == {(r.doc_id, str(r.pieces)) for r in got}
    text = mixing.shard_rows(docs, mixed).agg(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert text == sum(taken.values())


def test_tree_splits_quotas_exactly(spark):
    quotas = spark.createDataFrame([(1, 1000), (2, 0), (3, 77), (4, 1)], "source_no int, quota long")
    starts = {r.source_no: r.starts for r in mixing.splitting_tree(quotas, 8).collect()}
    for no, quota in ((1, 1000), (2, 0), (3, 77), (4, 1)):
        assert len(starts[no]) == 8 and starts[no] == sorted(starts[no]) and starts[no][0] == 0 and starts[no][-1] <= quota
    whole = [sum(b - a for b, a in zip([*s[1:], q], s)) for s, q in ((starts[1], 1000), (starts[3], 77))]
    assert whole == [1000, 77]


def test_hypergeometric_draws_have_the_right_law(spark):
    frame = spark.range(4000).select(mixing.hypergeometric(F.lit(60), F.lit(25), F.lit(20), mixing.uniform(F.col("id"))).alias("x"))
    counts = {r.x: r["count"] for r in frame.groupBy("x").count().collect()}
    law = {k: math.comb(25, k) * math.comb(35, 20 - k) / math.comb(60, 20) for k in range(21)}
    assert max(abs(counts.get(k, 0) / 4000 - p) for k, p in law.items()) < 0.03


def test_mix_of_odd_rows(spark, odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == 12 and all(sum(p.words for p in r.pieces) <= 2 * r.size for r in rows)
    assert mixing.mix(none).count() == 0
    empty = mixing.mix(odd.withColumn("text", F.lit(None).cast("string"))).collect()
    assert {(r.size, r.target, len(r.pieces)) for r in empty} == {(0, 0.0, 0)}


def test_toxicity_finds_planted_words(spark, odd, none):
    rng = random.Random(7)
    syllables = ["ba", "re", "ti", "on", "es", "la", "mu", "ko"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows, marks = [], []
    for i in range(600):
        words, toxic = [word() for _ in range(120)], int(i % 4 == 0)
        for _ in range(4 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["vexil", "groth", "snarkle"]))
        rows.append((i, " ".join(words)))
        marks.append((i, toxic))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.fit(docs.where("doc_id < 400"), labels.where("doc_id < 400"))
    got = toxicity.score(docs.where("doc_id >= 400"), model).collect()
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in got) / len(got) > 0.95
    odd_scores = toxicity.score(odd, model).collect()
    assert len(odd_scores) == 12 and all(0 <= r.score <= 1 for r in odd_scores)
    assert toxicity.score(none, toxicity.fit(none, labels.limit(0))).count() == 0
    assert {r.score for r in toxicity.score(odd, toxicity.fit(none, labels.limit(0))).collect()} == {0.0}


def test_lines_of_odd_rows(spark, odd, none):
    rows = lines.drop_repeated_lines(odd).collect()
    assert len(rows) == 12
    by = {r.doc_id: r for r in rows}
    assert (by[1].text, by[1].n_lines, by[1].n_dropped) == ("first", 2, 1)
    assert by[2].text == "second" and by[3].text == f"{LINE}\n{LINE}\nthird" and by[None].text.startswith(LINE)
    assert by[4].text is None and by[4].n_lines == 1 and by[5].text == "" and by[1].score == 9.5
    assert lines.drop_repeated_lines(none).count() == 0


class Captured:
    """Stands for a DataFrame whose Arrow function is called here and not in a worker."""

    def __init__(self, schema):
        self.schema = T._parse_datatype_string(schema)

    def where(self, *_):
        return self

    select = where

    def mapInArrow(self, run, schema):
        return run


def test_line_tasks_hold_few_texts_at_a_time(spark):
    texts = [f"{LINE}\n" + "\n".join(f"line {k} of text {i} and nothing else" for k in range(120)) for i in range(3000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(3000)), "text": texts})
    drop = lines.line_hash(LINE.encode(), lines.MIN_CHARS)
    with_drop = batch.append_column("_drop", pa.array([[drop] if i % 2 else None for i in range(3000)], pa.list_(pa.binary())))
    peaks = []
    for run, given in ((lines.line_keys(Captured("doc_id long, text string")), batch),
                       (lines._rebuild(Captured("doc_id long, text string, _drop array<binary>"), lines.MIN_CHARS), with_drop)):
        tracemalloc.start()
        found = [(out.num_rows, out.column(0)[0].as_py(), out.column(out.num_columns - 1)[0].as_py()) for out in run(iter([given]))]
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert sum(n for n, *_ in found) == (3000 if given is with_drop else 3000 * 121) and [i for _, i, _ in found] == sorted({i for _, i, _ in found})
    assert max(peaks) < 8e6 < sum(map(len, texts))
    rebuilt = pa.Table.from_batches(run(iter([with_drop])))
    assert rebuilt["n_lines"].to_pylist() == [121] * 3000 and rebuilt["n_dropped"].to_pylist() == [i % 2 for i in range(3000)]
    assert rebuilt["text"].to_pylist() == [t[len(LINE) + 1:] if i % 2 else t for i, t in enumerate(texts)]


def test_line_runs_are_compacted_and_fresh_lines_are_fresh(spark):
    runs = lines.LineRuns(spark, fresh_path(spark, "runs"), fanout=2)
    batches = [spark.createDataFrame([(10 * b + i, f"key{(b + i) % 4}".encode()) for i in range(3)], "doc_id long, key binary") for b in range(5)]
    seen = set()
    for batch in batches:
        fresh = {bytes(r.key) for r in runs.fresh_lines(batch).collect()}
        keys = {bytes(r.key) for r in batch.collect()}
        assert fresh == keys - seen
        seen |= keys
        runs.add(batch)
    assert sorted(level for level, paths in runs.levels.items() if paths) == [0, 2]
    merged = {bytes(r.key): (r.documents, r.owner) for r in runs.merged().collect()}
    assert sum(d for d, _ in merged.values()) == 15 and merged[b"key3"] == (3, 30)


def brute_components(texts, width, percent):
    sets = {}
    for i, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w)} if 0 < len(w) < width else {tuple(w[k:k + width]) for k in range(len(w) - width + 1)}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (1, 50)])
def test_jaccard_equals_brute_force(spark, width, percent):
    rng, texts = random.Random(width), {}
    for base in range(14):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([0, 1, 2, 4, 8, 14, 25, 60, 150]))]
        for _ in range(rng.choice([1, 2, 25])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5, 12])):
                if copy:
                    place = rng.randrange(len(copy))
                    copy[place:place + rng.randint(0, 1)] = [f"X{rng.randrange(30)}"] * rng.randint(0, 1)
            texts[len(texts)] = " ".join(copy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(docs, width, percent).collect()}
    assert got == brute_components(texts, width, percent)


def test_boundary_moves_with_cost():
    assert jaccard.boundary([(s, 1) for s in range(1, 100)], 90) == 20
    assert jaccard.missing(19, 90) == 1 and jaccard.missing(9, 90) == 0
    assert len(jaccard.subset_keys(np.arange(12, dtype=np.uint64), 90)) == 13


def test_jaccard_of_odd_rows(spark, odd, none):
    rows = jaccard.similar_components(odd).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 12 and by[4].n_shingles == 0 and by[4].component_id == 4 and by[9].component_id == 8 and by[11].component_id == 10
    assert by[None].component_id is None
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {1, 3, 4, 5, None, 7, 8, 10}
    assert jaccard.similar_components(none).count() == 0 and jaccard.keep_one(none).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.id: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}}


def tasks_of(spark, work):
    """Tasks that ran for ``work()``."""
    context, group = spark.sparkContext, fresh_path(spark, "group")
    context.setJobGroup(group, group)
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    tracker = context.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    return sum(info.numCompletedTasks for info in map(tracker.getStageInfo, stages) if info)


def test_components_take_few_tasks(many_slices):
    edges = many_slices.createDataFrame([(0, k) for k in range(1, 60)] + [(k, k + 100) for k in range(1, 60)], "u long, v long").repartition(8)
    found = []
    spent = tasks_of(many_slices, lambda: found.extend(components.components(edges).collect()))
    assert {r.id: r.root for r in found} == {k: 0 for k in [*range(60), *range(101, 160)]} and len(found) == 119
    assert spent <= 8 * 20  # one round and one look at its result; a second round would go beyond


@pytest.mark.parametrize("seed", range(4))
def test_components_of_random_edges(spark, seed):
    rng = random.Random(seed)
    names = [rng.getrandbits(63) - (1 << 62) for _ in range(80)]
    edges = [(rng.choice(names), rng.choice(names)) for _ in range(60)] * 2 + [(None, names[0]), (names[1], None), (names[2], names[2])]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        if u is not None and v is not None and u != v:
            x, y = find(u), find(v)
            root[max(x, y)] = min(x, y)
    found = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted((r.id, r.root) for r in found) == sorted((x, find(x)) for x in list(root))


def test_pseudonyms_keep_formats_and_go_back(spark, odd, none):
    permuter = privacy.Permuter(b"k")
    card, iban = "4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00"
    text = f"card {card}, again {card}; iban {iban}; born 1984-02-29 or 29.02.1984; not 1984-02-30; ssn 123-45-6789; call +1 (974) 555-3436; " \
           'ip 10.0.0.255 not 300.1.1.1; mail Jo.Doe7@mail.example.com; token = "0123456789abcdef0123456789ABCDEF"; plain 1234567890123'
    out, counts = privacy.replace_all(text, permuter)
    assert counts == {"card": 2, "iban": 1, "date": 2, "ssn": 1, "phone": 1, "ipv4": 1, "email": 1, "secret": 1, "number": 1}
    assert privacy.replace_all(out, permuter, back=True)[0] == text
    new = re.findall(r"\d{4} \d{4} \d{4} \d{4}", out)
    assert new[0] == new[1] != card and privacy.luhn_digit(new[0].replace(" ", "")[:-1]) == new[0][-1]
    plain = re.search(r"iban ([A-Z0-9 ]+);", out)[1].replace(" ", "")
    assert privacy.iban_check(plain[:2], plain[4:]) == plain[2:4] and "1984-02-30" in out and "300.1.1.1" in out
    assert privacy.replace_all(text, privacy.Permuter(b"other"))[0] != out and "Jo.Doe7@" not in out and "@mail.example.com" in out
    small = [privacy.Permuter(b"k").forward(v, 50, "x") for v in range(50)]
    assert sorted(small) == list(range(50)) and small != sorted(small)
    rows = privacy.pseudonymise(odd, b"k").collect()
    assert len(rows) == 12 and next(r for r in rows if r.doc_id == 4).text is None and next(r for r in rows if r.doc_id == 1).text.startswith(LINE)
    assert privacy.pseudonymise(none, b"k").count() == 0


def test_contamination_of_odd_rows(spark, odd, none):
    items = benchmark_table(spark, [(1, "KURZER satz"), (2, "kurzer"), (3, ""), (4, None), (5, " ".join(f"word{i}" for i in range(12))), (5, "ein")])
    rows = contamination.contamination(odd, items).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 12 and by[4].n_words == 0 and not by[5].contaminated
    assert (by[10].n_words, by[10].n_hit, by[10]["items"]) == (3, 3, ["1", "2", "5"])
    assert by[8].n_hit == 12 * (30_000 // 97) + 12 and by[8].n_items == 1
    assert {r.doc_id for r in contamination.drop_contaminated(odd, items).collect()} == {1, 2, 3, 4, 5, None, 7}
    cut = {r.doc_id: r.text for r in contamination.remove_spans(odd, benchmark_table(spark, [(1, "kurzer satz")])).collect()}
    assert cut[10] == "ein" and cut[1] == f"{LINE}\nfirst" and cut[4] is None
    assert contamination.contamination(none, items).count() == 0
    assert contamination.contamination(odd, items.limit(0)).where("contaminated").count() == 0


def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    rows = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(rows) - len(set(rows)), len(hit)


def test_quality_counts_and_ratios_equal_brute_force(spark):
    rng = random.Random(3)
    texts = ["", None, "a b\n a b\na b\n\n  \n\n", "x " * 50, "# $ % a|b <c>"]
    texts += [" ".join(rng.choice(["ab", "cd", "é", "\n", "f#"]) for _ in range(rng.randrange(1, 90))) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(10, 18)], "doc_id long")
    buckets = 64
    table = quality.ratio_table(docs, trusted, buckets)
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x

    def grams(text):
        h = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        two = [xxhash.xxh64_intdigest((b).to_bytes(8, "little"), seed=xxhash.xxh64_intdigest(a.to_bytes(8, "little"), seed=42)) for a, b in zip(h, h[1:])]
        return [signed(x) % buckets for x in h + two]

    good, raw = np.ones(buckets), np.ones(buckets)
    for i, text in enumerate(texts):
        for g in grams(text):
            raw[g] += 1
            good[g] += 10 <= i < 18
    expected = np.log(good / good.sum()) - np.log(raw / raw.sum())
    assert np.allclose(table, expected)
    for r in quality.judge(docs, table, threshold=0.0).collect():
        text, g = texts[r.doc_id], grams(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(text)
        assert r.log_ratio == pytest.approx(sum(expected[x] for x in g) / max(1, len(g)), abs=1e-5)
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and r.log_ratio >= 0)


def test_quality_of_odd_rows(spark, odd, none):
    table = quality.ratio_table(odd, odd.select("doc_id").limit(0))
    assert set(table) == {0.0} and quality.judge(odd, table).count() == 12
    assert quality.judge(none, quality.ratio_table(none, none.select("doc_id"))).count() == 0


def brute_suffixes(rows):
    first = {}
    for i, data in rows:
        for s in range(len(data) - 49):
            first[data[s:s + 50]] = min(i, first.get(data[s:s + 50], i))
    out = {}
    for i, data in rows:
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - 49):
            if first[data[s:s + 50]] < i:
                gone[s:s + 50] = True
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[i] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("letters", ["ab", "abcdefghé "])
def test_suffix_dedup_equals_brute_force(spark, letters):
    rng = random.Random(len(letters))
    pool = ["".join(rng.choice(letters) for _ in range(rng.choice([30, 50, 51, 80, 200]))) for _ in range(12)]
    pool.append("a" * 300)
    texts = ["".join(rng.choice(pool) if rng.random() < 0.6 else "".join(rng.choice(letters) for _ in range(rng.randrange(70))) for _ in range(rng.randrange(6))) for _ in range(60)]
    texts += [texts[5], texts[5], "", pool[4][:49], pool[4]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in suffixes.remove_repeats(docs).collect()}
    assert got == brute_suffixes([(i, t.encode()) for i, t in enumerate(texts)])


def test_samples_of_pieces_are_those_of_the_whole(monkeypatch):
    text = "".join(random.Random(5).choice("abc ") for _ in range(3000)).encode()

    def found():
        out = []
        for buffer in suffixes.buffers([b"x" * 60, text]):
            places, doc, pos = buffer.owned(buffer.samples())
            around = suffixes.identifier(buffer.parts, places - suffixes.REACH, suffixes.LENGTH + suffixes.REACH)
            out += list(zip(doc.tolist(), pos.tolist(), around.tolist()))
        return sorted(out)

    whole = found()
    monkeypatch.setattr(suffixes, "PIECE", 211)
    monkeypatch.setattr(suffixes, "BUFFER", 500)
    assert found() == whole


def test_suffix_dedup_of_odd_rows(spark, odd, none):
    rows = suffixes.remove_repeats(odd).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(rows) == 12 and by[8][0].n_removed == 0 and [r.n_removed for r in by[9]] == [r.n_bytes for r in by[9]]
    assert by[4][0].n_bytes == 0 and by[None][0].n_removed == 0 and bytes(by[5][0].kept) == b""
    assert suffixes.remove_repeats(none).count() == 0


def test_packing_goes_back():
    for values in (np.arange(1000, dtype=np.uint64) ** 3, np.array([], np.int64), np.array([7], np.uint16)):
        assert (packing.unpack(packing.pack(values), values.dtype) == values).all()
