"""The pipeline on a small folder with planted cases: each stage's decisions take effect, clean documents stay."""

import random

import pytest

import corpus_pipeline
from loomwork.session import fresh_path

WORDS = {"en": ["the", "thing", "with", "house", "ring", "light", "what", "when"], "fr": ["çela", "être", "où", "déjà", "voilà", "fenêtre", "garçon"]}
SHARED = "A licence line that many documents carry around with them"


@pytest.fixture(scope="module")
def folder(spark):
    rng = random.Random(11)

    def prose(lang, n):
        return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "er", "ed", "ly", "ou"]) for _ in range(n))

    rows = [(i, prose(lang := "en" if i % 3 else "fr", 60), lang, f"s{i % 4}") for i in range(80)]
    rows += [(100 + i, f"{prose('en', 60)}\n{SHARED}", "en", "s0") for i in range(4)]
    base = prose("en", 100)
    rows += [(200, base, "en", "s1"), (201, base, "en", "s1"), (202, base.rsplit(" ", 3)[0] + " or so", "en", "s1")]
    item = prose("fr", 14)
    rows += [(300, f"{prose('fr', 40)} {item} {prose('fr', 40)}", "fr", "s2"), (400, "12345 678 !!", "en", "s3"), (401, None, None, None)]
    path = fresh_path(spark, "folder")
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_planted_cases(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, "stage")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = {r.doc_id: r for r in docs.collect()}
        assert name == "mixing" or docs.columns == columns
    clean = set(range(80))
    assert set(seen["language"]) == clean | {100, 101, 102, 103, 200, 201, 202, 300}
    lines = seen["line dedup"]
    assert SHARED in lines[103].text and all(SHARED not in lines[i].text and lines[i].n_chars == len(lines[i].text) for i in (100, 101, 102))
    assert set(seen["near duplicates"]) == set(lines) - {201, 202}
    assert set(seen["decontamination"]) == set(seen["near duplicates"]) - {300}
    assert set(seen["mixing"]) == set(seen["decontamination"])
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == set(seen["mixing"])


def test_tables_without_rows(spark):
    path = fresh_path(spark, "folder")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0


def test_texts_that_fit_no_learned_language_go(spark):
    rng = random.Random(5)
    words = {**WORDS, "xx": ["żółw", "wszystkie", "przez", "książka", "jeszcze", "człowiek", "mógł"]}

    def prose(lang, n):
        return " ".join(rng.choice(words[lang]) + rng.choice(["", "er", "ed", "ly", "ou"]) for _ in range(n))

    rows = [(i, prose(lang := "en" if i % 3 else "fr", 60), lang) for i in range(120)]
    rows += [(200 + i, prose("xx", 60), None) for i in range(5)]
    rows += [(210 + i, " ".join("".join(rng.choice("bcdfghjkmpqvwxz") for _ in range(6)) for _ in range(60)), None) for i in range(5)]
    rows += [(300, f"{prose('en', 60)} {rng.getrandbits(900):x}a1 +1 (555) 010-7788", None), (301, "x1 q2 9z", None), (302, f"{prose('en', 60)} {prose('fr', 60)}", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in corpus_pipeline.known_language(spark, docs, "").collect()} == set(range(120)) | {300, 302}


@pytest.mark.parametrize("n", [1, 3, 7])
def test_learned_texts_stay_however_many_languages(spark, n):
    rng = random.Random(n)
    kinds = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 7))) for _ in range(40)] for _ in range(n + 1)]
    rows = [(100 * k + i, " ".join(rng.choices(kinds[k], k=80)), f"l{k}" if k < n else None) for k in range(n + 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in corpus_pipeline.known_language(spark, docs, "").collect()} == {r[0] for r in rows if r[2]}
