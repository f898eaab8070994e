"""Chunking rules, trimming, extraction and TF-IDF on small literals."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomwork.functions.text import SPACE, split_text, strip
from loomwork.operators import texts as tt


def cut(spark, text, size, overlap):
    return spark.createDataFrame([(text,)], "content string").select(split_text("content", size, overlap).alias("c")).first()["c"]


def test_short_text_is_one_chunk(spark):
    assert cut(spark, " hello ", 20, 5) == [" hello "]
    assert cut(spark, " \n\t ", 20, 5) == []


def test_paragraphs_are_merged_with_overlap(spark):
    # 6+1 and 6+1 fit in 15; the third piece opens a chunk that starts with the last 3 characters
    assert cut(spark, "aaaaaa\n\nbbbbbb\n\n\ncccccc", 15, 3) == ["aaaaaa bbbbbb", "bbb cccccc"]


def test_sentences_when_there_is_one_paragraph(spark):
    assert cut(spark, "One two. Three four! Five six?", 20, 0) == ["One two.", "Three four!", "Five six?"]
    assert cut(spark, "One two. Three four! Five six?", 22, 0) == ["One two. Three four!", "Five six?"]


def test_oversized_piece_stays_whole(spark):
    assert cut(spark, "x" * 30 + "\n\n" + "y", 10, 0) == ["x" * 30, "y"]


def test_overlap_may_exceed_the_size(spark):
    assert cut(spark, "aaaa\n\nbbbbbbbb", 9, 4) == ["aaaa", "aaaa bbbbbbbb"]


def test_carried_blank_is_counted_but_not_kept(spark):
    # the tail " bb" of "aaa bb" counts three characters, the text starts at "bb"
    assert cut(spark, "aaa bb\n\ncccc\n\ndd", 8, 3) == ["aaa bb", "bb cccc", "ccc dd"]


def test_hard_split_keeps_a_contained_tail(spark):
    assert cut(spark, "abcdefghij", 6, 2) == ["abcdef", "efghij", "ij"]
    assert cut(spark, "abcdefg", 3, 3) == ["abc", "def", "g"]


def test_unicode_white_space(spark):
    text = "  \x1fword　"
    assert spark.createDataFrame([(text,)], "t string").select(strip("t").alias("s")).first()["s"] == "word"
    assert all(c.isspace() for c in SPACE)


def test_index_counts_blank_chunks(spark):
    docs = spark.createDataFrame([(1, "a" * 6 + " " * 6 + "b" * 6)], "doc_id int, content string")
    rows = tt.hard_split_documents(docs, 6, 0).orderBy("chunk_index").collect()
    assert [(r["chunk_index"], r["chunk_count"], r["content"]) for r in rows] == [(0, 3, "aaaaaa"), (2, 3, "bbbbbb")]


def test_metadata_is_kept_and_documents_add_up(spark):
    one = spark.createDataFrame([(1, "f", "A one. " * 40)], "doc_id int, filename string, content string")
    two = one.unionByName(one.withColumn("doc_id", F.lit(2)))
    a, b = tt.chunk_documents(one, 64, 8), tt.chunk_documents(two, 64, 8)
    assert b.count() == 2 * a.count() > 2
    assert a.filter("filename = 'f'").count() == a.count()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab .!?\n", min_size=0, max_size=300), min_size=20, max_size=20))
def test_chunks_hold_every_character_of_the_text(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "content string").select("content", split_text("content", 40, 0).alias("c")).collect()
    for r in rows:
        assert "".join("".join(r["c"]).split()) == "".join(r["content"].split())


def cosine(spark, a, b, stop=("the",)):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    return tt.tfidf_pair_cosine(df, "a", "b", list(stop)).first()["cosine"]


def test_pair_cosine(spark):
    s = 1 + math.log(1.5)
    # "cat" is in both, "dog" twice in one, "cow" in the other; "the" and one-letter words do not count
    assert cosine(spark, "The cat, dog dog a", "CAT cow") == pytest.approx(1 / math.sqrt((1 + 4 * s * s) * (1 + s * s)))
    assert cosine(spark, "same words", "same words") == pytest.approx(1.0)
    assert cosine(spark, "the", "the") == 0.0
    assert cosine(spark, " ", "word") == 0.0


def test_context_relevance(spark):
    df = spark.createDataFrame([(1, "cat", ["cat", "dog"]), (2, "cat", []), (3, "the", ["cat"])], "k int, question string, contexts array<string>")
    got = {r["k"]: r["context_relevance"] for r in tt.context_relevance_tfidf(df, ["k"], ["the"]).collect()}
    assert got == {1: pytest.approx(0.5), 2: 0.0, 3: 0.0}


def test_scores_are_averaged_before_rounding(spark):
    df = spark.createDataFrame([(1, "cat dog", "cat cow", ["cat hen", "dog"])], "k int, question string, answer string, contexts array<string>")
    r = tt.rag_scores(df, ["k"], tt.STOP_WORDS).first()
    assert r["overall"] == pytest.approx((r["context_relevance"] + r["answer_faithfulness"] + r["answer_relevancy"]) / 3, abs=1e-4)
    assert all(0 <= r[c] <= 1 for c in ("context_relevance", "answer_faithfulness", "answer_relevancy"))


def test_sql_and_verdicts(spark):
    rows = spark.createDataFrame([("x ```sql\n SELECT 1 \n``` y",), ("try select a\nfrom b; more",), (" no query ",)], "text string")
    assert [r["sql"] for r in tt.extract_sql_block(rows).collect()] == ["SELECT 1", "select a\nfrom b", "no query"]
    rows = spark.createDataFrame([("ANSWER: yes ANSWER:",), ("RETRY: wrong table",), ("neither",)], "text string")
    assert [(r["verdict"], r["body"]) for r in tt.parse_verdict(rows).collect()] == [("answer", "yes"), ("retry", "wrong table"), ("retry", "neither")]


def test_prompt(spark):
    found = spark.createDataFrame([(1, 2, None, "two"), (1, 1, "f.txt", "one")], "query_id int, rank int, filename string, content string")
    asked = spark.createDataFrame([(1, "Why?"), (2, "How?")], "query_id int, question string")
    got = {r["query_id"]: r["prompt"] for r in tt.assemble_prompt(found, asked).collect()}
    assert got[1] == "Answer based on context:\n\n[1] (source: f.txt)\none\n\n[2] (source: unknown)\ntwo\n\nQuestion: Why?\n\nAnswer:"
    assert got[2] == "Answer based on context:\n\n\n\nQuestion: How?\n\nAnswer:"


def test_chunks_of_odd_texts_and_missing_ones(spark):
    assert cut(spark, None, 20, 5) == []
    assert cut(spark, "a.\u2003b.\x1cc! \u3000d?" + "e" * 9, 9, 0) == ["a. b.\x1cc!", "d?eeeeeeeee"]  # \x1c is trimmed but ends no sentence
    assert cut(spark, "\U0001f600" * 5 + "\n\n" + "\x1f\n\n" + "b", 6, 0) == ["\U0001f600" * 5, "b"]


def test_a_text_is_chunked_in_one_pass(spark):
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("One. Two.").alias("content"))
    plan = tt.chunk_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "aggregate(" not in plan and plan.count("EvalPython") == 1
