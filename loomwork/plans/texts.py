"""Chunking, prompts, extraction and TF-IDF scores over documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.operators import gates
from loomwork.operators import texts as tt
from loomwork.operators import vectors as vx
from loomwork.plans.registry import register, select_sql
from loomwork.session import cut_lineage, spread, stored
from loomwork.sources.derived import DOC_SQL, QA_SQL, documents, question_answers, table

STOP = tt.STOP_WORDS
STOP_SQL = ", ".join(f"'{w}'" for w in STOP)
KEYS = ["conv_id", "turn"]
CHUNK_IDS = 1 << 20  # a chunk's number is its document's times this, and its index


def strip_sql(x):
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def chunks_sql(size=512, overlap=50, src="docs", out="chunks"):
    step = size - overlap
    tail = f"right({strip_sql('s.text')}, {overlap})"
    return f"""{out}_p AS (
  SELECT *, CASE WHEN len(string_split_regex(content, '\\n\\n+')) > 1 THEN string_split_regex(content, '\\n\\n+')
                 ELSE string_split(regexp_replace(content, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) END AS pieces FROM {src}),
{out}_f AS (
  SELECT * EXCLUDE (pieces), len(pieces) AS n_pieces, list_reduce(
    list_transform(list_filter(list_transform(pieces, lambda p: {strip_sql('p')}), lambda p: length(p) > 0),
                   lambda p: {{'done': []::VARCHAR[], 'text': p, 'used': length(p) + 1, 'started': true}}),
    lambda s, x: CASE WHEN s.started AND s.used + x.used > {size}
      THEN {{'done': list_append(s.done, {strip_sql('s.text')}),
             'text': CASE WHEN length({tail}) > 0 THEN {tail} || ' ' || x.text ELSE x.text END,
             'used': length({tail}) + x.used, 'started': true}}
      ELSE {{'done': s.done, 'text': CASE WHEN s.started THEN s.text || ' ' || x.text ELSE x.text END, 'used': s.used + x.used, 'started': true}} END,
    {{'done': []::VARCHAR[], 'text': '', 'used': 0::BIGINT, 'started': false}}) AS st FROM {out}_p),
{out}_l AS (
  SELECT * EXCLUDE (st, n_pieces), CASE
      WHEN length(content) <= {size} THEN CASE WHEN length({strip_sql('content')}) > 0 THEN [content] ELSE []::VARCHAR[] END
      WHEN n_pieces > 1 THEN CASE WHEN length({strip_sql('st.text')}) > 0 THEN list_append(st.done, {strip_sql('st.text')}) ELSE st.done END
      ELSE list_transform(range(0, length(content), {step}), lambda i: substr(content, i + 1, {size})) END AS parts FROM {out}_f),
{out}_u AS (SELECT doc_id, filename, file_type, len(parts) AS chunk_count, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS chunk_index FROM {out}_l),
{out} AS (SELECT doc_id, filename, file_type, chunk_count, chunk_index, {strip_sql('part')} AS content FROM {out}_u WHERE length({strip_sql('part')}) > 0)"""


CHUNKS = f"{DOC_SQL},\n{chunks_sql()}"


def dealt(spark, folder):
    """The documents over all cores: the test table is a single row group."""
    return spread(documents(spark, folder))


def chunks(spark, folder):
    return tt.chunk_documents(dealt(spark, folder))


@register("chunk_documents", select_sql(CHUNKS, "chunks", "doc_id filename file_type content", "", "chunk_count chunk_index"))
def _(spark, folder):
    return chunks(spark, folder)


@register("hard_split", select_sql(f"""{DOC_SQL},
h AS (SELECT doc_id, list_transform(range(0, length(content), 462), lambda i: substr(content, i + 1, 512)) AS parts FROM docs),
u AS (SELECT doc_id, len(parts) AS chunk_count, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS chunk_index FROM h),
o AS (SELECT doc_id, chunk_count, chunk_index, {strip_sql('part')} AS content FROM u WHERE length({strip_sql('part')}) > 0)""",
          "o", "doc_id content", "", "chunk_count chunk_index"))
def _(spark, folder):
    return tt.hard_split_documents(dealt(spark, folder).select("doc_id", "content"))


# Fixed values: (size, overlap) of the sweep.
SETTINGS = [(256, 25), (512, 50), (768, 75), (1024, 100)]


@register("chunk_size_sweep", f"WITH {DOC_SQL},\n" + ",\n".join(chunks_sql(s, o, out=f"c{s}") for s, o in SETTINGS) + "\n" + " UNION ALL ".join(
    f'SELECT {s}::BIGINT AS "size", {o}::BIGINT AS "overlap", count(*) AS n_chunks FROM c{s}' for s, o in SETTINGS))
def _(spark, folder):
    return tt.chunk_size_sweep(dealt(spark, folder), SETTINGS)


@register("chunk_length_stats", select_sql(f"""{CHUNKS},
o AS (SELECT avg(length(content)) AS mean_len, min(length(content)) AS min_len, max(length(content)) AS max_len, count(*) AS n_chunks,
      quantile_cont(length(content), 0.5) AS median_len FROM chunks)""", "o", "", "mean_len median_len", "min_len max_len n_chunks"))
def _(spark, folder):
    return tt.chunk_length_stats(chunks(spark, folder))


@register("chunk_length_hist", select_sql(f"""{CHUNKS},
e AS (SELECT CAST(min(length(content)) AS DOUBLE) AS lo, CAST(max(length(content)) AS DOUBLE) AS hi FROM chunks),
o AS (SELECT least(floor((length(content) - lo) / (hi - lo) * 15), 14) AS bin, count(*) AS n FROM chunks, e GROUP BY 1)""", "o", "", "", "bin n"))
def _(spark, folder):
    return tt.chunk_length_hist(chunks(spark, folder))


@register("chunk_length_quartiles", select_sql(f"""{CHUNKS},
o AS (SELECT q::DOUBLE AS q, v AS value FROM (SELECT unnest([0.25, 0.5, 0.75]) AS q, unnest(quantile_cont(length(content), [0.25, 0.5, 0.75])) AS v FROM chunks))""",
          "o", "", "q value"))
def _(spark, folder):
    return tt.chunk_length_quartiles(chunks(spark, folder))


@register("document_lengths", f"WITH {DOC_SQL} SELECT doc_id, file_type, filename, length(content) AS n_chars, substr(content, 1, 500) AS preview FROM docs")
def _(spark, folder):
    return tt.document_lengths(documents(spark, folder))


@register("append_documents", select_sql(f"""{CHUNKS},
b AS (SELECT item_id AS doc_id, 'item_' || item_id || '.txt' AS filename, 'txt' AS file_type, text AS content FROM benchmark),
{chunks_sql(src='b', out='added')},
o AS (SELECT * FROM chunks UNION ALL SELECT * FROM added UNION ALL SELECT * FROM added)""",
          "o", "doc_id filename file_type content", "", "chunk_count chunk_index"))
def _(spark, folder):
    """The documents' chunks with the benchmark texts added twice, which keeps both copies."""
    items = table(spark, folder, "benchmark").select(
        F.col("item_id").alias("doc_id"), F.concat(F.lit("item_"), F.col("item_id").cast("string"), F.lit(".txt")).alias("filename"),
        F.lit("txt").alias("file_type"), F.col("text").alias("content"),
    )
    added = tt.chunk_documents(items)
    return tt.append_documents(tt.append_documents(chunks(spark, folder), added), added)


# --- extraction ------------------------------------------------------------------------

CHAT_SQL = """chat AS (SELECT conv_id, turn, CASE turn % 5
  WHEN 0 THEN 'Here:' || chr(10) || '```sql' || chr(10) || 'SELECT * FROM t' || chr(10) || '-- ' || text || chr(10) || '```' || chr(10) || 'Done'
  WHEN 1 THEN 'Try select a from b where c = 1; ' || text WHEN 2 THEN text WHEN 3 THEN 'ANSWER: ' || text ELSE 'RETRY: ' || text END AS text
  FROM conversations)"""


def chat(spark, folder):
    """Conversation turns wrapped as answers of five kinds."""
    text, kind = F.col("text"), F.col("turn") % 5
    fenced = F.concat(F.lit("Here:\n```sql\nSELECT * FROM t\n-- "), text, F.lit("\n```\nDone"))
    return table(spark, folder, "conversations").select(
        "conv_id", "turn",
        F.when(kind == 0, fenced).when(kind == 1, F.concat(F.lit("Try select a from b where c = 1; "), text)).when(kind == 2, text)
        .when(kind == 3, F.concat(F.lit("ANSWER: "), text)).otherwise(F.concat(F.lit("RETRY: "), text)).alias("text"),
    )


@register("extract_sql_block", f"""WITH {CHAT_SQL}
SELECT conv_id, turn, {strip_sql("CASE WHEN regexp_matches(text, '(?s)```sql\\s*(.*?)\\s*```') THEN regexp_extract(text, '(?s)```sql\\s*(.*?)\\s*```', 1) WHEN regexp_matches(text, '(?is)(SELECT .+?)(?:;|$)') THEN regexp_extract(text, '(?is)(SELECT .+?)(?:;|$)', 1) ELSE text END")} AS sql FROM chat""")
def _(spark, folder):
    return tt.extract_sql_block(chat(spark, folder)).drop("text")


@register("parse_verdict", f"""WITH {CHAT_SQL}
SELECT conv_id, turn, CASE WHEN starts_with(text, 'ANSWER:') THEN 'answer' ELSE 'retry' END AS verdict,
{strip_sql("replace(text, CASE WHEN starts_with(text, 'ANSWER:') THEN 'ANSWER:' ELSE 'RETRY:' END, '')")} AS body FROM chat""")
def _(spark, folder):
    return tt.parse_verdict(chat(spark, folder)).drop("text")


# --- scores ---------------------------------------------------------------------------

DIM, K = 384, 5
EMBEDDED = f"""texts AS (SELECT 0 AS side, doc_id * {CHUNK_IDS} + chunk_index AS id, content AS text FROM chunks
  UNION ALL SELECT 1, conv_id * 1000 + turn, question FROM qa),
buckets AS (SELECT side, id, ('0x' || substr(md5(w), 1, 8))::BIGINT % {DIM} AS b
  FROM (SELECT side, id, unnest(string_split_regex(lower(text), '[\\x20\\x09-\\x0D]+')) AS w FROM texts) WHERE w <> ''),
idf AS (SELECT d.b, ln(((SELECT count(*) FROM chunks) + 1)::DOUBLE / (count(DISTINCT k.id) + 1)) AS idf
  FROM (SELECT unnest(range({DIM})) AS b) d LEFT JOIN buckets k ON k.b = d.b AND k.side = 0 GROUP BY 1),
weighed AS (SELECT side, id, b, count(*) * any_value(idf) AS x FROM buckets JOIN idf USING (b) GROUP BY 1, 2, 3),
unit AS MATERIALIZED (SELECT side, id, b, x / sqrt(sum(x * x) OVER (PARTITION BY side, id)) AS x FROM weighed WHERE x > 0)"""
CTX = f"""{QA_SQL},
{CHUNKS},
{EMBEDDED},
dense AS (SELECT t.side, t.id, list(coalesce(u.x, 0) ORDER BY d.b) AS v FROM texts t CROSS JOIN (SELECT unnest(range({DIM})) AS b) d
  LEFT JOIN unit u ON u.side = t.side AND u.id = t.id AND u.b = d.b GROUP BY 1, 2),
sim AS (SELECT q.id AS query_id, c.id AS cand_id, round(list_inner_product(q.v, c.v), 12) AS score FROM dense q, dense c WHERE q.side = 1 AND c.side = 0),
top AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, cand_id) AS rank FROM sim
  QUALIFY rank <= {K}),
ctx AS MATERIALIZED (SELECT query_id, query_id // 1000 AS conv_id, query_id % 1000 AS turn, score, rank, filename, content
  FROM top JOIN chunks ON cand_id = doc_id * {CHUNK_IDS} + chunk_index)"""


def asked(spark, folder):
    return question_answers(spark, folder).withColumn("query_id", F.col("conv_id") * 1000 + F.col("turn"))


def retrieved(spark, folder, k=K):
    """The chunks of all documents nearest to each question; chunked once, encoded by the built-in encoder."""
    store = stored(chunks(spark, folder).select(
        (F.col("doc_id") * CHUNK_IDS + F.col("chunk_index")).alias("cand_id"), "filename", "content"), "chunks")
    return vx.retrieve(store, asked(spark, folder), vx.hash_encoder(store, "content", DIM), k)


def contexts(spark, folder):
    """Questions and answers, each with the contents of its retrieved chunks in order of rank."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "content")))  # at most k of them
    lists = retrieved(spark, folder).groupBy("query_id").agg(F.transform(ranked, lambda c: c["content"]).alias("contexts"))
    joined = asked(spark, folder).join(lists, "query_id", "left")
    return joined.withColumn("contexts", F.coalesce("contexts", F.array().cast("array<string>")))


def tokens_sql(src, text, extra, out):
    return f"""{out} AS (SELECT {extra}, w, count(*) AS c FROM (SELECT {extra}, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS w FROM {src})
  WHERE w NOT IN ({STOP_SQL}) GROUP BY ALL)"""


def cosine_sql(src, a, b, out, score):
    return f"""{tokens_sql(src, a, 'conv_id, turn, 0 AS side', out + '_a')},
{tokens_sql(src, b, 'conv_id, turn, 1 AS side', out + '_b')},
{out}_j AS (SELECT conv_id, turn, w, sum(c) FILTER (side = 0) AS ca, sum(c) FILTER (side = 1) AS cb FROM (SELECT * FROM {out}_a UNION ALL SELECT * FROM {out}_b) GROUP BY 1, 2, 3),
{out}_s AS (SELECT conv_id, turn, sum(coalesce(ca * cb, 0)) / sqrt(sum(ca * ca * CASE WHEN cb IS NULL THEN pow(1 + ln(1.5), 2) ELSE 1 END)
            * sum(cb * cb * CASE WHEN ca IS NULL THEN pow(1 + ln(1.5), 2) ELSE 1 END)) AS s FROM {out}_j GROUP BY 1, 2),
{out} AS (SELECT q.conv_id, q.turn, coalesce(s, 0) AS {score} FROM {src} q LEFT JOIN {out}_s s ON s.conv_id = q.conv_id AND s.turn = q.turn)"""


RELEVANCY = cosine_sql("qa", "question", "answer", "rel", "answer_relevancy")
FAITH = f"""joined AS (SELECT conv_id, turn, answer, (SELECT string_agg(content, ' ' ORDER BY rank) FROM ctx WHERE ctx.conv_id = qa.conv_id AND ctx.turn = qa.turn) AS context FROM qa),
{cosine_sql("joined", "answer", "context", "fai", "answer_faithfulness")}"""
CONTEXT = f"""qt AS (SELECT conv_id, turn, 0 AS rank, question AS text FROM qa UNION ALL SELECT conv_id, turn, rank, content FROM qa JOIN ctx USING (conv_id, turn)),
nn AS (SELECT conv_id, turn, count(*) AS n FROM qt GROUP BY 1, 2),
{tokens_sql("qt", "text", "conv_id, turn, rank", "tk")},
wd AS (SELECT t.*, c * (ln((1 + n)::DOUBLE / (1 + count(*) OVER (PARTITION BY t.conv_id, t.turn, w))) + 1) AS x FROM tk t JOIN nn ON nn.conv_id = t.conv_id AND nn.turn = t.turn),
nm AS (SELECT conv_id, turn, rank, sqrt(sum(x * x)) AS norm FROM wd GROUP BY 1, 2, 3),
dt AS (SELECT q.conv_id, q.turn, d.rank, sum(q.x * d.x) AS dot FROM wd q JOIN wd d ON d.conv_id = q.conv_id AND d.turn = q.turn AND d.w = q.w AND d.rank > 0 WHERE q.rank = 0 GROUP BY 1, 2, 3),
sm AS (SELECT dt.conv_id, dt.turn, sum(dot / a.norm / b.norm) AS s FROM dt JOIN nm a ON a.conv_id = dt.conv_id AND a.turn = dt.turn AND a.rank = 0
       JOIN nm b ON b.conv_id = dt.conv_id AND b.turn = dt.turn AND b.rank = dt.rank GROUP BY 1, 2),
cr AS (SELECT nn.conv_id, nn.turn, coalesce(s / nullif(n - 1, 0), 0) AS context_relevance FROM nn LEFT JOIN sm ON sm.conv_id = nn.conv_id AND sm.turn = nn.turn)"""
RAG = f"""{CTX},
{RELEVANCY},
{FAITH},
{CONTEXT},
rag AS (SELECT cr.conv_id, cr.turn, context_relevance, answer_faithfulness, answer_relevancy, (context_relevance + answer_faithfulness + answer_relevancy) / 3 AS overall
        FROM cr JOIN rel ON rel.conv_id = cr.conv_id AND rel.turn = cr.turn JOIN fai ON fai.conv_id = cr.conv_id AND fai.turn = cr.turn)"""
RAG_COLS = "context_relevance answer_faithfulness answer_relevancy overall"


@register("tfidf_pair_cosine", select_sql(f"""pairs AS (SELECT a.conv_id, a.turn, a.text AS question, b.text AS answer FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1),
{cosine_sql("pairs", "question", "answer", "cos", "cosine")}""", "cos", "conv_id turn", "cosine"))
def _(spark, folder):
    """Every turn against the next one."""
    talk = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    after = talk.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("after"))
    return tt.tfidf_pair_cosine(talk.join(after, KEYS), "text", "after", STOP).select("conv_id", "turn", "cosine")


@register("answer_relevancy", select_sql(f"{QA_SQL},\n{RELEVANCY}", "rel", "conv_id turn", "answer_relevancy"))
def _(spark, folder):
    return tt.answer_relevancy(question_answers(spark, folder), STOP).select(*KEYS, "answer_relevancy")


@register("answer_faithfulness", select_sql(f"{CTX},\n{FAITH}", "fai", "conv_id turn", "answer_faithfulness"))
def _(spark, folder):
    return tt.answer_faithfulness(contexts(spark, folder), STOP).select(*KEYS, "answer_faithfulness")


@register("context_relevance_tfidf", select_sql(f"{CTX},\n{CONTEXT}", "cr", "conv_id turn", "context_relevance"))
def _(spark, folder):
    return tt.context_relevance_tfidf(contexts(spark, folder), KEYS, STOP)


@register("rag_scores", select_sql(RAG, "rag", "conv_id turn", RAG_COLS, digits=4), digits=4)
def _(spark, folder):
    return tt.rag_scores(contexts(spark, folder), KEYS, STOP)


@register("metric_summary", f"""WITH {RAG}, m AS (SELECT * FROM (SELECT {RAG_COLS.replace(' ', ', ')} FROM rag) UNPIVOT (value FOR metric IN ({RAG_COLS.replace(' ', ', ')})))
SELECT metric, round(avg(round(value, 4)), 4) + 0.0 AS mean, round(stddev_samp(round(value, 4)), 4) + 0.0 AS std, round(min(value), 4) + 0.0 AS "min",
       round(max(value), 4) + 0.0 AS "max" FROM m GROUP BY 1""", digits=4)
def _(spark, folder):
    return gates.metric_summary(tt.rag_scores(contexts(spark, folder), KEYS, STOP), RAG_COLS.split())


def prompt_sql(context, question):
    head, middle, end = (" || ".join(f"'{part}'" for part in text.replace("\n", "\0|\0").split("\0") if part).replace("'|'", "chr(10)")
                         for text in (tt.PROMPT_HEAD, tt.PROMPT_QUESTION, tt.PROMPT_END))
    return f"{head} || coalesce({context}, '') || {middle} || {question} || {end}"


SOURCES_SQL = "string_agg('[' || rank || '] (source: ' || coalesce(filename, 'unknown') || ')' || chr(10) || content, chr(10) || chr(10) ORDER BY rank)"
PROMPTS = f"""{CTX},
b AS (SELECT q.conv_id * 1000 + q.turn AS query_id, question, {SOURCES_SQL} AS context, avg(score) AS context_relevance
      FROM qa q LEFT JOIN ctx c ON c.conv_id = q.conv_id AND c.turn = q.turn GROUP BY 1, 2)"""


@register("assemble_prompt", f"WITH {PROMPTS} SELECT query_id, {prompt_sql('context', 'question')} AS prompt FROM b")
def _(spark, folder):
    return tt.assemble_prompt(retrieved(spark, folder), asked(spark, folder))


@register("retrieve_batch", f"""WITH {PROMPTS} SELECT query_id, {prompt_sql('context', 'question')} AS prompt,
round(context_relevance, 6) + 0.0 AS context_relevance FROM b""")
def _(spark, folder):
    """Questions → nearest chunks of all documents → prompt and retrieval score."""
    found = cut_lineage(retrieved(spark, folder))
    return tt.assemble_prompt(found, asked(spark, folder)).join(vx.context_relevance_dense(found), "query_id", "left")


@register("k_sweep", select_sql(f"""{CTX}, e AS (SELECT k, query_id, avg(score) AS cr FROM ctx JOIN (SELECT unnest([1, 2, 3, 5]) AS k) ks ON rank <= k GROUP BY 1, 2),
o AS (SELECT k, avg(cr) AS mean_cr, stddev_pop(cr) AS std_cr FROM e GROUP BY 1)""", "o", "", "mean_cr std_cr", "k"))
def _(spark, folder):
    return vx.k_sweep(retrieved(spark, folder), [1, 2, 3, 5])


@register("hash_embed", f"""WITH {QA_SQL}, {CHUNKS}, {EMBEDDED}
SELECT id // {CHUNK_IDS} AS doc_id, id % {CHUNK_IDS} AS chunk_index, b AS bucket, round(x, 6) + 0.0 AS weight FROM unit WHERE side = 0""")
def _(spark, folder):
    """The numbers above zero of the hashed TF-IDF vectors of all chunks."""
    store = stored(chunks(spark, folder).select("doc_id", "chunk_index", "content"), "chunks")
    return vx.hash_embed(store, "content", DIM).select("doc_id", "chunk_index", F.posexplode("embedding").alias("bucket", "weight")).where("weight > 0")


@register("read_text_docs", f"""
SELECT doc_id, md5({strip_sql("text")}) AS content_md5, 'txt' AS file_type, 1::BIGINT AS page, 1::BIGINT AS total_pages FROM documents""")
def _(spark, folder):
    """The documents written out as one text file each, in the shared folder, and read back whole."""
    from loomwork.session import fresh_path, small_files
    from loomwork.sources.files import read_text_docs, write_text_docs

    path = fresh_path(spark, "texts")
    write_text_docs(table(spark, folder, "documents").select("doc_id", "text"), path)
    ident = F.regexp_extract("source", r"doc_id=(\d+)", 1).cast("bigint").alias("doc_id")
    with small_files(spark):
        read = read_text_docs(spark, path)
        return stored(read.select(ident, F.md5(F.col("content").cast("binary")).alias("content_md5"), "file_type", "page", "total_pages"), "digests")
