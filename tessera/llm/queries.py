"""Queries of the corpus operators for the driver's entry module."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import contaminated
from .exact_dedup import exact_dedup
from .html_text import extract_main_text
from .language_id import held_out, identify, train
from .near_dedup import near_components
from .packing import pack
from .secret_scan import digest, find_secrets
from .substring_dedup import remove_repeats
from .toxicity import score_toxicity
from .toxicity import train as train_toxicity
from .warc import build_derivatives, responses


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words left when windows of 35 words that stand elsewhere too are gone.

    Null and empty texts lose nothing (0 words); equal texts of 35 words or more
    lose all; rows that repeat an id are judged row by row; no rows give none.
    """
    return remove_repeats(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in a batch of its length bucket, by words.

    Null and empty texts have length 0; a text longer than the budget is alone in
    its batch; ties and repeated rows take places of their own.
    """
    return pack(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that a window of it resembles at 0.8 or more.

    Null and empty texts and items match nothing; rows without an id or repeating
    one report one by one, repeated items once.
    """
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score in 0..1 for every document, whether it is marked at 0.3, and whether its id is held out.

    Null and empty texts get the score of a text without words; without labels to
    learn from all scores are 0; an id that is null counts as "".
    """
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.withColumns({"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= 0.3).cast("int")})


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page.

    Null and empty pages give an empty text; a page alone on its host is not
    differenced; copies of a page, repeated rows too, get the same text.
    """
    return extract_main_text(table(spark, sf_dir, "pages"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base spans, their hash, and all spans of every document.

    Null and empty texts have none, with the hash of the empty string; rows that
    repeat get equal results.
    """
    return digest(find_secrets(table(spark, sf_dir, "documents")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document and whether its id is held out.

    Null texts and texts without a letter are "und" with score 0, and all are
    where there is nothing to learn from; of equal evidence the first name wins.
    """
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs)).withColumn("held_out", held_out(F.col("doc_id")))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the largest id of its group of equal texts.

    Null counts as the empty text; rows without an id never stay where one has
    an id; rows that repeat id and text agree.
    """
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the least id reachable over links of 0.85 or more.

    Null and empty texts are alone; rows that repeat an id link by each of their
    texts; a component without any id has none.
    """
    return near_components(table(spark, sf_dir, "documents"), percent=85)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page's response, blocks as digests.

    Null pages have an empty body; repeated rows give equal records under equal ids.
    """
    out = build_derivatives(responses(table(spark, sf_dir, "pages")))
    return out.withColumn("headers", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("headers"))))).withColumn("block_sha256", F.sha2("block", 256)).drop("block")


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_packing": op2_packing,
    "op3_decontaminate": op3_decontaminate,
    "op4_toxicity": op4_toxicity,
    "op5_html_text": op5_html_text,
    "op6_secret_scan": op6_secret_scan,
    "op7_language_id": op7_language_id,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_near_dedup": op9_near_dedup,
    "op10_warc": op10_warc,
}

SQL = {
    "op1_substring_dedup": """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, p, md5(array_to_string(w[p : p + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
r AS (SELECT doc_id, p FROM s WHERE h IN (SELECT h FROM s GROUP BY h HAVING count(*) > 1)),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS k FROM r),
x AS (SELECT doc_id, k, w[k] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM d)),
t AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.k) AS kept, count(*) AS n FROM x ANTI JOIN g ON x.doc_id = g.doc_id AND x.k = g.k GROUP BY 1)
SELECT d.doc_id, len(w)::bigint AS n_words, len(w)::bigint - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN t USING (doc_id)""",
    "op8_exact_dedup": """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)""",
    "op9_near_dedup": """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5_number(array_to_string(w[p : p + 4], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT x, y FROM i JOIN n a ON x = a.doc_id JOIN n b ON y = b.doc_id WHERE 100 * k >= 85 * (a.n + b.n - k)),
c AS (SELECT doc_id AS id, doc_id AS c FROM d UNION SELECT e.y, c.c FROM c JOIN e ON c.id = e.x WHERE c.c < e.y)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept FROM d JOIN (SELECT id, min(c) AS c FROM c GROUP BY 1) m ON d.doc_id = m.id LEFT JOIN n USING (doc_id)""",
}
