"""The pipeline against plain versions of its stages, and its stages on odd inputs."""

import os
import random
import sys

import brute
import duckdb
import pandas as pd
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "../.."))

import corpus_pipeline as P
from tessera.llm import queries as Q
from tessera.llm.language_id import identify, train

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, make):
    """A small corpus whose columns clash with names that operators use, with every odd row there is."""
    rng = random.Random(4)
    words = {"en": "the and with that this from have".split(), "de": "und der die das nicht auch eine".split()}

    def text(lang, n):
        return " ".join(rng.choice(words[lang]) + rng.choice(["", "a", "e", "o"]) + str(rng.randrange(40)).translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(n))

    rows = [(k, text(lang, rng.choice([8, 40, 90])), lang) for k, lang in enumerate(rng.choices(["en", "de"], k=60))]
    rows += [(100 + k, rows[k][1].upper() if k % 2 else rows[k][1], "en") for k in range(10)]  # copies
    for k in range(10):  # near copies
        w = rows[k + 20][1].split()
        w[len(w) // 2] = "changed"
        rows.append((200 + k, " ".join(w), "de"))
    items = [text("en", 20) for _ in range(3)]
    rows += [(300 + k, f"{text('en', 20)} {items[k]} {text('en', 20)}", "en") for k in range(3)]
    rows += [(400, None, "en"), (401, "", None), (402, "12 34 !!", "en"), (None, text("en", 30), "en"), (None, items[0], None), (5, text("en", 30), "en"), (403, text("de", 9000), "de"), rows[7], rows[7]]
    path = str(tmp_path_factory.mktemp("corpus"))
    make(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([*enumerate(items), (9, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def kept_by_hand(spark, make, rows, items):
    """Indexes of the rows that reach packing."""
    docs = make(rows)
    named = {r["doc_id"]: r for r in identify(docs.filter("doc_id is not null"), train(docs)).collect()}
    stay = [k for k, (i, t, _) in enumerate(rows) if i is None or named[i]["lang_pred"] != "und"]
    best = {}
    for k in stay:
        key = rows[k][1].translate(brute.LOWER)
        best[key] = max(best.get(key, -1), -1 if rows[k][0] is None else rows[k][0])
    stay = [k for k in stay if best[rows[k][1].translate(brute.LOWER)] == (-1 if rows[k][0] is None else rows[k][0])]
    label = {k: c for k, (_, c) in brute.near_components([(k, rows[k][1]) for k in stay], 80).items()}
    groups = {}
    for k in stay:
        groups.setdefault(label[k], []).append(k)
    lead = {c: min((rows[k][0] is None, rows[k][0] or 0) for k in g) for c, g in groups.items()}
    stay = [k for k in stay if (rows[k][0] is None, rows[k][0] or 0) == lead[label[k]]]
    return [k for k in stay if not any(item in rows[k][1] for item in items)]


def test_pipeline_equals_plain_stages(spark, make, folder):
    path, rows, items = folder
    got = P.run(spark, path).collect()
    want = sorted((-1 if rows[k][0] is None else rows[k][0], len(brute.words(rows[k][1]))) for k in kept_by_hand(spark, make, rows, items))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"]) for r in got) == want
    assert {300, 301, 302, 400, 401, 402}.isdisjoint({r["doc_id"] for r in got}) and [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontaminate", "packing"]


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_stages_on_odd_tables(spark, make, folder, name, stage):
    path, rows, _ = folder
    odd = make([(1, None), (2, ""), (None, None), (None, "a b c"), (3, "x" * 200_000), (4, "a b c"), (4, "a b c"), (4, "other words")])
    for docs in (odd, odd.limit(0)):
        out = stage(spark, docs, path)
        assert name == "packing" or out.columns == docs.columns
        assert out.count() <= docs.count()


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_queries_equal_their_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got, want = Q.QUERIES[name](spark, DATA).toPandas(), duck.execute(Q.SQL[name]).df()

    def normal(df):
        return df[sorted(df.columns)].astype(str).sort_values(sorted(df.columns)).reset_index(drop=True)

    assert len(got)
    pd.testing.assert_frame_equal(normal(got), normal(want))
