import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import toxicity
from tessera.llm.language_id import LanguageFilter, grams, held_out, identify, keep_identified, train
from tessera.llm.toxicity import Learning, TextCnn, _features, best_threshold, learning_round, score_toxicity, thresholds
from tessera.llm.toxicity import train as train_toxicity

PARTS = {"en": "the ing tion er th on re".split(), "de": "sch ung keit ein ge ver ü".split(), "fr": "eau oi ment é que aux ier".split()}


def sentence(rng, lang, n=40):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def labelled(seed=1, n=300):
    rng = random.Random(seed)
    return [(i, sentence(rng, lang), lang) for i, lang in enumerate(rng.choices(list(PARTS), k=n))]


def test_held_out_is_crc32(make):
    docs = make([(i, "") for i in range(50)] + [(None, "")])
    got = [r[0] for r in docs.orderBy("doc_id").select(held_out(docs["doc_id"])).collect()]
    assert got == [False, *(zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50))]


def test_grams_keep_words_apart():
    gram, owner, has = grams(["ab", "", None, "1 2", "a b"])
    assert has.tolist() == [True, False, False, False, True]
    one = set(gram[owner == 0].tolist())
    alone, _, _ = grams(["ab"])
    assert one == set(alone.tolist()) and len(one) == 6  # " a", "ab", "b ", " ab", "ab ", " ab "


def test_bloom_has_no_false_negative_and_few_false_positives():
    rng = np.random.default_rng(0)
    gram = rng.integers(0, 2**63, 5000).astype(np.uint64)
    mask = rng.integers(1, 8, 5000).astype(np.uint64)
    f = LanguageFilter.build(["a", "b", "c"], gram, mask, 1 << 16, 2)
    assert ((f.lookup(gram) & mask) == mask).all()
    other = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    seen = np.array([((f.lookup(other) >> np.uint64(b)) & np.uint64(1)).mean() for b in range(3)])
    assert np.allclose(seen, f.false_positive, atol=0.01)


def test_every_language_is_learnt(make):
    def words(k, rng, n=30):
        return " ".join("".join(chr(0x4E00 + 40 * k + rng.randrange(20)) for _ in range(4)) for _ in range(n))

    rng = random.Random(3)
    rows = [(k * 20 + j, words(k, rng), f"l{k:03d}") for k in range(70) for j in range(20 if k < 69 else 12)]
    rows += [(5000 + k, words(k, rng), None) for k in range(70)]
    got = {r["doc_id"]: r["lang_pred"] for r in identify(make(rows), train(make(rows))).collect()}
    assert [got[5000 + k] for k in range(70)] == [f"l{k:03d}" for k in range(70)]


def test_scores_equal_a_plain_count(make):
    """Popcounts over the filters give what counting the n-grams one by one gives."""
    rows = labelled(5, 60)
    model = train(make(rows))
    for text in [rows[0][1], "Über-größe 12 the", "z", "", None, "1 2"]:
        gram, _, has = grams([text])
        hits = [sum(all(int(model.slots[model.probe(np.array([g]), k, len(model.slots))[0]]) >> b & 1 for k in range(model.hashes)) for g in gram) for b in range(3)]
        right = [max(h - len(gram) * f, 0) / (1 - f) for h, f in zip(hits, model.false_positive, strict=True)]
        names, score, covered = model.predict([text])
        if not has[0]:
            assert names == ["und"] and score[0] == covered[0] == 0
            continue
        assert names[0] == model.languages[int(np.argmax(right))] and abs(covered[0] - max(right) / len(gram)) < 1e-12
        assert sum(right) == 0 or abs(score[0] - max(right) / sum(right)) < 1e-12


def test_filters_are_sized_by_their_ngrams():
    rng = np.random.default_rng(1)
    for n in (100, 50_000, 400_000):
        slots = LanguageFilter.slots_for(n, 2, 0.03)
        f = LanguageFilter.build(["a"], rng.integers(0, 2**63, n).astype(np.uint64), np.ones(n, np.uint64), slots, 2)
        assert f.false_positive[0] <= 0.031


def test_rare_language_keeps_its_grams(make):
    rng = random.Random(4)
    big = [(i, sentence(rng, lang), lang) for i, lang in enumerate(rng.choices(["en", "fr"], k=200))]
    rare = "мама мыла раму"
    docs = make([*big, (1000, rare, "ru"), (1001, rare, None)])  # the crc32 of 1000 is not held out
    assert zlib.crc32(b"1000") % 4 != 2
    model = train(docs)
    got = {r["doc_id"]: r for r in identify(docs, model).collect()}
    assert got[1001]["lang_pred"] == "ru" and got[1001]["coverage"] > 0.9
    assert 1001 in {r["doc_id"] for r in keep_identified(docs, model).collect()}


def test_language_accuracy_and_edges(spark, make):
    rows = labelled()
    odd = [(1000, None, None), (1001, "123 !!", "en"), (1002, "", "de"), (None, sentence(random.Random(9), "fr"), "fr"), (1003, sentence(random.Random(4), "de", 20_000), None)]
    docs = make(rows + odd)
    model = train(docs)
    got = {r["doc_id"]: r for r in identify(docs, model).collect()}
    test = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i]["lang_pred"] == lang for i, lang in test) >= 0.98 * len(test) > 0
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1003]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[1000]["score"] == 0
    kept = {r["doc_id"] for r in keep_identified(docs, model).collect()}
    assert kept == set(got) - {1000, 1001, 1002}
    assert train(make([])) is None and train(make([(1, "text", None)])) is None
    assert identify(make(rows[:3]), None).filter("lang_pred = 'und'").count() == 3


def test_training_ignores_held_out_rows(make):
    rows = labelled(3)
    lie = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    assert "xx" not in train(make(lie)).languages


def test_toxicity_accuracy_and_edges(spark, make):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(500):
        lang, bad = rng.choice(["en", "de"]), i % 4 == 0
        w = sentence(rng, lang).split()
        if bad:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["idiot", "scum", "trash"]) if lang == "en" else "lowei" + rng.choice(["ung", "heit", "en", "st"])
        rows.append((i, " ".join(w), lang))
        labels.append((i, int(bad)))
    table = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    docs = make([*rows, (1000, None, None), (1001, "", "en"), (1002, "hallo loweixyz und " * 3000, "de")])
    model = train_toxicity(docs, table, epochs=8)
    got = {r["doc_id"]: r for r in score_toxicity(docs, model).collect()}
    test = [(i, t) for i, t in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((got[i]["score"] >= 0.3) == bool(t) for i, t in test) >= 0.95 * len(test)
    assert got[1000]["score"] == got[1001]["score"] < 0.3 and got[1002]["score"] > 0.3
    assert set(model.thresholds) == {"en", "de"}
    assert train_toxicity(docs, table.limit(0)) is None and score_toxicity(make([(1, "x")]), None).first()["score"] == 0
    assert train_toxicity(make([]), table) is None


@pytest.mark.parametrize("texts", [["a b", ""], [""], [None], ["", "a"], ["a", "", None, ""], ["a b c d e", None], ["x" * 9000, "y " * 9000, ""]])
def test_scores_equal_the_forward_pass_wherever_empty_texts_stand(texts):
    net = TextCnn.start()
    got = net.score(texts, net.tables())
    rows, starts, sizes = _features(texts)
    r = net._responses(net.embedding[rows].sum(axis=1))
    pooled = np.stack([np.maximum(r[s : s + max(1, n)].max(axis=0) + net.bias, 0) for s, n in zip(starts, sizes, strict=True)])
    assert np.allclose(got, 1 / (1 + np.exp(-(pooled @ net.weights + net.offset))), atol=1e-5)
    assert np.allclose(got, [net.score([t], net.tables())[0] for t in texts], atol=1e-6)


def test_learning_from_empty_texts(spark, make):
    TextCnn.start().fit(["a b", "", "idiot", None], np.array([0, 0, 1, 1]), epochs=6)
    docs = make([(1, "a b"), (2, ""), (3, None)]).coalesce(1)
    model = train_toxicity(make([(k, "bad" if k % 2 else "") for k in range(40)]), spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int"))
    assert [r["doc_id"] for r in score_toxicity(docs, model).filter("score between 0 and 1").collect()] == [1, 2, 3]


def test_best_threshold():
    assert best_threshold(np.array([0.1, 0.9, 0.8]), np.array([0, 1, 1])) == (0.8 + 0.1) / 2
    assert best_threshold(np.array([0.1]), np.array([0])) == 0.5


def test_toxicity_learns_from_every_labelled_row(spark, make):
    """A word that only one text has gets its embedding from that text, however many rows there are and however long they are."""
    n = 4000
    texts = {i: f"w{i}" if i % 100 else f"w{i} " * 25_000 for i in range(n)}
    model = train_toxicity(make(list(texts.items())), spark.createDataFrame([(i, i % 2) for i in range(n)], "doc_id long, toxic int"), epochs=1)
    checks = {r["id"] for r in spark.range(n).filter(F.xxhash64("id").bitwiseAND(F.lit(3)) == 0).collect()}
    learnt = [i for i in range(n) if i not in checks and zlib.crc32(str(i).encode()) % 4 != 2]
    at = _features([f"w{i}" for i in learnt])
    own = at[0][at[1], 0]
    changed = (model.network.embedding[own] != TextCnn.start().embedding[own]).any(axis=1)
    assert len(learnt) > 2000 and any(len(texts[i]) > 100_000 for i in learnt) and changed.all()


def test_a_round_averages_what_its_learners_change(spark):
    rows = [("a b scum", 1), ("a c", 0), ("d e f", 0), ("a scum", 1), (None, 0), ("", 1)]
    parts = [rows[:2], rows[2:]]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).mapPartitionsWithIndex(lambda k, _: parts[k]), "text string, toxic int")
    start = Learning.start(TextCnn.start())
    got = learning_round(df, start, 4)
    alone = [start.copy() for _ in parts]
    for k, (own, part) in enumerate(zip(alone, parts, strict=True)):
        own.learn([t for t, _ in part], np.array([y for _, y in part]), np.random.default_rng((11, 4, k)))
    met = [(x.squares["e"] != start.squares["e"]).any(axis=1) for x in alone]
    change = sum(x.words() - start.words() for x in alone) / np.maximum(1, sum(m.astype(int) for m in met))[:, None]
    assert (met[0] & met[1]).any() and (met[0] ^ met[1]).any() and np.allclose(got.words(), start.words() + change, atol=1e-6)
    assert np.allclose(got.rest(), (alone[0].rest() + alone[1].rest()) / 2, atol=1e-5)
    assert learning_round(df.limit(0), start, 0) is start


def test_peaks_of_long_texts_in_blocks(monkeypatch):
    rows, starts, sizes = _features(["a b c d e f g h i j k l m n o p q r s t", "", "x y", " ".join(f"z{k}" for k in range(40))])
    want = TextCnn.start()._peaks(rows, starts, sizes)
    monkeypatch.setattr(toxicity, "_BLOCK", 7)
    got = TextCnn.start()._peaks(rows, starts, sizes)
    assert (got[0] == want[0]).all() and np.allclose(got[1], want[1])


def test_thresholds_equal_the_plain_ones(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["en", "de", None]), rng.random(), rng.randrange(2)) for _ in range(300)] + [("fr", 0.99, 0), ("es", 0.5, 1)]
    by, default = thresholds(spark.createDataFrame(rows, "lang string, score double, toxic int"))
    plain = lambda own: best_threshold(np.array([s for _, s, _ in own]), np.array([y for *_, y in own]))
    assert by == {x: plain([r for r in rows if r[0] == x]) for x in ("en", "de", "es")} and default == plain(rows)
    assert thresholds(spark.createDataFrame([], "lang string, score double, toxic int")) == ({}, 0.5)
    # a tie is marked as a whole
    assert thresholds(spark.createDataFrame([("en", 0.9, 1), ("en", 0.9, 0), ("en", 0.1, 0)], "lang string, score double, toxic int"))[1] == 0.5
