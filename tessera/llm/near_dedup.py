"""Near-duplicate components by fast similarity sketching, banding and exact verification."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stages, connected_components, join_groups, join_large, join_salted
from .textkit import U, chunks, mix, texts_of, windows, words_of

SIZE = 128  # coordinates of a sketch
BAND_ROWS = 5  # a pair at similarity 0.85 misses all 25 bands less than once in 10^6
CROWD = 8  # members from which a bucket counts the shingles that are a member's own
EMPTY = U(0xFFFFFFFFFFFFFFFF)
_SEEDS = mix(np.arange(1, 2 * SIZE + 1, dtype=U) * U(0x9E3779B97F4A7C15))


def shingle_sets(texts: list, width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle, no words none."""
    words = words_of(texts, ascii_lower=True)
    all_windows = windows(words.hash, width)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= width:
            s = np.sort(all_windows[a : b - width + 1])
            new = np.empty(len(s), bool)
            new[0] = True
            np.not_equal(s[1:], s[:-1], out=new[1:])
            out.append(s[new])
        elif b > a:
            out.append(windows(np.concatenate([words.hash[a:b], np.full(1, U(b - a))]), b - a + 1))
        else:
            out.append(np.zeros(0, U))
    return out


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """One row of SIZE coordinates per set.

    Round i < SIZE throws every element into a random bin with value i plus a
    fraction; round SIZE + j throws all into bin j.  A bin keeps its least value,
    and a set leaves when its bins are full, after about one round if it has
    many elements.  Every bin is full at the end, and the share of equal
    coordinates of two sets concentrates around their similarity.
    """
    n = len(sets)
    out = np.full((n, SIZE), EMPTY, U)
    sizes = np.array([len(s) for s in sets], np.int64)
    if not n or not sizes.sum():
        return out
    flat = out.reshape(-1)
    items, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    done = 0
    while done < 2 * SIZE and len(items):
        rounds = np.arange(done, min(2 * SIZE, done + max(1, min(32, 100_000 // len(items)))), dtype=np.int64)
        x = mix((items[:, None] ^ _SEEDS[rounds][None, :]).reshape(-1))
        r = np.tile(rounds, len(items))
        own_bin = np.where(r < SIZE, (x & U(SIZE - 1)).astype(np.int64), r - SIZE)
        np.minimum.at(flat, np.repeat(owner, len(rounds)) * SIZE + own_bin, (r.astype(U) << U(55)) | (x >> U(9)))
        done = int(rounds[-1]) + 1
        open_rows = (out == EMPTY).any(axis=1)
        stay = open_rows[owner]
        items, owner = items[stay], owner[stay]
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A 64-bit key per band; the band's number is part of it."""
    bands = SIZE // BAND_ROWS
    parts = sketches[:, : bands * BAND_ROWS].reshape(len(sketches), bands, BAND_ROWS)
    key = np.broadcast_to(_SEEDS[:bands], parts.shape[:2]).copy()
    for k in range(BAND_ROWS):
        key = mix(key * U(0xD6E8FEB86659FD93) + parts[:, :, k])
    return key.view(np.int64)


def _signatures(frames):
    for part in chunks(frames):
        sets = shingle_sets(texts_of(part["text"]))
        keys = band_keys(sketch(sets))
        full = [len(s) > 0 for s in sets]
        yield pd.DataFrame({
            "doc_id": part["doc_id"],
            "key": part["key"],
            "n_shingles": [len(s) for s in sets],
            "set_key": [np.array([mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U), mix(s ^ U(0x14057B7EF767814F)).sum(dtype=U), len(s)], U).tobytes() if ok else None for s, ok in zip(sets, full, strict=True)],
            "bands": [k if ok else None for k, ok in zip(keys, full, strict=True)],
        })


def _set_blobs(frames):
    for part in chunks(frames):
        yield pd.DataFrame({"id": part["id"], "items": [s.tobytes() for s in shingle_sets(texts_of(part["text"]))]})


def _items(frames):
    for frame in frames:
        items = [np.frombuffer(x, np.int64) for x in frame["items"]]
        yield pd.DataFrame({"id": np.repeat(frame["id"].to_numpy(np.int64), [len(x) for x in items]), "g": np.concatenate(items)})


def _verifier(percent: int):
    def verify(frames):
        for frame in frames:
            good = []
            for x, y in zip(frame["items_a"], frame["items_b"], strict=True):
                a, b = np.frombuffer(x, U), np.frombuffer(y, U)
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(a) + len(b) - common))
            yield frame.loc[np.array(good, bool), ["a", "b"]]

    return verify


def _text_key(text: str) -> Column:
    """The 128 bits by which a text is known; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _labelled(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(doc_id, key of the text, n_shingles, lead_id, lead_key) of every row; the lead is the row that stands for its component."""
    stages = Stages(docs.sparkSession, "near")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), _text_key(text_col).alias("key"))
    rows = stages.keep(base.mapInPandas(_signatures, "doc_id long, key binary, n_shingles long, set_key binary, bands array<long>"), "signatures")
    total = rows.count()
    # rows with equal sets are one class, under a number of its own, as ids may repeat or be missing
    classes = stages.keep(
        rows.filter("set_key is not null").groupBy("set_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key", "n_shingles", "bands")).alias("r"), F.count("*").alias("members"))
        .select("set_key", "members", F.monotonically_increasing_id().alias("id"), "r.nameless", "r.doc_id", "r.key", F.col("r.n_shingles").alias("n"), F.col("r.bands").alias("bands")),
        "classes",
    )
    spread = classes.select("id", "n", F.explode("bands").alias("bucket"))
    n_spread = classes.count() * (SIZE // BAND_ROWS)
    shared = spread.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
    members = stages.keep(join_large(spread, shared, "bucket", "m", n_spread).select("bucket", "id", "n", "m"), "buckets")
    met = members.select("id", "n").distinct()
    reps = classes.join(met.select("id"), "id", "left_semi").select("id", F.col("key").alias("rep_key"), F.col("doc_id").alias("rep_id"))
    texts = base.join(reps, (F.col("key") == F.col("rep_key")) & F.col("doc_id").eqNullSafe(F.col("rep_id"))).select("id", "text").dropDuplicates(["id"])
    sets = stages.keep(texts.mapInPandas(_set_blobs, "id long, items binary"), "sets")

    # in crowded buckets: how many classes have each shingle
    crowd = members.filter(F.col("m") >= CROWD).select("id", "n").distinct()
    items = sets.join(crowd, "id", "left_semi").mapInPandas(_items, "id long, g long")
    n_items = int(crowd.agg(F.sum("n")).first()[0] or 0)
    shingles = stages.keep(join_groups(items, items.groupBy("g").agg(F.count("*").alias("k")), "g", "k", n_items), "shingles")
    typical = shingles.groupBy("id").agg(F.avg("k").alias("typical"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The written pairs(a, b) that pass on the full sets."""
        n_pairs = pairs.count()
        first = join_salted(pairs, sets.select(F.col("id").alias("a"), F.col("items").alias("items_a")), "a", F.col("b"), n_pairs)
        both = join_salted(first, sets.select(F.col("id").alias("b"), F.col("items").alias("items_b")), "b", F.col("a"), n_pairs)
        return both.select("a", "b", "items_a", "items_b").mapInPandas(_verifier(percent), "a long, b long")

    rated = members.join(typical, "id", "left")
    centers = rated.groupBy("bucket").agg(F.min(F.struct((-F.coalesce("typical", F.lit(0))).alias("r"), "id", "n")).alias("c"), F.count("*").alias("m")).select("bucket", "m", F.col("c.id").alias("center"), F.col("c.n").alias("nc"))
    star = join_groups(members.select("bucket", "id", "n"), centers, "bucket", "m", n_spread).filter(f"id <> center and 100 * least(n, nc) >= {percent} * greatest(n, nc)")
    tried = stages.keep(star.select(F.greatest("id", "center").alias("a"), F.least("id", "center").alias("b")).distinct(), "star-pairs")
    links = stages.keep(confirmed(tried), "star-links")
    comp = stages.keep(connected_components(stages, links), "components")

    # similar classes share one of their rarest shingles, no later in the longer than position n - percent % of n + 1,
    # and in the shorter early enough for what is left to make the overlap of two sets of its size
    early = f"({100 + percent} * (n - pos + 1) >= {2 * percent} * n)"
    prefix = (
        shingles.join(met, "id").withColumn("pos", F.row_number().over(Window.partitionBy("id").orderBy("k", "g")))
        .filter(f"100 * (n - pos + 1) >= {percent} * n and k > 1").select(F.col("g").alias("bucket"), "id", "n", "pos")
    )
    places = members.filter(F.col("m") < CROWD).select("bucket", "id", "n", F.lit(1).alias("pos")).unionByName(prefix)
    placed = stages.keep(places.join(comp, "id", "left").select("bucket", "id", "n", "pos", F.coalesce("component", "id").alias("comp"), F.expr(early).alias("early")), "placed")
    parts = placed.groupBy("bucket", "comp").agg(F.count("*").alias("k"), F.max("early").alias("early"))
    split = parts.groupBy("bucket").agg(F.max(F.struct("k", "comp")).alias("top"), F.count("*").alias("parts"), F.sum("k").alias("m"), F.max("early").alias("early"))
    split = split.filter("parts > 1 and early").select("bucket", "m", F.col("top.comp").alias("main"))
    open_rows = stages.keep(join_groups(placed, split, "bucket", "m", placed.count()).filter("main is not null"), "open")
    outside = open_rows.filter("comp <> main").select("bucket", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"), F.col("comp").alias("cx"), F.col("early").alias("ex"))
    most = "least(nx - px, n - pos) + 1"  # what two classes can share from these positions on
    fit = f"cx <> comp and 100 * ({most}) >= {percent} * (nx + n - ({most}))"
    short = outside.filter("ex").join(open_rows, "bucket").filter(f"nx <= n and {fit}")
    long = outside.join(open_rows.filter("early"), "bucket").filter(f"nx >= n and {fit}")
    rest = short.unionByName(long).select(F.greatest("x", "id").alias("a"), F.least("x", "id").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    more = stages.keep(confirmed(stages.keep(rest, "rest-pairs")), "rest-links")
    if not more.isEmpty():
        comp = stages.keep(connected_components(stages, links.unionByName(more)), "components")
    own = stages.keep(classes.join(comp, "id", "left").select("set_key", "members", "nameless", "doc_id", "key", F.coalesce("component", "id").alias("component")), "own")
    leads = own.groupBy("component").agg(F.min(F.struct("nameless", "doc_id", "key")).alias("lead"), F.count("*").alias("m")).select("component", "m", F.col("lead.doc_id").alias("lead_id"), F.col("lead.key").alias("lead_key"))
    labelled = join_groups(own.select("set_key", "members", "component"), leads, "component", "m", total).select("set_key", "members", "lead_id", "lead_key")
    return join_groups(rows.select("doc_id", "key", "n_shingles", "set_key"), labelled, "set_key", "members", total)


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """Link texts whose shingle sets have 100 * |A and B| >= percent * |A or B|; label components.

    Rows with equal sets form a class first, however many they are.  Classes
    meet in band buckets, and each bucket compares its members with one of them,
    the one whose shingles are the most widespread, never all with all.  What a
    bucket then still holds apart is compared further: in a small bucket, members
    of different components; in crowded ones, classes of different components
    that share one of their rarest shingles early enough to be similar (the exact
    prefix filter).  So no link between candidate classes is lost, and each is
    confirmed on the full sets.

    Null or empty texts have n_shingles 0 and stay alone.  Returns id_col,
    n_shingles, component_id (least id of the component) and kept (id equals
    component_id), one row per input row.  Each row is judged by its own text: rows
    that repeat an id link by every text they have, and rows without an id
    link like others but never lead a component that has one (component_id is
    null where none has).
    """
    out = _labelled(docs, id_col, text_col, percent)
    label = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("lead_id"))
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", label.alias("component_id"), F.col("doc_id").eqNullSafe(label).alias("kept"))


def drop_near_copies(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of docs that lead their component, with their columns; rows without words stay.

    The lead has the least id, and of texts under that id the first by hash; rows
    that repeat both stay together.  Where no row of a component has an id, the
    text that is first by hash stays.
    """
    rows = _labelled(docs, "doc_id", "text", percent).filter("set_key is not null")
    gone = rows.filter(~(F.col("doc_id").eqNullSafe(F.col("lead_id")) & (F.col("key") == F.col("lead_key")))).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    own = _text_key("text")
    return docs.join(gone, (own == F.col("_key")) & docs["doc_id"].cast("long").eqNullSafe(F.col("_id")), "left_anti").select(*docs.columns)
