"""Suffix dedup, centroid clustering and importance resampling against brute force, and on odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.llm import centroids, resampling, suffix_dedup
from tallymark.llm.queries import QUERIES
from tallymark.llm.registry import ship_package
from tests.conftest import rows
from tests.llm import odd


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


# -- suffix dedup ------------------------------------------------------------------------


def cut_by_hand(docs, length=50):
    first = {}
    raw = [(i, (t or "").encode()) for i, t in docs]
    for i, b in raw:
        for p in range(len(b) - length + 1):
            if i is not None:
                w = b[p : p + length]
                first[w] = min(i, first.get(w, i))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if i is not None and first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out.append((i, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def cut(spark, docs, length=50):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = suffix_dedup.remove_repeats(frame, length=length).collect()
    assert all(r["n_spans"] == len(r["spans"]) for r in found)
    return sorted(
        ((r["doc_id"], r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in found), key=repr
    )


def passages(seed, alphabet):
    """Documents that share pieces of all lengths, some of them in very many documents."""
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    pieces = [text(rng.choice([20, 49, 50, 51, 70, 120, 400])) for _ in range(12)]
    docs = [
        (rng.randrange(500), "".join(rng.choice(pieces) if rng.random() < 0.4 else text(rng.randrange(60)) for _ in range(6)))
        for _ in range(150)
    ]
    line = text(64)
    return docs + [(1000 + i, text(30) + line + text(30)) for i in range(80)]


@pytest.mark.parametrize(("alphabet", "hot"), [("abcdefghijklmnop ", 4096), ("ab", 4096), ("abcdefgh é\U0001f642", 3)])
def test_repeats_equal_brute_force(spark, monkeypatch, alphabet, hot):
    """With few letters, first digits repeat; with a low bound, digits are dealt out by suffix."""
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", (1 << 13, 1 << 13))
    monkeypatch.setattr(suffix_dedup, "SORT_ROWS", 500)
    monkeypatch.setattr(suffix_dedup, "HOT_STRETCHES", hot)
    docs = passages(len(alphabet), alphabet)
    # what is patched here does not reach the workers: the passes run over the same chunks in this process as well
    assert in_process(docs) == cut_by_hand(docs)
    assert cut(spark, docs) == cut_by_hand(docs)


def in_process(docs, length=50, chunks=5, slices=3):
    parts = [[d for j, d in enumerate(docs) if (d[0] or 0) % chunks == c] for c in range(chunks)]
    answers = [{} for _ in parts]
    for passes in range(3):
        sent = []
        for c, p in enumerate(parts):
            chunk = suffix_dedup._Chunk([(t or "").encode() for _, t in p], [i for i, _ in p], length, slices, c)
            sent += [(c, *m) for m in suffix_dedup._next_entries(chunk, answers[c], passes)]
        for kind, home in sorted({(k, h) for _, k, h, _ in sent}):
            group = [(c, d) for c, k, h, d in sent if (k, h) == (kind, home)]
            for (c, _), b in zip(group, suffix_dedup._answer(kind, [d for _, d in group], length)):
                answers[c].setdefault(kind, []).append(b)
    out = []
    for p, heard in zip(parts, answers):
        results = suffix_dedup._results([(t or "").encode() for _, t in p], heard, length)
        for (i, _), *r in zip(p, *(a.to_pylist() for a in results)):
            out.append((i, r[0], r[1], [(s["start"], s["end"]) for s in r[3]], r[4]))
    return sorted(out, key=repr)


def test_equal_windows_is_equality():
    rng = np.random.default_rng(1)
    text = np.frombuffer(bytes(rng.integers(97, 99, 3000).astype(np.uint8)) * 2 + b"b" * 200, np.uint8)
    for length in (16, 23, 50):
        at = rng.permutation(len(text) - length + 1)
        group = suffix_dedup.equal_windows(text, at, length)
        by_group, by_window = {}, {}
        for g, p in zip(group.tolist(), at.tolist()):
            window = text[p : p + length].tobytes()
            assert by_group.setdefault(g, window) == window and by_window.setdefault(window, g) == g


def test_repeats_on_odd_inputs(spark):
    docs = odd.frame(spark)
    found = suffix_dedup.remove_repeats(docs).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in found), key=repr)
    assert got == [(i, n, gone, kept) for i, n, gone, _, kept in cut_by_hand([(r[0], r[1]) for r in odd.ROWS])]
    assert {r["doc_id"]: r["text"] for r in found}[1] is None and found[0]["od.d"] in ("x", None)
    assert suffix_dedup.remove_repeats(odd.empty(spark)).collect() == []
    # rows of one id do not take from each other, and a row without an id is left alone
    same = "the same passage of more than fifty bytes, again and again"
    assert [r[2] for r in cut(spark, [(3, same), (3, same), (None, same), (4, same)])] == [0, 0, len(same), 0]


def test_repeats_of_periodic_text(spark):
    docs = [(1, "ab" * 3000), (2, "x" + "ab" * 1000 + "y"), (3, "a" * 49), (4, "a" * 500), (5, "a" * 51)]
    assert cut(spark, docs) == cut_by_hand(docs)


# -- centroid clustering -----------------------------------------------------------------------


def cluster_by_hand(vectors, clusters=40, rounds=5):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in vectors
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in first[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c for n, c in enumerate(centres)]
    found = [(i, *nearest(v)) for i, v in kept]
    spent = Counter()
    for _, d, n in found:
        spent[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, spent[n], sum(spent.values()), digest[n]) for i, d, n in found), key=repr)


def test_clusters_equal_brute_force(spark):
    rng = random.Random(5)
    base = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(9)]
    vectors = [(i, [x + rng.gauss(0, 0.05 * (1 + i % 3)) for x in rng.choice(base)]) for i in range(150)]
    vectors += [(i, list(vectors[i % 4][1])) for i in range(150, 190)]  # ties
    vectors += [(200, None), (201, []), (202, [0.5] * 63), (203, [None] * 64), (204, [math.nan] * 64), (205, [math.inf] * 64),
                (7, vectors[7][1]), (7, vectors[8][1]), (None, vectors[9][1]), (206, [1000.0] * 64), (207, [-1000.0] * 64)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id bigint, embedding array<double>, cluster string")
    assert rows(centroids.cluster(frame)) == cluster_by_hand(vectors)
    assert centroids.cluster(frame.limit(0)).collect() == []
    few = [(i, v) for i, v in vectors[:7]]
    assert rows(centroids.cluster(spark.createDataFrame(few, "vec_id bigint, embedding array<double>"))) == cluster_by_hand(few)


def test_vectors_too_long_for_a_distance_are_left_out(spark):
    frame = spark.createDataFrame([(1, [1e30] * 64), (2, [0.5] * 64)], "vec_id bigint, embedding array<double>")
    assert [r["vec_id"] for r in centroids.cluster(frame).collect()] == [2]


def test_search_measures_less_than_all():
    rng = np.random.default_rng(3)
    centres = rng.integers(-50, 50, (40, 64)) + rng.integers(-400, 400, (40, 1))
    vectors = np.repeat(centres, 20, axis=0) + rng.integers(-20, 20, (800, 64))
    index = centroids.NearestCentroid(centres)
    label, distance = index.search(vectors)
    exact = ((vectors[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (label == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert index.measured < 0.2 * exact.size


# -- importance resampling --------------------------------------------------------------------------


def draw_by_hand(docs, target):
    def features(text):
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(ws), [zlib.crc32(f.encode()) % 10000 for f in [*ws, *(f"{a} {b}" for a, b in zip(ws, ws[1:]))]]

    source, aim = Counter(), Counter()
    for _, t in docs:
        source.update(features(t)[1])
    for t in target:
        aim.update(features(t)[1])
    s_all, t_all = sum(source.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (s_all + 10000) / ((source[b] + 1) * (t_all + 10000)))) for b in source}
    out = []
    for i, t in docs:
        n, fs = features(t)
        weight = sum(gain[f] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    fit = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): n + 1 for n, r in enumerate(fit[: 25 * len(fit) // 100])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=repr)


def test_resampling_equals_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = rows(QUERIES["op13_resampling"](spark, sf_dir))
    assert found == draw_by_hand(docs, target)
    assert sum(r[4] is not None for r in found) > 20


def test_resampling_on_odd_inputs(spark):
    docs = odd.frame(spark).withColumnRenamed("size", "rank")
    target = spark.createDataFrame([("word1 Word2", 1), (None, 2), ("", 3)], "text string, item_id int")
    names = ["doc_id", "n_features", "weight", "score", "rank"]
    found = resampling.resample(docs, target)
    assert rows(found.select(*names)) == draw_by_hand([(r[0], r[1]) for r in odd.ROWS], ["word1 Word2", "", ""])
    assert "od.d" in found.columns
    assert resampling.resample(odd.empty(spark), target).collect() == []
    assert resampling.resample(docs, target.limit(0)).count() == len(odd.ROWS)


def test_quickselect_with_ties(spark):
    """Half the keys are one value, and every key occurs many times."""
    frame = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 50).alias("a"), (F.col("id") % 3).alias("b")
    )
    keys = sorted((r["a"], r["b"]) for r in frame.collect())
    for k in (1, 2, 777, 1500, 2999, 3000):
        assert resampling.kth_key(frame, ["a", "b"], k) == keys[k - 1]


def test_drawn_ties_fill_the_share_exactly(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(1, text)] * 41, "doc_id bigint, text string")
    found = resampling.resample(docs, docs.limit(1))
    assert sorted(r["rank"] for r in found.collect() if r["rank"]) == list(range(1, 11))
