"""SimHash, embeddings and components against all pairs."""

import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import local_frame
from llm_cases import awkward, awkward_rows, empty, smallest_reachable
from pyspark.sql import functions as F

from revmart.llm import embeddings, simhash
from revmart.llm.components import connected_components
from revmart.llm.queries import QUERIES


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_all_pairs(spark):
    rows = awkward_rows()
    fps = [plain_fingerprint(r[1]) for r in rows]
    want = smallest_reachable([r[0] for r in rows], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    got = simhash.near_duplicates(awkward(spark)).select("doc_id", simhash.hex_digits(F.col("fp")), "component_id").collect()
    assert Counter(map(tuple, got)) == Counter((r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, want))


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 5])
def test_fingerprint_links_are_complete(spark, bits):
    rng = random.Random(bits)
    fps = set()
    for _ in range(40):
        centre = rng.getrandbits(64)
        for flips in range(6):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), flips)))
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    links = simhash.linked_fingerprints(local_frame(spark, [(f,) for f in signed], "fp long"), bits).collect()
    got = {frozenset((a, b)) for a, b in links}
    mask = (1 << 64) - 1
    want = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= bits}
    assert got == want


def test_simhash_judges_texts_of_one_id_apart(spark):
    words = " ".join(f"w{i}" for i in range(200))
    rows = [(5, words), (9, words), (9, "quite another text here"), (9, "quite another text here"), (7, "and a third one")]
    kept = simhash.keep_one(local_frame(spark, rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect())) == [(5, words), (7, "and a third one"), (9, "quite another text here")]


def test_simhash_keeps_one_row_of_each_group(spark):
    rows = awkward_rows()
    kept = simhash.keep_one(awkward(spark))
    fps = [plain_fingerprint(r[1]) for r in rows]
    names = smallest_reachable([r[0] for r in rows], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    roots = smallest_reachable(fps, lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    named = {(r[0], root) for r, c, root in zip(rows, names, roots) if r[0] is not None and r[0] == c}
    want = Counter(i for i, _ in named) + Counter([None])
    assert Counter(r["doc_id"] for r in kept.select("doc_id").collect()) == want
    assert kept.columns == awkward(spark).columns
    assert simhash.keep_one(empty(spark)).count() == 0
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201)]
    got = {r["node"]: r["root"] for r in connected_components(local_frame(spark, links, "a long, b long")).collect()}
    want = {i: 1 for i in range(2, 61)} | {i: 100 for i in range(101, 140)} | {201: 200}
    assert got == want


def plain_vectors(rows, threshold=0.98):
    def usable(v, label):
        return v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def linked(i, j):
        (_, v, a), (_, w, b) = rows[i], rows[j]
        if not usable(v, a) or not usable(w, b) or a != b or len(v) != len(w):
            return False
        x, y = np.array(v, float), np.array(w, float)
        return x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold

    n = [sum(linked(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    return n, smallest_reachable([r[0] for r in rows], linked)


def vector_rows():
    rng = np.random.default_rng(5)
    rows = []
    for c in range(12):
        centre = rng.normal(size=8)
        for i in range(6):
            rows.append((c * 6 + i, (centre + rng.normal(size=8) * rng.choice([0.0, 0.05, 0.1])).astype(np.float32).tolist(), c % 3))
    odd = [None, [], [0.0] * 8, [1.0, None] + [1.0] * 6, [math.nan] * 8, [math.inf] + [0.0] * 7, [1.0, 2.0], [2.0, 4.0]]
    rows += [(100 + i, v, 1) for i, v in enumerate(odd)]
    rows += [(120, rows[0][1], None), (121, rows[0][1], 0), rows[3]]
    return rows


@pytest.mark.parametrize("tile", [4, 1024])
def test_embeddings_against_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    rows = vector_rows()
    frame = local_frame(spark, [(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<float>, label int, node long, key long, copies long")
    n, names = plain_vectors(rows)
    got = embeddings.near_vectors(frame).collect()
    assert Counter(map(tuple, got)) == Counter((r[0], k, c, r[0] == c) for r, k, c in zip(rows, n, names))


def test_no_embeddings(spark):
    frame = local_frame(spark, [], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_vectors(frame).count() == 0


def test_embedding_query_at_small_scale(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in QUERIES["op9_embeddings"](spark, "/root/testdata/sf0.001").collect()}
    x = np.array([r[1] for r in rows], float)
    cos = x @ x.T / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1))
    same = np.equal.outer([r[2] for r in rows], [r[2] for r in rows])
    near = (cos >= 0.98) & same & ~np.eye(len(rows), dtype=bool)
    names = smallest_reachable([r[0] for r in rows], lambda i, j: near[i, j])
    assert got == {r[0]: (int(k), c) for r, k, c in zip(rows, near.sum(axis=1), names)}
