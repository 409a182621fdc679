"""Small tables with the awkward cases, and plain versions of what the operators compute."""

from __future__ import annotations

import random

from conftest import local_frame

DDL = (
    "doc_id long, text string, lang string, source string, n_chars int, size long, fp long, shard int, slot long, version long, "
    "tokens string, words string, score double, mix string, n_entities string, toxicity string, round_trip string, kept string, "
    "component_id long, block int, part int, target double, place int, held string, code long, p double, _q double, query_id long"
)
EXTRA = (None,) * 23


def sentences(seed: int, n: int, words: int = 60) -> list[str]:
    rng = random.Random(seed)
    pool = ["".join(rng.choice(["the", "ing", "an", "or", "est", "ly"]) for _ in range(rng.randint(1, 3))) for _ in range(80)]
    return [" ".join(rng.choice(pool) for _ in range(words)) for _ in range(n)]


def awkward_rows() -> list[tuple]:
    base = sentences(1, 12)
    long = " ".join(sentences(2, 1, 30_000))
    texts = {
        0: None,
        1: "",
        2: " \n\t ",
        3: long,
        4: base[0],
        5: base[0],
        6: base[0] + " " + base[1],
        7: base[2].upper(),
        8: "one",
        9: "日本語 テキスト é ß 𝔘 <|endoftext|> mail a.b@mail7.example.com",
        10: "x" * 5000 + " " + " " * 3000 + "y",
        12: "same " * 400,
        14: base[3],
    }
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in texts.items()]
    rows += [rows[5], rows[5]]  # repeated rows
    rows += [(20, base[4], None, None, None), (21, base[5], None, None, None), (None, base[4], "en", "src0", 1)]
    rows += [(14, base[6], "en", "src1", 2)]  # an id with two texts
    return [r + EXTRA for r in rows]


def awkward(spark):
    return local_frame(spark, awkward_rows(), DDL)


def empty(spark):
    return local_frame(spark, [], DDL)


def smallest_reachable(ids, linked):
    """Smallest id reachable from each place by ``linked(i, j)``."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                root[find(i)] = find(j)
    groups = {}
    for i, x in enumerate(ids):
        groups.setdefault(find(i), []).append(x)
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(ids))]
