"""SimHash near-duplicates, candidates pruned by the pigeonring principle.

A fingerprint's 64 bits form a ring of ``m = max_bits + 1`` segments.  If two fingerprints differ in at most
``max_bits`` bits, some segment starts a chain around the ring whose first ``l`` segments differ in at most
``l * max_bits / m`` bits, for every ``l``: none in the first, one at most in the first two, and so on.  (The
pigeonhole principle gives only the first of these.)  The first two conditions are the join key: the first
segment and the second one as it is, or with one set bit cleared, since of two segments that differ in one bit one is
the other with that bit cleared.  The key has about ``128 / m`` bits, so keys stay rare among billions of
fingerprints.  The rest of the chain and the whole Hamming distance are checked as the join's condition.

Equal fingerprints are grouped first and linked once; components are found on distinct fingerprints only.

Defined cases: a null text counts as the empty text, whose fingerprint is zero and is linked like any other; texts with
fewer words than a shingle form one shingle; rows with a null ``doc_id`` take part, but never name a component unless
it has no other member; repeated rows get the same result each; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import text_of, unused
from revmart.llm.components import connected_components
from revmart.operators.lineage import cut_lineage

BITS = 64
#: The seed of the shingle hash.
SEED = 42
#: Shingles hashed and counted at a time, which bounds the memory for very long texts.
BLOCK = 1 << 16


def fingerprint(text: str, shingle: int) -> int:
    """64-bit SimHash of the lower-cased (A-Z) text's word shingles, repeats included."""
    words = text.encode().lower().split()  # bytes: exactly the ASCII white space and letters
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        hashes = [digest(joined[i:j], SEED) for i, j in zip(first[at : at + BLOCK], last[at : at + BLOCK])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """Return ``doc_id, digest, fp`` (64 bits of the text's hash, the fingerprint as a signed long) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
            arrays = [batch.column(0), batch.column(1), pa.array(values.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "digest", "fp"])

    narrow = docs.select("doc_id", F.xxhash64(text_of()).alias("digest"), text_of().alias("text"))
    return narrow.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, digest long, fp long")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the ring's segments."""
    m = max_bits + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment(value: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1))


def _within(difference: Column, ring: list[tuple[int, int]], start: int, max_bits: int) -> Column:
    """Whether the chain from ``start`` keeps to its budgets; its whole length is the Hamming check."""
    found, bits = F.lit(True), F.lit(0)
    for length in range(1, len(ring) + 1):
        bits = bits + F.bit_count(_segment(difference, *ring[(start + length - 1) % len(ring)]))
        found = found & (bits <= length * max_bits // len(ring))
    return found


def _key(i: int, first: Column, second: Column) -> Column:
    return F.struct(F.lit(i).alias("i"), first.alias("k1"), second.alias("k2"))


def _probes(i: int, first: Column, second: Column, width: int) -> Column:
    """Keys with the second segment as it is and with each of its set bits cleared."""
    set_bits = F.filter(F.array(*[F.lit(1 << b) for b in range(width)]), lambda b: second.bitwiseAND(b) != 0)
    cleared = F.transform(set_bits, lambda b: _key(i, first, second.bitwiseXOR(b)))
    return F.concat(F.array(_key(i, first, second)), cleared)


def linked_fingerprints(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Links ``a, b`` between different fingerprints of ``distinct`` (fp) at most ``max_bits`` apart."""
    if max_bits == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    ring = segments(max_bits)
    m = len(ring)
    stored, probes, fits = [], [], F.lit(False)
    difference = F.col("a").bitwiseXOR(F.col("b"))
    for i in range(m):
        own, (low, width) = ring[i], ring[(i + 1) % m]
        first, second = _segment(F.col("fp"), *own), _segment(F.col("fp"), low, width)
        stored.append(_key(i, first, second))
        probes.append(_probes(i, first, second, width))
        fits = fits | ((F.col("p.i") == i) & _within(difference, ring, i, max_bits))
    index = distinct.select(F.col("fp").alias("a"), F.inline(F.array(*stored))).alias("s")
    probe = distinct.select(F.col("fp").alias("b"), F.inline(F.concat(*probes))).alias("p")
    same_key = (F.col("s.i") == F.col("p.i")) & (F.col("s.k1") == F.col("p.k1")) & (F.col("s.k2") == F.col("p.k2"))
    return index.join(probe, same_key & (F.col("a") != F.col("b")) & fits).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Return ``doc_id, fp, component_id, digest, root`` for every row.

    The smallest ``doc_id`` reachable names a component; its smallest fingerprint, the root, tells components of one name apart.
    """
    rows = cut_lineage(fingerprints(docs, shingle))
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_doc")))
    links = linked_fingerprints(distinct.select("fp"), max_bits)
    roots = connected_components(links)
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_doc", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    components = rooted.join(named, "root").select("fp", "component_id", "root")
    return rows.join(components, "fp").select("doc_id", "fp", "component_id", "digest", "root")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of ``docs`` of each component: of the rows whose ``doc_id`` names it, those with the smallest text hash, once.

    Rows of one id whose texts lie in different components are judged apart; rows with a null id all stay, since
    no component is theirs to name.
    """
    digest = unused("digest", docs)
    names = near_duplicates(docs, shingle, max_bits).where("doc_id = component_id")
    kept = names.groupBy("doc_id", "root").agg(F.min("digest").alias(digest)).select("doc_id", digest)
    keyed = docs.withColumn(digest, F.xxhash64(text_of()))
    stays = keyed.join(kept, ["doc_id", digest], "left_semi").dropDuplicates(["doc_id", digest])
    return stays.select(*docs.columns).union(docs.where("doc_id IS NULL"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
