"""Removal of long passages that repeat across documents, by prefix-partitioned suffix trees.

A suffix starts at every word and is followed for ``window`` words, which is as deep as a decision needs: two suffixes
share a node of that depth exactly if their windows are equal words.  A deep internal node with suffixes of several
documents is a repeat; neighbouring ones in a document join to its maximal repeats.

*Partition.* Every window is filed under the prefix of ``PREFIX`` words at its anchor, the place in the window whose
words have the smallest code (the leftmost of equals).  Equal windows have their anchor at the same place, so they meet
under the same prefix, and neighbouring windows mostly share one, so a file entry holds a run of windows.  Prefixes
of one document only are left out at once; that leaves few texts' windows.  Prefixes with up to ``GROUP`` entries are
small enough for memory: the subtrees of many prefixes are built together from sorted codes.  Prefixes with more are
lengthened to the whole window, so that their suffixes spread over all tasks; only the smallest document of each
node is kept, by an aggregation that begins before the shuffle.

Codes have 64 bits; two different windows are taken for equal only if the codes of prefix and window both agree.

Defined cases: a null text has no words; rows with a null ``doc_id`` are returned unchanged and don't count as
earlier documents; rows with equal ``doc_id`` are no earlier documents of each other, whether their texts are equal
or not; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import stored, text_of
from revmart.llm.wordcodes import gram_codes, word_codes

PREFIX = 8
#: Entries of a prefix that a task handles in memory.
GROUP = 20_000
#: Windows whose anchors are looked for at once.
ROWS = 1 << 15
#: Bytes of text per step of a task (a longer text is a step of its own).
STEP_BYTES = 1 << 20


def _steps(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    """The batches' rows in pieces of about ``STEP_BYTES`` of text."""
    for batch in batches:
        sizes = np.cumsum([len(t) for t in batch.column(text_at).to_pylist()]) // STEP_BYTES
        cuts = [0, *(np.nonzero(np.diff(sizes))[0] + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


class Windows:
    """The windows of some texts: text, place in the text, anchor's prefix code, window code."""

    def __init__(self, texts: list[str], window: int) -> None:
        codes, begins = word_codes(texts)
        per_text = np.diff(begins)
        n = np.maximum(per_text - window + 1, 0)  # windows of each text
        self.text = np.repeat(np.arange(len(texts)), n)
        self.place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = begins[:-1][self.text] + self.place
        if not len(at):
            self.prefix = self.anchor = self.code = np.zeros(0, np.uint64)
            return
        length = min(PREFIX, window)
        grams = gram_codes(codes, length)
        inside = np.lib.stride_tricks.sliding_window_view(grams, window - length + 1)
        parts = [at[a : a + ROWS] + inside[at[a : a + ROWS]].argmin(axis=1) for a in range(0, len(at), ROWS)]
        self.anchor = np.concatenate(parts)  # in parts, as each holds all codes of its windows
        self.prefix = grams[self.anchor]
        self.code = gram_codes(codes, window)[at]


def _prefixes(docs: DataFrame, window: int) -> DataFrame:
    """``doc_id, version, prefix, entries``: the prefixes of each text and how many anchors have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _steps(batches, 2):
            w = Windows(part.column(2).to_pylist(), window)
            if not len(w.text):
                continue
            first = np.concatenate(([True], (np.diff(w.anchor) != 0) | (np.diff(w.text) != 0)))
            text, prefix = w.text[first], w.prefix[first]
            order = np.lexsort((prefix, text))
            text, prefix = text[order], prefix[order]
            new = np.nonzero(np.concatenate(([True], (np.diff(text) != 0) | (np.diff(prefix) != 0))))[0]
            entries = np.diff(np.append(new, len(text)))
            rows = pa.array(text[new])
            arrays = [part.column(0).take(rows), part.column(1).take(rows), pa.array(prefix[new].view(np.int64)), pa.array(entries)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "version", "prefix", "entries"])

    return docs.select("doc_id", "version", "text").mapInArrow(run, "doc_id long, version long, prefix long, entries long")


def _entries(docs: DataFrame, window: int) -> DataFrame:
    """File entries: runs of windows of one anchor whose prefix is in the row's ``prefixes``.

    ``docs`` has doc_id, version, text, prefixes, big (the prefixes that are lengthened).  ``codes`` holds the
    windows' codes, eight bytes each, from place ``start`` on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _steps(batches, 2):
            w = Windows(part.column(2).to_pylist(), window)
            if not len(w.text):
                continue
            wanted = part.column(3)
            pairs = np.zeros(len(wanted.flatten()), [("t", np.int64), ("p", np.uint64)])
            lengths = np.diff(wanted.offsets.to_numpy())
            pairs["t"] = np.repeat(np.arange(len(lengths)), lengths)
            pairs["p"] = wanted.flatten().to_numpy().view(np.uint64)
            first = np.nonzero(np.concatenate(([True], (np.diff(w.anchor) != 0) | (np.diff(w.text) != 0))))[0]
            ends = np.append(first[1:], len(w.text))
            own = np.zeros(len(first), pairs.dtype)
            own["t"], own["p"] = w.text[first], w.prefix[first]
            keep = np.isin(_paired(own), _paired(pairs)) if len(pairs) else np.zeros(len(own), bool)
            first, ends = first[keep], ends[keep]
            rows = pa.array(w.text[first])
            code_bytes = w.code.tobytes()
            blobs = pa.array([code_bytes[8 * a : 8 * b] for a, b in zip(first.tolist(), ends.tolist())], pa.binary())
            arrays = [
                pa.array(w.prefix[first].view(np.int64)),
                part.column(0).take(rows),
                part.column(1).take(rows),
                pa.array(w.place[first].astype(np.int32)),
                blobs,
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["prefix", "doc_id", "version", "start", "codes"])

    names = ("doc_id", "version", "text", "prefixes")
    return docs.select(*names).mapInArrow(run, "prefix long, doc_id long, version long, start int, codes binary")


def _paired(x: np.ndarray) -> np.ndarray:
    """One 64-bit code per (text of this step, prefix); texts of a step are few, prefixes are mixed codes."""
    return x["p"] ^ (x["t"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _deep_nodes(entries: DataFrame, window: int) -> DataFrame:
    """Spans ``doc_id, version, start, end, later`` of words under nodes of several documents; ``later``: an earlier one has them too.

    ``entries`` are dealt by prefix and sorted by it, so that every prefix is whole in one step.
    """

    def spans(table: pa.Table) -> pa.RecordBatch:
        prefix = table.column("prefix").to_numpy()
        doc = table.column("doc_id").to_numpy()
        blobs = table.column("codes").to_pylist()
        counts = np.array([len(b) // 8 for b in blobs])
        code = np.frombuffer(b"".join(blobs), np.uint64)
        entry = np.repeat(np.arange(len(blobs)), counts)
        place = np.arange(len(code)) - np.repeat(np.cumsum(counts) - counts, counts) + table.column("start").to_numpy()[entry]
        order = np.lexsort((code, prefix[entry]))
        p, c = prefix[entry][order], code[order]
        node = np.zeros(len(order), np.int64)
        node[1:] = np.cumsum((np.diff(p) != 0) | (c[1:] != c[:-1]))
        n, own = node[-1] + 1 if len(node) else 0, doc[entry][order]
        first_doc, last_doc = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
        np.minimum.at(first_doc, node, own)
        np.maximum.at(last_doc, node, own)
        repeats, later = np.zeros(len(order), bool), np.zeros(len(order), bool)
        repeats[order] = (first_doc < last_doc)[node]
        later[order] = first_doc[node] < own
        at = np.nonzero(repeats)[0]
        e, s, is_later = entry[at], place[at], later[at]
        new = np.concatenate(([True], (np.diff(e) != 0) | (np.diff(s) != 1) | (np.diff(is_later.astype(np.int8)) != 0)))
        new = np.nonzero(new)[0] if len(at) else at
        last = np.append(new[1:], len(at)) - 1 if len(at) else at
        rows = pa.array(e[new])
        arrays = [
            table.column("doc_id").take(rows).combine_chunks(),
            table.column("version").take(rows).combine_chunks(),
            pa.array(s[new].astype(np.int32)),
            pa.array((s[last] + window).astype(np.int32)),
            pa.array(is_later[new]),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "version", "start", "end", "later"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < GROUP:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            prefix = table.column("prefix").to_numpy()
            cut = int(np.searchsorted(prefix, prefix[-1]))  # the last prefix may go on
            if cut:
                yield spans(table.slice(0, cut))
            held = table.slice(cut).to_batches()
            rows = table.num_rows - cut
        if rows:
            yield spans(pa.Table.from_batches(held))

    return entries.mapInArrow(run, "doc_id long, version long, start int, end int, later boolean")


def _large_nodes(entries: DataFrame, window: int) -> DataFrame:
    """The same spans for prefixes with many entries, lengthened to whole windows."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(4).to_pylist()
            counts = np.array([len(b) // 8 for b in blobs], np.int64)
            code = np.frombuffer(b"".join(blobs), np.int64)
            entry = np.repeat(np.arange(len(blobs)), counts)
            place = np.arange(len(code)) - np.repeat(np.cumsum(counts) - counts, counts) + batch.column(3).to_numpy()[entry]
            rows = pa.array(entry)
            arrays = [*[batch.column(k).take(rows) for k in (0, 1, 2)], pa.array(place.astype(np.int32)), pa.array(code)]
            yield pa.RecordBatch.from_arrays(arrays, ["prefix", "doc_id", "version", "start", "code"])

    windows = entries.mapInArrow(unpack, "prefix long, doc_id long, version long, start int, code long")
    first = windows.groupBy("prefix", "code").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    shared = first.where("first_doc < last_doc").select("prefix", "code", "first_doc")
    found = windows.join(shared, ["prefix", "code"])
    return found.select("doc_id", "version", "start", (F.col("start") + window).alias("end"), (F.col("first_doc") < F.col("doc_id")).alias("later"))


def repeated_spans(docs: DataFrame, window: int = 50) -> DataFrame:
    """``doc_id, version, start, end, later``: word spans of ``docs`` (doc_id, version, text) that another document has.

    ``later`` tells that an earlier document is among them.  Spans of one text may overlap or touch.
    """
    known = docs.where("doc_id IS NOT NULL")
    prefixes = stored(_prefixes(known, window))
    per_prefix = prefixes.groupBy("prefix").agg(
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.sum("entries").alias("all_entries")
    )
    shared = per_prefix.where("first_doc < last_doc").select("prefix", (F.col("all_entries") > GROUP).alias("big"))
    wanted = (
        prefixes.join(shared, "prefix")
        .groupBy("doc_id", "version")
        .agg(F.collect_list("prefix").alias("prefixes"), F.collect_list(F.when(F.col("big"), F.col("prefix"))).alias("big"))
    )
    wanted = stored(wanted)
    big = wanted.select(F.explode("big").alias("prefix")).distinct()
    texts = known.join(wanted.select("doc_id", "version", "prefixes"), ["doc_id", "version"])
    entries = stored(_entries(texts, window))
    small = entries.join(big, "prefix", "left_anti")
    large = entries.join(big, "prefix", "left_semi")
    # Dealt by a code of the prefix: Spark leaves out a repartition by the key that the join before it was dealt by, and when that
    # join becomes a broadcast at run time it no longer deals its rows by the key.
    small = small.repartition(F.xxhash64("prefix")).sortWithinPartitions("prefix")
    return _deep_nodes(small, window).union(_large_nodes(large, window))


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """Return ``doc_id, n_words, n_removed, n_repeated, kept`` for every row.

    ``kept`` has the words left, joined by one space; ``n_repeated`` counts the words of passages that another document has,
    be it earlier or later.
    """
    texts = docs.select("doc_id", F.xxhash64(text_of()).alias("version"), text_of().alias("text"))
    spans = stored(repeated_spans(texts, window))
    per_text = spans.groupBy("doc_id", "version").agg(F.collect_set(F.struct("start", "end", "later")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, n_repeated, kept = [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = text.encode().split()
                n_words.append(len(words))
                n_repeated.append(0)
                if found:
                    n_repeated[-1] = int(_covered(len(words), found).sum())
                    goes = _covered(len(words), [s for s in found if s["later"]])
                    words = [w for w, gone in zip(words, goes.tolist()) if not gone]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            counts = [pa.array(c, pa.int64()) for c in (n_words, n_removed, n_repeated)]
            names = ["doc_id", "n_words", "n_removed", "n_repeated", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(kept, pa.binary()).cast(pa.string())], names)

    joined = texts.join(per_text, ["doc_id", "version"], "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, n_repeated long, kept string")


def _covered(n: int, spans: list[dict]) -> np.ndarray:
    """Whether each of ``n`` words lies in a span."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, [s["start"] for s in spans], 1)
    np.add.at(change, [s["end"] for s in spans], -1)
    return np.cumsum(change[:-1]) > 0
