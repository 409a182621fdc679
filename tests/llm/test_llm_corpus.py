"""Search, language model, mixing, shards and the pipeline."""

import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, difference
from conftest import SF_DIR, local_frame
from llm_cases import awkward, awkward_rows, empty
from pyspark.sql import functions as F
from test_llm_pairs import plain_fingerprint
from llm_cases import smallest_reachable

import corpus_pipeline
from revmart.llm import maxent, mixing, pii, search, sharding, toxicity
from revmart.llm.common import BATCHES
from revmart.llm.queries import BYTE_BPE, KEY, QUERIES, SQL


def plain_search(rows, queries, k=10):
    counts = [Counter((t or "").encode().lower().split()) for _, t in rows]
    lengths = [sum(c.values()) for c in counts]
    mean = sum(lengths) / len(rows)
    df = Counter(w for c in counts for w in c)
    out = []
    for q, text in queries:
        asked = Counter((text or "").encode().lower().split())
        found = []
        for (i, _), c, n in zip(rows, counts, lengths):
            s = sum(m * math.log(1 + (len(rows) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * n / mean)) for w, m in asked.items() if w in c)
            if s > 0:
                found.append((-round(s, 7), i is None, i or 0, i))
        out += [(q, rank + 1, f[3]) for rank, f in enumerate(sorted(found)[:k])]
    return out


@pytest.mark.parametrize("size", [4000, 1 << 30])
def test_search_against_all_scores(spark, monkeypatch, size):
    monkeypatch.setattr(search, "SHARD_BYTES", size)
    monkeypatch.setattr(search, "DOC_BLOCK", 2)
    monkeypatch.setattr(search, "SEEDS", 4)
    rows = [(r[0], r[1]) for r in awkward_rows()]
    asked = [(1000, None), (1001, "   "), (1002, "the the ing unknown"), *[(i, t) for i, t in rows if i in (4, 6, 7, 12, 20)]]
    queries = local_frame(spark, asked, "query_id long, text string")
    got = search.search(awkward(spark), queries, k=3).select("query_id", "rank", "doc_id").collect()
    assert Counter(map(tuple, got)) == Counter(plain_search(rows, asked, 3))


def test_search_in_rounds_gives_all_scores(spark, monkeypatch):
    """Queries are copied for the shards of a round only; the best so far are the next round's threshold, and ties across rounds keep their order."""
    rounds, found_in = [], search._found_in

    def watched(placed, packed, floors, some, *args):
        rounds.append((len(some), floors is not None))
        return found_in(placed, packed, floors, some, *args)

    monkeypatch.setattr(search, "_found_in", watched)
    monkeypatch.setattr(search, "shards_of_a_round", lambda *args: 2)
    monkeypatch.setattr(search, "SHARD_BYTES", 8000)
    rows = [(r[0], r[1]) for r in awkward_rows()]
    asked = [(1000, None), (1002, "the the ing unknown"), *[(i, t) for i, t in rows if i in (4, 6, 7, 12, 20)]]
    queries = local_frame(spark, asked, "query_id long, text string")
    got = search.search(awkward(spark), queries, k=3).select("query_id", "rank", "doc_id").collect()
    assert Counter(map(tuple, got)) == Counter(plain_search(rows, asked, 3))
    assert len(rounds) > 1 and [n for n, _ in rounds[:-1]] == [2] * (len(rounds) - 1)
    assert [seen for _, seen in rounds] == [False] + [True] * (len(rounds) - 1)


def test_copies_of_the_queries_are_bounded_by_the_documents():
    for shards, blocks, docs, packed in ((28, 1, 1 << 30, 1 << 26), (320, 3, 10 << 30, 1 << 30), (1600, 12, 50 << 30, 5 << 30), (5, 1, 0, 0)):
        least = -(-12 // blocks)
        some = search.shards_of_a_round(shards, blocks, 12, docs, packed)
        assert min(shards, least) <= some <= shards and packed * some <= max(docs, packed * least)


def test_search_in_nothing(spark):
    queries = local_frame(spark, [(1, "the")], "query_id long, text string")
    assert search.search(empty(spark), queries).count() == 0


def test_search_bounds_what_a_task_holds(spark, monkeypatch):
    """A shard's index grows out of small batches and takes a bounded number of bytes a posting while it is built."""
    before = {name: spark.conf.get(name, None) for name in BATCHES}
    try:
        for name in BATCHES:
            spark.conf.unset(name)
        search.search(awkward(spark), local_frame(spark, [(1, "the")], "query_id long, text string"))
        assert {name: spark.conf.get(name) for name in BATCHES} == BATCHES
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)
    rng = np.random.default_rng(2)
    texts = [" ".join(map(str, rng.integers(0, 60_000, 250))) for _ in range(2000)]
    parts = [search._term_counts(texts[a : a + 500]) for a in range(0, len(texts), 500)]
    tracemalloc.start()
    try:
        index = search.Shard(list(range(len(texts))), parts, 250.0)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert not parts and most < 56 * len(index.post_doc)
    monkeypatch.setattr(search, "STEP_BYTES", 1 << 12)
    whole = search.Shard(index.ids, [search._term_counts(texts)], 250.0)
    for name in ("terms", "begin", "doc_begin", "doc_term", "doc_impact", "post_doc", "post_impact", "block_of", "block_max", "block_begin"):
        assert np.array_equal(getattr(index, name), getattr(whole, name))


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def plain_base(rows):
    counts = Counter()
    for i, t in rows:
        if i is None or not held(i):
            counts.update([*(t or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        out.append((i, i is not None and held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 5)))
    return Counter(out)


@pytest.mark.parametrize("size", [50_000, 1 << 24])
def test_model_counts_against_plain_ones(spark, monkeypatch, size):
    monkeypatch.setattr(maxent, "BLOCK_BYTES", size)
    got = maxent.score_documents(awkward(spark), toxicity.is_held_out(folds=7, fold=2)).collect()
    want = plain_base([(r[0], r[1]) for r in awkward_rows()])
    assert Counter((*tuple(r)[:5], round(r["base_score"], 5)) for r in got) == want
    assert all(r["score"] < 0 for r in got)


def test_model_is_a_distribution_and_beats_the_base(spark):
    rng = np.random.default_rng(1)
    table = np.exp(maxent.log_softmax(rng.normal(size=(maxent.WEIGHT_ROWS, maxent.CLASSES)), maxent.history_features()))
    assert np.allclose(table.sum(axis=1), 1)
    rows = QUERIES["op3_maxent"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 0.1 * sum(r["n_tokens"] for r in rows)


def test_model_sorts_words_once_and_weighs_their_letters_only():
    """One sort numbers the words of a block, which gives their classes too; letters are weighed for bytes of words, not for gaps."""

    class Letters:
        def __init__(self, table):
            self.table, self.rows = table, 0

        def __getitem__(self, at):
            self.rows += len(at)
            return self.table[at]

    words = [b"the", b"of", b"and"]
    lexicon = maxent._lexicon(words, np.array([9.0, 8.0, 7.0]), np.array([0, 1, 2]))
    lexicon.letters = letters = Letters(lexicon.letters)
    texts = ["the cat  of THE cats", "", "cat and and \u00e9t\u00e9 cat", "   "]
    found = maxent.tokens(texts, lexicon)
    assert letters.rows == sum(len(w.encode()) for w in {"cat", "cats", "\u00e9t\u00e9"})
    every = [w for t in texts for w in t.lower().split()]
    codes, which = maxent._numbered([found.codes[:4], found.codes[4:]])
    assert np.array_equal(codes[which], found.codes) and len(codes) == len(set(every))
    classes = maxent._class_of([found.classes[:4], found.classes[4:]], which, len(codes))
    assert np.array_equal(classes[which], found.classes)


def test_model_reads_the_words_before(spark):
    """Of two equally frequent words one is often said twice: texts of the same classes are scored apart by the words in them."""
    common = [f"w{i:02d}" for i in range(80)]  # more frequent, so that the others are no classes of their own
    rows = []
    for i in range(400):
        some = [common[(i * 7 + j * 13) % 80] for j in range(160)]
        rare = [["alpha", "alpha"], ["mid"]] if i % 2 else [["gamma"], ["gamma"]]
        rows.append((i * 2, " ".join([*some[:50], *rare[0], *some[50:100], *rare[1], *some[100:]])))
    asked = [t for t in range(1, 400, 2) if held(t)][:2]
    rows += [(asked[0], "alpha alpha"), (asked[1], "gamma gamma")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in maxent.score_documents(frame, toxicity.is_held_out(folds=7, fold=2)).collect()}
    assert got[asked[0]] > got[asked[1]] + 0.1


def test_weights_of_words_against_a_plain_version():
    """Sums, weights and gains of the table of words equal those of one token after another."""
    words = [b"the", b"of", b"and", b"a"]
    lexicon = maxent._lexicon(words, np.array([9.0, 8.0, 7.0, 6.0]), np.array([0, 1, 2, 1]))
    t = maxent.tokens(["the cat of the the dog and", "", "a dog of a cat", "the"], lexicon)
    rng = np.random.default_rng(3)
    class_log = (maxent.log_softmax(rng.normal(size=(maxent.WEIGHT_ROWS, maxent.CLASSES)), maxent.history_features()) / np.log(10)).astype(np.float32)
    kinds, learned, n = maxent.kinds_of_classes(lexicon), np.array([True, True, False, True]), 64
    expected = maxent.kinds_expected(class_log, kinds)
    sums = np.zeros((2, maxent.KINDS, n))
    maxent.add_word_counts(sums, t, learned, kinds, np.ascontiguousarray(expected.T))
    history, own = maxent.histories(t)
    rows = maxent.word_rows(t, n)
    want, text = np.zeros_like(sums), np.repeat(np.arange(4), np.diff(t.begins) + 1)
    for i in range(len(own)):
        for r in rows[:, i] if learned[text[i]] else ():
            want[0, kinds[own[i]], r] += 1
            want[1, :, r] += expected[history[i]]
    assert np.allclose(sums, want) and np.isclose(sums[0].sum(), sums[1].sum())
    weights = maxent.word_weights(sums)
    gains = maxent.word_gains(t, history, own, kinds, weights, expected.astype(np.float32))
    for i in range(len(own)):
        p = expected[history[i]] * np.exp(sum(weights[r].astype(float) for r in rows[:, i]))
        assert np.isclose(gains[i], np.log10(p[kinds[own[i]]] / p.sum() / expected[history[i], kinds[own[i]]]), atol=1e-5)
    # A text's first words have no words before them, whatever text comes before it.
    alone = maxent.word_rows(maxent.tokens(["a dog of a cat"], lexicon), n)
    assert np.array_equal(alone, rows[:, text == 2])
    # One step never makes the training texts less likely.
    assert gains[learned[text]].sum() > 0


def test_model_without_rows(spark):
    assert maxent.score_documents(empty(spark), toxicity.is_held_out(folds=7, fold=2)).count() == 0


def test_mixing_equals_sql(spark):
    with connect(SF_DIR) as duck:
        assert difference(QUERIES["op7_source_mix"](spark, SF_DIR), duck, SQL["op7_source_mix"]) is None


def test_mixing_targets(spark):
    mixed = mixing.mix_sources(awkward(spark))
    assert mixed.columns.count("mix") == 1 and len(mixed.columns) == len(awkward(spark).columns)
    rows = mixed.select("doc_id", "source", "mix.*").collect()
    sizes = defaultdict(int)
    for r in awkward_rows():
        sizes[r[3]] += len((r[1] or "").encode().split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_ = 1.5 * sum(sizes.values()), set(order)
    target = {}
    while True:  # deal by weight, fix those above their cap, deal again
        rate = left / sum(weights[s] for s in open_) if open_ else 0
        full = {s for s in open_ if weights[s] * rate >= 2 * sizes[s]}
        if not full:
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(target[s] for s in full)
        open_ -= full
    target |= {s: weights[s] * rate for s in open_}
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
    assert len(rows) == len(awkward_rows())
    again = mixing.mix_sources(awkward(spark).repartition(3)).select("doc_id", "source", "mix.*").collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    assert mixing.mix_sources(empty(spark)).count() == 0
    none = local_frame(spark, [(1, None, "a"), (2, " ", "b")], "doc_id long, text string, source string")
    assert [tuple(r) for r in mixing.mix_sources(none).select("mix.target", "mix.taken").collect()] == [(0.0, 0), (0.0, 0)]


def test_rows_without_id_meet_the_targets(spark):
    """Every ninth row has no id; sources still come near their targets, and reruns agree."""
    texts = [" ".join([f"w{i}"] * (1 + i * 7 % 50)) for i in range(900)]
    rows = [(None if i % 9 == 0 else i, t, f"s{i % 4}") for i, t in enumerate(texts)]
    docs = local_frame(spark, rows, "doc_id long, text string, source string")
    mixed = mixing.mix_sources(docs).select("doc_id", "source", "text", "mix.*").collect()
    for source in {r["source"] for r in mixed}:
        own = [r for r in mixed if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 50
    again = mixing.mix_sources(docs.repartition(5)).select("doc_id", "source", "text", "mix.*").collect()
    assert Counter(mixed) == Counter(again)
    copies = local_frame(spark, [(None, "one two", "a")] * 300 + [(i, f"three {i}", "b") for i in range(300)], docs.schema.simpleString()[7:-1].replace(":", " "))
    assert mixing.mix_sources(copies).count() == 600


CLASHING = ("_q", "_s1", "_s2", "_size", "_mix", "_time", "_draws", "toxicity", "n_entities", "digest", "mix", "row", "key", "draws", "size", "p", "held")


def test_extra_columns_come_back_from_every_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    docs = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in CLASHING), name
    mixed = mixing.mix_sources(docs).drop("mix").collect()
    assert all(r[c] == f"{c} of {r['doc_id']}" for r in mixed for c in CLASHING if c != "mix")


def test_mixing_repeats_rows(spark):
    want = Counter()
    for r in mixing.mix_sources(awkward(spark)).collect():
        want[(r["doc_id"], r["text"])] += r["mix"]["copies"]
    again = mixing.repeated(awkward(spark))
    assert again.columns == awkward(spark).columns
    assert Counter((r["doc_id"], r["text"]) for r in again.collect()) == +want


def test_source_words_come_near_their_targets(spark):
    rows = QUERIES["op7_source_mix"](spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source"), "doc_id"
    )
    sums = rows.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"), F.max("size").alias("m")).collect()
    assert all(abs(r["t"] - r["n"]) <= r["m"] / 2 + 1 for r in sums)


@pytest.mark.parametrize("heavy", [2, 1024])
def test_shards(spark, monkeypatch, heavy):
    monkeypatch.setattr(sharding, "HEAVY", heavy)
    rows = sharding.shard_rows(awkward(spark), 3).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in awkward_rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= {0, 1, 2} and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_rows(empty(spark), 3).count() == 0


def test_shard_query_balances_and_keeps_groups(spark):
    df = QUERIES["op10_sharding"](spark, "/root/testdata/sf0.01")
    assert dict(df.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    rows = df.collect()
    sizes = Counter()
    homes = defaultdict(set)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        homes[r["text_crc32"]].add(r["shard"])
    assert max(sizes.values()) < 1.03 * min(sizes.values()) and all(len(h) == 1 for h in homes.values())


def test_a_group_beyond_a_shard_is_split(spark):
    rows = [(i, "same text here") for i in range(400)] + [(1000 + i, f"other {i}") for i in range(100)]
    placed = sharding.shard_rows(local_frame(spark, rows, "doc_id long, text string"), 4).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert len(placed) == 4 and max(r["n"] for r in placed) < 1.35 * min(r["n"] for r in placed)


def test_pipeline_stages_against_plain_versions(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    bag = lambda frame: Counter(tuple(r) for r in frame.select("doc_id", "text").collect())
    stages = dict(corpus_pipeline.STAGES)
    rows = sorted(bag(docs).elements())

    machine = toxicity.fit(docs, labels)
    clean = stages["toxicity"](spark, docs, SF_DIR)
    rows = [r for r, s in zip(rows, machine.scores([t or "" for _, t in rows])) if s < 0.5]
    assert clean.columns == docs.columns and bag(clean) == Counter(rows)

    single = stages["simhash"](spark, clean, SF_DIR)
    fps = [plain_fingerprint(t) for _, t in rows]
    names = smallest_reachable([i for i, _ in rows], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    rows = [r for r, c in zip(rows, names) if r[0] == c]
    assert single.columns == docs.columns and bag(single) == Counter(rows)

    private = stages["pii"](spark, single, SF_DIR)
    key = __import__("hashlib").blake2b(KEY.encode(), digest_size=32).digest()
    rows = [(i, pii.rewrite(t or "", key, {})[0]) for i, t in rows]
    assert private.columns == docs.columns and bag(private) == Counter(rows)
    assert private.where("n_chars != char_length(text)").count() == 0

    mixed = stages["mixing"](spark, private, SF_DIR)
    copies = {r["doc_id"]: r["mix"]["copies"] for r in mixing.mix_sources(private).collect()}
    rows = [r for r in rows for _ in range(copies[r[0]])]
    assert mixed.columns == docs.columns and bag(mixed) == Counter(rows)

    library = Tokenizer.from_file(BYTE_BPE)
    library.no_truncation()
    encoded = stages["bpe"](spark, mixed, SF_DIR).collect()
    want = Counter((i, tuple(library.encode(t, add_special_tokens=False).ids)) for i, t in rows)
    assert Counter((r["doc_id"], tuple(r["tokens"])) for r in encoded) == want
    assert all(r["round_trip"] for r in encoded)


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF_DIR).where("NOT round_trip").count() == 0


@pytest.mark.parametrize("rows", ["awkward", "empty"])
def test_pipeline_on_awkward_tables(spark, tmp_path, rows):
    frame = awkward(spark) if rows == "awkward" else empty(spark)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert done.where("NOT round_trip").count() == 0
    assert done.count() > 0 if rows == "awkward" else done.count() == 0


@pytest.mark.parametrize("held", [3, 1 << 18])
def test_frequent_words_do_not_depend_on_the_partitions(spark, monkeypatch, held):
    # "thin" is seen once by every task, after more frequent words that only this task has.
    monkeypatch.setattr(maxent, "HELD", held)
    monkeypatch.setattr(maxent, "HEAD", 4)
    monkeypatch.setattr(maxent, "PROPOSED", 2, raising=False)
    texts = [" ".join([f"own{i} also{i} more{i}"] * 3) + " Thin" for i in range(12)]
    want = [(b"thin", 12), (b"also0", 3), (b"also1", 3), (b"also10", 3)]
    frame = local_frame(spark, [(t,) for t in texts], "text string")
    for parts in (1, 12):
        assert maxent._frequent_words(frame.repartitionByRange(parts, "text")) == want
