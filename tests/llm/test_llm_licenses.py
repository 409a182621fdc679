"""License scans against plain versions."""

import random
import re
from collections import Counter

import pytest
from conftest import SF_DIR, local_frame
from llm_cases import awkward, awkward_rows, empty, sentences
from pyspark.sql import functions as F

from revmart.llm import licenses
from revmart.llm.licenses import NOTICES, PHRASES, Template, scan_licenses
from revmart.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(lowered)


def plain_places(text, phrases=PHRASES):
    words = plain_words(text)
    out = []
    for t in phrases:
        phrase = plain_words(t.text)
        out += [(i, t.label) for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
    return sorted(out)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def frame(spark, texts):
    return local_frame(spark, list(enumerate(texts)), "doc_id long, text string")


def base_of(rows):
    return Counter((r["doc_id"], r["n_words"], tuple((f["first"], f["label"]) for f in r["found"] if f["base"])) for r in rows)


def test_words_are_those_of_the_pattern():
    for text in ["", "A1-b_c é日本 x y \x7f{z}`~[]^", "Ünï İ 𝔘", *[r[1] for r in awkward_rows() if r[1]]]:
        assert [w.decode() for w in licenses.words_of(text.encode().lower())] == plain_words(text)


@pytest.mark.parametrize("step", [1 << 20, 64])
def test_base_places_of_awkward_rows(spark, monkeypatch, step):
    monkeypatch.setattr(licenses, "STEP_BYTES", step)
    phrase = "Under the MIT-License; cc by nc. cc by,nc apache license version 2.0 "
    rows = [(r[0], (r[1] or "") + phrase if i % 3 else r[1], *r[2:]) for i, r in enumerate(awkward_rows())]
    rows += [(500, phrase * 700, *rows[0][2:]), (501, "cc by " * 900 + "nc", *rows[0][2:]), (500, phrase * 700, *rows[0][2:])]
    docs = local_frame(spark, rows, awkward(spark).schema.simpleString()[7:-1].replace(":", " "))
    got = scan_licenses(docs).collect()
    want = Counter((r[0], len(plain_words(r[1])), tuple(plain_places(r[1]))) for r in rows)
    assert base_of(got) == want


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = "other"
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, "more")
    return words


@pytest.mark.parametrize("notice", [1, 4, 6, 7], ids=lambda i: NOTICES[i].label)
def test_notices_with_errors_are_found_up_to_the_bound(spark, notice):
    t = Template(NOTICES[notice].label, NOTICES[notice].text)
    rng = random.Random(notice)
    filler = [s.split() for s in sentences(notice, 60, 40)]
    texts = []
    for i, words in enumerate(filler):
        inside = edited(rng, plain_words(t.text), rng.randint(0, 2 * t.errors + 1))
        texts.append(words[: i % 40] + inside + words[i % 40 :])
    got = {r["doc_id"]: r["found"] for r in scan_licenses(frame(spark, [" ".join(x) for x in texts]), (), (t,)).collect()}
    template = plain_words(t.text)
    for i, words in enumerate(texts):
        lengths = range(len(template) - t.errors, len(template) + t.errors + 1)
        least = min(edit_distance(template, words[a : a + n]) for a in range(len(words)) for n in lengths)
        assert len(got[i]) == (least <= t.errors), (i, least)
        for f in got[i]:
            span = words[f["first"] : f["last"] + 1]
            assert edit_distance(template, span) == least and f["score"] == pytest.approx(1 - least / len(template))


def test_every_occurrence_is_found(spark):
    text = " and then ".join([NOTICES[1].text, "nothing here", NOTICES[1].text.upper(), NOTICES[7].text])
    (row,) = scan_licenses(frame(spark, [text])).collect()
    assert [(f["label"], f["score"]) for f in row["found"]] == [("mit", 1.0), ("mit", 1.0), ("gpl-3", 1.0)]


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3"}),
        ("This work is licensed under the GNU General Public License, version 2.", {"gpl-2"}),
        ("This book is licensed under GNU General Public License version 3", {"gpl-3"}),
        ("This work is licensed under the Swiss General Public Library, version 3", set()),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc"}),
        ("Licensed under CC BY-SA 4.0.", {"cc-by-sa"}),
        ("Licensed under CC BY 4.0.", {"cc-by"}),
        ("Licensed under the Apache License, Version 2.0.", {"apache-2"}),
        ("Released under the MIT license.", {"mit"}),
        ("Released under the new license.", set()),
        ("He was permitted to use the form provided that the following conditions are met", set()),
    ],
)
def test_notices_are_told_apart(text, labels):
    words = licenses.words_of(("He said " + text + " and went on").encode().lower())
    near = [(i, 0, len(words)) for i, t in enumerate(NOTICES)]
    assert {NOTICES[f[0]].label for f in licenses.verified(NOTICES, words, near)} == labels


def test_licenses_of_copies_and_names_of_columns(spark):
    docs = awkward(spark).withColumn("key", F.lit(1)).withColumn("near", F.lit(2)).withColumn("found", F.lit(3)).withColumn("of", F.lit(4))
    assert scan_licenses(docs).count() == len(awkward_rows())
    assert scan_licenses(empty(spark)).count() == 0
    copies = local_frame(spark, [(i % 7 or None, NOTICES[7].text) for i in range(300)], "doc_id long, text string")
    assert {(len(r["found"]), r["found"][0]["label"]) for r in scan_licenses(copies).collect()} == {(1, "gpl-3")}


def test_license_query_at_small_scale(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = QUERIES["op11_licenses"](spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        places = plain_places(texts[r["doc_id"]])
        named = sorted({label for _, label in places})
        assert r["n_words"] == len(plain_words(texts[r["doc_id"]])) and r["n_base"] == len(places)
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(named) and set(named) <= set(r["labels"].split(","))
        is_gpl = "general public license, version 3" in texts[r["doc_id"]].lower()
        assert r["labels"] == ",".join(sorted({*named, *["gpl-3"] * is_gpl})) and r["score"] == float(bool(r["labels"]))
