"""Licences, language model, fingerprints and BPE."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caderneta.llm import bpe, fingerprints, licences, masked_lm, quality_rules
from caderneta.llm.arrow_words import Words, pieces
from caderneta.llm.lexicon import Lexicon, compile_words
from caderneta.llm.tables import settled
from corpus import frame, rows, saved, texts, words


def test_words_are_the_contracts():
    found = Words(pa.array(texts()))
    names = found.names.to_pylist()
    for k, text in enumerate(texts()):
        got = [names[c] for c in found.codes[found.starts[k] : found.starts[k + 1]]]
        assert got == words(text)
    batch = pa.RecordBatch.from_arrays([pa.array(texts())], names=["text"])
    assert sum(p.num_rows for p in pieces(batch)) == len(texts())


# --- licences ----------------------------------------------------------------

NOTICES = [
    ("Licensed under the Apache License, Version 2.0.", "apache"),
    ("Released under the MIT License.", "mit"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("All rights reserved.", "proprietary"),
    ("Licensed under the Mozilla Public License, v. 2.0.", "unknown"),
    ("Released under the zlib license.", "unknown"),
]


@pytest.fixture(scope="module")
def model(spark):
    return licences.Classifier(licences.background_sample(frame(spark)))


def test_notices(spark, model):
    data = [(k, f"some text here\n{t}\nmore text", *rows()[0][2:]) for k, (t, _) in enumerate(NOTICES)]
    found = {r.doc_id: r for r in licences.scan_licences(frame(spark, data), model).collect()}
    for k, (text, family) in enumerate(NOTICES):
        assert found[k].families == family, text
        assert found[k].n_unknown == (family == "unknown")


def test_plain_documents_have_no_licence(spark, model):
    found = licences.scan_licences(frame(spark), model).collect()
    assert len(found) == len(rows()) and all(r.families == "" for r in found)
    assert licences.scan_licences(frame(spark, []), model).count() == 0


def test_variations_held_out(model):
    draw = licences.random.Random(99)
    held = [(licences._varied(t, draw), k) for k, f in enumerate(licences.FAMILIES)
            for t in licences.TEMPLATES[f] for _ in range(20)]
    model.index = {g: i for g, i in model.index.items()}
    right = np.mean(model._probabilities(model._matrix([w for w, _ in held])).argmax(axis=1)
                    == [k for _, k in held])
    assert right > 0.9


def test_words_seen_in_the_background_lose_no_notice(spark):
    plain = [f"plain{k} words{k} of the text{k} in a row{k}".split(" ") for k in range(200)]
    seen = ["your driver s license and all public software with permission".split(" "),
            "all of it is reserved for guests".split(" "), "the rights of a version".split(" ")]
    model = licences.Classifier(plain + seen * 3)
    data = [(k, f"plain text\n{t}", *rows()[0][2:]) for k, (t, _) in enumerate(NOTICES)]
    data.append((50, "the rights of a version are reserved for all", *rows()[0][2:]))
    found = {r.doc_id: r for r in licences.scan_licences(frame(spark, data), model).collect()}
    for k, (text, family) in enumerate(NOTICES):
        assert found[k].families == family, text
    assert found[50].families == ""


def test_text_around_a_notice_does_not_void_it(spark, model):
    around = " ".join(f"other{k}" for k in range(60))
    data = [(k, f"{around} {t} {around}", *rows()[0][2:]) for k, (t, _) in enumerate(NOTICES)]
    found = {r.doc_id: r for r in licences.scan_licences(frame(spark, data), model).collect()}
    for k, (text, family) in enumerate(NOTICES):
        assert found[k].families == family, text

def plain_licences(text, model):
    """Families that the paragraphs of a text name, from n-grams and weights one by one."""
    out = []
    for line in (text or "").split("\n"):
        found = licences._words(line)
        grams = licences._grams(found)
        if not any(g in grams for g in model.pairs):
            continue
        logits = model.bias.astype(float).copy()
        for g in grams & set(model.index):
            logits += model.weights[model.index[g]].astype(float)
        odds = np.exp(logits - logits.max())
        odds /= odds.sum()
        if odds[licences.NONE] >= 0.5:
            continue
        longer = {g for g in grams if " " in g}
        shares = []
        for k, family in enumerate(licences.FAMILIES):
            notices = [licences._long_grams(t) for t in licences.TEMPLATES[family]]
            own = len(longer & set().union(*notices)) / len(longer)
            shares.append(max([own, *(len(longer & n) / len(n) for n in notices)]))
        top = max(range(licences.NONE), key=lambda k: (logits[k], licences.FAMILIES[k]))
        sure = odds[top] >= model.least and shares[top] >= licences.CONFIRMED
        out.append(licences.FAMILIES[top] if sure else "unknown")
    return len(out), ",".join(sorted(set(out))), out.count("unknown")


def test_every_paragraph_is_scored(spark, model):
    notices = [t for f in licences.TEMPLATES.values() for t in f] + list(licences.UNSEEN)
    some = texts()[7:20]
    mixed = [f"{n} {(some[k % 13] or '')[:40]}\n{some[(k + 5) % 13]}\n{n[: len(n) // 2]}" for k, n in enumerate(notices)]
    data = list(enumerate([*texts(), *mixed, *mixed[:5], "the license of the software\n" * 4]))
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r for r in licences.scan_licences(docs, model).collect()}
    for k, text in data:
        row = found[k]
        assert (row.n_paragraphs, row.families, row.n_unknown) == plain_licences(text, model), text


def test_no_filter_splits_texts_again(spark, model):
    docs = frame(spark)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    rules = [(quality_rules.Condition("repeated_words", True, 0.2), quality_rules.Condition("duplicate_lines", True, 0.3))]
    counted = settled(
        quality_rules.with_features(quality_rules.text_counts(docs.select(F.struct("*").alias("row")), "row.text")),
        "row", values=["n_words", "n_repeat_words", "repeated_words", "duplicate_lines"],
    ).filter(~quality_rules.base_failed() & quality_rules.verdict(rules).isNull())
    for df in (counted, licences.scan_paragraphs(keyed, model)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.split("\n") if line.lstrip(" :+-").startswith("Filter")]
        assert filters and not any("split(" in line or "regexp_replace(" in line for line in filters)


# --- language model ----------------------------------------------------------


def test_neighbours_are_learned(spark):
    draw = np.random.default_rng(1)
    lines = []
    for k in range(400):
        pairs = draw.integers(0, 20, 60)
        lines.append((k, " ".join(f"a{p} b{p}" for p in pairs)))
    docs = spark.createDataFrame(lines, "doc_id long, text string").repartition(3)
    vocabulary, weights = masked_lm.train(docs, rounds=25)
    scored = {r.doc_id: r for r in masked_lm.score(docs, vocabulary, weights).collect()}
    mean = np.mean([r.log_probability / r.n_words for r in scored.values()])
    assert mean < 0 and mean > np.log(1 / 40) + 0.5  # well above the words' shares
    mixed_up = [(k, " ".join(draw.permutation(t.split(" ")))) for k, t in lines]
    other = masked_lm.score(spark.createDataFrame(mixed_up, docs.schema), vocabulary, weights).collect()
    assert np.mean([r.log_probability / r.n_words for r in other]) < mean - 0.3


def test_scores_are_sums_of_logs(spark):
    docs = frame(spark)
    vocabulary, weights = masked_lm.train(docs, rounds=1)
    network = masked_lm.Network(weights)
    found = masked_lm.score(docs, vocabulary, weights).collect()
    assert len(found) == len(rows())
    by_id = {(d, t): t for d, t, *_ in rows()}
    for r in found:
        assert r.n_words or r.log_probability == 0
    text = texts()[8]
    w = Words(pa.array([text]))
    ids, share = (x[w.codes] for x in vocabulary.ids(w))
    total = 0.0
    for k in range(len(ids)):
        near = [ids[k + s] if 0 <= k + s < len(ids) else masked_lm.EDGE for s in masked_lm.SIDES]
        hidden = np.tanh(network.inner + sum(network.sides[i, n] for i, n in enumerate(near)))
        g, spot = ids[k] % masked_lm.GROUPS, ids[k] // masked_lm.GROUPS
        groups = hidden @ network.heads + network.head_bias
        within = hidden @ network.out[g] + network.bias[g]
        total += groups[g] - np.log(np.exp(groups).sum())
        total += within[spot] - np.log(np.exp(within).sum()) + share[k]
    doc = next(d for d, t, *_ in rows() if t == text)
    assert any(abs(r.log_probability - total) < 1e-2 for r in found if r.doc_id == doc)
    assert by_id and masked_lm.score(frame(spark, []), vocabulary, weights).count() == 0


def test_every_word_has_its_own_count(spark):
    names = [f"n{k}" for k in range(masked_lm.FREQUENT + 6 * masked_lm.CLASSES)]
    lines = [(k, " ".join(names)) for k in range(6)] + [(9, " ".join(names[-40:-20] * 3 + names[-20:]))]
    docs = spark.createDataFrame(lines, "doc_id long, text string")
    vocabulary = masked_lm.corpus_vocabulary(docs)
    w = Words(pa.array([lines[0][1] + " never met"]))
    ids, share = vocabulary.ids(w)
    count = {name: sum(t.split(" ").count(name) for _, t in lines) for name in w.names.to_pylist()}
    total = np.bincount(ids, [count[n] for n in w.names.to_pylist()], masked_lm.OUTPUTS)
    for name, k, s in zip(w.names.to_pylist(), ids, share):
        expected = 0 if k < masked_lm.FREQUENT else np.log(max(count[name], 1) / (total[k] + 1))
        assert abs(s - expected) < 1e-9, name


def test_all_places_are_masked_over_the_rounds(monkeypatch, spark):
    w = Words(pa.array(texts()))
    folds = masked_lm._fold(w.hashes()[w.codes], w.starts, masked_lm.ROUNDS)
    assert set(folds.tolist()) == set(range(masked_lm.ROUNDS))
    turns = []
    monkeypatch.setattr(masked_lm, "_train_round", lambda d, v, x, turn, n: turns.append(turn % n) or x)
    masked_lm.train(frame(spark))
    assert set(turns) == set(folds.tolist()) and masked_lm.FREQUENT > 256


def test_probabilities_sum_to_one_and_files_do_not_matter(spark):
    docs = frame(spark)
    vocabulary, weights = masked_lm.train(docs, rounds=2)
    network = masked_lm.Network(weights)
    around = np.repeat(np.array([[1], [2], [masked_lm.EDGE], [5]]), masked_lm.OUTPUTS, axis=1)
    every = network.log_probabilities(around, np.arange(masked_lm.OUTPUTS))
    assert abs(np.exp(every.astype(float)).sum() - 1) < 1e-5
    for parts in (3, 30):
        _, other = masked_lm.train(docs.repartition(parts), rounds=2)
        assert np.abs(other - weights).max() < 1e-6


def test_model_of_nothing(spark):
    vocabulary, weights = masked_lm.train(frame(spark, []))
    assert np.isfinite(weights).all() and vocabulary.counts.sum() > 0


# --- fingerprints ------------------------------------------------------------


def test_equal_parts_share_phrases_at_any_offset():
    draw = np.random.default_rng(0)
    letters = [chr(97 + k) for k in range(20)]
    body = "".join(draw.choice(letters, 3000))
    for shift in (1, 2, 3, 7, 50):
        head = "".join(draw.choice(letters, shift))
        a, b = fingerprints.fingerprints([body, head + body])
        assert fingerprints.likeness(a, b) > 0.85
    other = "".join(draw.choice(letters, 3000))
    assert fingerprints.likeness(*fingerprints.fingerprints([body, other])) < 0.1


def test_fingerprints_do_not_depend_on_company():
    every = [t or "" for t in texts()]
    together = fingerprints.fingerprints(every)
    for text, mark in zip(every, together):
        alone = fingerprints.fingerprints([text])[0]
        assert (alone == mark).all() and fingerprints.likeness(alone, mark) == 1.0
        assert len(mark) == 0 if not text else len(mark) > 0


def test_likeness_is_jaccard_of_small_sets():
    a, b = np.array([1, 2, 3, 9], np.uint32), np.array([2, 3, 5], np.uint32)
    assert fingerprints.likeness(a, b) == 2 / 5
    assert fingerprints.likeness(a, a[:0]) == 0 and fingerprints.likeness(a[:0], a[:0]) == 1


@pytest.mark.parametrize("ranges", (1, 7))
def test_next_document_across_ranges(spark, tmp_path, monkeypatch, ranges):
    data = [r for r in rows() if r[0] is not None]
    unique = list({r[0]: r for r in data}.values())
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", -(-len(unique) // ranges))
    folder = saved(spark, unique, tmp_path)
    found = {r.doc_id: r for r in fingerprints.op8_locally_consistent_parsing(spark, folder).collect()}
    text = {r[0]: r[1] or "" for r in unique}
    ids = sorted(text)
    assert sorted(found) == ids
    for i, j in zip(ids, ids[1:] + ids[:1]):
        half = len(text[i]) // 2
        edited = text[i][: len(text[i]) - half] + text[j][:half]
        own, changed, after = fingerprints.fingerprints([text[i], edited, text[j]])
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert found[i].fingerprint == fingerprints.shown(own)
        assert found[i].near_edited == fingerprints.likeness(own, changed)
        assert found[i].near_next == fingerprints.likeness(own, after)


def test_repeated_and_null_ids_are_divided_among_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 8)
    data = [(None, f"text {k}") for k in range(100)] + [(5, f"five {k}") for k in range(60)] + [(1, "a"), (9, "b")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    dealt = fingerprints.with_next(docs).filter("ahead = 0")
    assert dealt.groupBy("range").count().agg({"count": "max"}).first()[0] < 60
    assert fingerprints.compare_with_edited(docs).count() == len(data)
    assert fingerprints.compare_with_edited(docs.limit(0)).count() == 0
    one = fingerprints.compare_with_edited(docs.limit(1)).first()
    assert one.near_next == 1.0
    assert fingerprints.fingerprint_documents(frame(spark)).count() == len(rows())


# --- BPE ---------------------------------------------------------------------


def test_transducer_numbers_words_and_shares_ends():
    known = sorted({w.encode() for t in texts() for w in words(t) if len(w) < 50} | {b"a", b"ab", b"b"})
    lexicon = Lexicon(compile_words(known))
    asked = pa.array([w.decode() for w in known] + ["", "nothing", "abx", "x" * 500])
    assert lexicon.places(asked).tolist() == list(range(len(known))) + [-1] * 4
    shared = np.frombuffer(compile_words([b"nation", b"station"]), np.int32)[0]
    assert shared == 9  # dead state, start, s, t-a, and one path "tion" for both
    assert Lexicon(compile_words([])).places(pa.array(["a"])).tolist() == [-1]


def test_ids_and_decoding_are_the_librarys(spark):
    library = Tokenizer.from_file(bpe.vocabulary_path())
    odd = ["It's <|endoftext|>x<|startoftext|> Σας ΑΣ İx é ÉTÉ don't'll !!'s 12,5 \x00", "a\x1cb\x85c　d",
           "Ᲊ Ɤ ẞ ǅ ﬁ ﻿", "<|endoftext|>" * 3, "'S 'RE x'Ve"]
    data = [(k, t) for k, t in enumerate(texts() + odd)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    coded = bpe.encode(docs, lexicon_words=50)
    found = {r.doc_id: r for r in bpe.decode(coded).collect()}
    for k, text in data:
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert found[k].ids == expected
        assert found[k].decoded == library.decode(expected, skip_special_tokens=False)
    digests = {r.doc_id: r for r in bpe.digests(docs).collect()}
    for k, r in digests.items():
        ids = np.array(found[k].ids, "<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(found[k].decoded.encode()).hexdigest()


def test_overlapping_pairs_merge_from_the_left():
    with open(bpe.vocabulary_path(), encoding="utf-8") as file:
        text = file.read()
    library, merger = Tokenizer.from_str(text), bpe.Merger(text)
    asked = ["a" * k for k in range(1, 40)] + ["ababab" * 9, "thethethe", "!!!!!!!", "x" * 5000]
    ids, starts = merger.encode(pa.array(asked))
    for word, a, b in zip(asked, starts, starts[1:]):
        assert ids[a:b].tolist() == library.encode(word, add_special_tokens=False).ids
    assert merger.encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_empty_table(spark, tmp_path):
    assert bpe.op10_transducer_bpe(spark, saved(spark, [], tmp_path)).count() == 0
    assert bpe.encode(frame(spark)).count() == len(rows())
