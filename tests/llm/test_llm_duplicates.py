"""Near-duplicates, components, line dedup and the pipeline against brute force."""

import random

import pytest

import corpus_pipeline
from caderneta.llm import line_dedup, near_duplicates
from caderneta.llm.components import components
from corpus import frame, rows, saved, shingles, similar, words


def groups(nodes, edges):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_noise(spark):
    draw = random.Random(4)
    path = [(k, k + 1) for k in range(1, 300)]
    star = [(5000, 5001 + k) for k in range(300)]
    loose = [(9000 + draw.randrange(400), 9000 + draw.randrange(400)) for _ in range(250)]
    edges = path + star + loose + [(7, 7), (8, 9)]
    draw.shuffle(edges)
    nodes = {n for e in edges for n in e}
    expected = groups(nodes, edges)
    half = len(edges) // 2
    first = components(spark.createDataFrame(edges[:half], "a long, b long"))
    labels = components(spark.createDataFrame(edges[half:], "a long, b long"), first)
    found = {r.node: r.label for r in labels.collect()}
    assert set(found) == nodes
    smallest = {}
    for n, label in found.items():
        smallest[label] = min(n, smallest.get(label, n))
    assert {n: smallest[label] for n, label in found.items()} == expected


def expected_groups(data):
    sets = {d: shingles(t) for d, t in data}
    ids = sorted(sets)
    edges = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if similar(sets[a], sets[b], 75)]
    return sets, groups(ids, edges)


@pytest.mark.parametrize("pairs", (0.0, 1e9))
def test_groups_are_exact(spark, tmp_path, monkeypatch, pairs):
    monkeypatch.setattr(near_duplicates, "PAIRS_PER_ROW", pairs)
    unique = list({r[0]: r for r in rows() if r[0] is not None}.values())
    folder = saved(spark, unique, tmp_path)
    sets, groups_of = expected_groups([(r[0], r[1]) for r in unique])
    found = near_duplicates.op9_minhash_hamming(spark, folder).collect()
    assert len(found) == len(unique)
    for r in found:
        assert r.n_shingles == len(sets[r.doc_id])
        assert r.component_id == groups_of[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_odd_rows(spark):
    docs = frame(spark)
    found = near_duplicates.near_duplicates(docs).collect()
    assert len(found) == len(rows())
    assert all(r.kept for r in found if r.n_shingles == 0)
    left = near_duplicates.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    texts = [r.text for r in left.collect()]
    full = [t for t in texts if shingles(t)]
    assert not any(similar(shingles(a), shingles(b), 75) for i, a in enumerate(full) for b in full[i + 1 :])
    assert near_duplicates.near_duplicates(frame(spark, [])).count() == 0
    assert near_duplicates.drop_near_duplicates(frame(spark, [])).count() == 0


def test_one_id_with_several_texts(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    data = [(5, a), (5, b), (5, "b0x " + b), (7, a + " end"), (8, b + " end")]
    found = near_duplicates.near_duplicates(
        spark.createDataFrame(data, "doc_id long, text string")
    ).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(5, 5), (7, 5), (8, 5)}
    assert sum(r.kept for r in found) == 2


def test_nothing_alike(spark):
    docs = frame(spark, [(k, f"a{k} b{k} c{k} d{k} e{k} f{k}", *rows()[0][2:]) for k in range(20)])
    assert near_duplicates.near_duplicates(docs).filter("kept").count() == 20


# --- lines -------------------------------------------------------------------


def expected_lines(data):
    earlier, gone = [], {}
    for doc, text in sorted(data, key=lambda r: r[0]):
        gone[doc] = []
        for number, line in enumerate((text or "").split("\n")):
            held = frozenset(words(line))
            if len(held) < line_dedup.LEAST_WORDS:
                continue
            if any(similar(held, other, line_dedup.SIMILAR) for other in earlier):
                gone[doc].append(number)
            earlier.append(held)
    return gone


def line_data():
    draw = random.Random(8)
    base = [" ".join(f"v{draw.randrange(150)}" for _ in range(draw.randrange(3, 25))) for _ in range(60)]
    data = []
    for k in range(80):
        lines = []
        for _ in range(draw.randrange(0, 6)):
            held = draw.choice(base).split(" ")
            if draw.random() < 0.6:
                held[draw.randrange(len(held))] = f"v{draw.randrange(150)}"
            lines.append(" ".join(held))
        data.append((k * 3 % 241, "\n".join(lines)))
    return data + [(500, None), (501, ""), (502, "\n\n"), (503, "a a a a a a a")]


def test_lines_are_exact(spark, tmp_path):
    data = line_data()
    folder = saved(spark, [(d, t, *rows()[0][2:]) for d, t in data], tmp_path)
    gone = expected_lines(data)
    for r in line_dedup.op7_line_dedup(spark, folder).collect():
        assert r.removed_lines == ",".join(map(str, gone[r.doc_id])), r.doc_id
        assert r.n_removed == len(gone[r.doc_id])


def test_texts_without_the_lines(spark):
    data = line_data()
    docs = frame(spark, [(d, t, *rows()[0][2:]) for d, t in data])
    gone, text = expected_lines(data), dict(data)
    left = line_dedup.drop_repeated_lines(docs)
    assert left.columns == docs.columns and left.count() == len(data)
    for r in left.collect():
        lines = (text[r.doc_id] or "").split("\n")
        kept = "\n".join(line for n, line in enumerate(lines) if n not in gone[r.doc_id])
        assert r.text == (None if text[r.doc_id] is None else kept)


def test_short_lines_go_too(spark, tmp_path):
    data = [
        (1, "All rights reserved.\nHome\n\na b c d\nx y z"), (2, "Home\nAll rights reserved.\n\nx y"),
        (3, "reserved. rights All All\na b c d e\nHome page\nx y z w"), (4, "w x y z v\nb a\na b"),
    ]
    folder = saved(spark, [(d, t, *rows()[0][2:]) for d, t in data], tmp_path)
    found = {r.doc_id: r.removed_lines for r in line_dedup.op7_line_dedup(spark, folder).collect()}
    assert found == {1: "", 2: "0,1", 3: "0,1", 4: "0,2"}


def compared(spark, monkeypatch, lines):
    """(pairs of lines verified, numbers of the lines removed) of one line a document."""
    counts, verify = [], line_dedup._gone

    def counted(docs, classes, pairs):
        counts.append(pairs.count())
        return verify(docs, classes, pairs)

    monkeypatch.setattr(line_dedup, "_gone", counted)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    gone = {r.doc_id for r in line_dedup.removed_lines(docs).collect()}
    return sum(counts), gone


def test_long_unlike_lines_are_not_compared(spark, monkeypatch):
    draw = random.Random(5)
    lines = [" ".join(f"v{draw.randrange(600)}" for _ in range(160)) for _ in range(250)]
    pairs, gone = compared(spark, monkeypatch, lines)
    assert not gone and pairs < len(lines)


def test_a_family_of_near_copies_does_not_meet_in_all_pairs(spark, monkeypatch):
    draw = random.Random(6)
    base, lines = [f"f{k}" for k in range(60)], []
    for _ in range(300):
        held = list(base)
        for _ in range(5):
            held[draw.randrange(60)] = f"v{draw.randrange(500)}"
        lines.append(" ".join(held))
    pairs, gone = compared(spark, monkeypatch, lines)
    expected = expected_lines(enumerate(lines))
    assert gone == {number for number, removed in expected.items() if removed}
    assert pairs < 20 * len(lines)


def test_words_of_few_lines_have_no_star(spark, monkeypatch):
    """Two copies of a line meet once, in the search itself; a star for them is work for nothing."""
    searched, search = [], line_dedup._star_pairs

    def counted(*given):
        searched.append(search(*given))
        return searched[-1]

    monkeypatch.setattr(line_dedup, "_star_pairs", counted)
    lines = [" ".join(f"w{k % 20}x{j}" for j in range(20)) + f" y{k}" for k in range(40)]
    pairs, gone = compared(spark, monkeypatch, lines)
    assert gone == set(range(20, 40)) and pairs == 20
    assert sum(found.count() for found in searched) == 0


def test_odd_rows_of_lines(spark):
    docs = frame(spark)
    assert line_dedup.drop_repeated_lines(docs).count() == len(rows())
    assert line_dedup.drop_repeated_lines(frame(spark, [])).count() == 0


# --- pipeline ----------------------------------------------------------------


def test_stages(spark, tmp_path):
    folder = saved(spark, None, tmp_path)
    labels = [(d, int(bool(t) and len(words(t)) > 20)) for d, t, *_ in rows() if d is not None]
    spark.createDataFrame(labels, "doc_id long, quality long").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"stage{number}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert docs.columns == ["doc_id", "n_tokens", "ids"]
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))
