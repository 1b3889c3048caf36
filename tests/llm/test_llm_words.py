import hashlib
import json
import re
import zlib
from collections import Counter, defaultdict

from caderneta.llm import chat, collocations, ranges, variants
from corpus import LOWER, frame, rows, saved

LETTERS = re.compile("[A-Za-z\u00c0-\u00ff]+")


# --- spelling variants ---------------------------------------------------------


def spelled(doc_id, run):
    run = run.translate(LOWER)
    h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1 :] if h % 199 == 0 else run


def edits_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected_variants(counts):
    out = {}
    for word, n in counts.items():
        near = sorted((-m, other) for other, m in counts.items() if edits_one(word, other))
        form = near[0][1] if near and -near[0][0] >= 5 * n else None
        out[word] = [form, n, len(near), counts[form] if form else None]
    for word, row in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        row.insert(1, root)
    return {(word, *row) for word, row in out.items()}


def found_variants(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


WORDS = {
    "colour": 700, "color": 3, "colours": 90, "colouur": 12, "coloour": 12, "collour": 5, "colous": 5,
    "xcolour": 6, "coloxr": 40, "aaaaaa": 100, "aaaaaaa": 19, "aaaaaaaa": 3, "aaabaaa": 5, "étéétéé": 9,
    "étéetéé": 90, "unrelated": 50, "b" * 3000: 9, "b" * 3001: 60, "b" * 1500 + "c" + "b" * 1499: 5,
}


def test_near_words_forms_and_roots(spark, monkeypatch):
    words = spark.createDataFrame([*WORDS.items(), (None, 9)], "word string, n long").repartition(3)
    assert found_variants(variants.spelling_variants(words)) == expected_variants(WORDS)
    # Many ranges: prefixes that run over bounds keep one number.
    monkeypatch.setattr(ranges, "RANGE_KEYS", 3)
    monkeypatch.setattr(ranges.draw_bounds, "__defaults__", (3,))
    assert len(ranges.draw_bounds(words.dropna(), "word")) > 2
    assert found_variants(variants.spelling_variants(words)) == expected_variants(WORDS)


def test_variants_of_documents(spark, tmp_path):
    stem = ["Wonder", "wonder", "wönder", "wander", "wonders", "wonder1"]
    data = [(k % 90, " ".join(stem[: 1 + k % 6]) + ("\n" + "É" * 7) * (k % 3), *rows()[0][2:]) for k in range(400)]
    data += [(None, "wonders wonder", *rows()[0][2:])] * 3 + rows()
    counts = Counter(
        w for d, t, *_ in data for run in LETTERS.findall(t or "") for w in [spelled(d, run)] if len(w) >= 6
    )
    counts = {w: n for w, n in counts.items() if n >= 5}
    found = found_variants(variants.op11_spelling_variants(spark, saved(spark, data, tmp_path)))
    assert found == expected_variants(counts) and any(f[1] for f in found)


def test_no_words(spark):
    assert variants.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0
    assert variants.corpus_words(frame(spark, [])).count() == 0


# --- chat formatting -------------------------------------------------------------


def test_layouts_by_fingerprint(spark):
    turns = [("system", "s"), ("user", "u\n"), ("assistant", "a")]
    given = {
        "messages": {"messages": [{"role": r, "content": t} for r, t in turns], "id": 7},
        "conversations": {"conversations": [
            {"from": {"user": "human", "assistant": "gpt"}.get(r, r), "value": t} for r, t in turns]},
        "speakers": {"data": {"turns": [{"utterance": {"text": t}, "speaker": {"name": r}} for r, t in turns]}},
        "question": {"response": "a", "question": "u\n", "system": "s"},
    }
    records = [(k, json.dumps(v)) for k, v in enumerate(given.values())]
    records += [(10, None), (11, "no json"), (12, '{"other": [1, {"x": 2}]}'), (13, "[]"), (14, '{"messages": []}'),
                (15, '{"prompt": null, "completion": 5}')]
    found = {r.conv_id: r for r in chat.canonical_turns(
        spark.createDataFrame(records, "conv_id long, record string")).collect()}
    for k, name in enumerate(given):
        assert found[k].layout == name and [tuple(t) for t in found[k].turns] == turns
    assert len({found[k].fingerprint for k in range(4)}) == 4
    assert found[10].fingerprint is None and found[11].fingerprint is None
    assert found[12].fingerprint and found[12].layout is None and found[12].turns is None
    assert [tuple(t) for t in found[15].turns] == [("user", ""), ("assistant", "5")]


HOSTILE = ["", "\\", "\\\\n", "###", "#####", "### user:\n", "</turn>\n", "\\</turn>", "a</turn", "#\\##", "😀\n" * 3,
           r"\### Assistant: </turn> ok"]


def test_templates_round_trip():
    for role in ("user", "assistant", "", "a:b\\#\n<x", "### x"):
        turns = [(role, text) for text in HOSTILE] + [("assistant", text) for text in HOSTILE]
        text, spans = chat.written(turns)
        assert chat.read_back(text) == turns
        told = [chat.unescaped(text[a:b]) for a, b in spans]
        assert told == [t for r, t in turns if r == "assistant"]
    assert chat.read_back("") == []


def test_conversations_are_read_back(spark, tmp_path):
    roles = ["system", "user", "assistant", None, "tool:x"]
    data = [(c, t, roles[(c + t * 3) % 5], HOSTILE[(c * 5 + t) % len(HOSTILE)], "x") for c in range(40) for t in range(c % 9)]
    data += [(90, 0, "user", None, "x"), (90, 1, "assistant", "b", "x"), (90, 1, "assistant", "a", "x"),
             (91, None, "user", "first", "x"), (91, 5, "assistant", "x" * 200000, "x"), (None, 1, "user", "q", "x")]
    data += [(k, 0, "user", f"q{k}", "x") for k in range(100, 110)] + [(k, 1, "assistant", f"a{k}", "x") for k in range(100, 110)]
    schema = "conv_id long, turn long, role string, text string, record string"
    spark.createDataFrame(data, schema).repartition(4).write.parquet(str(tmp_path / "conversations.parquet"))
    found = {r.conv_id: r for r in chat.op12_chat_formatting(spark, str(tmp_path)).collect()}
    told = defaultdict(list)
    hostile = [(-7, k, r, HOSTILE[-1], "") for k, r in enumerate(("user", "assistant"))]
    for c, t, r, x, _ in data + hostile:
        told[c].append((t is not None, t or 0, r or "", x or ""))
    assert set(found) == set(told)
    for c, turns in told.items():
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        every = "".join(f"{r}\n{x}\n" for r, x in turns)
        loss = "".join(x for r, x in turns if r == "assistant")
        row = found[c]
        assert (row.n_turns, row.loss_chars) == (len(turns), len(loss)), c
        assert row.turns_sha256 == hashlib.sha256(every.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert row.formatted_chars == len(chat.written(turns)[0])


def test_empty_conversations(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    assert [r.conv_id for r in chat.op12_chat_formatting(spark, str(tmp_path)).collect()] == [-7]


# --- phrase collocations ---------------------------------------------------------


def expected_phrases(data, least, best):
    words, counts = Counter(), defaultdict(Counter)
    for lang, text in data:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            found = re.findall("[^ \t]+", piece)
            words[lang] += len(found)
            for m in range(1, 6):
                counts[lang].update(tuple(found[i : i + m]) for i in range(len(found) - m + 1))
    out = set()
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {q[i:j] for q, a in frequent.items() for i in range(len(q)) for j in range(i + 1, len(q) + 1)
                   if j - i < len(q) and f[q[i:j]] <= a}
        scored = []
        for p, a in frequent.items():
            if p not in covered:
                cuts = [(1000 * a * words[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], words[lang]))
        for rank, (score, a, p, l, r, n) in enumerate(sorted(scored)[:best], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n, -score))
    return out


def found_phrases(df):
    return {(r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


TALK = ["The quick\tfox. the quick fox jumps over it", "a a a a a a a, a", "The\x00 quick  \x01 fox; é É", None, "",
        "over it\rover it\x0bnew york city hall of fame new york city", "x" * 50000, "\x01 fox é É the quick"]


def test_phrases(spark, monkeypatch):
    data = [([None, "en", "fr", "und"][k % 4], TALK[(k * 3) % len(TALK)]) for k in range(120)]
    docs = spark.createDataFrame([(*d, 1, "x") for d in data], "lang string, text string, n long, phrase string")
    found = found_phrases(collocations.collocations(docs.repartition(5), least=3, best=7))
    assert found == expected_phrases(data, 3, 7) and len(found) > 8
    monkeypatch.setattr(ranges.draw_bounds, "__defaults__", (4,))
    monkeypatch.setattr(collocations, "HELD_WINDOWS", 10)
    monkeypatch.setattr(collocations, "HELD_KEYS", 10)
    monkeypatch.setattr(collocations, "BUCKET_WORDS", 50)
    monkeypatch.setattr(collocations, "PIECE_BYTES", 100)
    assert found_phrases(collocations.collocations(docs.repartition(5), least=3, best=50)) == expected_phrases(data, 3, 50)


def test_scores_beyond_64_bits(spark):
    l, r, a, n = 3 * 10**9, 4 * 10**9, 2 * 10**9, 7 * 10**12
    row = spark.sql(f"SELECT (CAST({1000 * a}L AS decimal(19,0)) * CAST({n}L AS decimal(19,0)))"
                    f" div (CAST({l}L AS decimal(19,0)) * CAST({r}L AS decimal(19,0))) AS s").first()
    assert row.s == 1000 * a * n // (l * r)


def test_no_phrases(spark):
    assert collocations.collocations(frame(spark, [])).count() == 0
    assert collocations.collocations(frame(spark).limit(3), least=1).count() >= 0
