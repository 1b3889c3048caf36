"""Small texts with nulls, repeats, near copies and long ones, and plain restatements."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, row string, "
    "text_hash long, label long, size long, position double, n_words long, cls long, start long"
)
LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def sentence(draw: random.Random, words: int) -> str:
    return " ".join(f"w{draw.randrange(400)}{draw.choice('abc')}" for _ in range(words))


def texts() -> list[str | None]:
    draw = random.Random(3)
    base = ["\n".join(sentence(draw, draw.randrange(6, 30)) for _ in range(draw.randrange(1, 6)))
            for _ in range(25)]
    out: list[str | None] = [None, "", " ", "\n\n", "one", "one two three four", "ONE two three four"]
    out += base + base[:5]
    for text in base[:12]:
        words = text.split(" ")
        words[draw.randrange(len(words))] = "changed"
        out.append(" ".join(words))
        words[draw.randrange(len(words))] = "again"
        out.append(" ".join(words))
    hub = sentence(draw, 80).split(" ")
    for _ in range(40):
        near = list(hub)
        near[draw.randrange(80)] = sentence(draw, 1)
        out.append(" ".join(near))
    out.append(sentence(draw, 6000))
    out.append("x" * 70000)
    out.append("tab\tsep\x0bverticals  é ü 漢字 😀 a b mail me@x.org or +49 (30) 1234-5678")
    return out


def rows() -> list[tuple]:
    found = []
    for number, text in enumerate(texts()):
        source = [None, "a", "b", "c"][number % 4]
        found.append((number * 7 % 997, text, "en", source, None, "k", "r", 1, 2, 3, 0.5, 4, 5, 6))
    found += [found[10], found[10], (None, "null id text of six words", *found[0][2:]),
              (None, "null id text of six words", *found[0][2:]), (None, None, *found[0][2:])]
    return found


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(5)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None) -> frozenset:
    found = words((text or "").translate(LOWER))
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def similar(a: frozenset, b: frozenset, percent: int) -> bool:
    shared = len(a & b)
    return bool(a and b) and 100 * shared >= percent * (len(a) + len(b) - shared)


def saved(spark, data, tmp_path):
    """A folder with a documents table, for the registered queries."""
    frame(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)
