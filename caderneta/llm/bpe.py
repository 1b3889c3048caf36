"""Operator 10, BPE: frequent words by a transducer lexicon, all others by exact merging.

The words that are most frequent over all texts are merged once and compiled into a
``Lexicon`` whose outputs point to their ids.  In a task, each different word of a piece
of text is looked up there; a word it does not have is normalised, split and merged by
the vocabulary's rules.  White space always ends a word of the vocabulary, so words are
independent of their neighbours.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caderneta.llm.arrow_words import Words, pieces
from caderneta.llm.bpe_merges import PairRanks, merge_words
from caderneta.llm.lexicon import Lexicon, compile_words
from caderneta.llm.tables import load, stored, words

LEXICON_WORDS = 16_384
WORD_END = "</w>"
# Below this code point the rules are the same in all Unicode versions.
PLAIN_BELOW = "Ͱ"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Merger:
    """The ids of any words, from the text of a vocabulary file; nothing is approximated."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        parsed = json.loads(text)
        ids = dict(parsed["model"]["vocab"])
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.names = [""] * (max(*ids.values(), *self.special.values()) + 1)
        for name, number in chain(ids.items(), self.special.items()):
            self.names[number] = name
        pairs = parsed["model"]["merges"]
        left, right = (np.array([ids[pair[k]] for pair in pairs]) for k in (0, 1))
        self.ranks = PairRanks(left, right)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        split = parsed["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(split + "|\n")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        # Letters are printable stand-ins for bytes: themselves, or 256 upwards in turn.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.byte_of = {letter: b for b, letter in self.letters.items()}
        inner, last = ([ids[self.letters[b] + end] for b in range(256)] for end in ("", WORD_END))
        self.symbols = np.array([inner, last], np.int32)
        # Scripts whose rules follow the Unicode version are split by the library's own.
        self.library = Tokenizer.from_str(text)

    def _merged(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts) of parts given as their bytes."""
        offsets = np.frombuffer(parts.buffers()[1], np.int32)[: len(parts) + 1].astype(np.int64)
        data = np.frombuffer(parts.buffers()[2] or b"", np.uint8)[: offsets[-1]]
        end = np.zeros(len(data), np.int64)
        end[offsets[1:] - 1] = 1
        return merge_words(self.symbols[end, data], offsets, self.ranks, self.merged)

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts) of words without special tokens, all below ``PLAIN_BELOW``."""
        if not words:
            return np.empty(0, np.uint32), np.zeros(1, np.int64)
        text = normalize("NFC", "\n".join(words)).lower()
        found = pa.array(self.split.findall(text), pa.string()).dictionary_encode()
        codes = found.indices.to_numpy(zero_copy_only=False)
        parts = found.dictionary
        breaks = codes == pc.index(parts, "\n").as_py()
        word = np.cumsum(breaks)[~breaks]
        codes = codes[~breaks]
        ids, starts = self._merged(parts)
        begin, size = starts[:-1][codes], np.diff(starts)[codes]
        total = np.bincount(word, size, len(words)).astype(np.int64)
        return ids[spread(begin, size)], np.r_[0, np.cumsum(total)]

    def _odd(self, word: str) -> np.ndarray:
        """The ids of any one word, special tokens included."""
        out = [np.empty(0, np.uint32)]
        for piece in self.cut.split(word):
            if piece in self.special:
                out.append(np.array([self.special[piece]], np.uint32))
            elif piece:
                plain = self.library.normalizer.normalize_str(piece)
                parts = [part for part, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]
                raw = [bytes(map(self.byte_of.__getitem__, part)) for part in parts]
                out.append(self._merged(pa.array(raw, pa.binary()))[0])
        return np.concatenate(out)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts) of words without white space of the contract."""
        odd = pc.or_(
            pc.match_substring_regex(words, f"[^\\x00-{chr(ord(PLAIN_BELOW) - 1)}]"),
            pc.match_substring_regex(words, "|".join(map(regex.escape, self.special))),
        ).to_numpy(zero_copy_only=False)
        ids, starts = self._plain(words.filter(pa.array(~odd)).to_pylist())
        others = [self._odd(word) for word in words.filter(pa.array(odd)).to_pylist()]
        size = np.zeros(len(words), np.int64)
        size[~odd] = np.diff(starts)
        size[odd] = [len(o) for o in others]
        begin = np.zeros(len(words), np.int64)
        begin[~odd] = starts[:-1]
        begin[odd] = len(ids) + np.cumsum(size[odd]) - size[odd]
        pool = np.concatenate([ids, *others])
        return pool[spread(begin, size)], np.r_[0, np.cumsum(size)]


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``begin[i]`` to ``begin[i] + size[i]``, one range after another."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin - (ends - size), size) + np.arange(total)


def frequent_words(docs: DataFrame, number: int = LEXICON_WORDS, text: str = "text") -> list[str]:
    """The most frequent words over all texts, at most ``number`` of them.

    A table of words per eighth of a doubling of the count tells where to cut, so that no
    task sends more words than the lexicon takes.
    """
    each = docs.select(F.explode(words(F.col(text))).alias("word"))
    level = F.floor(8 * F.log2("n")).cast("int")
    counted = stored(
        each.groupBy("word").agg(F.count(F.lit(1)).alias("n")).select("word", level.alias("level")),
        "words",
    )
    levels = sorted(counted.groupBy("level").count().collect(), reverse=True)
    cut, total = None, 0
    for row in levels:
        total += row["count"]
        if total > number:
            break
        cut = row["level"]
    if cut is None:
        return []
    return [row["word"] for row in counted.filter(F.col("level") >= cut).select("word").collect()]


def compile_lexicon(frequent: list[str], merger: Merger) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(transducer block, ids of all its words in turn, where each word's ids start)."""
    ordered = sorted(w.encode() for w in set(frequent))
    ids, starts = merger.encode(pa.array([w.decode() for w in ordered], pa.string()))
    return compile_words(ordered), ids, starts


class _Coder:
    """Ids of whole texts, piece by piece."""

    def __init__(self, vocabulary: str, block: bytes, flat: np.ndarray, starts: np.ndarray):
        self.merger = Merger(vocabulary)
        self.lexicon = Lexicon(block)
        self.flat, self.starts = flat, starts

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts): text ``i`` has ``ids[starts[i]:starts[i + 1]]``."""
        found = Words(texts)
        place = self.lexicon.places(found.names)
        seen = place >= 0
        merged, starts = self.merger.encode(found.names.filter(pa.array(~seen)))
        pool = np.concatenate([self.flat, merged])
        begin, size = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        begin[seen] = self.starts[place[seen]]
        size[seen] = self.starts[place[seen] + 1] - begin[seen]
        begin[~seen] = len(self.flat) + starts[:-1]
        size[~seen] = np.diff(starts)
        each = size[found.codes]
        ends = np.r_[0, np.cumsum(each)]
        return pool[spread(begin[found.codes], each)], ends[found.starts]


def _coded(docs: DataFrame, vocabulary: str, lexicon_words: int, emit, schema: str) -> DataFrame:
    """Runs ``emit(coder, piece)`` over all pieces of ``docs``."""
    with open(vocabulary, encoding="utf-8") as file:
        rules = file.read()
    lexicon = compile_lexicon(frequent_words(docs, lexicon_words), Merger(rules))
    # Bounded by the vocabulary file and the number of lexicon words.
    shared = docs.sparkSession.sparkContext.broadcast((rules, *lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _Coder(*shared.value)
        for batch in batches:
            for piece in pieces(batch):
                yield emit(coder, piece)

    return docs.mapInArrow(run, schema)


def encode(
    docs: DataFrame, vocabulary: str | None = None, lexicon_words: int = LEXICON_WORDS
) -> DataFrame:
    """(doc_id, ids array<int>) of each row; a null or empty text has no ids."""

    def emit(coder: _Coder, piece: pa.RecordBatch) -> pa.RecordBatch:
        ids, starts = coder.ids(piece.column("text"))
        lists = pa.ListArray.from_arrays(
            pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32))
        )
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), lists], names=["doc_id", "ids"])

    return _coded(docs.select("doc_id", "text"), vocabulary or vocabulary_path(), lexicon_words,
                  emit, "doc_id long, ids array<int>")


def decode(coded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Adds ``decoded``, the names of the ids joined by blanks, to rows with ``ids``.

    The vocabulary has no decoder, and this is what its library does then.  A null list
    of ids gives null.
    """
    with open(vocabulary or vocabulary_path(), encoding="utf-8") as file:
        names = coded.sparkSession.sparkContext.broadcast(Merger(file.read()).names)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if ids is None else " ".join(map(names.value.__getitem__, ids))
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"]
            )

    return coded.mapInArrow(run, f"{fields}, decoded string")


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(
    docs: DataFrame, vocabulary: str | None = None, lexicon_words: int = LEXICON_WORDS
) -> DataFrame:
    """(doc_id, number of ids, SHA-256 of the ids and of the decoded text) of each row."""

    def emit(coder: _Coder, piece: pa.RecordBatch) -> pa.RecordBatch:
        ids, starts = coder.ids(piece.column("text"))
        ids = ids.astype("<u4")
        names = list(map(coder.merger.names.__getitem__, ids.tolist()))
        bounds = list(zip(starts[:-1].tolist(), starts[1:].tolist()))
        coded = [hashlib.sha256(ids[a:b]).hexdigest() for a, b in bounds]
        texts = [hashlib.sha256(" ".join(names[a:b]).encode()).hexdigest() for a, b in bounds]
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(np.diff(starts)), pa.array(coded), pa.array(texts)],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return _coded(docs.select("doc_id", "text"), vocabulary or vocabulary_path(), lexicon_words,
                  emit, DIGEST)


def op10_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded; a null text counts as empty."""
    return digests(load(spark, sf_dir, "documents"))


QUERIES = {"op10_transducer_bpe": op10_transducer_bpe}
ORACLES: dict[str, str] = {}
