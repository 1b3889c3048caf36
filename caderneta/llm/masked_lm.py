"""Operator 6, language-model scoring by masked pseudo-likelihood.

A small network reads the two words before a place and the two after it and predicts the
word there; the score of a text is the sum of the log-probabilities of all its words,
each given both sides.  The network speaks of 1,024 frequent words and 64 classes that
share out all other words by hash; a class word's probability within its class is its own
count, from a table of all words of the corpus that grows with it and is joined by word.

The output has two levels: the probability of a word's group, and of the word within it.
Both are exact, and a place costs two small softmaxes instead of one over all words.

Training masks a part of the places of every document in each round, so that all places
are masked over the rounds.  Documents are dealt to shards by their hash, as many as the
number of words of the corpus asks for, so results do not depend on how its files are cut.
Each shard trains with numpy on its own documents, the weights are averaged by trained words
in a distributed sum, and the next round starts from the average.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caderneta.llm.arrow_words import Words, mixed, pieces
from caderneta.llm.tables import discard, load, release, stored

FREQUENT = 1024
CLASSES = 64
OUTPUTS = FREQUENT + CLASSES
EDGE = OUTPUTS  # what lies beyond a text
SIDES = (-2, -1, 1, 2)
HIDDEN = 16
GROUPS = 32  # of outputs, dealt by frequency
WIDTH = OUTPUTS // GROUPS
ROUNDS = 2
FOLDS = 6  # the parts of the places that take turns in being masked, if there are as many rounds
BATCH = 2048
SCORE_BATCH = 8192
RATE = 0.1
SHARD_WORDS = 4_000_000  # words of the corpus for each shard
PART = 1 << 14  # rows of a batch of weights
STEPS = 1 << 20  # a weight's unit in the average, which adds whole numbers and so in any order

_SHAPES = [
    (len(SIDES), OUTPUTS + 1, HIDDEN), (HIDDEN,), (HIDDEN, GROUPS), (GROUPS,),
    (GROUPS, HIDDEN, WIDTH), (GROUPS, WIDTH),
]
_SIZES = [int(np.prod(shape)) for shape in _SHAPES]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            words = Words(piece.column("text"))
            counts = np.bincount(words.codes, minlength=len(words.names)).astype(np.int64)
            used = pa.array(counts > 0)
            hashes = pa.array(words.hashes().view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [words.names.filter(used), hashes.filter(used), pa.array(counts).filter(used)],
                names=["word", "hash", "n"],
            )


class Vocabulary:
    """Ids of words: a frequent word has its own, any other that of its class.

    ``table`` has (word, hash, n) of all words of the corpus; only the driver holds it.
    """

    def __init__(
        self, frequent: list[str], counts: list[int], classes: np.ndarray, table: DataFrame | None = None
    ):
        self.parts = (frequent, counts, classes)  # what makes the same vocabulary again in a task
        self.table = table
        # A word never met has the share of a word met once; each class leaves room for one.
        self.class_share = -np.log(classes + 1.0)
        hashes = Words(pa.array([" ".join(frequent)])).hashes()  # distinct words, in order
        self.order = np.argsort(hashes)
        self.known = hashes[self.order]
        self.counts = np.ones(OUTPUTS)
        self.counts[: len(counts)] += counts
        self.counts[FREQUENT:] += classes

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The id of each word; those from ``FREQUENT`` on are classes."""
        other = FREQUENT + (hashes % np.uint64(CLASSES)).astype(np.int64)
        if not len(self.known):
            return other
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] != hashes, other, self.order[at])

    def class_shares(self, ids: np.ndarray) -> np.ndarray:
        """What a word's log-share has from its class; the log of its count comes on top."""
        return np.where(ids < FREQUENT, 0.0, self.class_share[np.maximum(ids - FREQUENT, 0)])

    def ids(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(id, log-share) of each different word of a few texts, on the driver."""
        hashes = words.hashes()
        ids = self.places(hashes)
        asked = self.table.sparkSession.createDataFrame(
            [(h,) for h in hashes[ids >= FREQUENT].view(np.int64).tolist()], "hash long"
        )
        count = {r["hash"]: r["n"] for r in self.table.join(asked, "hash").select("hash", "n").collect()}
        log = np.log([float(count.get(h, 1)) for h in hashes.view(np.int64).tolist()])
        return ids, np.where(ids < FREQUENT, 0.0, self.class_shares(ids) + log)


def corpus_vocabulary(docs: DataFrame) -> Vocabulary:
    """Counts of all words of all documents; ``FREQUENT + CLASSES`` rows reach the driver."""
    counts = docs.select("text").mapInArrow(_counted, "word string, hash long, n long")
    counts = stored(counts.groupBy("word", "hash").agg(F.sum("n").alias("n")), "words")
    first = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    classes = np.zeros(CLASSES)
    of = F.col("hash").bitwiseAND(CLASSES - 1)
    for row in counts.groupBy(of.alias("class")).agg(F.sum("n").alias("n")).collect():
        classes[row["class"]] = row["n"]
    for row in first:
        classes[row["hash"] & (CLASSES - 1)] -= row["n"]
    return Vocabulary([r["word"] for r in first], [r["n"] for r in first], classes, counts)


def _windows(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The four neighbours of each place, ``EDGE`` beyond the ends of its text."""
    n = len(ids)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    out = np.full((len(SIDES), n), EDGE, np.int64)
    for row, side in enumerate(SIDES):
        at = np.arange(n) + side
        inside = (at >= 0) & (at < n)
        inside[inside] = text[at[inside]] == text[inside]
        out[row, inside] = ids[at[inside]]
    return out


class Network:
    """Neighbour embeddings summed into a tanh layer, then a softmax over groups and one within.

    Output ``k`` is number ``k // GROUPS`` of group ``k % GROUPS``.
    """

    def __init__(self, weights: np.ndarray | None = None):
        if weights is None:
            draw = np.random.default_rng(7)
            weights = np.concatenate([
                draw.normal(0, 0.1, size) if len(shape) > 1 and shape != _SHAPES[-1] else np.zeros(size)
                for shape, size in zip(_SHAPES, _SIZES)
            ])
        self.weights = weights.astype(np.float32)
        parts = np.split(self.weights, np.cumsum(_SIZES)[:-1])
        self.sides, self.inner, self.heads, self.head_bias, self.out, self.bias = (
            part.reshape(shape) for part, shape in zip(parts, _SHAPES)
        )
        self.squares = [np.full(shape, 1e-3, np.float32) for shape in _SHAPES]

    def start_from(self, counts: np.ndarray) -> None:
        """Biases by the outputs' shares, so that training adds what neighbours tell."""
        shares = (counts / counts.sum()).reshape(WIDTH, GROUPS).T
        self.head_bias[:] = np.log(shares.sum(axis=1))
        self.bias[:] = np.log(shares / shares.sum(axis=1, keepdims=True))

    def hidden(self, around: np.ndarray) -> np.ndarray:
        total = self.inner + self.sides[0, around[0]]
        for row in range(1, len(SIDES)):
            total += self.sides[row, around[row]]
        return np.tanh(total)

    def _safe(self) -> tuple[np.ndarray, np.ndarray]:
        """Both biases, lowered where a logit could pass 60, so that no power overflows."""
        # The hidden layer lies in -1 to 1, so no logit is above these.
        heads = (np.abs(self.heads).sum(axis=0) + self.head_bias).max()
        within = (np.abs(self.out).sum(axis=1) + self.bias).max(axis=1, keepdims=True)
        return self.head_bias - max(heads - 60, 0), self.bias - np.maximum(within - 60, 0)

    def log_probabilities(self, around: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The log-probability of each id between its neighbours."""
        found = np.empty(len(ids), np.float32)
        head_bias, bias = self._safe()
        for begin in range(0, len(ids), SCORE_BATCH):
            part = slice(begin, begin + SCORE_BATCH)
            order, spot, group = _by_group(ids[part])
            inner = self.hidden(around[:, part][:, order])
            logs = _log_share(inner @ self.heads + head_bias, group)
            for g, rows in _groups(group):
                logs[rows] += _log_share(inner[rows] @ self.out[g] + bias[g], spot[rows])
            found[begin + order] = logs
        return found

    def learn(self, around: np.ndarray, ids: np.ndarray) -> None:
        """Adagrad steps over batches; weights that a batch does not use do not move."""
        numbers = np.arange(BATCH)
        offsets = (np.arange(len(SIDES)) * (OUTPUTS + 1))[:, None]
        sides, side_squares = self.sides.reshape(-1, HIDDEN), self.squares[0].reshape(-1, HIDDEN)
        for begin in range(0, len(ids), BATCH):
            part = slice(begin, min(begin + BATCH, len(ids)))
            order, spot, group = _by_group(ids[part])
            near, size = around[:, part][:, order], part.stop - begin
            head_bias, bias = self._safe()
            inner = self.hidden(near)
            error = _error(inner @ self.heads + head_bias, group, numbers)
            back = error @ self.heads.T
            steps = [inner.T @ error, error.sum(axis=0), np.zeros_like(self.out), np.zeros_like(self.bias)]
            for g, rows in _groups(group):
                own = inner[rows]
                error = _error(own @ self.out[g] + bias[g], spot[rows], numbers)
                back[rows] += error @ self.out[g].T
                steps[2][g], steps[3][g] = own.T @ error, error.sum(axis=0)
            back *= 1 - inner * inner
            # Each place adds to the embeddings of its neighbours.
            spots = (near + offsets).astype(np.uint16).ravel()
            order = np.argsort(spots, kind="stable")
            spots = spots[order]
            first = np.flatnonzero(np.r_[True, spots[1:] != spots[:-1]])
            used = spots[first]
            step = np.add.reduceat(back[order % size], first, axis=0) / size
            squares = side_squares[used] + step * step
            side_squares[used] = squares
            sides[used] -= RATE * step / np.sqrt(squares)
            others = (self.inner, self.heads, self.head_bias, self.out, self.bias)
            for weights, squares, step in zip(others, self.squares[1:], [back.sum(axis=0), *steps]):
                step /= size
                squares += step * step
                weights -= RATE * step / np.sqrt(squares)


_ONES = np.ones(max(GROUPS, WIDTH), np.float32)


def _log_share(logits: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The log of the wanted one's share of each row's powers."""
    chosen = logits[np.arange(len(logits)), wanted]
    np.exp(logits, out=logits)
    return chosen - np.log(logits @ _ONES[: logits.shape[1]])


def _error(logits: np.ndarray, wanted: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Each row's probabilities, less one at the wanted one."""
    np.exp(logits, out=logits)
    logits *= (1 / (logits @ _ONES[: logits.shape[1]]))[:, None]
    logits[numbers[: len(logits)], wanted] -= 1
    return logits


def _by_group(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the order in which the ids stand by group, their numbers within it, their groups)."""
    spot, group = np.divmod(ids, GROUPS)
    order = np.argsort(group.astype(np.uint8), kind="stable")
    return order, spot[order], group[order]


def _groups(group: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(group, its rows) of each group there is, of rows that stand by group."""
    begin = 0
    for g, end in enumerate(np.cumsum(np.bincount(group, minlength=GROUPS)).tolist()):
        if end > begin:
            yield g, slice(begin, end)
        begin = end


def _fold(codes_hashes: np.ndarray, starts: np.ndarray, folds: int) -> np.ndarray:
    """The fold of each place: by its word, its place in the text and the next word."""
    n = len(codes_hashes)
    place = (np.arange(n) - np.repeat(starts[:-1], np.diff(starts))).astype(np.uint64)
    after = np.r_[codes_hashes[1:], codes_hashes[:1]]
    return (mixed(mixed(codes_hashes + place) ^ after) % np.uint64(folds)).astype(np.int64)


def coded_texts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, key, shard, ids): each row's words as two-byte ids, and the shard it trains in."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(*shared.value)
        for batch in batches:
            for piece in pieces(batch):
                found = Words(piece.column("text"))
                ids = words.places(found.hashes())[found.codes].astype(np.uint16)
                coded = [ids[a:b].tobytes() for a, b in zip(found.starts[:-1], found.starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("key"), pa.array(coded, pa.binary())],
                    names=["doc_id", "key", "ids"],
                )

    total = vocabulary.table.agg(F.sum("n")).first()[0] or 0
    shard = F.pmod("key", F.lit(total // SHARD_WORDS + 1))
    return _keyed(docs).mapInArrow(run, "doc_id long, key long, ids binary").withColumn("shard", shard)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))


def _read(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, ids of their words, where each row's begin) of pieces of a batch of coded texts."""
    for piece in pieces(batch, "ids"):
        column = piece.column("ids")
        sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // 2
        ids = np.frombuffer(b"".join(column.to_pylist()), np.uint16).astype(np.int64)
        yield piece, ids, np.r_[0, np.cumsum(sizes)]


def _train_round(
    coded: DataFrame, vocabulary: Vocabulary, weights: np.ndarray, turn: int, folds: int
) -> np.ndarray:
    """The average of the networks that the shards train, weighted by their words.

    The places of the fold whose turn it is are masked.  A shard's documents come in the
    order of their hashes.
    """
    shared = coded.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, network, trained = None, Network(shared.value), 0

        def told() -> Iterator[pa.RecordBatch]:
            if trained:
                sums = np.rint(network.weights.astype(np.float64) * STEPS).astype(np.int64) * trained
                numbers = np.arange(len(sums), dtype=np.int32)
                for begin in range(0, len(sums), PART):
                    some = slice(begin, begin + PART)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(numbers[some]), pa.array(sums[some]),
                         pa.array(np.full(len(sums[some]), trained, np.int64))],
                        names=["at", "w", "n"],
                    )

        for batch in batches:
            shards = batch.column("shard").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]])[: len(shards)]
            for begin, end in zip(cuts, np.r_[cuts[1:], len(shards)]):
                if shards[begin] != at:
                    yield from told()
                    at, network, trained = shards[begin], Network(shared.value), 0
                for _, ids, starts in _read(batch.slice(begin, end - begin)):
                    picked = np.flatnonzero(_fold(ids.astype(np.uint64), starts, folds) == turn % folds)
                    if len(picked):
                        network.learn(_windows(ids, starts)[:, picked], ids[picked])
                        trained += len(picked)
        yield from told()

    dealt = coded.select("shard", "key", "ids").repartition("shard").sortWithinPartitions("shard", "key")
    rows = dealt.mapInArrow(run, "at int, w long, n long")
    total = F.sum(F.col("w").cast("decimal(20,0)")).cast("double")
    table = rows.groupBy("at").agg((total / F.sum("n") / STEPS).alias("w")).toArrow()
    averaged = weights.astype(np.float64)
    averaged[table.column("at").to_numpy()] = table.column("w").to_numpy()
    return averaged


def fit(coded: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Weights from all places of all coded texts; without words they stay as drawn."""
    network = Network()
    network.start_from(vocabulary.counts)
    weights = network.weights.astype(np.float64)
    for turn in range(rounds):
        weights = _train_round(coded, vocabulary, weights, turn, min(rounds, FOLDS))
        release(coded.sparkSession)
    return weights


def train(docs: DataFrame, rounds: int = ROUNDS) -> tuple[Vocabulary, np.ndarray]:
    """(vocabulary, weights) from all places of all documents."""
    vocabulary = corpus_vocabulary(docs)
    coded = stored(coded_texts(docs, vocabulary), "coded")
    weights = fit(coded, vocabulary, rounds)
    discard(coded)
    return vocabulary, weights


def _rare_words(docs: DataFrame, shared) -> DataFrame:
    """(key, hash, times): the words of each text that have no id of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(*shared.value[0])
        for batch in batches:
            for piece in pieces(batch):
                found = Words(piece.column("text"))
                hashes = found.hashes()
                rare = (words.places(hashes) >= FREQUENT)[found.codes]
                text = np.repeat(np.arange(len(found.counts)), found.counts)[rare]
                pairs, times = np.unique(text * max(len(hashes), 1) + found.codes[rare], return_counts=True)
                text, code = np.divmod(pairs, max(len(hashes), 1))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key").take(pa.array(text)), pa.array(hashes[code].view(np.int64)),
                     pa.array(times.astype(np.int64))],
                    names=["key", "hash", "times"],
                )

    return docs.select("key", "text").mapInArrow(run, "key long, hash long, times long")


SCORED = "doc_id long, key long, n_words long, n_rare long, known double"


def score(
    docs: DataFrame, vocabulary: Vocabulary, weights: np.ndarray, coded: DataFrame | None = None
) -> DataFrame:
    """(doc_id, n_words, log_probability): natural logs summed over all words of a text.

    A null text, or one without words, has none and scores 0.  Repeated rows score alike.
    The network and the classes are scored in tasks, from ``coded`` if the caller has it;
    the log-counts of words within their classes come from the join with the corpus's words.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.parts, weights))
    keyed = _keyed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, trained = shared.value
        words, network = Vocabulary(*parts), Network(trained)
        for batch in batches:
            for piece, ids, starts in _read(batch):
                each = network.log_probabilities(_windows(ids, starts), ids) + words.class_shares(ids)
                sums = np.r_[0.0, np.cumsum(each, dtype=np.float64)]
                rare = np.r_[0, np.cumsum(ids >= FREQUENT)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("key"), pa.array(np.diff(starts)),
                     pa.array(rare[starts[1:]] - rare[starts[:-1]]),
                     pa.array(sums[starts[1:]] - sums[starts[:-1]])],
                    names=["doc_id", "key", "n_words", "n_rare", "known"],
                )

    coded = coded_texts(docs, vocabulary) if coded is None else coded
    # A word met once has the log-count 0, as one never met.
    again = vocabulary.table.filter("n > 1").select("hash", F.log("n").alias("log_n"))
    counted = _rare_words(keyed, shared).join(again, "hash", "left").groupBy("key").agg(
        F.sum(F.col("times") * F.coalesce("log_n", F.lit(0.0))).alias("within"),
        F.sum("times").alias("times"),
    )
    # Rows of equal id and text are added up under one key: each has its part of the sum.
    within = F.coalesce(F.col("within") * F.col("n_rare") / F.col("times"), F.lit(0.0))
    return coded.select("doc_id", "key", "ids").mapInArrow(run, SCORED).join(counted, "key", "left").select(
        "doc_id", "n_words", (F.col("known") + within).alias("log_probability")
    )


def op6_masked_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their pseudo-log-likelihood and its mean per word."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = corpus_vocabulary(docs)
    coded = stored(coded_texts(docs, vocabulary), "coded")
    scored = score(docs, vocabulary, fit(coded, vocabulary), coded)
    mean = F.col("log_probability") / F.nullif(F.col("n_words"), F.lit(0))
    return scored.withColumn("per_word", mean)


QUERIES = {"op6_masked_pseudo_likelihood": op6_masked_pseudo_likelihood}
ORACLES: dict[str, str] = {}
