"""A minimal acyclic transducer from words (bytes) to their number, in flat arrays.

Words with a common beginning share states, and so do words with a common end: states of
equal futures are one.  Each arc carries the number of words that sort before it, so the
sum along a word is the word's place in sorted order.  The arrays lie in one block of
bytes that a task maps instead of loading.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

import numpy as np
import pyarrow as pa


def compile_words(words: Sequence[bytes]) -> bytes:
    """The block for distinct, sorted, non-empty words."""
    register: dict[tuple, int] = {}
    arcs_of: list[dict[int, int]] = [{}, {}]  # state 0: no way on; state 1: the start
    final = [False, False]
    path = [1]
    before = b""

    def settle(depth: int) -> None:
        """Replaces finished states on the path by equal ones met earlier."""
        for at in range(len(path) - 1, depth, -1):
            state = path[at]
            shape = (final[state], tuple(arcs_of[state].items()))
            known = register.setdefault(shape, state)
            if known != state:
                arcs_of[path[at - 1]][before[at - 1]] = known
        del path[depth + 1:]

    for word in words:
        common = 0
        while common < min(len(word), len(before)) and word[common] == before[common]:
            common += 1
        settle(common)
        for byte in word[common:]:
            arcs_of.append({})
            final.append(False)
            arcs_of[path[-1]][byte] = len(arcs_of) - 1
            path.append(len(arcs_of) - 1)
        final[path[-1]] = True
        before = word
    settle(0)

    number, stack, order = {0: 0, 1: 1}, [1], [1]
    while stack:
        for target in arcs_of[stack.pop()].values():
            if target not in number:
                number[target] = len(number)
                order.append(target)
                stack.append(target)
    used = sorted({byte for state in order for byte in arcs_of[state]})
    classes = np.zeros(256, np.int32)
    classes[used] = np.arange(1, len(used) + 1)
    width = len(used) + 1
    step = np.zeros((len(number), width), np.int32)
    skipped = np.zeros((len(number), width), np.int32)
    ends = np.zeros(len(number), np.int32)
    futures: dict[int, int] = {}

    def count(state: int) -> int:
        """Words that can still end from a state."""
        todo = [state]
        while todo:
            top = todo[-1]
            missing = [t for t in arcs_of[top].values() if t not in futures]
            if missing:
                todo += missing
            else:
                futures[top] = final[top] + sum(futures[t] for t in arcs_of[top].values())
                todo.pop()
        return futures[state]

    count(1)
    for state in order:
        row, passed = number[state], int(final[state])
        ends[row] = final[state]
        for byte in sorted(arcs_of[state]):
            target = arcs_of[state][byte]
            step[row, classes[byte]] = number[target]
            skipped[row, classes[byte]] = passed
            passed += futures[target]
    head = np.array([len(number), width, max(map(len, words), default=0)], np.int32)
    return b"".join(a.tobytes() for a in (head, classes, ends, step, skipped))


class Lexicon:
    """A block mapped into memory; ``places`` looks up a whole column of words at once."""

    def __init__(self, block: bytes):
        # The file has no name any more once it is mapped, so nothing stays behind.
        with tempfile.TemporaryFile() as file:
            file.write(block)
            file.flush()
            data = np.memmap(file, np.int32, "r")
        states, self.width, self.longest = (int(v) for v in data[:3])
        cuts = np.cumsum([3, 256, states, states * self.width])
        self.classes, self.ends, self.step, self.skipped = np.split(data, cuts)[1:]

    def places(self, words: pa.Array) -> np.ndarray:
        """Each word's place among the sorted words of the lexicon, -1 if it is not there."""
        n = len(words)
        found = np.full(n, -1, np.int64)
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + n + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        lengths = np.diff(offsets)
        live = np.flatnonzero((lengths > 0) & (lengths <= self.longest))
        state, total = np.ones(len(live), np.int64), np.zeros(len(live), np.int64)
        for position in range(self.longest):
            if not len(live):
                break
            arc = state * self.width + self.classes[data[offsets[live] + position]]
            state, total = self.step[arc].astype(np.int64), total + self.skipped[arc]
            over = lengths[live] == position + 1
            hit = over & (self.ends[state] > 0)
            found[live[hit]] = total[hit]
            going = ~over & (state > 0)
            live, state, total = live[going], state[going], total[going]
        return found
