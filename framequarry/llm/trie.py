"""A compact trie of a sorted word list, and its intersection with distance-one Levenshtein automata, both in numpy.

Nodes are numbered level by level, so the children of a node are neighbours in number and ordered by letter. A node costs
its first child, its letter, the word that ends there and a mask of its children's letters: 22 bytes.
"""

from __future__ import annotations

import numpy as np

#: Letters are code points, below 2^21.
LETTER_BITS = 21
#: States taken from the stack at once; the stack holds at most a few times as many for each letter of a word.
BLOCK = 1 << 13


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All letters one after the other, and where each word starts (one more at the end)."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    start = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=start[1:])
    return flat, start


def _bit(letter: np.ndarray) -> np.ndarray:
    return np.uint64(1) << ((letter.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58))


class Trie:
    """``first`` (children of node v are first[v] to first[v + 1] - 1), ``letter``, ``word`` (number of the word that ends here, or -1) and ``mask``."""

    def __init__(self, first: np.ndarray, letter: np.ndarray, word: np.ndarray):
        self.first, self.letter, self.word = first, letter, word
        parent = np.repeat(np.arange(len(letter), dtype=np.int64), np.diff(first))
        #: Of the edges in order of number, that is of parent and letter: what a child is looked up by.
        self.edges = (parent << LETTER_BITS) | letter[1:]
        self.mask = np.zeros(len(letter), np.uint64)
        np.bitwise_or.at(self.mask, parent, _bit(letter[1:]))

    @classmethod
    def build(cls, words: list[str]) -> Trie:
        """``words`` are distinct and sorted by code points."""
        flat, start = code_points(words)
        size = np.diff(start)
        active, node = np.arange(len(words)), np.zeros(len(words), np.int64)  # words longer than the depth, their node at it
        letters, ends, children, depth, nodes = [np.zeros(1, np.int64)], [np.full(1, -1, np.int64)], [], 0, 1
        while True:
            done = size[active] == depth
            ends[-1][node[done]] = active[done]
            active, node = active[~done], node[~done]
            if not len(active):
                children.append(np.zeros(len(letters[-1]), np.int64))
                break
            c = flat[start[active] + depth]
            new = np.ones(len(active), bool)
            new[1:] = (node[1:] != node[:-1]) | (c[1:] != c[:-1])
            children.append(np.bincount(node[new], minlength=len(letters[-1])))
            letters.append(c[new])
            ends.append(np.full(len(letters[-1]), -1, np.int64))
            node, depth, nodes = np.cumsum(new) - 1, depth + 1, nodes + int(new.sum())
        first = np.empty(nodes + 1, np.int64)
        first[0] = 1
        np.cumsum(np.concatenate(children), out=first[1:])
        first[1:] += 1
        return cls(first, np.concatenate(letters), np.concatenate(ends))

    def to_bytes(self) -> bytes:
        return b"".join(a.astype(np.int32).tobytes() for a in (self.first, self.letter, self.word))

    @classmethod
    def from_bytes(cls, blob: bytes) -> Trie:
        a = np.frombuffer(blob, np.int32).astype(np.int64)
        n = (len(a) - 1) // 3
        return cls(a[: n + 1], a[n + 1 : 2 * n + 1], a[2 * n + 1 :])

    def child(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The child by ``letter`` of each node, or -1."""
        out = np.full(len(node), -1, np.int64)
        may = np.flatnonzero(self.mask[node] & _bit(letter))
        if len(may):
            key = (node[may] << LETTER_BITS) | letter[may]
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            hit = self.edges[at] == key
            out[may[hit]] = at[hit] + 1
        return out

    def neighbours(self, words: list[str], block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in ``words``, number of a word of the trie) at a distance of exactly one insertion, deletion or replacement.

        A state is (word, node, letters read, edits made). States wait on a stack; the ones pushed last, which are the deepest,
        are taken first, in blocks, so that the memory is bounded however many neighbours there are."""
        flat, start = code_points(words)
        flat = np.append(flat, 0)
        stack = []
        for a in range(0, len(words), block):
            q = np.arange(a, min(a + block, len(words)))
            stack.append((q, np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.zeros(len(q), bool)))
        stack.reverse()
        found_q, found_w = [], []
        while stack:
            q, node, at, edited = stack.pop()
            if len(q) > block:
                stack.append(tuple(a[block:] for a in (q, node, at, edited)))
                q, node, at, edited = (a[:block] for a in (q, node, at, edited))
            left = start[q + 1] - start[q] - at
            accept = edited & (left == 0) & (self.word[node] >= 0)
            found_q.append(q[accept])
            found_w.append(self.word[node[accept]])
            nexts = []

            def push(q, node, at, edited):
                """Keeps what can still accept: at a word's end a node where one ends, else one that has the next letter."""
                left = start[q + 1] - start[q] - at
                letter = flat[start[q] + at]
                ok = np.where(left == 0, ~edited | (self.word[node] >= 0), ~edited | ((self.mask[node] & _bit(letter)) != 0))
                if ok.any():
                    nexts.append((q[ok], node[ok], at[ok], np.full(int(ok.sum()), edited)))

            # The next letter as it is.
            more = np.flatnonzero(left > 0)
            for e in (False, True):
                i = more[edited[more] == e]
                if len(i):
                    to = self.child(node[i], flat[start[q[i]] + at[i]])
                    hit = to >= 0
                    push(q[i[hit]], to[hit], at[i[hit]] + 1, np.bool_(e))
            # One edit: a letter of the word less, one more, or another one.
            fresh = np.flatnonzero(~edited)
            if len(fresh):
                i = fresh[left[fresh] > 0]
                push(q[i], node[i], at[i] + 1, np.bool_(True))
                n = self.first[node[fresh] + 1] - self.first[node[fresh]]
                i = np.repeat(fresh, n)
                to = self.first[node[i]] + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
                push(q[i], to, at[i], np.bool_(True))
                other = (left[i] > 0) & (self.letter[to] != flat[start[q[i]] + at[i]])
                push(q[i[other]], to[other], at[i[other]] + 1, np.bool_(True))
            if nexts:
                stack.append(tuple(np.concatenate(a) for a in zip(*nexts, strict=True)))
        if not found_q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.stack([np.concatenate(found_q), np.concatenate(found_w)], axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]
