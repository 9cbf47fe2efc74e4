"""An existing subword vocabulary as a unigram model, and walks over its lattice.

Sorted words are met in the order of a depth-first walk of their trie. The walk keeps the scores
of the current path only, so a prefix shared by many words is scored once and memory is that of
one word.
"""

from __future__ import annotations

import functools
import math
from typing import NamedTuple

import sentencepiece

#: The mark of a word's start in the vocabulary.
START = "▁"


class Vocabulary(NamedTuple):
    """Pieces by number, their log probabilities, and the numbers of the 256 single-byte pieces."""

    pieces: list[str]
    scores: list[float]
    bytes_at: list[int]


@functools.cache
def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a vocabulary file with unigram scores; read on the driver, of fixed size.

    The file ranks its pieces (its score is minus the rank). A unigram model needs
    probabilities, so these fall with the rank as in Zipf's law. Single bytes, for characters
    that are no piece, come after the last rank. Control pieces and runs of spaces are left out.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [k for k in range(size) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k))
             and model.id_to_piece(k).strip(START) or model.id_to_piece(k) == START]
    single = {int(model.id_to_piece(k)[3:5], 16): k for k in range(size) if model.is_byte(k)}
    ranks = [-model.get_score(k) for k in plain]
    last = max(ranks)
    weights = [1 / (1 + r) for r in ranks] + [1 / (2 + last + b) for b in range(256)]
    total = math.log(sum(weights))
    pieces = [model.id_to_piece(k) for k in plain] + [model.id_to_piece(single[b]) for b in range(256)]
    return Vocabulary(pieces, [math.log(w) - total for w in weights], [len(plain) + b for b in range(256)])


class Lattice:
    """Arcs of the lattice: which pieces end at a place of a word."""

    def __init__(self, vocabulary: Vocabulary, scores: list[float] | None = None):
        scores = vocabulary.scores if scores is None else scores
        self.scores, self.bytes_at = scores, vocabulary.bytes_at
        # Every ending of a piece; that of a whole piece has its number and score, another one nothing.
        self.endings: dict[str, tuple[int, float] | tuple[()]] = {}
        for number, piece in enumerate(vocabulary.pieces[: vocabulary.bytes_at[0]]):
            for start in range(1, len(piece)):
                self.endings.setdefault(piece[start:], ())
            self.endings[piece] = (number, scores[number])

    def arcs(self, text: str, end: int) -> list[tuple[int, int | bytes, float]]:
        """Start, piece and score of each piece of ``text`` that ends at ``end``, from short to long.

        A character that is no piece is one arc of its single bytes. No piece is longer than an
        ending that none has.
        """
        found, endings = [], self.endings
        for start in range(end - 1, -1, -1):
            hit = endings.get(text[start:end])
            if hit:
                found.append((start, *hit))
            elif hit is None:
                break
        last = text[end - 1]
        if not endings.get(last):
            spelled = last.encode()
            found.append((end - 1, spelled, sum(self.scores[self.bytes_at[b]] for b in spelled)))
        return found


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    for k in range(n):
        if a[k] != b[k]:
            return k
    return n


def best_counts(words: list[bytes], lattice: Lattice) -> list[int]:
    """For each of the sorted words, the number of tokens in its best segmentation.

    Best is the highest sum of scores; of equal ones, the fewest tokens.
    """
    best, tokens, before, out = [0.0], [0], "", []
    for word in words:
        text = START + word.decode()
        shared = shared_prefix(before, text)
        del best[shared + 1:], tokens[shared + 1:]
        for end in range(shared + 1, len(text) + 1):
            top, count = -math.inf, 0
            for start, piece, score in lattice.arcs(text, end):
                value = best[start] + score
                more = tokens[start] + (len(piece) if isinstance(piece, bytes) else 1)
                if value > top or value == top and more < count:
                    top, count = value, more
            best.append(top)
            tokens.append(count)
        out.append(tokens[len(text)])
        before = text
    return out


def marginals(words: list[bytes], lattice: Lattice) -> list[float]:
    """For each of the sorted words, the log of the summed probability of all segmentations."""
    alpha, before, out, exp, log = [0.0], "", [], math.exp, math.log
    for word in words:
        text = START + word.decode()
        shared = shared_prefix(before, text)
        del alpha[shared + 1:]
        for end in range(shared + 1, len(text) + 1):
            terms = [alpha[start] + score for start, _, score in lattice.arcs(text, end)]
            top = max(terms)
            alpha.append(top + log(sum([exp(t - top) for t in terms])) if len(terms) > 1 else top)
        out.append(alpha[len(text)])
        before = text
    return out


def expected(words: list[bytes], counts: list[int], lattice: Lattice) -> list[float]:
    """Expected uses of each piece when every sorted word stands ``counts`` times.

    Going forward, a place keeps the share of each arc in its probability. When the walk leaves
    a place, what passes through it is dealt to its arcs by these shares: all words below a
    prefix are dealt at once.
    """
    uses = [0.0] * len(lattice.scores)
    alpha, shares, passing, before, exp, log = [0.0], [()], [0.0], "", math.exp, math.log

    def leave(depth: int) -> None:
        while len(alpha) > depth + 1:
            through, arcs = passing.pop(), shares.pop()
            alpha.pop()
            for start, piece, share in arcs:
                part = through * share
                passing[start] += part
                if isinstance(piece, bytes):
                    for b in piece:
                        uses[lattice.bytes_at[b]] += part
                else:
                    uses[piece] += part

    for word, count in zip(words, counts):
        text = START + word.decode()
        leave(shared_prefix(before, text))
        for end in range(len(alpha), len(text) + 1):
            arcs = lattice.arcs(text, end)
            terms = [alpha[start] + score for start, _, score in arcs]
            top = max(terms)
            weights = [exp(t - top) for t in terms]
            total = sum(weights)
            alpha.append(top + log(total))
            shares.append([(a[0], a[1], w / total) for a, w in zip(arcs, weights)])
            passing.append(0.0)
        passing[len(text)] += count
        before = text
    leave(0)
    return uses
