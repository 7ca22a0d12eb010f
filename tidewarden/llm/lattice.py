"""Words as lattices of subword pieces: probabilities summed over all segmentations, and expected piece counts.

The vocabulary is a fixed public one. A word is the bytes of a blank and of the word itself; its lattice has an arc
for every piece that stands somewhere in it, and the 256 single bytes are pieces too, so each word has a path. Words
of equal length are walked through the trie of the pieces together, as numpy arrays.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Longer words take the plain loop instead of a matrix of bytes.
LONG = 64


def public_pieces(path: str, lower: bool = True) -> list[bytes]:
    """The pieces of a vocabulary file that can stand in lower-cased words, then the single bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[bytes, None] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        # A blank can only begin a word; capital letters do not occur in lower-cased words.
        if b" " in piece[1:] or (lower and piece != piece.lower()):
            continue
        found[piece] = None
    for value in range(256):
        found.setdefault(bytes([value]), None)
    return list(found)


class Lattice:
    """The trie of the pieces, with the walks over words that need no probabilities."""

    def __init__(self, pieces: Sequence[bytes]):
        self.pieces = list(pieces)
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        used = sorted({b for p in pieces for b in p})
        self.column = np.zeros(256, dtype=np.int32)
        self.column[used] = np.arange(len(used), dtype=np.int32)
        children: list[dict[int, int]] = [{}]
        piece_at = [-1]
        for i, piece in enumerate(pieces):
            node = 0
            for b in piece:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                    piece_at.append(-1)
                node = children[node][b]
            piece_at[node] = i
        self.width = len(used)
        self.step = np.zeros(len(children) * self.width, dtype=np.int32)
        for node, below in enumerate(children):
            for b, child in below.items():
                self.step[node * self.width + self.column[b]] = child
        self.piece_at = np.array(piece_at, dtype=np.int32)

    def arcs(self, matrix: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(from, to, words, pieces) of words of equal length, ordered by `from`. Node 0 doubles as "no such node"."""
        n, length = matrix.shape
        columns = self.column[matrix]
        everyone = np.arange(n, dtype=np.int32)
        for start in range(length):
            rows, node = everyone, np.zeros(n, dtype=np.int32)
            for end in range(start + 1, min(length, start + self.longest) + 1):
                node = self.step[node * self.width + columns[rows, end - 1]]
                going = node > 0
                if not going.all():
                    rows, node = rows[going], node[going]
                if not len(rows):
                    break
                piece = self.piece_at[node]
                is_piece = piece >= 0
                if is_piece.all():
                    yield start, end, rows, piece
                elif is_piece.any():
                    yield start, end, rows[is_piece], piece[is_piece]

    def _long_arcs(self, word: bytes) -> Iterator[tuple[int, int, int]]:
        for start in range(len(word)):
            for end in range(start + 1, min(len(word), start + self.longest) + 1):
                piece = self.ids.get(word[start:end])
                if piece is not None:
                    yield start, end, piece

    def score(self, words: Sequence[bytes], logp: np.ndarray) -> np.ndarray:
        """Natural log of each word's probability, for one or several sets of piece scores (pieces x sets).

        A forward recursion in log space over the byte positions of the word.
        """
        sets = logp.reshape(len(self.pieces), -1)
        out = np.empty((len(words), sets.shape[1]))
        for where, matrix in self._grouped(words):
            forward = np.full((matrix.shape[1] + 1, len(where), sets.shape[1]), -np.inf)
            forward[0] = 0.0
            for start, end, rows, piece in self.arcs(matrix):
                forward[end, rows] = np.logaddexp(forward[end, rows], forward[start, rows] + sets[piece])
            out[where] = forward[-1]
        for i, word in enumerate(words):
            if len(word) >= LONG:
                text = b" " + word
                line = np.full((len(text) + 1, sets.shape[1]), -np.inf)
                line[0] = 0.0
                for start, end, piece in self._long_arcs(text):
                    line[end] = np.logaddexp(line[end], line[start] + sets[piece])
                out[i] = line[-1]
        return out.reshape(len(words), *logp.shape[1:])

    def expected(self, words: Sequence[bytes], weights: np.ndarray, logp: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece, over all segmentations of all words, by forward and backward."""
        counts = np.zeros(len(self.pieces))
        for where, matrix in self._grouped(words):
            length = matrix.shape[1]
            arcs = list(self.arcs(matrix))
            forward = np.full((length + 1, len(where)), -np.inf)
            backward = np.full((length + 1, len(where)), -np.inf)
            forward[0] = backward[length] = 0.0
            for start, end, rows, piece in arcs:
                forward[end, rows] = np.logaddexp(forward[end, rows], forward[start, rows] + logp[piece])
            for start, end, rows, piece in reversed(arcs):
                backward[start, rows] = np.logaddexp(backward[start, rows], backward[end, rows] + logp[piece])
            used, shares = [], []
            for start, end, rows, piece in arcs:
                path = forward[start, rows] + logp[piece] + backward[end, rows] - forward[length, rows]
                used.append(piece)
                shares.append(np.exp(path) * weights[where[rows]])
            counts += np.bincount(np.concatenate(used), np.concatenate(shares), minlength=len(counts))
        for i, word in enumerate(words):
            if len(word) >= LONG:
                self._expected_long(b" " + word, float(weights[i]), logp, counts)
        return counts

    def _expected_long(self, text: bytes, weight: float, logp: np.ndarray, counts: np.ndarray) -> None:
        forward, backward = np.full(len(text) + 1, -np.inf), np.full(len(text) + 1, -np.inf)
        forward[0] = backward[-1] = 0.0
        for start, end, piece in self._long_arcs(text):
            forward[end] = np.logaddexp(forward[end], forward[start] + logp[piece])
        for start in range(len(text) - 1, -1, -1):
            for end in range(start + 1, min(len(text), start + self.longest) + 1):
                piece = self.ids.get(text[start:end])
                if piece is not None:
                    backward[start] = np.logaddexp(backward[start], backward[end] + logp[piece])
                    counts[piece] += weight * np.exp(forward[start] + logp[piece] + backward[end] - forward[-1])

    def _grouped(self, words: Sequence[bytes], most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Indices of the words of one length and their bytes as a matrix, a leading blank included."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(lengths, kind="stable")
        edges = np.searchsorted(lengths[order], np.arange(LONG + 1))
        for length in range(LONG):
            for low in range(edges[length], edges[length + 1], most):
                where = order[low : min(low + most, edges[length + 1])]
                data = np.frombuffer(b"".join([words[i] for i in where]), dtype=np.uint8).reshape(len(where), length)
                yield where, np.concatenate([np.full((len(where), 1), ord(" "), dtype=np.uint8), data], axis=1)


def starting_scores(pieces: Sequence[bytes]) -> np.ndarray:
    """Scores before anything is learnt: the vocabulary is ordered by frequency, so a piece's rank gives a share."""
    shares = 1.0 / (np.arange(len(pieces)) + 100.0)
    return np.log(shares / shares.sum())


def scores_of(counts: np.ndarray, extra: float = 0.0, smoothing: float = 0.1) -> np.ndarray:
    """Natural logs of the pieces' probabilities; `extra` is the weight of symbols beside the pieces."""
    return np.log((counts + smoothing) / (counts.sum() + extra + smoothing * (len(counts) + 1)))
