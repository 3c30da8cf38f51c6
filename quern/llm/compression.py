"""Pairs of zstandard dictionaries, one from the texts of either class: which of them compresses a text better, and by how much.

Texts are cut into windows of words. Where whole texts of the classes differ, as good and bad prose do, each dictionary is
trained on its class's windows (`trained_pair`). Where special texts are ordinary ones with some passages of another kind,
as toxic texts are, the dictionary trained on all their windows would differ from the other by chance more than by those
passages. Then both dictionaries hold what is trained on ordinary windows, and the special one the passages of special
texts besides whose k-mers stand in more special texts than chance lets them (`passage_pair`).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import xxhash
import zstandard

#: Words in a compressed window; bytes of a dictionary, of what both dictionaries hold, and of special passages.
WINDOW_WORDS, TRAINED_BYTES, SHARED_BYTES, PASSAGE_BYTES = 16, 65_536, 32_768, 24_000
#: Bytes above which a stretch of special text is cut into pieces.
PIECE_BYTES = 512
#: Bytes of a k-mer (at most 8), and how many times the logarithm of their number a k-mer's log-likelihood ratio must be.
KMER, LEAST_RATIO = 6, 2.0
#: Parts of the labelled texts: each part's sizes come from dictionaries of the other parts.
FOLDS = 3


def windows(text: bytes, lower: bool) -> list[bytes]:
    w = (text.decode("utf-8", "replace").lower().encode() if lower else text).split()
    return [b" " + b" ".join(w[i : i + WINDOW_WORDS]) + b" " for i in range(0, len(w), WINDOW_WORDS)]


def without_copies(texts: list[bytes]) -> list[bytes]:
    """The texts of whose runs of three words at most half stand in those before."""
    seen: set[int] = set()
    out = []
    for text in texts:
        w = text.split()
        runs = {xxhash.xxh64_intdigest(b" ".join(w[i : i + 3])) for i in range(max(1, len(w) - 2))}
        if 2 * len(runs & seen) <= len(runs):
            out.append(text)
        seen |= runs
    return out


def trained(texts: list[bytes], lower: bool, size: int, segment: int) -> bytes:
    """A dictionary that zstandard trains on the windows of the texts; of too few windows, these as they stand."""
    samples = [x for t in texts for x in windows(t, lower)]
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=KMER).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def kmers(text: bytes) -> np.ndarray:
    """The k-mers of a text as numbers, in order."""
    a = np.frombuffer(text, np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(a) - KMER + 1), np.uint64)
    for i in range(KMER if len(out) else 0):
        out = (out << np.uint64(8)) | a[i : i + len(out)]
    return out


def spaced(text: bytes, lower: bool) -> bytes:
    return b" ".join(x.strip() for x in windows(text, lower)).join([b" ", b" "])


def text_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The sorted k-mers, and in how many texts each stands."""
    each = [np.unique(kmers(t)) for t in texts]
    return np.unique(np.concatenate(each), return_counts=True) if each else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def found_in(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of the wanted among sorted keys; 0 for those not there."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0).astype(np.float64)


def passages(special: list[bytes], ordinary: list[bytes], lower: bool) -> bytes:
    """The stretches of special texts that consist of k-mers which are twice as frequent there at least and beyond chance, the most telling last; a long stretch counts in pieces, and one that no longer fits PASSAGE_BYTES leaves room for shorter ones."""
    special, ordinary = [spaced(t, lower) for t in special], [spaced(t, lower) for t in ordinary]
    keys, n = text_counts(special)
    if not len(keys):
        return b""
    m = found_in(*text_counts(ordinary), keys)
    share = len(special) / max(1, len(special) + len(ordinary))
    expected = (n + m) * share
    ratio = 2 * (n * np.log(n / expected) + m * np.log(np.maximum(m, 1) / np.maximum(n + m - expected, 1e-9)))
    ratio = np.where((n * len(ordinary) > 2 * m * len(special)) & (ratio > LEAST_RATIO * math.log(max(2, len(keys)))), ratio, 0.0)
    best: dict[bytes, float] = {}
    for text in special:
        weight = found_in(keys, ratio, kmers(text))
        cover = np.zeros(len(text) + 1, np.int64)
        hits = np.flatnonzero(weight)
        np.add.at(cover, hits, 1)
        np.add.at(cover, hits + KMER, -1)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8), [0]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            for i in range(a, b, PIECE_BYTES):  # a long stretch in pieces, each with a k-mer at least
                j = b if b - i < PIECE_BYTES + KMER else i + PIECE_BYTES
                if j - i >= KMER:
                    best[text[i:j]] = max(best.get(text[i:j], 0.0), float(weight[i : j - KMER + 1].max()))
    out, size, held = [], 0, set()
    for passage, _ in sorted(best.items(), key=lambda x: (-x[1], x[0])):
        if (own := set(kmers(passage).tolist())) <= held or size + len(passage) > PASSAGE_BYTES:
            continue
        held |= own
        size += len(passage)
        out.append(passage)
    return b"".join(reversed(out))


@dataclass
class DictionaryPair:
    """The special and the ordinary dictionary; raw: their content is plain text, not what zstandard's trainer made. wholes: whole texts differ, so that only the sum of a text's differences counts, and its calibration follows the labelled texts in steps; else the largest difference of a window counts too."""

    special: bytes
    ordinary: bytes
    lower: bool
    raw: bool
    wholes: bool
    _pair: tuple | None = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_pair": None}

    def compressors(self) -> tuple:
        if self._pair is None:
            p = zstandard.ZstdCompressionParameters.from_level(
                9, min_match=4, strategy=zstandard.STRATEGY_LAZY2, search_log=5, window_log=18, hash_log=17, chain_log=17,
                write_content_size=0, write_checksum=0, write_dict_id=0,
            )
            kind = zstandard.DICT_TYPE_RAWCONTENT if self.raw else zstandard.DICT_TYPE_AUTO
            self._pair = tuple(zstandard.ZstdCompressor(compression_params=p, dict_data=zstandard.ZstdCompressionDict(d.rjust(8), dict_type=kind)) for d in (self.special, self.ordinary))
        return self._pair

    def features(self, text: bytes) -> tuple[float, ...]:
        """Over the windows of the whole text: how many bytes fewer the special dictionary needs, per raw byte, and, if asked, for one window at most. Texts without words: zeros."""
        a, b = self.compressors()
        saved = most = raw = 0
        for x in windows(text, self.lower):
            d = len(b.compress(x)) - len(a.compress(x))
            saved, most, raw = saved + d, max(most, d), raw + len(x)
        mean = saved / raw if raw else 0.0
        return (mean,) if self.wholes else (mean, float(most))


def trained_pair(special: list[bytes], ordinary: list[bytes], lower: bool) -> DictionaryPair:
    a, b = (trained(without_copies(x), lower, TRAINED_BYTES, 64) for x in (special, ordinary))
    return DictionaryPair(a, b, lower, raw=False, wholes=True)


def passage_pair(special: list[bytes], ordinary: list[bytes], lower: bool) -> DictionaryPair:
    special, ordinary = without_copies(special), without_copies(ordinary)
    shared = trained(ordinary, lower, SHARED_BYTES, 32)
    return DictionaryPair(passages(special, ordinary, lower) + shared, shared, lower, raw=True, wholes=False)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Coefficients, the constant last, of a ridge-regularised weighted logistic regression, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ b)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return b


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising steps that fit y best: the mean x and y of each (pooled neighbours that would fall)."""
    blocks: list[list[float]] = []
    for i in np.argsort(x, kind="stable").tolist():
        blocks.append([x[i] * weight[i], y[i] * weight[i], weight[i]])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


@dataclass
class CompressionModel:
    """A pair of dictionaries with the calibration of its size differences; score() is the probability of the special class."""

    pair: DictionaryPair | None
    mean: np.ndarray
    scale: np.ndarray
    coefficients: np.ndarray
    steps: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def fit(cls, special: list[bytes], ordinary: list[bytes], n_special: int, n_ordinary: int, lower: bool, build: Callable[..., DictionaryPair]) -> CompressionModel:
        """All texts train the dictionaries; the sizes that calibrate them come, for each of FOLDS parts, from dictionaries of the other parts. n_special, n_ordinary: all labelled rows, which set the prior; without texts of both classes every score is the smoothed prior."""
        prior = (n_special + 1) / (n_special + n_ordinary + 2)
        if not special or not ordinary:
            return cls(None, np.zeros(0), np.ones(0), np.array([math.log(prior / (1 - prior))]))
        folds = FOLDS if min(len(special), len(ordinary)) >= 2 * FOLDS else 1
        rows, y = [], []
        for fold in range(folds):
            others = [[t for i, t in enumerate(x) if folds == 1 or i % folds != fold] for x in (special, ordinary)]
            pair = build(*others, lower)
            for own, value in ((special[fold::folds], 1.0), (ordinary[fold::folds], 0.0)):
                rows += [pair.features(t) for t in own]
                y += [value] * len(own)
        x, y = np.array(rows), np.array(y)
        weight = np.where(y == 1, prior / len(special), (1 - prior) / len(ordinary)) * len(y)
        mean, scale = x.mean(0), x.std(0) + 1e-9
        b = logistic((x - mean) / scale, y, weight)
        z = ((x - mean) / scale) @ b[:-1] + b[-1]
        return cls(build(special, ordinary, lower) if folds > 1 else pair, mean, scale, b, isotonic(z, y, weight) if pair.wholes else None)

    def score(self, text: bytes) -> float:
        if self.pair is None:
            return float(1 / (1 + math.exp(-self.coefficients[0])))
        z = float(((np.array(self.pair.features(text)) - self.mean) / self.scale) @ self.coefficients[:-1] + self.coefficients[-1])
        smooth = 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))
        if self.steps is None:
            return smooth
        return 0.98 * float(np.interp(z, *self.steps)) + 0.02 * smooth  # on a step, the larger difference ranks higher
