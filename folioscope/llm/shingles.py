"""Word shingles as 64-bit hashes and SuperMinHash signatures, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
STEPS = np.arange(1, 1025, dtype=np.uint64) * ODD[0]
#: Elements that a block of the signature's permutation table holds.
BLOCK = 1 << 18


class WordHash(dict):
    """word -> 64-bit hash; emptied when full."""

    def __missing__(self, word: str | bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= 500_000:
            self.clear()
        self[word] = value
        return value


HASHES = WordHash()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_list(text: str) -> list[bytes]:
    """Words in UTF-8 after lower-casing A-Z: of bytes, lower() and split() know ASCII alone, so they do just that."""
    return text.encode("utf-8").lower().split()


def word_hashes(words: list) -> np.ndarray:
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def windows(h: np.ndarray, width: int = 5) -> np.ndarray:
    """Hash of every window of `width` words; the whole sequence as one where it is shorter; none without words."""
    width = min(width, len(h))
    if not width:
        return np.zeros(0, np.uint64)
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mix(out + h[k : k + n] * ODD[k % 5])
    return out


def shingle_set(words: list, width: int = 5) -> np.ndarray:
    return np.unique(windows(word_hashes(words), width))


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """Signatures (len(sets), m) of uint64; rows of empty sets are all ones.

    Every element draws one permutation of the m slots and gives slot p[j] the value j + r[j]; a slot keeps its
    smallest. The ranks of one element are so without repetition over the slots, which lowers the variance, and an
    element needs no step j once every slot of its set is below j. Elements go in blocks, so a very long text needs
    no more memory than a block; the result doesn't depend on the blocks.
    """
    sig = np.full((len(sets), m), np.inf)
    flat = sig.reshape(-1)
    lens = np.array([len(s) for s in sets], np.int64)
    owner, every = np.repeat(np.arange(len(sets)), lens), np.concatenate([*sets, np.zeros(0, np.uint64)])
    for lo in range(0, len(every), BLOCK):
        h, doc = every[lo : lo + BLOCK], owner[lo : lo + BLOCK]
        perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(h), 1))
        for j in range(m):
            x = mix(h + STEPS[j])
            r = (x >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))
            k = j + (mix(x ^ ODD[1]) % np.uint64(m - j)).astype(np.int64)
            at = np.arange(len(h))
            slot = perm[at, k].astype(np.int64)
            perm[at, k] = perm[:, j]
            np.minimum.at(flat, doc * m + slot, r + j)
            first = doc[0]
            open_ = sig[first : doc[-1] + 1].max(1) >= j + 1
            if not open_.any():
                break
            alive = open_[doc - first]
            if not alive.all():
                h, doc, perm = h[alive], doc[alive], perm[alive]
    return sig.view(np.uint64)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n, bands) of int64: a hash of each band's slots."""
    out = np.empty((len(sig), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(sig), b + 1, np.uint64)
        for k in range(rows):
            key = mix(key * ODD[1] + sig[:, b * rows + k])
        out[:, b] = key
    return out.view(np.int64)
