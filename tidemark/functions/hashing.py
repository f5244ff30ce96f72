"""Hash positions for bitmaps and bloom filters."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BITS = 64
_WORD_SEED = 1
_BITS_SEED = 2


def bit_offset(text: Column | str, bits: int = 30) -> Column:
    """Position of a string in a bitmap of ``2**bits`` bits.

    The hash multiplies by 32 per character, so a character further than
    ``bits / 5`` from the end is shifted out of the mask.  Adding up the last few
    characters is the whole hash and stays inside generated code.
    """
    column = F.col(text) if isinstance(text, str) else text
    mask = F.lit((1 << bits) - 1).cast("long")
    total = F.lit(0).cast("long")
    for back in range(math.ceil(bits / 5)):
        code = F.ascii(F.substring(column, -(back + 1), 1)).cast("long")
        total = total + F.shiftleft(code, 5 * back)
    return total.bitwiseAND(mask)


#: A 64-bit number out of a seed and key columns.
KeyHash = Callable[[int, Sequence[str]], Column]

#: Bits per key that a filter may have: few are tried one by one, many in wider steps.
_BITS_PER_KEY = (*range(4, 65), *range(72, 129, 8), *range(144, 257, 16), *range(320, 1025, 64))


def xx_hash(seed: int, keys: Sequence[str]) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])


def md5_hash(seed: int, keys: Sequence[str]) -> Column:
    """Sixty bits that other engines compute too; slower than :func:`xx_hash`."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


@lru_cache(maxsize=256)
def word_filter_shape(expected: int, fpp: float) -> tuple[int, int]:
    """Words and bits per key of a bloom filter made of 64-bit words.

    All bits of one key lie in one word, so the number of keys per word is
    Poisson distributed and the error rate is the mean over that distribution.
    """
    if not 0 < fpp < 1:
        raise ValueError("fpp must lie between 0 and 1")

    def error(bits_per_key: int, k: int) -> float:
        load = WORD_BITS / bits_per_key
        weight, mean = math.exp(-load), 0.0
        for keys in range(1, 200):
            weight *= load / keys
            mean += weight * (1 - (1 - 1 / WORD_BITS) ** (k * keys)) ** k
        return mean

    for bits_per_key in _BITS_PER_KEY:
        rate, k = min((error(bits_per_key, k), k) for k in range(1, 9))
        if rate <= 0.8 * fpp:
            return max(1, math.ceil(max(1, expected) * bits_per_key / WORD_BITS)), k
    raise ValueError(f"fpp {fpp} is too small for a word filter")


def word_number(keys: Sequence[str], words: int, hash_of: KeyHash = xx_hash) -> Column:
    """The word a key belongs to."""
    return F.pmod(hash_of(_WORD_SEED, keys), F.lit(words).cast("long"))


def word_mask(keys: Sequence[str], k: int, hash_of: KeyHash = xx_hash) -> Column:
    """The bits a key sets in its word."""
    h = hash_of(_BITS_SEED, keys)
    mask = F.lit(0).cast("long")
    for i in range(k):
        position = F.shiftright(h, 6 * i).bitwiseAND(F.lit(WORD_BITS - 1).cast("long")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), position))
    return mask
