"""Text functions with the token rules of the MLlib text stages."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylens.functions.stopwords import ENGLISH_STOP_WORDS

# The characters of the pattern \s. Trimming is linear, where a pattern for trailing blanks retries inside every run.
BLANKS = " \t\n\x0b\f\r"


def word_count(text: Column, compat: bool = False) -> Column:
    """Pieces between runs of white space.

    ``compat`` splits at a literal backslash followed by ``s``, which is what the
    over-escaped pattern of older jobs did: nearly every text then counts one.
    """
    return F.size(F.split(text, r"\\s+" if compat else r"\s+"))


def tokens(text: Column) -> Column:
    """Lower-cased text split at each single white-space character.

    Leading and doubled blanks give empty tokens and trailing ones do not, as in
    ``pyspark.ml.feature.Tokenizer``. Null text counts as empty text.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    body = F.rtrim(lowered, F.lit(BLANKS))
    only_blanks = (body == "") & (F.length(lowered) > 0)
    return F.when(only_blanks, F.array().cast("array<string>")).otherwise(F.split(body, r"\s"))


def without_stop_words(words: Column, stop_words: list[str] = ENGLISH_STOP_WORDS) -> Column:
    """Drop listed words, whatever their case. The list becomes one hash-set lookup."""
    listed = [w.lower() for w in stop_words]
    return F.filter(words, lambda w: ~F.lower(w).isin(listed))


def term_bucket(term: Column, buckets: int = 20_000) -> Column:
    """Feature index of a term: MurmurHash3 (seed 42) modulo ``buckets``.

    Equals the index ``HashingTF`` gave up to Spark 2.4; later versions hash the
    last one to three bytes of a term another way, see ``current_term_bucket``.
    """
    return F.pmod(F.hash(term), F.lit(buckets))


# MurmurHash3 (32 bit) constants and the inverses of its two closing multipliers modulo 2^32.
_C1, _C2, _CLOSE1, _CLOSE2 = 0xCC9E2D51, 0x1B873593, 0x85EBCA6B, 0xC2B2AE35
_OPEN1, _OPEN2 = pow(_CLOSE1, -1, 2**32), pow(_CLOSE2, -1, 2**32)
_LOW = 0xFFFFFFFF


Let = Callable[[Column, Callable[[Column], Column]], Column]


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used; works inside lambdas, where it is evaluated node by node."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _signed(number: Column) -> Column:
    """The low 32 bits of a long, as a signed number."""
    return F.shiftright(F.shiftleft(number, 32), 32)


def _times(number: Column, factor: int) -> Column:
    """Signed product modulo 2^32: that of two signed 32-bit numbers fits a long."""
    return _signed(number * F.lit(factor - 2**32 if factor >= 2**31 else factor).cast("long"))


def _fold(number: Column, *bits: int) -> Column:
    low = number.bitwiseAND(_LOW)
    return reduce(Column.bitwiseXOR, [F.shiftrightunsigned(low, b) for b in bits], number)


def murmur3(data: Column, let: Let = bound) -> Column:
    """The standard 32-bit MurmurHash3 (seed 42) of binary data, as a signed integer.

    ``F.hash`` differs only where one to three bytes are left over after whole words of four. So
    the state after the whole words is taken back from the hash of those words, by undoing its closing
    steps; the bytes left over are mixed in, and the steps are closed again: a fixed number of
    operations next to the built-in hash, whatever the length. ``let`` holds values that are used more than once.
    """
    size = F.octet_length(data).cast("long")
    whole = size.bitwiseAND(~3)
    state = F.hash(F.substring(data, F.lit(1), whole.cast("int"))).cast("long")
    state = _times(let(state, lambda h: _fold(h, 16)), _OPEN2)
    state = _times(let(state, lambda h: _fold(h, 13, 26)), _OPEN1)
    state = let(state, lambda h: _fold(h, 16))
    # The bytes left over are a number with the first byte lowest; hex digits put it highest.
    rest = F.conv(F.hex(F.rpad(F.substring(data, (whole + 1).cast("int"), F.lit(3)), 3, F.lit(b"\x00"))), 16, 10).cast("long")
    tail = let(rest, lambda x: F.shiftleft(x.bitwiseAND(0xFF), 16).bitwiseOR(x.bitwiseAND(0xFF00)).bitwiseOR(F.shiftright(x, 16)))
    tail = _times(tail, _C1)
    tail = let(tail, lambda k: F.shiftleft(k, 15).bitwiseOR(F.shiftrightunsigned(k.bitwiseAND(_LOW), 17)))
    tail = _times(_signed(tail), _C2)
    mixed = state.bitwiseXOR(whole).bitwiseXOR(tail).bitwiseXOR(size)
    mixed = _times(let(mixed, lambda h: _fold(h, 16)), _CLOSE1)
    mixed = _times(let(mixed, lambda h: _fold(h, 13)), _CLOSE2)
    closed = let(mixed, lambda h: _fold(h, 16)).cast("int")
    # Whole words need no mending.
    return F.when(size > whole, closed).when(size == whole, F.hash(data))


def current_term_bucket(term: Column, buckets: int = 20_000, let: Let = bound) -> Column:
    """Feature index of a term as ``HashingTF`` of the running Spark gives it."""
    return F.pmod(murmur3(F.encode(term, "UTF-8"), let), F.lit(buckets))
