"""Arithmetic on vectors held as array columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.constants import IGNORE_LABEL, NF4_CODES, NORM_EPS, ROPE_THETA


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also when it is used inside a lambda
    (a plain expression there would be computed again for every item)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_double(vec: str | Column) -> Column:
    return (F.col(vec) if isinstance(vec, str) else vec).cast("array<double>")


def literal_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def elementwise(a: Column, b: Column, op: Callable[[Column, Column], Column]) -> Column:
    return F.zip_with(a, b, op)


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def multiply(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def divide(a: Column, b: Column) -> Column:
    """Quotient per element; a zero divisor gives NULL."""
    return F.zip_with(a, b, lambda x, y: F.try_divide(x, y))


def total(vec: Column) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x)


def mean(vec: Column) -> Column:
    return total(vec) / F.size(vec)


def dot(a: Column, b: Column) -> Column:
    return total(multiply(a, b))


def rsqrt(x: Column) -> Column:
    return F.lit(1.0) / F.sqrt(x)


def rms_norm(vec: Column, weights: Column, eps: float = NORM_EPS) -> Column:
    """Vector over its root mean square, times the weights."""
    scale = rsqrt(total(F.transform(vec, lambda x: x * x)) / F.size(vec) + F.lit(eps))
    return let(scale, lambda s: F.zip_with(vec, weights, lambda x, w: x * s * w))


def softmax(vec: Column, temperature: float = 1.0) -> Column:
    def powers(top: Column) -> Column:
        return F.transform(vec, lambda x: F.exp((x - top) / F.lit(float(temperature))))

    def shares(values: Column) -> Column:
        return let(total(values), lambda whole: F.transform(values, lambda e: e / whole))

    return let(let(F.array_max(vec), powers), shares)


def log_sum_exp(vec: Column) -> Column:
    return let(F.array_max(vec), lambda top: top + F.log(total(F.transform(vec, lambda x: F.exp(x - top)))))


def at_label(values: Column, label: Column) -> Column:
    """The value of a class; NULL for the ignored label, an error for any other number that is no class."""
    wrong = F.raise_error(F.concat(F.lit("no such class: "), label.cast("string")))
    outside = (label < 0) | (label >= F.size(values))
    return F.when(label == IGNORE_LABEL, F.lit(None)).when(outside, wrong).otherwise(F.get(values, label))


def cross_entropy(logits: Column, label: Column) -> Column:
    return log_sum_exp(logits) - at_label(logits, label)


def negative_log_likelihood(probabilities: Column, label: Column) -> Column:
    return -F.log(at_label(probabilities, label))


def squared_error(a: Column, b: Column) -> Column:
    """Mean squared difference of two vectors."""
    return mean(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def argmax(vec: Column) -> Column:
    """0-based index of the largest value; the lowest index wins a tie."""
    return (F.array_position(vec, F.array_max(vec)) - 1).cast("int")


def rotation_frequencies(size: int, theta: float = ROPE_THETA) -> list[float]:
    half = size // 2
    return [theta ** (-(j / half)) for j in range(half)]


def rope(vec: Column, pos: Column, size: int, theta: float = ROPE_THETA) -> Column:
    """Rotate consecutive pairs of ``vec`` by ``pos`` times the pair's frequency; another size than ``size`` is an error."""
    freqs = literal_vector(rotation_frequencies(size, theta))

    def rotate(freq: Column, j: Column) -> Column:
        re, im = F.get(vec, 2 * j), F.get(vec, 2 * j + 1)
        cos, sin = F.cos(pos * freq), F.sin(pos * freq)
        return F.array(re * cos - im * sin, re * sin + im * cos)

    wrong = F.raise_error(F.concat(F.lit(f"expected a vector of {size} values, got "), F.size(vec).cast("string")))
    return F.when(F.size(vec) != size, wrong).otherwise(F.flatten(F.transform(freqs, rotate)))


def broadcast_row(value: Column, row: Column, op: Callable[[Column, Column], Column]) -> Column:
    """One row of a (n,1) against (1,m) operation: the scalar meets every item of ``row``."""
    return F.transform(row, lambda y: op(value, y))


def split_heads(vec: Column, heads: int, head_dim: int) -> Column:
    """View one vector as ``heads`` vectors of ``head_dim``."""
    starts = F.sequence(F.lit(0), F.lit(heads - 1))
    return F.transform(starts, lambda h: F.slice(vec, h * head_dim + 1, F.lit(head_dim)))


def rope_heads(vec: Column, pos: Column, heads: int, head_dim: int, theta: float = ROPE_THETA) -> Column:
    """``rope`` of every head of a vector that holds them side by side."""
    return F.flatten(F.transform(split_heads(vec, heads, head_dim), lambda head: rope(head, pos, head_dim, theta)))


def block_scale(vec: Column) -> Column:
    return F.array_max(F.transform(vec, lambda x: F.abs(x)))


def quantize_int8(vec: Column) -> Column:
    """Struct of the block scale and 8-bit codes of ``vec``."""
    def codes(scale: Column) -> Column:
        return F.transform(vec, lambda x: F.when(scale == 0, 0.0).otherwise(F.round(x / scale * 127.0)).cast("tinyint"))

    return let(block_scale(vec), lambda scale: F.struct(scale.alias("scale"), codes(scale).alias("codes")))


def dequantize_int8(scale: Column, codes: Column) -> Column:
    return F.transform(codes, lambda c: c * scale / F.lit(127.0))


def quantize_nf4(vec: Column) -> Column:
    """Struct of the block scale and the index of the nearest of 16 code-book values."""
    middles = literal_vector([(a + b) / 2 for a, b in zip(NF4_CODES, NF4_CODES[1:])])

    def nearest(x: Column, scale: Column) -> Column:
        return F.size(F.filter(middles, lambda m: m * scale < x)).cast("tinyint")

    def codes(scale: Column) -> Column:
        return F.transform(vec, lambda x: nearest(x, scale))

    return let(block_scale(vec), lambda scale: F.struct(scale.alias("scale"), codes(scale).alias("codes")))


def dequantize_nf4(scale: Column, codes: Column) -> Column:
    book = literal_vector(NF4_CODES)
    return F.transform(codes, lambda c: F.get(book, c.cast("int")) * scale)
