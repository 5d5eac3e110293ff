"""Exact sums of doubles: decimal accumulators by exponent bin, added without rounding.

A finite double stands for the decimal number that Spark prints it as. That number falls into a
*bin*: ``part * 10^(9 * bin)`` with a part of nine decimals. Everyday amounts have bin 0, where
the part is the amount itself. Parts of one bin add up exactly as decimals, in any order and
over any number of tasks, so stored sums can be merged later. Only the end result is rounded,
once, to the nearest double.

A bin's sum holds 28 digits before the point; a part has at most 17, so 10^11 amounts fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_TYPE = "decimal(38,9)"
# One digit less while sums are finished: what is added to them then keeps its nine decimals.
_SUM_TYPE = "decimal(37,9)"
_TOP_TYPE = "decimal(27,0)"
# Amounts below 10^12 with at most nine decimals are their own part.
_PLAIN_TYPE = "decimal(21,9)"
_PRINTED = r"^-?(\\d+)\\.(\\d+)(?:E(-?\\d+))?$"

# The expressions are SQL text and the steps of a sum are columns of their own: nested lambdas
# would take Spark far longer to analyse than the data to run.


def _summable(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN NOT isnan({x}) AND abs({x}) <> double('inf') END"


def _part(x: str) -> str:
    """struct(bin, part) of the double ``x``."""
    plain = f"try_cast({x} AS {_PLAIN_TYPE})"
    digits, decimals, power = (f"regexp_extract(CAST({x} AS STRING), '{_PRINTED}', {i})" for i in (1, 2, 3))
    exponent = f"(coalesce(try_cast({power} AS INT), 0) - length({decimals}))"
    bin_ = f"CAST(floor({exponent} / 9) + 1 AS INT)"
    scaled = (f"try_cast(concat(CASE WHEN {x} < 0 THEN '-' ELSE '' END, {digits}, {decimals}, 'E', "
              f"{exponent} - 9 * {bin_}) AS {PART_TYPE})")
    return (f"CASE WHEN CAST({plain} AS DOUBLE) = {x} "
            f"THEN named_struct('bin', 0, 'part', CAST({plain} AS {PART_TYPE})) "
            f"WHEN {_summable(x)} THEN named_struct('bin', {bin_}, 'part', {scaled}) END")


def summable(name: str) -> Column:
    """False for NaN and infinities; NULL for NULL."""
    return F.expr(_summable(name))


def exact_part(name: str) -> Column:
    """struct(bin, part) of a double column; NULL for NULL, NaN and infinities."""
    return F.expr(_part(name))


def part_sum(name: str = "part") -> Column:
    """Sum of the parts of one bin; NULL if there is none."""
    return F.try_sum(name)


def part_list(bin_: str = "bin", part: str = "part") -> Column:
    """Aggregate: the (bin, part) pairs of a group that has one sum for each bin."""
    return F.expr(f"collect_list(CASE WHEN {bin_} IS NOT NULL THEN "
                  f"named_struct('bin', {bin_}, 'part', {part}) END)")


def _digits(sign: str) -> str:
    """(top, digits) of the sum or its opposite: whole part in the highest bin, nine digits a bin.

    Bin by bin from the lowest, what lies above a bin's nine decimals is carried to the next.
    """
    mine = f"coalesce(try_element_at(_by_bin, b), CAST(0 AS {_SUM_TYPE}))"
    carried = f"CAST(a.top * CAST(0.000000001 AS DECIMAL(10,9)) AS {_SUM_TYPE})"
    total = f"CAST({sign}{mine} + {carried} AS {_SUM_TYPE})"
    top = f"CAST(floor({total}) AS {_TOP_TYPE})"
    rest = f"CAST(CAST({total} - {top} AS DECIMAL(10,9)) * 1000000000 AS BIGINT)"
    return (f"aggregate(sequence(array_min(map_keys(_by_bin)), array_max(map_keys(_by_bin))), "
            f"named_struct('top', CAST(0 AS {_TOP_TYPE}), 'digits', ''), (a, b) -> named_struct("
            f"'top', {top}, 'digits', concat(lpad(CAST({rest} AS STRING), 9, '0'), a.digits)))")


def with_double(df: DataFrame, parts: str, name: str) -> DataFrame:
    """Add ``name``, the nearest double of a list of (bin, part) sums; NULL for an empty list."""
    def read(sign: str, n: str) -> str:
        return (f"CAST(concat('{sign}', {n}.top, {n}.digits, 'E', "
                f"9 * array_min(map_keys(_by_bin)) - 9) AS DOUBLE)")

    plain = f"size({parts}) = 1 AND {parts}[0].bin = 0"
    by_bin = f"map_from_entries(transform({parts}, p -> struct(p.bin, CAST(p.part AS {_SUM_TYPE}))))"
    df = df.withColumn("_by_bin", F.expr(f"CASE WHEN size({parts}) > 0 AND NOT ({plain}) THEN {by_bin} END"))
    df = df.withColumn("_plus", F.expr(f"CASE WHEN _by_bin IS NOT NULL THEN {_digits('')} END"))
    # a negative sum is read from the digits of its opposite
    df = df.withColumn("_minus", F.expr(f"CASE WHEN _plus.top < 0 THEN {_digits('-')} END"))
    return df.withColumn(name, F.expr(
        f"CASE WHEN {plain} THEN CAST({parts}[0].part AS DOUBLE) "
        f"WHEN _minus IS NOT NULL THEN {read('-', '_minus')} "
        f"WHEN _plus IS NOT NULL THEN {read('', '_plus')} END")).drop("_by_bin", "_plus", "_minus")


def with_rest(df: DataFrame, parts: str, rounded: str, name: str) -> DataFrame:
    """Add ``name``, what the double ``rounded`` leaves of the sum, as a double.

    It orders sums that round alike; NULL where there is no sum, or an infinite one.
    """
    df = df.withColumn("_taken", F.expr(_part(f"(-{rounded})")))
    others = f"transform({parts}, p -> p.bin)"
    left = (f"concat(transform({parts}, p -> named_struct('bin', p.bin, 'part', CASE WHEN p.bin = _taken.bin "
            f"THEN CAST(CAST(p.part AS {_SUM_TYPE}) + CAST(_taken.part AS {_SUM_TYPE}) AS {PART_TYPE}) "
            f"ELSE p.part END)), CASE WHEN array_contains({others}, _taken.bin) "
            f"THEN array() ELSE array(_taken) END)")
    df = df.withColumn("_left", F.expr(f"CASE WHEN size({parts}) > 0 AND _taken IS NOT NULL THEN {left} END"))
    return with_double(df, "_left", name).drop("_taken", "_left")
