"""Array mathematics on built-in functions. A frame is one flat row-major array."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def array_sum(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def array_mean(xs: Column) -> Column:
    return F.when(F.size(xs) > 0, array_sum(xs) / F.size(xs))


def _rows(data: Column, width: Column, height: Column, row) -> Column:
    """Map every frame row; NULL when the array does not hold width x height elements."""
    whole = (width > 0) & (height > 0) & (F.size(data) == width * height)
    rows = F.transform(F.sequence(F.lit(0), F.greatest(height, F.lit(1)) - 1),
                       lambda r: row(F.slice(data, r * width + 1, width)))
    return F.when(whole, rows)


def reshape(data: Column, width: Column, height: Column) -> Column:
    """Flat array to rows of columns."""
    return _rows(data, width, height, lambda xs: xs)


def row_means(data: Column, width: Column, height: Column) -> Column:
    """Projection: mean of every row."""
    return _rows(data, width, height, lambda xs: array_sum(xs) / width)


def zero_mean(xs: Column) -> Column:
    """Subtract the array's own mean."""
    # array and mean are bound as one-element arrays: lambda bodies are evaluated per element,
    # and a repeated expression would be computed again each time it is named
    def shifted(a: Column) -> Column:
        return F.flatten(F.transform(F.array(array_mean(a)),
                                     lambda m: F.transform(a, lambda x: x - m)))

    return F.flatten(F.transform(F.array(xs), shifted))


def linear_axis(count: Column, first: float, last: float) -> Column:
    """`count` evenly spaced points from first to last, both included."""
    step = F.when(count > 1, F.lit(last - first) / (count - 1)).otherwise(F.lit(0.0))
    points = F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1),
                         lambda i: F.lit(float(first)) + i * step)
    return F.when(count > 0, points)


def pixel_axis(count: Column, pixels_per_unit: float) -> Column:
    """Pixel positions in length units, centred on zero."""
    return zero_mean(F.transform(linear_axis(count, 0.0, 1.0),
                                 lambda x: x * count / F.lit(float(pixels_per_unit))))


def repair_axis(axis: Column, length: Column) -> Column:
    """Replace the last sample by its predecessor plus the last good step, then crop."""
    prev, before = F.try_element_at(axis, F.lit(-2)), F.try_element_at(axis, F.lit(-3))
    fixed = F.concat(F.slice(axis, F.lit(1), F.greatest(F.size(axis) - 1, F.lit(0))),
                     F.array(prev + (prev - before)))
    return F.slice(F.when(F.size(axis) >= 3, fixed), F.lit(1), length)


def frequency_step(axis: Column) -> Column:
    """Spacing in GHz of the spectrum over a time axis in picoseconds."""
    window = F.try_element_at(axis, F.lit(-1)) - F.try_element_at(axis, F.lit(1))
    return F.when(window != 0, F.lit(1e3) / window)


def peak_bin(spectrum: Column) -> Column:
    """0-based position of the maximum; the lowest wins a tie."""
    return (F.array_position(spectrum, F.array_max(spectrum)) - 1).cast("int")


def parse_numbers(text: Column) -> Column:
    """Whitespace-separated numbers; a malformed one is NULL."""
    return F.transform(F.split(F.trim(text), r"\s+"), lambda x: x.try_cast("double"))


def sample_variance(xs: Column) -> Column:
    """Unbiased variance; NULL below two samples."""
    squares = F.aggregate(zero_mean(xs), F.lit(0.0), lambda acc, d: acc + d * d)
    return F.when(F.size(xs) > 1, squares / (F.size(xs) - 1))
