"""Column expressions over `#`-delimited paths. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pathwarden.model import SEPARATOR


def segments(path: Column) -> Column:
    return F.split(path, SEPARATOR)


def segment_count(path: Column) -> Column:
    """Number of segments; a null path counts as -1, so that it never equals a depth."""
    return F.coalesce(F.size(segments(path)), F.lit(-1))


def path_depth(path: Column) -> Column:
    """Number of separators; null for a null path."""
    return F.size(segments(path)) - 1


def parent_path(path: Column) -> Column:
    """The path without its last segment; a path of one segment stays as it is."""
    return F.regexp_replace(path, "#[^#]+$", "")


def strip_levels(path: Column, levels) -> Column:
    """Drop the last `levels` segments; none left gives the empty string."""
    levels = levels if isinstance(levels, Column) else F.lit(levels)
    parts = segments(path)
    kept = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - levels, F.lit(0))), SEPARATOR)
    return F.when(levels <= 0, path).otherwise(kept)


def strip_own_code(path: Column, code: Column) -> Column:
    """Drop the last segment only where the path ends in the row's own code."""
    ends_in_code = F.endswith(path, F.concat(F.lit(SEPARATOR), code))
    return F.when(F.coalesce(ends_in_code, F.lit(False)), strip_levels(path, 1)).otherwise(path)


def position_of(path: Column, segment: Column) -> Column:
    """1-based place of `segment` in the path, 0 where absent, null for a null input."""
    return F.array_position(segments(path), segment).cast("int")


def segments_after(path: Column, segment: Column) -> Column:
    """How many segments follow the first `segment`; null where it is absent."""
    place = position_of(path, segment)
    return F.when(place > 0, F.size(segments(path)) - place)


def tail_after(path: Column, segment: Column) -> Column:
    """The array of segments that follow the first `segment`."""
    parts = segments(path)
    return F.slice(parts, position_of(path, segment) + 1, F.greatest(F.size(parts), F.lit(1)))


def path_prefixes(path: Column) -> Column:
    """Every prefix of the path that ends at a separator or at its end."""
    parts = segments(path)
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), SEPARATOR),
    )
