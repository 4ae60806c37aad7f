"""Scores from 0 to 100 for how alike two texts are.

`levenshtein` stays in the JVM. `ratio` and `weighted` follow the public definition of
the matching-blocks ratio and of its token and partial variants; they run in
Arrow batches, behind a JVM filter wherever a cutoff is known.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathwarden.functions.batches import ratios

SCORERS = ("levenshtein", "ratio", "ratio_plain", "weighted")


def levenshtein_score(a: Column, b: Column) -> Column:
    """100 x (1 - distance / longer length), rounded half up, in whole numbers."""
    longer = F.greatest(F.length(a), F.length(b))
    kept = longer - F.levenshtein(a, b)
    return F.when(longer == 0, F.lit(100)).otherwise(F.floor((kept * 200 + longer) / (longer * 2)).cast("int"))


def plain_text(text: Column) -> Column:
    """Lower case, blanks for everything but letters, digits and underscores, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)\W", " "))


def sorted_tokens(text: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(text, r"\s+"), lambda t: t != "")), " ")


def _plain(text: str) -> str:
    return re.sub(r"\W", " ", text).lower().strip()


def _ratio(a: str, b: str) -> int:
    if a == b:
        return 100
    if not a or not b:
        return 0
    return round(100 * SequenceMatcher(None, a, b).ratio())


def _partial(a: str, b: str) -> int:
    """The best ratio of the shorter text against an equally long piece of the longer one."""
    if a == b:
        return 100
    if not a or not b:
        return 0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    best = 0.0
    for block in SequenceMatcher(None, short, long).get_matching_blocks():
        begin = max(block.b - block.a, 0)
        piece = SequenceMatcher(None, short, long[begin : begin + len(short)]).ratio()
        if piece > 0.995:
            return 100
        best = max(best, piece)
    return round(100 * best)


def _token_scores(a: str, b: str, scorer) -> int:
    """The better of the sorted-token score and of the shared-token scores."""
    by_order = scorer(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    left, right = set(a.split()), set(b.split())
    # The scores of equal texts are 100, and no score is higher.
    if by_order == 100 or left <= right or right <= left:
        return 100
    shared = " ".join(sorted(left & right))
    with_left = (shared + " " + " ".join(sorted(left - right))).strip()
    with_right = (shared + " " + " ".join(sorted(right - left))).strip()
    by_set = max(scorer(shared, with_left), scorer(shared, with_right), scorer(with_left, with_right))
    return max(by_order, by_set)


def weighted_score(a: str, b: str) -> int:
    """The composite score: plain ratio, token scores at 0.95, partial ones when lengths differ."""
    p, q = _plain(a), _plain(b)
    if not p or not q:
        return 0
    base = _ratio(p, q)
    lengths = max(len(p), len(q)) / min(len(p), len(q))
    # Fixed weights of the composite score.
    if lengths < 1.5:
        return round(max(base, 0.95 * _token_scores(p, q, _ratio)))
    scale = 0.6 if lengths > 8 else 0.9
    return round(max(base, scale * _partial(p, q), 0.95 * scale * _token_scores(p, q, _partial)))


def plain_ratio(a: str, b: str) -> int:
    return _ratio(_plain(a), _plain(b))


def _nearly_equal(a: str, b: str) -> int:
    """The ratio where it may round to 100, else 0."""
    # Texts that differ have an unmatched character, which is over a half of a hundredth in less than 200.
    if a == b or len(a) + len(b) < 200:
        return 100 * (a == b)
    matcher = SequenceMatcher(None, a, b)
    return _ratio(a, b) if min(matcher.real_quick_ratio(), matcher.quick_ratio()) >= 0.99 else 0


def weighted_scores(a: list[str], b: list[str], least: int = 0) -> list[int]:
    """The composite scores of pairs: exact from `least` on, any lower number below it."""
    if least <= 94:
        return [weighted_score(x, y) for x, y in zip(a, b)]
    # Texts of unlike lengths stay below 91, token scores under 100 below 95, and none of them exceeds a ratio of 95.
    plain = {text: _plain(text) for text in {*a, *b}}
    left, right = [plain[x] for x in a], [plain[y] for y in b]
    like = [bool(p and q) and max(len(p), len(q)) < 1.5 * min(len(p), len(q)) for p, q in zip(left, right)]
    scores, at = [0] * len(like), [k for k, yes in enumerate(like) if yes]
    for k, base in zip(at, ratios([left[k] for k in at], [right[k] for k in at]).tolist()):
        scores[k] = base
        if base < 95 and least == 95 and _token_scores(left[k], right[k], _nearly_equal) == 100:
            scores[k] = 95
    return scores


_BATCH_SCORERS = {
    "ratio": lambda a, b, least: ratios(a, b),
    "ratio_plain": lambda a, b, least: ratios([_plain(x) for x in a], [_plain(y) for y in b]),
    "weighted": weighted_scores,
}
_PYTHON_SCORERS = {"ratio": _ratio, "ratio_plain": plain_ratio, "weighted": weighted_score}


def score_of(a: Column, b: Column, scorer: str, least: int = 0) -> Column:
    """The score of two text columns; of scores below `least` only that they are is known."""
    if scorer == "levenshtein":
        return levenshtein_score(a, b)
    compare = _BATCH_SCORERS[scorer]

    @F.pandas_udf(T.IntegerType())
    def scores(left, right):
        import pandas as pd

        known = (left.notna() & right.notna()).to_numpy()
        values = np.zeros(len(known), np.int32)
        if known.any():
            values[known] = compare(left[known].tolist(), right[known].tolist(), least)
        return pd.Series(values)

    return scores(a, b)


def best_of(text: Column, choices: Column, scorer: str) -> Column:
    """The best entry of an array of (ordinal, choice), as (score, ordinal, choice); ties to the first."""
    if scorer == "levenshtein":
        scored = F.transform(
            choices,
            lambda c: F.struct(
                levenshtein_score(text, c["choice"]).alias("score"), (-c["ordinal"]).alias("rank"), c["choice"].alias("choice")
            ),
        )
        top = F.array_max(scored)
        return F.struct(top["score"].alias("score"), (-top["rank"]).alias("ordinal"), top["choice"].alias("choice"))
    compare = _PYTHON_SCORERS[scorer]
    result = T.StructType([T.StructField("score", T.IntegerType()), T.StructField("at", T.IntegerType())])

    @F.pandas_udf(result)
    def best(texts, options):
        import pandas as pd

        rows = []
        for value, names in zip(texts, options):
            # A missing text or an empty list has no best entry.
            scores = [] if pd.isna(value) or names is None else [compare(value, name) for name in names]
            top = max(scores, default=None)
            rows.append((top, None if top is None else scores.index(top)))
        return pd.DataFrame(rows, columns=["score", "at"]).astype("Int32")

    found = best(text, F.transform(choices, lambda c: c["choice"]))
    chosen = F.get(choices, found["at"])
    return F.struct(found["score"].alias("score"), chosen["ordinal"].alias("ordinal"), chosen["choice"].alias("choice"))
